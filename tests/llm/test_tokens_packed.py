"""Sequences of tokens and aligned tokens against direct, plain versions."""

import hashlib
import itertools
import os
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from shelftrack.llm import alignment, packing

FOLDER = Path(os.environ.get("SHELFTRACK_TOKENIZERS", "/opt/tokenizers"))
WORDS, BYTES, PIECES = FOLDER / "word_bpe_49k.json", FOLDER / "byte_bpe_50k.json", FOLDER / "piece_bpe_32k.model"
TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not WORDS.exists(), reason="no tokenizers")

ODD = [
    None,
    "",
    " ",
    "\n\n \t x",
    "one two  three   four ",
    "it's  don't 12345 3.14 e-mail@x.org <|endoftext|> <s> </s> <unk> <0x41>",
    "Straße ÉTÉ été  nbsp  thin space 　wide  line",
    "日本語のテキスト 中文 한국어 🙂🙃 👩‍👩‍👧 ​ zero",
    "a▁b mark",
    "mark \x01 in\x01side \x01",
    "Word. WORD, (word.) é! ÷, ×: don't. 'S's, x.. x.,y a.b H\u0331. h\u0331, J\u030c",
    "End.",
    ", starts",
    "nul \x00 \x1c\x1d \x7f del",
    "x" * 3000 + " " * 50 + "yz" * 700,
    "é ́ combining",
    "\u0085next   ogham᠎",
]


def texts():
    found = list(ODD)
    if TABLES.exists():
        import pyarrow.parquet as pq

        found += pq.read_table(TABLES / "documents.parquet").column("text").to_pylist()
    return found


def frame(spark, rows):
    schema = "doc_id long, text string, piece string, shard int, row string, block string"
    return spark.createDataFrame([(i, t, "p", 1, "r", "b") for i, t in rows], schema)


# Packing.


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(WORDS))
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_are_encoded_as_whole_texts(word_tokenizer):
    words, given = packing.WordTokens(WORDS.read_text(encoding="utf-8")), texts()
    for step in (1, 7, len(given)):
        words.known.most = 50 if step == 7 else 300_000
        for at in range(0, len(given), step):
            numbers, bounds = words.encode(pa.array(given[at : at + step], pa.string()))
            for text, a, b in zip(given[at : at + step], bounds, bounds[1:], strict=False):
                assert [*numbers[a:b].tolist(), 1] == word_tokenizer(text), text


def plain_squares(lengths, limit):
    """Sequences as lists of lengths: the sum of squares is counted anew for every place."""
    open_ = []

    def squares(gaps):
        return sum(n * n for gap, n in Counter(gaps).items() if gap)

    for length in lengths:
        gaps = [limit - sum(s) for s in open_]
        fits = [i for i, gap in enumerate(gaps) if gap >= length]
        if fits:
            best = min(fits, key=lambda i: (squares(gaps[:i] + [gaps[i] - length] + gaps[i + 1 :]), gaps[i]))
            open_[best].append(length)
        else:
            open_.append([length])
    return Counter(tuple(s) for s in open_)


@pytest.mark.parametrize("seed", range(6))
def test_place_makes_the_squares_smallest(seed):
    rng = np.random.default_rng(seed)
    limit = int(rng.integers(4, 30))
    lengths = rng.integers(1, limit + 1, 120)
    lengths = np.sort(lengths)[::-1] if seed % 2 else lengths
    sequence, offset = packing.place(lengths, limit)
    found = defaultdict(list)
    for i, s in enumerate(sequence.tolist()):
        assert offset[i] == sum(found[s])
        found[s].append(int(lengths[i]))
    # Sequences of one gap are alike, so which of them a length joins does not matter.
    assert Counter(map(sum, found.values())) == Counter(map(sum, plain_squares(lengths.tolist(), limit).elements()))


def check_packed(spark, rows, limit, word_tokenizer, keep=True):
    found = packing.pack(frame(spark, rows), str(WORDS), limit, keep=keep).collect()
    wanted = Counter()
    for i, text in rows:
        ids = word_tokenizer(text)
        for start in range(0, len(ids), limit):
            part = ids[start : start + limit]
            wanted[(i, start // limit, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.tokens)) for r in found) == wanted
    of_sequence = defaultdict(list)
    for r in found:
        of_sequence[r.sequence_id].append((r.offset, r.length))
    for spans in of_sequence.values():
        spans.sort()
        assert [a for a, _ in spans] == list(itertools.accumulate([n for _, n in spans], initial=0))[:-1]
        assert sum(n for _, n in spans) <= limit
    return len(of_sequence), -(-sum(r.length for r in found) // limit)


@pytest.mark.parametrize("limit", [1, 7, 64, 4096])
def test_pack(spark, word_tokenizer, limit):
    rows = [*enumerate(texts()), (None, "no id"), (None, "no id"), (3, "one two"), (3, "one two")]
    used, least = check_packed(spark, rows[-60:] if limit < 64 else rows, limit, word_tokenizer)
    assert used <= least + 2


def test_pack_in_shards(spark, word_tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 25)
    used, least = check_packed(spark, list(enumerate(texts())), 4096, word_tokenizer)
    assert used <= least + 10


def test_pack_empty(spark):
    found = packing.pack(frame(spark, []), str(WORDS))
    assert found.count() == 0
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


# Alignment.


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(str(BYTES))
    a.encode_special_tokens = True
    char = alignment._byte_of_char()
    b = sentencepiece.SentencePieceProcessor(model_file=str(PIECES))
    docs = []
    for i, text in rows:
        body = (" " + text).encode() if text else b""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(char[ch] for ch in a.id_to_token(k)) for k in ids_a]
        pieces = [(k, b.id_to_piece(k)) for k in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in pieces]
        if b"".join(bytes_a) != body or b"".join(bytes_b) != body:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a = list(itertools.accumulate(map(len, bytes_a)))
        ends_b = list(itertools.accumulate(map(len, bytes_b)))
        groups, p, q = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_p, to_q = ends_a.index(end, p) + 1, ends_b.index(end, q) + 1
            groups.append((ids_a[p:to_p], ids_b[q:to_q]))
            p, q = to_p, to_q
        docs.append((i, ids_a, ids_b, groups))
    held = Counter()
    for *_, groups in docs:
        held.update({pair for g in groups for pair in itertools.product(*g)})
    best = defaultdict(int)
    for (k, _), n in held.items():
        best[k] = max(best[k], n)
    out = []
    for i, ids_a, ids_b, groups in docs:
        links = [pair for g in groups for pair in itertools.product(*g)]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        n_best = sum(held[pair] == best[pair[0]] for pair in links)
        out.append((i, len(ids_a), len(ids_b), len(groups), len(links), n_best, sum(held[pair] for pair in links), text))
    return Counter(out)


@pytest.mark.parametrize("part", [8 << 20, 2000])
def test_align(spark, monkeypatch, part):
    monkeypatch.setattr(alignment, "_PART", part)
    rows = [*enumerate(texts()), (None, "no id here"), (None, "no id here"), (3, "one two  three")]
    found = alignment.align(frame(spark, rows).repartition(3), str(BYTES), str(PIECES))
    assert found.columns == alignment._RESULT
    wanted = plain_alignment(rows)
    assert Counter(map(tuple, found.collect())) == wanted
    hashed = alignment.align(frame(spark, rows), str(BYTES), str(PIECES), digest=True)
    assert Counter(map(tuple, hashed.collect())) == Counter(
        {(*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else ""): n for row, n in wanted.items()}
    )


@pytest.mark.parametrize("wide", [4096, 2])
def test_align_forgets(monkeypatch, wide):
    """One text at a time, few known segments, and wide groups counted first."""
    pair, given = alignment.Pair(BYTES.read_text(encoding="utf-8"), PIECES.read_bytes()), texts()
    whole = pair.align(pa.array(given, pa.string()))
    monkeypatch.setattr(alignment, "_WIDE", wide)
    pair.known.most = 20
    for at, text in enumerate(given):
        groups, totals, owner, links, times = pair.align(pa.array([text], pa.string()))
        assert groups == [whole[0][at]] and totals[0].tolist() == whole[1][at].tolist()
        mine = whole[2] == at
        assert links.tolist() == whole[3][mine].tolist() and times.tolist() == whole[4][mine].tolist()


def test_align_empty(spark):
    assert alignment.align(frame(spark, []), str(BYTES), str(PIECES)).count() == 0
    assert [tuple(r) for r in alignment.align(frame(spark, [(1, None), (2, "")]), str(BYTES), str(PIECES)).orderBy("doc_id").collect()] == [
        (1, 0, 0, 0, 0, 0, 0, ""),
        (2, 0, 0, 0, 0, 0, 0, ""),
    ]


def test_map_of_equal_bytes():
    pair = alignment.Pair(BYTES.read_text(encoding="utf-8"), PIECES.read_bytes())
    for a in range(0, pair.n_a, 97):
        if pair.same[a] >= 0:
            assert pair.a_bytes.join(np.array([a])).tobytes() == pair.b_bytes.join(pair.same[[a]]).tobytes()
    assert (pair.same >= 0).mean() > 0.2
