"""Passages, strings, lines and fingerprints against brute force on small tables."""

import hashlib
import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelftrack.llm import line_dedup, simhash, substring_dedup, suffix_dedup
from shelftrack.llm import common as c

SCHEMA = "doc_id long, text string"


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0]))


def sha(body):
    return hashlib.sha256(body).hexdigest()


@pytest.fixture(scope="module")
def noisy():
    """Cuts of one long text with small changes, a copy, a null, an empty text and one without an id."""
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh é\n ") for _ in range(4000))
    rows = []
    for i in range(120):
        at = rng.randrange(3000)
        text = list(base[at : at + rng.randint(0, 900)])
        for _ in range(rng.randint(0, 4)):
            if text:
                text[rng.randrange(len(text))] = rng.choice("xyz")
        rows.append((i, "".join(text)))
    rows[5], rows[6], rows[9] = (5, None), (6, ""), (None, rows[9][1])
    return rows + [(900, rows[20][1]), (901, rows[20][1]), (902, "a" * 700), (903, "ab" * 300), (904, "w " * 90)]


def words_left(rows, width):
    seen, out = set(), {}
    for doc_id, text in by_id(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - width + 1):
            window = tuple(words[s : s + width])
            if window in seen:
                gone[s : s + width] = [True] * width
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc_id] = (len(words), sum(gone), sha(kept))
    return out


def bytes_left(rows, width):
    seen, out = set(), {}
    for doc_id, text in by_id(rows):
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for s in range(len(body) - width + 1):
            if body[s : s + width] in seen:
                gone[s : s + width] = True
            seen.add(body[s : s + width])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc_id] = (len(body), int(gone.sum()), runs, sha(np.frombuffer(body, np.uint8)[~gone].tobytes()))
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def lines_left(rows, most, near):
    seen, out = [], {}
    for doc_id, text in by_id(rows):
        lines, kept = text.split("\n") if text else [], []
        for line in lines:
            body = line.encode()
            close = lambda o, b=body: b == o or (min(len(b), len(o)) >= near and abs(len(b) - len(o)) <= most and edits(b, o) <= most)
            if not (body.strip() and any(close(o) for o in seen)):
                kept.append(line)
            if body.strip():
                seen.append(body)
        out[doc_id] = (len(lines), len(lines) - len(kept), sha("\n".join(kept).encode()))
    return out


def collected(df):
    rows = df.collect()
    found = {r[0]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("block", [2000, 4 << 20])
@pytest.mark.parametrize("width", [13, 20])
def test_passages(spark, monkeypatch, noisy, block, width):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    df = spark.createDataFrame(noisy, SCHEMA)
    assert collected(substring_dedup.remove_repeated_passages(df, width, digest=True)) == words_left(noisy, width)


def test_passage_spans(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (2, "new " + text + " end")], SCHEMA)
    rows = {r.doc_id: r for r in substring_dedup.remove_repeated_passages(df).collect()}
    assert rows[2].kept == "new end" and [tuple(s) for s in rows[2].spans] == [(1, 31)]
    assert rows[1].kept == text and rows[1].spans == []


@pytest.mark.parametrize("block,hot", [(5000, 8192), (5000, 4), (5000, 1), (3 << 20, 8192)])
def test_strings(spark, monkeypatch, noisy, block, hot):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 40)
    df = spark.createDataFrame(noisy, SCHEMA)
    assert collected(suffix_dedup.remove_repeated_strings(df, 100, digest=True)) == bytes_left(noisy, 100)


def test_string_spans(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(300))
    df = spark.createDataFrame([(1, text), (2, "é" + text)], SCHEMA)
    row = {r.doc_id: r for r in suffix_dedup.remove_repeated_strings(df, 40).collect()}[2]
    assert bytes(row.kept) == "é".encode() and [tuple(s) for s in row.spans] == [(2, 302)]


def test_transform():
    rng = random.Random(9)
    for _ in range(20):
        texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 20))]
        first, width = np.concatenate([[0], np.cumsum([len(t) for t in texts])]), rng.randint(1, 6)
        owner, offset, kind = suffix_dedup.repeated_prefixes(np.frombuffer(b"".join(texts), np.uint8), first, width)
        wanted, got = {}, {}
        for i, text in enumerate(texts):
            for at in range(len(text) - width + 1):
                wanted.setdefault(text[at : at + width], []).append((i, at))
        for row in zip(owner.tolist(), offset.tolist(), kind.tolist(), strict=True):
            got.setdefault(row[2], []).append(row[:2])
        assert sorted(sorted(v) for v in got.values()) == sorted(sorted(v) for v in wanted.values())


@pytest.mark.parametrize("most,hot", [(0, 200), (1, 200), (2, 200), (0, 1), (1, 1), (2, 1), (2, 4)])
def test_lines(spark, monkeypatch, most, hot):
    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefg hé") for _ in range(rng.randint(3, 60))) for _ in range(40)]

    def changed(line):
        line = list(line)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(line) + 1)
            if rng.random() < 0.4:
                line.insert(at, rng.choice("xyz"))
            elif line:
                line.pop(min(at, len(line) - 1))
        return "".join(line)

    rows = [(i, "\n".join(rng.choice(["", "  ", changed(rng.choice(base)), rng.choice(base)]) for _ in range(rng.randint(0, 8)))) for i in range(150)]
    rows[7], rows[50] = (7, None), (None, rows[50][1])
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(line_dedup.remove_repeated_lines(df, most, digest=True)) == lines_left(rows, most, 24)


@pytest.mark.parametrize("shape", ["id {:08x} of the nightly run", "the same words in front of {:06d}", "x{:04d} and the rest is always the same"])
def test_lines_of_one_template(spark, monkeypatch, shape):
    """Far more lines than a key may bring together; near ones among them are found as by brute force."""
    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", 4000)
    rng = random.Random(len(shape))
    rows = [(i, "\n".join(shape.format(rng.randrange(10**6)) [: rng.choice([99, 99, -1])] for _ in range(8))) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(line_dedup.remove_repeated_lines(df, 2, digest=True)) == lines_left(rows, 2, 24)


def test_changed_copies_of_one_long_line(spark, monkeypatch):
    """Copies with a few letters put in somewhere: all share most segments, few are near."""
    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", 20_000)
    rng = random.Random(9)
    base = " ".join("".join(rng.choice("etaoinshr") for _ in range(5)) for _ in range(18))
    changes = [(rng.randrange(len(base)), "".join(rng.choice("xyz") for _ in range(4))) for _ in range(230)]
    changes += [(at, new[:-1] + "q") for at, new in rng.choices(changes, k=40)]
    rows = [(i, base[:at] + new + base[at:]) for i, (at, new) in enumerate(changes)]
    rows += [(400, base), (401, base[:-1] + "q")]
    monkeypatch.setattr(line_dedup, "_DEALT", 50)
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(line_dedup.remove_repeated_lines(df, 2, digest=True)) == lines_left(rows, 2, 24)


def test_many_lines_of_one_template(spark):
    """Distinct lines that share a segment, none near another: all stay, in time that grows with their number."""
    took = []
    for n in (5_000, 20_000):
        rows = [(i, "\n".join(f"INFO connection from host {(i * 100 + k) * 2654435761 % 2**32 * 65537:014x} closed" for k in range(100))) for i in range(n // 100)]
        began = time.perf_counter()
        found = line_dedup.remove_repeated_lines(spark.createDataFrame(rows, SCHEMA), 2, digest=True).agg(F.sum("n_lines"), F.sum("n_removed")).first()
        took.append(time.perf_counter() - began)
        assert found[0] == n and found[1] < n / 50
    assert took[1] < 8 * max(took[0], 2)


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4])
def test_edit_distance(most):
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(50)]
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    stops = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], stops[:-1] + 1])
    a, b = (v.ravel() for v in np.meshgrid(np.arange(50), np.arange(50)))
    got = line_dedup.within(data, starts[a], (stops - starts)[a], starts[b], (stops - starts)[b], most)
    assert got.tolist() == [edits(texts[i], texts[j]) <= most for i, j in zip(a, b, strict=True)]


def marks_of(text):
    words = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(marks, most):
    root = {i: i for i in marks}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    names = sorted(marks)
    for n, i in enumerate(names):
        for j in names[n + 1 :]:
            if (marks[i] ^ marks[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in names}


def test_near_duplicates(spark):
    rng = random.Random(1)
    words = [f"Wört{i}" for i in range(50)] + ["The", "the", "　x"]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 200)))
        rows.append((3 * i, text))
        changed = text.split(" ")
        if changed:
            changed[rng.randrange(len(changed))] = "other"
        rows.append((3 * i + 1, " ".join(changed)))
    rows += [(900, None), (901, ""), (902, " \t "), (903, "one two"), (904, rows[0][1].upper())]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df, 3, 6).collect()}
    marks = {i: marks_of(t) for i, t in rows}
    parts = components_of(marks, 6)
    assert len(set(parts.values())) < len(rows) - 20
    assert got == {i: (format(m, "016x"), parts[i]) for i, m in marks.items()}


def test_rows_without_id(spark):
    df = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "z y x")], SCHEMA)
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=repr) == [(7, 7), (7, 7), (None, 7), (None, None)]


@pytest.mark.parametrize("leaf", [16, 300, 4096])
def test_trie_join(spark, leaf):
    rng = np.random.default_rng(1)
    marks = rng.integers(0, 2**64, 100, dtype=np.uint64)
    for _ in range(4):
        flipped = marks ^ (np.uint64(1) << rng.integers(0, 64, len(marks)).astype(np.uint64))
        marks = np.unique(np.concatenate([marks, flipped]))[:600]
    wanted = {(i, j) for i in range(len(marks)) for j in range(i + 1, len(marks)) if int(marks[i] ^ marks[j]).bit_count() <= 2}
    got = [p for x, y in simhash.close_pairs(marks, None, 2) for p in zip(x.tolist(), y.tolist(), strict=True)]
    assert set(got) == wanted and len(got) == len(wanted)
    signed = marks.view(np.int64)
    df = spark.createDataFrame([(int(m),) for m in signed], "mark long")
    pairs = [tuple(sorted(r)) for r in simhash.close_fingerprints(df, 2, leaf).collect()]
    assert sorted(pairs) == sorted(tuple(sorted((int(signed[i]), int(signed[j])))) for i, j in wanted)


def test_components(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 160)]
    edges = chain + star + [(500, 400), (400, 450), (7, 7)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in c.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}, 450: 400, 500: 400}


def test_run_hashes():
    words = np.arange(1, 60, dtype=np.uint64)
    for n in (1, 2, 3, 8, 13, 20, 32, 59, 60):
        hashes = c.run_hashes(words, n)
        assert len(hashes) == max(0, 60 - n)
        again = c.run_hashes(np.concatenate([words[5:], words]), n)
        if n <= 50:
            assert hashes[5] == again[0] and len(np.unique(hashes)) == len(hashes)


OPERATORS = [
    lambda df: substring_dedup.remove_repeated_passages(df, digest=True),
    lambda df: suffix_dedup.remove_repeated_strings(df, digest=True),
    lambda df: line_dedup.remove_repeated_lines(df, digest=True),
    lambda df: simhash.near_duplicates(df),
]


@pytest.mark.parametrize("operator", OPERATORS)
def test_empty_tables_and_other_columns(spark, operator):
    empty = spark.createDataFrame([], SCHEMA + ", block int, bucket string, body binary, mark long")
    assert operator(empty).count() == 0
    long = "lorem ipsum dolor " * 20000 + "x" * 5000
    rows = [(1, long, 1, "b"), (2, long, 2, None), (2, long, 2, None), (None, None, None, None), (3, "\n" * 50, 0, "")]
    clashing = spark.createDataFrame(rows, SCHEMA + ", block int, bucket string")
    found = operator(clashing.withColumn("hash", F.lit(1)).withColumn("place", F.lit("x")))
    assert found.count() == 5


def test_line_dedup_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a line of text here\nb", "en"), (2, "a line of text here\nc", None)], SCHEMA + ", lang string")
    rows = {r.doc_id: r for r in line_dedup.remove_repeated_lines(df, keep=True).collect()}
    assert rows[2].kept == "c" and rows[2].removed == [0] and rows[1].row.lang == "en" and rows[2].row.lang is None
