"""Token numbers against the model's own library, and exact round trips."""

import os
import random

import pytest

from shelftrack.llm import sentencepiece_fst as fst
from shelftrack.llm.queries import TOKENIZER

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")


@pytest.fixture(scope="module")
def machine():
    return fst.load(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)


def texts(machine):
    rng = random.Random(3)
    out = ["", " ", "  ", "a", " a b  c   d     e", " " * 37 + "x", "\n\n\n", "a\0b", "▁▁x▁", "中文字符 测试", "é" * 50, "a" * 900]
    out += ["🙂🙂 x🙂", "the the  the\t\tthe", "　 　", " 中", "   中  中", "x" * 3000, "<s> <unk> </s> <0x41>", "1234567890 3.14159", " " * 3000]
    out += ["    if (a == b) {\n        return;\n    }", "don't http://www.example.com/foo?bar=baz&x=1", "é ‍ ﻿ \U0010ffff"]
    pieces = [p.replace("▁", " ") for p in machine.pieces[259:]]
    out += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    return out + ["".join(rng.choice("abcdehinorst  .\n") for _ in range(rng.randint(1, 60))) for _ in range(1500)]


def test_numbers(machine, library):
    encoder, decoder = fst.Encoder(machine), fst.Decoder(machine)
    given = texts(machine)
    for part in (given, given[::-1], given[:5]):
        numbers, bounds = encoder.encode(part)
        assert [numbers[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == library.encode(part)
        assert decoder.decode(numbers, bounds) == [t.replace("▁", " ") for t in part]


def test_table(spark, machine, library):
    rows = [(1, "Hello  wörld"), (2, None), (3, ""), (3, ""), (None, "x\ny"), (4, "long words " * 30000), (5, "z" * 20000)]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, tokens int, n_tokens string")
    encoded = fst.encode(df, TOKENIZER)
    got = encoded.collect()
    assert [r.tokens for r in got] == library.encode([t or "" for _, t in rows])
    assert all(r.round_trip and r.n_tokens == len(r.tokens) for r in got)
    assert [r.text for r in fst.decode(encoded, TOKENIZER).collect()] == [t or "" for _, t in rows]
    assert fst.encode(df.limit(0), TOKENIZER).count() == 0
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id long, tokens array<int>")
    assert [r.text for r in fst.decode(empty, TOKENIZER).collect()] == ["", ""]
