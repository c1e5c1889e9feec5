"""Repaired conversations against every edit there is, and the whole operator against a plain version."""

import hashlib
import heapq
import itertools
import os
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from shelftrack.llm import conversations as cv

TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
GRAMMAR = re.compile("(s?(ua)+)?")


def every_edit(signature):
    """Least cost and first audit of all edits with up to two rows inserted at a place."""
    gaps = [("", 0), ("u", 1), ("a", 1), ("ua", 2), ("au", 2)]
    choices = [gaps]
    for letter in signature:
        extra, role = 3 * letter.isupper(), letter.lower()
        options = [("", "D", 4)]
        if role != "x":
            options += [("u", "R", 3 + extra), ("a", "R", 3 + extra), (role, "K", extra)]
        choices += [options, gaps]
    best = None
    for picked in itertools.product(*choices):
        roles = "".join(p[0] for p in picked)
        if GRAMMAR.fullmatch(roles):
            audit = "".join("I" * p[1] if len(p) == 2 else p[1] for p in picked)
            cost = sum(3 * p[1] if len(p) == 2 else p[2] for p in picked)
            best = min(best or (cost, audit), (cost, audit))
    return best


def shortest(signature):
    """The same by uniform-cost search, for longer ones; also the roles that result."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        state = "s" if roles == "s" else "" if not roles else roles[-1]
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(signature) and GRAMMAR.fullmatch(roles):
            return cost, audit, roles
        role = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", i, roles + role))
        if i < len(signature):
            letter = signature[i]
            extra = 3 * letter.isupper()
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles))
            if letter != "x":
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, roles + role))
                if letter.lower() == role or (letter.lower() == "s" and not roles):
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, roles + letter.lower()))
    return None


@pytest.mark.parametrize("seed", range(25))
def test_every_edit(seed):
    rng = np.random.default_rng(seed)
    signature = "".join(rng.choice(list("suaoSUAOx"), rng.integers(0, 4)))
    assert list(cv.cheapest([signature])) == [(signature, *every_edit(signature))]


def test_many_signatures():
    rng = np.random.default_rng(1)
    signatures = {"".join(rng.choice(list("suaoSUAOx"), rng.integers(0, 14))) for _ in range(3000)}
    for order in (sorted(signatures, key=lambda s: s[::-1]), list(signatures)):
        for signature, cost, audit in cv.cheapest(order):
            assert (cost, audit) == shortest(signature)[:2], signature


def test_shared_ends_are_met_once(monkeypatch):
    made = []
    plain = cv._node
    monkeypatch.setattr(cv, "_node", lambda letter, rest: made.append(letter) or plain(letter, rest))
    signatures = ["".join(s) for s in itertools.product("suax", repeat=5)]
    list(cv.cheapest(sorted(signatures, key=lambda s: s[::-1])))
    assert len(made) == sum(4**n for n in range(1, 6))


def plain_repair(rows):
    """Rows of conv_id, turn, role, text, after the contract's damage."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        known = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{known[0]}:{known[1]}".encode()) % 20
        role, text = known[2:]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        times = 0 if kind == 0 else 2 if kind == 3 else 1
        conversations[conv] += [(turn, role, text)] * times
    out = []
    for conv, found in conversations.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}\0{r[2]}".encode()).hexdigest()))
        turns = {t for t, _, _ in found if t is not None}
        seen, faults, signature = set(), [], ""
        for _, role, text in found:
            words = text.strip(" \t\n\x0b\f\r")
            fault = "b" if not words else "d" if (role, text) in seen else "k" if words[-1] in ".!?" else "t"
            seen.add((role, text))
            faults.append(fault)
            letter = role[:1] if role[:1] and role[:1] in "sua" else "o"
            signature += "x" if fault in "bd" else letter.upper() if fault == "t" else letter
        initials = [role[:1] for _, role, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, roles = shortest(signature)
        lines, rest, new = [], iter(found), iter(roles)
        for edit in audit:
            if edit == "I":
                lines.append({"u": "user:", "a": "assistant:"}[next(new)])
                continue
            _, role, text = next(rest)
            if edit != "D":
                short = next(new)
                lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[short]}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, "\n".join(lines)))
    return out


def check(spark, rows, rows_of=None):
    schema = "conv_id long, turn long, role string, text string, head string, kind int, n int"
    df = rows_of if rows_of is not None else spark.createDataFrame([(*r, "h", 7, 9) for r in rows], schema)
    wanted = sorted(plain_repair(rows), key=repr)
    assert sorted(map(tuple, cv.repair(cv.damage(df), "times").collect()), key=repr) == wanted
    hashed = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest()) for r in wanted]
    assert sorted(map(tuple, cv.repair(cv.damage(df), "times", digest=True).collect()), key=repr) == hashed


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    roles, words = ["user", "assistant", "system", "tool", "", None, "u"], ["yes.", "no", " \t", "", None, "what?\n ", "é!", "x" * 2000]
    rows = []
    for conv in [*range(40), None]:
        for turn in rng.integers(0, 9, rng.integers(0, 12)).tolist():
            turn = None if rng.random() < 0.15 else turn
            rows.append((conv, turn, roles[rng.integers(len(roles))], words[rng.integers(len(words))]))
    check(spark, rows)


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(cv, "_CHUNK", 16)
    rng = np.random.default_rng(4)
    rows = [(5, int(t), ["user", "assistant", "system"][rng.integers(3)], f"line {rng.integers(900)}{'.' if rng.random() < 0.8 else ''}") for t in rng.permutation(600)]
    rows += [(5, None, "user", f"no turn {i}.") for i in range(30)] + [(6, 3, "user", "alone.")] * 40
    check(spark, rows)


@pytest.mark.skipif(not TABLES.exists(), reason="no tables")
def test_given_table(spark):
    df = spark.read.parquet(str(TABLES / "conversations.parquet"))
    check(spark, [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()], df)


def test_plain_rows_and_no_rows(spark):
    df = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Hello.")], "conv_id string, turn int, role string, text string")
    assert [tuple(r) for r in cv.repair(df).collect()] == [("a", 0, 0, 0, 0, 0, 0, "KK", "user:Hi.\nassistant:Hello.")]
    assert cv.repair(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        cv.repair(df.withColumn("conv_id", df["turn"].cast("double")))
