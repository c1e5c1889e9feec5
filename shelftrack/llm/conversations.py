"""Repair of damaged conversations at the least cost, once for all that share an ending.

A conversation is a signature: a letter a row, of its role and fault. What a rest of
a conversation costs depends on its signature and on the state of the grammar
``(s?(ua)+)?`` alone, so signatures are kept as an automaton that shares suffixes: a
node is a letter in front of the node of the rest. Distinct signatures of all
conversations, dealt by ranges and sorted from their ends, walk that automaton in
depth-first order; a node gets the cost to go and the best first edit for each state
when it is entered, and the path from the node to the end holds all it needs. In every
state there is one role to insert or change to, so of equally cheap edits the least first letter
decides, and best edits follow from node to node. Texts are read only to find the
faults and, sorted, to write the repaired conversation.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.operators.joins import skew_join

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3  # costs; CUT_OFF is added for each truncated row that stays
_SPACE = " \t\n\x0b\f\r"
_CHUNK = 4096  # turns whose rows are put in order together
_START, _SYSTEM, _USER, _ASSISTANT = range(4)  # states: nothing yet, or the last row's role
_NEXT = (_USER, _USER, _ASSISTANT, _USER)  # the state after a user or assistant row that fits
_NEVER = 1 << 60


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id``, ``turn``, ``role`` and ``text`` after damage, with ``times``: 0 for a dropped row, 2 for a repeated one.

    The CRC-32 of ``conv_id:turn`` modulo 20 decides: 0 drops the row, 1 empties its text, 2
    removes ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it a user's. A null counts as one space.
    """
    known = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    kind = F.pmod(F.crc32(F.concat(known["conv_id"], F.lit(":"), known["turn"])), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(known["text"], ".!?", "")).otherwise(known["text"])
    role = F.when(kind == 4, "user").otherwise(known["role"])
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), times.alias("times"))


# Cost to go.


def _node(letter: str, rest: tuple) -> tuple:
    """Costs and best first edits of the four states at a row of ``letter``, from those behind it."""
    after = rest[0]
    extra, role = CUT_OFF if letter.isupper() else 0, letter.lower()
    costs, edits = [], []
    for state in range(4):
        best, edit = DELETE + after[state], "D"
        if role != "x":
            to = _NEXT[state]
            fits = to if role == ("a" if state == _USER else "u") else _SYSTEM if role == "s" and state == _START else None
            if fits is not None and KEEP + extra + after[fits] < best:
                best, edit = KEEP + extra + after[fits], "K"
            if REROLE + extra + after[to] < best:
                best, edit = REROLE + extra + after[to], "R"
        costs.append(best)
        edits.append(edit)
    return _inserted(costs, edits)


def _inserted(costs: list[int], edits: list[str]) -> tuple:
    """The same where a row may be inserted first; I goes before K and R, D before I."""
    out = list(costs), list(edits)
    for state in (_USER, _ASSISTANT, _START, _SYSTEM):
        # Two rows inserted one behind the other lead back to the same state, so these two look at each other's own costs.
        to = costs if state in (_USER, _ASSISTANT) else out[0]
        cost = INSERT + to[_NEXT[state]]
        if cost < costs[state] or (cost == costs[state] and edits[state] > "I"):
            out[0][state], out[1][state] = cost, "I"
    return out


_END = _inserted([0, _NEVER, _NEVER, 0], ["", "Z", "Z", ""])


def cheapest(signatures):
    """Signature, cost and edits of each signature; fast if they are sorted by their reversed letters."""
    path, before = [_END], ""
    for signature in signatures:
        letters = signature[::-1]
        same = 0
        for p, q in zip(before, letters, strict=False):
            if p != q:
                break
            same += 1
        del path[same + 1 :]
        for letter in letters[same:]:
            path.append(_node(letter, path[-1]))
        before = letters
        depth, state, edits = len(letters), _START, []
        while edit := path[depth][1][state]:
            edits.append(edit)
            if edit in "KR":
                depth -= 1
                state = _SYSTEM if edit == "K" and letters[depth] in "sS" else _NEXT[state]
            elif edit == "D":
                depth -= 1
            else:
                state = _NEXT[state]
        yield signature, path[-1][0][_START], "".join(edits)


def _solve(batches):
    for batch in batches:
        found = list(cheapest(batch.column("signature").to_pylist()))
        columns = zip(*found, strict=True) if found else ([], [], [])
        kinds = (pa.string(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], ["signature", "cost", "audit"])


# Faults.


def _ordered(turn: Column) -> list[Column]:
    """Sorts by turn, missing ones first."""
    return [turn.isNotNull().alias("has"), F.coalesce(turn, F.lit(0)).alias("at")]


def _letters(rows: DataFrame) -> DataFrame:
    """Of every conversation: ``initials``, ``faults`` and ``signature``, a letter a row in order, and ``gaps``."""
    trimmed = F.rtrim(F.col("text"), F.lit(_SPACE))
    fault = F.when(trimmed == "", "b").when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), "k").otherwise("t")
    initial = F.substring("role", 1, 1)
    light = rows.select(
        "conv_id", "turn", "digest", *_ordered(F.col("turn")), fault.alias("fault"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"), "times",
    )
    # Equal rows become one before they are shuffled.
    kinds = light.groupBy("conv_id", "turn", "has", "at", "digest", "fault", "initial").agg(F.sum("times").alias("n"))
    there = F.when(F.col("times") > 0, F.struct("has", "at"))
    first = light.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same")).agg(F.min(there).alias("earliest"))
    met = kinds.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")))
    n, fault, initial = F.col("n").cast("int"), F.col("fault"), F.col("initial")
    new = F.col("earliest") == F.struct("has", "at")
    faults = F.when(fault == "b", F.repeat(F.lit("b"), n)).when(new, F.concat(fault, F.repeat(F.lit("d"), n - 1)))
    own = F.when(fault == "t", F.upper(initial)).otherwise(initial)
    signature = F.when((fault != "b") & new, F.concat(own, F.repeat(F.lit("x"), n - 1))).otherwise(F.repeat(F.lit("x"), n))
    entry = F.struct(
        "has", "at", "digest", F.repeat(initial, n).alias("initials"),
        F.coalesce(faults, F.repeat(F.lit("d"), n)).alias("faults"), signature.alias("signature"),
    )
    turn = F.when(n > 0, F.col("turn"))
    # Rows without a turn are in order of their digests, so these may be cut there.
    chunk = [F.floor(F.col("at") / _CHUNK).alias("chunk"), F.when(F.col("has"), "").otherwise(F.substring("digest", 1, 2)).alias("part")]
    lists = [F.sort_array(F.collect_list(F.when(n > 0, entry))).alias("rows"), F.size(F.collect_set(turn)).alias("turns")]
    chunks = met.groupBy("conv_id", "has", *chunk).agg(*lists, F.min(turn).alias("low"), F.max(turn).alias("high"))
    names = ("initials", "faults", "signature")
    joined = [F.array_join(f"rows.{k}", "").alias(k) for k in names]
    chunks = chunks.select("conv_id", F.struct("has", "chunk", "part", *joined).alias("entry"), "turns", "low", "high")
    whole = F.sort_array(F.collect_list("entry"))
    found = chunks.groupBy("conv_id").agg(whole.alias("rows"), F.sum("turns").alias("turns"), F.min("low").alias("low"), F.max("high").alias("high"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return found.select("conv_id", gaps.alias("gaps"), *(F.array_join(f"rows.{k}", "").alias(k) for k in names))


def _count(letter: str) -> Column:
    return (F.length("faults") - F.length(F.translate("faults", letter, ""))).cast("long")


# Repaired conversations.

_STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _write(conv: pa.DataType, digest: bool):
    last = "repaired_sha256" if digest else "repaired"

    class Repair:
        """The conversation that is being written."""

        def __init__(self, row: dict):
            self.row, self.at, self.state, self.empty = row, 0, _START, True
            self.lines, self.hash = [], hashlib.sha256()

        def add(self, line: str) -> None:
            if digest:
                self.hash.update((line if self.empty else "\n" + line).encode())
            else:
                self.lines.append(line)
            self.empty = False

        def insert(self) -> None:
            """Rows that are inserted here."""
            audit = self.row["audit"]
            while self.at < len(audit) and audit[self.at] == "I":
                self.at, self.state = self.at + 1, _NEXT[self.state]
                self.add("user:" if self.state == _USER else "assistant:")

        def take(self, role: str, text: str) -> None:
            self.insert()
            edit, self.at = self.row["audit"][self.at], self.at + 1
            if edit == "D":
                return
            if edit == "K" and role[0] == "s":
                self.state = _SYSTEM
            else:
                self.state = _NEXT[self.state]
            if edit == "R":
                role = "user" if self.state == _USER else "assistant"
            self.add(f"{role}:{text}")

        def done(self) -> dict:
            self.insert()
            return self.row | {last: self.hash.hexdigest() if digest else "\n".join(self.lines)}

    schema = pa.schema([("conv_id", conv), *((k, pa.int64()) for k in _STATS), ("audit", pa.string()), (last, pa.string())])

    def run(batches):
        current = None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["head"] is not None:
                    if current:
                        found.append(current.done())
                    current = Repair({"conv_id": row["conv_id"], **row["head"]})
                else:
                    for _ in range(row["times"]):
                        current.take(row["role"], row["text"])
            yield pa.RecordBatch.from_pylist(found, schema=schema)
        if current:
            yield pa.RecordBatch.from_pylist([current.done()], schema=schema)

    return run


def repair(rows: DataFrame, times: str | None = None, digest: bool = False) -> DataFrame:
    """Every conversation of ``conv_id``, ``turn``, ``role`` and ``text`` with its faults and cheapest repair.

    ``times`` names a column that tells how often a row stands there, 0 for a row that is
    gone; by default each stands once. Rows are taken by turn, missing ones first,
    those of one turn by a digest of role and text. A row's first fault counts: ``blank``
    (only white space), ``duplicate`` (role and text seen earlier), ``truncated`` (ends
    with none of ``.!?``). ``gaps`` counts turns that lack, ``illegal`` neighbours whose role initials
    are not su, ua or au. Edits are K (keep, free), R (make it a user's or an assistant's, 3), D
    (delete, 4; a must for blank and duplicate rows) and I (insert an empty user's
    or assistant's row, 3); a truncated row that stays adds 3. ``audit`` holds the cheapest edits
    that lead to role initials ``(s?(ua)+)?``, of several the first by ASCII,
    ``cost`` their cost, ``repaired`` the lines ``role:text``; with ``digest`` ``repaired_sha256`` is
    the hash of it.

    A null role or text counts as one space; a null ``conv_id`` is a conversation of its own. A conversation
    without rows gets zeros and empty texts; no rows give no conversations. Rows that are
    repeated are duplicates; other columns are ignored. A conversation's signature and audit,
    a byte or two a row, are one value each; its texts are sorted outside the heap and written
    one by one.
    """
    spark = rows.sparkSession
    c.ship(spark)
    text = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text")}
    often = F.col(times).cast("long") if times else F.lit(1).cast("long")
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *(v.alias(k) for k, v in text.items()), often.alias("times"))
    rows = rows.withColumn("digest", F.md5(F.concat("role", F.lit("\0"), "text")))
    found = c.cut(_letters(rows))
    signatures = found.select("signature").distinct().withColumn("letters", F.reverse("signature"))
    signatures = signatures.repartitionByRange("letters").sortWithinPartitions("letters").select("signature")
    solved = signatures.mapInArrow(_solve, "signature string, cost long, audit string")
    heads = skew_join(found, solved, ["signature"])
    legal = F.regexp_count("initials", F.lit("(?=su|ua|au)."))
    illegal = (F.greatest(F.length("initials") - 1, F.lit(0)) - legal).cast("long")
    stats = ["gaps", _count("b").alias("blank"), _count("d").alias("duplicate"), _count("t").alias("truncated"), illegal.alias("illegal")]
    heads = heads.select("conv_id", F.struct(*stats, "cost", "audit").alias("head"))
    body = rows.filter("times > 0").select("conv_id", F.lit(1).alias("kind"), *_ordered(F.col("turn")), "digest", "role", "text", "times")
    both = heads.withColumn("kind", F.lit(0)).unionByName(body, allowMissingColumns=True)
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "has", "at", "digest")
    given = dealt.select("conv_id", "head", "role", "text", "times")
    conv = pa.int64() if dict(rows.dtypes)["conv_id"] == "bigint" else pa.string() if dict(rows.dtypes)["conv_id"] == "string" else None
    if conv is None:
        raise ValueError("conv_id must be a long or a string")
    kinds = f"conv_id {dict(rows.dtypes)['conv_id']}, " + ", ".join(f"{k} long" for k in _STATS)
    last = "repaired_sha256" if digest else "repaired"
    return given.mapInArrow(_write(conv, digest), f"{kinds}, audit string, {last} string")
