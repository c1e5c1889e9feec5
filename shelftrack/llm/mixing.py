"""Mixing sources to target weights, with documents as soft members of domains.

A table of labelled documents teaches a classifier of hashed words (naive Bayes);
every document gets posteriors of the domains from it. Document rates are then
fitted so that the expected tokens of each domain meet their targets: least
squares over nonnegative rates, by projected gradients. Residuals are weighed by
one over the domain's tokens and gradients by one over the document's, which
makes steps of length one safe. A step needs the domains' sums over all documents
only, a few numbers; a document's rate is an expression of its posteriors and the
residuals of the steps since rates were last written, which they are every few
steps. Everything is built-in functions and aggregates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.operators.ranking import per_source_cap

TRAIN_ROWS = 2000  # labelled documents per domain that the classifier sees at most
SLOTS = 16384
EVIDENCE = 100.0  # words; a longer text counts no more than so many
MAX_STEPS = 60
TOLERANCE = 1e-4
STEPS_AT_ONCE = 8  # after so many steps rates are written, so that their expression stays short

_SPACE = r"[\x20\t-\r]+"


def words(text: str | Column) -> Column:
    """Runs that are no ASCII white space; none of a null."""
    return F.array_remove(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _SPACE), "")


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


def _total(weights: Column) -> Column:
    return F.aggregate("mix_slots", F.lit(0.0), lambda done, slot: done + F.get(weights, slot))


class Classifier:
    """Prior and per-slot log weights of each domain, relative to the first."""

    def __init__(self, domains: list[str], priors: list[float], tables: list[list[float]]):
        self.domains, self.priors, self.tables = domains, priors, tables

    def posteriors(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``mix_tokens`` and an array ``mix_posteriors`` in the order of the domains."""
        rows = docs.withColumn("mix_slots", F.transform(words(text), _slot)).withColumn("mix_tokens", F.size("mix_slots").cast("long"))
        damp = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest("mix_tokens", F.lit(1)))
        odds = []
        for prior, table in zip(self.priors, self.tables, strict=True):
            # One literal array, folded before the run.
            weights = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")
            odds.append(_total(weights) * damp + F.lit(prior) if any(table) else F.lit(prior))
        rows = rows.withColumn("mix_odds", F.array(*odds))
        powers = F.transform("mix_odds", lambda x: F.exp(x - F.array_max("mix_odds")))
        rows = rows.withColumn("mix_powers", powers)
        total = F.aggregate("mix_powers", F.lit(0.0), lambda done, x: done + x)
        shares = F.transform("mix_powers", lambda x: x / total)
        return rows.withColumn("mix_posteriors", shares).drop("mix_slots", "mix_odds", "mix_powers")


def train(docs: DataFrame, labels: DataFrame, domains: list[str], rows: int = TRAIN_ROWS) -> Classifier:
    """Fit on at most ``rows`` documents per domain of ``labels`` (``doc_id``, ``domain``)."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    total = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    picked = per_source_cap(known, rows, [F.xxhash64("doc_id"), F.col("doc_id")], "domain").select("doc_id", "domain")
    # At most rows times domains entries are broadcast.
    taught = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    slots = taught.select("domain", F.explode(words("text")).alias("word")).select("domain", _slot(F.col("word")).alias("slot"))
    counts = {name: [1.0] * SLOTS for name in domains}
    for r in slots.groupBy("domain", "slot").count().collect():
        counts[r.domain][r.slot] += r["count"]
    logs = {name: [math.log(x / sum(row)) for x in row] for name, row in counts.items()}
    all_labels = sum(total.values())
    base = next((name for name in domains if total.get(name)), domains[0])
    prior = {name: math.log(total[name] / all_labels) if total.get(name) else -700.0 for name in domains}
    if not all_labels:
        prior = dict.fromkeys(domains, 0.0)
    tables = [[a - b for a, b in zip(logs[name], logs[base], strict=True)] if total.get(name) else [0.0] * SLOTS for name in domains]
    return Classifier(domains, [prior[name] - prior[base] for name in domains], tables)


def _sums(members: DataFrame, weight: Column, n: int) -> list[float]:
    cells = [F.sum(weight * F.col("mix_tokens") * F.col("mix_posteriors")[i]).alias(f"s{i}") for i in range(n)]
    return [x or 0.0 for x in members.agg(*cells).first()]


def _next(rate: Column, step: list[float]) -> Column:
    slope = sum((F.col("mix_posteriors")[i] * F.lit(x) for i, x in enumerate(step)), F.lit(0.0))
    return F.greatest(F.lit(0.0), rate - slope)


def rated(members: DataFrame, targets: list[float]) -> tuple[DataFrame, list[list[float]]]:
    """Rows of ``mix_tokens`` and ``mix_posteriors`` with their ``mix_rate``, and the steps it is made of.

    Rates start at one. A domain that no document belongs to cannot be met and
    is left out.
    """
    n = len(targets)
    present = reached = _sums(members, F.lit(1.0), n)
    rate, steps = F.lit(1.0), []
    for _ in range(MAX_STEPS):
        steps.append([(got - want) / have if have > 0 else 0.0 for got, want, have in zip(reached, targets, present, strict=True)])
        rate = _next(rate, steps[-1])
        before, reached = reached, _sums(members, rate, n)
        if max(abs(a - b) for a, b in zip(before, reached, strict=True)) <= TOLERANCE * max(sum(targets), 1.0):
            break
        if len(steps) % STEPS_AT_ONCE == 0:
            members, rate = c.cut(members.withColumn("mix_rate", rate)), F.col("mix_rate")
    return members.withColumn("mix_rate", rate), steps


def fit_rates(members: DataFrame, targets: list[float]) -> tuple[Column, list[list[float]]]:
    """The rate of a row of ``mix_tokens`` and ``mix_posteriors`` as a column, for rows other than ``members`` too, and its steps."""
    steps = rated(members, targets)[1]
    rate = F.lit(1.0)
    for step in steps:
        rate = _next(rate, step)
    return rate, steps


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], budget: float | None = None, keeping: str | None = None) -> DataFrame:
    """Tokens, memberships, rate and copies of each document of ``doc_id`` and ``text``.

    ``weights`` are the shares of the domains (any positive numbers); domains come
    in the order of their names. ``budget`` is the number of tokens to reach, by
    default all there are; ``keeping`` names a domain instead whose expected tokens are
    to stay as they are. The result has ``doc_id``, ``text_hash`` (``xxhash64`` of
    the text, which tells rows of one id apart), ``mix_tokens``,
    ``mix_posteriors``, ``mix_rate`` and ``mix_copies``: the rate rounded down or
    up, with the fraction as the probability of up, by a hash of the id.

    A null or empty text has no tokens and the posteriors of the labels' shares.
    Labels of unknown domains and null ids teach nothing; of several labels for
    an id the first by name counts; with no labels all domains are equally
    likely. Ids may repeat or be null: each row is rated by its own text and gives
    one row. Other columns are ignored.
    """
    domains = sorted(weights)
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    members = train(docs, labels, domains).posteriors(docs)
    members = c.cut(members.select("doc_id", F.xxhash64("text").alias("text_hash"), "mix_tokens", "mix_posteriors"))
    present = _sums(members, F.lit(1.0), len(domains))
    share = [weights[name] / sum(weights.values()) for name in domains]
    if keeping is not None:
        at = domains.index(keeping)
        budget = present[at] / share[at]
    elif budget is None:
        budget = sum(present)
    members, _ = rated(members, [s * budget for s in share])
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # A rate rounds up if its fraction is over the chance.
    return members.withColumn("mix_copies", F.ceil(F.col("mix_rate") - chance).cast("long"))


def label_domains(labels: DataFrame) -> DataFrame:
    """Domains of a table of ``doc_id``, ``quality`` and ``toxic`` marks: toxic, else poor or good."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))
