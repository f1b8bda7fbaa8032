"""Mixing to target weights with soft domains, in DataFrame operations only."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.store import saved

# The classifier learns from so many labelled documents at most, taken in order of the hash of their ids.
SAMPLE = 16384
# Buckets of the hashed words, added count of each, and the words that a text's evidence counts as at most.
BUCKETS, SMOOTH, EVIDENCE = 8192, 0.5, 8
# Projected gradient ends at this relative miss, or where a step takes less than this share off the sum of squares.
CLOSE, GAIN = 1e-6, 1e-4
# Lengths of the tried steps by the inverse Gram matrix, beside the plain gradient's.
LENGTHS = (1.0, 1 / 4, 1 / 16)


def buckets(text: Column) -> Column:
    """The bucket of every word between white space."""
    words = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")), r"\s+")
    return F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(BUCKETS)))


@dataclass
class Classifier:
    """Naive Bayes over hashed words: domains in order, log prior odds and log odds of words against the first."""

    domains: list[str]
    prior: list[float]
    odds: np.ndarray

    def posteriors(self, hashed: Column) -> list[Column]:
        """Posterior of each domain. All words count, with a joint weight of ``EVIDENCE`` words at most."""
        scale = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.size(hashed))
        margins = [F.lit(0.0)]
        for prior, odds in zip(self.prior[1:], self.odds[1:]):
            table = F.split(F.lit(",".join(f"{x:.6g}" for x in odds)), ",").cast("array<double>")  # folded to one constant
            margins.append(F.lit(prior) + scale * F.aggregate(hashed, F.lit(0.0), lambda a, i: a + F.get(table, i)))
        top = F.greatest(*margins) if len(margins) > 1 else margins[0]
        each = [F.exp(m - top) for m in margins]
        return [e / sum(each[1:], each[0]) for e in each]


def learn(docs: DataFrame, labelled: DataFrame, doc: str, text: str, label: str, domains: list[str]) -> Classifier:
    """Counts words per domain over a bounded sample of the labelled documents. An id with several labels has
    the greatest; null labels, and labels that are no domain, are left out."""
    known = (labelled.where(F.col(label).cast("string").isin(domains)).groupBy(F.col(doc).alias("_id")).agg(F.max(F.col(label).cast("string")).alias("_label"))
             .where(F.col("_id").isNotNull()).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE))
    rows = docs.select(F.col(doc).alias("_id"), F.col(text).cast("string").alias("_text")).join(F.broadcast(known), "_id").select("_label", buckets(F.col("_text")).alias("_b"))
    counted = rows.select("_label", F.explode("_b").alias("bucket")).groupBy("_label", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # domains x BUCKETS at most
    counts = np.full((len(domains), BUCKETS), SMOOTH)
    for r in counted:
        counts[domains.index(r["_label"]), r["bucket"]] += r["n"]
    times = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    prior = np.log([times.get(d, 0) + 1.0 for d in domains])
    return Classifier(domains, (prior - prior[0]).tolist(), logs - logs[0])


def totals(mixed: DataFrame, rates: list[Column], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of the rates, in one pass: the expected domain totals, and the Gram matrix of the documents above 0."""
    p = [F.get("posteriors", F.lit(i)) for i in range(k)]
    moved = mixed.select("n_tokens", "posteriors", *[r.alias(f"r{c}") for c, r in enumerate(rates)])
    sums = moved.agg(*[F.sum(F.col("n_tokens") * F.col(f"r{c}") * p[i]).alias(f"t{c}_{i}") for c in range(len(rates)) for i in range(k)],
                     *[F.sum(F.when(F.col(f"r{c}") > 0, F.col("n_tokens") * p[i] * p[j])).alias(f"m{c}_{i}_{j}") for c in range(len(rates)) for i in range(k) for j in range(i, k)]).first()
    return [(np.array([sums[f"t{c}_{i}"] or 0.0 for i in range(k)]),
             np.array([[sums[f"m{c}_{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])) for c in range(len(rates))]


def fit_rates(mixed: DataFrame, targets: np.ndarray) -> tuple[list[list[float]], np.ndarray]:
    """Steps of projected gradient that bring the expected domain totals to the targets, and what they still miss.

    mixed has n_tokens and posteriors. The unknowns are one rate for every document, at least 0, from 1 on;
    minimised is the sum over domains of (expected total - target)^2 / total now. A step needs a few numbers
    from all documents, and moves a document's rate by a weighting of its own posteriors; so the steps so far,
    and not the rates, are what is kept between passes. Beside the plain step, which never fails, each pass
    tries steps by the inverse Gram matrix of the documents above 0, which alone are quick where domains are
    hard to tell apart, and the best is taken.
    """
    k = len(targets)
    (now, gram), = totals(mixed, [F.lit(1.0)], k)
    if not now.sum():
        return [], np.zeros(k)
    scale = 1 / np.maximum(now, 1e-9 * now.sum())
    pace = 1 / np.linalg.eigvalsh(gram * np.sqrt(np.outer(scale, scale))).max()
    steps: list[list[float]] = []
    while np.abs(now - targets).max() > CLOSE * targets.sum():
        newton = np.linalg.pinv(gram, rcond=1e-9, hermitian=True) @ (now - targets)
        tried = [x.tolist() for x in (pace * scale * (now - targets), *(length * newton for length in LENGTHS))]
        each = totals(mixed.withColumn("rate", rate(steps)), [F.greatest(F.lit(0.0), F.col("rate") - dot(F.array(*map(F.lit, x)), k)) for x in tried], k)
        squares = [float((scale * (t - targets) ** 2).sum()) for t, _ in each]
        best = int(np.argmin(squares))
        if not squares[best] < (1 - GAIN) * float((scale * (now - targets) ** 2).sum()):
            break
        steps.append(tried[best])
        now, gram = each[best]
    return steps, now - targets


def dot(step: Column, k: int) -> Column:
    """A step's weighting of a document's posteriors."""
    return sum((F.get(step, F.lit(i)) * F.get("posteriors", F.lit(i)) for i in range(1, k)), F.get(step, F.lit(0)) * F.get("posteriors", F.lit(0)))


def rate(steps: list[list[float]]) -> Column:
    """A document's rate after the steps, from its posteriors."""
    if not steps:
        return F.lit(1.0)
    table = F.split(F.lit(";".join(",".join(f"{x:.17g}" for x in s) for s in steps)), ";")
    table = F.transform(table, lambda s: F.split(s, ",").cast("array<double>"))
    return F.aggregate(table, F.lit(1.0), lambda r, s: F.greatest(F.lit(0.0), r - dot(s, len(steps[0]))))


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], doc: str = "doc_id", text: str = "text", label: str = "domain",
        keep: tuple[str, ...] = ()) -> DataFrame:
    """doc, the columns in ``keep``, n_tokens, posteriors (in the targets' order), rate, copies and missed of every row.

    The targets' weights are shares of all tokens (words between white space), so the mixture is as large as
    the input. ``copies`` is the rate rounded up or down by the hash of the id, so that its expectation is the
    rate: take the row so many times. ``missed`` is what the domains' expected shares miss their targets by, the
    same in every row; more than ``CLOSE``, where no rates reach the targets, is also warned of. Null, empty and blank texts have one empty word;
    rows that repeat are mixed one by one; an empty table stays empty. Without any labelled row all domains are
    equally likely.
    """
    domains = list(targets)
    model = learn(docs, labelled, doc, text, label, domains)
    hashed = docs.select(F.col(doc).alias("doc"), *keep, buckets(F.col(text).cast("string")).alias("_b"))
    mixed = saved(hashed.select("doc", *keep, F.size("_b").cast("long").alias("n_tokens"), F.array(*model.posteriors(F.col("_b"))).alias("posteriors")), "posteriors")
    total = mixed.agg(F.sum("n_tokens")).first()[0] or 0
    weights = np.array([targets[d] for d in domains], float)
    steps, miss = fit_rates(mixed, weights / weights.sum() * total)
    missed = (miss / max(total, 1)).tolist()
    if max(map(abs, missed)) > CLOSE:
        warnings.warn(f"the mixture misses its targets: {dict(zip(domains, missed))}")
    drawn = F.pmod(F.xxhash64(F.lit("mix"), "doc"), F.lit(1 << 32)) / float(1 << 32)
    return mixed.withColumn("rate", rate(steps)).withColumn("copies", F.floor(F.col("rate") + drawn).cast("int")).withColumn("missed", F.array(*map(F.lit, missed)))
