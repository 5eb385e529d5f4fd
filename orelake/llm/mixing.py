"""Mixing sources to target weights by soft membership, in DataFrame and SQL functions only.

A source here is a domain of the labelled table.  No document belongs to one
for certain: a classifier learned from labelled rows gives each document a
posterior over the domains, and its words count for every domain in that
proportion.  Nonnegative rates r (expected copies of a document) are then fitted
so that the expected words of each domain meet the target shares:

    min  1/2 sum_k (m_k(r) - t_k)^2 / s_k  +  ridge/2 sum_d w_d (r_d - 1)^2,   r >= 0

with w_d the document's share of all words, m_k = sum_d w_d r_d p_dk, s_k the
domain's share at r = 1.  Projected gradient in the metric w takes the step
r <- max(0, r - step * (sum_k p_dk (m_k - t_k) / s_k + ridge (r - 1))); its
Lipschitz bound is 1 + ridge.  A step needs only the domain residuals, so an
iteration is one aggregate over a narrow table and the rate of a document is a
function of its posterior: nothing per document reaches the driver, and rates
need no join.  ``copies`` is the rate rounded up or down by a hash of the id.

The classifier is a Bernoulli naive Bayes over figures of the text and the
presence of strings, learned from at most ``TRAIN_ROWS`` labelled rows, those
with the least hash of their id.  Null texts are empty.  Labels of a repeated id
count once (toxic over poor over clean); a null id is never labelled.  Without
labelled rows all posteriors are equal.  An empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are carried along untouched.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.rows import settled
from orelake.storage import write_out

DOMAINS = ("clean", "poor", "toxic")
# Shares of the mixed corpus' words.
TARGETS = (0.92, 0.06, 0.02)
# Words of the mixed corpus per word of the input.
SIZE = 1.0
TRAIN_ROWS = 6000
STRINGS = 24
RIDGE = 1e-3
# Steps end when every domain is this near to its target share (of the mixed words), or nothing moves, or at the last.
RESIDUAL = 1e-3
ITERATIONS = 30
TOLERANCE = 1e-6
# The domain whose certain documents have a rate of 1 at least: the mixed corpus grows as far as that needs.
WHOLE = 0
# Sizes tried for that; what is then missing is logged.
SIZES = 4
SEED = 42

SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Classifier:
    """Strings looked for, log prior per domain, log odds of each feature and their sum at zero."""

    strings: tuple[str, ...]
    prior: tuple[float, ...]
    present: tuple[tuple[float, ...], ...]
    absent: tuple[tuple[float, ...], ...]


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): number of the domain, once per labelled id."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    return labels.filter("doc_id is not null").select("doc_id", domain.alias("domain")).groupBy("doc_id").agg(F.max("domain").alias("domain"))


def _figures(docs: DataFrame, *carried: str) -> DataFrame:
    """Word count and yes/no figures of the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(*carried, text.alias("_text"), F.trim(F.regexp_replace(text, SPACE, " ")).alias("_plain"))
    df = df.select(*carried, "_text", F.expr("if(_plain = '', cast(array() as array<string>), split(_plain, ' '))").alias("_words"))
    df = df.select(
        *carried, "_text",
        F.size("_words").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("_words")).alias("_distinct"),
        (F.length("_text") - F.length(F.regexp_replace("_text", "[#*$%&|<>]+", ""))).alias("_symbols"),
        (F.col("_text") == F.upper("_text")).alias("_upper"),
    )
    marks = ("n_tokens < 50", "n_tokens < 300", "2 * _distinct < n_tokens", "5 * _distinct < n_tokens", "10 * _symbols > n_tokens", "_symbols > n_tokens", "_upper")
    return df.select(*carried, "_text", "n_tokens", *[F.expr(m).cast("int").alias(f"f{i}") for i, m in enumerate(marks)])


_MARKS = 7


def _features(docs: DataFrame, strings: Sequence[str], *carried: str) -> DataFrame:
    found = [F.contains(F.col("_text"), F.lit(s)).cast("int").alias(f"f{_MARKS + i}") for i, s in enumerate(strings)]
    df = _figures(docs, *carried)
    return df.select(*carried, "n_tokens", *[f"f{i}" for i in range(_MARKS)], *found)


def train(docs: DataFrame, labelled: DataFrame, domains: int = len(DOMAINS), rows: int = TRAIN_ROWS, strings: int = STRINGS) -> Classifier:
    """Learn from the ``rows`` labelled ids of least hash; the driver gets one row per string and domain."""
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # Bounded by ``rows``, so the texts are not shuffled to meet their labels.
    sample = write_out(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "domain"), "mix-sample")
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    word = F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), SPACE))).alias("word")
    per = [F.sum((F.col("domain") == k).cast("long")).alias(f"n{k}") for k in range(domains)]
    counts = sample.select("domain", word).filter(F.col("word").rlike(r"^\p{L}{4,}$")).groupBy("word").agg(*per)
    # Words of letters only: symbols and capitals have figures of their own.
    # How far a string moves the odds of a domain, in standard errors.
    scores = []
    for k in range(domains):
        inside, outside = max(sizes.get(k, 0), 1), max(total - sizes.get(k, 0), 1)
        a = F.col(f"n{k}") / inside
        b = (sum((F.col(f"n{j}") for j in range(domains)), F.lit(0)) - F.col(f"n{k}")) / outside
        both = sum((F.col(f"n{j}") for j in range(domains)), F.lit(0)) / max(total, 1)
        scores.append((a - b) / F.sqrt(both * (1 + 1e-9 - both) * (1 / inside + 1 / outside)))
    best = counts.withColumn("score", F.greatest(*scores)).orderBy(F.desc("score"), "word").limit(strings)
    names = tuple(r["word"] for r in best.select("word").collect())
    width = _MARKS + len(names)
    hits = _features(sample, names, "domain").groupBy("domain").agg(*[F.sum(f"f{i}").alias(f"f{i}") for i in range(width)]).collect()
    by = {r["domain"]: r for r in hits}
    rate = [[((by[k][f"f{i}"] if k in by else 0) + 1) / (sizes.get(k, 0) + 2) for i in range(width)] for k in range(domains)]
    return Classifier(
        names,
        tuple(math.log((sizes.get(k, 0) + 1) / (total + domains)) for k in range(domains)),
        tuple(tuple(math.log(x) for x in r) for r in rate),
        tuple(tuple(math.log(1 - x) for x in r) for r in rate),
    )


def posteriors(docs: DataFrame, model: Classifier, *carried: str) -> DataFrame:
    """``carried``, n_tokens and the posterior p0, p1, ... of every row."""
    df = _features(docs, model.strings, *carried)
    domains = range(len(model.prior))
    logits = []
    for k in domains:
        constant = model.prior[k] + sum(model.absent[k])
        terms = [F.col(f"f{i}") * F.lit(p - a) for i, (p, a) in enumerate(zip(model.present[k], model.absent[k]))]
        logits.append(sum(terms, F.lit(constant)).alias(f"l{k}"))
    df = df.select(*carried, "n_tokens", *logits)
    top = F.greatest(*[F.col(f"l{k}") for k in domains])
    df = df.select(*carried, "n_tokens", *[F.exp(F.col(f"l{k}") - top).alias(f"e{k}") for k in domains])
    whole = sum((F.col(f"e{k}") for k in domains), F.lit(0.0))
    return df.select(*carried, "n_tokens", *[(F.col(f"e{k}") / whole).alias(f"p{k}") for k in domains])


def rate(steps: Sequence[Sequence[float]], ridge: float = RIDGE) -> Column:
    """The rate after the given steps: each projected, starting from 1."""
    step = 1 / (1 + ridge)
    r = F.lit(1.0)
    for pull in steps:
        move = sum((F.lit(step * g) * F.col(f"p{k}") for k, g in enumerate(pull)), F.lit(0.0))
        r = F.greatest(F.lit(0.0), r * F.lit(1 - step * ridge) + F.lit(step * ridge) - move)
    return r


def _rate_of(posterior: Sequence[float], steps: Sequence[Sequence[float]], ridge: float) -> float:
    """``rate`` of one posterior."""
    step, r = 1 / (1 + ridge), 1.0
    for pull in steps:
        r = max(0.0, r * (1 - step * ridge) + step * ridge - step * sum(g * p for g, p in zip(pull, posterior)))
    return r


def fit(member: DataFrame, targets: Sequence[float] = TARGETS, size: float = SIZE, ridge: float = RIDGE) -> list[list[float]]:
    """Residuals of every projected-gradient step; one aggregate over ``member`` each.

    ``size`` is the least size: it grows until a document that is certainly of
    the domain ``WHOLE`` has a rate of 1, so that the other domains are repeated
    to meet their shares instead of that one being thinned out.
    """
    domains = range(len(targets))

    def totals(r: Column) -> tuple[float, list[float]]:
        expected = [F.sum(F.col("n_tokens") * r * F.col(f"p{k}")).alias(f"t{k}") for k in domains]
        row = member.agg(F.sum("n_tokens").alias("n"), *expected).first()
        n = float(row["n"] or 0)
        return n, [float(row[f"t{k}"] or 0) / n if n else 0.0 for k in domains]

    n, share = totals(F.lit(1.0))
    if not n:
        return []

    def residual(now: Sequence[float]) -> float:
        return max(abs(now[k] / size - targets[k]) for k in domains)

    surely = [float(k == WHOLE) for k in domains]
    if targets[WHOLE] > 0:
        size = max(size, share[WHOLE] / targets[WHOLE])
    for trial in range(SIZES):
        steps: list[list[float]] = []
        now, moved = share, math.inf
        while not steps or (residual(now) > RESIDUAL and moved > TOLERANCE and len(steps) < ITERATIONS):
            steps.append([(now[k] - size * targets[k]) / share[k] if share[k] > 0 else 0.0 for k in domains])
            _, after = totals(rate(steps, ridge))
            moved = max(abs(a - b) for a, b in zip(after, now))
            now = after
        lowest = _rate_of(surely, steps, ridge)
        if lowest >= 1 - 1e-6 or not targets[WHOLE] or trial == SIZES - 1:
            break
        size *= 1.001 / max(lowest, 0.5)
    report = logging.getLogger(__name__)
    said = report.info if residual(now) <= RESIDUAL and lowest >= 1 - 1e-6 else report.warning
    said("mixing: size %.4f, shares %s, residual %.2e after %d steps, rate of %s %.4f", size, now, residual(now), len(steps), WHOLE, lowest)
    return steps


def copies(r: Column, seed: int = SEED) -> Column:
    """The rate rounded to a neighbouring whole number, up with the probability of its fraction."""
    u = F.xxhash64(F.lit(seed), F.col("doc_id")).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") * 2.0**-53
    return F.floor(r + u).cast("int")


def rates(docs: DataFrame, labelled: DataFrame, targets: Sequence[float] = TARGETS, size: float = SIZE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, posteriors, rate and copies."""
    model = train(docs, labelled)
    member = write_out(posteriors(docs, model, "doc_id"), "mix-member")
    r = rate(fit(member, targets, size))
    named = [F.col(f"p{k}").alias(f"p_{name}") for k, name in enumerate(DOMAINS)]
    return member.select("doc_id", "n_tokens", *named, r.alias("rate"), copies(r).alias("copies"))


def mix(docs: DataFrame, labelled: DataFrame, targets: Sequence[float] = TARGETS, size: float = SIZE) -> DataFrame:
    """Rows of ``docs``, each as often as its copies say, all columns unchanged."""
    model = train(docs, labelled)
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row"), "doc_id", "text")
    r = rate(fit(write_out(posteriors(docs, model), "mix-member"), targets, size))
    times = settled(posteriors(packed, model, "_row", "doc_id").select("_row", copies(r).alias("copies")), "copies").filter("copies > 0")
    each = times.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(*[F.col("_row").getField(n).alias(n) for n in docs.columns])
