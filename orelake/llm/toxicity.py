"""Toxicity by a subsequence string-kernel support vector machine with Nystrom landmarks.

The machine (see ``string_kernel``) scores words, the shortest sentences a label
can be pinned on.  It learns from labelled rows: every distinct word counts as
often positive as toxic rows hold it and as often negative as other rows do, so
a word that both kinds use is negative, and a spelling that only toxic rows use,
or that resembles such spellings, is positive.  Landmarks are the words that set
toxic rows apart most, and background words.  A text's figures (its best words
and their share) pass through a logistic curve fitted on the same rows.

Rows are labelled by ``doc_id``; those with crc32(doc_id) mod 5 = 0 are held
out.  Of the others the ``TRAIN_ROWS`` with the least hash are used, a
documented bound: only they reach the driver, which trains and sends the
weights (of fixed size) to the tasks.  Labels, language, source and id are no
inputs of a score.

Every word of every whole text is scored, distinct words once per task.  Null
and empty texts get the score of a text without words; without labelled rows of
both kinds all scores are 0.  Labels of a repeated id count once (toxic wins).
Repeated rows get equal scores; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.storage import write_out

TRAIN_ROWS = 4000
LANDMARKS = 72
# Landmarks added after a first training.
NEIGHBOURS = 48
# Distinct words of the training rows that the machine sees, those with the least hash among the uninformative ones.
TRAIN_WORDS = 40_000
# Weight of a toxic row's words; under the ratio of other rows to toxic ones, so that shared words stay negative.
BALANCE = 4.0
HELD_OUT = 5
# Distinct words whose scores a task keeps.
_CACHE = 1_000_000


@dataclass(frozen=True)
class Model:
    machine: object | None
    curve: tuple[float, ...]


def held_out(doc_id=None):
    """Rows that training never sees."""
    return F.crc32((F.col("doc_id") if doc_id is None else doc_id).cast("string").cast("binary")) % HELD_OUT == 0


def figures(scores, ends):
    """Per text: best word, second best, and share of words above 0; texts without words get the floor."""
    import numpy as np

    n = len(ends)
    begin = np.append(0, ends[:-1])
    out = np.zeros((n, 3))
    out[:, :2] = -2.0
    some = np.flatnonzero(ends > begin)
    if len(some):
        clipped = np.clip(scores, -2.0, 2.0)
        best = np.maximum.reduceat(clipped, begin[some])
        out[some, 0] = best
        count = (ends - begin)[some]
        owner = np.repeat(np.arange(len(some)), count)
        is_best = clipped == best[owner]
        rest = np.where(is_best, -2.0, clipped)
        second = np.maximum.reduceat(rest, np.append(0, np.cumsum(count)[:-1]))
        many = np.bincount(owner, weights=is_best, minlength=len(some)) > 1
        out[some, 1] = np.where(many, best, second)
        out[some, 2] = np.log1p(np.bincount(owner, weights=clipped > 0, minlength=len(some)))
    return out


def _curve(x, y):
    """Logistic weights (two centred in one), by Newton steps with a small ridge."""
    import numpy as np

    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + 1e-2 * w
        bend = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def learn(texts: list[str], toxic: list[int], landmarks: int = LANDMARKS, words: int = TRAIN_WORDS) -> Model:
    import zlib

    import numpy as np

    from orelake.llm import string_kernel as kernel

    if len(set(toxic)) < 2:
        return Model(None, ())
    bags = [sorted({w for t in text.split() if len(w := kernel.normal(t)) >= kernel.ORDERS[0]}) for text in texts]
    bad, good = Counter(), Counter()
    for bag, y in zip(bags, toxic):
        (bad if y else good).update(bag)
    n_bad, n_good = sum(toxic), len(toxic) - sum(toxic)
    vocabulary = sorted(set(bad) | set(good))
    p = np.array([bad[w] for w in vocabulary], float)
    q = np.array([good[w] for w in vocabulary], float)
    both = (p + q) / len(toxic)
    apart = (p / n_bad - q / n_good) / np.sqrt(both * (1.000001 - both) * (1 / n_bad + 1 / n_good))
    hashed = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in vocabulary])
    by_force = np.lexsort((hashed, -apart))
    first = [i for i in by_force[: 2 * landmarks // 3] if apart[i] > 0]
    rest = [i for i in np.lexsort((hashed, -(p + q)))[:2000] if i not in set(first)]
    rest = sorted(rest, key=lambda i: hashed[i])[: landmarks - len(first)]
    marks = [vocabulary[i] for i in [*first, *rest]]
    informative = np.flatnonzero((p + q >= 3) | (apart > 2))
    others = np.setdiff1d(np.arange(len(vocabulary)), informative)
    others = others[np.argsort(hashed[others])][: max(0, words - len(informative))]
    use = np.concatenate([informative[:words], others]).astype(int)
    cut = kernel.WINDOW - 2
    short, up, down = [vocabulary[i][:cut] for i in use], p[use] * BALANCE, q[use]
    marks = [m[:cut] for m in marks]
    machine = kernel.train(short, up, down, marks)
    # Words of the other side that come too close become landmarks themselves.
    wrong = np.maximum(1 + machine.score(short), 0) * down * (down > up)
    close = [short[i] for i in np.argsort(-wrong, kind="stable") if short[i] not in set(marks)][:NEIGHBOURS]
    machine = kernel.train(short, up, down, [*marks, *close])
    value = dict(zip(vocabulary, machine.score(vocabulary)))
    scores = np.array([value[w] for bag in bags for w in bag])
    x = figures(scores, np.cumsum([len(b) for b in bags]))
    return Model(machine, _curve(x, np.array(toxic, float)))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labelled rows of least hash that are not held out."""
    known = labels.filter("doc_id is not null AND toxic is not null").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # Bounded by ``rows``, so no text is shuffled to meet its label.
    sample = write_out(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "toxic-sample")
    found = sample.orderBy("doc_id", F.xxhash64("text")).limit(2 * rows).toArrow()
    texts = [t or "" for t in found.column("text").to_pylist()]
    return learn(texts, [int(y == 1) for y in found.column("toxic").to_pylist()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from orelake.llm import string_kernel as kernel

        machine, curve = shared.value.machine, shared.value.curve
        seen: dict[str, int] = {}
        values = np.zeros(0)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if machine is None:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.zeros(len(texts)))], ["doc_id", "score"])
                continue
            if len(seen) > _CACHE:
                seen, values = {}, np.zeros(0)
            new: list[str] = []
            numbers: list[int] = []
            ends = []
            for text in texts:
                for token in set(text.split()) if text else ():
                    i = seen.get(token)
                    if i is None:
                        i = seen[token] = len(seen)
                        new.append(token)
                    numbers.append(i)
                ends.append(len(numbers))
            if new:
                spelled, place = np.unique(np.array([kernel.normal(t) for t in new], dtype=object), return_inverse=True)
                values = np.append(values, machine.score(list(spelled))[place])
            x = figures(values[np.array(numbers, dtype=int)], np.array(ends))
            logit = x @ np.array(curve[:-1]) + curve[-1]
            result = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(result)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, score double")


def judge(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    scored = score(docs, train(docs, labels, rows))
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
