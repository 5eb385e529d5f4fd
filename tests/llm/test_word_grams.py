"""The n-gram model of the quality classifier."""

from __future__ import annotations

import collections
import math
import random

import edge
import pyarrow as pa
import pytest

from orelake.llm import kneser_ney, word_grams


def brute_words(texts, order=3):
    """Modified Kneser-Ney over word tuples straight from the definition."""
    seqs = [["^"] * (order - 1) + t.split() + ["^"] for t in texts]
    counts = {order: collections.Counter(tuple(s[i : i + order]) for s in seqs for i in range(len(s) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / max(32, len(counts[1]) + 1)
        c = counts[k]
        n = collections.Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        d = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        d = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
        own = {g: v for g, v in c.items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        mass = sum(own.values())
        v = own.get(gram, 0)
        return (v - d[min(v, 3) - 1] if v else 0) / mass + sum(d[min(x, 3) - 1] for x in own.values()) / mass * p(gram[1:])

    return p


def test_word_perplexity_matches_the_definition(spark):
    known = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "кот сел на мат"]
    asked = ["the cat sat on the log", "mat the on sat cat the", "zebra quagga", "кот на мат"]
    docs = edge.rows(spark, [(i, t, "en") for i, t in enumerate([*known, *asked])])
    got = {r.doc_id: r for r in kneser_ney.judge(docs, docs.filter("doc_id < 4").select("doc_id")).collect()}
    p = brute_words(known)
    for i, text in enumerate([*known, *asked]):
        seq = ["^", "^", *text.split(), "^"]
        logs = [math.log(p(tuple(seq[k - 2 : k + 1]))) for k in range(2, len(seq))]
        assert got[i].n_symbols == len(logs)
        assert got[i].perplexity == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-9), text
    # Order and vocabulary tell, and so do letters beyond U+017F.
    assert min(got[5].perplexity, got[6].perplexity) > 3 * got[4].perplexity
    assert got[7].perplexity < got[6].perplexity


def test_model_grows_with_the_trusted_text(spark):
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(20)), "en") for i in range(200)]
    tokens = word_grams.words(edge.rows(spark, texts), "doc_id")
    sizes = [word_grams.train(tokens.filter(f"doc_id < {n}"), kneser_ney.discounts).grams[3].count() for n in (50, 200)]
    assert sizes == [50 * 21, 200 * 21]


def test_poor_rows_set_the_threshold(spark):
    rng = random.Random(5)
    names = [f"w{i}" for i in range(40)]
    good = [" ".join(names[(s + k) % 40] for k in range(60)) for s in (rng.randrange(40) for _ in range(150))]
    bad = [" ".join(rng.sample(names, 40)) for _ in range(60)]
    docs = edge.rows(spark, [(i, t, "en") for i, t in enumerate([*good, *bad])])
    labels = edge.labels(spark, [(i, int(i < 150), 0) for i in range(190)])
    out = kneser_ney.judge(docs, kneser_ney.trusted_ids(labels), poor=kneser_ney.poor_ids(labels)).collect()
    # Shuffled words are rejected, also on rows without a label.
    assert not [r for r in out if r.doc_id >= 150 and r.kept]
    assert sum(r.kept for r in out if r.doc_id < 150) >= 140


def test_rounds_and_spread_words_change_nothing_and_keep_no_words(spark, monkeypatch):
    rng = random.Random(9)
    names = [f"w{i}" for i in range(30)] + ["über", "日本", "x" * 70]
    texts = [" ".join(rng.choice(names) + rng.choice(["", "", ",", " ."]) for _ in range(40)) for _ in range(60)]
    docs = edge.rows(spark, [(i, t, "en") for i, t in enumerate(texts)])
    trusted, poor = docs.filter("doc_id < 25").select("doc_id"), docs.filter("doc_id >= 50").select("doc_id")
    written = []
    for module in (kneser_ney, word_grams):
        keep = module.write_out
        monkeypatch.setattr(module, "write_out", lambda df, label, keep=keep: written.append(df.columns) or keep(df, label))
    judged = lambda: sorted((r.doc_id, r.n_symbols, r.bucket, r.kept, r.perplexity) for r in kneser_ney.judge(docs, trusted, poor=poor).collect())
    whole = judged()
    # Neither the words of texts nor their grams are kept.
    assert written and not [c for c in written if "words" in c or "gram" in c or "w1" in c]
    monkeypatch.setattr(word_grams, "SHARD", 150)
    monkeypatch.setattr(word_grams, "ROUNDS", 2)
    parted = judged()
    assert [r[:4] for r in parted] == [r[:4] for r in whole]
    assert [r[4] for r in parted] == pytest.approx([r[4] for r in whole], rel=1e-9)


def test_no_shard_holds_a_frequent_pair_whole(spark, monkeypatch):
    rng = random.Random(3)
    texts = [f"w{rng.randrange(50)} w{rng.randrange(50)} x{i}" for i in range(1500)]
    docs = edge.rows(spark, [(i, t, "en") for i, t in enumerate(texts)])
    trusted, poor = docs.filter("doc_id < 900").select("doc_id"), docs.filter("doc_id >= 1400").select("doc_id")
    judged = lambda: {r.doc_id: r for r in kneser_ney.judge(docs, trusted, poor=poor).collect()}
    whole = judged()
    monkeypatch.setattr(word_grams, "SHARD", 200)
    monkeypatch.setattr(word_grams, "ROUNDS", 2)
    monkeypatch.setattr(word_grams, "COMMON", 20)
    tokens = word_grams.words(docs.selectExpr("doc_id as rid", "3 as mark", "text"), "rid", "mark")
    model = word_grams.train(tokens, kneser_ney.discounts)
    count = lambda shard: pa.table({"n": [len(word_grams._opened(shard)[0])]})
    dealt = [word_grams._dealt(tokens, model.layout, model.rounds, turn) for turn in range(model.rounds)]
    sizes = [r.n for x in dealt for r in x.groupBy("shard").applyInArrow(count, "n bigint").collect()]
    # Each text begins with the same pair of bounds: 1,500 of 6,000 grams.
    assert sum(sizes) == 6000 and max(sizes) < 900
    parted = judged()
    for i, r in whole.items():
        assert (parted[i].n_symbols, parted[i].bucket, parted[i].kept) == (r.n_symbols, r.bucket, r.kept)
        assert parted[i].perplexity == pytest.approx(r.perplexity, rel=1e-9)
