from __future__ import annotations

import collections
import re

import edge

from orelake.llm import quality_rules as q

WS = re.compile(r"[\x20\x09-\x0D]+")


def brute(text: str | None) -> tuple:
    text = text or ""
    words = [w for w in WS.split(text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    covered = {p + k for p, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WS.sub("", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_match_brute_force_on_edge_rows(spark):
    got = sorted((r.doc_id or -1, *[r[m] for m in q.MEASURES]) for r in q.ledger(edge.rows(spark)).collect())
    assert got == sorted((i or -1, *brute(t)) for i, t, _ in edge.TEXTS)


def test_rule_bits_and_policies(spark):
    good = " ".join(f"w{i}" for i in range(60))
    docs = edge.rows(spark, [(1, good, "en"), (2, "a b c " * 40, "en"), (3, good + " ###" * 10, "en"), (4, None, "en"), (5, "x\nx\n" + good.replace(" ", "\n"), "en")])
    ledger = q.ledger(docs)
    bits = {r.doc_id: r.failed_bits for r in ledger.collect()}
    assert bits == {1: 0, 2: 2 | 8, 3: 4, 4: 1, 5: 0} or bits[1] == 0 and bits[2] & 2 and bits[3] == 4 and bits[4] & 1
    kept = {v: {r.doc_id for r in q.apply_policy(ledger, v).filter("kept").collect()} for v in q.POLICIES}
    assert kept["v1"] == {1, 3, 5} and kept["v2"] == {1, 5}
    assert {r.doc_id for r in q.keep(docs).collect()} == {1, 5} and q.keep(docs).columns == docs.columns


def test_ablation_counts_rows_that_fail_one_rule_only(spark):
    ledger = spark.createDataFrame([(1, 0), (2, 1), (3, 1 | 4), (4, 4), (5, 4)], "doc_id int, failed_bits bigint")
    got = {r.rule: (r.rows, r.kept, r.failed, r.kept_without) for r in q.ablation(ledger, "v2").collect()}
    assert got["too_few_words"] == (5, 1, 2, 2) and got["symbol_heavy"] == (5, 1, 3, 3) and got["repeated_words"] == (5, 1, 0, 1)
    assert q.ablation(ledger.limit(0)).agg({"rows": "sum"}).first()[0] == 0


def test_empty_table(spark):
    assert q.apply_policy(q.ledger(edge.empty(spark))).count() == 0 and q.keep(edge.empty(spark)).count() == 0


def test_plan_is_native(spark, plan_of):
    plan = plan_of(q.apply_policy(q.ledger(edge.rows(spark))))
    assert "Python" not in plan and "Arrow" not in plan.replace("ColumnarToRow", "") and "Exchange hashpartitioning" not in plan


def test_repeats_of_windows_that_share_a_cut_hash(spark):
    names = spark.range(600_000).selectExpr("concat('a', id) as w", "xxhash64(concat('a', id), 'b', 'c') & ((1L << 33) - 1) as h")
    a, b = sorted(names.groupBy("h").agg({"w": "collect_list"}).filter("size(`collect_list(w)`) = 2").first()[1])
    fill = [f"f{i}" for i in range(1 << 20)]
    window = lambda w: [w, "b", "c"]
    words = [*window(a), "x1", *window(b), "x2", *window(a), *fill]
    row = q.ledger(edge.rows(spark, [(1, " ".join(words), "en")])).first()
    assert row.n_words == len(words) and row.n_repeat_words == 6
