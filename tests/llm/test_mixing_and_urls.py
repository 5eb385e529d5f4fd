from __future__ import annotations

import random

import edge
import numpy as np

from orelake.llm import mixing, url_filters
from orelake.storage import write_out


def _corpus(spark):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    texts, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rng.randint(60, 200))]
        kind = 2 if i % 8 == 0 else 1 if i % 5 == 0 else 0
        if kind == 2:
            words.insert(5, "dimwit")
        if kind == 1:
            words = ["again"] * len(words)
        texts.append((i, " ".join(words), "en"))
        labels.append((i, int(kind != 1), int(kind == 2)))
    return edge.rows(spark, texts), edge.labels(spark, labels), labels


def test_expected_shares_meet_the_targets(spark):
    docs, labels, truth = _corpus(spark)
    out = mixing.rates(docs, mixing.label_domains(labels)).toPandas()
    assert len(out) == 400 and (out.rate >= 0).all()
    n, p = out.n_tokens.values, out[["p_clean", "p_poor", "p_toxic"]].values
    assert np.allclose(p.sum(axis=1), 1)
    share = (n * out.rate.values) @ p / n.sum()
    assert np.abs(share - np.array(mixing.TARGETS)).max() < 0.01
    kind = np.array([2 if t else 0 if q else 1 for _, q, t in truth])
    assert (p.argmax(axis=1) == kind[out.doc_id.values]).mean() > 0.97
    assert (np.abs(out.copies - out.rate) < 1).all()


def test_rates_match_projected_gradient_in_numpy(spark):
    docs, labels, _ = _corpus(spark)
    model = mixing.train(docs, mixing.label_domains(labels))
    member = write_out(mixing.posteriors(docs, model, "doc_id"), "test-member")
    steps = mixing.fit(member)
    rows = member.toPandas().sort_values("doc_id")
    n, p = rows.n_tokens.values, rows[["p0", "p1", "p2"]].values
    w, r, t = n / n.sum(), np.ones(len(n)), np.array(mixing.TARGETS)
    share = w @ p
    step = 1 / (1 + mixing.RIDGE)
    for _ in steps:
        r = np.maximum(0, r - step * (p @ (((w * r) @ p - t) / share) + mixing.RIDGE * (r - 1)))
    got = member.select("doc_id", mixing.rate(steps).alias("r")).toPandas().sort_values("doc_id").r.values
    assert np.abs(got - r).max() < 1e-6


def test_mix_repeats_rows_as_copies_say(spark):
    docs, labels, _ = _corpus(spark)
    labelled = mixing.label_domains(labels)
    want = {r.doc_id: r.copies for r in mixing.rates(docs, labelled).collect() if r.copies}
    mixed = mixing.mix(docs, labelled)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_mixing_edge_rows(spark):
    docs = edge.rows(spark)
    labels = edge.labels(spark, [(5, 1, 0), (6, 0, 1), (6, 1, 0), (11, 0, 0), (None, 1, 1), (99, None, None)])
    out = mixing.rates(docs, mixing.label_domains(labels)).collect()
    assert len(out) == len(edge.TEXTS) and all(r.rate >= 0 and r.copies >= 0 for r in out)
    assert mixing.rates(edge.empty(spark), mixing.label_domains(labels)).count() == 0
    assert mixing.mix(edge.empty(spark), mixing.label_domains(labels.limit(0))).count() == 0
    equal = mixing.rates(docs, mixing.label_domains(labels.limit(0))).first()
    assert abs(equal.p_clean - 1 / 3) < 1e-9


def test_mixing_plan_is_native(spark, plan_of):
    docs, labels, _ = _corpus(spark)
    plan = plan_of(mixing.mix(docs, mixing.label_domains(labels)))
    assert "Python" not in plan and "InArrow" not in plan


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(4)
    hosts = [(f"h{i}.example", rng.random() < 0.1) for i in range(20_000)]
    universe = spark.createDataFrame(hosts, "host string, listed boolean")
    levels = url_filters.build(universe)
    assert len(levels) > 2 and 8 * sum(len(x.data) for x in levels) < 30 * sum(y for _, y in hosts)
    for segment in (url_filters.SEGMENT, 500):
        marked = url_filters.mark(universe, universe, segment=segment)
        assert marked.filter("is_listed <> listed").count() == 0 and marked.count() == len(hosts)


def test_url_parts_and_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.B.NET", "https://X.Example.NET/en/1?q", "http://example.net/en", "http://net/x",
        "x://y.org/fr/", "x://y.org?/fr/", "http://m.example.com/de/1#z", "http://spam-farm.example.com/", "http://a.example.com://b/de/",
        "http://Ärger.com/\n/x", "http://adult.example.net/en/", "http://notnet/",
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages).collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("a.b.net", "", None, "allow") and got[5] == ("x.example.net", "/en/1", "example.net/en/", "allow")
    assert got[6] == ("example.net", "/en", "net/", "block") and got[7] == ("net", "/x", "net/", "block")
    assert got[8] == ("y.org", "/fr/", "org/fr/", "allow") and got[9] == ("y.org", "", None, "allow")
    assert got[10][2:] == ("example.com/de/", "block") and got[11] == ("spam-farm.example.com", "/", None, "block")
    assert got[12][:2] == ("a.example.com:", "//b/de/") and got[13][:2] == ("Ärger.com", "/\n/x")
    assert got[14][2:] == ("example.net/en/", "allow") and got[15] == ("notnet", "/", None, "allow")
    assert url_filters.judge(pages.limit(0)).count() == 0


def test_a_table_of_hosts_is_the_list(spark):
    rng = random.Random(3)
    hosts = [f"Plain{i}.example" for i in range(3000)]
    listed = set(rng.sample(hosts, 700))
    # A third of the pages are of one listed host.
    urls = [f"http://{h}/x" for h in hosts] + [f"http://{min(listed)}/y"] * 1500 + [None, "http://"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").repartition(5)
    names = [h.upper() for h in listed] + [min(listed), "on.no.page", None, ""]
    table = spark.createDataFrame([(h, "x") for h in names], "host string, listed string")
    want = {i: u is not None and u[7:].split("/")[0] in listed for i, u in enumerate(urls)}
    for segment in (url_filters.SEGMENT, 100):
        got = {r.page_id: r.verdict == "block" for r in url_filters.judge(pages, listed=table, segment=segment).collect()}
        assert got == want
    assert {r.verdict for r in url_filters.judge(pages, listed=table.limit(0)).collect()} == {"allow"}


def test_clean_documents_stay_where_most_words_are_clean(spark):
    rows = [(i, 100, 1.0, 0.0, 0.0) for i in range(970)] + [(i, 100, 0.0, 1.0, 0.0) for i in range(970, 990)]
    rows += [(i, 100, 0.3, 0.0, 0.7) for i in range(990, 1000)]
    member = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, p0 double, p1 double, p2 double")
    out = member.select("*", mixing.rate(mixing.fit(member)).alias("rate")).toPandas()
    assert out.rate[out.p0 == 1].min() >= 1 - 1e-6
    words = (out[["p0", "p1", "p2"]].values * out.rate.values[:, None]).sum(axis=0)
    assert abs(words / words.sum() - mixing.TARGETS).max() < 2 * mixing.RESIDUAL
