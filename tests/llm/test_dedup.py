from __future__ import annotations

import collections
import random
import re

import edge

from orelake.llm import bag_minhash, exact_dedup, near_dedup

WS = re.compile(r"[\x20\x09-\x0D]+")


def test_exact_groups_match_brute_force(spark):
    texts = [(i, t, lang) for i, t, lang in edge.TEXTS if i is not None]
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.groups(edge.rows(spark, texts), block=64).collect()}
    by = collections.defaultdict(list)
    for i, t, _ in texts:
        by[WS.sub(" ", t or "")].append(i)
    assert got == {(i, min(m), len(m)) for m in by.values() for i in m}


def test_exact_keeps_one_row_of_repeated_rows_and_all_columns(spark):
    docs = edge.rows(spark)
    kept = exact_dedup.keep(docs, block=64)
    assert kept.columns == docs.columns
    assert sorted(WS.sub(" ", r.text or "") for r in kept.collect()) == sorted({WS.sub(" ", t or "") for _, t, _ in edge.TEXTS})
    one = exact_dedup.groups(docs).filter("doc_id = 6").collect()
    assert len(one) == 2 and not any(r.kept for r in one)


def test_names_do_not_depend_on_block_size_or_dictionary(spark, monkeypatch):
    base = "".join(random.Random(1).choice("ab ") for _ in range(2000))
    texts = [(i, base[: 1900 + i % 5 * 20] + ("!" if i % 7 == 0 else ""), "en") for i in range(60)]
    docs = edge.rows(spark, texts)
    whole = sorted(map(tuple, exact_dedup.groups(docs).collect()))
    monkeypatch.setattr(exact_dedup, "HELD", 500)
    assert sorted(map(tuple, exact_dedup.groups(docs, block=7).collect())) == whole


def test_empty_tables(spark):
    assert exact_dedup.groups(edge.empty(spark)).count() == 0 and exact_dedup.keep(edge.empty(spark)).count() == 0
    assert near_dedup.classes(edge.empty(spark)).count() == 0 and near_dedup.keep(edge.empty(spark)).count() == 0


def bag(text: str | None) -> collections.Counter:
    words = [w for w in WS.split(text or "") if w]
    return collections.Counter(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1 if words else 0)))


def brute_classes(texts) -> dict[int, int]:
    bags = [(i, bag(t)) for i, t, _ in texts]
    parent = list(range(len(bags)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(bags)):
        for b in range(a):
            x, y = bags[a][1], bags[b][1]
            shared = sum((x & y).values())
            if shared and shared / (sum(x.values()) + sum(y.values()) - shared) >= 0.8:
                parent[root(a)] = root(b)
    members = collections.defaultdict(list)
    for a, (i, _) in enumerate(bags):
        members[root(a)].append(i)
    return {i: min(m) for m in members.values() for i in m}


def test_near_classes_match_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(8, 120))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append((len(texts), " ".join(copy) + (" " + " ".join(base[:10])) * rng.randint(0, 1), "en"))
    texts += [(900 + i, t, "en") for i, (_, t, _) in enumerate(edge.TEXTS) if t]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(edge.rows(spark, texts)).collect()}
    assert got == brute_classes(texts)


def test_hot_group_of_near_copies_is_one_class_with_few_comparisons(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = []
    for i in range(300):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(150)] = f"x{i}{rng.randrange(99)}"
        texts.append((i, " ".join(copy), "en"))
    got = {r.class_id for r in near_dedup.classes(edge.rows(spark, texts)).collect()}
    assert got == set(brute_classes(texts).values())


def test_near_keep_edge_rows(spark):
    docs = edge.rows(spark)
    kept = near_dedup.keep(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id or -1) for r in kept.collect())
    # 5 to 7 are one class, 8 and 9 another; texts without words stay.
    assert ids == [-1, -1, 1, 2, 3, 4, 5, 8, 10, 11]


def test_signature_estimates_weighted_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    true, seen = [], []
    for _ in range(20):
        words = [f"w{x}" for x in rng.integers(0, 40, 300)]
        other = list(words)
        for p in rng.integers(0, 300, 6):
            other[p] = f"x{p}"
        a, b = " ".join(words), " ".join(other + words[:60])
        x, y = bag(a), bag(b)
        shared = sum((x & y).values())
        true.append(shared / (sum(x.values()) + sum(y.values()) - shared))
        owner, item, count = bag_minhash.shingles([a.encode(), b.encode()])
        signature = bag_minhash.signatures(owner, item, count, 2, 1000)
        seen.append((signature[0] == signature[1]).mean())
    assert abs(np.mean(true) - np.mean(seen)) < 0.01 and np.abs(np.array(true) - seen).max() < 0.06


def test_components_match_brute_force(spark):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(200, i) for i in range(201, 320)] + [(201, i) for i in range(320, 330)]
    loose = [tuple(rng.sample(range(400, 520), 2)) for _ in range(70)]
    pairs = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + star + loose + star[:5] + [(7, 7)]]
    name = lambda i: i.to_bytes(2, "big")
    rng.shuffle(pairs)
    edges = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], "a binary, b binary")
    got = {bytes(r.node): bytes(r.label) for r in near_dedup.components(edges).collect()}
    least = {i: i for p in pairs for i in p}
    for _ in range(200):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {name(i): name(j) for i, j in least.items() if i != 7}


def test_large_group_that_its_pivots_split(spark):
    """Copies drift from one to the next: a pivot is close to its neighbours only, yet all are one class."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = []
    for i in range(240):
        base = list(base)
        base[rng.randrange(200)] = f"x{i}"
        texts.append((i, " ".join(base), "en"))
    docs = edge.rows(spark, texts)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert got == brute_classes(texts)


def test_a_group_of_near_copies_has_few_links(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = []
    for i in range(400):
        copy = list(base)
        copy[rng.randrange(300)] = f"x{i}"
        texts.append((i, " ".join(copy), "en"))
    docs = edge.rows(spark, texts)
    state = near_dedup.signed(docs).filter("node is not null").select("node", near_dedup.F.explode("bands").alias("bucket"))
    assert near_dedup._star(state).count() <= 3 * 400
