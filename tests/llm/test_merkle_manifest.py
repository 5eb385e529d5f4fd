from __future__ import annotations

import hashlib
import zlib

from edge import TEXTS, empty, rows

from orelake.llm import merkle_manifest as mm


def digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text) -> str:
    shown = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest("-" if v is None else f"{len(v.encode())}:{v}" for v in shown)


def plain_tree(nodes: list[str]) -> tuple[str, list[list[list[str]]]]:
    """Root and, for each leaf, its siblings level by level."""
    paths = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = p // 8 * 8
            paths[i].append([n for k, n in enumerate(nodes[run : run + 8], run) if k != p])
        place = [p // 8 for p in place]
        nodes = [digest(nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def expected(docs: list[tuple]) -> list[tuple]:
    """The whole manifest anew for every row, from its definition."""

    def build(all_rows):
        trees = {}
        for r in all_rows:
            trees.setdefault(r[2], []).append(r)
        names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
        done = {}
        for name in names:
            order = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
            done[name] = (order, *plain_tree([leaf_of(*r) for r in order]))
        root, upper = plain_tree([done[n][1] for n in names])
        return names, done, root, upper

    names, done, root, upper = build(docs)
    out = []
    for k, name in enumerate(names):
        order, subroot, paths = done[name]
        for row, path in zip(order, paths):
            proof = digest(s for level in [*path, *upper[k]] for s in level)
            out.append((row, leaf_of(*row), subroot, root, proof))
    return out


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_manifest_matches_the_definition(spark):
    docs = [(i, f"s{i % 3}", "en", i * 7, f"Text {i} A") for i in range(1300)]
    docs += [(i, None, f"l{i % 600}", None, None if i % 5 == 0 else f"Ü{i}") for i in range(2000, 2700)]
    docs += [(9000, "s", None, 1, "alone"), (9001, "s", "", 1, ""), (1, "s0", "en", 3, "same id")]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    result = mm.audit(df).collect()
    want = expected(docs)
    key = lambda r: (r[0] if r[0] is not None else -1, r[1])
    assert sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in result], key=key) == sorted(
        [(w[0][0], *w[1:]) for w in want], key=key
    )
    for r in result:
        row = next(w[0] for w in want if w[1] == r.leaf)
        tampered = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and mm_lower(row[4]) != row[4]
        assert r.verified == (not tampered)


def mm_lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_a_version_is_the_tree_of_the_changed_rows(spark):
    docs = [(i, "s", "ab"[i % 7 == 0], 1, f"Text {i}") for i in range(700)]
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    found = mm.versions(spark.createDataFrame(docs, schema).repartition(3)).filter("size(copied) > 0").collect()
    assert len(found) > 150
    for r in found[::40]:
        changed = [(*d[:4], mm_lower(d[4])) if d[0] == r.doc_id else d for d in docs]
        assert expected(changed)[0][3] == r.folded_root
        # One copy a level: three or four of the language's tree and one above it.
        assert len(r.copied) == len([p for p in r.proof]) and r.copied[-1] == r.folded_root


def test_a_version_shares_what_it_does_not_copy():
    top = mm.grow([digest([str(i)]) for i in range(500)], 500)[0]
    version = mm.changed(top, 77, 3, digest(["new"]))

    def nodes(node):
        yield id(node)
        for child in node[1]:
            yield from nodes(child)

    assert len(set(nodes(version)) - set(nodes(top))) == 4
    assert version[0] != top[0] and mm.path_of(version, 77, 3) == mm.path_of(top, 77, 3)


def test_edge_rows_and_empty_table(spark):
    docs = [(i, "src", lang, len(t or ""), t) for i, t, lang in TEXTS]
    result = mm.audit(rows(spark)).collect()
    key = lambda r: (r[0] if r[0] is not None else -1, *r[1:])
    assert sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in result], key=key) == sorted(
        [(w[0][0], *w[1:]) for w in expected(docs)], key=key
    )
    assert mm.audit(empty(spark)).collect() == []
