from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from edge import TEXTS, empty, rows

from orelake.llm import source_audit as sa
from orelake.llm.term_transducer import Transducer

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(docs: list[tuple]) -> list[tuple]:
    """(lang, source, part, item, value, rank) from the definition; docs are (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    terms = [TERM.findall(lower(t)) for _, _, t in docs]
    df = defaultdict(Counter)
    for (lang, _, _), own in zip(docs, terms):
        df[lang].update(set(own))
    kept = {lang: sorted((t for t, n in c.items() if n >= 10), key=str.encode) for lang, c in df.items()}
    counts = defaultdict(Counter)
    for (lang, source, _), own in zip(docs, terms):
        counts[lang, source].update(t for t in own if df[lang][t] >= 10)
    out = []
    for lang in df:
        sources = sorted({s for l, s in counts if l == lang}, key=str.encode)
        v = len(kept[lang])
        whole = sum((counts[lang, s] for s in sources), Counter())

        def p(count, t):
            return 1 + 10**9 * (count[t] + 2) // (sum(count.values()) + 2 * v)

        for s in sources:
            own = counts[lang, s]
            f = lambda t, other: (p(own, t) - p(other, t)) ** 2 // (p(own, t) + p(other, t))
            found = [(sum(f(t, counts[lang, o]) for t in kept[lang]), o) for o in sources if o != s]
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", o, value, k) for k, (value, o) in enumerate(found, 1)]
            found = [(f(t, whole), t) for t in kept[lang] if own[t] and p(own, t) > p(whole, t)]
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", t, value, k) for k, (value, t) in enumerate(found[:10], 1)]
    return sorted(out)


def random_docs(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["a", "ab", "abc", "B", "Zeta", "öl", "日本", "x_y", "Ünder", "straße", "end"] + [f"w{chr(97 + i % 26)}{'q' * (i % 5)}" for i in range(60)]
    docs = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s2", "s3", "s4", "ß", None])
        text = rng.choice(["", " ", "\n", "1-"]).join(rng.choice(vocabulary) + rng.choice([" ", "\t", "9"]) for _ in range(rng.randrange(40)))
        docs.append((lang, source, rng.choice([text] * 20 + [None, ""])))
    docs += [("xx", "none", "1 2 3"), ("xx", "other", None), ("xx", "third", "rare")]
    return docs


def spread(spark, docs):
    rows_ = [(i, t, lang, s, "c", "d", "e") for i, (lang, s, t) in enumerate(docs)]
    return spark.createDataFrame(rows_, "doc_id bigint, text string, lang string, source string, term string, at string, n string").repartition(4)


# Shards of three terms, terms routed, tiles of two sources and blocks of five terms: every border is crossed.
@pytest.mark.parametrize("small", [{}, {"shard": 3, "tile": 2, "block": 5}, {"shard": 3, "held": 0, "tile": 2, "block": 5}])
def test_audit_matches_the_definition(spark, small):
    docs = random_docs(700, 3)
    got = sorted(tuple(r) for r in sa.audit(spread(spark, docs), **small).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == expected(docs)


def test_edge_rows_and_empty_table(spark):
    docs = [(lang, "src", t) for _, t, lang in TEXTS * 12]
    got = sorted(tuple(r) for r in sa.audit(rows(spark, TEXTS * 12)).collect())
    assert got == expected(docs)
    assert sa.audit(empty(spark)).collect() == []


def test_counts_beyond_64_bits_stay_exact(spark):
    found = spark.sql("select 3000000000000L as n, 9000000000000L as total, 7L as v").select(sa.share_of("n", "total", "v")).first()[0]
    assert found == 1 + 10**9 * (3 * 10**12 + 2) // (9 * 10**12 + 14)


def test_transducer_is_minimal_and_ordered():
    rng = random.Random(7)
    for size in (0, 1, 2, 30, 400):
        terms = sorted({bytes(rng.choice(b"abc\xc3") for _ in range(rng.randrange(1, 8))) for _ in range(size)})
        machine = Transducer.unpack(Transducer.build(terms).pack())
        assert [machine.lookup(t) for t in terms] == list(range(len(terms)))
        for _ in range(200):
            other = bytes(rng.choice(b"abcd\xc3") for _ in range(rng.randrange(9)))
            assert (machine.lookup(other) >= 0) == (other in terms)
        # As many states as there are different sets of endings.
        endings = defaultdict(set)
        for t in terms:
            for k in range(len(t) + 1):
                endings[t[:k]].add(t[k:])
        assert len(machine) == max(1, len({frozenset(e) for e in endings.values()}))


def test_all_terms_are_looked_up_at_once():
    rng = random.Random(9)
    for size in (0, 1, 2, 30, 400):
        terms = sorted({bytes(rng.choice(b"abc\xc3") for _ in range(rng.randrange(0, 8))) for _ in range(size)})
        machine = Transducer.unpack(Transducer.build(terms).pack())
        asked = [bytes(rng.choice(b"abcd\xc3\xff") for _ in range(rng.randrange(9))) for _ in range(300)] + terms
        assert machine.lookup_all(asked).tolist() == [machine.lookup(t) for t in asked]
        assert machine.lookup_all([]).tolist() == []


def test_terms_are_told_apart_as_texts_are_cut(monkeypatch):
    rng = random.Random(11)
    words = ["a", "Ab", "abc", "\u00f6l", "\u65e5\u672c", "x", "ZZ", "\0", "1", "-"]
    texts = ["", " ", "\0", *["".join(rng.choice(words) + rng.choice(["", " ", "  ", "9\n"]) for _ in range(rng.randrange(30))) for _ in range(50)]]
    expected_ = [TERM.findall(lower(t)) for t in texts]
    for piece in (1, 16, 4 << 20):
        monkeypatch.setattr(sa, "_PIECE", piece)
        found = [[] for _ in texts]
        for terms, code, row in sa.told([t.encode() for t in texts]):
            for i, k in zip(row.tolist(), code.tolist()):
                found[i].append(terms[k].decode())
        assert found == expected_
        for t, own in zip(texts, expected_):
            parts = [[terms[k].decode() for k in code.tolist()] for terms, code, _ in sa.told([t.encode()])]
            assert sum(parts, []) == own and (piece > 16 or len(own) < 40 or len(parts) > 1)


def test_python_meets_a_common_word_once_a_piece(monkeypatch):
    import pyarrow as pa

    class Shared:
        value = [("en", 0, b"common", Transducer.build([b"common"]).pack())]

    asked = []
    plain = Transducer.lookup_all
    monkeypatch.setattr(Transducer, "lookup", None)
    monkeypatch.setattr(Transducer, "lookup_all", lambda self, terms: asked.append(len(terms)) or plain(self, terms))
    n = 300
    texts = [b"Common " * 50 + b"rare" + b"e" * i for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * n, "source": ["a", "b", "a"] * (n // 3), "text": texts})
    out = [r for b in sa._streamed(Shared, sa.SHARD)(iter([batch])) for r in b.to_pylist()]
    assert sorted((r["source"], r["at"], r["n"]) for r in out) == [("a", 0, 10_000), ("b", 0, 5_000)]
    assert asked == [n + 1]


def test_counts_stay_whole_when_tasks_hand_them_on_early(monkeypatch):
    import pyarrow as pa

    docs = [(lang or "", source or "", (text or "").encode()) for lang, source, text in random_docs(200, 4)]
    batch = pa.RecordBatch.from_pydict({k: list(v) for k, v in zip(("lang", "source", "text"), zip(*docs))})
    words = {lang: {w for l, _, t in docs if l == lang for w in t.translate(sa._KEPT).split()} for lang in {d[0] for d in docs}}

    class Shared:
        value = []

    for lang, own in words.items():
        own = sorted(own)[::2]
        for k in range(0, len(own), 16):
            Shared.value.append((lang, k // 16, own[k], Transducer.build(own[k : k + 16]).pack()))

    def found(run, key):
        total = Counter()
        batches = list(run(iter([batch, batch])))
        for r in (r for b in batches for r in b.to_pylist()):
            total[tuple(r.get(k) for k in key)] += r["n"]
        return total, len(batches)

    runs = [(sa._streamed(Shared, 16), ("lang", "source", "at")), (sa._term_counts, ("lang", "source", "at")), (sa._document_counts, ("lang", "term"))]
    whole = [found(*r)[0] for r in runs]
    for name, least in (("CELLS", 4), ("ENTRIES", 2), ("_PIECE", 40)):
        monkeypatch.setattr(sa, name, least)
    cut = [found(*r) for r in runs]
    assert [c for c, _ in cut] == whole and min(n for _, n in cut) > 5
    assert sum(whole[1].values()) == 2 * sum(len(t.translate(sa._KEPT).split()) for _, _, t in docs)


def test_unsorted_terms_are_refused():
    with pytest.raises(ValueError):
        Transducer.build([b"b", b"a"])
