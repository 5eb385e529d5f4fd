from __future__ import annotations

import collections
import random
import re

import edge
import numpy as np
import pytest

from orelake.llm import kneser_ney, page_text, personal_data, piece_sampling, string_kernel, toxicity
from orelake.llm.piece_lattice import Sampler, Vocabulary


# --- SentencePiece -----------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(piece_sampling.MODEL)


def test_round_trip_and_columns(spark):
    docs = edge.rows(spark)
    out = piece_sampling.decode(piece_sampling.encode(docs))
    assert out.columns == [*docs.columns, "pieces", "decoded"]
    assert all(r.decoded == (r.text or "") and (len(r.pieces) == 0) == (not r.text) for r in out.collect())
    assert piece_sampling.decode(piece_sampling.encode(edge.empty(spark))).count() == 0


def test_samples_depend_on_row_key_and_seed_only(spark):
    docs = edge.rows(spark, [(i, edge.TEXTS[4][1], "en") for i in range(40)])
    first = {r.doc_id: r.pieces for r in piece_sampling.encode(docs.repartition(1)).collect()}
    again = {r.doc_id: r.pieces for r in piece_sampling.encode(docs.repartition(7)).collect()}
    other = {r.doc_id: r.pieces for r in piece_sampling.encode(docs, seed=1).collect()}
    assert first == again and first != other and len({tuple(p) for p in first.values()}) > 30


def test_draws_follow_path_weights(vocabulary):
    sampler = Sampler(vocabulary)
    index = {p: i for i, p in enumerate(vocabulary.pieces) if p}

    def paths(text):
        if not text:
            yield (), 0.0
        for k in range(1, len(text) + 1):
            if text[:k] in index:
                for rest, cost in paths(text[k:]):
                    yield (index[text[:k]], *rest), cost + sampler.cost[index[text[:k]]]

    known = list(paths(" hello"))
    weight = np.exp([c for _, c in known])
    weight /= weight.sum()
    n = 40_000
    pieces, sizes = sampler.encode(list(range(n)), ["hello"] * n)
    ends = np.append(0, np.cumsum(sizes))
    seen = collections.Counter(tuple(pieces[ends[i] : ends[i + 1]].tolist()) for i in range(n))
    assert set(seen) <= {p for p, _ in known}
    assert max(abs(seen[p] / n - w) for (p, _), w in zip(known, weight)) < 0.01


def test_segments_are_asked_for_once_a_piece(vocabulary):
    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

    sampler = Sampler(vocabulary)
    sampler.young.known = Counted()
    sampler.encode([1], ["more of the same " * 5_000])
    # Five segments: the last blank is one of its own.
    assert Counted.asked <= 10


def test_cut_texts_give_the_same_pieces(vocabulary, monkeypatch):
    texts = ["", "a  b \n\n c\n", "word " * 300 + "  \n", "x" * 90, "\u4f60\u597d \U0001f600 " * 40, "   ", "\n", "end"]
    whole, sizes = Sampler(vocabulary).encode(list(range(8)), texts)
    for chunk in (1, 7, 64):
        monkeypatch.setattr("orelake.llm.piece_lattice._CHUNK", chunk)
        sampler = Sampler(vocabulary)
        found, own = sampler.encode(list(range(8)), texts)
        assert found.tolist() == whole.tolist() and own.tolist() == sizes.tolist()
        assert sampler.lossless(found, own, texts) == [True] * 8
        assert sampler.lossless(found, own, [*texts[:7], "and"]) == [True] * 7 + [False]


# --- personal data -----------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind: str, s: str) -> bool:
    d = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(sum(divmod(x * 2, 10)) if i % 2 else x for i, x in enumerate(d[::-1])) % 10 == 0
    return kind != "phone" or 10 <= len(d) <= 15


def test_base_spans_match_the_patterns():
    machine = personal_data.automaton()
    rng = random.Random(1)
    texts = ["".join(rng.choice("a.@-+1234567890 ()%b") for _ in range(rng.randint(0, 60))) for _ in range(20_000)]
    texts += ["4111 1111 1111 1111 x 1.2.3.4.5.6.7.8 +1 (222) 333-4444", "a@b.c@d.e", "300.1.1.1 1.1.1.1", "😀 x@y.zz", "1" * 5000]
    for text in texts:
        want = sorted(
            ((m.start(), m.end(), k) for k, p in BASE.items() for m in re.finditer(p, text) if holds(k, m[0])),
            key=lambda s: (s[0], list(BASE).index(s[2])),
        )
        assert [s for s in personal_data.spans(text, machine) if s[2] in BASE] == want


def test_added_kinds():
    machine = personal_data.automaton()
    found = lambda t: [(t[a:b], k) for a, b, k in personal_data.spans(t, machine) if k not in BASE]
    assert found("pay IBAN: DE89 3704 0044 0532 0130 00 now") == [("DE89 3704 0044 0532 0130 00", "iban")]
    assert found("pay IBAN: DE88 3704 0044 0532 0130 00 now") == []
    assert found("at 12 Main Street, or Hauptstraße 5, or rue de Lyon 14b") == [("12 Main Street", "address"), ("Hauptstraße 5", "address"), ("rue de Lyon 14b", "address")]
    assert found("see https://a.b/c?d=1. ok") == [("https://a.b/c?d=1", "url")]
    assert found("ciónuearue 53") == []


def test_identifiers_accounts_and_secrets_after_their_cues():
    machine = personal_data.automaton()
    found = lambda t: [(t[a:b], k) for a, b, k in personal_data.spans(t, machine) if k not in BASE]
    for text, want in (
        ('token = "04dbebab91ab85687d33"', [("04dbebab91ab85687d33", "secret")]),
        ("db_password: hunter2!x, next", [("hunter2!x", "secret")]),
        ("Bearer eyJhbGciOi.JIUzI1NiJ9", [("eyJhbGciOi.JIUzI1NiJ9", "secret")]),
        ("passport 123456789", [("123456789", "identifier")]),
        ("Passport No: X1234567 AND more", [("X1234567", "identifier")]),
        ("ssn 078-05-1120", [("078-05-1120", "identifier")]),
        ("account no. 1234 5678 90 and", [("1234 5678 90", "account")]),
        ("12 " + "a" * 300 + " Street", [("12 " + "a" * 300 + " Street", "address")]),
        ("the secret is nothing special; tokens are good; secret: alphabet", []),
        ("account of 1999 people, my account 12, accountable 123456", []),
    ):
        assert found(text) == want, text


def test_cues_in_a_row_take_linear_time():
    import time

    machine = personal_data.automaton()
    for cue in ("strasse", "rue", "12 street ", "rue a ", "token=", "passport 1 ", "account"):
        started = time.process_time()
        personal_data.spans(cue * (1_000_000 // len(cue)), machine)
        assert time.process_time() - started < 20, cue


def test_personal_data_edge_rows(spark):
    out = personal_data.digest(personal_data.find(edge.rows(spark)))
    assert out.count() == len(edge.TEXTS) and {r.n_email for r in out.collect()} == {0}
    assert personal_data.find(edge.empty(spark)).count() == 0


# --- page text ---------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>t</title></head><body></body></html>", ""),
        ("just text", "just text"),
        ("<p>one<p>two  \n three", "one\ntwo three"),
        ("<p>a &lt; b &amp; c&nbsp;d &am</p>", "a < b & c d &am"),
        ("<nav><a href='/x'>menu</a></nav><article><h1>T</h1><p><b>x.<br><p>y</article><footer>f</footer>", "T\nx.\ny"),
        ("<article><p>x</p><section id='comments'><p>bad</p></section><p>y</p></article>", "x\ny"),
        ('<script>var t="</p>";</script><style>p{}</style><article><p>x</p></article>', "x"),
        ("<div class='sidebar'>s s s s s s s s s</div><div><p>long text here and more</p><ul><li>i<li>j</ul></div>", "long text here and more\ni\nj"),
        ("<main><p>in <a href='x'>a link</a> too</p><form>q</form></main><aside>no</aside>", "in a link too"),
        ("<!-- <p>no</p> --><article>bare <i>text</i><p>p</p>end", "bare text\np\nend"),
    ],
)
def test_main_text(page, text):
    assert page_text.main_text(page) == text


def test_deep_and_long_pages():
    assert page_text.main_text("<div>" * 3000 + "<p>x</p>") == "x"
    assert len(page_text.main_text("<article>" + "<p>word word</p>" * 20_000)) == 20_000 * 10 - 1


def test_page_table(spark):
    pages = spark.createDataFrame([(1, None, None, "z"), (1, "u", "<p>a", "z")], "page_id bigint, url string, html string, text string")
    assert sorted(map(tuple, page_text.extract(pages).select("page_id", "text").collect())) == [(1, ""), (1, "a")]
    assert page_text.extract(pages.limit(0)).count() == 0


# --- Kneser-Ney --------------------------------------------------------------


def test_quality_edge_rows(spark):
    docs = edge.rows(spark)
    trusted = kneser_ney.trusted_ids(edge.labels(spark, [(5, 1, 0), (6, 1, 0), (6, 1, 0), (8, 1, 0), (4, 0, 0), (None, 1, 0)]))
    got = kneser_ney.judge(docs, trusted).collect()
    assert len(got) == len(edge.TEXTS)
    none = [r for r in got if r.doc_id in (1, 2)]
    assert all(r.perplexity is None and not r.kept for r in none)
    assert {r.kept for r in got if r.doc_id in (5, 6, 8)} == {True}
    assert kneser_ney.judge(edge.empty(spark), trusted).count() == 0
    untrained = kneser_ney.judge(docs, trusted.limit(0)).filter("doc_id = 5").first()
    assert untrained.kept and abs(untrained.perplexity - 32) < 1e-3


# --- toxicity ----------------------------------------------------------------


def test_kernel_matches_the_definition():
    def phi(word, order):
        import itertools

        word = string_kernel.START + word + string_kernel.END
        out = collections.Counter()
        for at in itertools.combinations(range(len(word)), order):
            if at[-1] - at[0] < string_kernel.SPAN:
                out[tuple(string_kernel._CLASS.get(word[i], 0) for i in at)] += string_kernel.DECAY ** (at[-1] - at[0] + 1)
        return out

    def kernel(a, b):
        total = 0.0
        for order in string_kernel.ORDERS:
            x, y = phi(a, order), phi(b, order)
            dot = lambda u, v: sum(u[k] * v[k] for k in u)
            total += dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5 if x and y else 0.0
        return total / len(string_kernel.ORDERS)

    words, marks = ["idiot", "idixot", "i.diot", "banana", "ab"], ["idiot", "nab"]
    got = string_kernel._against(words, marks)
    assert np.allclose(got, [[kernel(a, b) for b in marks] for a in words], atol=1e-4)


@pytest.fixture(scope="module")
def taught():
    rng = random.Random(0)
    syllables = ["ta", "no", "er", "li", "sum", "re", "ok", "an"]
    clean = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))
    texts, toxic = [], []
    for i in range(600):
        y = int(i % 6 == 0)
        words = clean(rng.randint(20, 80)).split()
        if y:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "dimwit", "numbskull"]))
        texts.append(" ".join(words))
        toxic.append(y)
    return texts, toxic


def test_gapped_and_inserted_spellings(taught):
    model = toxicity.learn(*taught)
    names = ["blockhead", "bl0ckhead", "block-head", "blockxhead", "dimmwit", "numb.skull", "tanoer", "lisum", "oker"]
    score = dict(zip(names, model.machine.score([string_kernel.normal(w) for w in names])))
    assert min(score[w] for w in names[:6]) > max(score[w] for w in names[6:])


def test_held_out_accuracy_and_edge_rows(spark, taught):
    texts, toxic = taught
    docs = edge.rows(spark, [*[(i, t, "en") for i, t in enumerate(texts)], (5000, None, "en"), (None, "dimwit", "en"), (5001, edge.LONG, "en")])
    out = toxicity.judge(docs, edge.labels(spark, [(i, 1, y) for i, y in enumerate(toxic)])).collect()
    assert len(out) == len(texts) + 3 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 5000]
    assert len(held) > 80 and all(r.predicted == toxic[r.doc_id] for r in held)
    assert not [r for r in out if r.doc_id == 5000][0].predicted
    again = toxicity.judge(edge.empty(spark), edge.labels(spark, [(1, 1, 1)]))
    assert again.count() == 0
    assert {r.score for r in toxicity.judge(docs.limit(5), edge.labels(spark, [])).collect()} == {0.0}
