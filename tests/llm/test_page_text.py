"""Main text against a plain computation of density, sum and threshold, and pages with comments and forms."""

from __future__ import annotations

import math
import random

from orelake.llm import page_text

ARTICLE = "<p>" + "This is the article text that goes on for a while. " * 6 + "</p>"
READERS = "<p>" + "Reader prose here which is rather long and dense too. " * 20 + "</p>"


def random_tree(rng: random.Random, depth: int):
    """(tag, children); children are texts and trees."""
    children = []
    for _ in range(rng.randrange(1, 5)):
        kind = rng.random()
        if kind < 0.4 or depth == 0:
            children.append(" ".join(rng.choice(["a", "word", "longerword", "text"]) for _ in range(rng.choice([1, 3, 40]))))
        elif kind < 0.6:
            children.append(("a", [" ".join(["link"] * rng.randrange(1, 9))]))
        else:
            children.append(random_tree(rng, depth - 1))
    return (rng.choice(["div", "section", "blockquote"]), children)


def as_html(node) -> str:
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(as_html, node[1]))}</{node[0]}>"


def expected(root) -> str:
    """Everything counted anew for every node, from the definition."""

    def figures(node):
        if isinstance(node, str):
            return len(node), 0, 0, 0
        parts = [figures(c) for c in node[1]]
        chars, tags, link_chars, link_tags = (sum(p[k] for p in parts) for k in range(4))
        return (chars, tags + 1, chars, link_tags + 1) if node[0] == "a" else (chars, tags + 1, link_chars, link_tags)

    body = figures(root)

    def score(chars, tags, link_chars, link_tags):
        if chars == 0:
            return 0.0
        inner = math.log(max(chars / max(chars - link_chars, 1) * link_chars + body[2] / max(body[0], 1) * chars + math.e, math.e))
        return chars / tags * math.log(chars / max(link_chars, 1) * tags / max(link_tags, 1)) / math.log(max(inner, math.e))

    def density(node):
        return score(len(node), 1, 0, 0) if isinstance(node, str) else score(*figures(node))

    def total(node):
        own = sum(len(c) for c in node[1] if isinstance(c, str))
        return sum(density(c) for c in node[1] if not isinstance(c, str)) + (0 if node[0] == "a" else score(own, 1, 0, 0))

    def paths(node, above=()):
        yield (*above, node)
        for c in node[1]:
            if not isinstance(c, str):
                yield from paths(c, (*above, node))

    every = list(paths(root))
    best = max(every, key=lambda path: total(path[-1]))
    threshold = min(density(n) for n in best)
    taken = [best[-1]] + [c for on, parent in zip(best[1:], best) for c in parent[1] if c is not on and density(c) >= threshold > 0]
    lines, current = [], []

    def end():
        if "".join(current).split():
            lines.append(" ".join("".join(current).split()))
        current.clear()

    def walk(node, whole, parent=None):
        whole = whole or any(node is t for t in taken)
        if isinstance(node, str):
            if whole:
                current.append(node)
            return
        # A link is part of the line that it stands in.
        if node[0] != "a":
            end()
        for c in node[1]:
            walk(c, whole)
        if node[0] != "a":
            end()

    walk(root, False)
    end()
    return "\n".join(lines)


def test_main_text_matches_the_definition_on_random_trees():
    rng = random.Random(4)
    seen = set()
    for _ in range(400):
        # Texts differ, so that the place of each is told apart.
        count = iter(range(10**6))

        def marked(node):
            return f"{node} {next(count)}" if isinstance(node, str) else (node[0], [marked(c) for c in node[1]])

        root = marked(("body", [random_tree(rng, 4) for _ in range(3)]))
        # Neighbouring texts of a parent are one text of the page.
        def joined(node):
            if isinstance(node, str):
                return node
            out = []
            for c in map(joined, node[1]):
                if isinstance(c, str) and out and isinstance(out[-1], str):
                    out[-1] += " " + c
                else:
                    out.append(c)
            return (node[0], out)

        root = joined(root)
        want = expected(root)
        assert page_text.main_text(as_html(root)) == want
        seen.add(len(want.split("\n")))
    assert len(seen) > 5


def test_reader_comments_go_and_the_article_stays():
    article = page_text.main_text(ARTICLE)
    for page in (
        f"<div>{ARTICLE}</div><div class='comments'>{READERS}</div>",
        f"<article>{ARTICLE}</article><div class='comments'>{READERS}</div>",
        f"<article>{ARTICLE}<section class='comments'>{READERS}</section></article>",
        f"<article class='comment'>{READERS}</article><div>{ARTICLE}</div>",
        f"<div>{ARTICLE}</div><ol class='comment-list'><li><article>{READERS}</article></li></ol>",
        f"<div class='has-comments'>{ARTICLE}</div>",
        f"<div class='page-with-comments'>{ARTICLE}<div id='disqus_thread'>{READERS}</div></div>",
    ):
        assert page_text.main_text(page) == article, page[:60]
    # Where nothing else is left, and around the page's heading, the name decides nothing.
    assert page_text.main_text(f"<div class='comments'>{READERS}</div>") == page_text.main_text(READERS)
    assert page_text.main_text(f"<div class='comments'><h1>T</h1>{ARTICLE}</div>") == "T\n" + article


def test_a_form_around_the_page_is_a_wrapper():
    article = page_text.main_text(ARTICLE)
    assert page_text.main_text(f"<form action='x'>{ARTICLE}<input name='a'><button>Go</button></form>") == article
    assert page_text.main_text(f"<form>Your name and mail <input></form><div>{ARTICLE}</div>") == article
    assert page_text.main_text("<form>Sign in here</form>") == ""


def _prose(word, n):
    return " ".join([word] * n)


def test_density_decides_beyond_one_article():
    part = lambda w: f"<p>{_prose(w, 40)}</p>"
    links = "<div>" + "".join(f"<a href='/{i}'>go {i}</a>" for i in range(12)) + "</div>"
    text = lambda *words: "\n".join(_prose(w, 40) for w in words)
    inner = "<article>" + part("card") * 3 + "</article>"
    nested = f"{links}<article>{part('outer')}{inner}{part('after')}</article>{links}"
    assert page_text.main_text(nested) == text("outer", "card", "card", "card", "after")
    siblings = f"{links}<section><article>{part('one') * 3}</article><article>{part('two') * 2}</article></section>{links}"
    assert page_text.main_text(siblings) == text("one", "one", "one", "two", "two")
    bare = f"{links}<div>{_prose('bare', 40)}<div>{part('in') * 3}</div></div>{links}"
    assert page_text.main_text(bare) == text("bare", "in", "in", "in")


def test_class_words_alone_remove_nothing():
    body = "".join(f"<p>{_prose(w, 40)}</p>" for w in ("one", "two", "three"))
    text = "\n".join(_prose(w, 40) for w in ("one", "two", "three"))
    for name in ("content with-sidebar", "no-sidebar", "has-comments", "page-with-menu"):
        assert page_text.main_text(f"<div class='{name}'>{body}</div>") == text
    assert page_text.main_text(f"<article>{body}<section id='related-work'><p>{_prose('four', 40)}</p></section></article>").endswith("four")
    assert _prose("five", 40) in page_text.main_text(f"<article><p class='notice'>{_prose('five', 40)}</p>{body}</article>")
    assert page_text.main_text(f"<article><p data-id='menu' data-class='ad'>x y</p>{body}</article>") == "x y\n" + text
    assert page_text.main_text(f"<article><p title=' class=ad '>x y</p>{body}</article>") == "x y\n" + text
    # What holds little or links still goes.
    links = "".join(f"<a href='/{i}'>{_prose('link', 9)}</a>" for i in range(5))
    assert page_text.main_text(f"<article>{body}<div class='related'>{links}</div><p class='ad'>Buy now</p></article>") == text
    assert page_text.main_text(f"<article><p>a <span class='ad'>b <span>c</span> d</span> e</p>{body}</article>") == "a e\n" + text
