from __future__ import annotations

import hashlib
import random

import pytest

from orelake.llm import warc_archive as wa
from orelake.storage import new_path

SCHEMA = "page_id bigint, url string, html string, start string, digest string, value string"
FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 12\r\n\r\nhello"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


ROWS = [
    (1, "http://a/", "x" * 300),
    (2, "http://a/2", "x" * 300),
    (2, "http://a/2", "x" * 300),
    (3, None, None),
    (4, "http://a/ b\r\nX: y", "short"),
    (5, "", "short"),
    (6, "http://b/", f"text\r\n\r\n{FAKE * 40}"),
    (7, "http://b/", f"{FAKE}\r\n\r\n" * 50 + "\r\n"),
    (8, "http://b/" + "long" * 20_000, "ends with a line end " * 8 + "\r\n"),
    (9, "http://c/", "öä日本😀" * 40_000),
    (None, "http://d/", "n" * 200),
    (None, "http://d/", "n" * 200),
    (10, "http://e/", "n" * 200),
    (11, "http://f/", "WARC/1.1\r\n"),
    (12, "http://f/", "WARC/1.1\nno header" * 20),
]


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page_id), page_id)
    out, done = [], set()
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        stored = len(data) < 100 or html not in done
        done.add(html)
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if stored else "revisit", None if stored else first[html]))
    return sorted(out, key=str)


def test_archive_gives_every_page_back(spark):
    got = sorted((tuple(r) for r in wa.archived(pages(spark, ROWS)).collect()), key=str)
    assert got == expected(ROWS)


def test_payloads_urls_and_references(spark):
    path = new_path(spark, "warc-test")
    wa.write(pages(spark, ROWS), path)
    found = wa.read(spark, path).collect()
    assert len({r.record_id for r in found}) == len(ROWS)
    stored = {r.record_id: bytes(r.payload) for r in found if r.record_type == "response"}
    payloads = [(h or "").encode() for _, _, h in ROWS]
    assert sorted(stored.values()) == sorted([p for p in payloads if len(p) < 100] + list({p for p in payloads if len(p) >= 100}))
    for r in found:
        if r.record_type == "revisit":
            assert hashlib.sha256(stored[r.refers_to]).hexdigest() == r.digest and len(stored[r.refers_to]) == r.n_bytes
        else:
            assert hashlib.sha256(r.payload).hexdigest() == r.digest
    assert {r.target_uri for r in found if r.record_id.startswith("urn:orelake:4:")} == {"http://a/%20b%0D%0AX:%20y"}


def test_empty_table(spark):
    assert wa.archived(pages(spark, [])).collect() == []


def archive(spark, tmp_path, content: bytes, width: int = wa.RANGE):
    (tmp_path / "one.warc").write_bytes(content)
    return wa.candidates(spark, f"file://{tmp_path}", width)


def record(payload: bytes) -> bytes:
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return head + payload + b"\r\n\r\n"


@pytest.mark.parametrize("width", [wa.RANGE, 1000, 97])
def test_chain_rejects_records_inside_payloads(spark, tmp_path, width):
    rng = random.Random(5)
    content, real = b"", []
    for i in range(200):
        inner = b"".join(record(b"p" * rng.randrange(40)) for _ in range(rng.randrange(4)))
        # A false record that claims to reach to the next true one, so that both chains meet.
        payload = b"HTTP/1.1 200 OK\r\n\r\n" + inner + rng.choice([b"", b"\r\n", b"WARC/1.1\r\n", record(b"")[:-4]])
        real.append(len(content))
        content += record(payload)
    found = archive(spark, tmp_path, content, width)
    assert found.count() > 300
    assert sorted(r.start for r in wa.verified(found).collect()) == real


def test_truncated_and_foreign_files(spark, tmp_path):
    good = record(b"HTTP/1.1 200 OK\r\n\r\nabc")
    cut = archive(spark, tmp_path, good + good + good[:-9])
    assert sorted(r.start for r in wa.verified(cut).collect()) == [0, len(good)]
    other = tmp_path / "other"
    other.mkdir()
    assert wa.verified(archive(spark, other, b"junk\r\n" + good)).collect() == []


def test_numbers_answer_what_is_reached():
    rng = random.Random(1)
    for _ in range(50):
        starts = sorted(rng.sample(range(1000), 40))
        following = [rng.choice([s for s in (*starts, 1500, 1600) if s > start]) for start in starts]
        exits, low, high = wa.numbered(starts, following)
        after = dict(zip(starts, following))
        for i, start in enumerate(starts):
            chain = [start]
            while chain[-1] in after:
                chain.append(after[chain[-1]])
            assert exits[i] == chain[-1]
            assert {s for j, s in enumerate(starts) if low[j] <= low[i] < high[j]} == set(chain[:-1])


def test_jumps_over_many_ranges(spark):
    """A chain over 300 ranges beside false ones; jumps double, so it takes few rounds."""
    rng = random.Random(2)
    rows, real = [], []
    for k in range(300):
        base = k * 1000
        inside = sorted(rng.sample(range(base, base + 1000), 6))
        true = inside[0] if k else 0
        inside[0] = true
        real.append(true)
        rows.append((k, inside))
    nodes, after = [], {}
    for k, inside in rows:
        nxt = real[k + 1] if k + 1 < len(real) else 300_000
        following = [nxt] + [rng.choice([nxt, nxt + 7, 999_999]) for _ in inside[1:]]
        exits, low, high = wa.numbered(inside, following)
        nodes += [("f", 300_000, k, s, 1, f, e, lo, hi) for s, f, e, lo, hi in zip(inside, following, exits, low, high)]
    found = spark.createDataFrame(nodes, wa._CANDIDATE)
    assert sorted(r.start for r in wa.verified(found).collect()) == real
