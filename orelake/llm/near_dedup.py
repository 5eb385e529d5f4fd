"""Near-duplicate classes by BagMinHash, banding and exact multiset overlap.

Two texts are linked when the weighted Jaccard similarity of their multisets of
five-word shingles is at least 0.8; a class is a connected component of links.

1. Every text gets a BagMinHash signature and a digest of its multiset.  Texts
   with one multiset are one *node*, so copies never meet in a bucket.
2. 25 bands of 4 registers put nodes in buckets; a pair at 0.8 misses all of
   them with a probability under 2e-6.
3. In each bucket the least node is the pivot, compared with every other node; one
   order of nodes for all buckets makes most of a node's pairs the same pair.
   Components are formed; a bucket that is one component by then is done, so n close
   texts cost about n comparisons.  In the others every node outside the largest component meets
   every node of another component, in blocks of bounded size inside the tasks:
   only pairs whose 16-bit elements reach the similarity leave them.
4. Pairs are verified by the overlap of the whole multisets.
5. Components by hooking every node to its least neighbour, pointer jumping and
   contraction: links within a component go and equal ones collapse, so the rows fall
   every round.  Links found in blocks join components, not nodes.  Each step is written
   to the shared folder.

Words are runs of characters outside space and tab..carriage return; a text of
one to four words is one shingle.  Null texts and texts without words have no
shingles and stay alone.  Repeated rows share a class.  Rows with a null id are
members like others; a class is named by its smallest id (null if it has none).
An empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm import rows as _rows
from orelake.storage import release, write_out

SIMILARITY = 0.8
# Nodes on either side of a block.
CHUNK = 512

_SIGNED = "_key string, _mark bigint, doc_id bigint, node binary, bands array<bigint>"


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]


def _pieces(texts: list[bytes]):
    """Per chunk: its texts' shingles and where each text's part begins."""
    import numpy as np

    from orelake.llm import bag_minhash

    for part in bag_minhash.chunks([len(t) for t in texts]):
        own = texts[part]
        owner, item, count = bag_minhash.shingles(own)
        yield own, owner, item, count, np.searchsorted(owner, np.arange(len(own) + 1))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    from orelake.llm import bag_minhash

    for batch in batches:
        nodes, bands = [], []
        for own, owner, item, count, cut in _pieces(_texts(batch)):
            keys = bag_minhash.bands(bag_minhash.signatures(owner, item, count, len(own))).view("int64")
            for i in range(len(own)):
                a, b = cut[i], cut[i + 1]
                if a == b:
                    nodes.append(None)
                    bands.append(None)
                else:
                    whole = item[a:b].tobytes() + count[a:b].astype("uint32").tobytes()
                    nodes.append(hashlib.blake2b(whole, digest_size=16).digest())
                    bands.append(keys[i])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_key"), batch.column("_mark"), batch.column("doc_id"), pa.array(nodes, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["_key", "_mark", "doc_id", "node", "bands"],
        )


def _multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of a node as six bytes each, their counts where any is over 1, and all elements as two bytes each."""
    import numpy as np

    from orelake.llm import bag_minhash

    for batch in batches:
        bags, counts, small = [], [], []
        for own, _, item, count, cut in _pieces(_texts(batch)):
            six = np.ascontiguousarray(item.view(np.uint8).reshape(-1, 8)[:, :6])
            for a, b in zip(cut[:-1], cut[1:]):
                bags.append(six[a:b].tobytes())
                more = count[a:b]
                counts.append(more.astype("uint32").tobytes() if more.max(initial=1) > 1 else b"")
                # The k-th copy of a shingle is an element of its own.
                copy = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
                small.append((bag_minhash.mix(np.repeat(item[a:b], more) + (copy.astype(np.uint64) << np.uint64(48))) & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(bags, pa.binary()), pa.array(counts, pa.binary()), pa.array(small, pa.binary())],
            ["node", "bag", "counts", "small"],
        )


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    def read(bag: bytes, counts: bytes):
        item = np.zeros((len(bag) // 6, 8), np.uint8)
        item[:, :6] = np.frombuffer(bag, np.uint8).reshape(-1, 6)
        item = item.view(np.uint64).ravel()
        return item, np.frombuffer(counts, "uint32").astype(np.int64) if counts else np.ones(len(item), np.int64)

    for batch in batches:
        found = []
        columns = [batch.column(c).to_pylist() for c in ("a_bag", "a_counts", "b_bag", "b_counts")]
        for a_bag, a_counts, b_bag, b_counts in zip(*columns):
            (a, m), (b, n) = read(a_bag, a_counts), read(b_bag, b_counts)
            both = np.concatenate([a, b])
            weight = np.concatenate([m, n])
            order = np.argsort(both, kind="stable")
            both, weight = both[order], weight[order]
            twice = np.flatnonzero(both[1:] == both[:-1])
            shared = np.minimum(weight[twice], weight[twice + 1]).sum()
            found.append(float(shared / (m.sum() + n.sum() - shared)))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "j"])


def signed(docs: DataFrame) -> DataFrame:
    """Row key, id, node and band keys of every row."""
    read = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"),
        F.xxhash64("text").alias("_mark"), F.col("doc_id").cast("long"), "text",
    )
    return read.mapInArrow(_sign, _SIGNED)


def _bags(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Multisets of the wanted nodes, from one row of each."""
    rows = _rows.once(docs).join(wanted, list(_rows.KEY)).select("node", F.col("_row.text").alias("text"))
    return rows.mapInArrow(_multisets, "node binary, bag binary, counts binary, small binary")


def _similarities(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    side = lambda x: bags.select(F.col("node").alias(x), F.col("bag").alias(f"{x}_bag"), F.col("counts").alias(f"{x}_counts"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_overlap, "a binary, b binary, j double")


def _star(state: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's pivot with its other nodes; nodes are digests, so the least one is any of them."""
    pivots = write_out(state.groupBy("bucket").agg(F.min("node").alias("pivot")), "pivots")
    met = state.join(pivots, "bucket").filter("node <> pivot")
    return met.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()


def _compare(similarity: float):
    """Rows sorted by group: every minor node of a group against its other rows, by matrix products.

    The 16-bit elements of two texts share at least as many as the texts do, so
    no pair at the similarity is missed.
    """

    def close(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        import numpy as np

        minor = [r for r in rows if r[1]]
        if not minor or len(minor) == len(rows):
            return []
        rest = [r for r in rows if not r[1]]
        shared = np.zeros((len(minor), len(rest)), np.float32)
        sides = []
        for side in (minor, rest):
            elements = [np.frombuffer(r[3], np.uint16) for r in side]
            sides.append((np.repeat(np.arange(len(side)), [len(e) for e in elements]), np.concatenate(elements)))
        known = np.intersect1d(sides[0][1], sides[1][1])
        for at in range(0, len(known), 4096):
            part = known[at : at + 4096]
            dense = []
            for (owner, element), side in zip(sides, (minor, rest)):
                place = np.minimum(np.searchsorted(part, element), len(part) - 1)
                hit = part[place] == element
                block = np.zeros((len(side), len(part)), np.float32)
                np.add.at(block, (owner[hit], place[hit]), 1)
                dense.append(block)
            if dense[0].max(initial=0) <= 1 or dense[1].max(initial=0) <= 1:
                # Where one side holds an element once, the lesser count is a product.
                shared += np.minimum(dense[0], 1) @ np.minimum(dense[1], 1).T
            else:
                top = int(min(dense[0].max(), dense[1].max()))
                for k in range(1, top + 1):
                    shared += (dense[0] >= k).astype(np.float32) @ (dense[1] >= k).astype(np.float32).T
        size = lambda side: np.array([len(r[3]) // 2 for r in side], np.float32)
        union = size(minor)[:, None] + size(rest)[None, :] - shared
        labels = np.unique([r[2] for r in [*minor, *rest]], return_inverse=True)[1]
        apart = labels[: len(minor), None] != labels[None, len(minor) :]
        i, j = np.nonzero(apart & (shared >= similarity * union - 1e-3))
        return [(min(minor[x][0], rest[y][0]), max(minor[x][0], rest[y][0])) for x, y in zip(i, j)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: set) -> pa.RecordBatch:
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        group, rows, found = None, [], set()
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("bucket", "i", "j")])
            data = zip(*[batch.column(c).to_pylist() for c in ("node", "minor", "label", "small")])
            for key, row in zip(keys, data):
                if key != group:
                    found.update(close(rows))
                    group, rows = key, []
                rows.append(row)
            if len(found) > 100_000:
                yield out(found)
                found = set()
        found.update(close(rows))
        yield out(found)

    return run


def _blocks(named: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Pairs between components that the buckets leave to be tested, found block by block.

    Every node outside a bucket's largest component meets every node of the
    bucket: both sides are cut into chunks of at most about ``CHUNK`` nodes, and a
    group holds one chunk of each.
    """
    parts = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("labels"), F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("largest")
    ).filter("labels > 1")
    chunks = lambda n: F.ceil(n / F.lit(CHUNK)).cast("int")
    mixed = mixed.select(
        "bucket", F.col("largest.label").alias("largest"), chunks(F.col("n")).alias("all_chunks"),
        chunks(F.col("n") - F.col("largest.n")).alias("minor_chunks"),
    )
    live = named.join(write_out(mixed, "mixed"), "bucket")
    chunk = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = live.select("bucket", "node", "label", F.lit(False).alias("minor"), chunk("all_chunks").alias("i"),
                        F.explode(F.sequence(F.lit(0), F.col("minor_chunks") - 1)).alias("j"))
    minor = live.filter("label <> largest").select(
        "bucket", "node", "label", F.lit(True).alias("minor"),
        F.explode(F.sequence(F.lit(0), F.col("all_chunks") - 1)).alias("i"), chunk("minor_chunks").alias("j"))
    rows = every.union(minor).join(bags.select("node", "small"), "node")
    sorted_ = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return sorted_.mapInArrow(_compare(similarity), "a binary, b binary").distinct()


def links(docs: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame | None:
    """Component labels (node, label) of the nodes that verified links connect; None when no bucket holds two nodes."""
    state = nodes.select("node", F.explode("bands").alias("bucket"))
    counts = write_out(state.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "counts")
    state = write_out(state.join(counts, "bucket", "left_semi"), "buckets")
    if state.isEmpty():
        return None
    wanted = nodes.join(state.select("node").distinct(), "node").select("node", "first._key", "first._mark")
    bags = write_out(_bags(docs, wanted), "bags")
    linked = lambda pairs: write_out(_similarities(pairs, bags).filter(F.col("j") >= similarity), "links")
    first = components(linked(_star(state)))
    named = write_out(state.join(first, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    rest = linked(_blocks(named, bags, similarity))
    if rest.isEmpty():
        return first
    # Links between components; a node that has been alone is its own component.
    name = lambda side: first.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
    lifted = rest.join(name("a"), "a", "left").join(name("b"), "b", "left")
    merged = components(lifted.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")))
    further = merged.select(F.col("node").alias("label"), F.col("label").alias("further"))
    whole = first.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label"))
    return write_out(whole.union(merged.join(first, "node", "left_anti").select("node", "label")), "labels")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the links: the least node of its component."""
    rows = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    edges, labels, known = write_out(rows(edges), "edges"), None, None
    while True:
        # The lower end of a link is the least neighbour of the higher one, or a candidate for it: chains only fall.
        hooks = write_out(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")), "hooks")
        if hooks.isEmpty():
            return labels if labels is not None else hooks
        while True:
            further = hooks.select(F.col("node").alias("label"), F.col("label").alias("further"))
            if hooks.join(further, "label", "left_semi").isEmpty():
                break
            jumped = hooks.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label"))
            shorter, hooks = hooks, write_out(jumped, "hooks")
            release(shorter)
        if labels is None:
            roots = edges.select(F.col("a").alias("node")).distinct().join(hooks, "node", "left_anti")
            labels = hooks.union(roots.select("node", F.col("node").alias("label")))
        else:
            further = hooks.select(F.col("node").alias("label"), F.col("label").alias("further"))
            labels = labels.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label"))
        before, labels = known, write_out(labels, "labels")
        known, contracted = labels, edges
        for end in ("a", "b"):
            lifted = hooks.select(F.col("node").alias(end), "label")
            contracted = contracted.join(lifted, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
        spent, edges = edges, write_out(rows(contracted), "edges")
        # The next round reads what this one has written.
        release(spent, hooks, *([before] if before is not None else []))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, class_id, class_size and whether its text stays."""
    marks = write_out(signed(docs), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_key", "_mark")
    nodes = write_out(
        marks.filter("node is not null").groupBy("node").agg(
            F.min(order).alias("first"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("n")
        ),
        "nodes",
    )
    label = links(docs, nodes, similarity)
    small = nodes.select("node", "first", "n")
    if label is not None:
        grouped = write_out(small.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
        per = write_out(grouped.groupBy("label").agg(F.min("first").alias("stay"), F.sum("n").alias("class_size")), "classes")
        small = grouped.join(per, "label").select("node", "stay", "class_size")
    else:
        small = small.select("node", F.col("first").alias("stay"), F.col("n").alias("class_size"))
    of_text = marks.select("_key", "_mark", "doc_id", "node")
    member = of_text.filter("node is not null").join(small, "node").select(
        "_key", "_mark", "doc_id", F.col("stay.doc_id").alias("class_id"), "class_size",
        ((F.col("_key") == F.col("stay._key")) & (F.col("_mark") == F.col("stay._mark"))).alias("kept"),
    )
    alone = of_text.filter("node is null").select(
        "_key", "_mark", "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    return member.union(alone)


def keep(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, all columns unchanged."""
    return _rows.keep(docs, classes(docs, similarity).filter("kept"))
