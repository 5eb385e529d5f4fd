"""Manifest of a dataset as a persistent hash tree of eight children a node.

Every row is a leaf; the leaves of a language, by ascending ``doc_id``, form a
tree, and the roots of the languages, ordered by name, form the tree above them.

1. Leaves are spread by *range* over (language, doc_id, leaf), so a language with
   most of the rows is many shares; a share's numbers begin where the shares
   before it end.
2. Aligned blocks of 512 neighbours (three levels) become one node each, until a
   tree is one node; every round leaves 1/512 of the rows.
3. From the top down every block gets the path above it: the siblings left and
   right of each ancestor.  A block's path is held once, not once per leaf.
4. In its block every changed leaf makes a *version*: a new root that shares all
   nodes with the original but for the ancestors of the leaf, which are copied
   (``changed``).  The version continues above the block by copying the nodes of
   the block's path, which no other task has to know of.

A run of eight or fewer nodes becomes the digest of their concatenated hex
digests; a last run of one is digested too, but a level with one node ends the
tree.  ``doc_id`` null comes first among the leaves, equal ids are ordered by
leaf, and equal rows have neighbouring places of their own.  A row with a null id
is never changed.  Null, empty and very long texts are leaves like others; the
language '' is not the null language.  An empty table gives an empty result.
Other columns than doc_id, source, lang, n_chars and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelake.storage import write_out

FAN = 8
# Levels in a block, and nodes at its bottom.
LEVELS = 3
BLOCK = FAN**LEVELS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATH = "path array<struct<before: string, after: string>>"
_NODE = "tree string, n bigint, at bigint, digest string"
_CARRIED = "doc_id bigint, fresh string, subroot string, root string"
_ROW = f"{_NODE}, {_CARRIED}, {_PATH}"
_VERSION = (
    "doc_id bigint, tree string, at bigint, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, "
    "copied array<string>, folded_root string"
)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """Digest of a row whose text is ``text``."""
    parts = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long"), text]
    return F.sha2(F.concat(*map(_field, parts)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def third_of_ids() -> Column:
    """Whether 3 divides the crc32 of the decimal id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0, F.lit(False))


# Nodes as (digest, children): versions share what they do not copy.
Node = tuple[str, tuple]


def grow(digests: list[str], n: int) -> list[Node]:
    """The nodes that stand above a block's digests in a tree of ``n`` nodes: one, or none where there is no digest."""
    import hashlib

    nodes: list[Node] = [(d, ()) for d in digests]
    for _ in range(LEVELS):
        if n == 1:
            break
        runs = [tuple(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        nodes = [(hashlib.sha256("".join(c[0] for c in run).encode()).hexdigest(), run) for run in runs]
        n = -(-n // FAN)
    return nodes


def height(n: int) -> int:
    """Levels of a block in a tree of ``n`` nodes."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // FAN), levels + 1
    return levels


def changed(root: Node, place: int, levels: int, digest: str) -> Node:
    """A version of the tree with another leaf: ancestors are copied, all else is shared."""
    import hashlib

    if levels == 0:
        return (digest, ())
    slot, rest = divmod(place, FAN ** (levels - 1))
    children = root[1]
    children = (*children[:slot], changed(children[slot], rest, levels - 1, digest), *children[slot + 1 :])
    return (hashlib.sha256("".join(c[0] for c in children).encode()).hexdigest(), children)


def path_of(root: Node, place: int, levels: int) -> list[tuple[str, str]]:
    """Siblings before and after each node from the leaf up to below the root."""
    path = []
    for level in range(levels - 1, -1, -1):
        slot, place = divmod(place, FAN**level)
        digests = [c[0] for c in root[1]]
        path.append(("".join(digests[:slot]), "".join(digests[slot + 1 :])))
        root = root[1][slot]
    return path[::-1]


def copied_of(root: Node, place: int, levels: int) -> list[str]:
    """Digests of the ancestors of a leaf, lowest first."""
    found = []
    for level in range(levels - 1, -1, -1):
        found.append(root[0])
        slot, place = divmod(place, FAN**level)
        root = root[1][slot]
    return found[::-1]


def continued(digest: str, path: list[tuple[str, str]]) -> list[str]:
    """Digests of the copies that a version adds along ``path``."""
    import hashlib

    found = []
    for before, after in path:
        digest = hashlib.sha256((before + digest + after).encode()).hexdigest()
        found.append(digest)
    return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Sorted rows, block by block."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["tree"], row["at"] // BLOCK if row["at"] >= 0 else -row["at"] - 1)
            if own != key:
                if rows:
                    yield rows
                key, rows = own, []
            rows.append(row)
    if rows:
        yield rows


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 2048:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


_STRING, _LONG = pa.string(), pa.int64()
_PATH_TYPE = pa.list_(pa.struct([("before", _STRING), ("after", _STRING)]))
_NODE_SCHEMA = pa.schema([("tree", _STRING), ("n", _LONG), ("at", _LONG), ("digest", _STRING)])
_ROW_SCHEMA = pa.schema(
    [*_NODE_SCHEMA, ("doc_id", _LONG), ("fresh", _STRING), ("subroot", _STRING), ("root", _STRING), ("path", _PATH_TYPE)]
)
_VERSION_SCHEMA = pa.schema(
    [
        ("doc_id", _LONG), ("tree", _STRING), ("at", _LONG), ("leaf", _STRING), ("subroot", _STRING), ("root", _STRING),
        ("proof", pa.list_(_STRING)), ("proof_sha256", _STRING), ("copied", pa.list_(_STRING)), ("folded_root", _STRING),
    ]
)


def _raise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One node of the next round for every block."""

    def nodes() -> Iterator[dict]:
        for rows in _blocks(batches):
            n = rows[0]["n"]
            top = grow([r["digest"] for r in rows], n)[0]
            yield {"tree": rows[0]["tree"], "n": -(-n // BLOCK), "at": rows[0]["at"] // BLOCK, "digest": top[0]}

    yield from _batches(nodes(), _NODE_SCHEMA)


def _opened(rows: list[dict]):
    """A block's own path row, its nodes, their tree and its levels."""
    above, own = rows[0], rows[1:]
    return above, own, grow([r["digest"] for r in own], own[0]["n"])[0], height(own[0]["n"])


def _lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path above every node of a block, as path rows of the blocks below."""

    def paths() -> Iterator[dict]:
        for rows in _blocks(batches):
            above, own, top, levels = _opened(rows)
            rest = [(p["before"], p["after"]) for p in above["path"]]
            for i, row in enumerate(own):
                path = [*path_of(top, i, levels), *rest]
                yield {
                    "tree": row["tree"], "n": None, "at": -row["at"] - 1, "digest": row["digest"], "doc_id": None,
                    "fresh": None, "subroot": above["subroot"], "root": above["root"],
                    "path": [{"before": b, "after": a} for b, a in path],
                }

    yield from _batches(paths(), _ROW_SCHEMA)


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proof and version of every leaf."""
    import hashlib

    def leaves() -> Iterator[dict]:
        for rows in _blocks(batches):
            above, own, top, levels = _opened(rows)
            rest = [(p["before"], p["after"]) for p in above["path"]]
            for i, row in enumerate(own):
                version = top if row["fresh"] is None else changed(top, i, levels, row["fresh"])
                higher = continued(version[0], rest)
                proof = [b + a for b, a in (*path_of(top, i, levels), *rest)]
                yield {
                    "doc_id": row["doc_id"], "tree": row["tree"], "at": row["at"], "leaf": row["digest"],
                    "subroot": above["subroot"], "root": above["root"], "proof": proof,
                    "proof_sha256": hashlib.sha256("".join(proof).encode()).hexdigest(),
                    "copied": [] if row["fresh"] is None else [*copied_of(version, i, levels), *higher],
                    "folded_root": (higher or [version[0]])[-1],
                }

    yield from _batches(leaves(), _VERSION_SCHEMA)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their number ``at`` within their tree by ``order`` and the tree's size ``n``; no tree is sorted in one task."""
    share = F.shiftright("_place", 33)
    sorted_ = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    spread = write_out(sorted_.withColumn("_place", F.monotonically_increasing_id()), "spread")
    # One row per share and tree.
    parts = spread.groupBy("tree", share.alias("_share")).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    per_tree = Window.partitionBy("tree").orderBy("_share")
    before = F.coalesce(F.sum("_n").over(per_tree.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(
        "tree", "_share", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy("tree")).alias("n")
    )
    numbered = spread.withColumn("_share", share).join(write_out(parts, "shares"), ["tree", "_share"])
    return numbered.withColumn("at", F.col("_place") + F.col("_shift")).drop("_place", "_share", "_shift")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Blocks whole in one task, a block's path row before its nodes."""
    path_row = F.col("at") < 0
    block = F.when(path_row, -F.col("at") - 1).otherwise(F.floor(F.col("at") / BLOCK))
    return rows.withColumn("_block", block).repartition("tree", "_block").sortWithinPartitions("tree", "_block", "at").drop("_block")


def ascend(bottom: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Node tables of every round, and the root of each tree with the round below it."""
    rounds, roots, nodes = [bottom], None, bottom.select("tree", "n", "at", "digest")
    while True:
        nodes = write_out(_in_blocks(nodes).mapInArrow(_raise, _NODE), "nodes")
        ended = nodes.filter("n = 1").select("tree", "digest", F.lit(len(rounds) - 1).alias("last"))
        roots = ended if roots is None else roots.union(ended)
        nodes = nodes.filter("n > 1")
        if nodes.isEmpty():
            return rounds, roots
        rounds.append(nodes)


def _joined(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    fields = [f.split()[:2] for f in (*_NODE.split(", "), *_CARRIED.split(", "))]
    own = [F.col(n) if n in nodes.columns else F.lit(None).cast(kind).alias(n) for n, kind in fields]
    return _in_blocks(nodes.select(*own, F.lit(None).cast(_PATH.split(" ", 1)[1]).alias("path")).union(paths))


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The bottom nodes of every tree with their blocks' path rows; ``tops`` has a path row for every tree."""
    paths = None
    for k in range(len(rounds) - 1, -1, -1):
        first = tops.filter(F.col("last") == k).drop("last")
        paths = first if paths is None else first.union(paths)
        if k:
            paths = write_out(_joined(rounds[k], paths).mapInArrow(_lower, _ROW), "paths")
    return _joined(rounds[0], paths)


def _tops(roots: DataFrame, subroot: Column, root: Column, path: Column) -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    return roots.select(
        "tree", null("bigint").alias("n"), F.lit(-1).cast("long").alias("at"), null("string").alias("digest"),
        null("bigint").alias("doc_id"), null("string").alias("fresh"), subroot.alias("subroot"), root.alias("root"),
        path.cast(_PATH.split(" ", 1)[1]).alias("path"), "last",
    )


def versions(docs: DataFrame, where: Column | None = None, change: Callable[[Column], Column] = lower_ascii) -> DataFrame:
    """One row per row of ``docs``: its leaf, place and proof, and the version made by changing its text.

    ``where`` says which rows are changed (default: ``third_of_ids``).  ``proof`` has the
    siblings of every level, ``copied`` the ancestors that the version does not share
    with the original, lowest first, and ``folded_root`` the version's root.
    """
    where = third_of_ids() if where is None else where
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    text = F.col("text")
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf(text).alias("digest"),
        F.when(where, leaf(change(text))).alias("fresh"), F.monotonically_increasing_id().alias("uid"),
    )
    bottom = write_out(placed(write_out(leaves, "leaves"), ["doc_id", "digest", "uid"]).drop("uid"), "placed")
    rounds, subroots = ascend(bottom)
    subroots = write_out(subroots, "subroots")
    # The tree of the languages.
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("language"), "digest", "last")
    upper = write_out(placed(named, ["language"]), "languages")
    upper_rounds, root = ascend(upper)
    highest = _tops(root, F.lit(None).cast("string"), F.col("digest"), F.array())
    above = descend(upper_rounds, highest).mapInArrow(_lower, _ROW)
    above = above.select((-F.col("at") - 1).alias("at"), F.col("digest").alias("subroot"), "root", "path")
    above = above.join(upper.select("at", F.col("language").alias("tree"), "last"), "at")
    tops = write_out(_tops(above, F.col("subroot"), F.col("root"), F.col("path")), "tops")
    return descend(rounds, tops).mapInArrow(_versions, _VERSION)


def audit(docs: DataFrame) -> DataFrame:
    """Leaf, roots, proof and the outcome of checking every third row with its letters lowered."""
    return versions(docs).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
