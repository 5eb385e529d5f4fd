"""Quality rules as a bitmask ledger, in DataFrame and SQL functions only.

``ledger`` measures every whole text once, evaluates every rule once and stores
the measurements with one failure bit per rule.  Policies are versioned masks:
``apply_policy`` decides from the stored bits, and ``ablation`` compares
policies and rules by bitwise aggregation, without reading a text again.

Words are runs of characters outside space and tab..carriage return.  Null and
empty texts have no words and fail ``too_few_words``.  Rows are judged one by
one, so repeated rows, ties and empty tables need no care; input columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.rows import settled

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
# Windows of this many words count as repeated when found twice or more.
WINDOW = 3

# Bit i of ``failed_bits`` is rule i.  Rules read measurements only.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbol_heavy", "10 * n_symbols > 3 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
)
BASE = ("too_few_words", "repeated_words")
# A policy names the rules it enforces; a published version never changes.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbol_heavy", "word_length"),
    "v3": (*BASE, "symbol_heavy", "word_length", "repeated_lines"),
}
DEFAULT_POLICY = "v2"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

_BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def mask(rules: tuple[str, ...]) -> int:
    return sum(_BIT[name] for name in rules)


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` from the word array ``_words``.

    Windows are sorted by their hash, then their words, then their position, so
    that equal windows are neighbours in texts of every size, whatever the hash.
    """
    parts = [f"get(_words, i + {k}) as w{k}" for k in range(WINDOW)]
    hashed = ", ".join(f"get(_words, i + {k})" for k in range(WINDOW))
    df = df.withColumn(
        "_windows",
        F.expr(
            f"""sort_array(transform(
                  slice(_words, 1, greatest(size(_words) - {WINDOW - 1}, 0)),
                  (w, i) -> struct(xxhash64({hashed}) as h, {", ".join(parts)}, i as at)))"""
        ),
    )
    same = " AND ".join(f"a.{x} = b.{x}" for x in ("h", *[f"w{k}" for k in range(WINDOW)]))
    df = df.withColumn(
        "_found",
        F.expr(
            f"""flatten(filter(
                  zip_with(_windows, slice(_windows, 2, greatest(size(_windows) - 1, 0)),
                    (a, b) -> if({same}, array(a.at, b.at), null)),
                  x -> x is not null))"""
        ),
    )
    covered = ", ".join(f"p + {k}" for k in range(WINDOW))
    return df.withColumn(
        "n_repeat_words",
        F.expr(f"cast(size(array_distinct(flatten(transform(array_distinct(_found), p -> array({covered}))))) as bigint)"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the measurements and ``failed_bits``."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    df = df.select(
        "doc_id",
        F.trim(F.regexp_replace("_text", SPACE, " ")).alias("_plain"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.expr(r"filter(split(_text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')").alias("_lines"),
    )
    df = df.select(
        "*", F.expr("if(_plain = '', cast(array() as array<string>), split(_plain, ' '))").alias("_words")
    ).withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": (F.length("_plain") - F.greatest(F.size("_words") - 1, F.lit(0))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    df = _repeat_words(df).select("doc_id", *MEASURES)
    failed = F.lit(0).cast("long")
    for name, rule in RULES:
        failed = failed.bitwiseOR(F.when(F.expr(rule), F.lit(_BIT[name])).otherwise(F.lit(0)).cast("long"))
    return df.withColumn("failed_bits", failed)


def apply_policy(marked: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """Add ``base_failed``, ``policy`` and ``kept`` from the stored bits."""
    bits = F.col("failed_bits")
    return marked.withColumns(
        {
            "base_failed": bits.bitwiseAND(F.lit(mask(BASE))) != 0,
            "policy": F.lit(version),
            "kept": bits.bitwiseAND(F.lit(mask(POLICIES[version]))) == 0,
        }
    )


def ablation(marked: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: rows that fail it, that fail only it, and that come back without it.

    Rows are first counted per bit pattern, of which there are at most 2 ** rules.
    """
    rules = POLICIES[version]
    patterns = marked.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    hit = F.col("failed_bits").bitwiseAND(F.lit(mask(rules)))
    figures = []
    for name in rules:
        figures += [
            F.sum(F.when(hit.bitwiseAND(F.lit(_BIT[name])) != 0, F.col("n")).otherwise(0)).alias(f"{name}_failed"),
            F.sum(F.when(hit == _BIT[name], F.col("n")).otherwise(0)).alias(f"{name}_alone"),
        ]
    totals = patterns.agg(F.sum("n").alias("rows"), F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("kept"), *figures)
    parts = ", ".join(f"'{n}', {n}_failed, {n}_alone" for n in rules)
    return totals.selectExpr("rows", "kept", f"stack({len(rules)}, {parts}) as (rule, failed, failed_alone)").selectExpr(
        f"'{version}' as policy", "rule", "coalesce(rows, 0) as rows", "coalesce(kept, 0) as kept",
        "coalesce(failed, 0) as failed", "coalesce(kept + failed_alone, 0) as kept_without",
    )


def keep(docs: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """Rows of ``docs`` that the policy keeps, all columns unchanged.

    The ledger rides along with its row, so no join is needed and rows with
    equal ids stay apart.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("doc_id"), F.col("text"))
    kept = settled(apply_policy(ledger(packed), version).select("doc_id", "kept"), "kept").filter("kept")
    return kept.select(*[F.col("doc_id").getField(n).alias(n) for n in names])
