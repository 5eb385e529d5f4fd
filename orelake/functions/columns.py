"""Column expressions shared by the operators.  All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orelake.constants import LOWEST_BAND, LOWEST_TIER, RATE_BANDS, TIERS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("int")


def guarded_ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom, 0.0 where bottom is not positive (ANSI division raises)."""
    return F.when(col(bottom) > 0, col(top) / col(bottom)).otherwise(F.lit(0.0))


def percent(part: Column | str, whole: Column | str, digits: int) -> Column:
    """Rounded share in percent as a double; NULL for an empty whole."""
    share = F.lit(100.0) * col(part).cast("double") / F.nullif(col(whole).cast("double"), F.lit(0.0))
    return F.round(share, digits)


def rounded_avg(c: Column | str, digits: int) -> Column:
    return F.round(F.avg(col(c).cast("double")), digits)


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation over rows where both are set; NULL for a constant (``corr`` raises there in ANSI mode)."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.covar_pop(xs, ys) / F.nullif(F.stddev_pop(xs) * F.stddev_pop(ys), F.lit(0.0))


def parse_timestamp(text: Column | str, pattern: str) -> Column:
    """Strict parse by pattern; text that does not match gives NULL."""
    return F.try_to_timestamp(col(text), F.lit(pattern))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end (23:59 to 00:01 counts as one)."""
    return F.datediff(col(end), col(start))


def letter_bucket(c: Column | str) -> Column:
    """First letter in upper case, a key with few values to partition by."""
    return F.upper(F.substring(col(c), 1, 1))


def prefixed(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(prefix), col(c))


def last_part(c: Column | str, separator: str = r"\.") -> Column:
    """The text after the last separator, the whole text without one."""
    return F.element_at(F.split(col(c), separator), -1)


def short_label(group: Column | str, name: Column | str) -> Column:
    return F.concat(col(group), F.lit(" • "), last_part(name))


def head_text(c: Column | str, length: int = 30) -> Column:
    return F.substring(col(c), 1, length)


def steps(value: Column | str, cuts: Sequence[tuple[float, str]], otherwise: str, strict: bool = False) -> Column:
    """Label of the first cut the value reaches; NULL takes the last label."""
    value = col(value)
    chain = None
    for limit, label in cuts:
        hit = value > limit if strict else value >= limit
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def priority_tier(score: Column | str) -> Column:
    return steps(score, TIERS, LOWEST_TIER)


def rate_band(rate: Column | str) -> Column:
    return steps(rate, RATE_BANDS, LOWEST_BAND, strict=True)


def hash_number(seed: int, *keys: Column | str) -> Column:
    """A 32-bit number that depends only on the seed and the key text."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
