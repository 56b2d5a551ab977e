"""Column helpers.  All are built-in Spark expressions (JVM side, inside
whole-stage codegen); no Python UDF anywhere in the library."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "lit_date", "ts_lit", "price_date_range", "py_strip", "distinct_days",
    "equity_shape", "letters_shape", "is_us_listing", "rank_by",
    "guarded_ratio", "pct_return_2dp", "round_avg",
    "coverage_class_short", "coverage_class_long", "label_or",
    "CLEAN_TOKENS_DB", "CLEAN_TOKENS_PROFILE",
]

# --- fixed values ----------------------------------------------------------
# Text treated as missing by the profile writer (case-insensitive, after strip).
CLEAN_TOKENS_DB = ("null", "none", "n/a", "na", "unknown")
# Smaller list used by the second profile vendor's mapper.
CLEAN_TOKENS_PROFILE = ("none", "null", "n/a")
# ---------------------------------------------------------------------------

# Python's str.strip() removes Unicode whitespace; Spark's trim() only spaces.
_STRIP_RE = r"(?U)^\s+|\s+$"


def lit_date(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def ts_lit(t: dt.datetime | None) -> Column:
    """A timestamp literal read in the session time zone (so it prints back
    as the same text whatever the Python process zone is); None -> NULL."""
    if t is None:
        return F.lit(None).cast("timestamp")
    return F.to_timestamp(F.lit(t.strftime("%Y-%m-%d %H:%M:%S")))


def price_date_range(prices, lo: dt.date | None = None, hi: dt.date | Column | None = None):
    """Filter a price table to [lo, hi] on ``price_date``; on the stored
    layout also on ``price_month`` so whole month partitions are pruned.
    ``hi`` may be a scalar subquery, which prunes when the query runs."""
    p = prices
    has_month = "price_month" in prices.columns
    if lo is not None:
        p = p.filter(F.col("price_date") >= lit_date(lo))
        if has_month:
            p = p.filter(F.col("price_month") >= F.lit(lo.strftime("%Y-%m")))
    if hi is not None:
        late = hi if isinstance(hi, Column) else lit_date(hi)
        p = p.filter(F.col("price_date") <= late)
        if has_month:
            p = p.filter(F.col("price_month") <= F.date_format(late, "yyyy-MM"))
    return p


def py_strip(c: Column) -> Column:
    return F.regexp_replace(c, _STRIP_RE, "")


def distinct_days(day: Column, days: int) -> Column:
    """Aggregate: how many different values ``day`` (0..days) takes.  One bit a
    day in 64-bit words: exact, with a buffer of fixed size, so the aggregate
    stays hash-based at any number of groups."""
    words = []
    for w in range(days // 64 + 1):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (day - 64 * w).cast("int"))
        words.append(F.coalesce(F.bit_count(F.bit_or(F.when(F.floor(day / 64) == w, bit))), F.lit(0)))
    total = words[0]
    for x in words[1:]:
        total = total + x
    return total.cast("bigint")


def _no_uwr_ending(u: Column) -> Column:
    return ~u.rlike("[UWR]\\z")


def equity_shape(sym: Column) -> Column:
    """Worklist shape: not null, not '', upper(sym) is 1-5 letters/digits and
    does not end in U, W or R.  ``\\z`` (not ``$``): Java's ``$`` also matches
    before a trailing newline."""
    u = F.upper(sym)
    return (sym.isNotNull() & (sym != "") & u.rlike("^[A-Z0-9]{1,5}\\z")
            & _no_uwr_ending(u))


def letters_shape(sym: Column, upper: bool = True) -> Column:
    u = F.upper(sym) if upper else sym
    return u.rlike("^[A-Z]{1,5}\\z")


def is_us_listing(exchange: Column) -> Column:
    u = F.upper(exchange)
    return u.contains("NASDAQ") | u.contains("NYSE")


def rank_by(cases: list[tuple[Column, int]], default: int = 99) -> Column:
    """CASE WHEN cond1 THEN r1 ... ELSE default END."""
    expr = None
    for cond, r in cases:
        expr = F.when(cond, F.lit(r)) if expr is None else expr.when(cond, F.lit(r))
    return expr.otherwise(F.lit(default))


def guarded_ratio(num: Column, den: Column) -> Column:
    """(num - den) / den as exact decimal; NULL when either side is NULL or
    den = 0 (ANSI mode would raise on x/0)."""
    return F.when(den.isNull() | num.isNull() | (den == 0), F.lit(None)).otherwise((num - den) / den)


def pct_return_2dp(first: Column, last: Column) -> Column:
    """round((last/first - 1) * 100, 2), computed exactly as
    round((last - first) * 100 / first, 2) on decimals (half away from zero)."""
    return F.when(first.isNull() | last.isNull() | (first == 0), F.lit(None)) \
        .otherwise(F.round((last - first) * 100 / first, 2))


def round_avg(sum_col: Column, cnt_col: Column, digits: int,
              sum_type: str = "decimal(20,0)") -> Column:
    """Exact round(avg, d): decimal sum / decimal count then one rounding.
    With decimal(20,0) operands Spark keeps 18 fractional digits, so the
    only rounding that matters is the final half-away-from-zero one."""
    return F.when(cnt_col > 0, F.round(sum_col.cast(sum_type) / cnt_col.cast("decimal(20,0)"), digits))


def coverage_class_short(days: Column, limits=(15, 7, 1)) -> Column:
    good, partial, low = limits
    d = F.coalesce(days, F.lit(0))
    return (F.when(d >= good, "good_coverage").when(d >= partial, "partial_coverage")
            .when(d >= low, "very_low_coverage").otherwise("no_prices"))


def coverage_class_long(is_priceable: Column, price_symbol: Column, days: Column,
                        limits=(20, 60)) -> Column:
    low, good = limits
    d = F.coalesce(days, F.lit(0))
    return (F.when(is_priceable == F.lit(False), "not_priceable")
            .when(price_symbol.isNull(), "unmapped")
            .when(d == 0, "mapped_but_no_prices")
            .when(d < low, "very_low_coverage")
            .when(d < good, "partial_coverage")
            .otherwise("good_coverage"))


def label_or(c: Column, missing: str = "Not available", trim: bool = True) -> Column:
    """coalesce(nullif(trim(x), ''), missing)   (trim strips spaces only)."""
    if trim:
        t = F.trim(c)
        return F.coalesce(F.when(t != "", t), F.lit(missing))
    return F.coalesce(c, F.lit(missing))
