"""Scalar expressions: ratios with guards, times, digests, canonical text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970, of either kind of timestamp."""
    return F.unix_micros(col(ts).cast("timestamp"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return (micros(end) - micros(start)) / MICROS


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as doubles; null if either is null or b is 0."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def change(now: Column | str, base: Column | str) -> Column:
    """now / base - 1; null for a base that is not positive."""
    return F.when(col(base) > 0, ratio(now, base) - 1)


def division(a: Column | str, b: Column | str) -> Column:
    """a / b as doubles divide: infinite over 0, and 0 / 0 is NaN."""
    x, y = col(a).cast("double"), col(b).cast("double")
    over_zero = F.when((x == 0) | F.isnan(x), F.lit(float("nan"))).otherwise(F.signum(x) * F.lit(float("inf")))
    return F.when((y == 0) & x.isNotNull(), over_zero).otherwise(F.try_divide(x, y))


def plain_change(now: Column | str, base: Column | str) -> Column:
    """now / base - 1 whatever the base, as doubles divide."""
    return division(now, base) - 1


def rounded(x: Column | str, digits: int) -> Column:
    """x to so many digits, halves away from 0, as rounding the product by a power of ten does; F.round goes by the shortest decimal of x instead."""
    return F.round(col(x) * F.lit(10.0**digits), 0) / F.lit(10.0**digits)


def slope(now: Column | str, base: Column | str, seconds: Column | str) -> Column:
    return F.when(col(seconds) > 0, (col(now).cast("double") - col(base).cast("double")) / col(seconds))


def buy_ratio(buys: Column | str, sells: Column | str) -> Column:
    return ratio(col(buys), col(buys) + col(sells))


def imbalance(buys: Column | str, sells: Column | str) -> Column:
    return ratio(col(buys) - col(sells), col(buys) + col(sells))


def tri_state(happened: Column, complete: Column) -> Column:
    """TRUE once it happened; FALSE only if the whole path is known; else UNKNOWN."""
    return F.when(F.coalesce(happened, F.lit(False)), "TRUE").when(F.coalesce(complete, F.lit(False)), "FALSE").otherwise("UNKNOWN")


def stratum(identity: Column | str, n: int) -> Column:
    """The first 8 bytes of the SHA-256 of an identity, big-endian, modulo n."""
    head = F.conv(F.substring(F.sha2(col(identity).cast("string").cast("binary"), 256), 1, 16), 16, 10)
    return F.pmod(head.cast("decimal(20,0)"), F.lit(n)).cast("int")


def row_digest(*columns: str) -> Column:
    """SHA-256 of the JSON of the named columns in sorted order, nulls included."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def decimal_text(d: Column | str) -> Column:
    """A decimal without exponent and without trailing zeros behind the point."""
    text = col(d).cast("string")
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def same_at_scale(a: Column | str, stored: Column | str, scale: int) -> Column:
    """Whether a value, rounded half up to the scale that a store keeps, is what it holds; two nulls are the same."""
    at = lambda c: F.round(col(c).cast("decimal(38,18)"), scale).cast(f"decimal(38,{scale})")
    return at(a).eqNullSafe(at(stored))


def epoch_time(x: Column | str) -> Column:
    """Seconds, or milliseconds from 1e11 on, to a timestamp; null if it is not a finite number."""
    v = col(x).try_cast("double")
    ms = F.when(F.abs(v) >= 1e11, v).otherwise(v * 1000)
    return F.when(~F.isnan(v) & (F.abs(v) < 1e18), F.timestamp_millis(ms.cast("long")))


def bounded_text(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def has_nul(raw_json: Column | str) -> Column:
    """Whether a raw JSON text spells a NUL character in any key or value."""
    return F.coalesce(F.regexp_like(col(raw_json), F.lit(r"(?<!\\)(\\\\)*\\u0000")), F.lit(False))


def fixed_bucket(ts: Column | str, seconds: int) -> Column:
    """Start of the bucket of so many seconds, counted from 1970."""
    return (F.floor(micros(ts) / (seconds * MICROS)) * seconds).cast("long")
