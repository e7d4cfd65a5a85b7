"""Column builders for the scalar layer: built-in expressions only, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidloom import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- identifiers and hashes -------------------------------------------------

def normalize_id(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def sha256_hex(c: Column | str) -> Column:
    """Hex digest of the value's text form; null stays null."""
    return F.sha2(_col(c).cast("string"), 256)


def stable_uuid(c: Column | str) -> Column:
    """The 16 MD5 bytes printed 8-4-4-4-12, with no version bits set."""
    digest = F.md5(_col(c).cast("string"))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def composite_key(*cols: Column | str, sep: str = ":") -> Column:
    """Joined text of the columns; nulls are skipped, as concat_ws does."""
    return F.concat_ws(sep, *[_col(c).cast("string") for c in cols])


def surrogate_key(*cols: Column | str) -> Column:
    """One non-null key for several nullable columns.

    Every value is tagged and length-prefixed, so ('a', null) and (null, 'a'), or ('a', 'bc') and
    ('ab', 'c'), never produce the same text.
    """
    parts = []
    for c in cols:
        text = _col(c).cast("string")
        tagged = F.concat(F.lit("v"), F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(tagged, F.lit("n")))
    return F.sha2(F.concat_ws("|", *parts), 256)


# --- time -------------------------------------------------------------------

def floor_minutes(ts: Column | str, minutes: int) -> Column:
    """Start of the epoch-aligned bucket; floors before 1970 too and drops sub-seconds."""
    width = minutes * 60
    bucket = F.floor(F.unix_seconds(_col(ts).cast("timestamp")) / F.lit(width))
    return F.timestamp_seconds(bucket * F.lit(width))


def calendar_date(c: Column | str) -> Column:
    """Date of a timestamp or of an ISO string; the zone suffix of a string is ignored, bad text is null."""
    return _col(c).try_cast("date")


def date_parts(c: Column | str) -> dict[str, Column]:
    day = calendar_date(c)
    return {"year": F.year(day), "month": F.month(day), "dayofmonth": F.dayofmonth(day)}


# --- classification ---------------------------------------------------------

def band(c: Column | str, bounds: Iterable[tuple[float, str]], default: str) -> Column:
    """Label of the first lower bound reached; null and smaller values take the default."""
    value = _col(c)
    label = F
    for lower_bound, name in bounds:
        label = label.when(value >= F.lit(lower_bound), F.lit(name))
    return label.otherwise(F.lit(default))


def price_bucket(price: Column | str) -> Column:
    return band(price, fv.PRICE_BUCKETS, fv.PRICE_BUCKET_DEFAULT)


def unit_score_band(score: Column | str) -> Column:
    return band(score, fv.SCORE_BANDS_UNIT, fv.SCORE_BAND_DEFAULT)


def percent_score_band(score: Column | str) -> Column:
    return band(score, fv.SCORE_BANDS_PERCENT, fv.SCORE_BAND_DEFAULT)


def quality_score(is_test: Column | str, price: Column | str) -> Column:
    priced = F.when(_col(price) >= F.lit(fv.QUALITY_PREMIUM_FROM), F.lit(fv.QUALITY_PREMIUM))
    return F.when(_col(is_test), F.lit(fv.QUALITY_TEST)).otherwise(priced.otherwise(F.lit(fv.QUALITY_DEFAULT)))


def frequency_of_user(normalized_id: Column | str) -> Column:
    hot = _col(normalized_id).startswith(fv.HOT_USER_PREFIX)
    return F.when(hot, F.lit(fv.HIGH)).otherwise(F.lit(fv.LOW))


def flag(condition: Column | str) -> Column:
    """1 when true, 0 when false or null."""
    return F.when(_col(condition), F.lit(1)).otherwise(F.lit(0))


# --- salts ------------------------------------------------------------------

def murmur_salt(key: Column | str, buckets: int = fv.SALT_BUCKETS) -> Column:
    """Salt from Spark's Murmur3 hash; widened before abs because abs(INT_MIN) raises under ANSI."""
    return F.pmod(F.abs(F.hash(_col(key)).cast("bigint")), F.lit(buckets)).cast("int")


def portable_salt(key: Column | str, buckets: int = fv.SALT_BUCKETS) -> Column:
    """Salt from the first 32 bits of MD5, for comparison with engines without Murmur3."""
    head = F.conv(F.substring(F.md5(_col(key).cast("string")), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(buckets)).cast("int")


# --- prices -----------------------------------------------------------------

def priced(price: Column | str, modifier: Column | str, quality: Column | str) -> dict[str, Column]:
    """Modifier defaulted to 1, adjusted price, quality-weighted price."""
    effective = F.coalesce(_col(modifier), F.lit(1.0))
    adjusted = _col(price) * effective
    return {
        "effective_bid_modifier": effective,
        "adjusted_bid_price": adjusted,
        "quality_weighted_price": adjusted * _col(quality),
    }
