"""Column -> Column building blocks. Every function here is a native Spark
expression (whole-stage codegen, no Python UDF)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(ref) -> Column:
    """Literal timestamp (session time zone is UTC)."""
    if isinstance(ref, str):
        return F.to_timestamp(F.lit(ref))
    if isinstance(ref, _dt.datetime):
        if ref.tzinfo is not None:
            ref = ref.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return F.to_timestamp(F.lit(ref.strftime("%Y-%m-%d %H:%M:%S.%f")))
    if isinstance(ref, _dt.date):
        return F.to_timestamp(F.lit(ref.isoformat()))
    return ref


def ntz_lit(ref) -> Column:
    """Literal timestamp_ntz, for filters on source columns (pushed to the scan)."""
    if isinstance(ref, (_dt.datetime, _dt.date)):
        ref = ref.strftime("%Y-%m-%d %H:%M:%S") if isinstance(ref, _dt.datetime) else ref.isoformat()
    return F.lit(ref).cast("timestamp_ntz")


def ts_utc(c) -> Column:
    """Timestamp-without-time-zone (or text) -> timestamp, read as UTC."""
    return F.to_timestamp(col(c))


# ---- P1 / P2 / P3: casts -------------------------------------------------

_DECIMAL_RE = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def cast_numeric(c) -> Column:
    """Text/number -> double, anything unparsable -> NULL (P1). NaN -> NULL.
    Only decimal notation counts: the cast itself would also take Java's float
    suffixes and hexadecimal floats."""
    d = col(c).try_cast("double")
    return F.when(~F.isnan(d) & F.trim(col(c).cast("string")).rlike(_DECIMAL_RE), d)


def coerced_flag(c) -> Column:
    """1 when a non-null input was coerced to NULL by :func:`cast_numeric`."""
    return (col(c).isNotNull() & cast_numeric(c).isNull()).cast("int")


def safe_int(c) -> Column:
    """Text -> bigint, '12.5' and garbage -> NULL."""
    return F.trim(col(c).cast("string")).try_cast("bigint")


def safe_bool(c) -> Column:
    """Keep only real booleans; text such as 'garbage' -> NULL.

    Works on a column already typed boolean by the JSON schema, and on text
    columns holding 'true'/'false' literally produced by a JSON writer.
    """
    s = F.lower(col(c).cast("string"))
    return F.when(s == "true", F.lit(True)).when(s == "false", F.lit(False))


# ---- P4: ISO-8601 durations -----------------------------------------------

_ISO_RE = r"^([+-])?P(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:[.,]\d+)?)S)?)?$"


def iso8601_duration_seconds(c) -> Column:
    """'P1DT2H3M4S' -> seconds (bigint). NULL for NULL, garbage, 'P', 'PT',
    year/month components. Fractional seconds are truncated toward zero."""
    def seconds(s):
        valid = s.rlike(_ISO_RE) & ~s.rlike(r"^[+-]?PT?$") & ~s.rlike(r"T$")
        groups = F.split(F.regexp_replace(s, _ISO_RE, "$1;$2;$3;$4;$5;$6"), ";")
        return F.when(valid, _once(groups, lambda g: _once(signed(g), truncated)))

    def number(part):
        # A part that is not there is told before the cast, where each one costs an exception.
        return F.when(part == "", F.lit(0.0)).otherwise(F.coalesce(F.translate(part, ",", ".").try_cast("double"), F.lit(0.0)))

    def signed(g):
        w, d, h, m, sec = (number(F.get(g, F.lit(i))) for i in range(1, 6))
        total = w * 604800 + d * 86400 + h * 3600 + m * 60 + sec
        return _once(total, lambda t: F.when(F.get(g, F.lit(0)) == "-", -t).otherwise(t))

    def truncated(v):
        return F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)).cast("bigint")

    # The API's own form of hours, minutes and seconds needs no groups to be taken out.
    t = F.trim(col(c))
    left = F.substring(t, 3, 64)
    plain = F.lit(0).cast("bigint")
    for unit, size in (("H", 3600), ("M", 60), ("S", 1)):
        plain = plain + F.when(F.contains(left, F.lit(unit)), F.substring_index(left, unit, 1).try_cast("bigint") * size).otherwise(0)
        left = F.substring_index(left, unit, -1)
    return F.coalesce(F.when(t.rlike(r"^PT(?=\d)(\d{1,9}H)?(\d{1,9}M)?(\d{1,9}S)?\z"), plain), _once(F.upper(t), seconds))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def seconds_to_iso(c) -> Column:
    """Whole seconds -> 'PT{m}M{s}S' text (used by the B1 binding)."""
    v = col(c).cast("bigint")
    return F.when(v.isNotNull(), F.format_string("PT%dM%dS", F.floor(v / 60).cast("bigint"), v % 60))


# ---- P5 / P6 / P7 --------------------------------------------------------

def parse_ts(c) -> Column:
    """ISO timestamp text ('Z' = UTC) -> timestamp, bad -> NULL (P5). Fractions of
    up to nine digits are cut to microseconds; offsets may be ``+00:00`` or ``+0000``."""
    # The API's own form needs no patterns to be tried.
    t = F.trim(col(c))
    plain = F.when(t.rlike(r"^[1-9]\d{3}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"), F.substring(t, 1, 19).try_cast("timestamp"))
    s = F.regexp_replace(t, "Z$", "")
    s = F.regexp_replace(s, r"(\.\d{6})\d{1,3}(?=$|[+-])", "$1")
    s = F.regexp_replace(s, r"(\d{2}:\d{2}:\d{2}(?:\.\d+)?[+-]\d{2})(\d{2})$", "$1:$2")
    return F.coalesce(
        plain,
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX]")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd")),
    )


def key_absent(map_col, key: str) -> Column:
    """True when ``key`` is absent from the map (not merely null)."""
    return F.when(col(map_col).isNotNull(), ~F.map_contains_key(col(map_col), F.lit(key))).otherwise(F.lit(True))


def text_or_empty(c) -> Column:
    """Missing nested text -> '' (P7)."""
    return F.coalesce(col(c), F.lit(""))


# ---- P8 - P11: per-video window metrics -----------------------------------

def whole_days_between(ref, ts) -> Column:
    """Floor of elapsed 24-hour days from ts to ref (N1); NULL when ts is NULL."""
    r, t = ts_lit(ref), col(ts)
    return F.floor((F.unix_micros(r) - F.unix_micros(t)) / F.lit(MICROS_PER_DAY)).cast("bigint")


def window_cutoff(ref, days: int) -> Column:
    return ts_lit(ref) - F.make_interval(days=F.lit(int(days)))


def in_window(ts, ref, days: int) -> Column:
    """ts >= ref - days; NULL time is outside every window."""
    return F.coalesce(col(ts) >= window_cutoff(ref, days), F.lit(False))


def window_flags(ts, ref, short: int = 30, long: int = 90) -> dict[str, Column]:
    """in_short, in_long, in_between."""
    s, lg = in_window(ts, ref, short), in_window(ts, ref, long)
    return {"in_short": s, "in_long": lg, "in_between": lg & ~s}


def safe_ratio(a, b) -> Column:
    """A / b, NULL when either is NULL or b <= 0."""
    a, b = col(a), col(b)
    return F.when(a.isNotNull() & b.isNotNull() & (b > 0), F.try_divide(a, b))


def views_per_day(views, ts, ref) -> Column:
    """P10: views / max(whole days since publish, 1); NULL time -> NULL."""
    days = whole_days_between(ref, ts)
    return F.when(col(ts).isNotNull() & col(views).isNotNull(),
                  col(views).cast("double") / F.greatest(days, F.lit(1)).cast("double"))


def engagement_rate(likes, comments, views) -> Column:
    """(likes + comments) / views clipped to [0, 1]; NULL when views is 0/NULL."""
    v = col(views).cast("double")
    num = F.coalesce(col(likes).cast("double"), F.lit(0.0)) + F.coalesce(col(comments).cast("double"), F.lit(0.0))
    return F.when(v.isNotNull() & (v != 0), F.least(F.greatest(num / v, F.lit(0.0)), F.lit(1.0)))


def log1p_clipped(c) -> Column:
    """log1p(max(x, 0))."""
    return F.log1p(F.greatest(col(c).cast("double"), F.lit(0.0)))


def valid_channel_id(c) -> Column:
    """P19: 'UC' + 22 of [A-Za-z0-9_-]."""
    return F.coalesce(col(c).rlike(r"^UC[A-Za-z0-9_-]{22}$"), F.lit(False))
