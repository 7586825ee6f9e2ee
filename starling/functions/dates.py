"""Mixed-format date parsing (C4), standard-form tests (C5) and rendering.

All native expressions: no Python runs per row.  Each value is validated by an
anchored regex for its layout, rewritten to ISO order and read by Spark's
timestamp cast.  Results are zone-less timestamps (TIMESTAMP_NTZ); Unix seconds
are read as UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted layouts.  A value is read only when it matches one
# of these shapes exactly; anything else is NULL.
#   yyyy-M-d   yyyy/M/d   yyyy.M.d
#   M/d/yyyy   M-d-yyyy   M.d.yyyy  (d first when the first number cannot be a month),
#   each with a two-digit year as well (76-99 are 19xx, 00-75 are 20xx)
#   d-MMM-yyyy   d MMMM yyyy   MMM d yyyy   MMMM d, yyyy  (English names, any case)
# each with an optional time after a blank or T: H:mm[:ss[.fraction of 1 to 9 digits]],
# or with AM or PM behind it.  White space around the value does not count.
# Ambiguous hyphen and slash dates are read month first (``05-03-2024`` is May
# 3rd), as the reference does; ``hyphen_day_first`` flips the hyphen reading.
_TIME = r"((?:[T ][0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)?)$"
YMD_RE = r"^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})" + _TIME
MDY_RE = r"^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4})" + _TIME
MONTH_FIRST_RE = r"^([A-Za-z]{3,9})\.? ([0-9]{1,2}),? ([0-9]{4})" + _TIME
DAY_FIRST_RE = r"^([0-9]{1,2})[- ]([A-Za-z]{3,9})[-, ] ?([0-9]{4})" + _TIME
HALF_DAY_RE = r"[T ](0?[1-9]|1[0-2]):[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)? ?[AaPp][Mm]$"
HALF_RE = r" ?([AaPp])[Mm]$"
LONG_FRACTION_RE = r"(:[0-9]{2}\.[0-9]{6})[0-9]{1,3}( ?[AaPp][Mm])?$"
YEAR_19_RE = r"^([0-9]{1,2}[-/.][0-9]{1,2}[-/.])(7[6-9]|[89][0-9])(?![0-9])"
YEAR_20_RE = r"^([0-9]{1,2}[-/.][0-9]{1,2}[-/.])([0-6][0-9]|7[0-5])(?![0-9])"
AROUND_RE = r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$"
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august",
          "september", "october", "november", "december"]
NULL_WORDS = ["nan", "none", "null"]
# Largest whole number of seconds that still fits a nanosecond timestamp.
MAX_EPOCH_SECONDS = 9223372036

# The standard forms.
STANDARD_DATE = r"^\d{4}-\d{2}-\d{2}$"
STANDARD_DATETIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def _month_number(word: Column) -> Column:
    """Month number of a full or three-letter English month name, any case."""
    keys = {}
    for i, m in enumerate(MONTHS, start=1):
        keys.setdefault(m, i)
        keys.setdefault(m[:3], i)
    keys["sept"] = 9
    pairs = [x for k, i in keys.items() for x in (F.lit(k), F.lit(i))]
    return F.element_at(F.create_map(*pairs), F.lower(word))


def strip(c: Column) -> Column:
    """The text without white space of any kind around it (not blanks alone)."""
    return F.regexp_replace(c, AROUND_RE, "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it.

    The body runs as a lambda over a one-element array: its many tests of the text stay
    out of the generated code, which they would otherwise grow past the method limit.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _plain(t: Column) -> Column:
    """Fractions cut to microseconds and years written with four digits."""
    t = F.regexp_replace(t, LONG_FRACTION_RE, "$1$2")
    return F.regexp_replace(F.regexp_replace(t, YEAR_19_RE, "$119$2"), YEAR_20_RE, "$120$2")


def _half_day_hours(t: Column, ts: Column) -> Column:
    """Hours to add to a time read without its AM or PM."""
    pm = F.lower(F.regexp_extract(t, HALF_RE, 1)) == "p"
    noon = F.hour(ts) == 12
    return F.when(pm & ~noon, 12).when(~pm & noon, -12).otherwise(0)


def _as_iso(t: Column, hyphen_day_first: bool) -> Column:
    """Rewrite any accepted layout into ``yyyy-M-d[ time]``; NULL for other text."""
    lead_is_month = F.regexp_extract(t, MDY_RE, 1).cast("int") <= 12
    second_is_month = F.regexp_extract(t, MDY_RE, 2).cast("int") <= 12
    month_first = F.regexp_replace(t, MDY_RE, "$3-$1-$2$4")
    day_first = F.regexp_replace(t, MDY_RE, "$3-$2-$1$4")
    # Trying "M-d" and falling back to "d-M" (and the reverse) is the same as
    # choosing by whether the leading (or second) number can be a month.
    numeric = F.when(lead_is_month, month_first).otherwise(day_first)
    if hyphen_day_first:
        numeric = F.when(t.rlike("^[0-9]{1,2}-"), F.when(second_is_month, day_first).otherwise(month_first)).otherwise(numeric)

    def named(pattern: str, month_at: int, day_at: int) -> Column:
        month = _month_number(F.regexp_extract(t, pattern, month_at))
        date = F.concat_ws("-", F.regexp_extract(t, pattern, 3), month.cast("string"), F.regexp_extract(t, pattern, day_at))
        return F.when(month.isNotNull(), F.concat(date, F.regexp_extract(t, pattern, 4)))

    return (
        F.when(t.rlike(YMD_RE), F.regexp_replace(t, YMD_RE, "$1-$2-$3$4"))
        .when(t.rlike(MDY_RE), numeric)
        .when(t.rlike(MONTH_FIRST_RE), named(MONTH_FIRST_RE, 1, 2))
        .when(t.rlike(DAY_FIRST_RE), named(DAY_FIRST_RE, 2, 1))
    )


def parse_mixed_datetime(c: Column, hyphen_day_first: bool = False) -> Column:
    """Text in any supported layout -> TIMESTAMP_NTZ, NULL when it cannot be read.

    Order of tests: null, blank or a null word -> NULL; all digits -> Unix
    seconds (UTC); otherwise the layouts above.  Every layout is validated by an
    anchored regex and rewritten to ISO order, then read by Spark's timestamp
    cast, which also rejects impossible dates (Feb 30, month 13).  No pattern
    formatter and no exception per row: both dominate the cost otherwise.
    """
    def read(t: Column) -> Column:
        return _as_iso(F.regexp_replace(t, HALF_RE, ""), hyphen_day_first).try_cast("timestamp_ntz")

    def dated(t: Column) -> Column:
        later = _let(read(t), lambda ts: ts + F.make_dt_interval(F.lit(0), _half_day_hours(t, ts)))
        return F.when(~t.rlike(HALF_RE), read(t)).when(t.rlike(HALF_DAY_RE), later)

    def any_text(t: Column) -> Column:
        secs = t.try_cast("bigint")
        epoch = F.when(secs <= F.lit(MAX_EPOCH_SECONDS), from_epoch_seconds(secs))
        return (F.when(t.isNull() | (t == "") | F.lower(t).isin(NULL_WORDS), F.lit(None).cast("timestamp_ntz"))
                .when(t.rlike("^[0-9]+$"), epoch).otherwise(_let(_plain(t), dated)))

    return _let(strip(c), any_text)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of a zone-less timestamp, from its fields.

    ``timestamp_diff``/``unix_seconds`` go through the session time zone, where a
    daylight-saving change would move the result by an hour; this does not.
    """
    return (F.unix_date(ts.cast("date")).cast("bigint") * 86400
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def from_epoch_seconds(secs: Column) -> Column:
    """Zone-less timestamp of whole seconds since 1970-01-01, built from fields
    (``timestamp_add`` on a zone-less value still resolves through the session
    time zone and shifts times that fall in a daylight-saving gap)."""
    day = F.date_from_unix_date(F.floor(secs / 86400).cast("int"))
    rest = F.pmod(secs, F.lit(86400))
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60)))


def add_seconds(ts: Column, secs: Column) -> Column:
    """``ts`` + whole seconds, zone-independent (``ts`` must have no fraction)."""
    return from_epoch_seconds(epoch_seconds(ts) + secs)


def add_months_keep_time(ts: Column, months: int) -> Column:
    """``ts`` shifted by whole months (day clamped to the month's end), time kept."""
    d = F.add_months(ts.cast("date"), months)
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.hour(ts), F.minute(ts), F.second(ts))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days from ``start`` to ``end`` (zone-less, truncated)."""
    return F.floor((epoch_seconds(end) - epoch_seconds(start)) / 86400).cast("bigint")


def truncate_to_second(ts: Column) -> Column:
    """Drop the fraction of a zone-less timestamp without a time-zone round trip."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
                                F.second(ts))


def is_nonstandard(c: Column, pattern: str) -> Column:
    """True when the raw text is not already in the standard layout (NULL counts)."""
    return ~F.coalesce(c.rlike(pattern), F.lit(False))


# Rendering goes through the zone-less text form of the value: ``date_format``
# converts a zone-less timestamp through the session time zone, which moves a
# time inside a daylight-saving gap by an hour.

def iso_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a zone-less timestamp (any fraction dropped)."""
    return F.substring(c.cast("timestamp_ntz").cast("string"), 1, 19)


def render_datetime(c: Column) -> Column:
    return iso_text(c)


def render_minutes(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm``."""
    return F.substring(iso_text(c), 1, 16)


def render_date(c: Column) -> Column:
    return c.cast("date").cast("string")


def month_key(c: Column) -> Column:
    """``yyyy-MM``."""
    return F.substring(c.cast("date").cast("string"), 1, 7)


def month_number(c: Column) -> Column:
    """yyyymm as INT: a partition value that reads back with a stable type."""
    return (F.year(c) * 100 + F.month(c)).cast("int")


def between_dates(df, ts_col: str, part_col: str, start: str, end: str):
    """Filter a date-partitioned fact on a timestamp range so partitions prune.

    A predicate on the timestamp alone gives ``PartitionFilters: []``; adding the
    same bounds on the partition column (``order_day`` DATE or ``order_month``
    yyyymm INT) lets the scan skip whole folders.  ``start`` is inclusive and
    ``end`` exclusive (``yyyy-MM-dd`` text).
    """
    ts = F.col(ts_col)
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    if part_col == "order_month":
        part = (F.col(part_col) >= month_number(lo)) & (F.col(part_col) <= month_number(hi))
    else:
        part = (F.col(part_col) >= lo) & (F.col(part_col) <= hi)
    return df.filter(part & (ts >= lo.cast("timestamp_ntz")) & (ts < hi.cast("timestamp_ntz")))
