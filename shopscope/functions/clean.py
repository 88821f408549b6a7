"""Cleaning rules for raw text fields (all JVM-side column expressions)."""

from __future__ import annotations

import datetime
import unicodedata

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shopscope.fixed import DAY_LENGTH
from shopscope.functions._util import as_col

# Strict integer text accepted by the integer fields: an optional sign, then
# ASCII digits, nothing else (other decimal digits are mapped to ASCII first).
INT_TEXT_PATTERN = r"\A[+-]?[0-9]+\z"

# Leading/trailing characters at or below U+0020, i.e. what a JVM trim removes
# (Spark's own trim only strips spaces).
_EDGE_CONTROL = r"\A[\x00-\x20]+|[\x00-\x20]+\z"


def blank_to_empty(c) -> Column:
    """Null or empty text becomes the empty string."""
    return F.coalesce(as_col(c), F.lit(""))


def _decimal_digit_map() -> tuple[str, str]:
    """Every non-ASCII BMP character of Unicode category Nd, and its value.

    A JVM integer parse accepts any such decimal digit (it reads UTF-16
    chars), e.g. fullwidth digits; the table is built from that rule.
    """
    src, dst = [], []
    for code in range(0x80, 0x10000):
        ch = chr(code)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.digit(ch)))
    return "".join(src), "".join(dst)


_DIGITS_FROM, _DIGITS_TO = _decimal_digit_map()


def _ascii_digits(c: Column) -> Column:
    # The translate only runs for text that is not already a plain integer.
    return F.when(c.rlike(INT_TEXT_PATTERN), c).otherwise(F.translate(c, _DIGITS_FROM, _DIGITS_TO))


def is_int_text(c) -> Column:
    """True when text is blank/null (read as 0) or a strict in-range int.

    Strict means an optional sign then decimal digits, nothing else (no
    blanks); digits may be any Unicode decimal digit, as the JVM parse allows.
    """
    c = as_col(c)
    d = _ascii_digits(c)
    return c.isNull() | (c == "") | (d.rlike(INT_TEXT_PATTERN) & d.try_cast("int").isNotNull())


def blank_to_zero(c) -> Column:
    """Null or empty text becomes 0, otherwise the text as an int.

    Text that is not a strict integer gives null here; readers decide with
    ``is_int_text`` whether such a row fails the job, is dropped or kept.
    """
    c = as_col(c)
    d = _ascii_digits(c)
    return (
        F.when(c.isNull() | (c == ""), F.lit(0))
        .when(d.rlike(INT_TEXT_PATTERN), d.try_cast("int"))
        .otherwise(F.lit(None).cast("int"))
    )


def java_trim(c) -> Column:
    """Strip every leading and trailing character at or below U+0020."""
    return F.regexp_replace(as_col(c), _EDGE_CONTROL, "")


def pay_day(time_stamp) -> Column:
    """The day of a payment time stamp.

    The trimmed text cut to its first ten characters when the trimmed text
    is longer than ten; otherwise the text unchanged (untrimmed).
    """
    t = as_col(time_stamp)
    # Only text starting or ending with a character <= U+0020 needs the
    # trim; everything else takes the cheap branch (no regex per row).
    # Strings compare by UTF-8 bytes, so "> ' '" is exactly "not <= U+0020".
    clean_edges = (F.substring(t, 1, 1) > F.lit(" ")) & (F.substring(t, -1, 1) > F.lit(" "))
    trimmed = java_trim(t)
    return F.when(clean_edges, text_to_day(t)).otherwise(
        F.when(F.length(trimmed) > DAY_LENGTH, F.substring(trimmed, 1, DAY_LENGTH)).otherwise(t)
    )


def text_to_day(time_stamp) -> Column:
    """First ten characters of a text time stamp when it is longer."""
    t = as_col(time_stamp)
    return F.when(F.length(t) > DAY_LENGTH, F.substring(t, 1, DAY_LENGTH)).otherwise(t)


def epoch_to_day(seconds, time_zone: str | None = None) -> Column:
    """Epoch seconds to a ``yyyy-MM-dd`` day string.

    ``time_zone=None`` formats in the session time zone (the JVM-default-zone
    behaviour of the original function). A named zone gives a result that
    does not depend on the session setting.
    """
    s = as_col(seconds).cast("bigint")
    if time_zone is None:
        return F.date_format(F.timestamp_seconds(s), "yyyy-MM-dd")
    if time_zone.upper() in ("UTC", "Z", "+00:00"):
        whole_days = F.call_function("div", s - F.pmod(s, F.lit(86400)), F.lit(86400))
        return F.date_format(F.date_from_unix_date(whole_days.cast("int")), "yyyy-MM-dd")
    wall_utc = F.lit(datetime.datetime(1970, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=s)
    local = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), wall_utc)
    return F.date_format(local, "yyyy-MM-dd")


def ntz_epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ read as UTC wall-clock time."""
    ts = as_col(ts)
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def register_sql_functions(spark: SparkSession) -> None:
    """SQL-callable day functions, defined as SQL expressions.

    ``toDayStr(bigint)`` formats epoch seconds in the session zone;
    ``toDayText(string)`` applies the text rule of ``text_to_day``. Both are
    inlined into the plan like built-ins (no Python at run time).
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION toDayStr(s BIGINT) RETURNS STRING "
        "RETURN date_format(timestamp_seconds(s), 'yyyy-MM-dd')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION toDayText(t STRING) RETURNS STRING "
        f"RETURN CASE WHEN length(t) > {DAY_LENGTH} THEN substring(t, 1, {DAY_LENGTH}) ELSE t END"
    )
