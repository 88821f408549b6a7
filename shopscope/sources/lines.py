"""Parsing of raw record lines into typed shop / payment / view rows.

The parsers take a DataFrame with one text line per row, so the same code
serves any source of lines.

Comma lines follow the original split rule: no quoting, trailing empty
fields are dropped, fields past the last known column are ignored. A line
is good when it has enough fields and every integer field is blank or a
strict in-range integer. ``bad_rows`` says what happens to the others:

* ``"fail"`` – the job fails on the first bad line (original behaviour);
* ``"drop"`` – bad lines are skipped;
* ``"keep"`` – bad lines stay, with the raw line in a ``_bad`` column
  (null on good lines) and unparsable integers as null.

A null line is bad and reads as an empty one. ``reasons`` says of each bad
line what is wrong with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.functions.clean import blank_to_empty, blank_to_zero, is_int_text, pay_day
from shopscope.sources.schema import (
    LOG_COLUMNS,
    LOG_REQUIRED_FIELDS,
    SHOP_COLUMNS,
    SHOP_INT_COLUMNS,
    SHOP_REQUIRED_FIELDS,
    raw_string_schema,
)

BAD_ROW_POLICIES = ("fail", "drop", "keep")
BAD_COLUMN = "_bad"
_CORRUPT = "_corrupt_record"


def _check_policy(bad_rows: str) -> None:
    if bad_rows not in BAD_ROW_POLICIES:
        raise ValueError(f"bad_rows must be one of {BAD_ROW_POLICIES}, got {bad_rows!r}")


def split_fields(value) -> Column:
    """Comma split with trailing empty fields removed (trailing commas are
    trimmed first, a character trim rather than a regex)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.split(F.rtrim(v, F.lit(",")), ",")


def _once(parsed: Column) -> Column:
    """The parse as a generated one-row column: the good-line filter stays
    above it, so a line is parsed once however often its fields are mentioned."""
    return F.explode(F.array(parsed))


def _typed_columns(raw: dict[str, Column], columns, int_columns) -> list[Column]:
    out = []
    for name in columns:
        if name in int_columns:
            out.append(blank_to_zero(raw[name]).alias(name))
        else:
            out.append(blank_to_empty(raw[name]).alias(name))
    return out


def _apply_policy(df: DataFrame, good: Column, columns: list[Column], line: Column, bad_rows: str, what: str) -> DataFrame:
    _check_policy(bad_rows)
    if bad_rows == "fail":
        guard = F.when(good, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"malformed {what} line: "), F.coalesce(line, F.lit("<null>"))))
        )
        return df.filter(guard).select(*columns)
    if bad_rows == "drop":
        return df.filter(good).select(*columns)
    return df.select(*columns, F.when(~good, line).alias(BAD_COLUMN))


def _parse_csv(lines: DataFrame, columns, int_columns, min_fields: int, exact_fields: int | None,
               bad_rows: str, what: str, value_col: str) -> DataFrame:
    staged = lines.select(F.col(value_col).alias("_line"), _once(split_fields(value_col)).alias("_parts"))
    n = F.size("_parts")
    raw = {name: F.get(F.col("_parts"), i) for i, name in enumerate(columns)}
    good = (n == exact_fields) if exact_fields else (n >= min_fields)
    for name in int_columns:
        good = good & is_int_text(raw[name])
    return _apply_policy(staged, F.coalesce(good, F.lit(False)), _typed_columns(raw, columns, int_columns),
                         F.coalesce("_line", F.lit("")), bad_rows, what)


def _parse_json(lines: DataFrame, columns, int_columns, bad_rows: str, what: str, value_col: str) -> DataFrame:
    schema = raw_string_schema(list(columns) + [_CORRUPT])
    parsed = F.from_json(F.col(value_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    staged = lines.select(F.col(value_col).alias("_line"), _once(parsed).alias("_rec"))
    raw = {name: F.col("_rec").getField(name) for name in columns}
    good = (
        F.col("_rec").isNotNull()
        & F.col("_rec").getField(_CORRUPT).isNull()
        & (F.trim(F.col("_line")) != "")
    )
    for name in int_columns:
        good = good & is_int_text(raw[name])
    return _apply_policy(staged, F.coalesce(good, F.lit(False)), _typed_columns(raw, columns, int_columns),
                         F.coalesce("_line", F.lit("")), bad_rows, what)


#: Columns of each kind of record, those that hold integers, and the least fields of a line.
KINDS = {
    "shop": (SHOP_COLUMNS, SHOP_INT_COLUMNS, SHOP_REQUIRED_FIELDS),
    "pay": (LOG_COLUMNS, (), LOG_REQUIRED_FIELDS),
    "view": (LOG_COLUMNS, (), LOG_REQUIRED_FIELDS),
}


def typed_records(records: DataFrame, kind: str, bad_rows: str) -> DataFrame:
    """Rows of Spark's JSON source (all columns as text, and ``_corrupt_record``)
    to typed rows. ``_bad`` has the raw line of one that is not JSON, and the
    record as it was read where an integer is bad."""
    columns, int_columns, _ = KINDS[kind]
    raw = {name: F.col(name) for name in columns}
    # the source wants another column beside the corrupt one to be read, whatever the caller selects
    good = ~(F.col(_CORRUPT).isNotNull() & (F.coalesce(raw[columns[0]], F.lit("")) >= F.lit("")))
    for name in int_columns:
        good = good & is_int_text(raw[name])
    line = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*columns))) if int_columns else F.col(_CORRUPT)
    rows = _apply_policy(records, good, _typed_columns(raw, columns, int_columns), line, bad_rows, kind)
    return _with_day(rows) if kind == "pay" else rows


def reasons(lines: DataFrame, kind: str, fmt: str = "csv", value_col: str = "value",
            required_fields: int | None = None) -> DataFrame:
    """The bad lines among ``lines``, all their columns, with ``reason``: ``blank
    line``, ``N fields`` (too few, or not the required number), ``not JSON``, or
    ``not an integer:`` and the columns."""
    columns, int_columns, least = KINDS[kind]
    value = F.coalesce(F.col(value_col), F.lit(""))
    if fmt == "csv":
        parts = split_fields(value)
        n = F.size(parts)
        raw = {name: F.get(parts, i) for i, name in enumerate(columns)}
        wrong = (n != required_fields) if required_fields else (n < least)
        shape = F.when(value == "", F.lit("blank line")).when(wrong, F.concat(n.cast("string"), F.lit(" fields")))
    else:
        record = F.from_json(value, raw_string_schema(list(columns) + [_CORRUPT]),
                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
        raw = {name: record.getField(name) for name in columns}
        shape = F.when(F.trim(value) == "", F.lit("blank line")).when(
            record.isNull() | record.getField(_CORRUPT).isNotNull(), F.lit("not JSON"))
    odd = F.concat_ws(", ", *(F.when(~is_int_text(raw[name]), F.lit(name)) for name in int_columns))
    reason = F.coalesce(shape, F.when(odd != "", F.concat(F.lit("not an integer: "), odd)))
    return lines.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def _with_day(pays: DataFrame) -> DataFrame:
    cols = [c for c in pays.columns if c != BAD_COLUMN]
    extra = [BAD_COLUMN] if BAD_COLUMN in pays.columns else []
    return pays.select(*cols, pay_day("time_stamp").alias("day"), *extra)


def parse_shop_lines(lines: DataFrame, bad_rows: str = "fail", required_fields: int | None = None,
                     value_col: str = "value") -> DataFrame:
    """Comma-separated shop lines to typed shops.

    ``required_fields`` asks for exactly that many fields per line (the
    field-count line filter); by default nine or more are accepted.
    """
    return _parse_csv(lines, SHOP_COLUMNS, SHOP_INT_COLUMNS, SHOP_REQUIRED_FIELDS, required_fields,
                      bad_rows, "shop", value_col)


def parse_pay_lines(lines: DataFrame, bad_rows: str = "fail", value_col: str = "value") -> DataFrame:
    """Comma-separated payment lines to (user_id, shop_id, time_stamp, day)."""
    pays = _parse_csv(lines, LOG_COLUMNS, (), LOG_REQUIRED_FIELDS, None, bad_rows, "pay", value_col)
    return _with_day(pays)


def parse_view_lines(lines: DataFrame, bad_rows: str = "fail", value_col: str = "value") -> DataFrame:
    """S3: comma-separated page-view lines to (user_id, shop_id, time_stamp)."""
    return _parse_csv(lines, LOG_COLUMNS, (), LOG_REQUIRED_FIELDS, None, bad_rows, "view", value_col)


def parse_shop_json(lines: DataFrame, bad_rows: str = "fail", value_col: str = "value") -> DataFrame:
    """JSON-lines shops; numbers may be quoted or bare."""
    return _parse_json(lines, SHOP_COLUMNS, SHOP_INT_COLUMNS, bad_rows, "shop", value_col)


def parse_pay_json(lines: DataFrame, bad_rows: str = "fail", value_col: str = "value") -> DataFrame:
    """JSON-lines payments."""
    return _with_day(_parse_json(lines, LOG_COLUMNS, (), bad_rows, "pay", value_col))


def parse_view_json(lines: DataFrame, bad_rows: str = "fail", value_col: str = "value") -> DataFrame:
    """JSON-lines page views."""
    return _parse_json(lines, LOG_COLUMNS, (), bad_rows, "view", value_col)
