"""Sources: file readers, line parsers, schemas and the test-table stand-ins."""

from shopscope.sources.lines import (
    parse_pay_json,
    parse_pay_lines,
    parse_shop_json,
    parse_shop_lines,
    parse_view_json,
    parse_view_lines,
)
from shopscope.sources.readers import (
    ensure_min_partitions,
    quarantined,
    read_or_quarantine,
    read_pays,
    read_shops,
    read_tables,
    read_views,
)
from shopscope.sources.standin import standin_pays, standin_shops, standin_tables, standin_views

__all__ = [
    "ensure_min_partitions",
    "parse_pay_json",
    "parse_pay_lines",
    "parse_shop_json",
    "parse_shop_lines",
    "parse_view_json",
    "parse_view_lines",
    "quarantined",
    "read_or_quarantine",
    "read_pays",
    "read_shops",
    "read_tables",
    "read_views",
    "standin_pays",
    "standin_shops",
    "standin_tables",
    "standin_views",
]
