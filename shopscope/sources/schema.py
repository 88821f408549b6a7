"""Table schemas: the typed form every job consumes.

Shop master rows carry five integers; payment and view rows are three
strings. Payments additionally carry the derived ``day`` column.
"""

from pyspark.sql import types as T

from shopscope.fixed import LOG_REQUIRED_FIELDS, SHOP_REQUIRED_FIELDS  # noqa: F401  (re-exported)

SHOP_STRING_COLUMNS = ("shop_id", "city_name", "cate_1_name", "cate_2_name", "cate_3_name")
SHOP_INT_COLUMNS = ("location_id", "per_pay", "score", "comment_cnt", "shop_level")

# Field order of a shop line / record.
SHOP_COLUMNS = (
    "shop_id",
    "city_name",
    "location_id",
    "per_pay",
    "score",
    "comment_cnt",
    "shop_level",
    "cate_1_name",
    "cate_2_name",
    "cate_3_name",
)
# A shop line needs SHOP_REQUIRED_FIELDS fields (the tenth, cate_3_name, is
# optional); a log line needs LOG_REQUIRED_FIELDS.
LOG_COLUMNS = ("user_id", "shop_id", "time_stamp")

SHOP_SCHEMA = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name in SHOP_INT_COLUMNS else T.StringType(), False)
        for name in SHOP_COLUMNS
    ]
)

PAY_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in LOG_COLUMNS]
    + [T.StructField("day", T.StringType(), False)]
)

VIEW_SCHEMA = T.StructType([T.StructField(name, T.StringType(), False) for name in LOG_COLUMNS])


def raw_string_schema(columns) -> T.StructType:
    """All-string schema used to read JSON records before cleaning."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])
