"""Stand-in shop, payment and view tables over the TPC-H-like test tables.

The test tables hold no shops, so suppliers play shops: a supplier's region
is its city, its non-negative account balance (floored) its average spend,
and the part with the same key supplies size-derived rating fields and
three category texts. Every lineitem is a payment at its supplier on its
ship date, by the customer of its order (looked up, so counts that
do not need the customer skip the orders join); every ``view`` event is a page
view of shop ``event_id % (number of suppliers)``.

Everything here is a DataFrame plan over the parquet files; the joins are
planned by Catalyst as sort-merge joins, which AQE turns into broadcasts
when a dimension side's shuffle output measures small at run time) and only the columns used
downstream are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.functions.clean import pay_day

# Fixed values of the stand-in mapping: regions used as the three cities,
# the category keyword (matches the part types LARGE and STANDARD), and the
# category literal of the SQL-form selection.
STANDIN_CITIES = ("AFRICA", "AMERICA", "ASIA")
STANDIN_KEYWORD = "AR"
STANDIN_CATEGORY = "LARGE"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def standin_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table as read by the stand-ins."""
    return _table(spark, sf_dir, name)


def standin_shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nat = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", "p_brand", "p_name")
    joined = (
        sup.join(nat, sup.s_nationkey == nat.n_nationkey)
        .join(reg, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(part, part.p_partkey == sup.s_suppkey)
    )
    balance = F.when(F.col("s_acctbal") < 0, F.lit(0.0)).otherwise(F.col("s_acctbal"))
    return joined.select(
        F.col("s_suppkey").cast("string").alias("shop_id"),
        F.col("r_name").alias("city_name"),
        F.col("s_nationkey").cast("int").alias("location_id"),
        F.floor(balance).cast("int").alias("per_pay"),
        (F.col("p_size") % 6).alias("score"),
        F.col("p_size").alias("comment_cnt"),
        (F.col("p_size") % 3).alias("shop_level"),
        F.col("p_type").alias("cate_1_name"),
        F.col("p_brand").alias("cate_2_name"),
        F.col("p_name").alias("cate_3_name"),
    )


def standin_pays(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A payment is a lineitem; its user is the (largest) customer of its
    # order, null where there is no order. The oracle states the same rule.
    # Orders grouped on their key tell Catalyst that the key is unique, so a
    # query that never reads user_id (every count, score and ranking) has
    # the join removed and scans lineitem alone.
    # The join moves the stored columns only; the payment columns are derived
    # from its rows. A later filter on shop_id (e.g. the shop selection) still
    # goes below both, onto the lineitem scan, before the lineitem-orders shuffle.
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    orders = (
        _table(spark, sf_dir, "orders")
        .groupBy("o_orderkey")
        .agg(F.max("o_custkey").alias("o_custkey"))
    )
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
    time_stamp = F.col("l_shipdate").cast("string")
    return joined.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_suppkey").cast("string").alias("shop_id"),
        time_stamp.alias("time_stamp"),
        pay_day(time_stamp).alias("day"),
    )


def standin_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_shops = _table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    ev = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return ev.filter(F.col("event_type") == "view").select(
        F.col("user_id").cast("string").alias("user_id"),
        (F.col("event_id") % n_shops).cast("string").alias("shop_id"),
        F.col("ts").cast("string").alias("time_stamp"),
    )


def standin_tables(spark: SparkSession, sf_dir: str):
    """(shops, pays, views) over the test tables in ``sf_dir``."""
    return standin_shops(spark, sf_dir), standin_pays(spark, sf_dir), standin_views(spark, sf_dir)


def to_csv_lines(df: DataFrame, columns) -> DataFrame:
    """Render rows as comma lines (the input format of the text readers). A null
    is an empty field; the format has no quoting, so a comma in a text shifts it."""
    return df.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))


def to_json_lines(df: DataFrame, columns) -> DataFrame:
    """Render rows as JSON lines (numbers bare, as a JSON writer emits them)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in columns])).alias("value"))


# Lines of the file queries. Beside each row's own line they hold lines derived
# from some rows, one kind for each reading rule; the oracle states them again.

def _lines(df: DataFrame, *lines: tuple[Column | None, Column]) -> DataFrame:
    """One row for each line whose condition holds (None: always)."""
    found = F.array(*(line if when is None else F.when(when, line) for when, line in lines))
    return df.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("value"))


def _joined(*parts) -> Column:
    return F.concat_ws(",", *(F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts))


def shop_file_lines(shops: DataFrame) -> DataFrame:
    """Every shop; a nine-field copy (n...) where location_id % 5 = 0; one with blank
    integers and a blank text (b...) where % 3 = 0; bad: an eight-field line (e...)
    where % 4 = 0, an average spend of 12x (x...) where % 4 = 1, an empty line
    where shop_level = 0."""
    c = {name: F.col(name) for name in shops.columns}
    tail = [c[n] for n in ("score", "comment_cnt", "shop_level", "cate_1_name", "cate_2_name", "cate_3_name")]

    def named(letter: str) -> Column:
        return F.concat(F.lit(letter), c["shop_id"])

    return _lines(
        shops, (None, _joined(*c.values())),
        (c["location_id"] % 5 == 0, _joined(named("n"), c["city_name"], c["location_id"], c["per_pay"], *tail[:-1])),
        (c["location_id"] % 3 == 0, _joined(named("b"), c["city_name"], "", c["per_pay"], "", "", c["shop_level"], c["cate_1_name"], "", c["cate_3_name"])),
        (c["location_id"] % 4 == 0, _joined(named("e"), c["city_name"], c["location_id"], c["per_pay"], *tail[:-2])),
        (c["location_id"] % 4 == 1, _joined(named("x"), c["city_name"], c["location_id"], "12x", *tail)),
        (c["shop_level"] == 0, F.lit("")))


def pay_file_lines(pays: DataFrame) -> DataFrame:
    """Every payment, with a tab before the time stamp where the day ends in 7;
    bad: a line without the time stamp where it ends in 15."""
    stamp = F.when(F.col("day").endswith("7"), F.concat(F.lit("\t"), "time_stamp")).otherwise(F.col("time_stamp"))
    return _lines(pays, (None, _joined(F.col("user_id"), F.col("shop_id"), stamp)),
                  (F.col("day").endswith("15"), _joined(F.col("user_id"), F.col("shop_id"))))


def view_file_lines(views: DataFrame) -> DataFrame:
    """Every page view; bad: an empty line where shop_id ends in 3, a line of commas where it ends in 4."""
    return _lines(views, (None, _joined(*(F.col(n) for n in ("user_id", "shop_id", "time_stamp")))),
                  (F.col("shop_id").endswith("3"), F.lit("")), (F.col("shop_id").endswith("4"), F.lit(",,")))


def shop_file_records(shops: DataFrame) -> DataFrame:
    """Every shop, its numbers quoted where location_id % 2 = 0; a record with four
    keys (k...) where % 3 = 0; bad: a score of 4x (x...) where % 4 = 1, a line cut
    off after its first key where % 4 = 0."""
    c = {name: F.col(name) for name in shops.columns}
    quoted = F.to_json(F.struct(*(c[n].cast("string").alias(n) for n in c)))

    def named(letter: str) -> Column:
        return F.concat(F.lit(letter), c["shop_id"]).alias("shop_id")

    return _lines(
        shops, (None, F.when(c["location_id"] % 2 == 0, quoted).otherwise(F.to_json(F.struct(*c.values())))),
        (c["location_id"] % 3 == 0, F.to_json(F.struct(named("k"), c["per_pay"], c["cate_1_name"], F.lit("").alias("comment_cnt")))),
        (c["location_id"] % 4 == 1, F.to_json(F.struct(named("x"), F.lit("4x").alias("score")))),
        (c["location_id"] % 4 == 0, F.concat(F.lit('{"shop_id": "'), c["shop_id"], F.lit('", "per_pay":'))))


def pay_file_records(pays: DataFrame) -> DataFrame:
    """Every payment (no key for a missing user); bad: a line that is not JSON where
    the day ends in 15, an empty line where it ends in 25."""
    return _lines(pays, (None, F.to_json(F.struct("user_id", "shop_id", "time_stamp"))),
                  (F.col("day").endswith("15"), F.concat(F.lit("payment at "), "shop_id")), (F.col("day").endswith("25"), F.lit("")))
