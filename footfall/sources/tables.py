"""Behaviour logs derived from the given star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns used, with their types: a declared schema saves the footer-reading
# job that inference starts, and reads no column a query does not need.
_SCHEMAS = {
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
        "value DOUBLE, props STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "part": "p_partkey BIGINT, p_brand STRING",
}


# Epoch time of a zone-less timestamp, whatever the session time zone is.
_SECONDS = "unix_date(to_date({0})) * 86400L + hour({0}) * 3600 + minute({0}) * 60 + second({0})"
_MICROS = f"({_SECONDS}) * 1000000 + CAST(extract(SECOND FROM {{0}}) * 1000000 AS BIGINT) % 1000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def part_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item and category of every part; the category ends the brand's name."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS item_id",
        "CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT) AS category_id",
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``events`` as a behaviour log.

    Event types without a counterpart stay under their own name, as unknown
    behaviours do in a real log: they count in totals but in no measure.
    """
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "CAST(get_json_object(props, '$.k') AS INT) AS item_id",
        "CAST(CAST(get_json_object(props, '$.k') AS INT) DIV 10 AS INT) AS category_id",
        """CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'cart'
           WHEN 'signup' THEN 'fav' WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior""",
        f"{_SECONDS.format('ts')} AS timestamp",
        f"{_MICROS.format('ts')} AS ts_us",
        "to_date(ts) AS date",
        "hour(ts) AS hour",
        "value",
    )


def orders_log(
    spark: SparkSession, sf_dir: str, user: bool = True, category: bool = True
) -> DataFrame:
    """Every row of ``lineitem`` as a behaviour log.

    The user comes from ``orders`` and the category from ``part``.  Ask only
    for what a query needs: a dimension that is left out costs no join.
    """
    log = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey AS item_id",
        """CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'cart'
           WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'fav'
           WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'buy' ELSE 'pv' END AS behavior""",
        f"{_SECONDS.format('l_shipdate')} AS timestamp",
        f"{_MICROS.format('l_shipdate')} AS ts_us",
        "to_date(l_shipdate) AS date",
        "hour(l_shipdate) AS hour",
    )
    if user:
        orders = table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey AS l_orderkey", "o_custkey AS user_id"
        )
        log = log.join(orders, "l_orderkey")
    if category:
        log = log.join(part_categories(spark, sf_dir), "item_id")
    return log.drop("l_orderkey")
