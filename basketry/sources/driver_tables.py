"""Raw commerce tables derived from the TPC-H-like test tables.

Only selects and joins: the work of every plan on top grows with the tables given.
The customer of a review comes from a side made unique by ``groupBy``, so Catalyst
drops that join where the customer is not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOADED = "timestamp_ntz'2001-08-02 00:00:00'"
_META = [
    "'historic' AS data_source",
    "'batch-0' AS batch_id",
    f"{_LOADED} AS loaded_at",
]


# Read schemas, so that opening a table starts no job to infer one.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


class DriverTables:
    """The eight raw tables over one directory of test Parquet files."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._opened:
            path = f"{self.directory}/{name}.parquet"
            self._opened[name] = self.spark.read.schema(SCHEMAS[name]).parquet(path)
        return self._opened[name]

    def _places(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        return (
            self.read("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )

    def customers(self) -> DataFrame:
        return self._places().selectExpr(
            "c_custkey AS customer_id",
            "concat(c_name, '@example.com') AS email",
            "split_part(c_name, '#', 1) AS first_name",
            "split_part(c_name, '#', 2) AS last_name",
            "cast(18 + c_custkey % 58 AS int) AS age",
            "CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender",
            "cast(c_acctbal AS decimal(12,2)) * 10 AS annual_income",
            "CASE c_custkey % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' "
            "WHEN 2 THEN 'Divorced' ELSE 'Widowed' END AS marital_status",
            "c_mktsegment AS education",
            "CASE c_custkey % 3 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Suburban' "
            "ELSE 'Rural' END AS location_type",
            "concat('City_', c_custkey % 50) AS city",
            "n_name AS state",
            "r_name AS country",
            "cast(date_add(date'1995-01-01', cast(c_custkey % 365 AS int)) AS timestamp_ntz) "
            "AS signup_date",
            "cast(date_add(date'2001-01-01', cast(c_custkey % 200 AS int)) AS timestamp_ntz) "
            "AS last_login",
            "CASE c_custkey % 5 WHEN 0 THEN 'Email' WHEN 1 THEN 'Web' WHEN 2 THEN 'Web' "
            "ELSE 'Mobile App' END AS preferred_channel",
            "c_custkey % 10 <> 0 AS is_active",
            *_META,
        )

    def products(self) -> DataFrame:
        return self.read("part").selectExpr(
            "p_partkey AS product_id",
            "p_type AS category_id",
            "concat(p_type, '-', p_size % 5) AS subcategory_id",
            "p_name AS product_name",
            "concat(p_name, ' by ', p_brand) AS description",
            "p_retailprice AS base_price",
            "((cast(round(p_retailprice * 100) AS bigint) * (1 + p_size % 10)) div 10) / 100.0D "
            "AS sale_price",
            "p_size AS stock_quantity",
            "p_size / 4.0D AS weight_kg",
            "p_size % 7 <> 0 AS is_active",
            "timestamp_ntz'1995-01-01 00:00:00' AS created_at",
            "p_brand AS brand",
            "concat('SKU-', p_partkey) AS sku",
            "cast(1 + p_size % 5 AS double) AS rating",
            "0 AS review_count",
            *_META,
        )

    def categories(self) -> DataFrame:
        return (
            self.read("part")
            .select(F.col("p_type").alias("category_id"))
            .distinct()
            .selectExpr(
                "category_id",
                "category_id AS category_name",
                "timestamp_ntz'1995-01-01 00:00:00' AS created_at",
                *_META,
            )
        )

    def subcategories(self) -> DataFrame:
        return (
            self.read("part")
            .selectExpr("p_type AS category_id", "p_size % 5 AS part_no")
            .distinct()
            .selectExpr(
                "concat(category_id, '-', part_no) AS subcategory_id",
                "category_id",
                "concat(category_id, ' group ', part_no) AS subcategory_name",
                "timestamp_ntz'1995-01-01 00:00:00' AS created_at",
                *_META,
            )
        )

    def orders(self) -> DataFrame:
        place = (
            "concat('City_', o_custkey % 50, ', NATION_', o_custkey % 25, ', ', "
            "element_at(array('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), "
            "cast(1 + o_custkey % 5 AS int)))"
        )
        main_street = f"concat(o_orderkey, ' Main St, ', {place})"
        return self.read("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "o_orderdate AS order_date",
            "o_orderstatus AS status",
            "o_totalprice AS total_amount",
            "cast(5 + o_orderkey % 16 AS double) AS shipping_cost",
            "o_orderpriority AS payment_method",
            f"{main_street} AS shipping_address",
            "CASE WHEN o_orderkey % 4 < 2 THEN concat(o_orderkey div 4, ' Side St') "
            f"ELSE {main_street} END AS billing_address",
            "o_orderdate AS created_at",
            "o_orderdate AS updated_at",
            *_META,
        )

    def order_items(self) -> DataFrame:
        # unit price in whole cents, rounded half up
        return (
            self.read("lineitem")
            .withColumn("cents", F.expr("cast(round(l_extendedprice * 100) AS bigint)"))
            .withColumn("units", F.expr("cast(l_quantity AS bigint)"))
            .selectExpr(
                "concat(l_orderkey, '-', l_linenumber) AS order_item_id",
                "l_orderkey AS order_id",
                "l_partkey AS product_id",
                "cast(l_quantity AS int) AS quantity",
                "((2 * cents + units) div (2 * units)) / 100.0D AS unit_price",
                "l_extendedprice AS total_price",
                "l_shipdate AS created_at",
                *_META,
            )
        )

    def reviews(self) -> DataFrame:
        buyers = (
            self.read("orders")
            .groupBy(F.col("o_orderkey").alias("l_orderkey"))
            .agg(F.max("o_custkey").alias("o_custkey"))
        )
        return (
            self.read("lineitem")
            .filter("l_returnflag = 'R'")
            .join(buyers, "l_orderkey", "left")
            .selectExpr(
                "concat(l_orderkey, '-', l_partkey, '-', l_linenumber) AS review_id",
                "l_partkey AS product_id",
                "l_orderkey AS order_id",
                "o_custkey AS customer_id",
                "cast(1 + (l_orderkey + l_partkey + l_linenumber) % 5 AS int) AS review_score",
                "concat('Review of part ', l_partkey) AS review_text",
                "l_shipdate AS review_date",
                "cast(l_linenumber AS int) AS helpful_votes",
                "true AS verified_purchase",
                "l_shipdate AS created_at",
                "'historic' AS data_source",
                "'batch-0' AS batch_id",
                "l_shipdate AS loaded_at",
            )
        )

    def interactions(self) -> DataFrame:
        return self.read("events").selectExpr(
            "event_id",
            "user_id AS customer_id",
            "get_json_object(props, '$.k') AS product_id",
            "CASE event_type WHEN 'click' THEN 'cart_add' WHEN 'signup' THEN 'wishlist_add' "
            "WHEN 'error' THEN 'search' ELSE event_type END AS event_type",
            "ts AS event_date",
            "CASE cast(floor(value) AS bigint) % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' "
            "ELSE 'tablet' END AS device_type",
            "concat(user_id, '-', cast(ts AS date)) AS session_id",
            "ts AS created_at",
            *_META,
        )
