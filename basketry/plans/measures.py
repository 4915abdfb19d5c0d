"""Small measures over staged tables: statuses, tiers, shares, transitions, seasons."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import days_between, ratio, rounded_ratio
from basketry.operators.adjacency import adjacent_pairs

# Age ranges of the customer segments, both ends included.
AGE_SEGMENTS = {
    "Gen Z": (18, 25),
    "Young Millennials": (26, 32),
    "Older Millennials": (33, 40),
    "Gen X": (41, 56),
    "Boomers": (57, 75),
}
# Fixed value: ids of the latest extract start above this.
NEW_ID_OFFSET = 1_000_000


def _shares(counted: DataFrame, within: list[str], count: str) -> Column:
    """Share of each row's count in its group; only for small, already grouped tables."""
    return ratio(F.col(count), F.sum(count).over(Window.partitionBy(*within)))


def status_from_age(order_date: Column, as_of: date) -> Column:
    age = days_between(order_date, F.lit(as_of).cast("date"))
    return (
        F.when(age < 2, "Pending")
        .when(age < 4, "Processing")
        .when(age < 7, "Shipped")
        .when(age >= 7, "Delivered")
    )


def order_status_recency(orders: DataFrame, as_of: date) -> DataFrame:
    """Orders with the status their age implies."""
    return orders.select(
        "order_id", "order_date", status_from_age(F.col("order_date"), as_of).alias("status")
    )


def income_tier(income: Column) -> Column:
    return (
        F.when(income > 80000, "High Value").when(income > 50000, "Mid Value").otherwise("Low Value")
    )


def income_tiers(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy(income_tier(F.col("annual_income")).alias("tier"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("annual_income").alias("total_income"),
        )
    )


def price_band(price: Column) -> Column:
    return F.when(price > 500, "Premium").when(price > 100, "Mid-range").otherwise("Budget")


def price_band_scores(
    reviews: DataFrame, products: DataFrame, price: str = "base_price"
) -> DataFrame:
    """Review scores per price band, with their share in the band.

    Reviews fold to (product, score) before the price joins.
    """
    per_product = reviews.groupBy("product_id", "review_score").agg(F.count(F.lit(1)).alias("n"))
    bands = products.select("product_id", price_band(F.col(price)).alias("band"))
    counted = (
        per_product.join(bands, "product_id")
        .groupBy("band", "review_score")
        .agg(F.sum("n").alias("reviews"))
    )
    return counted.withColumn("share", _shares(counted, ["band"], "reviews"))


def age_segment(age: Column) -> Column:
    segment = None
    for name, (low, high) in AGE_SEGMENTS.items():
        hit = age.between(low, high)
        segment = F.when(hit, name) if segment is None else segment.when(hit, name)
    return segment.otherwise("Other")


def segment_share(customers: DataFrame) -> DataFrame:
    """Education and channel mix of each age segment, both from one scan."""
    tall = customers.select(
        age_segment(F.col("age")).alias("segment"),
        F.inline(
            F.array(
                F.struct(F.lit("education").alias("attribute"), F.col("education").alias("value")),
                F.struct(
                    F.lit("channel").alias("attribute"),
                    F.col("preferred_channel").alias("value"),
                ),
            )
        ),
    )
    counted = tall.groupBy("segment", "attribute", "value").agg(
        F.count(F.lit(1)).alias("customers")
    )
    return counted.withColumn("share", _shares(counted, ["segment", "attribute"], "customers"))


def is_new_customer(customer_id: Column, offset: int = NEW_ID_OFFSET) -> Column:
    return customer_id.cast("bigint") >= F.lit(offset)


def new_vs_returning(orders: DataFrame, offset: int = NEW_ID_OFFSET) -> DataFrame:
    """Customers, orders and revenue of new against returning customers."""
    per_customer = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount"))
    )
    return per_customer.groupBy(
        F.when(is_new_customer(F.col("customer_id"), offset), "new")
        .otherwise("returning")
        .alias("customer_kind")
    ).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("n").alias("orders"),
        F.sum("amount").alias("revenue"),
    )


def event_transitions(interactions: DataFrame) -> DataFrame:
    """How often one event type follows another in a session, and how likely."""
    pairs = adjacent_pairs(
        interactions, "session_id", ["event_date", "event_id"], "event_type", keep_sequence=False
    )
    counted = pairs.groupBy(
        F.col("source").alias("from_event"), F.col("target").alias("to_event")
    ).agg(F.sum("n").alias("transitions"))
    return counted.withColumn("probability", _shares(counted, ["from_event"], "transitions"))


def seasonality(orders: DataFrame, interactions: DataFrame) -> DataFrame:
    """Order value by month and weekday against the overall mean, and the hours of the
    day in which each device is used."""
    calendar = (
        orders.filter(F.col("order_date").isNotNull() & F.col("total_amount").isNotNull())
        .select(
            "total_amount",
            F.inline(
                F.array(
                    F.struct(
                        F.lit("month").alias("dimension"), F.month("order_date").alias("bucket")
                    ),
                    F.struct(
                        F.lit("weekday").alias("dimension"), F.weekday("order_date").alias("bucket")
                    ),
                )
            ),
        )
        .groupBy("dimension", "bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount"))
    )
    whole = Window.partitionBy("dimension")
    overall = ratio(F.sum("amount").over(whole), F.sum("n").over(whole))
    by_calendar = calendar.select(
        "dimension",
        "bucket",
        F.lit("all").alias("device_type"),
        "n",
        (ratio(F.col("amount"), F.col("n")) / overall).alias("factor"),
    )
    hours = (
        interactions.filter(F.col("event_date").isNotNull())
        .groupBy("device_type", F.hour("event_date").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_hour = hours.select(
        F.lit("hour").alias("dimension"),
        "bucket",
        "device_type",
        "n",
        _shares(hours, ["device_type"], "n").alias("factor"),
    )
    return by_calendar.unionByName(by_hour)


def delivered(orders: DataFrame, status: str = "Delivered") -> DataFrame:
    return orders.filter(F.col("status") == status)


def review_delay(reviews: DataFrame, orders: DataFrame, status: str = "Delivered") -> DataFrame:
    """Days between a delivered order and its reviews, as a histogram.

    Reviews fold to (order, day) before the join.
    """
    days = (
        reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id", F.to_date("loaded_at").alias("review_day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ordered = delivered(orders, status).select("order_id", "order_date")
    return (
        days.join(ordered, "order_id")
        .groupBy(days_between(F.col("order_date"), F.col("review_day")).alias("delay_days"))
        .agg(F.sum("n").alias("reviews"))
    )


def sentiment(score: Column) -> Column:
    return F.when(score >= 4, "positive").when(score >= 3, "neutral").otherwise("negative")


def review_sentiment(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy(sentiment(F.col("review_score")).alias("sentiment")).agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("review_score").alias("score_sum")
    )


def _rating(score_sum: Column, scores: Column) -> Column:
    return F.when(scores > 0, rounded_ratio(score_sum, scores, 1))


def refresh_ratings(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Products with rating and review count from their reviews; unreviewed ones keep theirs."""
    fresh = (
        reviews.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("_count"),
            _rating(F.sum("review_score"), F.count("review_score")).alias("_rating"),
        )
    )
    return products.join(fresh, "product_id", "left").select(
        *[
            F.coalesce(F.col("_rating").cast("decimal(3,1)"), F.col("rating")).alias("rating")
            if c == "rating"
            else F.coalesce(F.col("_count").cast("int"), F.col("review_count")).alias(c)
            if c == "review_count"
            else F.col(c)
            for c in products.columns
        ]
    )
