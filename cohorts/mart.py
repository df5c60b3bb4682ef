"""Customer feature table derived from ``customer`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions.skew import SAFE_ROWS, likely_hot_keys

# Fixed value: months covered by the order history, divisor of the *_FREQUENCY columns.
MONTHS = 80.0


def _money(condition, amount):
    return F.sum(F.when(condition, amount).otherwise(F.lit(0.0)))


def _hits(condition):
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def _by_customer(orders: DataFrame) -> DataFrame:
    """One row per customer, over one row per customer, year and month."""
    price = F.col("o_totalprice")
    oneoff = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    pending = F.col("o_orderstatus") == "P"
    finished = F.col("o_orderstatus") == "F"
    monthly = orders.groupBy(
        "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(
        F.sum(price).alias("spend"),
        _money(oneoff, price).alias("oneoff_spend"),
        _money(~oneoff, price).alias("installment_spend"),
        _money(pending, price).alias("pending_spend"),
        _money(finished, price).alias("finished_spend"),
        F.count(F.lit(1)).alias("n"),
        _hits(oneoff).alias("n_oneoff"),
        _hits(pending).alias("n_pending"),
        _hits(finished).alias("n_finished"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", price)).alias("top_urgent"),
        F.min(F.when(pending, price)).alias("low_pending"),
    )
    n = F.sum("n")
    return monthly.groupBy("o_custkey").agg(
        (F.count(F.lit(1)) / MONTHS).alias("BALANCE_FREQUENCY"),
        F.round(F.sum("spend"), 2).alias("PURCHASES"),
        F.round(F.sum("oneoff_spend"), 2).alias("ONEOFF_PURCHASES"),
        F.round(F.sum("installment_spend"), 2).alias("INSTALLMENTS_PURCHASES"),
        F.round(F.sum("pending_spend"), 2).alias("CASH_ADVANCE"),
        (n / MONTHS).alias("PURCHASES_FREQUENCY"),
        (F.sum("n_oneoff") / MONTHS).alias("ONEOFF_PURCHASES_FREQUENCY"),
        ((n - F.sum("n_oneoff")) / MONTHS).alias("PURCHASES_INSTALLMENTS_FREQUENCY"),
        (F.sum("n_pending") / MONTHS).alias("CASH_ADVANCE_FREQUENCY"),
        F.sum("n_pending").alias("CASH_ADVANCE_TRX"),
        n.alias("PURCHASES_TRX"),
        F.max("top_urgent").alias("CREDIT_LIMIT"),
        F.round(F.sum("finished_spend"), 2).alias("PAYMENTS"),
        F.min("low_pending").alias("MINIMUM_PAYMENTS"),
        (F.sum("n_finished") / n).alias("PRC_FULL_PAYMENT"),
        F.count_distinct("year").alias("TENURE"),
    )


def customer_mart(spark: SparkSession, base: str, safe_rows: int = SAFE_ROWS) -> DataFrame:
    """One row per customer with at least one order, in the customer schema.

    An order is shuffled once, to its customer, and folded there. Orders of a customer holding a
    large share of all orders are folded to (customer, year, month) first, so they leave each map task
    as at most one row per month.
    """
    columns = ["o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus"]
    orders = spark.read.parquet(f"{base}/orders.parquet").select(*columns).where("o_custkey is not null")
    customer = spark.read.parquet(f"{base}/customer.parquet")
    hot = likely_hot_keys(orders, "o_custkey", safe_rows)
    is_hot = F.col("o_custkey").isin(hot)
    per_customer = _by_customer((orders.where(~is_hot) if hot else orders).repartition("o_custkey"))
    if hot:
        per_customer = per_customer.unionByName(_by_customer(orders.where(is_hot)))
    joined = customer.select("c_custkey", "c_acctbal").join(
        per_customer, F.col("c_custkey") == F.col("o_custkey")
    )
    measures = [c for c in per_customer.columns if c != "o_custkey"]
    return joined.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("CUST_ID"),
        F.col("c_acctbal").alias("BALANCE"),
        *measures,
    )


def embedding_frame(spark: SparkSession, base: str) -> tuple[DataFrame, list[str]]:
    """Embeddings as wide numeric rows: a second clustering input with given labels."""
    vectors = spark.read.parquet(f"{base}/embeddings.parquet")
    width = 64
    names = [f"e{i:02d}" for i in range(width)]
    wide = vectors.select(
        F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("CUST_ID"),
        F.col("label").cast("int").alias("CLUSTER"),
        *[F.round(F.col("embedding")[i].cast("double"), 6).alias(n) for i, n in enumerate(names)],
    )
    return wide, names
