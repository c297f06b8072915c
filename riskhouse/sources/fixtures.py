"""Transaction views derived from the driver's tables (see FIXTURES.md).

``transactions`` turns ``lineitem`` into bronze-shaped card transactions
(with natural duplicate ids); ``event_transactions`` turns ``events`` into
the stream's transactions.  Both are plain projections: they scan only the
columns they use and stay inside one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.operators.star import Dimension, star_join


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- fixed values: fixture categories --------------------------------------
# Card networks by key % 5 (4 -> missing), card types by key % 3 (2 -> missing).
NETWORKS = ["visa", "mastercard", "discover", "american express"]
CARD_TYPES = ["debit", "credit"]
# Email domains by key % 30: 0-27 -> d<n>.com, 28 -> the sentinel "0", 29 -> missing.
N_DOMAINS = 28
# --- end of fixed values ---------------------------------------------------


def _pick(key: Column, modulus: int, values: list[str]) -> Column:
    m = F.pmod(key, F.lit(modulus))
    expr = F.when(m == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(m == i, F.lit(v))
    return expr  # remaining residues -> null


def network(key: Column) -> Column:
    return _pick(key, 5, NETWORKS)


def card_type(key: Column) -> Column:
    return _pick(key, 3, CARD_TYPES)


def email_domain(key: Column) -> Column:
    m = F.pmod(key, F.lit(30))
    return (
        F.when(m < N_DOMAINS, F.concat(F.lit("d"), m.cast("string"), F.lit(".com")))
        .when(m == N_DOMAINS, F.lit(S.SENTINEL))
    )


def transactions(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    """Bronze-shaped transactions (13 message columns + arrival time); ``extra``: further columns of the line."""
    li = read_table(spark, sf_dir, "lineitem")
    tax_pct = F.round(F.col("l_tax") * 100)
    fraud = (
        (F.col("l_returnflag") == "R")
        & (tax_pct >= 6)
        & (F.pmod(F.col("l_orderkey"), F.lit(3)) == 0)
    )
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("double").alias("TransactionID"),
        F.when(fraud, F.lit(1.0)).otherwise(F.lit(0.0)).alias("isFraud"),
        F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date"))
        .cast("double")
        .alias("TransactionDT"),
        (F.col("l_extendedprice") / 50).alias("TransactionAmt"),
        F.col("l_returnflag").alias("ProductCD"),
        F.col("l_suppkey").cast("double").alias("card1"),
        F.when(F.col("l_quantity") > 45, F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity"))
        .alias("card2"),
        network(F.col("l_suppkey")).alias("card4"),
        card_type(F.col("l_suppkey")).alias("card6"),
        email_domain(F.col("l_partkey")).alias("P_emaildomain"),
        F.col("l_linenumber").cast("double").alias("C1"),
        F.col("l_quantity").alias("C2"),
        tax_pct.alias("D1"),
        F.col("l_shipdate").cast("timestamp").alias(S.EVENT_TIME),
        *(extra or []),
    )


def keyed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions`` with the keys of the tables they refer to and the order line's own further fields."""
    extra = ["l_orderkey", "l_partkey", "l_suppkey", "l_discount", "l_linestatus"]
    return transactions(spark, sf_dir, extra)


def dimensions(spark: SparkSession, sf_dir: str) -> list[Dimension]:
    """The tables around ``keyed_transactions``: orders, their customers, parts and suppliers."""

    def dimension(table: str, key: str, on: str, *columns: str) -> Dimension:
        return Dimension(read_table(spark, sf_dir, table), key, on, {c: F.col(c) for c in columns})

    return [
        dimension("orders", "o_orderkey", "l_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate"),
        dimension("customer", "c_custkey", "o_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"),
        dimension("part", "p_partkey", "l_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
        dimension("supplier", "s_suppkey", "l_suppkey", "s_nationkey", "s_acctbal"),
    ]


def feature_columns() -> dict[str, Column]:
    """The features beyond the message's, over a joined transaction (see FIXTURES.md)."""
    number = lambda c: F.col(c).cast("double")
    ship, order = F.to_date(S.EVENT_TIME), F.to_date("o_orderdate")
    start = F.lit("1992-01-01").cast("date")
    wait = F.datediff(ship, order).cast("double")
    return {
        "card3": number("p_size"), "card5": number("c_nationkey"),
        "addr1": (F.col("c_nationkey") * 100 + F.col("s_nationkey")).cast("double"), "addr2": number("s_nationkey"),
        "dist1": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")), "R_emaildomain": email_domain(F.col("o_custkey")),
        "C3": F.round(F.col("l_discount") * 100), "C4": F.col("o_totalprice"), "C5": F.col("p_retailprice"), "C6": F.col("c_acctbal"),
        "C7": F.col("s_acctbal"), "C8": F.pmod("l_partkey", F.lit(100)).cast("double"), "C9": F.pmod("o_custkey", F.lit(50)).cast("double"),
        "C10": F.pmod("l_suppkey", F.lit(10)).cast("double"), "C11": wait, "C12": F.month(order).cast("double"), "C13": F.year(order).cast("double"),
        "C14": F.col("C1") * F.col("C2"),
        "D2": F.col("TransactionDT"), "D3": F.datediff(order, start).cast("double"), "D4": F.when(wait >= 0, wait), "D5": F.dayofmonth(ship).cast("double"),
        "M1": F.col("o_orderstatus"), "M2": F.col("o_orderpriority"), "M3": F.col("c_mktsegment"), "M4": F.col("p_brand"), "M5": F.col("p_type"),
        "M6": F.col("l_linestatus"), "M7": F.when(F.col("l_discount") > 0.05, "T").when(F.col("l_discount") > 0, "F"),
        "M8": F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), "M9": F.split_part("p_name", F.lit(" "), F.lit(1)),
    }


def with_all_features(deduped: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated ``keyed_transactions`` with all 41 features, by a star join."""
    return star_join(deduped, *dimensions(spark, sf_dir)).withColumns(feature_columns())


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream transactions from ``events`` (unique ids, January 2024)."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        F.col("event_id").cast("double").alias("TransactionID"),
        F.when(k < 4, F.lit(1.0)).otherwise(F.lit(0.0)).alias("isFraud"),
        F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
        .cast("double")
        .alias("TransactionDT"),
        (F.col("value") * 4).alias("TransactionAmt"),
        F.upper(F.substring("event_type", 1, 1)).alias("ProductCD"),
        F.col("user_id").cast("double").alias("card1"),
        F.when(F.pmod(k, F.lit(10)) == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(100.0) + k)
        .alias("card2"),
        network(F.col("user_id")).alias("card4"),
        card_type(F.col("user_id")).alias("card6"),
        email_domain(F.col("user_id")).alias("P_emaildomain"),
        F.pmod(k, F.lit(7)).cast("double").alias("C1"),
        F.pmod(k, F.lit(11)).cast("double").alias("C2"),
        F.pmod(k, F.lit(13)).cast("double").alias("D1"),
        F.col("ts").cast("timestamp").alias(S.EVENT_TIME),
    )
