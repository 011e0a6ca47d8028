"""Feeds, landing files, bronze and rescued values, on orders and events."""

from __future__ import annotations

import contextlib
import uuid
from functools import cache

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import FeedContract, Field
from siltworks.functions import casting, rescue
from siltworks.functions.casting import money_sum
from siltworks.functions.dates import month_text
from siltworks.operators import harmonize, quality
from siltworks.plans.testbed.standins import query, table
from siltworks.session import work_dir
from siltworks.sources import landing, tables
from siltworks.streaming import ingest


# The same orders as two feeds with their own names and column order.
URGENT = FeedContract(
    "urgent",
    "urgent_*.parquet",
    (
        Field("order_id", "bigint", "OrderID"),
        Field("placed_at", "timestamp_ntz", "u_placed"),
        Field("amount", "double", "Total"),
        Field("surcharge", "double"),
    ),
)
NORMAL = FeedContract(
    "normal",
    "normal_*.parquet",
    (
        Field("amount", "double", "n_total"),
        Field("order_id", "bigint", "n_order"),
        Field("placed_at", "timestamp_ntz", "n_placed"),
        Field("status", "string"),
    ),
)


@query
def feeds_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    is_urgent = F.coalesce(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(False))
    urgent = orders.filter(is_urgent).select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_orderdate").alias("u_placed"),
        F.col("o_totalprice").alias("Total"),
        (F.col("o_custkey") / 100).alias("surcharge"),
    )
    normal = orders.filter(~is_urgent).select(
        F.col("o_totalprice").alias("n_total"),
        F.col("o_orderkey").cast("int").alias("n_order"),
        F.col("o_orderdate").alias("n_placed"),
        F.col("o_orderstatus").alias("status"),
    )
    feeds = [harmonize.to_canonical(df, c, {"service": c.feed}) for df, c in ((urgent, URGENT), (normal, NORMAL))]
    return harmonize.union_feeds(*feeds)


@query
def feed_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    feeds = {name: table(spark, sf, name) for name in ("orders", "lineitem", "events")}
    return tables.shape_report(feeds)


@query
def rescue_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose value was lost for small amounts, filled from the JSON beside them."""
    events = table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.when(F.col("value") >= 50, F.col("value")).alias("value"),
        F.lit(None).cast("bigint").alias("code"),
        F.col("props").alias(rescue.RESCUED),
    )
    plan = {"value": ("double", ["K", "k"]), "code": ("bigint", ["k"])}
    return harmonize.recover_rescued(events, plan).drop(rescue.RESCUED)


ORDER_FEED = FeedContract(
    "orders",
    "*.parquet",
    (
        Field("order_key", "bigint", "o_orderkey"),
        Field("customer_key", "bigint", "o_custkey"),
        Field("status", "string", "o_orderstatus"),
        Field("total_price", "double", "o_totalprice"),
        Field("order_date", "timestamp_ntz", "o_orderdate"),
        Field("priority", "string", "o_orderpriority"),
    ),
)


@query
def rescued_values(spark: SparkSession, sf: str) -> DataFrame:
    """Orders under a contract too narrow for them: what fits, and what is rescued."""
    narrow = FeedContract(
        "orders",
        "*.parquet",
        (
            Field("o_orderkey", "int"),
            Field("o_totalprice", "bigint"),
            Field("o_orderpriority", "int"),
            Field("o_orderdate", "date"),
        ),
    )
    orders = table(spark, sf, "orders").withColumnRenamed("o_totalprice", "O_TotalPrice")
    return rescue.conform(orders, narrow).select(
        "o_orderkey",
        "o_totalprice",
        "o_orderpriority",
        "o_orderdate",
        rescue.rescued_field("O_TotalPrice", "double").alias("rescued_price"),
        rescue.rescued_field("o_orderpriority", "string").alias("rescued_priority"),
        rescue.rescued_field("o_custkey", "bigint").alias("rescued_custkey"),
    )


@cache
def drifted_landing(spark: SparkSession, sf: str) -> str:
    """All orders as monthly folders of files in three schemas, written once for each session."""
    place = work_dir(spark, "landing")
    orders = table(spark, sf, "orders").withColumn("period", month_text(F.col("o_orderdate")))
    month = F.month("o_orderdate")
    early = orders.filter((month <= 4) | month.isNull())
    middle = orders.filter(month.between(5, 8)).withColumns(
        {"o_custkey": F.col("o_custkey").cast("int"), "o_totalprice": F.col("o_totalprice").cast("decimal(15,2)")}
    )
    odd = F.when(F.col("o_custkey") < 50, F.concat(F.lit("C-"), "o_custkey")).otherwise(F.col("o_custkey").cast("string"))
    late = (
        orders.filter(month >= 9)
        .withColumns({"o_custkey": odd, "channel": F.lower("o_orderpriority")})
        .withColumnRenamed("o_totalprice", "O_TotalPrice")
    )
    for rows in (early, middle, late):
        rows.hint("rebalance", "period").write.mode("append").partitionBy("period").parquet(place)
    return place


@query
def bronze_stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    place, out = drifted_landing(spark, sf), work_dir(spark, "bronze")
    ingest.ingest(spark, ORDER_FEED, place, out, f"{out}/_state")
    rows = ingest.read_bronze(spark, out, f"{out}/_state", ORDER_FEED.feed)
    return with_period(rows).groupBy("period").agg(
        F.count("*").alias("rows_total"), money_sum("o_totalprice").alias("revenue")
    )


@cache
def bronze_orders(spark: SparkSession, sf: str) -> str:
    """The drifted orders as a bronze table, loaded once for each session."""
    place, out = drifted_landing(spark, sf), work_dir(spark, "bronze")
    return ingest.ingest(spark, ORDER_FEED, place, out, f"{out}/_state").path


def with_period(rows: DataFrame) -> DataFrame:
    return rows.withColumn("period", F.regexp_extract("_source_path", ORDER_FEED.period_pattern, 1))


@query
def rescue_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_period(spark.read.parquet(bronze_orders(spark, sf)))
    return quality.rescue_audit(rows, ["period"], ["o_custkey"])


@query
def bronze_recovered(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze orders in canonical form, with what their rescued JSON still holds."""
    rows = harmonize.to_canonical(spark.read.parquet(bronze_orders(spark, sf)), ORDER_FEED)
    rescued_key = rescue.rescued_field("o_custkey", "string")
    return rows.select(
        "order_key",
        "customer_key",
        "total_price",
        "order_date",
        rescued_key.alias("rescued_customer"),
        rescue.rescued_field("channel", "string").alias("channel"),
    )


@query
def bronze_uniform_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A feed whose types do not drift, through Spark's own file source and sink."""
    place = work_dir(spark, "uniform")
    table(spark, sf, "orders").write.parquet(f"{place}/landing")
    for _ in range(2):
        ingest.ingest_uniform(spark, ORDER_FEED, f"{place}/landing", f"{place}/bronze", f"{place}/state")
    stored = spark.read.parquet(f"{place}/bronze")
    return stored.groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.count_distinct("_run_id").alias("runs"))


@query
def bronze_second_run(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per run id after two runs over the same files: the second adds none."""
    place, out = drifted_landing(spark, sf), work_dir(spark, "bronze")
    for run_id in ("first", "second"):
        run = ingest.ingest(spark, ORDER_FEED, place, out, f"{out}/_state", run_id, files_per_batch=500)
    return spark.read.parquet(run.path).groupBy(F.col("_run_id").alias("run_id")).agg(F.count("*").alias("n_rows"))


def twice_landed(spark: SparkSession, sf: str) -> tuple[str, str]:
    """A landing folder with the drifted orders, loaded, and a folder of bronze beside it."""
    place, out = drifted_landing(spark, sf), work_dir(spark, "bronze")
    ingest.ingest(spark, ORDER_FEED, place, out, f"{out}/_state", "first")
    return place, out


@query
def bronze_after_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per run after everything was loaded anew: only the new generation is seen, and it has all rows."""
    place, out = twice_landed(spark, sf)
    ingest.ingest(spark, ORDER_FEED, place, out, f"{out}/_state", "again", refresh=True)
    rows = ingest.read_bronze(spark, out, f"{out}/_state", ORDER_FEED.feed)
    return rows.groupBy(F.col("_run_id").alias("run_id")).agg(F.count("*").alias("n_rows"))


@query
def bronze_after_failed_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per run after a refresh that breaks off: the old generation stays the one that is seen."""
    place, out = twice_landed(spark, sf)
    with contextlib.suppress(StreamingQueryException):  # a policy that the drifted files do not satisfy
        ingest.ingest(spark, ORDER_FEED, place, out, f"{out}/_state", "again", refresh=True, policy=casting.STRICT)
    rows = ingest.read_bronze(spark, out, f"{out}/_state", ORDER_FEED.feed)
    return rows.groupBy(F.col("_run_id").alias("run_id")).agg(F.count("*").alias("n_rows"))


@query
def bronze_empty_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Two feeds told apart by glob in one folder, of which one has no file yet: its table has no row."""
    place, out = drifted_landing(spark, sf), work_dir(spark, "bronze")
    missing = FeedContract("returns", "returns_*.parquet", ORDER_FEED.fields)
    counts = []
    for contract in (ORDER_FEED, missing):
        ingest.ingest(spark, contract, place, out, f"{out}/_state")
        rows = ingest.read_bronze(spark, out, f"{out}/_state", contract.feed)
        counts.append(rows.agg(F.lit(contract.feed).alias("feed"), F.count("*").alias("n_rows"), F.count("o_orderkey").alias("n_keys")))
    return counts[0].unionByName(counts[1])


@query
def ingest_instants(spark: SparkSession, sf: str) -> DataFrame:
    """A run over one month's folder and one over all, in batches of two files: each has one instant for all its rows."""
    place, out = drifted_landing(spark, sf), work_dir(spark, "bronze")
    month = table(spark, sf, "orders").agg(month_text(F.min("o_orderdate"))).first()[0]
    for run_id, folder in (("first", f"{place}/period={month}"), ("second", place)):
        ingest.ingest(spark, ORDER_FEED, folder, out, f"{out}/_state", run_id, files_per_batch=2 if run_id == "first" else 40)
    rows = ingest.read_bronze(spark, out, f"{out}/_state", ORDER_FEED.feed).groupBy(F.col("_run_id").alias("run_id"))
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct("_ingested_at").alias("n_instants"))


@query
def catalog_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A named table written, replaced under another schema, and read by name."""
    name = f"siltworks_orders_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    tables.write_table(orders.select("o_orderkey", "o_orderstatus"), name)
    tables.write_table(orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price")), name)
    return tables.read_table(spark, name)


@query
def nulled_values(spark: SparkSession, sf: str) -> DataFrame:
    """Orders under a contract too narrow for them, where what does not fit is dropped."""
    narrow = FeedContract("orders", "*.parquet", (Field("o_orderkey", "bigint"), Field("o_totalprice", "bigint"), Field("o_orderdate", "date")))
    return rescue.conform(table(spark, sf, "orders"), narrow, casting.NULL).select("o_orderkey", "o_totalprice", "o_orderdate")


@query
def strict_values(spark: SparkSession, sf: str) -> DataFrame:
    """Orders under a contract that they satisfy, where anything else would raise."""
    wide = FeedContract("orders", "*.parquet", (Field("o_orderkey", "decimal(20,0)"), Field("o_orderstatus", "string")))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return rescue.conform(rows, wide, casting.STRICT).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus")


@query
def inferred_reference(spark: SparkSession, sf: str) -> DataFrame:
    """A reference file whose types are inferred from its text."""
    place = work_dir(spark, "parts")
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("SuppKey"), F.col("s_name").alias("Name"), F.col("s_nationkey").alias("Nation"))
    suppliers.write.option("header", True).csv(place)
    read = tables.read_reference_csv(spark, place)
    kinds = F.concat_ws(",", *[F.lit(f"{f.name}:{f.dataType.simpleString()}") for f in read.schema if not f.name.startswith("_")])
    return read.select("suppkey", "name", "nation", kinds.alias("kinds"))


@query
def schema_drift_report(spark: SparkSession, sf: str) -> DataFrame:
    columns = landing.file_columns(landing.inventory(spark, drifted_landing(spark, sf)))
    return landing.drift_report(columns).select("column", "type", "n_variants")


@query
def schema_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    columns = landing.file_columns(landing.inventory(spark, drifted_landing(spark, sf)))
    found = landing.schema_mismatches(columns, ORDER_FEED)
    return found.select("column", "type", "declared", "problem").distinct()


@query
def inferred_feed_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The contract that the files themselves suggest: the wider type of each column."""
    contract = landing.infer_contract(
        spark, drifted_landing(spark, sf), "orders", "*.parquet", hints={"o_custkey": "bigint"}
    )
    lines = [F.struct(F.lit(f.name).alias("column"), F.lit(f.type).alias("type")) for f in contract.fields]
    return spark.range(1).select(F.inline(F.array(*lines)))


@query
def file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    files = landing.inventory(spark, drifted_landing(spark, sf))
    return files.select("file_name", "bytes").orderBy("file_name")


@query
def manifest_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Months that orders should fill, against the months that have files."""
    bounds = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
    span = F.sequence(F.trunc("low", "year"), F.trunc("high", "month"), F.expr("interval 1 month"))
    months = bounds.select(F.explode(span).alias("m"))
    wanted = months.select(F.year("m").cast("string").alias("year"), F.date_format("m", "MM").alias("month"))
    manifest = landing.expand_manifest(wanted, "period={year}-{month}", "folder")
    files = landing.inventory(spark, drifted_landing(spark, sf))
    present = files.select(F.element_at(F.split("path", "/"), -2).alias("folder"))
    return landing.completeness(manifest, present, "folder")
