"""Bronze ingestion: new files of a feed as a bounded stream, tolerant of drifting types.

Executors list the landing folder. Paths that the feed's ledger lacks are added to it, a table whose files hold the paths of one
batch each, and the stream reads the ledger. So the driver remembers one ledger file per batch, and no path of the
landing folder, however many there are.

A Parquet scan fails if a file's physical type differs from the declared one, so the stream carries
only file paths. Each batch groups its files by footer schema, reads every group with its own
schema, brings it to the contract, and writes one directory named after the batch. A batch that
is repeated after a failure has the same number and files, and replaces its own directory.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import contracts
from siltworks.contracts import FeedContract
from siltworks.functions import casting, rescue
from siltworks.session import stored
from siltworks.sources import events_log, landing

LINEAGE = ("_source_file", "_source_path")

# Spark's file source otherwise skips files a week older than the newest one, which would lose
# files that arrive late with their original time.
_MAX_FILE_AGE = "36500d"
_LEDGER = "path string, run_id string"
_GENERATIONS = "feed string, generation int, at timestamp, run_id string"


@dataclass(frozen=True)
class Ingestion:
    """Where one run put its rows, and how many batches it took."""

    path: str
    generation: int
    run_id: str
    batches: int


def new_run_id() -> str:
    return str(uuid.uuid4())


def _log_path(state_dir: str, feed: str) -> str:
    return f"{state_dir}/{feed}/_generations"


def generation(spark: SparkSession, state_dir: str, feed: str) -> int | None:
    log = events_log.read(spark, _log_path(state_dir, feed), _GENERATIONS)
    return log.agg(F.max("generation").alias("g")).first()["g"]


def table_path(out_dir: str, feed: str, number: int) -> str:
    return f"{out_dir}/{feed}/gen={number}"


def read_bronze(spark: SparkSession, out_dir: str, state_dir: str, feed: str) -> DataFrame:
    """The rows of the current generation of a feed."""
    number = generation(spark, state_dir, feed)
    if number is None:
        raise LookupError(f"{feed} was never ingested into {out_dir}")
    return spark.read.parquet(table_path(out_dir, feed, number))


def load_files(spark: SparkSession, paths: DataFrame, contract: FeedContract, policy: str) -> DataFrame:
    """The rows of a bounded set of files under the contract, with file lineage."""
    groups = landing.schema_groups(landing.file_columns(paths))
    parts = [rescue.conform(landing.read_group(spark, files), contract, policy, LINEAGE) for files in groups.values()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def stamped(rows: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """The time and id of the run, one value for all rows of all its batches."""
    return rows.withColumns({"_ingested_at": F.lit(at).cast("timestamp"), "_run_id": F.lit(run_id)})


def note_new_files(spark: SparkSession, landing_dir: str, glob: str, ledger: str, run_id: str, files_per_batch: int) -> int:
    """Add the files that the ledger lacks to it, at most ``files_per_batch`` to a ledger file; how many there were.

    A file is known by its path. If this breaks off, paths that were not added are new the next time.
    """
    known = events_log.read(spark, ledger, _LEDGER).select("path")
    new = stored(landing.list_files(spark, landing_dir, glob).select("path").join(known, "path", "left_anti"), "new-files")
    n = new.count()
    if n:
        rows = new.withColumn("run_id", F.lit(run_id)).repartition(-(-n // files_per_batch))
        rows.write.option("maxRecordsPerFile", files_per_batch).mode("append").parquet(ledger)
    return n


def ingest(
    spark: SparkSession,
    contract: FeedContract,
    landing_dir: str,
    out_dir: str,
    state_dir: str,
    run_id: str | None = None,
    refresh: bool = False,
    files_per_batch: int = 1_000,
    policy: str = casting.RESCUE,
    timeout_seconds: int | None = None,
) -> Ingestion:
    """Load the files of a feed that no earlier run has loaded, then stop.

    ``files_per_batch`` bounds a batch, of which the driver holds the paths. Files are looked for in ``landing_dir`` and all folders below
    it. ``refresh`` loads a
    new generation with its own ledger, checkpoint and table. It becomes the current one when all files are in it; until
    then, and after a failure, readers see the old one, and the next refresh goes on where this one stopped.
    """
    run_id, now = run_id or new_run_id(), datetime.now(timezone.utc)
    current = generation(spark, state_dir, contract.feed)
    number = 0 if current is None else current + refresh
    out = table_path(out_dir, contract.feed, number)
    state = f"{state_dir}/{contract.feed}/gen={number}"
    # The schema a generation began with stays in force until a refresh.
    kept = contracts.load(spark, f"{state}/schema")
    if kept is None:
        contracts.save(spark, contract, f"{state}/schema")
        # A table without rows, for feeds that have no file yet.
        stamped(rescue.conform(spark.createDataFrame([], contract.struct()), contract, policy), run_id, now).select(
            "*", *[F.lit(None).cast("string").alias(c) for c in LINEAGE]
        ).write.mode("overwrite").parquet(f"{out}/_batch=-1")
    effective = kept or contract
    written: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = stamped(load_files(session, batch, effective, policy), run_id, now)
        rows.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
        written.append(batch_id)

    ledger = f"{state}/ledger"
    note_new_files(spark, landing_dir, effective.glob, ledger, run_id, files_per_batch)
    if not events_log.read(spark, ledger, _LEDGER).isEmpty():
        query = (
            spark.readStream.schema(_LEDGER)
            .option("maxFilesPerTrigger", 1)
            .option("maxFileAge", _MAX_FILE_AGE)
            .parquet(ledger)
            .select("path")
            .writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", f"{state}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        finished = query.awaitTermination(timeout_seconds) if timeout_seconds else query.awaitTermination() or True
        if not finished:
            query.stop()
            raise TimeoutError(f"{contract.feed}: not drained after {timeout_seconds} s")
    if number != current:
        entry = (contract.feed, number, now, run_id)
        events_log.append(spark, _log_path(state_dir, contract.feed), _GENERATIONS, [entry])
    return Ingestion(out, number, run_id, len(written))


def ingest_uniform(
    spark: SparkSession,
    contract: FeedContract,
    landing_dir: str,
    out: str,
    checkpoint: str,
    run_id: str | None = None,
) -> None:
    """The same for a feed whose types never drift: one declared schema and Spark's own file source and sink.

    That source lists the landing folder on the driver and remembers its paths there, so this is for folders of some thousand files.
    """
    (
        spark.readStream.schema(contract.struct())
        .option("pathGlobFilter", contract.glob)
        .option("maxFileAge", _MAX_FILE_AGE)
        .parquet(landing_dir)
        .select("*", F.col("_metadata.file_name").alias("_source_file"))
        .withColumns({"_ingested_at": F.current_timestamp(), "_run_id": F.lit(run_id or new_run_id())})
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
