"""State tables kept by upserts: of rows and of checkpoints, as frames or stored as increments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.scalar import is_quota_error
from lakeloom.operators.increments import IncrementTable, same_keys
from lakeloom.operators.keyed import latest_by_key

DONE = ["COMPLETED", "SKIPPED"]


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Rows of ``target`` whose key ``source`` lacks, and all of ``source``; null keys are equal to each other.

    A key that ``source`` has twice is an error, as the result would be open.
    """
    if check and source.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError("the source holds a key more than once")
    kept = target.alias("t").join(source.select(*keys).alias("s"), same_keys("t", "s", keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def open_table(spark: SparkSession, name: str, keys: list[str], order: str | None = None, **rules) -> IncrementTable:
    """The keyed table of that name below the warehouse; see :class:`IncrementTable` for what its rules may be."""
    context = spark.sparkContext
    if not context.master.startswith("local") and not context.getConf().contains("spark.sql.warehouse.dir"):
        raise ValueError("set spark.sql.warehouse.dir to a folder that the driver and the executors share")
    return IncrementTable(spark, f"{spark.conf.get('spark.sql.warehouse.dir')}/{name.replace('.', '/')}.increments", keys, order, **rules)


def merge_into(spark: SparkSession, name: str, source: DataFrame, keys: list[str], order: str | None = None, add_columns: bool = False) -> DataFrame:
    """Upsert into the keyed table ``name`` and return it; a name without a schema also becomes a view of the session.

    What counts, what fails and what happens to a merge that breaks off: see :class:`IncrementTable`. A name that
    another table or view has is an error.
    """
    table = open_table(spark, name, keys, order)
    if table.head() is None and spark.catalog.tableExists(name):
        raise ValueError(f"{name} is not a table that merge_into keeps")
    table.merge(source, add_columns=add_columns)
    rows = table.read()
    if "." not in name:
        rows.createOrReplaceTempView(name)
    return rows


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and those rows of ``source`` whose key it lacks."""
    new = source.alias("s").join(target.select(*keys).alias("t"), same_keys("s", "t", keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def seed_windows(checkpoint: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows not known yet, added as PENDING."""
    fresh = windows.select("window_start", "window_end").withColumn("status", F.lit("PENDING")).withColumn("records", F.lit(0).cast("bigint"))
    return insert_if_absent(checkpoint, fresh, ["window_start", "window_end"])


def pending_windows(windows: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Windows that no COMPLETED row covers."""
    done = checkpoint.where("status = 'COMPLETED'").select("window_start", "window_end")
    return windows.join(done, ["window_start", "window_end"], "left_anti")


WINDOW_KEYS = ["window_start", "window_end"]


def window_upsert(checkpoint: DataFrame, updates: DataFrame) -> DataFrame:
    """Checkpoint of windows (window_start, window_end, status, records, updated_at) after a batch of updates.

    The newest update of a window gives its status, records and time; windows not known yet are added. An update older
    than what the checkpoint holds changes nothing; one as old as that replaces it.
    """
    columns = [*WINDOW_KEYS, "status", "records", "updated_at"]
    both = checkpoint.select(*columns, F.lit(0).alias("batch")).unionByName(updates.select(*columns, F.lit(1).alias("batch")))
    order = [F.desc_nulls_last("updated_at"), F.desc("batch"), F.col("status"), F.desc("records")]
    return latest_by_key(both, WINDOW_KEYS, order).select(*columns)


def settle_windows(attempts: DataFrame, at: F.Column) -> DataFrame:
    """Updates for :func:`window_upsert` from one run's attempts at windows (window_start, window_end, records, error).

    Windows are worked off in order. One without an error is COMPLETED with its records. The first that meets a used-up
    quota ends the run: it stays PENDING with what it got so far, and those after it stay PENDING with nothing, so that
    the next run starts there. A window with another error stays PENDING too and stops nothing.
    """
    quota = is_quota_error(F.col("error"))
    stop = attempts.where(quota).agg(F.min(F.struct(*WINDOW_KEYS)).alias("stop"))
    place = F.struct(*WINDOW_KEYS)
    before, here = F.col("stop").isNull() | (place < F.col("stop")), place == F.col("stop")
    status = F.when(before & F.col("error").isNull(), "COMPLETED").otherwise("PENDING")
    records = F.when(before | here, F.coalesce("records", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    rows = attempts.join(F.broadcast(stop), F.lit(True))  # one row
    return rows.select(*WINDOW_KEYS, status.alias("status"), records.alias("records"), at.alias("updated_at"))


CHECKPOINT_KEYS = ["run_id", "target_date", "fixture_id", "endpoint"]


def checkpoint_upsert(checkpoint: DataFrame, updates: DataFrame, force: bool = False) -> DataFrame:
    """Checkpoint rows after a batch of updates, one row a key in either.

    A COMPLETED row is not taken back unless ``force``; the earlier start stays; attempts add up; completed_at_utc is set
    only for rows that are done.
    """
    names = [*CHECKPOINT_KEYS, "status", "attempt_count", "last_error", "started_at_utc", "completed_at_utc"]
    both = checkpoint.select(*names, F.lit(0).alias("batch")).unionByName(updates.select(*names, F.lit(1).alias("batch")))
    new, old = (F.max(F.when(F.col("batch") == b, F.struct("status", "last_error", "completed_at_utc"))) for b in (1, 0))
    merged = both.groupBy(*CHECKPOINT_KEYS).agg(new.alias("new"), old.alias("old"), F.sum("attempt_count").alias("attempt_count"), F.min("started_at_utc").alias("started_at_utc"))
    keep = F.col("new").isNull() | ((F.coalesce(F.col("old.status"), F.lit("")) == "COMPLETED") & (F.col("new.status") != "COMPLETED") & F.lit(not force))
    state = merged.withColumn("state", F.when(keep, F.col("old")).otherwise(F.col("new")))
    done = F.when(F.col("state.status").isin(DONE), F.col("state.completed_at_utc"))
    return state.select(*CHECKPOINT_KEYS, F.col("state.status").alias("status"), F.col("attempt_count").cast("bigint").alias("attempt_count"), F.col("state.last_error").alias("last_error"), "started_at_utc", done.alias("completed_at_utc"))


def checkpoint_table(spark: SparkSession, path: str) -> IncrementTable:
    """A stored checkpoint: what :func:`checkpoint_upsert` says of two tables holds for all batches ever merged, whatever
    of them has been compacted."""
    return IncrementTable(spark, path, CHECKPOINT_KEYS, rules={"attempt_count": "sum", "started_at_utc": "min"}, first=("status", "COMPLETED"))


def record_attempts(table: IncrementTable, updates: DataFrame, force: bool = False) -> DataFrame:
    """Merge a batch of updates, one row a key, into a stored checkpoint and return the checkpoint."""
    done = F.when(F.col("status").isin(DONE), F.col("completed_at_utc"))
    rows = updates.select(*CHECKPOINT_KEYS, "status", F.col("attempt_count").cast("bigint").alias("attempt_count"), "last_error", "started_at_utc", done.alias("completed_at_utc"))
    table.merge(rows, force=force)
    return table.read()


def window_table(spark: SparkSession, path: str) -> IncrementTable:
    """A stored checkpoint of windows, of which the newest update counts, as :func:`window_upsert` says."""
    return IncrementTable(spark, path, WINDOW_KEYS, order="updated_at")


def backfill(table: IncrementTable, windows: DataFrame, attempt: Callable[[DataFrame], DataFrame], at: F.Column, scratch: str) -> DataFrame:
    """One run over the windows that a stored checkpoint has not COMPLETED; the next run goes on where this one ended.

    Windows it doesn't know yet are added as PENDING. ``attempt`` takes the windows to do and gives a row for each with
    records and error, landing its payloads on the way; that is written to ``scratch`` before it is settled, so it
    happens once. Returns the checkpoint.
    """
    begun = F.lit(None).cast("timestamp")  # before every update
    columns = [*WINDOW_KEYS, "status", "records", "updated_at"]
    fresh = windows.select(*WINDOW_KEYS).distinct()
    if table.head() is not None:
        fresh = fresh.join(table.read().select(*WINDOW_KEYS), WINDOW_KEYS, "left_anti")
    table.merge(fresh.select(*WINDOW_KEYS, F.lit("PENDING").alias("status"), F.lit(0).cast("bigint").alias("records"), begun.alias("updated_at")))
    attempt(pending_windows(windows.select(*WINDOW_KEYS).distinct(), table.read())).write.parquet(scratch)
    table.merge(settle_windows(table.spark.read.parquet(scratch), at).select(*columns))
    return table.read()


def completed_keys(checkpoint: DataFrame, endpoint: str, target_date=None) -> DataFrame:
    """Keys that an endpoint has completed, each once."""
    rows = checkpoint.where((F.col("endpoint") == endpoint) & (F.col("status") == "COMPLETED") & F.col("fixture_id").isNotNull())
    if target_date is not None:
        rows = rows.where(F.col("target_date") == F.lit(target_date))
    return rows.select("fixture_id").distinct()


# --- views of runs ---


def run_summary(checkpoint: DataFrame) -> DataFrame:
    """Counts by status and the time span of each run, day and endpoint."""
    count = lambda s: F.count_if(F.col("status") == s).alias(f"{s.lower()}_count")
    statuses = ["PENDING", "COMPLETED", "SKIPPED", "FAILED", "QUARANTINED"]
    return checkpoint.groupBy("run_id", "target_date", "endpoint").agg(F.count("*").alias("total_count"), *map(count, statuses), F.min("started_at_utc").alias("first_started"), F.max("completed_at_utc").alias("last_completed"))


def failures(checkpoint: DataFrame) -> DataFrame:
    return checkpoint.where(F.col("status").isin("FAILED", "QUARANTINED"))


def pending_age(checkpoint: DataFrame, now: F.Column) -> DataFrame:
    """Pending rows with the whole minutes since they started."""
    return checkpoint.where("status = 'PENDING'").withColumn("pending_minutes", F.timestamp_diff("MINUTE", F.col("started_at_utc"), now))


def create_ops_views(spark: SparkSession, checkpoint_table: str, prefix: str, temporary: bool = False) -> list[str]:
    """Named views of runs, failures and pending rows over a checkpoint table."""
    kind = "temporary view" if temporary else "view"
    statuses = ", ".join(f"count_if(status = '{s}') as {s.lower()}_count" for s in ("PENDING", "COMPLETED", "SKIPPED", "FAILED", "QUARANTINED"))
    views = {
        f"{prefix}run_summary": f"select run_id, target_date, endpoint, count(*) as total_count, {statuses}, min(started_at_utc) as first_started, max(completed_at_utc) as last_completed from {checkpoint_table} group by run_id, target_date, endpoint",
        f"{prefix}failures": f"select * from {checkpoint_table} where status in ('FAILED', 'QUARANTINED')",
        f"{prefix}pending": f"select * from {checkpoint_table} where status = 'PENDING'",
    }
    for name, sql in views.items():
        spark.sql(f"create or replace {kind} {name} as {sql}")
    return list(views)


def batch_summary(eligibility: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """One row: counts of what was discovered, eligible, and of each outcome."""
    a = eligibility.agg(F.count("*").alias("discovered"), F.count_if("is_eligible").alias("eligible"))
    names = {"COMPLETED": "ingested", "SKIPPED": "skipped", "FAILED": "failed", "QUARANTINED": "quarantined", "PENDING": "pending"}
    b = checkpoint.agg(*[F.count_if(F.col("status") == s).alias(n) for s, n in names.items()], F.min("target_date").alias("first_date"), F.max("target_date").alias("last_date"))
    return a.join(F.broadcast(b), F.lit(True))  # one row each
