"""Landed payload files as a stream: each micro-batch becomes envelopes and an upsert into the typed table."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators import state
from lakeloom.operators.increments import IncrementTable
from lakeloom.sources.io import land_envelopes

_ENVELOPE = "fixture_id int, landed_at timestamp, raw_payload string"


def land_files(rows: DataFrame, folder: str) -> None:
    """Add rows fixture_id, landed_at, raw_payload to a folder as compressed files of JSON lines."""
    rows.select("fixture_id", "landed_at", "raw_payload").write.mode("append").option("compression", "gzip").json(folder)


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """What a folder of landed files holds now."""
    return spark.read.schema(_ENVELOPE).json(folder)


def landing_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Files of JSON lines fixture_id, landed_at, raw_payload as a stream."""
    return spark.readStream.schema(_ENVELOPE).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def without_replays(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Each payload once: repeats of a fixture's payload that arrive within ``delay`` are dropped, and so is their state
    after it. The state and the shuffle hold the hash in 32 bytes; it becomes text after them."""
    hashed = stream.withColumn("response_hash", F.unhex(F.sha2("raw_payload", 256)))
    once = hashed.withWatermark("landed_at", delay).dropDuplicatesWithinWatermark(["fixture_id", "response_hash"])
    return once.withColumn("response_hash", F.lower(F.hex("response_hash")))


_NEWEST = "fixture_id int, landed bigint, raw_payload string, response_hash string"


#: What the state keeps of a fixture: its newest landing's time and half its hash, and when it last had one.
_KNOWN = np.dtype([("fixture", "<i8"), ("landed", "<i8"), ("hash", "S32"), ("seen", "<i8")])
_NONE = -(2**63)
#: Bytes of rows that a task gathers before it packs them by bucket.
_PACK_BYTES = 32 << 20


def packed(batches: Iterator[pa.RecordBatch], at_once: int = _PACK_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows with a column ``bucket`` as one compressed Arrow stream a bucket, for each ``at_once`` bytes: payloads of a kind
    shrink to a fraction beside each other, and that is what gets shuffled."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).sort_by("bucket").combine_chunks()
        bucket, rows = rows["bucket"].to_numpy(), rows.drop_columns("bucket")
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        texts = []
        for start, end in zip(starts, [*starts[1:], len(bucket)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(rows.slice(start, end - start))
            texts.append(sink.getvalue().to_pybytes())
        return pa.record_batch({"bucket": pa.array(bucket[starts], pa.int64()), "rows": pa.array(texts, pa.binary())})

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held, size = [*held, batch], size + batch.nbytes
        if size >= at_once:
            yield pack(held)
            held, size = [], 0
    if held:
        yield pack(held)


def newest_landings(stream: DataFrame, idle: str = "7 days", buckets: int = 1024) -> DataFrame:
    """Of each fixture the landing that is newer than all before it, if a batch has one (of equal times the least hash).

    The state keeps 56 bytes a fixture, not its payload, packed by ``buckets`` of fixtures (a few hundred fixtures a
    bucket keep both the calls and what one rewrites small), and drops a fixture when its bucket is next touched, ``idle``
    or more after its last landing (timeouts of Spark's own would keep a run over what has landed from ending); then an
    older landing may come through again, which an upsert by landing time ignores. Landings are late only by each
    other, never by a watermark, so the first landing of a fixture always comes through, however old. Null times are
    older than all others, and rows without a fixture count as one fixture. Landings are shuffled packed (``packed``) and
    hashed after that.
    """
    kept = int(pd.Timedelta(idle).total_seconds() * 1_000_000)

    def keep(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = time.time_ns() // 1000
        known = np.frombuffer(state.get[0], _KNOWN) if state.exists else np.empty(0, _KNOWN)
        known = known[known["seen"] > now - kept]
        rows = pa.concat_tables([pa.ipc.open_stream(text).read_all() for frame in frames for text in frame["rows"]])
        payloads = rows["raw_payload"].cast(pa.binary()).to_pylist()
        hashes = [None if p is None else hashlib.sha256(p).hexdigest() for p in payloads]
        new = np.empty(rows.num_rows, _KNOWN)
        new["fixture"] = rows["fixture_id"].cast(pa.int64()).fill_null(_NONE).to_numpy()
        new["landed"] = rows["landed"].fill_null(_NONE).to_numpy()
        new["hash"], new["seen"] = np.array([(h or "")[:32] for h in hashes], "S32"), now
        both, place = np.concatenate([known, new]), np.arange(len(known) + len(new)) - len(known)
        order = np.lexsort([place, both["hash"], -both["landed"], both["fixture"]])  # what is known comes before an equal landing
        first = np.ones(len(order), bool)
        first[1:] = both["fixture"][order][1:] != both["fixture"][order][:-1]
        best = order[first]
        after = both[best]
        seen = np.unique(new["fixture"])
        after["seen"][np.isin(after["fixture"], seen)] = now
        state.update((after.tobytes(),))
        chosen = np.sort(place[best[best >= len(known)]])
        if len(chosen):
            yield rows.take(chosen).to_pandas(integer_object_nulls=True).assign(response_hash=[hashes[i] for i in chosen])

    rows = stream.select("fixture_id", F.unix_micros("landed_at").alias("landed"), "raw_payload", F.pmod(F.xxhash64("fixture_id"), F.lit(buckets)).alias("bucket"))
    newest = rows.mapInArrow(packed, "bucket bigint, rows binary").groupBy("bucket").applyInPandasWithState(keep, _NEWEST, "known binary", "append", "NoTimeout")
    return newest.select("fixture_id", F.timestamp_micros("landed").alias("landed_at"), "raw_payload", "response_hash")


def refresh(table: IncrementTable, batch: DataFrame, normalize: Callable[[DataFrame], DataFrame], endpoint: str, run_id: str) -> None:
    """Upsert the typed rows of one batch of payloads into ``table``, which goes by ingested_at_utc; ``normalize`` keeps
    that. A replayed batch, or an older landing that comes late, changes nothing, and what a batch writes grows with the
    batch, not with the table. Payloads are dealt by fixture as they landed, which is less than their typed rows; these
    need no shuffle then."""
    table.merge(normalize(land_envelopes(batch.repartition("fixture_id"), run_id=run_id, endpoint=endpoint, at=F.col("landed_at"))))


def stream_into(spark: SparkSession, folder: str, table: str, checkpoint: str, normalize: Callable[[DataFrame], DataFrame], keys: list[str], endpoint: str = "fixtures/players", run_id: str = "stream", columns: list[str] | None = None) -> DataFrame:
    """Run all files landed so far, newest landings only, through :func:`refresh` and return the table, or ``columns`` of it."""

    def each(batch: DataFrame, _: int) -> None:
        refresh(state.open_table(batch.sparkSession, table, keys, "ingested_at_utc"), batch, normalize, endpoint, run_id)

    query = newest_landings(landing_stream(spark, folder)).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = state.open_table(spark, table, keys, "ingested_at_utc").read(columns=columns)
    if "." not in table:
        rows.createOrReplaceTempView(table)
    return rows
