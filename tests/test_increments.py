"""Tables kept as increments: rules against a plain fold, compaction, two writers, columns, stored checkpoints and marks."""

import random
import threading
from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import increments, state
from lakeloom.operators.increments import IncrementTable
from lakeloom.plans import silver
from lakeloom.streaming import ingest


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_small_increments_merge_with_one_another(spark, tmp_path):
    """Columns may have any name; the large increment is written once, and its rows are read without a shuffle."""
    table = IncrementTable(spark, f"file://{tmp_path}/t", ["id"])
    table.merge(spark.range(5000).select("id", F.lit(0).alias("part_number"), F.lit("a").alias("seq"), F.lit("b").alias("_seq"), F.lit(0).alias("RESET")))
    base = table.head()["increments"][0]["folder"]
    for i in range(20):
        table.merge(spark.createDataFrame([(i, i, "x", "y", 1), (None, i, "n", "n", i)], "id long, part_number int, seq string, _seq string, RESET int"))
    found = table.head()["increments"]
    assert base in {i["folder"] for i in found} and len(found) <= 2 * increments.FAN and max(i["rows"] for i in found if i["folder"] != base) < 5000
    got = {r.id: tuple(r)[1:] for r in table.read().collect()}
    assert len(got) == 5001 and all(got[i] == (i, "x", "y", 1) for i in range(20)) and got[20] == (0, "a", "b", 0) and got[None] == (19, "n", "n", 19)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    for kind in ("LeftAnti", "LeftSemi"):
        assert "Exchange" not in plan.split(f"{kind}, BuildRight")[1].split("BroadcastExchange")[0]
    assert [r.id for r in table.read(3, 5).orderBy("id").collect()] == [3, 4, 5]
    assert base not in table.vacuum() and table.read().count() == 5001


def test_ranges_leave_increments_unread(spark, tmp_path):
    table = IncrementTable(spark, f"file://{tmp_path}/t", ["k"])
    for lo in ("a", "m"):
        table.merge(spark.createDataFrame([(lo + c, c) for c in "xyz"], "k string, v string"))
    assert table.read("b", "n").inputFiles() and rows_of(table.read("mx", "my")) == [("mx", "x"), ("my", "y")]
    folders = {i["low"][0]: i["folder"] for i in table.head()["increments"]}
    assert all(folders["a"] not in f for f in table.read("m").inputFiles())


@pytest.mark.parametrize("order", [None, "at"])
def test_reads_equal_a_plain_fold_whatever_is_compacted(spark, tmp_path, monkeypatch, order):
    rng = random.Random(7)
    monkeypatch.setattr(increments, "FAN", 3)
    for looked_up in (0, 1000):
        monkeypatch.setattr(increments, "LOOKED_UP", looked_up)
        table, want = IncrementTable(spark, f"file://{tmp_path}/{order}{looked_up}", ["a", "b"], order), {}
        for n in range(7):
            batch = {(rng.choice([None, 1, 2]), rng.choice(["x", None])): (rng.choice([None, 1, 2, 3]), f"v{n}") for _ in range(3)}
            table.merge(spark.createDataFrame([(*k, *v) for k, v in batch.items()], "a int, b string, at int, v string"))
            for k, v in batch.items():
                if order is None or k not in want or (v[0] or 0) >= (want[k][0] or 0):
                    want[k] = v
        assert rows_of(table.read()) == sorted(((*k, *v) for k, v in want.items()), key=repr)


def test_two_writers_lose_nothing(spark, tmp_path):
    def write(n):
        table = IncrementTable(spark, f"file://{tmp_path}/t", ["k"])
        for i in range(5):
            table.merge(spark.createDataFrame([(10 * n + i, n)], "k int, v int"))

    writers = [threading.Thread(target=write, args=(n,)) for n in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert rows_of(IncrementTable(spark, f"file://{tmp_path}/t", ["k"]).read()) == sorted(((10 * n + i, n) for n in range(3) for i in range(5)), key=repr)


def test_columns_are_never_dropped_in_silence(spark, tmp_path):
    table = IncrementTable(spark, f"file://{tmp_path}/t", ["k"])
    with pytest.raises(ValueError):
        table.read()
    table.merge(spark.createDataFrame([(1, "a")], "k int, v string"))
    for wrong in ("k int", "k int, v string, w int"):
        with pytest.raises(ValueError):
            table.merge(spark.createDataFrame([(2, "b", 3)[: wrong.count(",") + 1]], wrong))
    table.merge(spark.createDataFrame([(3, "b", 2)], "w int, v string, k int"), add_columns=True)
    assert table.read().columns == ["k", "v", "w"] and rows_of(table.read()) == [(1, "a", None), (2, "b", 3)]
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"))
    with pytest.raises(ValueError):
        IncrementTable(spark, f"file://{tmp_path}/t", ["v"])
    table.merge(spark.createDataFrame([], "k int, v string, w int"))
    assert table.read().count() == 2


CHECKPOINT = "run_id string, target_date date, fixture_id int, endpoint string, status string, attempt_count int, last_error string, started_at_utc timestamp, completed_at_utc timestamp"


@pytest.mark.parametrize("compact_after", [(), (0, 2), (1, 3, 5)])
def test_a_stored_checkpoint_equals_the_fold_of_its_batches(spark, tmp_path, compact_after):
    rng = random.Random(len(compact_after))
    stored, want = state.checkpoint_table(spark, f"file://{tmp_path}/c"), None
    for n in range(6):
        t = datetime(2024, 1, rng.randrange(1, 20))
        rows = [("r", date(2024, 1, 1), i, "e", rng.choice(["PENDING", "COMPLETED", "FAILED", "SKIPPED"]), rng.randrange(3), f"e{n}", t, t) for i in range(12) if rng.random() < 0.7]
        batch, force = spark.createDataFrame(rows, CHECKPOINT), n == 3
        got = state.record_attempts(stored, batch, force)
        empty = batch.limit(0) if want is None else spark.createDataFrame(want, CHECKPOINT)
        want = state.checkpoint_upsert(empty, batch, force).collect()
        assert rows_of(got) == sorted(map(tuple, want), key=repr)
        if n in compact_after:
            stored.compact()
            assert len(stored.head()["increments"]) == 1 and rows_of(stored.read()) == sorted(map(tuple, want), key=repr)


def test_a_backfill_goes_on_where_it_ended(spark, tmp_path):
    days = spark.createDataFrame([(date(2024, 1, i), date(2024, 1, i), 10 * i) for i in range(1, 6)], "window_start date, window_end date, records int")
    stored, asked = state.window_table(spark, f"file://{tmp_path}/w"), []

    def attempt(errors):
        def run(todo):
            asked.append(sorted(r.window_start.day for r in todo.collect()))
            return todo.join(days, state.WINDOW_KEYS).withColumn("error", F.create_map(*[F.lit(x) for kv in errors.items() for x in kv])[F.day("window_start")] if errors else F.lit(None).cast("string"))

        return run

    at = lambda i: F.to_timestamp(F.lit(f"2024-02-0{i}"))
    first = state.backfill(stored, days, attempt({2: "timeout", 4: "daily quota used"}), at(1), f"{tmp_path}/1")
    assert {r.window_start.day: (r.status, r.records) for r in first.collect()} == {1: ("COMPLETED", 10), 2: ("PENDING", 20), 3: ("COMPLETED", 30), 4: ("PENDING", 40), 5: ("PENDING", 0)}
    second = state.backfill(stored, days, attempt({}), at(2), f"{tmp_path}/2")
    assert asked == [[1, 2, 3, 4, 5], [2, 4, 5]] and all(r.status == "COMPLETED" and r.records == 10 * r.window_start.day for r in second.collect())


def test_refresh_reads_what_is_new_and_repeats_nothing(spark, tmp_path):
    stored, read = IncrementTable(spark, f"file://{tmp_path}/s", ["k"], order="ingested_at_utc"), []
    landed = lambda *rows: spark.createDataFrame([(k, v, datetime(2024, 1, d)) for k, v, d in rows], "k int, v string, ingested_at_utc timestamp")

    def normalize(bronze):
        read.append(sorted(r.v for r in bronze.collect()))
        return bronze

    def lost(bronze):
        raise RuntimeError("lost")

    assert not silver.refresh(stored, landed(), normalize)
    first = landed((1, "a", 1), (2, "b", 2))
    assert silver.refresh(stored, first, normalize) and not silver.refresh(stored, first, normalize)
    more = first.union(landed((2, "c", 3)))
    with pytest.raises(RuntimeError):
        silver.refresh(stored, more, lost)
    assert silver.refresh(stored, more, normalize) and read == [["a", "b"], ["c"]]
    assert silver.refresh(stored, more, normalize, lag="36 hours") and read[-1] == ["b", "c"]
    assert [(k, v) for k, v, _ in rows_of(stored.read())] == [(1, "a"), (2, "c")]


def test_a_stream_lets_newer_landings_through_alone(spark, tmp_path):
    kinds = "fixture_id int, landed_at timestamp, raw_payload string"
    runs = [
        [(1, 2, "a"), (1, 1, "old"), (1, 2, "a"), (2, 5, "b"), (None, 1, "n")],
        [(1, 1, "late"), (1, 2, "a"), (2, 5, "b"), (3, 1, "first, and old"), (None, 2, "m")],
        [(1, 3, "a"), (2, 6, "c"), (2, 7, "d")],
        [(4, None, "without a time"), (4, None, "without a time")],
    ]
    seen = []
    for n, rows in enumerate(runs):
        spark.createDataFrame([(k, at and datetime(2024, 1, at), p) for k, at, p in rows], kinds).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        query = ingest.newest_landings(ingest.landing_stream(spark, f"{tmp_path}/in"), buckets=2).writeStream
        query.foreachBatch(lambda batch, _: seen.append((n, sorted((r.fixture_id or 0, r.raw_payload) for r in batch.collect())))).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    assert [batch for _, batch in seen if batch] == [[(0, "n"), (1, "a"), (2, "b")], [(0, "m"), (3, "first, and old")], [(1, "a"), (2, "d")], [(4, "without a time")]]


def test_landings_are_packed_by_bucket_for_the_shuffle():
    texts = [None if n % 100 == 7 else f'{{"response":[{{"team":{{"id":{n % 16},"name":"Team {n % 16}"}},"players":[{{"player":{{"id":{n},"name":"ü {n * 7919 % 1009}"}}}}]}}]}}' for n in range(4000)]
    rows = pa.table({"fixture_id": pa.array([n if n % 50 else None for n in range(4000)], pa.int32()), "raw_payload": texts, "bucket": pa.array([n % 8 for n in range(4000)], pa.int64())})
    for at_once, packs in ((1, 4), (1 << 30, 1)):
        got = list(ingest.packed(iter(rows.to_batches(max_chunksize=1000)), at_once))
        assert [sorted(g["bucket"].to_pylist()) for g in got] == [list(range(8))] * packs
        back = [r | {"bucket": b} for g in got for b, text in zip(g["bucket"].to_pylist(), g["rows"].to_pylist()) for r in pa.ipc.open_stream(text).read_all().to_pylist()]
        assert sorted(map(str, back)) == sorted(map(str, rows.to_pylist()))
        assert sum(len(t) for g in got for t in g["rows"].to_pylist()) < sum(len(t or "") for t in texts) / 3


def test_chosen_columns_alone_are_read(spark, tmp_path):
    table = IncrementTable(spark, f"file://{tmp_path}/t", ["k"], order="at")
    for at, text in ((1, "old"), (2, "new")):
        table.merge(spark.createDataFrame([(k, at, text * 50, k * at) for k in range(at, 4)], "k int, at int, text string, v int"))
    got = table.read(columns=["v", "k"])
    assert got.columns == ["v", "k"] and rows_of(got) == [(1, 1), (4, 2), (6, 3)]
    assert "text" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows_of(table.read(2, 2, columns=["v"])) == [(4,)]
    with pytest.raises(ValueError):
        table.read(columns=["gone"])


def test_resolved_rows_are_dealt_by_the_tables_size(spark, tmp_path, monkeypatch):
    """The session's partitions are a fixed number: past TASK_ROWS a partition, a task's share would grow with the table."""
    monkeypatch.setattr(increments, "LOOKED_UP", 10)
    monkeypatch.setattr(increments, "TASK_ROWS", 100)
    table = IncrementTable(spark, f"file://{tmp_path}/t", ["k", "part"], order="at")
    for at in (1, 2):
        table.merge(spark.range(600).select((F.col("id") % 300).alias("k"), (F.col("id") % 2).alias("part"), F.lit(at).alias("at"), (F.col("id") * at).alias("v")))
    for got in (table.read(), table.read(columns=["v"])):
        assert "hashpartitioning(k" in (plan := got._jdf.queryExecution().executedPlan().toString()) and plan.count("Exchange") == 1
        assert got.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, table.read(columns=["k", "at"]).collect())) == [(k, 2) for k in range(300)]
    table.compact()
    assert sorted(map(tuple, table.read(columns=["k", "at"]).collect())) == [(k, 2) for k in range(300)]
