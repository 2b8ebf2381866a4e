"""Operators on small examples whose results are known by hand."""

import hashlib
import random
import re
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import catalog
from lakeloom.functions import scalar as S
from lakeloom.functions.names import ACCENTED, PLAIN, normalize_name
from lakeloom.operators import elo, features, increments, keyed, quality, rules, shape, state
from lakeloom.plans import gold, silver
from lakeloom.sources import driver_tables, io
from lakeloom.sources.driver_tables import view
from lakeloom.streaming import ingest


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


# --- names and scalars ---


def test_accent_pairs(spark):
    assert len(ACCENTED) == len(PLAIN)
    rows = spark.createDataFrame(list(zip(ACCENTED, PLAIN)), "a string, p string")
    assert rows.where(normalize_name(F.col("a")) != F.col("p")).count() == 0
    assert rows.where(normalize_name(F.upper("a")) != F.col("p")).where("a != 'ı'").count() == 0


@pytest.mark.parametrize("name, mode, want", [("Curaçao", "key", "curacao"), ("İlkay Gündoğan", "key", "ilkay gundogan"), ("Straße", "key", "strasse"), ("Cote d'lvoire", "alias", "ivory coast"), ("Côte d'Ivoire", "alias", "ivory coast"), ("Pervis  Estupiñán-X", "player", "pervis estupinan-x"), (" A b/C ", "slug", "a_b_c"), ("Ärger, ok", "display", "Arger, ok"), ("Éa", "label", "a"), ("", "key", ""), (None, "key", None)])
def test_names(spark, name, mode, want):
    assert one(spark, normalize_name(F.lit(name).cast("string"), mode))[0] == want


def test_unknown_mode():
    with pytest.raises(ValueError):
        normalize_name(F.lit("x"), "other")


def test_scalars(spark):
    values = spark.createDataFrame([("forward", "F"), ("ATTACKER", "F"), ("M", "M"), ("D", "D"), ("g", "G"), ("unknown", "M"), (None, "M")], "p string, want string")
    assert values.where(S.position_group(F.col("p")) != F.col("want")).count() == 0
    lit = F.lit
    r = one(
        spark, S.per_90(lit(2), lit(45)), S.per_90(lit(2), lit(0)), S.per_90(lit(2), lit(None).cast("int")), S.smoothed_rate(lit(1.0), lit(15.0), lit(2), lit(90)), S.smoothed_rate(lit(8.0), lit(360.0), lit(2), lit(90)),
        S.opponent_strength(lit(1500.0), lit(0.0)), S.elo_expected(lit(1500.0), lit(1500.0)), S.gap_weight(lit(None).cast("double")), S.gap_weight(lit(900.0)), S.elo_anchor(lit(1700.0)), S.elo_anchor(lit(1300.0)),
    )
    assert list(r[:9]) == pytest.approx([4.0, 0.0, 0.0, 3 / 105, 10 / 450, 1.0, 0.5, 1.0, 1.25]) and r[9] < 1 < r[10]


def test_recency(spark):
    at = F.to_timestamp(F.lit("2026-06-26"))
    w = lambda d: S.recency_weight(F.try_to_timestamp(F.lit(d)), at)
    old, new, future, bad = one(spark, w("2023-06-26"), w("2026-06-26"), w("2027-01-01"), w("no date"))
    assert old < 0.13 and new > 0.99 and future == 1.0 and bad == 1.0
    assert one(spark, S.recency_weight(at, None))[0] == 1.0
    with pytest.raises(ValueError):
        S.recency_weight(at, at, 0)


def test_labels_and_texts(spark):
    lit = F.lit
    r = one(spark, S.stake_weight(lit("World Cup Qualifier")), S.stake_weight(lit("Euro qualifiers")), S.stake_weight(lit("Friendly")), S.stake_weight(lit(None).cast("string")), S.high_stakes(lit("Club Friendlies World Cup")), S.high_stakes(lit("Copa América")))
    assert list(r) == [1.0, 0.7, 0.2, 1.0, 0, 1]
    assert one(spark, S.error_text(lit("temporary failure\nwithout payload")))[0] == "temporary failure without payload"
    assert one(spark, S.is_quota_error(lit('{"e": "Too Many Requests"}')), S.is_quota_error(lit(None).cast("string")), S.is_quota_error(lit("bad key")))[:] == (True, False, False)
    texts = one(spark, *[S.change_text(lit(x), lit("A"), lit("B")) for x in (1.217, 0.783, 1.0)])
    assert "increases" in texts[0] and "22%" in texts[0] and "decreases" in texts[1] and "22%" in texts[1] and texts[2] == "neutral 0% effect"
    with pytest.raises(PySparkException):
        one(spark, S.change_text(lit(float("inf")), lit("A"), lit("B")))
    assert one(spark, S.minutes_between(lit(datetime(2024, 1, 1)), lit(datetime(2024, 1, 1, 0, 5, 59))))[0] == 5


# --- shapes and rules ---


def test_spines(spark):
    windows = shape.date_windows(spark, date(2022, 12, 23), date(2023, 1, 4)).collect()
    assert [tuple(r) for r in windows] == [(date(2022, 12, 23), date(2022, 12, 29)), (date(2022, 12, 30), date(2023, 1, 4))]
    assert shape.daily_dates(spark, date(2026, 6, 25), date(2026, 6, 27)).count() == 3
    for call in (lambda: shape.date_windows(spark, date(2022, 1, 2), date(2022, 1, 1)), lambda: shape.date_windows(spark, date(2022, 1, 1), date(2022, 1, 2), 0), lambda: shape.daily_dates(spark, date(2022, 1, 2), date(2022, 1, 1))):
        with pytest.raises(ValueError):
            call()


def test_eligibility(spark):
    rows = [(1, 1, "World Cup", "World", "FT"), (2, 667, "Friendlies Clubs", "World", "FT"), (3, 10, "Friendlies Women", "World", "FT"), (4, 5, "UEFA Nations League", "World", "PEN"), (5, 10, "U21 Friendlies", "World", "FT"), (6, 1, "World Cup", "World", "NS"), (7, None, None, None, None)]
    out = rules.eligibility(spark.createDataFrame(rows, "id int, league int, name string, country string, status string"), "league", "name", "country", "status")
    got = {r.id: r.reject_reason for r in out.collect()}
    assert got == {1: None, 2: "excluded word", 3: "excluded word", 4: None, 5: "excluded word", 6: "not completed", 7: "league not allowed"}
    good, bad = rules.split_valid(out, F.col("is_eligible"))
    assert good.count() == 2 and bad.count() == 5


def test_silver_keeps_players_without_statistics_and_drops_broken_payloads(spark):
    good = '{"response":[{"team":{"id":1,"name":"Á"},"players":[{"player":{"id":7,"name":"Zoë"},"statistics":[]},{"player":{"id":8,"name":"B"},"statistics":[{"games":{"minutes":"7","position":"F"},"shots":{"total":null,"on":1},"goals":{"total":2}}]},{"player":{"id":null},"statistics":[]}]}]}'
    landed = io.land_envelopes(spark.createDataFrame([(1, good), (2, '{"response": []}'), (3, '{"respo'), (1, good)], "fixture_id int, raw_payload string"), run_id="r", endpoint="e", params={"b": 1, "a": 2})
    assert landed.first().request_params == '{"a": 2, "b": 1}'
    rows = {r.player_id: r for r in silver.silver_player_stats(landed).collect()}
    assert set(rows) == {7, 8} and rows[7].games_minutes is None and rows[7].shots_total == 0 and rows[7].player_name_normalized == "zoe" and rows[8].games_minutes is None and rows[8].goals_total == 2
    assert [r.reason for r in silver.dead_letters(landed).collect()] == ["payload is not JSON"]


def test_lineup_prefers_starters(spark):
    doc = '{"response":[{"team":{"id":1,"name":"A"},"formation":"4-3-3","startXI":[{"player":{"id":7,"name":"Z","number":9,"pos":"F"}}],"substitutes":[{"player":{"id":7,"name":"Z","number":9,"pos":"F"}},{"player":{"id":8,"name":"Y","number":3,"pos":"D"}}]},{"team":{"id":2,"name":"B"},"startXI":null,"substitutes":null}]}'
    landed = io.land_envelopes(spark.createDataFrame([(1, doc)], "fixture_id int, raw_payload string"), run_id="r", endpoint="e")
    assert {r.player_id: r.is_starting for r in silver.silver_lineups(landed).collect()} == {7: True, 8: False}


def test_required_columns(spark):
    with pytest.raises(ValueError, match="b, c"):
        shape.require_columns(spark.range(1), ["id", "b", "c"])


def test_alignment(spark):
    schema = T.StructType.fromDDL("id bigint, n int, s struct<a int>, t string, gone double")
    df = spark.createDataFrame([(1, "x7", '{"a": 3}', {"k": 1})], "id bigint, n string, s string, t map<string,int>").withColumn("extra", F.lit(1))
    row = io.align_to_schema(df, schema).first()
    assert row.n is None and row.s.a == 3 and row.t == '{"k":1}' and row.gone is None and "extra" not in row


# --- keys and state ---


def test_work_plan(spark):
    ids = spark.createDataFrame([(101,), (102,), (102,), (103,), (None,)], "k int")
    done = ids.where("k = 102")
    assert {tuple(r) for r in keyed.plan_work(ids, done, "k").collect()} == {(101, "FETCH"), (102, "SKIP"), (103, "FETCH")}
    assert {r.action for r in keyed.plan_work(ids, done, "k", force=True).collect()} == {"FETCH"}


def test_name_join_and_resolution(spark):
    a = spark.createDataFrame([("Pervis Estupiñán", 90)], "n string, minutes int")
    b = spark.createDataFrame([("Pervis Estupinan",)], "m string")
    assert keyed.join_on_name(a, b, "n", "m").first().minutes == 90
    fixtures = spark.createDataFrame([(1, datetime(2026, 6, 1, 18), "Curaçao", "Ivory Coast"), (2, datetime(2026, 6, 1, 20), "B", "A"), (3, datetime(2026, 6, 2), "C", "D"), (4, datetime(2026, 6, 2), "C", "D")], "fixture_id int, fixture_date timestamp, home_team string, away_team string")
    day = date(2026, 6, 1)
    requests = spark.createDataFrame([(1, day, "Curacao", "Cote d'lvoire"), (2, day, "A", "B"), (3, date(2026, 6, 2), "C", "D"), (4, day, "X", "Y"), (5, day, "A", "a"), (6, None, "A", "B"), (7, day, None, "B")], "request_id int, match_date date, home_team string, away_team string")
    got = {r.request_id: (r.outcome, r.fixture_id) for r in keyed.resolve_matches(requests, fixtures).collect()}
    assert got == {1: ("matched", 1), 2: ("reversed", None), 3: ("ambiguous", None), 4: ("missing", None), 5: ("invalid", None), 6: ("invalid", None), 7: ("invalid", None)}


def test_merge(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "A"), (None, "B"), (4, "D")], "k int, v string")
    want = {(1, "A"), (None, "B"), (3, "c"), (4, "D")}
    once = state.merge_upsert(old, new, ["k"])
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in state.merge_upsert(once, new, ["k"]).collect()}
    with pytest.raises(ValueError):
        state.merge_upsert(old, new.union(new), ["k"])
    with pytest.raises(ValueError):
        keyed.join_context(old, new.union(new), ["k"], [], check=True)


def test_merge_into_table(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    state.merge_into(spark, "merged_t", rows, ["k"])
    state.merge_into(spark, "merged_t", rows.where("k = 2 or k is null").withColumn("v", F.upper("v")), ["k"])
    assert {tuple(r) for r in spark.table("merged_t").collect()} == {(1, "a"), (2, "B"), (None, "N")}
    with pytest.raises(ValueError):
        state.merge_into(spark, "merged_t", rows.union(rows), ["k"])
    spark.range(1).write.mode("overwrite").saveAsTable("plain_t")
    with pytest.raises(ValueError):
        state.merge_into(spark, "plain_t", spark.range(2), ["id"])
    spark.sql("drop table plain_t")
    spark.sql("drop view merged_t")


def test_merge_keeps_the_newest_landing(spark, monkeypatch):
    monkeypatch.setattr(increments, "FAN", 2)
    row = lambda v, day: spark.createDataFrame([(1, v, date(2024, 1, day))], "k int, v string, at date")
    for v, day, want in (("new", 2, "new"), ("old", 1, "new"), ("newer", 3, "newer"), ("again", 3, "again"), ("late", 2, "again")):
        state.merge_into(spark, "late_t", row(v, day), ["k"], order="at")
        assert [r.v for r in spark.table("late_t").collect()] == [want]
        assert len(state.open_table(spark, "late_t", ["k"], "at").head()["increments"]) == 1
    state.merge_into(spark, "late_t", row("x", 5).union(row("y", 6)).union(row("z", 4)), ["k"], order="at")
    assert [r.v for r in spark.table("late_t").collect()] == ["y"]
    spark.sql("drop view late_t")


def test_merge_that_breaks_off_changes_nothing(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    state.merge_into(spark, "broken_t", rows, ["k"])
    new = rows.withColumn("v", F.upper("v"))
    with monkeypatch.context() as m:
        def stop(*_):
            raise RuntimeError("lost")

        m.setattr(increments.IncrementTable, "_change", stop)
        with pytest.raises(RuntimeError):
            state.merge_into(spark, "broken_t", new, ["k"])
        assert {tuple(r) for r in spark.table("broken_t").collect()} == {(1, "a"), (2, "b")}
    state.merge_into(spark, "broken_t", new, ["k"])
    assert {tuple(r) for r in spark.table("broken_t").collect()} == {(1, "A"), (2, "B")}
    spark.sql("drop view broken_t")


def test_a_merge_writes_its_source_only(spark):
    state.merge_into(spark, "large_t", spark.range(1000).withColumn("v", F.lit(0)), ["id"])
    state.merge_into(spark, "large_t", spark.range(2).withColumn("v", F.lit(1)), ["id"])
    assert [i["rows"] for i in state.open_table(spark, "large_t", ["id"]).head()["increments"]] == [1000, 2] and spark.table("large_t").count() == 1000
    spark.sql("drop view large_t")


def test_backfill_stops_at_the_quota_and_resumes(spark):
    kinds = "window_start date, window_end date, records int, error string"
    d = lambda i: date(2024, 1, i)
    first = spark.createDataFrame([(d(1), d(7), 5, None), (d(8), d(14), 2, "timeout"), (d(15), d(21), 3, "daily quota used"), (d(22), d(28), 9, None), (d(29), d(30), 9, "quota")], kinds)
    at = lambda i: F.to_timestamp(F.lit(f"2024-02-0{i}"))
    known = state.settle_windows(first, at(1))
    assert sorted(tuple(r)[2:4] for r in known.collect()) == sorted([("COMPLETED", 5), ("PENDING", 2), ("PENDING", 3), ("PENDING", 0), ("PENDING", 0)])
    ahead = state.pending_windows(first.select("window_start", "window_end"), known)
    assert sorted(r.window_start.day for r in ahead.collect()) == [8, 15, 22, 29]
    second = first.join(ahead, ["window_start", "window_end"]).withColumn("error", F.lit(None).cast("string"))
    after = state.window_upsert(known, state.settle_windows(second, at(2)))
    assert {(r.window_start.day, r.status, r.records) for r in after.collect()} == {(1, "COMPLETED", 5), (8, "COMPLETED", 2), (15, "COMPLETED", 3), (22, "COMPLETED", 9), (29, "COMPLETED", 9)}
    assert sorted(map(tuple, state.window_upsert(after, known).collect())) == sorted(map(tuple, after.collect()))


def test_checkpoint_is_not_taken_back(spark):
    schema = "run_id string, target_date date, fixture_id int, endpoint string, status string, attempt_count int, last_error string, started_at_utc timestamp, completed_at_utc timestamp"
    t = datetime(2024, 1, 1)
    row = lambda i, s, at=t: ("r", date(2024, 1, 1), i, "e", s, 1, None, at, at)
    old = spark.createDataFrame([row(10, "COMPLETED"), row(11, "PENDING"), row(12, "PENDING")], schema)
    later = datetime(2024, 1, 2)
    new = spark.createDataFrame([row(10, "SKIPPED", later), row(11, "COMPLETED", later), row(12, "FAILED", later)], schema)
    got = {r.fixture_id: r for r in state.checkpoint_upsert(old, new).collect()}
    assert {i: r.status for i, r in got.items()} == {10: "COMPLETED", 11: "COMPLETED", 12: "FAILED"}
    assert got[11].started_at_utc == t and got[11].attempt_count == 2 and got[12].completed_at_utc is None
    assert {r.status for r in state.checkpoint_upsert(old, new, force=True).where("fixture_id = 10").collect()} == {"SKIPPED"}


def test_ops_views_and_names(spark):
    assert io.layer_table("c", {"bronze": "b", "silver": "s"}, "silver", "x") == "c.s.x"
    with pytest.raises(ValueError):
        io.layer_table("c", {"bronze": "b"}, "gold", "x")
    spark.createDataFrame([("r", date(2024, 1, 1), "e", "FAILED", datetime(2024, 1, 1), None)], "run_id string, target_date date, endpoint string, status string, started_at_utc timestamp, completed_at_utc timestamp").createOrReplaceTempView("ck_t")
    names = state.create_ops_views(spark, "ck_t", "ck_t_", temporary=True)
    assert spark.table(names[0]).first().failed_count == 1 and spark.table(names[1]).count() == 1 and spark.table(names[2]).count() == 0


# --- features ---


def test_common_opponents(spark):
    """A let its shared opponents have 10 shots where they have 15 otherwise, B the other way round."""
    matches, shots, n = [], [], 0
    for team, opponent, has in [("A", "X", 10), ("A", "Y", 10), ("B", "X", 15), ("B", "Y", 15), ("C", "X", 15), ("C", "Y", 10)]:
        n += 1
        matches.append((n, team, opponent))
        shots += [(n, opponent, has), (n, team, 12)]
    m = spark.createDataFrame(matches, "fixture_id int, home_team_id string, away_team_id string")
    t = spark.createDataFrame(shots, "fixture_id int, team_id string, shots int")
    got = {(r.team_id, r.rival_id): r.factor for r in features.common_opponent_factors(m, t).collect()}
    assert got["A", "B"] == pytest.approx(20 / (15 + 12.5)) and got["B", "A"] == pytest.approx(30 / (12.5 + 10))


def test_shared_opponents_of_pairs(spark):
    """Pairs asked for, whatever their order and repeats, with one copy of the edges or one for each pair."""
    rng = random.Random(7)
    edges = {(a, b) for _ in range(400) for a, b in [(min(rng.randrange(60), rng.randrange(60)), rng.randrange(60))]}
    pairs = [(0, b) for b in range(60)] + [(b, 1) for b in range(60)] + [(3, 3), (5, 99), (None, 2), (0, 1)]
    e = spark.createDataFrame([(a, b, 100 * a + b) for a, b in edges], "team int, opponent int, mark int")
    p = spark.createDataFrame(pairs, "team_a int, team_b int")
    met = {t: {o for x, o in edges if x == t} for t in range(100)}
    want = {(a, b, o, 100 * a + o, 100 * b + o) for a, b in pairs if a is not None and a != b for o in met[a] & met[b]}
    for load in (1, 10_000):
        out = keyed.shared_opponents(p, e, load).select("team_a", "team_b", "opponent", "a.mark", "b.mark").collect()
        assert len(out) == len(want) and {tuple(r) for r in out} == want
    undirected = keyed.mutual_opponents(e, p).collect()
    assert {(r.team_a, r.team_b, r.opponent) for r in undirected} == {(min(a, b), max(a, b), o) for a, b, o, *_ in want}
    assert keyed.shared_opponents(p.limit(0), e).count() == 0 and keyed.shared_opponents(p, e.limit(0)).count() == 0


def test_factors_of_pairs_equal_all_factors(spark, sf_dir):
    matches, stats = (view(spark, sf_dir, v) for v in ("match_v", "player_v"))
    totals = features.team_fixture_totals(stats)
    pairs = matches.select(F.col("home_team_id").alias("team_id"), F.col("away_team_id").alias("rival_id")).where("fixture_id % 3 = 0").distinct()
    some = features.common_opponent_factors(matches, totals, pairs=pairs)
    rounded = lambda df: sorted((r.team_id, r.rival_id, round(r.factor, 9)) for r in df.collect())
    every = features.common_opponent_factors(matches, totals)
    assert rounded(some) == rounded(every.join(pairs, ["team_id", "rival_id"], "left_semi"))
    all_pairs = re.compile(r"NOT \(team#\d+ = team#\d+\)")
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (every, some)]
    assert all_pairs.search(plans[0]) and not all_pairs.search(plans[1])


def test_priors(spark):
    rows = spark.createDataFrame([("F", 90, 5), ("F", 90, 1), ("M", 90, 2)], "games_position string, games_minutes int, shots_total int")
    got = {r.position_group: (r.prior_alpha, r.prior_beta) for r in features.estimate_priors(rows, 180.0).collect()}
    assert got["F"] == (pytest.approx(6.0), 180.0) and got["M"][0] == pytest.approx(4.0) and got["D"][0] == pytest.approx(1.0) and got["G"][0] == 0.0


def test_shrinkage_and_projection(spark):
    rates = spark.createDataFrame([(1, 90.0, 5.0, 5.0, 5.0), (2, 0.0, 0.0, 0.0, 0.0)], "player_id int, minutes double, shots double, shots_on double, goals double")
    a, b = features.shot_projection(features.shrunk_rates(rates, F.lit("F")), F.lit(1.0)).orderBy("player_id").collect()
    assert (a.weight, a.mean_shots, a.on_target, a.conversion) == pytest.approx((0.2, 3.08, 0.536, 0.328))
    assert b.mean_shots == pytest.approx(2.6) and 0 < b.any_shot < 1 and a.mean_missed + a.mean_on_target == pytest.approx(a.mean_shots)


def test_plus_minus(spark):
    rows = spark.createDataFrame([(1, 9, 90, 1, 20, "World Cup"), (1, 0, 0, 20, 90, "Friendly"), (2, 1, 90, 0, 0, "World Cup")], "player_id int, shots_on_pitch int, minutes_on_pitch int, shots_off_pitch int, minutes_off_pitch int, competition string")
    weighed = {r.player_id: r.ratio for r in features.weighted_plus_minus(rows, ["player_id"], S.stake_weight(F.col("competition"))).collect()}
    plain = {r.player_id: r.ratio for r in features.weighted_plus_minus(rows, ["player_id"], F.lit(1.0)).collect()}
    assert weighed[1] > plain[1] and weighed[1] > 1 * plain[1] and weighed[2] == float("inf")


def test_elo(spark):
    rows = [(1, datetime(2024, 1, 1), 1, 2, 1, 0, 1, "p"), (2, datetime(2024, 1, 2), 2, 1, None, None, 0, "p"), (3, datetime(2024, 1, 1), 1, 2, 0, 3, 0, "q"), (4, datetime(2024, 1, 1), None, 2, 0, 3, 0, "q")]
    got = elo.elo_replay(spark.createDataFrame(rows, "fixture_id int, match_date timestamp, home_team_id int, away_team_id int, home_goals int, away_goals int, is_high_stakes int, pool string"), "pool").collect()
    by = {(r.fixture_id, r.team_id): r for r in got}
    assert len(got) == 6 and by[1, 1].team_elo == 1520.0 and by[1, 2].team_elo == 1480.0 and by[2, 1].pre_team_elo == 1520.0 and by[2, 2].team_elo > 1480.0 and by[3, 2].team_elo == 1510.0


def test_elo_update_equals_a_replay_of_all(spark):
    """Matches added, taken away and changed; those before the first change and pools without one aren't replayed."""
    kinds = "fixture_id int, match_date timestamp, home_team_id int, away_team_id int, home_goals int, away_goals int, is_high_stakes int, pool string"
    match = lambda i, day, pool, goals=1: (i, day and datetime(2024, 1, day), i % 3, 3 + i % 2, goals, i % 4, i % 2, pool)
    known = [match(i, 1 + i // 2, "ab"[i % 2]) for i in range(40)] + [match(50, None, "a"), match(51, 3, "c")]
    for edit, pools in ((lambda m: m + [match(60, 15, "a"), match(61, 16, "a")], {"a"}), (lambda m: m[:20] + m[21:], {"a"}), (lambda m: [match(31, 16, "b", 5) if r[0] == 31 else r for r in m], {"b"}), (lambda m: m, set()), (lambda m: m + [match(62, 1, "d"), match(63, None, "c")], {"c", "d"})):
        before, after = spark.createDataFrame(known, kinds), spark.createDataFrame(edit(known), kinds)
        got, replayed = elo.elo_update(elo.elo_replay(before, "pool"), before, after, "pool")
        key = lambda r: (r.pool, r.fixture_id, r.team_id)
        assert sorted(got.collect(), key=key) == sorted(elo.elo_replay(after, "pool").collect(), key=key)
        rows = replayed.collect()
        assert {r.pool for r in rows} == pools and len(rows) < 12


def test_elo_update_of_nothing(spark):
    empty = spark.createDataFrame([], "fixture_id int, match_date timestamp, home_team_id int, away_team_id int, home_goals int, away_goals int, is_high_stakes int, pool string")
    got, replayed = elo.elo_update(elo.elo_replay(empty, "pool"), empty, empty, "pool")
    assert got.count() == 0 == replayed.count()


@pytest.mark.parametrize("pool", [None, "league_id"])
def test_elo_replay_matches_a_plain_fold(spark, sf_dir, pool):
    m = features.match_goals(view(spark, sf_dir, "match_v"), view(spark, sf_dir, "player_v"))
    m = m.select("fixture_id", F.col("fixture_date").alias("match_date"), "home_team_id", "away_team_id", "home_goals", "away_goals", S.high_stakes(F.col("league_name")).alias("is_high_stakes"), "league_id")
    ratings, want = {}, {}
    for r in sorted(m.collect(), key=lambda r: (r.match_date, r.fixture_id)):
        of = str(r[pool]) if pool else "all"
        a, b = ratings.get((of, r.home_team_id), 1500.0), ratings.get((of, r.away_team_id), 1500.0)
        hg, ag = r.home_goals or 0, r.away_goals or 0
        result = 1.0 if hg > ag else 0.0 if hg < ag else 0.5
        k = 40.0 if r.is_high_stakes == 1 else 20.0
        new = a + k * (result - 1 / (1 + 10 ** ((b - a) / 400))), b + k * (1 - result - 1 / (1 + 10 ** ((a - b) / 400)))
        ratings[of, r.home_team_id], ratings[of, r.away_team_id] = new
        want[r.fixture_id, r.home_team_id] = (of, a, b, *new)
        want[r.fixture_id, r.away_team_id] = (of, b, a, *new[::-1])
    got = elo.elo_replay(m, pool).collect()
    assert len(got) == 2 * m.count() > 1000
    for r in got:
        w = want[r.fixture_id, r.team_id]
        assert r.pool == w[0] and (r.pre_team_elo, r.pre_opponent_elo, r.team_elo, r.opponent_elo) == pytest.approx(w[1:], abs=1e-6)


def test_numbering_by_ranges(spark):
    rows = [(i, None if i % 50 == 0 else float((i * 37) % 90)) for i in range(400)]
    got = {r.i: r.n for r in keyed.numbered(spark.createDataFrame(rows, "i int, v double"), "v", [F.col("i")], "n", 7).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [got[i] for i, _ in order] == list(range(1, 401))
    assert keyed.numbered(spark.createDataFrame([], "i int, v double"), "v", [F.col("i")], "n").count() == 0


def test_rosters(spark):
    rows = [(1, 1, f"P {i}") for i in range(11)] + [(1, 2, f"P {i}") for i in range(10)] + [(1, 2, " ")]
    out = {r.team_id: r.is_complete for r in features.check_roster(spark.createDataFrame(rows, "fixture_id int, team_id int, player_name string")).collect()}
    assert out == {1: True, 2: False}


def test_gold_defaults(spark):
    rows = spark.createDataFrame([(1, 1, "F", 90, 3), (1, 2, "G", None, 0)], "fixture_id int, team_id int, games_position string, games_minutes int, shots_total int")
    got = {r.team_id: r for r in gold.player_sapm(rows).collect()}
    assert got[1].shot_rate_smoothed_per_minute == pytest.approx(10.8 / 360) and got[2].shot_rate_smoothed_per_minute == 0.0 and got[2].weighted_minutes is None and got[1].defensive_elo == 1500.0


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, v string")
    suite = quality.run_checks({"n": quality.not_null(df, ["k", "v"]), "u": quality.unique(df, "k"), "v": quality.accepted_values(df, "v", ["a"]), "r": quality.relationships(df, df.where("k is null"), "k")})
    assert {r.check_name: r.failing_rows for r in suite.collect()} == {"n": 2, "u": 1, "v": 1, "r": 2}
    assert quality.is_empty(df.limit(0)) and not quality.is_empty(df)


def test_suite_equals_single_checks(spark):
    a = spark.createDataFrame([(1, "a", 1), (1, None, 2), (None, "b", 1), (None, "b", 1), (4, "c", None)], "k int, v string, w int")
    b = spark.createDataFrame([(1,), (1,), (5,), (None,)], "key int")
    check = quality.Check
    checks = {
        "n": check("a", "not_null", ("k", "v")), "u": check("a", "unique", ("k",)), "uc": check("a", "unique_combination", ("k", "v")), "ub": check("b", "unique", ("key",)),
        "v": check("a", "accepted_values", ("v",), ("a",)), "r": check("a", "relationships", ("k",), parent="b", parent_columns=("key",)), "back": check("b", "relationships", ("key",), parent="a", parent_columns=("k",)), "self": check("a", "relationships", ("w",), parent="a", parent_columns=("k",)),
    }

    def single(a, b):
        return {
            "n": quality.not_null(a, ["k", "v"]), "u": quality.unique(a, "k"), "uc": quality.unique_combination(a, ["k", "v"]), "ub": quality.unique(b, "key"),
            "v": quality.accepted_values(a, "v", ["a"]), "r": quality.relationships(a, b, "k", "key"), "back": quality.relationships(b, a, "key", "k"), "self": quality.relationships(a, a, "w", "k"),
        }

    for x, y in ((a, b), (a, b.limit(0)), (a.limit(0), b), (a.limit(0), b.limit(0))):
        got = quality.run_suite({"a": x, "b": y, "unused": x}, checks)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.run_checks(single(x, y)).collect()))
    with pytest.raises(ValueError):
        quality.run_suite({"a": a}, {"x": check("a", "odd", ("k",))})


def test_suite_reads_each_table_once(spark, sf_dir):
    plan = catalog.dq_suite_of_orders(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert {t: len(re.findall(rf"FileScan parquet .*{t}\.parquet", plan)) for t in ("orders", "lineitem", "customer")} == dict(orders=1, lineitem=1, customer=1)
    assert plan.count("Exchange hashpartitioning") == 1


def test_windows_replace_only_what_they_name(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "d date, v int, s struct<x: timestamp>")
    windows = lambda *w: spark.createDataFrame(w, "window_start date, window_end date")
    one, two, three = (date(2024, 1, 1), date(2024, 1, 10)), (date(2024, 1, 10), date(2024, 1, 20)), (date(2024, 2, 1), date(2024, 2, 1))
    at = (datetime(2024, 1, 1, 2, 3),)
    land = lambda r, *w: sorted((r.window[:10], r.v) for r in io.land_json_windows(r, f"{tmp_path}/w", F.col("d"), windows(*w)).collect())
    first = rows((date(2024, 1, 2), 1, at), (date(2024, 1, 10), 2, at), (date(2024, 3, 1), 3, at), (None, 4, at))
    assert land(first, one, two, three, three) == [("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-10", 2)]
    assert land(rows((date(2024, 1, 3), 9, None)), one) == [("2024-01-01", 9), ("2024-01-10", 2)]
    assert land(first.limit(0), one) == [("2024-01-10", 2)]
    back = io.read_json_windows(spark, f"{tmp_path}/w", first.schema)
    assert back.drop("window").schema == first.schema and back.first().s.x == at[0]
    with pytest.raises(ValueError):
        io.land_json_windows(first.withColumn("landed", F.lit(1)), f"{tmp_path}/w", F.col("d"), windows(one))


def test_split_lands_both_sides(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, None), (3, False), (3, False)], "k int, ok boolean")
    for i, (rows, good, bad) in enumerate([(df, [1], [2, 3, 3]), (df.where("ok"), [1], []), (df.limit(0), [], [])]):
        sides = io.land_split(rows, F.col("ok"), f"{tmp_path}/{i}")
        assert [sorted(r.k for r in s.collect()) for s in sides] == [good, bad] and all(s.columns == df.columns for s in sides)
    with pytest.raises(ValueError):
        io.land_split(df.withColumn("split", F.lit(1)), F.col("ok"), f"{tmp_path}/clash")


def test_inferred_schema_parses_what_differs(spark):
    docs = ['{"OBJECT": 1, "VARIANT": {"VOID": null, "a b": [1, 2]}, "e": {}}', '{"VARIANT": {"a b": [2.5], "x`y": true}, "OBJECT": "s"}', '{"e": {}, "l": [{"p": 1}, {"q": "z"}, null]}', "not json", None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, raw_payload string")
    got = [r.payload for r in io.parse_inferred(df).orderBy("i").collect()]
    assert (got[0].OBJECT, got[1].OBJECT) == ("1", "s") and [float(x) for x in got[0].VARIANT["a b"]] == [1.0, 2.0] and [float(x) for x in got[1].VARIANT["a b"]] == [2.5]
    assert got[1].VARIANT["x`y"] is True and got[0].VARIANT.VOID is None and got[0].e == "{}"
    assert [x and x.asDict() for x in got[2].l] == [{"p": 1, "q": None}, {"p": None, "q": "z"}, None] and got[4] is None
    flat = shape.leaf_columns(io.parse_inferred(df), "payload")
    assert {"OBJECT", "VARIANT_VOID", "VARIANT_a b", "VARIANT_x`y", "e", "l"} <= set(flat.columns)
    assert io.payload_type(None) == T.StructType([]) == io.payload_type("OBJECT<>")
    with pytest.raises(ValueError):
        shape.leaf_columns(df.select("i", F.struct(F.lit(1).alias("i")).alias("s")), "s")


def test_due_within_counts_fractions_of_a_second(spark):
    times = [(1, "2024-01-15 13:00:30"), (2, "2024-01-15 13:00:30.000001"), (3, "2024-01-15 13:00:30.9"), (4, "2024-01-15 11:00:00"), (5, None)]
    df = spark.createDataFrame(times, "id int, t string").select("id", F.to_timestamp("t").alias("t"))
    assert {r.id for r in rules.due_within(df, "t", F.to_timestamp(F.lit("2024-01-15 12:00:00"))).collect()} == {1, 4}


def test_player_views_are_dealt_by_fixture(spark, sf_dir, tmp_path):
    for key in ("bigint", "int"):
        players = view(spark, sf_dir, "player_v", key)
        assert dict(players.dtypes)["fixture_id"] == key
        dealt = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert dealt(players.groupBy("fixture_id", "team_id", "player_id").count()) == dealt(players)
    (tmp_path / "lineitem.parquet").write_bytes(b"x" * (9 << 20))
    lines = driver_tables.line_partitions
    assert lines(spark, sf_dir) == 4
    before = driver_tables._PARTITION_BYTES
    try:
        driver_tables._PARTITION_BYTES = 1 << 20
        assert lines(spark, f"file://{tmp_path}") == 9
    finally:
        driver_tables._PARTITION_BYTES = before


def test_large_years_are_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(200_000, numPartitions=8).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(1998).alias("match_year"))
        io.write_target(io.balanced(rows, ["match_year"]), f"{tmp_path}/t", "overwrite", partition_by=["match_year"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = io.read_target(spark, f"{tmp_path}/t")
    assert len(written.inputFiles()) > 1 and written.count() == 200_000


def test_decayed_features_count_matches_without_a_shuffle_of_rows(spark, sf_dir):
    out = features.decayed_features(catalog._dated(spark, sf_dir), F.to_timestamp(F.lit("1998-08-02")), 365.0, ["player_id", "team_id"])
    dealt = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(player_id" in dealt and "fixture_id" not in "".join(x.split("]")[0] for x in dealt.split("Exchange hashpartitioning(player_id")[1:])


def test_landings_are_compressed_and_replays_leave_by_a_binary_key(spark, tmp_path):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1), "{}"), (1, datetime(2024, 1, 1), "{}"), (2, datetime(2024, 1, 1), None)], "fixture_id int, landed_at timestamp, raw_payload string")
    ingest.land_files(rows, f"{tmp_path}/in")
    assert all(f.endswith(".json.gz") for f in ingest.landed_files(spark, f"{tmp_path}/in").inputFiles())
    once = ingest.without_replays(ingest.landing_stream(spark, f"{tmp_path}/in"))
    once.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    got = {(r.fixture_id, r.raw_payload, r.response_hash) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(1, "{}", hashlib.sha256(b"{}").hexdigest()), (2, None, None)} and spark.read.parquet(f"{tmp_path}/out").count() == 2
    state = (tmp_path / "ck" / "state" / "0" / "_metadata" / "schema").rglob("*")
    kept = b"".join(f.read_bytes() for f in state if f.is_file())
    assert not kept or b"binary" in kept


def test_stream_replay_changes_nothing(spark, tmp_path):
    doc = '{"response":[{"team":{"id":1,"name":"A"},"players":[{"player":{"id":7,"name":"Z"},"statistics":[{"games":{"minutes":%d}}]}]}]}'
    rows = lambda m, at: spark.createDataFrame([(1, at, doc % m)], "fixture_id int, landed_at timestamp, raw_payload string")
    run = lambda: ingest.stream_into(spark, f"{tmp_path}/in", "streamed_t", f"{tmp_path}/ck", silver.silver_player_stats, ["fixture_id", "team_id", "player_id"]).collect()
    rows(10, datetime(2024, 1, 1)).write.json(f"{tmp_path}/in")
    assert [r.games_minutes for r in run()] == [10]
    rows(20, datetime(2024, 1, 2)).write.mode("append").json(f"{tmp_path}/in")
    assert [r.games_minutes for r in run()] == [20] == [r.games_minutes for r in run()]
    rows(5, datetime(2023, 12, 31)).write.mode("append").json(f"{tmp_path}/in")
    assert [r.games_minutes for r in run()] == [20]
    spark.sql("drop view streamed_t")


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "Curaçao", 5.5)], "Rank int, Team string, Raiting double")
    df.write.csv(f"{tmp_path}/seed", header=True)
    seed = io.load_seed(spark, f"{tmp_path}/seed", "Rank int, Team string, Raiting double", {"Raiting": "rating"}, date(2022, 12, 22)).first()
    assert seed.rating == 5.5 and seed.ranking_as_of_date == date(2022, 12, 22)
    io.ensure_table(spark, "ensured_t", "a int")
    io.ensure_table(spark, "ensured_t", "a int")
    assert io.target_exists(spark, "ensured_t") and not io.target_exists(spark, "no_such_table") and not io.target_exists(spark, f"{tmp_path}/none")
    io.write_target(spark.range(3), "ensured_u", "overwrite", overwrite_schema=True)
    assert io.materialize(spark.range(2), "ensured_u").count() == 2 and io.read_target(spark, "ensured_u").count() == 2
    for t in ("ensured_t", "ensured_u"):
        spark.sql(f"drop table {t}")


def test_match_goals_of_awkward_matches(spark):
    """Repeated matches, teams and fixtures that are null, sides without players or without goals, sums over a team's rows."""
    stats = spark.createDataFrame([(1, 5, 2), (1, 5, 1), (1, None, 7), (1, 6, None), (None, 5, 9), (2, 8, 4)], "fixture_id int, team_id int, goals_total int").withColumns({c: F.lit(1) for c in ("shots_total", "games_minutes", "shots_on")})
    matches = spark.createDataFrame([(1, 5, 6), (1, 6, 5), (1, None, 5), (2, 5, 8), (3, 5, 6), (None, 5, 6)], "fixture_id long, home_team_id long, away_team_id int")
    got = features.match_goals(matches, stats).select("fixture_id", "home_team_id", "away_team_id", "home_goals", "away_goals")
    assert got.dtypes[3:] == [("home_goals", "bigint"), ("away_goals", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 5, 6, 3, None), (1, 6, 5, None, 3), (1, None, 5, None, 3), (2, 5, 8, None, 4), (3, 5, 6, None, None), (None, 5, 6, None, None)], key=repr)
    totals = features.team_match_totals(stats)
    one, two = (features.team_match_result(totals, m) for m in (matches, features.match_goals(matches, stats)))
    assert one.columns == two.columns and sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


def test_joins_within_a_key_are_joins_by_all_keys(spark):
    """Repeats on both sides, null keys, teams the other side lacks, and columns that are null."""
    left = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "c"), (None, 5, "d"), (2, 7, "e"), (3, 5, None), (1, 6, "f")], "k int, t int, v string")
    right = spark.createDataFrame([(1, 5, 10), (1, 5, 11), (1, 6, None), (1, None, 12), (None, 5, 13), (2, 8, 14), (4, 5, 15)], "k int, t long, w int")
    for how in ("inner", "left"):
        got, want = keyed.join_within(left, right, "k", ["t"], how), left.join(right, ["k", "t"], how)
        assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
