"""Aggregated features: totals, decayed sums, priors, plus-minus, common-opponent factors and closed-form projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import scalar as S
from lakeloom.functions.names import normalize_name
from lakeloom.operators.keyed import join_within, shared_opponents


def team_match_totals(stats: DataFrame, keys: list[str] = ["fixture_id", "team_id"]) -> DataFrame:
    """Sums of a team's players in a match."""
    total = lambda c, n: F.sum(c).cast("bigint").alias(n)
    return stats.groupBy(*keys).agg(total("shots_total", "team_shots"), total("goals_total", "team_goals"), total("games_minutes", "team_minutes"), total("shots_on", "team_shots_on"))


def match_goals(matches: DataFrame, stats: DataFrame) -> DataFrame:
    """``matches`` with home_goals and away_goals: the goals of each side's players (null if it has none)."""
    # Joined by fixture alone, so rows that are dealt by fixture need no shuffle; a fixture has a handful of teams.
    goals = stats.groupBy("fixture_id", "team_id").agg(F.sum("goals_total").cast("bigint").alias("goals"))
    return _side_goals(matches.join(goals.groupBy("fixture_id").agg(F.collect_list(F.struct("team_id", "goals")).alias("__teams")), "fixture_id", "left"))


def _side_goals(rows: DataFrame) -> DataFrame:
    """home_goals and away_goals out of ``__teams``, the teams of the row's fixture with their goals."""
    of = lambda side: F.get(F.filter("__teams", lambda t: t["team_id"] == F.col(f"{side}_team_id")), F.lit(0))["goals"]
    return rows.withColumns({f"{side}_goals": of(side) for side in ("home", "away")}).drop("__teams")


def team_match_result(totals: DataFrame, matches: DataFrame) -> DataFrame:
    """Totals with goals for and against, goal difference and points. ``matches`` has goals of both sides, or if it has none
    they are those of the totals, which are then looked at once."""
    names = ["fixture_id", "home_team_id", "away_team_id"]
    home = F.col("team_id") == F.col("home_team_id")
    if "home_goals" in matches.columns:
        rows = totals.join(matches.select(*names, "home_goals", "away_goals"), "fixture_id", "left")
    else:
        teams = F.collect_list(F.struct("team_id", F.col("team_goals").alias("goals"))).over(Window.partitionBy("fixture_id"))
        rows = _side_goals(totals.withColumn("__teams", teams).join(matches.select(*names), "fixture_id", "left"))
    out = rows.withColumn("goals_for", F.when(home, F.col("home_goals")).otherwise(F.col("away_goals"))).withColumn("goals_against", F.when(home, F.col("away_goals")).otherwise(F.col("home_goals")))
    out = out.withColumn("goal_diff", F.coalesce("goals_for", F.lit(0)) - F.coalesce("goals_against", F.lit(0)))
    return out.withColumn("result_points", S.result_points(F.col("goal_diff")))


def decayed_features(stats: DataFrame, as_of: Column, half_life: float, keys: list[str]) -> DataFrame:
    """Sums of a player's shots, goals and minutes, each match weighed by its age; ``stats`` has fixture_date."""
    w = S.recency_weight(F.col("fixture_date"), as_of, half_life)
    weighed = stats.where("games_minutes > 0").withColumn("w", w)
    total = lambda c, n: F.sum(F.col(c) * F.col("w")).alias(n)
    sums = ["shots_decayed", "shots_on_decayed", "goals_decayed", "minutes_decayed"]
    # A row a match first: rows dealt by match need no shuffle for it, and what is dealt by ``keys`` are sums of tasks.
    one = weighed.groupBy(*keys, "fixture_id").agg(total("shots_total", sums[0]), total("shots_on", sums[1]), total("goals_total", sums[2]), total("games_minutes", sums[3]), F.max("fixture_date").alias("latest_date"))
    out = one.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.max("latest_date").alias("latest_date"), F.count("fixture_id").alias("matches_observed"))
    return out.withColumn("shots_per_90_decayed", S.per_90(F.col("shots_decayed"), F.col("minutes_decayed")))


def context_weights(matches: DataFrame, ratings: DataFrame) -> DataFrame:
    """fixture_id, w_stake, w_opp: a competition's weight and that of the mean rating gap; ``ratings`` has fixture_id,
    team_elo, opponent_elo."""
    gap = ratings.groupBy("fixture_id").agg(F.avg(F.abs(F.col("team_elo") - F.col("opponent_elo"))).alias("gap"))
    stake = F.when(S.high_stakes(F.col("league_name")) == 1, 1.25).otherwise(1.0)
    return matches.select("fixture_id", stake.alias("w_stake")).join(gap, "fixture_id", "left").select("fixture_id", "w_stake", S.gap_weight(F.col("gap")).alias("w_opp"))


def estimate_priors(stats: DataFrame, prior_minutes: float = S.PRIOR_MINUTES) -> DataFrame:
    """alpha and beta of each position group: its shots a minute times ``prior_minutes``; a group without minutes has
    its default rate."""
    spark = stats.sparkSession
    base = spark.createDataFrame([(g, v[0] / 90.0) for g, v in S.POSITION_PRIORS.items()], "position_group string, default_rate double")
    seen = stats.groupBy(S.position_group(F.col("games_position")).alias("position_group")).agg(F.sum("shots_total").alias("shots"), F.sum("games_minutes").alias("minutes"))
    rate = F.when(F.col("minutes") > 0, F.coalesce("shots", F.lit(0)).cast("double") / F.col("minutes")).otherwise(F.col("default_rate"))
    return F.broadcast(base).join(seen, "position_group", "left").select("position_group", (rate * prior_minutes).alias("prior_alpha"), F.lit(float(prior_minutes)).alias("prior_beta"))


def player_rates(stats: DataFrame, keys: list[str], as_of: Column | None = None, half_life: float = S.HALF_LIFE_DAYS) -> DataFrame:
    """Weighed minutes, shots, shots on target and goals of each player."""
    w = S.recency_weight(F.col("fixture_date"), as_of, half_life) if as_of is not None else F.lit(1.0)
    weighed = stats.withColumn("w", w)
    total = lambda c, n: F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0)) * F.col("w")), F.lit(0.0)).alias(n)
    return weighed.groupBy(*keys).agg(total("games_minutes", "minutes"), total("shots_total", "shots"), total("shots_on", "shots_on"), total("goals_total", "goals"))


def shrunk_rates(rates: DataFrame, group: Column) -> DataFrame:
    """Rates pulled to their position's priors by weight min(1, minutes / 450)."""
    r = rates.withColumn("position_group", group).withColumn("weight", F.least(F.lit(1.0), F.col("minutes") / S.FULL_MINUTES))
    seen = lambda n, d, k: F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(S.prior(F.col("position_group"), k))
    per90 = F.when(F.col("minutes") > 0, F.col("shots") / F.col("minutes") * 90.0).otherwise(S.prior(F.col("position_group"), 0))
    w, g = F.col("weight"), F.col("position_group")
    return (
        r.withColumn("shots_per_90", S.blended(per90, S.prior(g, 0), w))
        .withColumn("on_target", S.clip(S.blended(seen("shots_on", "shots", 1), S.prior(g, 1), w), 0.01, 0.99))
        .withColumn("conversion", S.clip(S.blended(seen("goals", "shots_on", 2), S.prior(g, 2), w), 0.01, 0.99))
    )


def shot_projection(rates: DataFrame, factor: Column) -> DataFrame:
    """Expected shots, on target, missed, goals and the chance of any shot. Counts are Poisson and thinned, so all of
    them follow from the rate in closed form."""
    rate = F.col("shots_per_90") * factor
    return rates.withColumn("mean_shots", rate).withColumn("mean_on_target", rate * F.col("on_target")).withColumn("mean_goals", rate * F.col("on_target") * F.col("conversion")).withColumn("mean_missed", rate * (F.lit(1.0) - F.col("on_target"))).withColumn("any_shot", F.lit(1.0) - F.exp(-rate))


def projection_matrix(projected: DataFrame) -> DataFrame:
    """The report's columns, without goalkeepers; chances in percent."""
    four = lambda c, k=1: F.round(F.col(c) * k, 4)
    return projected.where("position_group != 'G'").select("team_id", "player_id", F.col("position_group").alias("position"), four("mean_shots").alias("projected_shots"), four("mean_on_target").alias("projected_on_target"), four("mean_missed").alias("projected_missed"), four("mean_goals").alias("projected_goals"), four("any_shot", 100).alias("any_shot_percent"))


def weighted_plus_minus(segments: DataFrame, keys: list[str], weight: Column) -> DataFrame:
    """Rates of shots with and without a player, each segment weighed, and their ratio.

    ``segments`` has shots_on_pitch, minutes_on_pitch, shots_off_pitch, minutes_off_pitch. Without an off rate the ratio
    is infinite.
    """
    s = segments.withColumn("w", weight)
    total = lambda c: F.coalesce(F.sum(F.col("w") * F.col(c)), F.lit(0.0))
    t = s.groupBy(*keys).agg(total("minutes_on_pitch").alias("on_minutes"), total("minutes_off_pitch").alias("off_minutes"), total("shots_on_pitch").alias("on_shots"), total("shots_off_pitch").alias("off_shots"))
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    t = t.withColumn("on_rate", rate("on_shots", "on_minutes")).withColumn("off_rate", rate("off_shots", "off_minutes"))
    return t.withColumn("ratio", F.when(F.col("off_rate") > 0, F.col("on_rate") / F.col("off_rate")).otherwise(F.lit(float("inf"))))


def team_fixture_totals(stats: DataFrame) -> DataFrame:
    """Shots of each team in each match."""
    return stats.groupBy("fixture_id", "team_id").agg(F.sum(F.coalesce("shots_total", F.lit(0))).alias("shots"))


def leave_one_out_mean(rows: DataFrame, key: str, part: str, value: str) -> DataFrame:
    """For each (key, part): n and total of its rows, and ``rest_mean``, the mean over the key's other rows (null if
    none). Two group-bys, and no second look at the rows."""
    pair = rows.groupBy(key, part).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    whole = pair.groupBy(key).agg(F.sum("n").alias("all_n"), F.sum("total").alias("all_total"))
    rest = F.when(F.col("all_n") > F.col("n"), (F.col("all_total") - F.col("total")).cast("double") / (F.col("all_n") - F.col("n")))
    return pair.join(whole, key).select(key, part, "n", "total", rest.alias("rest_mean"))


def common_opponent_factors(matches: DataFrame, totals: DataFrame, elo: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """team_id, rival_id, factor: how many shots a team lets the opponents it shares with a rival have, against what
    these have in their other matches, scaled by the team's rating and held between 0.5 and 1.5.

    ``matches`` has fixture_id and both side ids, ``totals`` shots by fixture and team, ``elo`` team_id and elo. With
    ``pairs`` (team_id, rival_id) the factors of those alone, each at the cost of the shorter list of opponents
    (``keyed.shared_opponents``). Without, the result itself holds every pair of rivals that met one opponent: it grows
    with the square of the teams that did. What is joined are pairs of teams, summed before, never matches.
    """
    sides = matches.select("fixture_id", F.explode(F.array(F.struct(F.col("home_team_id").alias("team"), F.col("away_team_id").alias("opponent")), F.struct(F.col("away_team_id").alias("team"), F.col("home_team_id").alias("opponent")))).alias("s")).select("fixture_id", "s.*")
    # Shots of the opponent in the match against ``team``.
    shots = join_within(sides, totals.select("fixture_id", F.col("team_id").alias("opponent"), "shots"), "fixture_id", ["opponent"])
    base = totals.agg(F.avg("shots").alias("global_mean"))  # one row
    loo = leave_one_out_mean(shots, "opponent", "team", "shots").join(F.broadcast(base), F.lit(True))
    faced = loo.select("team", "opponent", "n", "total", F.coalesce("rest_mean", "global_mean").alias("baseline"))
    met = sides.select("team", "opponent").where("team is not null and opponent is not null").distinct()
    if pairs is None:
        shared = faced.where("baseline > 0").alias("f").join(met.alias("m"), F.expr("f.opponent = m.opponent and f.team != m.team")).select(F.col("f.team").alias("team_a"), F.col("m.team").alias("team_b"), F.struct("total", "baseline", "n").alias("a"))
    else:
        asked = pairs.select(F.col("team_id").alias("team_a"), F.col("rival_id").alias("team_b"))
        shared = shared_opponents(asked, met.join(faced, ["team", "opponent"], "left")).where("a.baseline > 0")
    summed = shared.groupBy(F.col("team_a").alias("team_id"), F.col("team_b").alias("rival_id")).agg(F.sum("a.total").alias("actual"), F.sum(F.col("a.baseline") * F.col("a.n")).alias("expected"))
    factor = F.when(F.col("expected") > 0, F.col("actual") / F.col("expected")).otherwise(F.lit(1.0))
    rated = summed.join(elo, "team_id", "left") if elo is not None else summed.withColumn("elo", F.lit(None).cast("double"))
    return rated.select("team_id", "rival_id", S.clip(factor * S.elo_anchor(F.col("elo")), 0.5, 1.5).alias("factor"))


def check_roster(lineups: DataFrame, n: int = 11) -> DataFrame:
    """fixture_id, team_id, rows, names, is_complete: exactly ``n`` rows with ``n`` different names, none empty."""
    name = normalize_name(F.col("player_name"), "player")
    out = lineups.groupBy("fixture_id", "team_id").agg(F.count("*").alias("players"), F.count_distinct(F.when(name != "", name)).alias("names"))
    return out.withColumn("is_complete", (F.col("players") == n) & (F.col("names") == n))


def resolve_lineups(confirmed: DataFrame, fallback: DataFrame, n: int = 11) -> DataFrame:
    """The confirmed rows of complete line-ups, and for the other teams of ``fallback`` its rows; lineup_source tells."""
    # Joined by fixture alone, so rows that are dealt by fixture need no shuffle; a fixture has a handful of teams.
    good = check_roster(confirmed, n).where("is_complete").groupBy("fixture_id").agg(F.collect_set("team_id").alias("__good"))
    is_good = F.coalesce(F.array_contains("__good", F.col("team_id")), F.lit(False))
    source = F.col("lineup_source")
    rows = confirmed.withColumn("lineup_source", F.lit("confirmed")).unionByName(fallback.withColumn("lineup_source", F.lit("fallback")))
    return rows.join(good, "fixture_id", "left").where(is_good == (source == "confirmed")).drop("__good")
