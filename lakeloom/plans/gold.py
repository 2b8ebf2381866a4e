"""Typed tables to feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import scalar as S
from lakeloom.functions.names import normalize_name
from lakeloom.operators import features, keyed, rules, shape

CONTEXT = {"game_importance_scalar": 1.0, "opponent_strength_adjustment": 1.0, "defensive_containment_rating": 1.0, "defensive_elo": 1500.0}


def team_match_context(fixtures: DataFrame) -> DataFrame:
    """Two rows a fixture, one a side, with neutral context values."""
    shared = [c for c in ("fixture_id", "fixture_date", "league_id", "league_name", "league_season", "status_short") if c in fixtures.columns]
    home = {"team_id": "home_team_id", "opponent_team_id": "away_team_id"}
    away = {"team_id": "away_team_id", "opponent_team_id": "home_team_id"}
    for name in ("team_name", "goals"):
        if f"home_{name}" in fixtures.columns:
            other = "opponent_" + name
            home |= {name: f"home_{name}", other: f"away_{name}"}
            away |= {name: f"away_{name}", other: f"home_{name}"}
    rows = shape.with_defaults(shape.unpivot_sides(fixtures, shared, home, away), CONTEXT)
    if "team_name" in rows.columns:
        rows = rows.withColumn("team_name_normalized", normalize_name(F.col("team_name"))).withColumn("opponent_team_name_normalized", normalize_name(F.col("opponent_team_name")))
    return rows


def rating_baseline(seed: DataFrame) -> DataFrame:
    """The seed ranking with a key for its names."""
    return seed.withColumn("team_name_normalized", normalize_name(F.col("team_name")))


def player_shot_features(stats: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Player rows with their fixture, opponent and rates for 90 minutes."""
    columns = [c for c in ("fixture_date", "league_id", "league_name", "league_season", "home_team_id", "away_team_id") if c in fixtures.columns]
    joined = keyed.join_context(stats, fixtures, ["fixture_id"], columns)
    joined = joined.withColumn("opponent_team_id", S.opponent_of(F.col("team_id"), F.col("home_team_id"), F.col("away_team_id"))).drop("home_team_id", "away_team_id")
    minutes = F.col("games_minutes")
    return joined.withColumn("shots_per_90", S.per_90(F.col("shots_total"), minutes)).withColumn("shots_on_per_90", S.per_90(F.col("shots_on"), minutes))


def player_sapm(stats: DataFrame, context: DataFrame | None = None, priors: DataFrame | None = None) -> DataFrame:
    """Player rows with position priors, match context, smoothed rate and weighed shots and minutes.

    Context joins on the keys it has: fixture and team, or fixture alone if it has one row a fixture. Estimated
    ``priors`` (position_group, prior_alpha, prior_beta; four rows) replace the default ones.
    """
    rows = stats.withColumn("position_group", S.position_group(F.col("games_position")))
    if priors is None:
        rows = rows.withColumn("prior_alpha", S.default_alpha(F.col("position_group"))).withColumn("prior_beta", F.lit(S.PRIOR_MINUTES))
    else:
        rows = rows.join(keyed.if_small(priors), "position_group", "left")
    if context is None:
        rows = shape.with_defaults(rows, CONTEXT)
    else:
        rows = keyed.join_context(rows, context, ["fixture_id", "team_id"], list(CONTEXT), CONTEXT, check=True)
    weight = F.col("game_importance_scalar") * F.col("opponent_strength_adjustment")
    return (
        rows.withColumn("shot_rate_smoothed_per_minute", S.smoothed_rate(F.col("prior_alpha"), F.col("prior_beta"), F.col("shots_total"), F.col("games_minutes")))
        .withColumn("sapm_interaction_weight", weight).withColumn("weighted_shots", weight * F.col("shots_total")).withColumn("weighted_minutes", weight * F.col("games_minutes"))
    )


def team_history(stats: DataFrame, fixtures: DataFrame, n: int = 5, exclude=None) -> DataFrame:
    """Rows of players who played in their team's last ``n`` finished matches, for all teams at once."""
    done = rules.completed_only(fixtures)
    sides = shape.unpivot_sides(done, ["fixture_id", "fixture_date"], {"team_id": "home_team_id", "opponent_team_id": "away_team_id"}, {"team_id": "away_team_id", "opponent_team_id": "home_team_id"})
    last = keyed.trailing_n(sides, ["team_id"], [F.desc("fixture_date"), F.desc("fixture_id")], n, exclude)
    return keyed.join_within(rules.played_only(stats), last, "fixture_id", ["team_id"])


def matchup_matrix(fixtures: DataFrame, stats: DataFrame, lineups: DataFrame, n: int = 5) -> DataFrame:
    """Projections of every starter of every fixture: rates over the team's last matches, against the factor of the
    opponent among the opponents both have met; all fixtures in a few joins."""
    history = team_history(stats, fixtures, n)
    rates = features.player_rates(history, ["team_id", "player_id"])
    sides = shape.unpivot_sides(fixtures, ["fixture_id"], {"team_id": "home_team_id", "opponent_team_id": "away_team_id"}, {"team_id": "away_team_id", "opponent_team_id": "home_team_id"})
    pairs = sides.select(F.col("opponent_team_id").alias("team_id"), F.col("team_id").alias("rival_id"))
    factors = features.common_opponent_factors(fixtures, features.team_fixture_totals(stats), pairs=pairs)
    starters = lineups.where("is_starting").groupBy("fixture_id", "team_id", "player_id").agg(F.min("position").alias("position"))
    rows = keyed.join_within(starters, sides, "fixture_id", ["team_id"]).join(rates, ["team_id", "player_id"], "left")
    rows = shape.with_defaults(rows, {"minutes": 0.0, "shots": 0.0, "shots_on": 0.0, "goals": 0.0}, coalesce=True)
    against = factors.select(F.col("team_id").alias("opponent_team_id"), F.col("rival_id").alias("team_id"), "factor")
    rows = rows.join(against, ["opponent_team_id", "team_id"], "left")
    shrunk = features.shrunk_rates(rows, S.position_group(F.col("position")))
    return features.shot_projection(shrunk, F.coalesce("factor", F.lit(1.0)))
