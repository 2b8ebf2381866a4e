"""Rating replay: an ordered fold over matches, in parallel over pools."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.keyed import latest_by_key

SCHEMA = "fixture_id bigint, match_date timestamp, team_id bigint, opponent_team_id bigint, pre_team_elo double, pre_opponent_elo double, team_elo double, opponent_elo double, is_high_stakes int, pool string"
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
START, SCALE = 1500.0, 400.0
#: What a match moves at most: one that counts for much, and others.
MOVES = (40.0, 20.0)


def _typed(matches: DataFrame, pool_col: str | None) -> DataFrame:
    """Matches with both teams, in the types that the fold reads."""
    pool = F.col(pool_col).cast("string") if pool_col else F.lit("all")
    goals = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return matches.where("home_team_id is not null and away_team_id is not null").select(
        F.col("fixture_id").cast("bigint").alias("fixture_id"), F.col("match_date").cast("timestamp").alias("match_date"),
        F.col("home_team_id").cast("bigint").alias("home_team_id"), F.col("away_team_id").cast("bigint").alias("away_team_id"),
        goals("home_goals"), goals("away_goals"), F.coalesce("is_high_stakes", F.lit(0)).cast("int").alias("is_high_stakes"), pool.alias("pool"),
    )


def elo_replay(matches: DataFrame, pool_col: str | None = None, start: DataFrame | None = None) -> DataFrame:
    """Two rows a match with both sides' ratings before and after it.

    Matches are replayed by date and number; teams start at 1500; K is 40 for matches that count for much, else 20; null
    goals are 0 and equal goals a draw. ``matches`` has fixture_id, match_date, home_team_id, away_team_id, home_goals,
    away_goals, is_high_stakes. A pool (say, a confederation) is one task, as each rating rests on all before it; a
    team's ratings in different pools are apart. Spark sorts a pool's matches, on disk where needed, and the task keeps
    no more of them than the ratings so far. ``start`` (pool, team_id, rating) are ratings that teams have already.
    """
    return _fold(_typed(matches, pool_col), start)


def _fold(rows: DataFrame, start: DataFrame | None) -> DataFrame:
    rows = rows.withColumn("rating", F.lit(None).cast("double"))
    if start is not None:
        given = start.select("pool", F.col("team_id").cast("bigint").alias("home_team_id"), F.col("rating").cast("double").alias("rating"))
        rows = rows.unionByName(given, allowMissingColumns=True)
    order = ["pool", F.col("rating").isNull(), F.asc_nulls_last("match_date"), "fixture_id", "home_team_id", "away_team_id", "home_goals", "away_goals"]
    return rows.repartition("pool").sortWithinPartitions(*order).mapInPandas(_replay, SCHEMA)


def rating_snapshot(ratings: DataFrame) -> DataFrame:
    """The rating each team of each pool ends with (pool, team_id, rating), from rows of :func:`elo_replay`."""
    last = latest_by_key(ratings, ["pool", "team_id"], [F.desc_nulls_first("match_date"), F.desc("fixture_id")])
    return last.select("pool", "team_id", F.col("team_elo").alias("rating"))


def elo_update(ratings: DataFrame, known: DataFrame, matches: DataFrame, pool_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The ratings of ``matches``, and the matches replayed for them, from ``ratings``, the replay of ``known``.

    Each pool is replayed from the first day on which a match was added, taken away or changed, from the ratings that
    its teams had before; earlier days, and pools without a change, stay as they are. A match's number is its own.
    """
    new, old = _typed(matches, pool_col), _typed(known, pool_col)
    day = F.coalesce("match_date", F.lit("9999-12-31").cast("timestamp"))  # matches without a date are replayed last
    changed = new.exceptAll(old).unionAll(old.exceptAll(new))
    cut = changed.groupBy("pool").agg(F.min(day).alias("cut"))  # a row a pool
    kept = ratings.join(cut, "pool", "left").where(F.col("cut").isNull() | (day < F.col("cut")))
    suffix = new.join(cut, "pool").where(day >= F.col("cut")).drop("cut")
    start = rating_snapshot(kept.where("cut is not null"))
    return kept.select(*_NAMES).unionByName(_fold(suffix, start)), suffix


def _replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fold over sorted matches, a batch at a time; ratings begin anew with each pool."""
    current, ratings = None, {}
    for batch in batches:
        rows = []
        for m in batch.itertuples(index=False):
            if m.pool != current:
                current, ratings = m.pool, {}
            if m.rating == m.rating and m.rating is not None:  # one that a team has already
                ratings[int(m.home_team_id)] = m.rating
                continue
            home, away = (ratings.get(t, START) for t in (m.home_team_id, m.away_team_id))
            won = 1.0 if m.home_goals > m.away_goals else 0.5 if m.home_goals == m.away_goals else 0.0
            moved = MOVES[m.is_high_stakes != 1] * (won - 1.0 / (1.0 + 10.0 ** ((away - home) / SCALE)))
            ratings[m.home_team_id], ratings[m.away_team_id] = home + moved, away - moved
            rows.append((m.fixture_id, m.match_date, m.home_team_id, m.away_team_id, home, away, home + moved, away - moved, m.is_high_stakes, m.pool))
            rows.append((m.fixture_id, m.match_date, m.away_team_id, m.home_team_id, away, home, away - moved, home + moved, m.is_high_stakes, m.pool))
        yield pd.DataFrame(rows, columns=_NAMES)
