"""Landed payloads to typed, deduplicated tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.names import normalize_name
from lakeloom.operators import keyed, shape
from lakeloom.operators.increments import IncrementTable

#: Columns of the typed tables: path in the flattened payload and type.
FIXTURE_COLUMNS = {
    "league_id": ("item.league.id", "int"), "league_name": ("item.league.name", "string"), "league_season": ("item.league.season", "int"),
    "home_team_id": ("item.teams.home.id", "int"), "home_team_name": ("item.teams.home.name", "string"),
    "away_team_id": ("item.teams.away.id", "int"), "away_team_name": ("item.teams.away.name", "string"),
    "home_goals": ("item.goals.home", "int"), "away_goals": ("item.goals.away", "int"),
    "status_short": ("item.fixture.status.short", "string"), "status_long": ("item.fixture.status.long", "string"),
    "venue": ("item.fixture.venue.name", "string"), "country": ("item.league.country", "string"),
}
PLAYER_COLUMNS = {
    "team_name": ("team.name", "string"), "player_name": ("player.name", "string"),
    "games_minutes": ("s.games.minutes", "int"), "games_position": ("s.games.position", "string"),
    "shots_total": ("s.shots.total", "int"), "shots_on": ("s.shots.on", "int"), "goals_total": ("s.goals.total", "int"),
}
LINEUP_COLUMNS = {
    "team_name": ("item.team.name", "string"), "player_name": ("member.player.name", "string"),
    "position": ("member.player.pos", "string"), "number": ("member.player.number", "int"), "formation": ("item.formation", "string"),
}


def _order(df: DataFrame, extra: list[Column]) -> list[Column]:
    """Newest landing first, then its hash, then ``extra``: a total order, so reruns choose the same rows."""
    return [*[F.desc_nulls_last(c) for c in _landed(df)], F.col("response_hash"), *extra]


def _landed(df: DataFrame) -> list[str]:
    """The time of landing, where landed rows have it: typed rows keep it, so that upserts can go by it."""
    return [c for c in ("ingested_at_utc",) if c in df.columns]


def _since(bronze: DataFrame, since: Column | None) -> DataFrame:
    return bronze if since is None else bronze.where(F.col("ingested_at_utc") > since)


def _itself(df: DataFrame, *names: str) -> dict[str, tuple[str, str]]:
    kinds = dict(df.dtypes)
    return {n: (n, kinds[n]) for n in names}


def silver_fixtures(bronze: DataFrame, since: Column | None = None, parts: int | None = None) -> DataFrame:
    """One row a fixture from landed fixtures payloads; ``since`` limits the landings read. With ``parts`` the rows come
    dealt by fixture_id over so many partitions, else over the session's."""
    df = shape.flatten(shape.parse_payload(_since(bronze, since), shape.FIXTURE_PAYLOAD), [("payload.response", "item")])
    df = df.withColumn("fixture_id", F.col("item.fixture.id")).withColumn("fixture_date_utc", F.try_to_timestamp("item.fixture.date"))
    df = shape.require_keys(df, ["fixture_id"])
    df = df.select("fixture_id", "fixture_date_utc", "item", "response_hash", *_landed(df))
    df = df if parts is None else df.repartition(parts, "fixture_id")
    df = keyed.latest_by_key(df, ["fixture_id"], _order(df, [F.to_json("item")]))
    return shape.project_paths(df, _itself(df, "fixture_id", "fixture_date_utc") | FIXTURE_COLUMNS | _itself(df, "response_hash", *_landed(df)))


def silver_player_stats(bronze: DataFrame, since: Column | None = None) -> DataFrame:
    """One row a fixture, team and player. A player without statistics stays, with null minutes and no shots; of several
    rows of a key the last listed counts."""
    df = shape.parse_payload(_since(bronze, since), shape.PLAYER_PAYLOAD)
    df = df.withColumn("t", F.explode("payload.response")).select(*bronze.columns, "t.team", F.posexplode("t.players").alias("place", "p"))
    df = df.select(*bronze.columns, "team", "place", "p.player", F.posexplode_outer("p.statistics").alias("nth", "s"))
    df = df.withColumn("team_id", F.col("team.id")).withColumn("player_id", F.col("player.id"))
    df = shape.require_keys(df, ["player_id"])
    df = keyed.latest_by_key(df, ["fixture_id", "team_id", "player_id"], _order(df, [F.desc("place"), F.desc_nulls_last("nth")]))
    df = shape.project_paths(df, _itself(df, "fixture_id", "team_id", "player_id") | PLAYER_COLUMNS | _itself(df, "response_hash", *_landed(df)))
    df = shape.with_defaults(df, {"shots_total": 0, "shots_on": 0, "goals_total": 0}, coalesce=True)
    names = {f"{n}_normalized": normalize_name(F.col(n)) for n in ("player_name", "team_name")}
    return df.withColumns(names)


def silver_lineups(bronze: DataFrame, since: Column | None = None) -> DataFrame:
    """One row a fixture, team and player of the line-ups; a player listed twice counts as a starter."""
    df = shape.flatten(shape.parse_payload(_since(bronze, since), shape.LINEUP_PAYLOAD), [("payload.response", "item")])
    df = shape.explode_tagged(df, {"item.startXI": True, "item.substitutes": False}, "member", "is_starting")
    df = df.withColumn("team_id", F.col("item.team.id")).withColumn("player_id", F.col("member.player.id"))
    df = shape.require_keys(df, ["player_id"])
    order = [F.desc("is_starting"), *_order(df, [F.col(f"member.player.{c}") for c in ("number", "name", "pos")])]
    df = keyed.latest_by_key(df, ["fixture_id", "team_id", "player_id"], order)
    return shape.project_paths(df, _itself(df, "fixture_id", "team_id", "player_id", "is_starting") | LINEUP_COLUMNS | _itself(df, "response_hash", *_landed(df)))


def refresh(table: IncrementTable, bronze: DataFrame, normalize: Callable[[DataFrame], DataFrame], lag: str | None = None) -> bool:
    """Bring a stored typed table up to date with what has landed since; False if nothing has.

    The table's mark is the landing time up to which it has read; it moves in the same step as the rows, so a run that
    breaks off repeats nothing and leaves nothing out. ``table`` goes by ingested_at_utc. With ``lag``, an interval such as
    ``1 hour``, landings from so long before the mark are read again: writers that take that long to land don't slip by.
    """
    mark, when = table.marks().get("landed"), F.unix_micros("ingested_at_utc")
    rows = bronze
    if mark is not None:
        since = F.timestamp_micros(F.lit(mark))
        rows = bronze.where(F.col("ingested_at_utc") > (since if lag is None else since - F.expr(f"interval {lag}")))
    newest = rows.agg(F.max(when)).first()[0]
    if newest is None or (mark is not None and newest <= mark and lag is None):
        return False
    table.merge(normalize(rows.where(when <= newest)), marks={"landed": max(newest, mark or newest)})
    return True


def dead_letters(bronze: DataFrame) -> DataFrame:
    """Landed rows whose payload isn't JSON."""
    from lakeloom.sources.io import quarantine

    return quarantine(bronze.where(shape.malformed()), F.lit("payload is not JSON"), "silver")
