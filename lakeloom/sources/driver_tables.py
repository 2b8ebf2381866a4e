"""The driver's tables seen as matches, player rows, line-ups, checkpoints and observations, and as raw payloads."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The views as SQL that Spark and DuckDB both run; names in braces are tables.
MATCH = """
select o_orderkey as fixture_id, o_orderdate as fixture_date,
  cast(o_custkey % 16 as int) as home_team_id,
  cast((o_custkey % 16 + 1 + o_orderkey % 15) % 16 as int) as away_team_id,
  case substr(o_orderpriority, 1, 1) when '1' then 1 when '2' then 10 when '3' then 667
       when '4' then 666 else 36 end as league_id,
  case substr(o_orderpriority, 1, 1) when '1' then 'World Cup' when '2' then 'Friendlies'
       when '3' then 'Friendlies Clubs' when '4' then 'Friendlies Women'
       else 'Africa Cup of Nations - Qualification' end as league_name,
  'World' as country, cast(year(o_orderdate) as int) as league_season,
  case o_orderstatus when 'F' then 'FT' when 'P' then 'PEN' else 'NS' end as status_short
from {orders}"""
_PLAYER_COLUMNS = """
select l.l_orderkey as fixture_id, l.l_linenumber as line_no,
  case when l.l_linenumber % 2 = 1 then m.home_team_id else m.away_team_id end as team_id,
  cast(l.l_partkey % 500 as int) as player_id, p.p_name as player_name,
  nullif(cast(floor(l.l_quantity) as int) * 2, 2) as games_minutes,
  case l.l_partkey % 5 when 0 then 'F' when 1 then 'Attacker' when 2 then 'D'
       when 3 then 'G' else 'Midfielder' end as games_position,
  nullif(cast(floor(l.l_quantity) as int) % 7, 0) as shots_total,
  cast(floor((cast(floor(l.l_quantity) as int) % 7) / 2) as int) as shots_on,
  cast(floor((cast(floor(l.l_quantity) as int) % 7) / 4) as int) as goals_total"""
PLAYER = f"""{_PLAYER_COLUMNS}
from {{lineitem}} l join {{match_v}} m on m.fixture_id = l.l_orderkey
join {{part}} p on p.p_partkey = l.l_partkey"""
#: The same for Spark: ``named_lines`` has each line with its part's name, dealt by order.
_DEALT_PLAYER = f"{_PLAYER_COLUMNS.replace('p.p_name', 'l.p_name')}\nfrom {{named_lines}} l join {{match_v}} m on m.fixture_id = l.l_orderkey"
LINEUP = """
select fixture_id, line_no, team_id, player_id, player_name,
  substr(games_position, 1, 1) as position, line_no as number, line_no <= 4 as is_starting,
  case when fixture_id % 2 = 0 then '4-3-3' else '4-4-2' end as formation from {player_v}"""
CHECKPOINT = """
select concat('run-', cast(user_id % 4 as string)) as run_id, cast(ts as date) as target_date,
  case when event_type = 'signup' and event_id % 3 = 0 then null else cast(event_id % 200 as int) end as fixture_id,
  case cast(event_id % 3 as int) when 0 then 'fixtures' when 1 then 'fixtures/players' else 'fixtures/lineups' end as endpoint,
  case event_type when 'signup' then 'PENDING' when 'click' then 'SKIPPED' when 'error' then 'FAILED'
       else 'COMPLETED' end as status,
  1 as attempt_count, case when event_type = 'error' then props end as last_error,
  ts as started_at_utc,
  case when event_type in ('click', 'purchase', 'view') then ts end as completed_at_utc, event_id
from {events}"""
OBSERVATION = "select user_id, event_type, ts, value from {events}"

_NEEDS = {"match_v": (MATCH, ["orders"], []), "player_v": (PLAYER, ["lineitem", "part"], ["match_v"]), "lineup_v": (LINEUP, [], ["player_v"]), "ckpt_v": (CHECKPOINT, ["events"], []), "obs_v": (OBSERVATION, ["events"], [])}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of lineitem's files in one partition of the views on it: a few hundred thousand rows, however large the table.
_PARTITION_BYTES = 4 << 20


def line_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of the views on lineitem, as many as its files ask for."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/lineitem.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(math.ceil(size / _PARTITION_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))


def view(spark: SparkSession, sf_dir: str, name: str, key: str = "bigint") -> DataFrame:
    """One of match_v, player_v, lineup_v, ckpt_v, obs_v; ``key`` is the type of fixture_id.

    player_v and lineup_v come dealt by fixture_id over :func:`line_partitions`, so what goes on by fixture needs no
    shuffle, and a task's share stays the same as the tables grow. Parts are joined first: a line is dealt twice in all.
    """
    typed = lambda t, c: table(spark, sf_dir, t).withColumn(c, F.col(c).cast(key))
    if name == "match_v":
        return spark.sql(MATCH, orders=typed("orders", "o_orderkey"))
    if name == "player_v":
        n = line_partitions(spark, sf_dir)
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_name").repartition(n, "p_partkey")
        named = typed("lineitem", "l_orderkey").join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey").repartition(n, "l_orderkey")
        return spark.sql(_DEALT_PLAYER, named_lines=named, match_v=view(spark, sf_dir, "match_v", key))
    sql, tables, views = _NEEDS[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables}, **{v: view(spark, sf_dir, v, key) for v in views})


def with_views(sql: str, *names: str) -> str:
    """SQL text that starts with the named views, and those they need, as common table expressions."""
    found: list[str] = []

    def add(name: str) -> None:
        for v in _NEEDS[name][2]:
            add(v)
        if name not in found:
            found.append(name)

    for n in names:
        add(n)
    if not found:
        return sql
    plain = {k: k for k in ("orders", "lineitem", "part", "events", *_NEEDS)}
    parts = [f"{n} as ({_NEEDS[n][0].format(**plain)})" for n in found]
    text = sql.strip()
    if text.lower().startswith("with "):
        return f"with {', '.join(parts)}, {text[5:]}"
    return f"with {', '.join(parts)} {text}"


def team_name(col) -> F.Column:
    return F.concat(F.lit("Team "), col.cast("string"))


def match_payloads(matches: DataFrame) -> DataFrame:
    """One payload of a fixtures response for each match: fixture_id, target_date, raw_payload."""
    col = F.col
    item = F.struct(
        F.struct(col("fixture_id").alias("id"), F.date_format("fixture_date", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("date"), F.struct(col("status_short").alias("short"), F.lit(None).cast("string").alias("long")).alias("status")).alias("fixture"),
        F.struct(col("league_id").alias("id"), col("league_name").alias("name"), col("league_season").alias("season"), "country").alias("league"),
        F.struct(F.struct(col("home_team_id").alias("id"), team_name(col("home_team_id")).alias("name")).alias("home"), F.struct(col("away_team_id").alias("id"), team_name(col("away_team_id")).alias("name")).alias("away")).alias("teams"),
    )
    return matches.select("fixture_id", F.to_date("fixture_date").alias("target_date"), F.to_json(F.struct(F.array(item).alias("response"))).alias("raw_payload"))


def player_payloads(players: DataFrame) -> DataFrame:
    """One payload of a players response for each match; a match has a handful of rows."""
    col = F.col
    stat = F.struct(F.struct(col("games_minutes").alias("minutes"), col("games_position").alias("position")).alias("games"), F.struct(col("shots_total").alias("total"), col("shots_on").alias("on")).alias("shots"), F.struct(col("goals_total").alias("total")).alias("goals"))
    player = F.struct(F.struct(col("player_id").alias("id"), col("player_name").alias("name")).alias("player"), F.array(stat).alias("statistics"))
    teams = players.groupBy("fixture_id", "team_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", player.alias("p")))), lambda x: x["p"]).alias("players"))
    team = F.struct(F.struct(col("team_id").alias("id"), team_name(col("team_id")).alias("name")).alias("team"), "players")
    whole = teams.groupBy("fixture_id").agg(F.array_sort(F.collect_list(team)).alias("response"))
    return whole.select("fixture_id", F.to_json(F.struct("response")).alias("raw_payload"))


def lineup_payloads(lineups: DataFrame) -> DataFrame:
    """One payload of a line-ups response for each match: starters and substitutes in arrays of their own."""
    col = F.col
    player = F.struct(F.struct(col("player_id").alias("id"), col("player_name").alias("name"), "number", col("position").alias("pos")).alias("player"))
    one = lambda start: F.array_sort(F.collect_list(F.when(col("is_starting") == F.lit(start), player)))
    teams = lineups.groupBy("fixture_id", "team_id", "formation").agg(one(True).alias("startXI"), one(False).alias("substitutes"))
    team = F.struct(F.struct(col("team_id").alias("id"), team_name(col("team_id")).alias("name")).alias("team"), "formation", "startXI", "substitutes")
    whole = teams.groupBy("fixture_id").agg(F.array_sort(F.collect_list(team)).alias("response"))
    return whole.select("fixture_id", F.to_json(F.struct("response")).alias("raw_payload"))
