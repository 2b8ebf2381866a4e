"""Registered queries over the driver's tables, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import scalar as S
from lakeloom.functions.names import normalize_name
from lakeloom.operators.increments import IncrementTable
from lakeloom.operators import elo, features, keyed, quality, rules, shape, state
from lakeloom.plans import gold, silver
from lakeloom.sources import io
from lakeloom.sources.driver_tables import line_partitions, lineup_payloads, match_payloads, player_payloads, table, team_name, view, with_views
from lakeloom.streaming import ingest

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
NOW, AS_OF = "2024-02-01 00:00:00", "2024-02-01"


def query(sql: str | None = None, *views: str):
    """Register a query under its function's name, with its SQL over the named views."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_views(sql, *views)
        return f

    return add


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and the executors share; only a local session may do without one that is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        base = tempfile.gettempdir()
    return f"{base}/lakeloom/{name}-{uuid.uuid4().hex}"


def six(df: DataFrame) -> DataFrame:
    """Doubles rounded to six places."""
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


def stamp(col: str) -> F.Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def _bronze_players(spark, d):
    return io.land_envelopes(player_payloads(view(spark, d, "player_v", "int")), run_id="run", endpoint="fixtures/players").drop("ingested_at_utc")


_SILVER_PLAYERS = """silver as (select * from (select cast(fixture_id as int) as fixture_id, team_id, concat('Team ', cast(team_id as
 varchar)) as team_name, player_id, player_name, games_minutes,
 games_position, coalesce(shots_total, 0) as shots_total, shots_on, goals_total, row_number() over (partition by fixture_id, team_id,
 player_id order by line_no desc, player_name desc, games_minutes desc nulls last, games_position desc, shots_total desc nulls last,
 shots_on desc, goals_total desc) as rn from player_v) where rn = 1)"""
_POSITION = """case when upper(games_position) in ('F','A','ATTACKER','FORWARD','STRIKER') then 'F' when upper(games_position) in
 ('D','DEFENDER','DEFENCE') then 'D' when upper(games_position) in ('G','GK','GOALKEEPER') then 'G' else 'M' end"""


def _silver_players(spark, d):
    return silver.silver_player_stats(_bronze_players(spark, d))


# --- landing to typed tables ---


@query("""select cast(fixture_id as int) as fixture_id, cast(fixture_date as date) as fixture_date, league_id, league_name, league_season,
 home_team_id, concat('Team ', cast(home_team_id as varchar)) as home_team_name,
 away_team_id, concat('Team ', cast(away_team_id as varchar)) as away_team_name, status_short, country from match_v""", "match_v")
def silver_fixtures(spark, d):
    bronze = io.land_envelopes(match_payloads(view(spark, d, "match_v")), run_id="run", endpoint="fixtures").drop("ingested_at_utc")
    s = silver.silver_fixtures(bronze)
    return s.select("fixture_id", F.to_date("fixture_date_utc").alias("fixture_date"), "league_id", "league_name", "league_season", "home_team_id", "home_team_name", "away_team_id", "away_team_name", "status_short", "country")


@query(f"""with {_SILVER_PLAYERS} select fixture_id, team_id, team_name, player_id, player_name, games_minutes, games_position, shots_total,
 shots_on, goals_total, trim(regexp_replace(lower(player_name), '[^a-z0-9]+', ' ', 'g')) as player_name_normalized from silver""", "player_v")
def silver_player_stats(spark, d):
    return _silver_players(spark, d).drop("response_hash", "team_name_normalized")


@query("""select cast(fixture_id as int) as fixture_id, team_id, player_id, player_name, position, number, is_starting, formation from
 (select *, row_number() over (partition by fixture_id, team_id, player_id order by is_starting desc, line_no, player_name, position) as rn
 from lineup_v) where rn = 1""", "lineup_v")
def silver_lineups(spark, d):
    payloads = lineup_payloads(view(spark, d, "lineup_v", "int"))
    return silver.silver_lineups(io.land_envelopes(payloads, run_id="run", endpoint="fixtures/lineups").drop("ingested_at_utc")).drop("response_hash", "team_name")


@query("""select count(*) as n_rows, count(distinct fixture_id) as n_keys, true as hashes_are_hex from (select distinct fixture_id from
 player_v)""", "player_v")
def bronze_hash_count(spark, d):
    return _bronze_players(spark, d).agg(F.count("*").alias("n_rows"), F.count_distinct("fixture_id").alias("n_keys"), F.bool_and(F.col("response_hash").rlike("^[0-9a-f]{64}$")).alias("hashes_are_hex"))


@query("""select cast(fixture_id as int) as fixture_id, 'fixtures/players' as source_endpoint, cast(count(*) as bigint) as n_players from
 player_v group by fixture_id""", "player_v")
def minimal_envelope(spark, d):
    bronze = io.land_envelopes(player_payloads(view(spark, d, "player_v")), run_id="run", endpoint="fixtures/players", columns="minimal")
    n = F.aggregate("payload.response", F.lit(0).cast("bigint"), lambda a, t: a + F.size(t["players"]))
    return shape.parse_payload(bronze, shape.PLAYER_PAYLOAD).select("fixture_id", "source_endpoint", n.alias("n_players"))


@query("""select * from (select l_orderkey, l_suppkey, l_linenumber, l_partkey, row_number() over (partition by l_orderkey order by
 l_shipdate desc, l_linenumber desc, l_partkey, l_suppkey) as rn from lineitem) where rn = 1""".replace("select *", "select l_orderkey, l_suppkey, l_linenumber, l_partkey"))
def latest_by_key(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_shipdate")
    return keyed.latest_by_key(rows, ["l_orderkey"], [F.desc("l_shipdate"), F.desc("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]).drop("l_shipdate")


@query("""select fixture_id, league_id, home_team_id as team_id, away_team_id as opponent_team_id, true as is_home, 1.0::double as
 game_importance_scalar, 1500.0::double as defensive_elo from match_v
 union all select fixture_id, league_id, away_team_id, home_team_id, false, 1.0, 1500.0 from match_v""", "match_v")
def team_match_context(spark, d):
    return gold.team_match_context(view(spark, d, "match_v")).select("fixture_id", "league_id", "team_id", "opponent_team_id", "is_home", "game_importance_scalar", "defensive_elo")


@query("""select p.fixture_id, p.line_no, p.team_id, p.player_id, case when p.team_id = m.home_team_id then m.away_team_id when p.team_id
 = m.away_team_id then m.home_team_id end as opponent_team_id, m.league_id,
 round(case when games_minutes > 0 then shots_total * 90.0::double / games_minutes else 0.0 end, 6) as shots_per_90, round(case when
 games_minutes > 0 then shots_on * 90.0::double / games_minutes else 0.0 end, 6) as shots_on_per_90
 from player_v p left join match_v m on p.fixture_id = m.fixture_id""", "player_v")
def player_shot_features(spark, d):
    out = gold.player_shot_features(view(spark, d, "player_v"), view(spark, d, "match_v"))
    return six(out.select("fixture_id", "line_no", "team_id", "player_id", "opponent_team_id", "league_id", "shots_per_90", "shots_on_per_90"))


_SAPM = f"""select fixture_id, line_no, team_id, player_id, position_group, round(prior_alpha, 6) as prior_alpha,
 round(case when 270.0 + games_minutes > 0 then (prior_alpha + shots_total)::double / (270.0::double + games_minutes) else 0.0 end, 6) as
 shot_rate_smoothed_per_minute,
 cast(shots_total as double) as weighted_shots, cast(games_minutes as double) as weighted_minutes
 from (select *, cast(case position_group when 'F' then 7.8 when 'M' then 3.6 when 'D' then 1.5 else 0.0 end as double) as prior_alpha from
 (select *, {_POSITION} as position_group from player_v))"""
_SAPM_COLUMNS = ["fixture_id", "line_no", "team_id", "player_id", "position_group", "prior_alpha", "shot_rate_smoothed_per_minute", "weighted_shots", "weighted_minutes"]


@query(_SAPM, "player_v")
def player_sapm(spark, d):
    return six(gold.player_sapm(view(spark, d, "player_v"), gold.team_match_context(view(spark, d, "match_v"))).select(*_SAPM_COLUMNS))


@query(_SAPM, "player_v")
def sapm_fixture_context(spark, d):
    one = gold.team_match_context(view(spark, d, "match_v")).where("is_home").drop("team_id")
    return six(gold.player_sapm(view(spark, d, "player_v"), one).select(*_SAPM_COLUMNS))


_PRIORS = f"""priors as (select b.position_group, 270.0::double * case when s.minutes > 0 then coalesce(s.shots, 0)::double / s.minutes
 else b.rate end as prior_alpha
 from (values ('F', 2.6::double / 90), ('M', 1.2::double / 90), ('D', 0.5::double / 90), ('G', 0.0::double)) b(position_group, rate)
 left join (select {_POSITION} as position_group, sum(shots_total) as shots, sum(games_minutes) as minutes from player_v group by 1) s on
 s.position_group = b.position_group)"""


@query(f"with {_PRIORS} select position_group, round(prior_alpha, 6) as prior_alpha, 270.0::double as prior_beta from priors", "player_v")
def estimate_priors(spark, d):
    return six(features.estimate_priors(view(spark, d, "player_v")))


@query(f"""with {_PRIORS} select p.fixture_id, p.line_no, p.position_group, round(case when 270.0 + games_minutes > 0 then (prior_alpha +
 shots_total) / (270.0::double + games_minutes) else 0.0 end, 6) as shot_rate_smoothed_per_minute
 from (select *, {_POSITION} as position_group from player_v) p left join priors r on p.position_group = r.position_group""", "player_v")
def sapm_with_priors(spark, d):
    players = view(spark, d, "player_v")
    return six(gold.player_sapm(players, priors=features.estimate_priors(players)).select("fixture_id", "line_no", "position_group", "shot_rate_smoothed_per_minute"))


@query("""select cast(row_number() over (order by s_acctbal desc, s_suppkey) as int) as rank, s_name as team_name, s_acctbal as rating,
 date '2022-12-22' as ranking_as_of_date,
 trim(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g')) as team_name_normalized from supplier""")
def rating_baseline(spark, d):
    ranked = keyed.numbered(table(spark, d, "supplier"), "s_acctbal", [F.col("s_suppkey")], "Rank")
    path = scratch(spark, "seed")
    ranked.select("Rank", F.col("s_name").alias("Team"), F.col("s_acctbal").alias("Raiting")).write.csv(path, header=True)
    seed = io.load_seed(spark, path, "Rank int, Team string, Raiting double", {"Rank": "rank", "Team": "team_name", "Raiting": "rating"}, date(2022, 12, 22))
    return gold.rating_baseline(seed)


@query(f"""with {_SILVER_PLAYERS} select s.fixture_id, s.team_id, s.player_id, case when s.team_id = m.home_team_id then m.away_team_id when
 s.team_id = m.away_team_id then m.home_team_id end as opponent_team_id, round(case when games_minutes > 0 then shots_total * 90.0::double /
 games_minutes else 0.0 end, 6) as shots_per_90, cast(shots_total as double) as weighted_shots from silver s left join match_v m on
 m.fixture_id = s.fixture_id""", "player_v")
def gold_chain(spark, d):
    """Typed fixtures are stored and read back, dealt by fixture as the player rows are: payloads are parsed and ranked once."""
    parts, folder = line_partitions(spark, d), scratch(spark, "fixtures")
    typed = silver.silver_fixtures(io.land_envelopes(match_payloads(view(spark, d, "match_v")), run_id="run", endpoint="fixtures").drop("ingested_at_utc"), parts=parts).drop("response_hash")
    typed.write.option("compression", "zstd").parquet(folder)
    fixtures = spark.read.schema(typed.schema).parquet(folder).repartition(parts, "fixture_id")
    stats = gold.player_shot_features(_silver_players(spark, d), fixtures)
    return six(gold.player_sapm(stats, gold.team_match_context(fixtures)).select("fixture_id", "team_id", "player_id", "opponent_team_id", "shots_per_90", "weighted_shots"))


# --- names ---

# Fixed values of the SQL: accented letters by the plain letter they stand for.
_LETTERS = {
    "a": "àáâãäåāăą", "c": "çćč", "d": "ðďđ", "e": "èéêëēĕėęě", "i": "ìíîïīįı", "l": "ł", "n": "ñńň", "o": "òóôõöøōő",
    "r": "ř", "s": "śşšș", "u": "ùúûüūůű", "y": "ýÿ", "z": "žźż", "g": "ğ", "t": "țť",
}
_FROM = "".join(_LETTERS.values())
_TRANSLATE = f"translate(lower(trim({{0}})), '{_FROM}', '{''.join(plain * len(accented) for plain, accented in _LETTERS.items())}')"
_ACCENTED_ROWS = [(1, "Curaçao"), (2, "Ørsted Ångström"), (3, "  Łukasz   Ğ. Müller-Öz "), (4, "Straße"), (5, "Côte d'Ivoire"), (6, "cote d'lvoire"), (7, "Æther"), (8, "Nuñez, José")]


def _key_sql(col: str) -> str:
    return f"trim(regexp_replace(replace(replace(replace({_TRANSLATE.format(col)}, 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), '[^a-z0-9]+', ' ', 'g'))"


_NAME_VALUES = "(values " + ", ".join(f"({i}, '{t.replace(chr(39), chr(39) * 2)}')" for i, t in _ACCENTED_ROWS) + ") v(id, name)"


def _names(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("name"))
    parts = table(spark, d, "part").select((F.col("p_partkey") + 10000000).alias("id"), F.col("p_name").alias("name"))
    return docs.unionByName(parts).unionByName(spark.createDataFrame([(i + 20000000, t) for i, t in _ACCENTED_ROWS], "id bigint, name string"))


_NAMES_SQL = f"""names as (select doc_id as id, text as name from documents union all select p_partkey + 10000000, p_name from part
 union all select id + 20000000, name from {_NAME_VALUES})"""


@query(f"with {_NAMES_SQL} select id, {_key_sql('name')} as name_key from names")
def normalize_names(spark, d):
    return _names(spark, d).select("id", normalize_name(F.col("name")).alias("name_key"))


@query(f"with {_NAMES_SQL} select id, trim(regexp_replace(lower(trim(name)), '[^a-z0-9]+', ' ', 'g')) as label from names")
def label_keys(spark, d):
    return _names(spark, d).select("id", normalize_name(F.col("name"), "label").alias("label"))


@query(f"with {_NAMES_SQL} select id, replace({_key_sql('name')}, ' ', '_') as slug from names")
def slugs(spark, d):
    return _names(spark, d).select("id", normalize_name(F.col("name"), "slug").alias("slug"))


_SHOWN = ["Curacao", "Orsted Angstrom", "  Lukasz   G. Muller-Oz ", "Strasse", "Cote d'Ivoire", "cote d'lvoire", "AEther", "Nunez, Jose"]


@query(f"""select p_partkey as id, p_name as display from part
 union all select * from (values {", ".join(f"({i + 20000001}, '{t.replace(chr(39), chr(39) * 2)}')" for i, t in enumerate(_SHOWN))}) v(id,
 display)""")
def display_text(spark, d):
    accented = F.translate("p_name", "aeiouAEIOUcn", "áèîõüÀÉÏÖÛçñ")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), accented.alias("name"))
    named = spark.createDataFrame([(i + 20000000, t) for i, t in _ACCENTED_ROWS], "id bigint, name string")
    return parts.unionByName(named).select("id", normalize_name(F.col("name"), "display").alias("display"))


@query("select s.s_suppkey, n.n_nationkey, n.n_name from supplier s join nation n on n.n_nationkey = s.s_nationkey")
def name_join(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    spelled = F.concat(F.lit("  "), F.translate(F.initcap("n_name"), "aeiou", "áèîõü"), F.lit(" "))
    teams = table(spark, d, "supplier").join(nation.withColumnRenamed("n_nationkey", "s_nationkey").select("s_nationkey", spelled.alias("spelled")), "s_nationkey").select("s_suppkey", "spelled")
    return keyed.join_on_name(teams, nation, "spelled", "n_name").select("s_suppkey", "n_nationkey", "n_name")


# --- rules ---

_LABEL = "trim(regexp_replace(lower(league_name), '[^a-z0-9]+', ' ', 'g')) || ' ' || trim(regexp_replace(lower(country), '[^a-z0-9]+', ' ', 'g'))"
# Fixed values of the SQL: words that rule a competition out, and competitions that are kept.
_WORDS = "women woman u17 u18 u19 u20 u21 u22 u23 youth olympic club clubs"
_EXCLUDED = " or ".join(f"contains({_LABEL}, '{w}')" for w in _WORDS.split())
_ALLOWED = "1, 4, 5, 6, 7, 9, 10, 21, 22, 29, 30, 31, 32, 33, 34, 35, 36, 37, 536, 806, 808, 858, 913, 960"
_REASON = f"""case when {_EXCLUDED} then 'excluded word' when league_id not in ({_ALLOWED}) then 'league not allowed' when status_short not
 in ('FT', 'AET', 'PEN') then 'not completed' end"""


def _eligible(spark, d, **more):
    return rules.eligibility(view(spark, d, "match_v"), "league_id", "league_name", "country", "status_short", **more)


@query(f"""select cast(fixture_id as int) as fixture_id, cast(fixture_date as date) as target_date, case when ({_REASON}) is null then
 'KEPT' else 'SKIPPED' end as eligibility_status, league_id, league_name, league_season from match_v""", "match_v")
def eligibility_split(spark, d):
    return io.land_eligibility(_eligible(spark, d), "run").drop("run_id", "raw_fixture", "response_hash")


@query(f"select fixture_id, {_REASON} as reject_reason from match_v where ({_REASON}) is not null", "match_v")
def eligibility_rejects(spark, d):
    _, bad = io.land_split(_eligible(spark, d), F.col("is_eligible"), scratch(spark, "eligible"))
    return bad.select("fixture_id", "reject_reason")


@query("""select event_id, case when event_id % 50 = 7 then 'rejected' else 'valid' end as side, case when event_id % 50 != 7 then
 props::json ->> '$.k' end as k from events""")
def split_landing(spark, d):
    """Payloads parsed once, good and broken ones landed side by side, both read back."""
    broken = F.when(F.col("event_id") % 50 == 7, F.concat(F.lit("{\"cut\": "), F.substring("props", 1, 5))).otherwise(F.coalesce("props", F.lit("{}")))
    rows = table(spark, d, "events").select("event_id", F.try_parse_json(broken).alias("doc"))
    good, bad = io.land_split(rows.select("event_id", F.try_variant_get("doc", "$.k", "string").alias("k"), F.col("doc").isNotNull().alias("parsed")), F.col("parsed"), scratch(spark, "split"))
    return good.select("event_id", F.lit("valid").alias("side"), "k").unionByName(bad.select("event_id", F.lit("rejected").alias("side"), "k"))


@query("""select fixture_id, league_id = 1 and league_season = 1995 and status_short in ('FT', 'AET', 'PEN') as is_eligible,
 case when league_id != 1 or league_season != 1995 then 'league not allowed' when status_short not in ('FT', 'AET', 'PEN') then
 'not completed' end as reject_reason from match_v""", "match_v")
def eligibility_season(spark, d):
    return _eligible(spark, d, allow=[1], words=[], season=("league_season", 1995)).select("fixture_id", "is_eligible", "reject_reason")


@query("""select fixture_id, ((home_team_id < 4 and away_team_id < 4) or league_name ilike '%friendl%' or league_name ilike '%world cup%'
 or league_name ilike '%africa cup%' or league_name ilike '%qualification%')
 and fixture_id % 3 != 0 as is_international,
 cast(case when league_name ilike '%friendl%' then 0 when league_name ilike '%cup%' then 1 else 0 end as int) as is_high_stakes from match_v""", "match_v")
def keyword_eligibility(spark, d):
    name, k = F.col("league_name"), F.col("fixture_id") % 3
    kind = F.when(k == 0, "League").when(k == 1, "Cup")
    national = [F.col(f"{side}_team_id") < 4 for side in ("home", "away")]
    return view(spark, d, "match_v").select("fixture_id", rules.keyword_eligibility(name, *national, kind=kind).alias("is_international"), S.high_stakes(name).alias("is_high_stakes"))


@query("select event_id, 'payload is not JSON' as reason, 'silver' as stage from events where event_id % 50 = 7")
def quarantine_rows(spark, d):
    broken = F.when(F.col("event_id") % 50 == 7, F.concat(F.lit("{\"cut\": "), F.substring("props", 1, 5))).otherwise(F.coalesce("props", F.lit("{}")))
    rows = table(spark, d, "events").select("event_id", broken.alias("raw_payload"))
    _, bad = io.land_split(rows, ~shape.malformed(), scratch(spark, "parsed"))
    return io.quarantine(bad.withColumn("fixture_id", F.col("event_id")), F.lit("payload is not JSON"), "silver").select(F.col("fixture_id").alias("event_id"), "reason", "stage")


@query("select fixture_id, status_short from match_v where status_short in ('FT', 'AET', 'PEN')", "match_v")
def completed_only(spark, d):
    return rules.completed_only(view(spark, d, "match_v")).select("fixture_id", "status_short")


@query("select fixture_id, line_no, games_minutes from player_v where games_minutes > 0", "player_v")
def played_only(spark, d):
    return rules.played_only(view(spark, d, "player_v")).select("fixture_id", "line_no", "games_minutes")


@query("select event_id from events where epoch(ts) - epoch(timestamp '2024-01-15 12:00:00') <= 60.5 * 60")
def due_within(spark, d):
    return rules.due_within(table(spark, d, "events"), "ts", F.to_timestamp(F.lit("2024-01-15 12:00:00"))).select("event_id")


@query("select event_id from events where cast(ts as date) = date '2024-01-10'")
def on_date(spark, d):
    text = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))
    return rules.on_date(text, "at", F.lit(date(2024, 1, 10))).select("event_id")


@query(f"select fixture_id, line_no, {_POSITION} as position_group from player_v", "player_v")
def position_group(spark, d):
    return view(spark, d, "player_v").select("fixture_id", "line_no", S.position_group(F.col("games_position")).alias("position_group"))


@query("""select fixture_id, round(case when league_name ilike '%world cup%' then 1.0 when league_name ilike '%qualifier%' then 0.7 when
 league_name ilike '%friendly%' then 0.2 else 1.0 end::double, 6) as stake from match_v""", "match_v")
def stake_weights(spark, d):
    return view(spark, d, "match_v").select("fixture_id", S.stake_weight(F.col("league_name")).alias("stake"))


@query("""select p.fixture_id, p.line_no, case when p.team_id = m.home_team_id then m.away_team_id else m.home_team_id end as
 opponent_team_id from player_v p join match_v m on m.fixture_id = p.fixture_id""", "player_v")
def opponent_two_way(spark, d):
    m = view(spark, d, "match_v").select("fixture_id", "home_team_id", "away_team_id")
    rows = view(spark, d, "player_v").join(m, "fixture_id")
    return rows.select("fixture_id", "line_no", S.opponent_of(F.col("team_id"), F.col("home_team_id"), F.col("away_team_id"), strict=False).alias("opponent_team_id"))


# --- spines and work plans ---


_SPAN = "(select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders)"


def _span(spark, d):
    """First and last day of the orders."""
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").agg(F.min(day), F.max(day)).first()


@query(f"""select day, (select count(*) from orders where cast(o_orderdate as date) = day) as n_orders
 from (select cast(unnest(generate_series(lo::timestamp, hi::timestamp, interval 1 day)) as date) as day from {_SPAN})""")
def date_spine(spark, d):
    days = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return shape.daily_dates(spark, *_span(spark, d)).join(days, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(f"""select window_start, window_end, (select count(*) from orders where cast(o_orderdate as date) between window_start and
 window_end) as n_orders
 from (select cast(d as date) as window_start, least(cast(d as date) + 6, hi) as window_end from (select hi,
 unnest(generate_series(lo::timestamp, hi::timestamp, interval 7 day)) as d from {_SPAN}))""")
def window_spine(spark, d):
    first, last = _span(spark, d)
    # Orders find their window by arithmetic, so that the join is on equal keys.
    start = F.date_add(F.lit(first), (F.floor(F.datediff(F.to_date("o_orderdate"), F.lit(first)) / 7) * 7).cast("int"))
    counts = table(spark, d, "orders").groupBy(start.alias("window_start")).agg(F.count("*").alias("n"))
    return shape.date_windows(spark, first, last).join(counts, "window_start", "left").select("window_start", "window_end", F.coalesce("n", F.lit(0)).alias("n_orders"))


_REQUESTED = "(select distinct o_custkey as k from orders)"


def _work(spark, d, force):
    requested = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    return keyed.plan_work(requested, done, "k", force)


@query(f"select k, case when k in (select o_custkey from orders where o_orderstatus = 'F') then 'SKIP' else 'FETCH' end as action from {_REQUESTED}")
def plan_work(spark, d):
    return _work(spark, d, False)


@query(f"select k, 'FETCH' as action from {_REQUESTED}")
def plan_work_forced(spark, d):
    return _work(spark, d, True)


# --- state ---


def _versions(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    old = orders.where("o_orderstatus in ('F', 'P')")
    new = orders.where("o_orderstatus in ('O', 'P')").withColumn("price", F.col("price") + 1).withColumn("o_orderkey", F.nullif("o_orderkey", F.lit(2)))
    return old.withColumn("o_orderkey", F.nullif("o_orderkey", F.lit(1))), new


_OLD = "select nullif(o_orderkey, 1) as o_orderkey, o_orderstatus, o_totalprice as price from orders where o_orderstatus in ('F', 'P')"
_NEW = "select nullif(o_orderkey, 2) as o_orderkey, o_orderstatus, o_totalprice + 1 as price from orders where o_orderstatus in ('O', 'P')"


@query(f"""with o as ({_OLD}), n as ({_NEW}) select o_orderkey, o_orderstatus, round(price, 6) as price from n union all select o_orderkey,
 o_orderstatus, round(price, 6) from o where not exists (select 1 from n where n.o_orderkey is not distinct from o.o_orderkey)""")
def merge_upsert(spark, d):
    return six(state.merge_upsert(*_versions(spark, d), ["o_orderkey"]))


@query(f"""with o as ({_OLD}), n as ({_NEW}) select o_orderkey, o_orderstatus, round(price, 6) as price from o union all select o_orderkey,
 o_orderstatus, round(price, 6) from n where not exists (select 1 from o where n.o_orderkey is not distinct from o.o_orderkey)""")
def insert_if_absent(spark, d):
    return six(state.insert_if_absent(*_versions(spark, d), ["o_orderkey"]))


_CKPT_KEYS = ["run_id", "target_date", "fixture_id", "endpoint"]


@query("""with r as (select *, row_number() over (partition by run_id, target_date, fixture_id, endpoint, event_id >= 5000 order by
 event_id desc) as rn from ckpt_v), o as (select * from r where rn = 1 and event_id < 5000), n as (select * from r where rn = 1 and event_id
 >= 5000),
 j as (select coalesce(n.run_id, o.run_id) as run_id, coalesce(n.target_date, o.target_date) as target_date, coalesce(n.fixture_id,
 o.fixture_id) as fixture_id, coalesce(n.endpoint, o.endpoint) as endpoint,
  case when n.run_id is null or (o.status = 'COMPLETED' and n.status != 'COMPLETED') then o.status else n.status end as status,
  case when n.run_id is null or (o.status = 'COMPLETED' and n.status != 'COMPLETED') then o.last_error else n.last_error end as last_error,
  case when n.run_id is null or (o.status = 'COMPLETED' and n.status != 'COMPLETED') then o.completed_at_utc else n.completed_at_utc end as
 completed_at,
  coalesce(o.attempt_count, 0) + coalesce(n.attempt_count, 0) as attempt_count, least(o.started_at_utc, n.started_at_utc) as started_at
  from o full join n on o.run_id = n.run_id and o.target_date = n.target_date and o.fixture_id is not distinct from n.fixture_id and
 o.endpoint = n.endpoint)
 select run_id, target_date, fixture_id, endpoint, status, cast(attempt_count as bigint) as attempt_count, last_error, strftime(started_at,
 '%Y-%m-%d %H:%M:%S') as started_at_utc,
 strftime(case when status in ('COMPLETED', 'SKIPPED') then completed_at end, '%Y-%m-%d %H:%M:%S') as completed_at_utc from j""", "ckpt_v")
def checkpoint_merge(spark, d):
    rows = view(spark, d, "ckpt_v")
    part = lambda cond: keyed.latest_by_key(rows.where(cond), _CKPT_KEYS, [F.desc("event_id")])
    out = state.checkpoint_upsert(part("event_id < 5000"), part("event_id >= 5000"))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started_at_utc", "completed_at_utc")})


def checkpoint_table(spark, d):
    """The same from a stored checkpoint: the earlier rows in two batches, compacted, then the later ones."""
    rows, stored = view(spark, d, "ckpt_v"), state.checkpoint_table(spark, scratch(spark, "checkpoint"))
    part = lambda cond: keyed.latest_by_key(rows.where(cond), _CKPT_KEYS, [F.desc("event_id")])
    even = F.xxhash64(*_CKPT_KEYS) % 2 == 0
    for batch in (part("event_id < 5000").where(even), part("event_id < 5000").where(~even)):
        state.record_attempts(stored, batch)
        stored.compact()
    out = state.record_attempts(stored, part("event_id >= 5000"))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started_at_utc", "completed_at_utc")})


QUERIES["checkpoint_table"], ORACLES["checkpoint_table"] = checkpoint_table, ORACLES["checkpoint_merge"]


_WINDOWS = """(select distinct date_trunc('week', target_date)::date as window_start, date_trunc('week', target_date)::date + 6 as
 window_end from ckpt_v)"""


def _weeks(spark, d):
    start = F.to_date(F.date_trunc("week", "target_date"))
    return view(spark, d, "ckpt_v").select(start.alias("window_start"), F.date_add(start, 6).alias("window_end"), "endpoint", "status").distinct()


@query(f"""select window_start, window_end from {_WINDOWS} w where not exists (select 1 from ckpt_v c where date_trunc('week',
 c.target_date)::date = w.window_start and c.status = 'COMPLETED' and c.endpoint = 'fixtures' and day(w.window_start) % 2 = 0)""", "ckpt_v")
def pending_windows(spark, d):
    weeks = _weeks(spark, d)
    done = weeks.where("status = 'COMPLETED' and endpoint = 'fixtures' and day(window_start) % 2 = 0")
    return state.pending_windows(weeks.select("window_start", "window_end").distinct(), done)


@query(f"""select window_start, window_end, case when day(window_start) % 2 = 0 then 'COMPLETED' else 'PENDING' end as status, case when
 day(window_start) % 2 = 0 then 5 else 0 end::bigint as records from {_WINDOWS}""", "ckpt_v")
def seed_windows(spark, d):
    weeks = _weeks(spark, d).select("window_start", "window_end").distinct()
    known = weeks.where("day(window_start) % 2 = 0").withColumn("status", F.lit("COMPLETED")).withColumn("records", F.lit(5).cast("bigint"))
    return state.seed_windows(known, weeks)


_UPDATES = f"""updates as (select window_start, window_end, case when day(window_start) % 3 = 0 then 'PENDING' else 'COMPLETED' end as
 status, n as records, timestamp '2024-03-01' + to_days(cast(day(window_start) % 2 as int)) as updated_at
 from (select window_start, window_end, count(*) as n from {_WINDOWS} w join ckpt_v c on date_trunc('week', c.target_date)::date =
 w.window_start group by 1, 2)),
 known as (select window_start, window_end, 'COMPLETED' as status, 5::bigint as records, timestamp '2024-03-01 12:00:00' as updated_at from
 {_WINDOWS} where day(window_start) % 2 = 0 or day(window_start) % 3 = 0)"""


@query(f"""with {_UPDATES} select window_start, window_end, status, records, strftime(updated_at, '%Y-%m-%d %H:%M:%S') as updated_at
 from (select *, row_number() over (partition by window_start, window_end order by updated_at desc) as rn from (select * from updates union
 all select * from known)) where rn = 1""", "ckpt_v")
def window_upsert(spark, d):
    """Half of the updates are older than what the checkpoint holds; some windows are new to it."""
    start = F.to_date(F.date_trunc("week", "target_date"))
    weeks = view(spark, d, "ckpt_v").groupBy(start.alias("window_start"), F.date_add(start, 6).alias("window_end")).agg(F.count("*").alias("records"))
    day = F.day("window_start")
    at = lambda text: F.to_timestamp_ntz(F.lit(text))
    updates = weeks.select("window_start", "window_end", F.when(day % 3 == 0, "PENDING").otherwise("COMPLETED").alias("status"), "records", F.when(day % 2 == 0, at("2024-03-01 00:00:00")).otherwise(at("2024-03-02 00:00:00")).alias("updated_at"))
    known = weeks.where((day % 2 == 0) | (day % 3 == 0)).select("window_start", "window_end", F.lit("COMPLETED").alias("status"), F.lit(5).cast("bigint").alias("records"), at("2024-03-01 12:00:00").alias("updated_at"))
    out = state.window_upsert(known, updates)
    return out.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@query("""with a as (select cast(target_date as date) as window_start, cast(target_date as date) as window_end, count(*) as records, case
 day(target_date) when 3 then 'timeout' when 20 then 'Too many requests' when 25 then 'quota' end as error from ckpt_v group by 1, 2, 4),
 s as (select min(window_start) as stop from a where error in ('Too many requests', 'quota'))
 select window_start, window_end, case when error is null and (stop is null or window_start < stop) then 'COMPLETED' else 'PENDING' end as
 status, case when stop is null or window_start <= stop then records else 0 end::bigint as records,
 not (error is null and (stop is null or window_start < stop)) as is_next from a, s""", "ckpt_v")
def backfill_quota_stop(spark, d):
    """A run over daily windows that meets a quota: what it settles, and which windows the next run takes up."""
    day = F.col("target_date")
    attempts = view(spark, d, "ckpt_v").groupBy(day.alias("window_start"), day.alias("window_end")).agg(F.count("*").alias("records"))
    error = F.when(F.day("window_start") == 3, "timeout").when(F.day("window_start") == 20, "Too many requests").when(F.day("window_start") == 25, "quota")
    settled = state.settle_windows(attempts.withColumn("error", error), F.current_timestamp())
    seeded = state.seed_windows(settled.select("window_start", "window_end", "status", "records").limit(0), attempts.select("window_start", "window_end"))
    after = state.window_upsert(seeded.withColumn("updated_at", F.to_timestamp(F.lit(AS_OF))), settled)
    ahead = state.pending_windows(attempts.select("window_start", "window_end"), after).withColumn("is_next", F.lit(True))
    return after.drop("updated_at").join(ahead, ["window_start", "window_end"], "left").withColumn("is_next", F.coalesce("is_next", F.lit(False)))


@query("""select distinct fixture_id from ckpt_v where endpoint = 'fixtures/players' and status = 'COMPLETED' and fixture_id is not null and
 target_date = date '2024-01-10'""", "ckpt_v")
def completed_keys(spark, d):
    return state.completed_keys(view(spark, d, "ckpt_v"), "fixtures/players", date(2024, 1, 10))


_COUNTS = ", ".join(f"count(*) filter (where status = '{s}') as {s.lower()}_count" for s in ("PENDING", "COMPLETED", "SKIPPED", "FAILED", "QUARANTINED"))
_SUMMARY = f"""select run_id, target_date, endpoint, count(*) as total_count, {_COUNTS}, strftime(min(started_at_utc), '%Y-%m-%d %H:%M:%S')
 as first_started, strftime(max(completed_at_utc), '%Y-%m-%d %H:%M:%S') as last_completed from ckpt_v group by run_id, target_date, endpoint"""


def _stamped(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_started", "last_completed")})


@query(_SUMMARY, "ckpt_v")
def run_summary(spark, d):
    return _stamped(state.run_summary(view(spark, d, "ckpt_v")))


def _ops_views(spark, d):
    source = f"lakeloom_{uuid.uuid4().hex}"
    view(spark, d, "ckpt_v").createOrReplaceTempView(source)
    return [spark.table(name) for name in state.create_ops_views(spark, source, f"{source}_", temporary=True)]


@query(_SUMMARY, "ckpt_v")
def ops_view_run_summary(spark, d):
    return _stamped(_ops_views(spark, d)[0])


@query("select event_id, run_id, status, last_error from ckpt_v where status in ('FAILED', 'QUARANTINED')", "ckpt_v")
def ops_view_failures(spark, d):
    return _ops_views(spark, d)[1].select("event_id", "run_id", "status", "last_error")


@query("select event_id, run_id, endpoint from ckpt_v where status = 'PENDING'", "ckpt_v")
def ops_view_pending(spark, d):
    return _ops_views(spark, d)[2].select("event_id", "run_id", "endpoint")


@query("select event_id, run_id, status, last_error from ckpt_v where status in ('FAILED', 'QUARANTINED')", "ckpt_v")
def failures(spark, d):
    return state.failures(view(spark, d, "ckpt_v")).select("event_id", "run_id", "status", "last_error")


@query(f"""select event_id, cast(date_sub('minute', started_at_utc, timestamp '{NOW}') as bigint) as pending_minutes from ckpt_v where
 status = 'PENDING'""", "ckpt_v")
def pending_age(spark, d):
    return state.pending_age(view(spark, d, "ckpt_v"), F.to_timestamp_ntz(F.lit(NOW))).select("event_id", "pending_minutes")


@query(f"""select (select count(*) from match_v) as discovered, (select count(*) from match_v where ({_REASON}) is null) as eligible,
 count(*) filter (where status = 'COMPLETED') as ingested, count(*) filter (where status = 'SKIPPED') as skipped,
 count(*) filter (where status = 'FAILED') as failed, count(*) filter (where status = 'QUARANTINED') as quarantined, count(*) filter (where
 status = 'PENDING') as pending, min(target_date) as first_date, max(target_date) as last_date from ckpt_v""", "match_v", "ckpt_v")
def batch_summary(spark, d):
    return state.batch_summary(_eligible(spark, d), view(spark, d, "ckpt_v"))


# --- features ---

_TOTALS = """select fixture_id, team_id, cast(sum(shots_total) as bigint) as team_shots, cast(sum(goals_total) as bigint) as team_goals,
 cast(sum(games_minutes) as bigint) as team_minutes, cast(sum(shots_on) as bigint) as team_shots_on from player_v group by 1, 2"""


@query(_TOTALS, "player_v")
def team_match_totals(spark, d):
    return features.team_match_totals(view(spark, d, "player_v"))


@query(f"""with t as ({_TOTALS}), g as (select fixture_id, team_id, sum(goals_total) as g from player_v group by 1, 2),
 m as (select v.fixture_id, home_team_id, a.g as hg, b.g as ag from match_v v left join g a on a.fixture_id = v.fixture_id and a.team_id =
 v.home_team_id left join g b on b.fixture_id = v.fixture_id and b.team_id = v.away_team_id),
 r as (select t.fixture_id, t.team_id, t.team_shots, cast(coalesce(case when t.team_id = m.home_team_id then hg else ag end, 0) -
 coalesce(case when t.team_id = m.home_team_id then ag else hg end, 0) as bigint) as goal_diff from t left join m on m.fixture_id =
 t.fixture_id)
 select *, cast(case when goal_diff > 0 then 3 when goal_diff = 0 then 1 else 0 end as double) as result_points from r""", "player_v")
def team_match_result(spark, d):
    players = view(spark, d, "player_v")
    out = features.team_match_result(features.team_match_totals(players), view(spark, d, "match_v"))
    return out.select("fixture_id", "team_id", "team_shots", "goal_diff", "result_points")


def _dated(spark, d):
    return view(spark, d, "player_v").join(view(spark, d, "match_v").select("fixture_id", "fixture_date"), "fixture_id")


_DECAY = "exp(-0.6931471805599453 / 365 * greatest(0, epoch(timestamp '1998-08-02') - epoch(fixture_date)) / 86400.0)"


@query(f"""with w as (select p.*, m.fixture_date, {_DECAY} as w from player_v p join match_v m on m.fixture_id = p.fixture_id where
 games_minutes > 0)
 select player_id, team_id, round(sum(shots_total * w), 6) as shots_decayed, round(sum(shots_on * w), 6) as shots_on_decayed,
 round(sum(goals_total * w), 6) as goals_decayed, round(sum(games_minutes * w), 6) as minutes_decayed,
 cast(max(fixture_date) as date) as latest_date, count(distinct fixture_id) as matches_observed, round(coalesce(sum(shots_total * w) /
 sum(games_minutes * w) * 90.0, null), 6) as shots_per_90_decayed from w group by 1, 2""", "player_v")
def decayed_features(spark, d):
    out = features.decayed_features(_dated(spark, d), F.to_timestamp(F.lit("1998-08-02")), 365.0, ["player_id", "team_id"])
    return six(out.withColumn("latest_date", F.to_date("latest_date")))


@query(f"""with w as (select p.*, {_DECAY} as w from player_v p join match_v m on m.fixture_id = p.fixture_id where games_minutes > 0)
 select player_id, team_id, round(coalesce(sum(shots_total * w), 0) / sum(games_minutes * w) * 90.0, 4) as rate from w group by 1, 2 order
 by rate desc, player_id, team_id limit 50""", "player_v")
def top_k_rates(spark, d):
    out = features.decayed_features(_dated(spark, d), F.to_timestamp(F.lit("1998-08-02")), 365.0, ["player_id", "team_id"])
    rate = F.round(F.coalesce("shots_per_90_decayed", F.lit(0.0)), 4)
    return keyed.top_k(out.select("player_id", "team_id", rate.alias("rate")), [F.desc("rate"), F.col("player_id"), F.col("team_id")], 50)


@query("""select o.fixture_id, case when m.league_name ilike '%friendl%' then 1.0 when m.league_name ilike '%cup%' then 1.25 else 1.0
 end::double as w_stake, round(least(greatest(1 + coalesce(gap, 0) / 1000.0, 0.85), 1.25), 6) as w_opp
 from (select fixture_id from match_v) o join match_v m on m.fixture_id = o.fixture_id left join (select fixture_id, avg(abs((1500 +
 home_team_id * 10) - (1500 + away_team_id * 10)))::double as gap from match_v where fixture_id % 3 != 0 group by 1) g on g.fixture_id =
 o.fixture_id""", "match_v")
def context_weights(spark, d):
    m = view(spark, d, "match_v")
    ratings = m.where("fixture_id % 3 != 0").select("fixture_id", (F.col("home_team_id") * 10 + 1500).alias("team_elo"), (F.col("away_team_id") * 10 + 1500).alias("opponent_elo"))
    return six(features.context_weights(m, ratings))


_RATES = f"""rates as (select player_id, team_id, min({_POSITION}) as position_group, coalesce(sum(games_minutes), 0)::double as minutes,
 coalesce(sum(shots_total), 0)::double as shots, coalesce(sum(shots_on), 0)::double as shots_on, coalesce(sum(goals_total), 0)::double as
 goals from player_v group by 1, 2)"""
# Fixed values of the SQL: shots per 90, share on target and conversion a position starts from, in the order F, D, G, M.
_STARTS = [(2.6, 0.5, 0.0, 1.2), (0.42, 0.25, 0.0, 0.35), (0.16, 0.05, 0.0, 0.10)]
_PRIOR = lambda k: "case position_group when 'F' then {} when 'D' then {} when 'G' then {} else {} end::double".format(*_STARTS[k])
_SHRUNK = f"""shrunk as (select *, w * p90 + (1 - w) * {_PRIOR(0)} as shots_per_90, least(greatest(w * ot + (1 - w) * {_PRIOR(1)}, 0.01),
 0.99) as on_target, least(greatest(w * cv + (1 - w) * {_PRIOR(2)}, 0.01), 0.99) as conversion
 from (select *, least(1.0, minutes / 450.0) as w, case when minutes > 0 then shots / minutes * 90.0 else {_PRIOR(0)} end as p90, case when
 shots > 0 then shots_on / shots else {_PRIOR(1)} end as ot, case when shots_on > 0 then goals / shots_on else {_PRIOR(2)} end as cv from
 rates))"""


def _rates(spark, d):
    some = view(spark, d, "player_v").withColumn("group", S.position_group(F.col("games_position")))
    groups = some.groupBy("player_id", "team_id").agg(F.min("group").alias("group"))
    return features.player_rates(some, ["player_id", "team_id"]).join(groups, ["player_id", "team_id"])


@query(f"with {_RATES} select player_id, team_id, minutes, shots, shots_on, goals from rates", "player_v")
def player_rates(spark, d):
    return features.player_rates(view(spark, d, "player_v"), ["player_id", "team_id"])


@query(f"""with {_RATES}, {_SHRUNK} select player_id, team_id, position_group, round(w, 6) as weight, round(shots_per_90, 6) as
 shots_per_90, round(on_target, 6) as on_target, round(conversion, 6) as conversion from shrunk""", "player_v")
def shrunk_rates(spark, d):
    return six(features.shrunk_rates(_rates(spark, d), F.col("group")).select("player_id", "team_id", "position_group", "weight", "shots_per_90", "on_target", "conversion"))


_PROJECTED = "shots_per_90 * 1.1 as l"


@query(f"""with {_RATES}, {_SHRUNK}, p as (select *, {_PROJECTED} from shrunk) select player_id, team_id, round(l, 6) as mean_shots,
 round(l * on_target, 6) as mean_on_target, round(l * on_target * conversion, 6) as mean_goals, round(l * (1 - on_target), 6) as
 mean_missed, round(1 - exp(-l), 6) as any_shot from p""", "player_v")
def shot_projection(spark, d):
    out = features.shot_projection(features.shrunk_rates(_rates(spark, d), F.col("group")), F.lit(1.1))
    return six(out.select("player_id", "team_id", "mean_shots", "mean_on_target", "mean_goals", "mean_missed", "any_shot"))


@query(f"""with {_RATES}, {_SHRUNK}, p as (select *, {_PROJECTED} from shrunk where position_group != 'G') select player_id, team_id,
 position_group as position, round(l, 4) as projected_shots, round(l * on_target, 4) as projected_on_target, round((1 - exp(-l)) * 100, 4)
 as any_shot_percent
 from p order by projected_shots desc, player_id, team_id limit 40""", "player_v")
def projection_matrix(spark, d):
    out = features.shot_projection(features.shrunk_rates(_rates(spark, d), F.col("group")), F.lit(1.1))
    matrix = features.projection_matrix(out).select("player_id", "team_id", "position", "projected_shots", "projected_on_target", "any_shot_percent")
    return keyed.top_k(matrix, [F.desc("projected_shots"), F.col("player_id"), F.col("team_id")], 40)


@query("""with t as (select fixture_id, team_id, sum(coalesce(shots_total, 0)) as shots from player_v group by 1, 2),
 s as (select p.player_id, p.fixture_id, p.team_id, sum(coalesce(p.shots_total, 0)) as on_s, sum(coalesce(p.games_minutes, 0)) as on_m from
 player_v p group by 1, 2, 3),
 j as (select s.player_id, on_s, on_m, t.shots - on_s as off_s, 90 - least(on_m, 90) as off_m, case when m.league_name ilike '%world cup%'
 then 1.0 else 1.0 end * least(greatest(exp((m.away_team_id * 10 - 75) / 900.0::double) / 1.0, 0.5), 1.8) as w
  from s join t on t.fixture_id = s.fixture_id and t.team_id = s.team_id join match_v m on m.fixture_id = s.fixture_id),
 a as (select player_id, sum(w * on_m) as om, sum(w * off_m) as fm, sum(w * on_s) as os, sum(w * off_s) as fs from j group by 1)
 select player_id, round(case when om > 0 then os / om else 0 end, 6) as on_rate, round(case when fm > 0 then fs / fm else 0 end, 6) as
 off_rate, case when fm > 0 and fs > 0 then round((case when om > 0 then os / om else 0 end) / (fs / fm), 6) else -1.0 end as ratio from a""", "player_v")
def weighted_plus_minus(spark, d):
    players = view(spark, d, "player_v").where("team_id is not null")
    on = players.groupBy("player_id", "fixture_id", "team_id").agg(F.sum(F.coalesce("shots_total", F.lit(0))).alias("shots_on_pitch"), F.sum(F.coalesce("games_minutes", F.lit(0))).alias("minutes_on_pitch"))
    # A team's total is summed over its players, who are dealt by fixture already: a join on both keys would deal them anew.
    totals = F.sum("shots_on_pitch").over(Window.partitionBy("fixture_id", "team_id"))
    segments = on.withColumn("shots", totals).join(view(spark, d, "match_v").select("fixture_id", "league_name", "away_team_id"), "fixture_id")
    segments = segments.withColumn("shots_off_pitch", F.col("shots") - F.col("shots_on_pitch")).withColumn("minutes_off_pitch", 90 - F.least("minutes_on_pitch", F.lit(90)))
    weight = S.stake_weight(F.col("league_name")) * S.opponent_strength(F.col("away_team_id") * 10.0 + 1425.0, F.lit(1.0))
    out = features.weighted_plus_minus(segments, ["player_id"], weight)
    return six(out.select("player_id", "on_rate", "off_rate", F.when(F.col("ratio") == float("inf"), -1.0).otherwise(F.col("ratio")).alias("ratio")))


_FACTORS = """tf as (select fixture_id, team_id, sum(coalesce(shots_total, 0)) as shots from player_v group by 1, 2), sides as (select
 fixture_id, home_team_id as team, away_team_id as opp from match_v union all select fixture_id, away_team_id, home_team_id from match_v),
 sh as (select s.team, s.opp, t.shots from sides s join tf t on t.fixture_id = s.fixture_id and t.team_id = s.opp), pr as (select opp, team,
 count(*) as n, sum(shots) as total from sh group by 1, 2), al as (select opp, sum(n) as an, sum(total) as tt from pr group by 1),
 f as (select p.team, p.opp, p.n, p.total, case when an > n then (tt - total)::double / (an - n) else (select avg(shots) from tf) end as
 baseline from pr p join al a on a.opp = p.opp), met as (select distinct team, opp from sides),
 g as (select f.team, m.team as rival, sum(f.total) as actual, sum(f.baseline * f.n) as expected from f join met m on m.opp = f.opp and
 m.team != f.team where baseline > 0 group by 1, 2),
 factors as (select team as team_id, rival as rival_id, least(greatest(case when expected > 0 then actual / expected else 1.0 end *
 exp((1500 - (1450 + team * 7)) / 900.0::double), 0.5), 1.5) as factor from g)"""


def _factors(spark, d, pairs=None):
    elo_ = view(spark, d, "match_v").select(F.col("home_team_id").alias("team_id")).distinct().withColumn("elo", F.col("team_id") * 7.0 + 1450.0)
    return features.common_opponent_factors(view(spark, d, "match_v"), features.team_fixture_totals(view(spark, d, "player_v")), elo_, pairs)


@query(f"with {_FACTORS} select team_id, rival_id, round(factor, 6) as factor from factors", "player_v")
def common_opponent_factors(spark, d):
    return six(_factors(spark, d))


_CHANGE = "cast(round_even((factor - 1.0) * 100, 0) as int)"


@query(f"""with {_FACTORS} select team_id, rival_id, case when {_CHANGE} > 0 then 'Team ' || rival_id || '''s defence increases Team ' ||
 team_id || '''s chances by ~' || abs({_CHANGE}) || '%' when {_CHANGE} < 0 then 'Team ' || rival_id || '''s defence decreases Team ' ||
 team_id || '''s chances by ~' || abs({_CHANGE}) || '%' else 'neutral 0% effect' end as prose from factors""", "player_v")
def defensive_prose(spark, d):
    return _factors(spark, d).select("team_id", "rival_id", S.change_text(F.col("factor"), team_name(F.col("team_id")), team_name(F.col("rival_id"))).alias("prose"))


@query("""select a.team as team_a, b.team as team_b, a.opp as opponent from (select distinct team, opp from (select home_team_id as team,
 away_team_id as opp from match_v union all select away_team_id, home_team_id from match_v)) a join (select distinct team, opp from (select
 home_team_id as team, away_team_id as opp from match_v union all select away_team_id, home_team_id from match_v)) b on a.opp = b.opp and
 a.team < b.team""", "match_v")
def mutual_opponents(spark, d):
    sides = shape.unpivot_sides(view(spark, d, "match_v"), [], {"team": "home_team_id", "opponent": "away_team_id"}, {"team": "away_team_id", "opponent": "home_team_id"})
    return keyed.mutual_opponents(sides)


_MET = """select distinct team, opp from (select home_team_id as team, away_team_id as opp from match_v union all select away_team_id,
 home_team_id from match_v)"""


@query(f"""with e as ({_MET}), p as (select distinct least(team, opp) as team_a, greatest(team, opp) as team_b from e where team != opp)
 select p.team_a, p.team_b, a.opp as opponent from p join e a on a.team = p.team_a join e b on b.team = p.team_b and b.opp = a.opp""", "match_v")
def mutual_opponents_of_pairs(spark, d):
    """Opponents in common of the pairs that have a match."""
    matches = view(spark, d, "match_v")
    sides = shape.unpivot_sides(matches, [], {"team": "home_team_id", "opponent": "away_team_id"}, {"team": "away_team_id", "opponent": "home_team_id"})
    return keyed.mutual_opponents(sides, matches.select(F.col("home_team_id").alias("team_a"), F.col("away_team_id").alias("team_b")))


@query(f"""with {_FACTORS} select team_id, rival_id, round(factor, 6) as factor from factors where (team_id, rival_id) in (select
 home_team_id, away_team_id from match_v)""", "player_v", "match_v")
def common_opponent_factors_of_pairs(spark, d):
    """Factors of home sides against the sides they received."""
    pairs = view(spark, d, "match_v").select(F.col("home_team_id").alias("team_id"), F.col("away_team_id").alias("rival_id"))
    return six(_factors(spark, d, pairs))


_TRAIL = """select fixture_id, team_id, cast(rn as int) as recency_rank from (select *, row_number() over (partition by team_id order by
 fixture_date desc, fixture_id desc) as rn from (select fixture_id, fixture_date, home_team_id as team_id from match_v where status_short in
 ('FT', 'AET', 'PEN') union all select fixture_id, fixture_date, away_team_id from match_v where status_short in ('FT', 'AET', 'PEN')) {0})
 where rn <= 5"""


def _trailing(spark, d, exclude):
    done = rules.completed_only(view(spark, d, "match_v"))
    sides = shape.unpivot_sides(done, ["fixture_id", "fixture_date"], {"team_id": "home_team_id"}, {"team_id": "away_team_id"})
    return keyed.trailing_n(sides, ["team_id"], [F.desc("fixture_date"), F.desc("fixture_id")], 5, exclude).select("fixture_id", "team_id", "recency_rank")


@query(_TRAIL.format(""), "match_v")
def trailing_n(spark, d):
    return _trailing(spark, d, None)


@query(_TRAIL.format("where fixture_id % 7 != 0"), "match_v")
def trailing_n_excluding(spark, d):
    return _trailing(spark, d, F.col("fixture_id") % 7 == 0)


_LAST = "last as (" + _TRAIL.format("") + ")"


@query(f"""with {_LAST} select p.fixture_id, p.line_no, p.team_id, p.player_id, p.games_minutes, l.recency_rank from player_v p join last l
 on l.fixture_id = p.fixture_id and l.team_id = p.team_id where games_minutes > 0""", "player_v")
def team_history(spark, d):
    return gold.team_history(view(spark, d, "player_v"), view(spark, d, "match_v")).select("fixture_id", "line_no", "team_id", "player_id", "games_minutes", "recency_rank")


_NEUTRAL_FACTORS = " ".join(_FACTORS.split()).replace("* exp((1500 - (1450 + team * 7)) / 900.0::double)", "")


@query(f"""with {_LAST}, {_NEUTRAL_FACTORS}, h as (select team_id, player_id, sum(games_minutes)::double as minutes,
 coalesce(sum(shots_total), 0)::double as shots, coalesce(sum(shots_on), 0)::double as shots_on, coalesce(sum(goals_total), 0)::double as
 goals
  from (select p.* from player_v p join last l on l.fixture_id = p.fixture_id and l.team_id = p.team_id where games_minutes > 0) group by 1,
 2),
 st as (select fixture_id, team_id, player_id, min(position) as position from lineup_v where is_starting group by 1, 2, 3),
 sd as (select fixture_id, home_team_id as team_id, away_team_id as opponent from match_v union all select fixture_id, away_team_id,
 home_team_id from match_v),
 rates as (select st.fixture_id, st.team_id, st.player_id, case st.position when 'A' then 'F' when 'F' then 'F' when 'D' then 'D' when 'G'
 then 'G' else 'M' end as position_group, coalesce(minutes, 0) as minutes, coalesce(shots, 0) as shots, coalesce(shots_on, 0) as shots_on,
 coalesce(goals, 0) as goals, coalesce(factor, 1.0) as factor
  from st join sd on sd.fixture_id = st.fixture_id and sd.team_id = st.team_id left join h on h.team_id = st.team_id and h.player_id =
 st.player_id left join factors on factors.team_id = sd.opponent and factors.rival_id = st.team_id), {_SHRUNK}
 select fixture_id, team_id, player_id, round(shots_per_90 * factor, 6) as mean_shots, round(shots_per_90 * factor * on_target, 6) as
 mean_on_target, round(1 - exp(-shots_per_90 * factor), 6) as any_shot from shrunk where position_group != 'G'""", "lineup_v")
def matchup_matrix(spark, d):
    out = gold.matchup_matrix(view(spark, d, "match_v"), view(spark, d, "player_v"), view(spark, d, "lineup_v"))
    return six(out.where("position_group != 'G'").select("fixture_id", "team_id", "player_id", "mean_shots", "mean_on_target", "any_shot"))


# --- resolution and line-ups ---


def _named_matches(spark, d):
    return view(spark, d, "match_v").select("fixture_id", "fixture_date", team_name(F.col("home_team_id")).alias("home_team"), team_name(F.col("away_team_id")).alias("away_team"), "home_team_id", "away_team_id")


@query("""with r as (select fixture_id as request_id, cast(fixture_date as date) as day, case when fixture_id % 5 = 1 then away_team_id
 when fixture_id % 5 = 4 then home_team_id + 100 else home_team_id end as h, case when fixture_id % 5 = 1 then home_team_id when fixture_id
 % 5 = 3 then null else away_team_id end as a from match_v),
 j as (select r.request_id, r.a, count(m.fixture_id) filter (where m.home_team_id = r.h) as exact, count(m.fixture_id) as alln,
 min(m.fixture_id) filter (where m.home_team_id = r.h) as id from r left join match_v m on cast(m.fixture_date as date) = r.day and
 ((m.home_team_id = r.h and m.away_team_id = r.a) or (m.home_team_id = r.a and m.away_team_id = r.h)) group by 1, 2)
 select request_id, case when a is null then 'invalid' when exact = 1 then 'matched' when exact > 1 then 'ambiguous' when alln > 0 then
 'reversed' else 'missing' end as outcome, case when a is not null and exact = 1 then id end as fixture_id from j""", "match_v")
def resolve_matches(spark, d):
    k, h, a = F.col("fixture_id") % 5, F.col("home_team_id"), F.col("away_team_id")
    home = F.when(k == 1, a).when(k == 4, h + 100).otherwise(h)
    away = F.when(k == 1, h).when(k == 3, None).otherwise(a)
    requests = view(spark, d, "match_v").select(F.col("fixture_id").alias("request_id"), F.to_date("fixture_date").alias("match_date"), F.upper(team_name(home)).alias("home_team"), team_name(away).alias("away_team"))
    return keyed.resolve_matches(requests, _named_matches(spark, d))


@query("""select s.s_suppkey, coalesce(n.n_nationkey, -1) as entity_id from supplier s left join nation n on n.n_nationkey = s.s_nationkey
 and n.n_nationkey % 4 != 0""")
def resolve_entities(spark, d):
    nation = table(spark, d, "nation")
    named = table(spark, d, "supplier").join(nation.select(F.col("n_nationkey").alias("s_nationkey"), F.lower("n_name").alias("spelled")), "s_nationkey").select("s_suppkey", "spelled")
    return keyed.resolve_entity_id(named, "spelled", nation.where("n_nationkey % 4 != 0"), "n_name", "n_nationkey", F.lit(-1)).select("s_suppkey", "entity_id")


@query("""select m.fixture_id, a.team_id as home_team_id, b.team_id as away_team_id from match_v m left join (select distinct fixture_id,
 team_id from player_v) a on a.fixture_id = m.fixture_id and a.team_id = m.home_team_id
 left join (select distinct fixture_id, team_id from player_v) b on b.fixture_id = m.fixture_id and b.team_id = m.away_team_id""", "player_v")
def side_ids(spark, d):
    teams = view(spark, d, "player_v").select("fixture_id", "team_id", team_name(F.col("team_id")).alias("team_name")).distinct()
    return keyed.side_ids(_named_matches(spark, d).drop("home_team_id", "away_team_id"), teams).select("fixture_id", "home_team_id", "away_team_id")


_ROSTER = "select fixture_id, team_id, count(*) as players, count(distinct lower(trim(player_name))) as names from lineup_v group by 1, 2"


@query(f"select *, players = 2 and names = 2 as is_complete from ({_ROSTER})", "lineup_v")
def roster_check(spark, d):
    return features.check_roster(view(spark, d, "lineup_v"), 2)


@query(f"""with good as (select fixture_id, team_id from ({_ROSTER}) where players = 2 and names = 2) select l.fixture_id, l.team_id,
 l.line_no, case when g.team_id is null then 'fallback' else 'confirmed' end as lineup_source from lineup_v l left join good g on
 g.fixture_id = l.fixture_id and g.team_id = l.team_id""", "lineup_v")
def lineup_resolution(spark, d):
    lineups = view(spark, d, "lineup_v")
    return features.resolve_lineups(lineups, lineups, 2).select("fixture_id", "team_id", "line_no", "lineup_source")


# --- quality ---


@query("select fixture_id, line_no from player_v where games_minutes is null or shots_total is null", "player_v")
def dq_not_null(spark, d):
    return quality.not_null(view(spark, d, "player_v"), ["games_minutes", "shots_total"]).select("fixture_id", "line_no")


@query("select o_custkey, count(*) as n_rows from orders group by 1 having count(*) > 1")
def dq_unique(spark, d):
    return quality.unique(table(spark, d, "orders"), "o_custkey")


@query("select fixture_id, team_id, player_id, count(*) as n_rows from player_v group by 1, 2, 3 having count(*) > 1", "player_v")
def dq_unique_combination(spark, d):
    return quality.unique_combination(view(spark, d, "player_v"), ["fixture_id", "team_id", "player_id"])


@query("select o_orderkey from orders where o_custkey not in (select c_custkey from customer where c_custkey % 10 != 0) and o_custkey is not null")
def dq_relationships(spark, d):
    return quality.relationships(table(spark, d, "orders"), table(spark, d, "customer").where("c_custkey % 10 != 0"), "o_custkey", "c_custkey").select("o_orderkey")


@query("select fixture_id, status_short from match_v where status_short not in ('FT', 'AET', 'PEN')", "match_v")
def dq_accepted_values(spark, d):
    return quality.accepted_values(view(spark, d, "match_v"), "status_short", rules.COMPLETED).select("fixture_id", "status_short")


@query("""select 'fixture_unique' as check_name, count(*) as failing_rows, count(*) = 0 as passed from (select fixture_id from match_v
 group by 1 having count(*) > 1) union all select 'minutes_known', count(*), count(*) = 0 from player_v where games_minutes is null
 union all select 'fixture_known', count(*), count(*) = 0 from player_v where fixture_id not in (select fixture_id from match_v) union all
 select 'status_accepted', count(*), count(*) = 0 from match_v where status_short not in ('FT', 'AET', 'PEN', 'NS')""", "player_v")
def dq_suite(spark, d):
    m, p = view(spark, d, "match_v"), view(spark, d, "player_v")
    check = quality.Check
    checks = {
        "fixture_unique": check("match", "unique", ("fixture_id",)),
        "minutes_known": check("player", "not_null", ("games_minutes",)),
        "fixture_known": check("player", "relationships", ("fixture_id",), parent="match"),
        "status_accepted": check("match", "accepted_values", ("status_short",), (*rules.COMPLETED, "NS")),
    }
    return quality.run_suite({"match": m, "player": p}, checks)


@query("""select 'order_unique' as check_name, count(*) as failing_rows, count(*) = 0 as passed from (select o_orderkey from orders group by 1
 having count(*) > 1) union all select 'line_unique', count(*), count(*) = 0 from (select l_orderkey, l_suppkey from lineitem group by 1, 2
 having count(*) > 1) union all select 'customer_known', count(*), count(*) = 0 from orders where o_custkey not in (select c_custkey from
 customer where c_custkey % 10 != 0) union all select 'order_known', count(*), count(*) = 0 from lineitem where l_orderkey not in (select
 o_orderkey from orders) union all select 'customer_ordered', count(*), count(*) = 0 from customer where c_custkey % 10 != 0 and c_custkey not
 in (select o_custkey from orders) union all select 'flag_accepted', count(*), count(*) = 0 from lineitem where l_returnflag not in ('A', 'N')
 union all select 'date_known', count(*), count(*) = 0 from orders where o_orderdate is null""")
def dq_suite_of_orders(spark, d):
    """Three tables whose keys are checked both ways, each read once."""
    check = quality.Check
    tables = {t: table(spark, d, t) for t in ("orders", "lineitem", "customer")}
    tables["customer"] = tables["customer"].where("c_custkey % 10 != 0")
    checks = {
        "order_unique": check("orders", "unique", ("o_orderkey",)),
        "line_unique": check("lineitem", "unique_combination", ("l_orderkey", "l_suppkey")),
        "customer_known": check("orders", "relationships", ("o_custkey",), parent="customer", parent_columns=("c_custkey",)),
        "order_known": check("lineitem", "relationships", ("l_orderkey",), parent="orders", parent_columns=("o_orderkey",)),
        "customer_ordered": check("customer", "relationships", ("c_custkey",), parent="orders", parent_columns=("o_custkey",)),
        "flag_accepted": check("lineitem", "accepted_values", ("l_returnflag",), ("A", "N")),
        "date_known": check("orders", "not_null", ("o_orderdate",)),
    }
    return quality.run_suite(tables, checks)


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(" union all ".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in _TABLES))
def table_counts(spark, d):
    return quality.table_counts({t: table(spark, d, t) for t in _TABLES})


@query("select distinct player_id from player_v", "player_v")
def distinct_ids(spark, d):
    return view(spark, d, "player_v").select("player_id").distinct()


@query("select l_orderkey, l_suppkey, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1")
def duplicate_keys(spark, d):
    return quality.unique_combination(table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"])


# --- parsing and schemas ---


@query("select event_id, cast(event_id as varchar) as label, round(value, 6) as value, cast(null as int) as absent from events")
def align_schema(spark, d):
    schema = T.StructType.fromDDL("event_id bigint, label string, value double, absent int")
    rows = table(spark, d, "events").select("event_id", F.col("event_id").alias("label"), F.col("value").cast("string").alias("value"), F.lit("dropped").alias("extra"))
    return six(io.align_to_schema(rows, schema))


@query("""select key as field, case when count(distinct json_type(doc, '$.' || key)) > 1 then 'VARIANT' when any_value(json_type(doc, '$.'
 || key)) in ('UBIGINT', 'BIGINT') then 'BIGINT'
 when any_value(json_type(doc, '$.' || key)) = 'VARCHAR' then 'STRING' when any_value(json_type(doc, '$.' || key)) = 'BOOLEAN' then
 'BOOLEAN' else 'OBJECT' end as kind
 from (select doc, unnest(json_keys(doc)) as key from (select case when event_id % 7 = 0 then json_object('k', event_id, 'user', concat('u',
 user_id), 'late', value > 100) else props::json end as doc from events where props is not null)) group by 1""")
def infer_schema(spark, d):
    """Fields and kinds of all documents of a column, some of which have more fields than the first."""
    more = F.to_json(F.struct(F.col("event_id").alias("k"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"), (F.col("value") > 100).alias("late")))
    docs = table(spark, d, "events").where("props is not null").select(F.when(F.col("event_id") % 7 == 0, more).otherwise(F.col("props")).alias("doc"))
    found = io.infer_payload_schema(docs, "doc")
    fields = [part.split(": ") for part in found.removeprefix("OBJECT<").removesuffix(">").split(", ")]
    return spark.createDataFrame([(name, kind) for name, kind in fields], "field string, kind string")


@query("""select event_id, case when event_id % 3 = 0 then event_id::varchar when event_id % 3 = 1 then '{"a":' || event_id || '}' end as
 mixed, case when event_id % 3 = 2 then event_id end as meta_deep_n, case when event_id % 3 = 2 then event_type end as meta_kind,
 case when event_id % 2 = 0 then user_id when event_id % 3 = 0 then event_id end as list_total from events""")
def schema_evolution(spark, d):
    """Documents whose fields differ, with a field of several kinds, inner objects and lists of objects of which some have
    a field more: inferred over all, parsed and flattened."""
    n = F.col("event_id")
    mixed = F.when(n % 3 == 0, n.cast("string")).when(n % 3 == 1, F.concat(F.lit('{"a":'), n.cast("string"), F.lit("}")))
    parts = F.array_compact(F.array(
        F.when(mixed.isNotNull(), F.concat(F.lit('"mixed":'), mixed)),
        F.when(n % 3 == 2, F.concat(F.lit('"meta":{"deep":{"n":'), n.cast("string"), F.lit('},"kind":"'), F.col("event_type"), F.lit('"}'))),
        F.when(n % 2 == 0, F.concat(F.lit('"list":[{"u":'), F.col("user_id").cast("string"), F.lit("}]"))).when(n % 3 == 0, F.concat(F.lit('"list":[{"e":'), n.cast("string"), F.lit("},{}]"))),
    ))
    docs = table(spark, d, "events").select("event_id", F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("raw_payload"))
    flat = shape.leaf_columns(io.parse_inferred(docs), "payload")
    total = F.aggregate("list", F.lit(None).cast("bigint"), lambda a, x: F.coalesce(a, F.lit(0)) + F.coalesce(x["u"], x["e"], F.lit(0)))
    return flat.select("event_id", "mixed", "meta_deep_n", "meta_kind", total.alias("list_total"))


@query("""select event_id, length(trim(regexp_replace(props, '\\s+', ' ', 'g'))) as n_chars, substr(trim(regexp_replace(props, '\\s+', ' ',
 'g')), 1, 500) as clean from events where props is not null""")
def error_text(spark, d):
    """Every space of a text is spread over lines and tabs first; what comes back is the text."""
    clean = S.error_text(F.concat(F.lit("\n "), F.regexp_replace("props", " ", "\n \t "), F.lit(" \r\n")))
    return table(spark, d, "events").where("props is not null").select("event_id", F.length(clean).cast("bigint").alias("n_chars"), clean.alias("clean"))


@query("""select event_id, sha256('{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}') as
 digest from events""")
def payload_fingerprint(spark, d):
    return table(spark, d, "events").select("event_id", S.fingerprint("event_id", "event_type", "user_id").alias("digest"))


@query("""select fixture_id, round(1 / (1 + pow(10::double, ((1500 + away_team_id * 20) - (1500 + home_team_id * 20)) / 400.0::double)), 6)
 as expected from match_v""", "match_v")
def elo_expected(spark, d):
    home, away = (F.col(f"{side}_team_id") * 20.0 + 1500.0 for side in ("home", "away"))
    return six(view(spark, d, "match_v").select("fixture_id", S.elo_expected(home, away).alias("expected")))


@query("""select event_id, cast(case when event_type = 'click' then 'c' end as varchar) as kind, cast(event_id as int) as number,
 round(value, 6) as amount from events""")
def project_paths(spark, d):
    nested = F.struct(F.struct(F.when(F.col("event_type") == "click", "c").alias("kind")).alias("a"), F.struct(F.struct(F.col("event_id").cast("string").alias("n"), F.col("value").alias("v")).alias("c")).alias("b"))
    rows = table(spark, d, "events").select("event_id", F.from_json(F.to_json(nested), "a struct<kind string>, b struct<c struct<n string, v double>>").alias("p"))
    return six(shape.project_paths(rows, {"event_id": ("event_id", "bigint"), "kind": ("p.a.kind", "string"), "number": ("p.b.c.n", "int"), "amount": ("p.b.c.v", "double")}))


@query("select 'missing columns: o_absent, o_gone' as message, count(*) as n_rows from orders")
def required_columns(spark, d):
    """What a table lacks is named; one that lacks nothing goes on."""
    orders = table(spark, d, "orders")
    try:
        shape.require_columns(orders, ["o_orderkey", "o_absent", "o_gone"])
        message = "none"
    except ValueError as e:
        message = str(e)
    return shape.require_columns(orders, ["o_orderkey"]).agg(F.lit(message).alias("message"), F.count("*").alias("n_rows"))


@query("select event_id, event_id % 4 = 1 as is_quota from events")
def quota_errors(spark, d):
    k = F.col("event_id") % 4
    text = F.when(k == 1, F.concat(F.lit("{\"requests\": \"Daily QUOTA of "), F.col("user_id").cast("string"), F.lit(" used\"}"))).when(k == 2, F.lit("{\"token\": \"bad key\"}")).when(k == 3, None).otherwise("")
    return table(spark, d, "events").select("event_id", S.is_quota_error(text).alias("is_quota"))


@query("""select event_id, case when event_id % 5 = 0 then null else cast(ts as date) end as day, case when event_id % 5 = 0 then null else
 cast(date_part('hour', ts) as int) end as hour, case when event_id % 3 = 0 then null else cast(event_id as int) end as number from events""")
def parse_dates(spark, d):
    k = F.col("event_id")
    text = F.when(k % 5 == 0, F.lit("not a date")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    number = F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit("x"))).otherwise(k.cast("string"))
    at = F.try_to_timestamp(text)
    return table(spark, d, "events").select("event_id", F.to_date(at).alias("day"), F.hour(at).alias("hour"), number.try_cast("int").alias("number"))


@query("""select event_id, upper(event_type) as kind, round(abs(value - 50), 6) as gap, round(greatest(least(value, 60), 40), 6) as held,
 round(exp(-value / 100), 6) as decay, coalesce(event_type, 'none') as known from events""")
def builtin_expressions(spark, d):
    trip = F.from_json(F.to_json(F.struct("event_type", "value")), "event_type string, value double")
    rows = table(spark, d, "events").withColumn("j", trip)
    v = F.col("j.value")
    return six(rows.select("event_id", F.upper("j.event_type").alias("kind"), F.abs(v - 50).alias("gap"), S.clip(v, 40.0, 60.0).alias("held"), F.exp(-v / 100).alias("decay"), F.coalesce("j.event_type", F.lit("none")).alias("known")))


@query("""select event_id, round(exp(-0.6931471805599453 / 10 * greatest(0, (epoch(timestamp '2024-02-01') - floor(epoch(ts))) / 86400.0)),
 6) as weight from events""")
def recency_weights(spark, d):
    return six(table(spark, d, "events").select("event_id", S.recency_weight(F.col("ts"), F.to_timestamp(F.lit(AS_OF)), 10.0).alias("weight")))


# --- files and tables ---


@query("select cast(fixture_id as varchar) as key, status_short, concat('Team ', cast(home_team_id as varchar)) as home_team from match_v", "match_v")
def keyed_json_bootstrap(spark, d):
    info = F.struct(F.struct("status_short", team_name(F.col("home_team_id")).alias("home_team")).alias("match_info"))
    some = view(spark, d, "match_v")
    # One object for each block of ten thousand keys, each in a file of its own lines.
    objects = some.groupBy(F.floor(F.col("fixture_id") / 10_000).alias("block")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("fixture_id").cast("string"), info)))).alias("value"))
    path = scratch(spark, "keyed")
    objects.select("value").write.option("maxRecordsPerFile", 1).text(path)
    got = io.read_keyed_json(spark, path, "struct<match_info struct<status_short string, home_team string>>".replace("match_info struct", "match_info:struct").replace("status_short string", "status_short:string").replace("home_team string", "home_team:string"))
    return got.select("key", "value.match_info.status_short", "value.match_info.home_team")


@query("select fixture_id, home_team_id, status_short from match_v", "match_v")
def json_window_landing(spark, d):
    """All matches landed in windows of a year, then the first window again, which replaces its first landing alone."""
    first, last = _span(spark, d)
    windows = shape.date_windows(spark, first, last, 366).select("window_start", "window_end")
    day, root = F.to_date("fixture_date"), scratch(spark, "windows")
    matches = view(spark, d, "match_v").select("fixture_id", "home_team_id", "status_short", "fixture_date")
    io.land_json_windows(matches.withColumn("home_team_id", F.when(day < F.date_add(F.lit(first), 366), -1).otherwise(F.col("home_team_id"))), root, day, windows)
    landed = io.land_json_windows(matches, root, day, windows.where(F.col("window_start") == F.lit(first)))
    return landed.select("fixture_id", "home_team_id", "status_short")


@query("""select cast(year(m.fixture_date) as int) as match_year, count(*) as n_rows, cast(sum(p.games_minutes) as bigint) as minutes from
 player_v p join match_v m on m.fixture_id = p.fixture_id group by 1""", "player_v")
def write_read_partitioned(spark, d):
    rows = _dated(spark, d).withColumn("match_year", F.year("fixture_date"))
    path = scratch(spark, "partitioned")
    assert not io.target_exists(spark, path)
    io.write_target(io.balanced(rows, ["match_year"]), path, "overwrite", partition_by=["match_year"])
    return io.read_target(spark, path).groupBy("match_year").agg(F.count("*").alias("n_rows"), F.sum("games_minutes").alias("minutes"))


@query("select c_custkey, case when c_custkey % 2 = 0 then 'new' else 'old' end as version, round(c_acctbal, 6) as balance from customer")
def upsert_target_exists(spark, d):
    name = f"lakeloom_{uuid.uuid4().hex}"
    rows = table(spark, d, "customer").select("c_custkey", F.lit("old").alias("version"), F.col("c_acctbal").alias("balance"))
    state.merge_into(spark, name, rows, ["c_custkey"])
    state.merge_into(spark, name, rows.where("c_custkey % 2 = 0").withColumn("version", F.lit("new")), ["c_custkey"])
    return six(io.read_target(spark, name))


@query("""select o_orderkey, case when o_orderstatus = 'P' then 'later' else 'first' end as version, round(case when o_orderstatus = 'P'
 then o_totalprice + 2 else o_totalprice end, 6) as price from orders""")
def merge_late_rows(spark, d):
    """Of two landings of a row the later one counts, in whichever order they come."""
    name = f"lakeloom_{uuid.uuid4().hex}"
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("landed"), F.lit("first").alias("version"), F.col("o_totalprice").alias("price"))
    state.merge_into(spark, name, rows, ["o_orderkey"], order="landed")
    shifted = lambda status, days, version, more: rows.where(F.col("o_orderstatus") == status).withColumns({"landed": F.col("landed") + F.make_dt_interval(F.lit(days)), "version": F.lit(version), "price": F.col("price") + more})
    state.merge_into(spark, name, shifted("F", -1, "earlier", 1).unionByName(shifted("P", 1, "later", 2)), ["o_orderkey"], order="landed")
    return six(spark.table(name).select("o_orderkey", "version", "price"))


@query("""select c_custkey, case when c_custkey % 3 = 0 then 2 else 1 end as part_number, round(c_acctbal, 6) as seq, case when c_custkey % 3 =
 0 then c_mktsegment end as segment from customer""")
def merge_into_columns(spark, d):
    """Columns named as an engine might name its own, and one that only the second merge has."""
    name = f"lakeloom_{uuid.uuid4().hex}"
    rows = table(spark, d, "customer").select("c_custkey", F.lit(1).alias("part_number"), F.col("c_acctbal").alias("seq"), F.col("c_mktsegment").alias("segment"))
    state.merge_into(spark, name, rows.drop("segment"), ["c_custkey"])
    return six(state.merge_into(spark, name, rows.where("c_custkey % 3 = 0").withColumn("part_number", F.lit(2)), ["c_custkey"], add_columns=True))


@query("""select o_orderkey, case when o_orderkey % 10 = 0 then 9 else o_orderkey % 10 end::int as batch, round(o_totalprice + case when o_orderkey % 10 = 0
 then 9 else o_orderkey % 10 end, 6) as price from orders""")
def merge_many(spark, d):
    """Ten merges, in the course of which small increments are merged with one another; a tenth of the rows comes in each."""
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    name, digit = f"lakeloom_{uuid.uuid4().hex}", F.col("o_orderkey") % 10
    for batch in range(10):
        part = rows.where((digit == batch) | (digit == 0)).select("o_orderkey", F.lit(batch).alias("batch"), (F.col("price") + batch).alias("price"))
        out = state.merge_into(spark, name, part, ["o_orderkey"])
    return six(out)


@query("select o_orderkey, o_orderstatus, round(o_totalprice * 2, 6) as price from orders")
def materialized_model(spark, d):
    """A model rebuilt as a table: the second build replaces the first."""
    name = f"lakeloom_{uuid.uuid4().hex}"
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    io.materialize(rows, name)
    return six(io.materialize(rows.withColumn("price", F.col("price") * 2), name))


@query("select c_custkey, c_name, false as was_there, true as was_empty from customer")
def ensured_layer_table(spark, d):
    """A table of a layer made where it is missing, found empty, and then filled; making it again changes nothing."""
    name = io.layer_table("spark_catalog", {"silver": "lakeloom_silver"}, "silver", f"customers_{uuid.uuid4().hex}")
    there = io.target_exists(spark, name)
    for _ in range(2):
        io.ensure_table(spark, name, "c_custkey bigint, c_name string")
    empty = quality.is_empty(spark.table(name))
    io.write_target(table(spark, d, "customer").select("c_custkey", "c_name"), name, "append")
    io.ensure_table(spark, name, "c_custkey bigint, c_name string")
    return shape.with_defaults(io.read_target(spark, name), {"was_there": there, "was_empty": empty})


# --- ratings ---


def _matches(spark, d):
    m = features.match_goals(view(spark, d, "match_v"), view(spark, d, "player_v"))
    return m.select("fixture_id", F.col("fixture_date").alias("match_date"), "home_team_id", "away_team_id", "home_goals", "away_goals", S.high_stakes(F.col("league_name")).alias("is_high_stakes"), "league_id")


def _elo(spark, d):
    return elo.elo_replay(_matches(spark, d), "league_id")


@query()
def elo_replay(spark, d):
    return six(_elo(spark, d).drop("match_date"))


@query("select cast(league_id as varchar) as pool, count(*) as n_matches, true as is_conserved from match_v group by 1", "match_v")
def elo_conservation(spark, d):
    gain = _elo(spark, d).groupBy("pool", "fixture_id").agg(F.sum(F.col("team_elo") - F.col("pre_team_elo")).alias("gain"))
    return gain.groupBy("pool").agg(F.count("*").alias("n_matches"), F.bool_and(F.abs("gain") < 1e-9).alias("is_conserved"))


@query("""with days as (select fixture_id, league_id, cast(fixture_date as date) as day from match_v),
 cuts as (select league_id, min(day) as cut from days where fixture_id % 97 = 0 and day >= (select max(day) from days) - 60 group by 1)
 select cast(d.league_id as varchar) as pool, 2 * count(*) as n_rows, count(*) filter (where day >= cut) as n_replayed, 0::bigint as n_different
 from days d left join cuts c on c.league_id = d.league_id group by 1""", "match_v")
def elo_update(spark, d):
    """Ratings after some matches of the last sixty days have come in: only what follows the first is replayed, and
    nothing differs from a replay of all."""
    matches = io.materialize(_matches(spark, d), f"lakeloom_{uuid.uuid4().hex}")  # five jobs read them
    ends = matches.agg(F.date_sub(F.max("match_date"), 60)).first()[0]
    known = matches.where(~((F.col("fixture_id") % 97 == 0) & (F.to_date("match_date") >= F.lit(ends))))
    before = io.materialize(elo.elo_replay(known, "league_id"), f"lakeloom_{uuid.uuid4().hex}")
    after, replayed = elo.elo_update(before, known, matches, "league_id")
    side = ["pool", "fixture_id", "team_id"]
    whole = elo.elo_replay(matches, "league_id").select(*side, F.col("team_elo").alias("want"), F.col("pre_team_elo").alias("pre_want"))
    wrong = (F.abs(F.col("team_elo") - F.col("want")) > 1e-9) | (F.abs(F.col("pre_team_elo") - F.col("pre_want")) > 1e-9) | F.col("want").isNull() | F.col("team_elo").isNull()
    both = after.join(whole, side, "full").groupBy("pool").agg(F.count("*").alias("n_rows"), F.count_if(wrong).alias("n_different"))
    return both.join(replayed.groupBy("pool").agg(F.count("*").alias("n")), "pool", "left").select("pool", "n_rows", F.coalesce("n", F.lit(0)).alias("n_replayed"), "n_different")


# --- stored tables kept up to date ---


@query("""select cast(target_date as date) as window_start, cast(target_date as date) as window_end, 'COMPLETED' as status, count(*) as records,
 case when day(target_date) = 3 or day(target_date) >= 20 then 2 else 1 end as run from ckpt_v group by 1, 2, 5""", "ckpt_v")
def backfill_resumed(spark, d):
    """A stored backfill whose first run meets a timeout and a quota; the second takes up what is pending and ends it."""
    days = view(spark, d, "ckpt_v").groupBy(F.col("target_date").alias("window_start"), F.col("target_date").alias("window_end")).agg(F.count("*").alias("records"))
    error = F.when(F.day("window_start") == 3, "timeout").when(F.day("window_start") >= 20, "quota used up")
    stored = state.window_table(spark, scratch(spark, "windows"))
    for run, failed in ((1, error), (2, F.lit(None).cast("string"))):
        attempt = lambda todo: todo.join(days, state.WINDOW_KEYS).withColumn("error", failed)  # noqa: B023, E731
        out = state.backfill(stored, days, attempt, F.to_timestamp(F.lit(f"2024-03-0{run} 00:00:00")), scratch(spark, "attempts"))
    return out.select("window_start", "window_end", "status", "records", F.day("updated_at").alias("run"))


_TYPED_KEYS = ["fixture_id", "team_id", "player_id"]
_TYPED = [*_TYPED_KEYS, "games_minutes", "shots_total", "shots_on", "goals_total"]


def _landings(spark, d, wrong, at):
    """Landed payloads of all fixtures at a time; ``wrong`` ones lack all minutes."""
    players = view(spark, d, "player_v", "int")
    players = players.withColumn("games_minutes", F.lit(None).cast("int")) if wrong else players
    return player_payloads(players).select("fixture_id", F.to_timestamp(F.lit(at)).alias("landed_at"), "raw_payload")


@query(f"with {_SILVER_PLAYERS} select fixture_id, team_id, player_id, games_minutes, shots_total, shots_on, goals_total from silver", "player_v")
def silver_refresh(spark, d):
    """A typed table brought up to date after each of two landings, of which it reads the new one only."""
    stored = IncrementTable(spark, scratch(spark, "typed"), _TYPED_KEYS, order="ingested_at_utc")
    bronze = None
    for wrong, at in ((True, "2024-02-01"), (False, "2024-02-02")):
        landed = io.land_envelopes(_landings(spark, d, wrong, at), run_id="run", endpoint="fixtures/players", at=F.col("landed_at"))
        bronze = landed if bronze is None else bronze.unionByName(landed)
        silver.refresh(stored, bronze, silver.silver_player_stats)
    return stored.read(columns=_TYPED)


# --- streams ---


def _landed(spark, d, copies):
    """A folder of landed payloads, each ``copies`` times; the copies are made from the first landing's files."""
    folder = scratch(spark, "landing")
    ingest.land_files(_landings(spark, d, False, AS_OF), folder)
    again = ingest.landed_files(spark, folder)
    for _ in range(copies - 1):
        ingest.land_files(again, folder)
    return folder


@query(f"with {_SILVER_PLAYERS} select fixture_id, team_id, player_id, games_minutes, shots_total, shots_on, goals_total from silver", "player_v")
def stream_bronze_to_silver(spark, d):
    name = f"lakeloom_{uuid.uuid4().hex}"
    out = ingest.stream_into(spark, _landed(spark, d, 2), name, scratch(spark, "stream"), silver.silver_player_stats, _TYPED_KEYS, columns=_TYPED)
    return out


@query("select cast(fixture_id as int) as fixture_id, count(*) as n_landed from (select distinct fixture_id from player_v) group by 1", "player_v")
def stream_dedup(spark, d):
    out = scratch(spark, "deduplicated")
    once = ingest.without_replays(ingest.landing_stream(spark, _landed(spark, d, 3)))
    once.writeStream.format("parquet").option("compression", "zstd").option("path", out).option("checkpointLocation", scratch(spark, "stream")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("fixture_id").agg(F.count("*").alias("n_landed"))


@query(f"with {_SILVER_PLAYERS} select fixture_id, team_id, player_id, games_minutes, shots_total, shots_on, goals_total from silver", "player_v")
def stream_late_landings(spark, d):
    """Two runs of a stream: newer landings replace older ones, replays and late older landings of the second change nothing."""
    name, folder, checkpoint = f"lakeloom_{uuid.uuid4().hex}", scratch(spark, "landing"), scratch(spark, "stream")
    old, new, even = _landings(spark, d, True, "2024-02-01"), _landings(spark, d, False, "2024-02-02"), F.col("fixture_id") % 2 == 0
    landings = scratch(spark, "landings")
    old.unionByName(new).write.option("compression", "zstd").parquet(landings)  # once for both runs
    both = spark.read.parquet(landings)
    for rows in (both.where(even == (F.col("landed_at") == F.to_timestamp(F.lit("2024-02-02")))), both):
        ingest.land_files(rows, folder)
        out = ingest.stream_into(spark, folder, name, checkpoint, silver.silver_player_stats, _TYPED_KEYS, columns=_TYPED)
    return out
