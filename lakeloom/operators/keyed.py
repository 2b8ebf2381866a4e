"""Operators on keys: latest rows, trailing rows, work plans, name joins and match resolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.names import normalize_name


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``, which should be total. Rank limits reach the tasks before the shuffle."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def trailing_n(df: DataFrame, keys: list[str], order: list[Column], n: int, exclude: Column | None = None) -> DataFrame:
    """The first ``n`` rows of each key; rows that ``exclude`` names are left out before they are counted."""
    if exclude is not None:
        df = df.where(~F.coalesce(exclude, F.lit(False)))
    return df.withColumn("recency_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("recency_rank") <= n)


def if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if a count shows at most so many rows, else unchanged (a shuffle join follows)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def numbered(df: DataFrame, col: str, ties: list[Column], out: str, parts: int = 200) -> DataFrame:
    """``df`` with ``out``, each row's number from 1 on by descending ``col`` (a number, nulls last) and then ``ties``.

    Rows are dealt to ranges between quantiles of ``col``; a range's number is counted up from the rows of those before
    it, so no task sorts more than a range. Rows of one equal value share a range.
    """
    cuts = df.agg(F.percentile_approx(col, [i / parts for i in range(1, parts)])).first()[0]  # ``parts`` numbers
    cuts = sorted(set(cuts or []), reverse=True)
    above = F.lit(0)
    for cut in cuts:
        above = above + F.when(F.col(col) >= F.lit(cut), 0).otherwise(1)
    ranged = df.withColumn("range_number", above)
    sizes = ranged.groupBy("range_number").agg(F.count("*").alias("range_size"))
    before = Window.orderBy("range_number").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    bases = sizes.select("range_number", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("range_base"))
    inside = F.row_number().over(Window.partitionBy("range_number").orderBy(F.desc_nulls_last(col), *ties))
    return ranged.join(F.broadcast(bases), "range_number").withColumn(out, (F.col("range_base") + inside).cast("int")).drop("range_number", "range_base")


def plan_work(requested: DataFrame, completed: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Each requested key once, with action FETCH or SKIP; ``force`` fetches all."""
    wanted = requested.select(key).where(F.col(key).isNotNull()).distinct()
    if force:
        return wanted.withColumn("action", F.lit("FETCH"))
    done = completed.select(key).distinct().withColumn("__done", F.lit(True))
    return wanted.join(done, key, "left").select(key, F.when(F.col("__done"), "SKIP").otherwise("FETCH").alias("action"))


def join_within(left: DataFrame, right: DataFrame, key: str, rest: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` by ``key`` and ``rest``, as ``join`` does it (inner or left), but dealt by ``key``
    alone, so rows that are dealt by it need no shuffle. ``right`` has a handful of rows of one ``key``: they meet the left
    rows in one array."""
    columns = [c for c in right.columns if c not in (key, *rest)]
    held = right.groupBy(key).agg(F.collect_list(F.struct(*rest, *columns)).alias("__held"))
    same = lambda r: reduce(lambda a, b: a & b, [r[c] == F.col(c) for c in rest])
    explode = F.explode if how == "inner" else F.explode_outer
    rows = left.join(held, key, how).withColumn("__held", explode(F.filter("__held", same)))
    return rows.select(key, *[c for c in left.columns if c != key], *[F.col(f"__held.{c}").alias(c) for c in columns])


def join_context(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], defaults: dict | None = None, check: bool = False) -> DataFrame:
    """Left join of chosen columns by the keys the right side has, the first of which has a handful of rows there; nulls
    become defaults. ``check`` raises if a key of the right side isn't unique, which would multiply rows."""
    keys = [k for k in keys if k in right.columns]
    side = right.select(*keys, *columns)
    if check and side.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"rows are not unique by {', '.join(keys)}")
    out = left.join(side, keys, "left") if len(keys) < 2 else join_within(left, side, keys[0], keys[1:], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def join_on_name(left: DataFrame, right: DataFrame, left_col: str, right_col: str, mode: str = "player", how: str = "inner") -> DataFrame:
    """Join by names that differ in accents, case or spacing only."""
    a = left.withColumn("__name", normalize_name(F.col(left_col), mode))
    b = right.withColumn("__name", normalize_name(F.col(right_col), mode))
    return a.join(b, "__name", how).drop("__name")


def resolve_entity_id(df: DataFrame, name_col: str, dim: DataFrame, dim_name: str, dim_id: str, fallback: Column) -> DataFrame:
    """``df`` with entity_id: that of the dimension row of the same name (the smallest), else the fallback."""
    ids = dim.groupBy(normalize_name(F.col(dim_name), "alias").alias("__key")).agg(F.min(dim_id).alias("__id"))
    named = df.withColumn("__key", normalize_name(F.col(name_col), "alias"))
    return named.join(ids, "__key", "left").withColumn("entity_id", F.coalesce("__id", fallback)).drop("__key", "__id")


def side_ids(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """``matches`` (home_team, away_team) with the ids of its sides, found by name among ``teams`` (fixture_id, team_id,
    team_name)."""
    keyed = teams.select("fixture_id", "team_id", normalize_name(F.col("team_name"), "alias").alias("key")).groupBy("fixture_id", "key").agg(F.min("team_id").alias("id"))
    for side in ("home", "away"):
        one = keyed.select("fixture_id", F.col("key").alias("__key"), F.col("id").alias(f"{side}_team_id"))
        matches = matches.withColumn("__key", normalize_name(F.col(f"{side}_team"), "alias")).join(one, ["fixture_id", "__key"], "left").drop("__key")
    return matches


def resolve_matches(requests: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Requests (request_id, match_date, home_team, away_team) with outcome and fixture_id.

    invalid: a name or the date is missing, or both names are one. matched: one fixture of that day has these sides in
    this order. ambiguous: several. reversed: only in the other order. missing: none. Equi-joins on day and names; each
    different spelling is normalised once.
    """
    sides = ("home_team", "away_team")
    spelled = None
    for df in (requests, fixtures):
        part = df.select(F.explode(F.array(*sides)).alias("spelling")).distinct()
        spelled = part if spelled is None else spelled.unionByName(part)
    spelled = spelled.where("spelling is not null").distinct()
    keys = if_small(spelled.select("spelling", normalize_name(F.col("spelling"), "alias").alias("key")))

    def keyed(df: DataFrame, names: tuple[str, str]) -> DataFrame:
        for side, name in zip(sides, names):
            df = df.join(keys.withColumnsRenamed({"spelling": side, "key": name}), side, "left")
        return df.withColumn("lo", F.least(*names)).withColumn("hi", F.greatest(*names))

    r = keyed(requests.select("request_id", "match_date", *sides), ("h", "a")).select("request_id", "match_date", "h", "a", "lo", "hi")
    valid = F.col("match_date").isNotNull() & (F.col("h") != "") & (F.col("a") != "") & (F.col("h") != F.col("a"))
    r = r.withColumn("valid", F.coalesce(valid, F.lit(False)))
    f = keyed(fixtures.select("fixture_id", F.to_date("fixture_date").alias("match_date"), *sides), ("fh", "fa"))
    joined = r.join(f.select("fixture_id", "match_date", "fh", "lo", "hi"), ["match_date", "lo", "hi"], "left")
    exact = F.col("fixture_id").isNotNull() & (F.col("fh") == F.col("h"))
    out = joined.groupBy("request_id").agg(F.first("valid").alias("valid"), F.count_if(exact).alias("exact"), F.count("fixture_id").alias("all"), F.min(F.when(exact, F.col("fixture_id"))).alias("id"))
    outcome = F.when(~F.col("valid"), "invalid").when(F.col("exact") == 1, "matched").when(F.col("exact") > 1, "ambiguous").when(F.col("all") > 0, "reversed").otherwise("missing")
    return out.select("request_id", outcome.alias("outcome"), F.when(outcome == "matched", F.col("id")).alias("fixture_id"))


def mutual_opponents(edges: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Pairs of teams (a < b) and the opponents both have met; edges are (team, opponent).

    With ``pairs`` (team_a, team_b, in any order) those alone (``shared_opponents``). Without, the result itself holds
    every pair of an opponent's rivals, so it grows with the square of the teams that met one opponent.
    """
    e = edges.select("team", "opponent").where("team is not null and opponent is not null").distinct()
    if pairs is not None:
        asked = pairs.select(F.least("team_a", "team_b").alias("team_a"), F.greatest("team_a", "team_b").alias("team_b"))
        return shared_opponents(asked, e).select("team_a", "team_b", "opponent")
    a, b = e.alias("a"), e.alias("b")
    return a.join(b, F.expr("a.opponent = b.opponent and a.team < b.team")).select(F.col("a.team").alias("team_a"), F.col("b.team").alias("team_b"), F.col("a.opponent").alias("opponent"))


def shared_opponents(pairs: DataFrame, edges: DataFrame, load: int = 10_000) -> DataFrame:
    """For each different pair (team_a, team_b) of two teams: the opponents both have met, with the edge of either as the
    structs ``a`` and ``b``. ``edges`` has one row for each (team, opponent), and any other columns.

    Of a pair, the team with fewer opponents lists them, and each is looked up among those of the other: a pair costs the
    shorter list, and no other pair is made. A team that more than ``load`` pairs ask for has its edges copied, one copy
    for each ``load`` pairs, and its pairs are dealt over the copies. Pairs without a shared opponent give no row.
    """
    asked = pairs.select("team_a", "team_b").where("team_a != team_b").distinct()
    loads = asked.select(F.explode(F.array("team_a", "team_b")).alias("team")).groupBy("team").agg(F.ceil(F.count("*") / load).cast("int").alias("salts"))
    teams = edges.groupBy("team").agg(F.count("*").alias("degree")).join(loads, "team")
    for side in "ab":
        asked = asked.join(teams.select(F.col("team").alias(f"team_{side}"), F.struct("team", "degree", "salts").alias(side)), f"team_{side}")
    flip = F.col("b.degree") < F.col("a.degree")
    asked = asked.select("team_a", "team_b", flip.alias("flip"), F.when(flip, F.col("b")).otherwise(F.col("a")).alias("few"), F.when(flip, F.col("a")).otherwise(F.col("b")).alias("many"))
    for side, other in (("few", "many"), ("many", "few")):
        asked = asked.withColumn(f"{side}_team", F.col(f"{side}.team")).withColumn(f"{side}_salt", F.pmod(F.xxhash64(f"{other}.team"), f"{side}.salts").cast("int"))
    copies = edges.join(loads, "team").select("team", "opponent", F.struct(*[F.col(c) for c in edges.columns]).alias("edge"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    few, many = (copies.withColumnsRenamed({"team": f"{s}_team", "salt": f"{s}_salt", "edge": f"{s}_edge"}) for s in ("few", "many"))
    met = asked.drop("few", "many").join(few, ["few_team", "few_salt"]).join(many, ["many_team", "many_salt", "opponent"])
    first, second = F.col("few_edge"), F.col("many_edge")
    return met.select("team_a", "team_b", "opponent", F.when(F.col("flip"), second).otherwise(first).alias("a"), F.when(F.col("flip"), first).otherwise(second).alias("b"))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows in a total order."""
    return df.orderBy(*order).limit(k)
