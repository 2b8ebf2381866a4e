"""Payloads to rows: parsing, exploding, projecting, unpivoting, and spines of dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Schemas of the payloads.
PLAYER_PAYLOAD = "response array<struct<team struct<id int,name string>, players array<struct<player struct<id int,name string>, statistics array<struct<games struct<minutes int,position string>, shots struct<total int,on int>, goals struct<total int>>>>>>>"
FIXTURE_PAYLOAD = "response array<struct<fixture struct<id int,date string,status struct<short string,long string>,venue struct<name string,city string>>, league struct<id int,name string,season int,country string>, teams struct<home struct<id int,name string>,away struct<id int,name string>>, goals struct<home int,away int>>>"
_MEMBER = "array<struct<player struct<id int,name string,number int,pos string>>>"
LINEUP_PAYLOAD = f"response array<struct<team struct<id int,name string>, formation string, startXI {_MEMBER}, substitutes {_MEMBER}>>"


def parse_payload(df: DataFrame, schema: str, col: str = "raw_payload", out: str = "payload") -> DataFrame:
    """Parse a JSON column; documents that don't parse give nulls (see :func:`malformed`)."""
    return df.withColumn(out, F.from_json(col, schema))


def malformed(col: str = "raw_payload") -> F.Column:
    """Whether a column's text isn't JSON."""
    return F.col(col).isNotNull() & F.expr(f"try_parse_json({col})").isNull()


def flatten(df: DataFrame, steps: list[tuple[str, str]], outer: bool = True) -> DataFrame:
    """Explode arrays one inside the other: ``steps`` are (path of the array, name of its element)."""
    explode = F.explode_outer if outer else F.explode
    for path, name in steps:
        df = df.withColumn(name, explode(path))
    return df


def explode_tagged(df: DataFrame, arrays: dict[str, bool], element: str, tag: str) -> DataFrame:
    """One row for each element of several arrays, tagged by the array it comes from; the input is read once."""

    def tagged(path: str, value: bool):
        return F.transform(F.coalesce(F.col(path), F.array()), lambda x: F.struct(x.alias("e"), F.lit(value).alias("t")))

    parts = [tagged(path, value) for path, value in arrays.items()]
    return df.withColumn("__tagged", F.explode(F.concat(*parts))).withColumn(element, F.col("__tagged.e")).withColumn(tag, F.col("__tagged.t")).drop("__tagged")


def project_paths(df: DataFrame, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns from nested paths: alias to (path, type)."""
    return df.select(*[F.col(path).cast(kind).alias(alias) for alias, (path, kind) in paths.items()])


def leaf_columns(df: DataFrame, col: str, sep: str = "_") -> DataFrame:
    """``df`` with a struct column replaced by its leaves, named by their paths, fields of inner structs included; arrays
    and maps stay whole. Two leaves of one name, or a leaf named like another column of ``df``, are an error."""

    def leaves(kind: T.DataType, value: F.Column, path: list[str]):
        if not isinstance(kind, T.StructType):
            return [(sep.join(path), value)]
        return [x for f in kind.fields for x in leaves(f.dataType, value.getField(f.name), [*path, f.name])]

    found = leaves(df.schema[col].dataType, F.col(f"`{col}`"), [])
    names = [c for c in df.columns if c != col] + [name for name, _ in found]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"columns of one name: {', '.join(repeated)}")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != col], *[value.alias(name) for name, value in found])


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all known."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df``, or an error that names the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_defaults(df: DataFrame, values: dict, coalesce: bool = False) -> DataFrame:
    """Constant columns, or with ``coalesce`` existing ones with their nulls replaced."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if coalesce else F.lit(v) for c, v in values.items()})


def unpivot_sides(df: DataFrame, shared: list[str], home: dict[str, str], away: dict[str, str]) -> DataFrame:
    """Two rows for each of ``df``, one a side: ``home`` and ``away`` map new names to columns. The input is read once."""
    side = lambda names, is_home: F.struct(*[F.col(c).alias(n) for n, c in names.items()], F.lit(is_home).alias("is_home"))
    return df.select(*shared, F.explode(F.array(side(home, True), side(away, False))).alias("__side")).select(*shared, "__side.*")


def daily_dates(spark: SparkSession, start: date, end: date) -> DataFrame:
    """All dates from start to end."""
    if end < start:
        raise ValueError("end lies before start")
    return spark.sql(f"select explode(sequence(date'{start}', date'{end}')) as day")


def date_windows(spark: SparkSession, start: date, end: date, days: int = 7) -> DataFrame:
    """Windows of ``days`` days from start, the last one cut at end."""
    if end < start or days < 1:
        raise ValueError("windows need end >= start and at least one day")
    first = spark.sql(f"select explode(sequence(date'{start}', date'{end}', make_interval(0, 0, 0, {days}))) as window_start")
    return first.withColumn("window_end", F.least(F.date_add("window_start", days - 1), F.lit(end)))
