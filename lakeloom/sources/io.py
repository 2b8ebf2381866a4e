"""Reading, landing and writing tables."""

from __future__ import annotations

import json
import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold", "ops")
MINIMAL = ["fixture_id", "source_endpoint", "raw_payload", "response_hash", "ingested_at_utc"]


def is_path(target: str) -> bool:
    """Whether a target is a path rather than a table's name, from its shape."""
    return target.startswith(("/", "dbfs:")) or "://" in target or target.startswith("file:") or target.startswith("delta.`")


def layer_table(catalog: str, layers: dict[str, str], layer: str, name: str) -> str:
    """catalog.schema.name of a table of one of the layers."""
    if layer not in layers:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{catalog}.{layers[layer]}.{name}"


def read_target(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(target) if is_path(target) else spark.table(target)


def target_exists(spark: SparkSession, target: str, fmt: str = "parquet") -> bool:
    """Whether a table of that name, or readable data at that path, is there."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    try:
        spark.read.format(fmt).load(target).schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def write_target(df: DataFrame, target: str, mode: str = "append", overwrite_schema: bool = False, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Write to a path or table. ``overwrite_schema`` lets an overwrite change the columns where the format asks."""
    writer = df.write.format(fmt).mode(mode)
    if overwrite_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target) if is_path(target) else writer.saveAsTable(target)


def balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """``df`` dealt by the columns it is written by, large values over several tasks: each sorts and writes a share of about
    the session's advisory size, however many rows a value has."""
    return df.hint("rebalance", *partition_by)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Rebuild a table from ``df`` and return the written table, so that later reads don't compute it again."""
    write_target(df, name, "overwrite", overwrite_schema=True)
    return read_target(df.sparkSession, name)


def ensure_table(spark: SparkSession, name: str, ddl: str) -> None:
    """Create a table, and its schema, if they are missing."""
    if "." in name:
        spark.sql(f"create schema if not exists {name.rpartition('.')[0]}")
    spark.sql(f"create table if not exists {name} ({ddl}) using parquet")


def land_envelopes(payloads: DataFrame, *, run_id: str, endpoint: str, params: dict | None = None, target_date: date | None = None, key: str = "fixture_id", columns: str = "all", at: F.Column | None = None) -> DataFrame:
    """Raw payloads as rows of the landing table: request parameters with sorted keys, SHA-256 and time of ingest.

    ``payloads`` has the key and raw_payload, and may have target_date and api_status. ``columns='minimal'`` keeps five.
    """
    has = set(payloads.columns)
    when = F.col("target_date") if "target_date" in has else F.lit(target_date)
    rows = payloads.select(
        F.lit(run_id).alias("run_id"), F.col(key).cast("int").alias("fixture_id"), F.lit(endpoint).alias("source_endpoint"), F.lit(json.dumps(params or {}, sort_keys=True)).alias("request_params"),
        when.cast("date").alias("target_date"), "raw_payload", F.sha2("raw_payload", 256).alias("response_hash"), (F.col("api_status") if "api_status" in has else F.lit("OK")).alias("api_status"),
        (at if at is not None else F.current_timestamp()).alias("ingested_at_utc"),
    )
    return rows.select(*MINIMAL) if columns == "minimal" else rows


def land_eligibility(df: DataFrame, run_id: str) -> DataFrame:
    """Decisions on discovered rows, KEPT or SKIPPED, with the row they were made on. ``df`` has is_eligible."""
    status = F.when(F.col("is_eligible"), "KEPT").otherwise("SKIPPED")
    raw = F.to_json(F.struct(*[c for c in df.columns if c not in ("is_eligible", "reject_reason")]))
    return df.select(F.lit(run_id).alias("run_id"), F.to_date("fixture_date").alias("target_date"), F.col("fixture_id").cast("int").alias("fixture_id"), status.alias("eligibility_status"), "league_id", "league_name", "league_season", raw.alias("raw_fixture"), F.sha2(raw, 256).alias("response_hash"))


def quarantine(df: DataFrame, reason: F.Column, stage: str, payload: str = "raw_payload") -> DataFrame:
    """Dead-letter rows of ``df``: why and where each failed, with its payload and the payload's hash."""
    keep = [c for c in ("run_id", "fixture_id", "endpoint") if c in df.columns]
    return df.select(*keep, F.lit(stage).alias("stage"), reason.alias("reason"), F.col(payload).alias("raw_payload"), F.sha2(payload, 256).alias("response_hash"))


def load_seed(spark: SparkSession, path: str, schema: str, rename: dict[str, str] | None = None, as_of: date | None = None) -> DataFrame:
    """A CSV with a header, typed by ``schema``, columns renamed, with a constant as_of date if given."""
    df = spark.read.csv(path, header=True, schema=schema)
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    return df.withColumn("ranking_as_of_date", F.lit(as_of).cast("date")) if as_of else df


def land_json_window(df: DataFrame, root: str, start: date, end: date) -> DataFrame:
    """Write ``df`` as JSON lines for one window, replacing what an earlier run left, and read it back with inference."""
    path = f"{root}/window={start.isoformat()}_{end.isoformat()}"
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.json(path)


def land_json_windows(df: DataFrame, root: str, day: F.Column, windows: DataFrame) -> DataFrame:
    """Write ``df`` as JSON lines, a folder a window, in one job that reads ``df`` once however many windows there are;
    returns what ``root`` holds then, read by the declared schema, with the text column ``window``.

    ``windows`` has window_start and window_end, dates, both included. A row lands in each window that holds its
    ``day``; others land nowhere. Windows named are replaced, others stay, also if a run breaks off before its end. A
    window without rows leaves a mark, so that what it held before goes. Columns named like the two it adds are an error.
    """
    clash = {"window", "landed"} & set(df.columns)
    if clash:
        raise ValueError(f"columns of the landing itself: {', '.join(sorted(clash))}")
    label = F.concat_ws("_", F.date_format("window_start", "yyyy-MM-dd"), F.date_format("window_end", "yyyy-MM-dd"))
    spine = windows.select("window_start", "window_end").distinct().select(label.alias("window"), F.explode(F.sequence("window_start", "window_end")).alias("__day"))
    rows = df.withColumn("__day", day.cast("date")).join(spine, "__day").drop("__day").withColumn("landed", F.lit(True))
    marks = windows.select(label.alias("window"), F.lit(False).alias("landed")).distinct()
    rows.unionByName(marks, allowMissingColumns=True).write.partitionBy("window").option("partitionOverwriteMode", "dynamic").mode("overwrite").json(root)
    return read_json_windows(df.sparkSession, root, df.schema)


def read_json_windows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All landed rows below ``root`` in the shape of ``schema``, with their window; no look at the files for a schema."""
    declared = T.StructType([*schema.fields, T.StructField("landed", T.BooleanType()), T.StructField("window", T.StringType())])
    return spark.read.schema(declared).json(root).where("landed").drop("landed")


def land_split(df: DataFrame, predicate: F.Column, root: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Rows for which the predicate is true, and all others, written side by side below ``root`` in one pass over ``df``
    and read back, each from its own folder. An empty side has the columns too. A column ``split`` is an error."""
    if "split" in df.columns:
        raise ValueError("column of the landing itself: split")
    tag = F.when(F.coalesce(predicate, F.lit(False)), "valid").otherwise("rejected")
    df.withColumn("split", tag).write.format(fmt).mode("overwrite").partitionBy("split").save(root)
    both = df.sparkSession.read.format(fmt).schema(T.StructType([*df.schema.fields, T.StructField("split", T.StringType())])).load(root)
    return tuple(both.where(F.col("split") == side).drop("split") for side in ("valid", "rejected"))


def read_keyed_json(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """Rows key, value of files that each hold one JSON object keyed by an id."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string, {value_schema}>")).alias("key", "value"))


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the shape of ``schema``: missing columns null, nested ones recast through JSON, others cast, the rest
    dropped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name not in have:
            col = F.lit(None).cast(f.dataType)
        elif have[f.name] == f.dataType:
            col = F.col(f.name)
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            text = F.col(f.name) if isinstance(have[f.name], T.StringType) else F.to_json(f.name)
            col = F.from_json(text, f.dataType)
        elif isinstance(have[f.name], (T.StructType, T.ArrayType, T.MapType)):
            col = F.to_json(f.name)
        else:
            col = F.col(f.name).try_cast(f.dataType)
        out.append(col.alias(f.name))
    return df.select(*out)


def infer_payload_schema(df: DataFrame, col: str) -> str:
    """Kinds of the JSON documents in a column, merged over all rows; VARIANT where documents differ in kind."""
    return df.select(F.expr(f"schema_of_variant_agg(try_parse_json({col}))")).first()[0]


#: Parts of the text of an inferred schema that a Spark type writes otherwise; quoted names and names before a colon stay.
_KINDS = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<>(?!:)|\bOBJECT(?=<)|\b(?:VARIANT|VOID)\b(?!:)")


def payload_type(kinds: str | None) -> T.DataType:
    """Spark type of documents of these kinds (``infer_payload_schema``), for ``shape.parse_payload``.

    What differs in kind, is always null or is an object without fields becomes a string: parsing keeps its JSON text. No
    document at all: a struct without fields.
    """
    if not kinds or kinds in ("VOID", "OBJECT<>"):
        return T.StructType([])
    plain = {"OBJECT": "STRUCT"}
    return T.DataType.fromDDL(_KINDS.sub(lambda m: m[0] if m[0][0] == "`" else plain.get(m[0], "STRING"), kinds))


def parse_inferred(df: DataFrame, col: str = "raw_payload", out: str = "payload") -> DataFrame:
    """``df`` with its JSON column parsed by the type that all its documents share."""
    return df.withColumn(out, F.from_json(col, payload_type(infer_payload_schema(df, col))))
