"""Checks of tables: each returns the failing rows, and a suite counts them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*cols).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def unique(df: DataFrame, col: str) -> DataFrame:
    return unique_combination(df.where(F.col(col).isNotNull()), [col])


def relationships(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of ``child`` whose key ``parent`` lacks; null keys are not checked."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key or key).alias(key)).distinct(), key, "left_anti")


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row a table with its number of rows."""
    return reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name, df in tables.items()])


def run_checks(suite: dict[str, DataFrame]) -> DataFrame:
    """One row a check: its name, how many rows fail it, and whether it passed; each check reads its table anew, so use
    :func:`run_suite` where checks share tables."""
    counts = table_counts(suite)
    return counts.select(F.col("table_name").alias("check_name"), F.col("n_rows").alias("failing_rows"), (F.col("n_rows") == 0).alias("passed"))


@dataclass(frozen=True)
class Check:
    """A check of ``table``. kind: not_null, accepted_values (``values``), unique, unique_combination, relationships
    (``columns`` must occur as ``parent_columns`` of ``parent``)."""

    table: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()


def run_suite(tables: dict[str, DataFrame], checks: dict[str, Check]) -> DataFrame:
    """One row a check, as :func:`run_checks` gives, with one pass over each table and one shuffle in all.

    A row is passed on once for each key that some check asks about, and once for the rows' own checks. Rows of equal keys
    are counted in the tasks that read them, so what is shuffled is one row a task and different key; the keys of a
    parent and its children meet in one group, which tells both repeats and missing parents. Keys are compared as
    text, so both sides of a relationship should have one type. Failing are: rows (not_null, accepted_values,
    relationships) and keys that repeat (unique, unique_combination). Null keys fail no unique and no relationship, but
    are one key to unique_combination. Empty tables pass; a table that no check names isn't read.
    """
    members: dict[tuple, int] = {}  # (domain of keys, table, columns): number
    used: dict[str, tuple[int, int | None]] = {}
    for name, c in checks.items():
        if c.kind == "relationships":
            domain = (c.parent, c.parent_columns or c.columns)
            used[name] = tuple(members.setdefault((domain, *m), len(members)) for m in ((c.table, c.columns), domain))
        elif c.kind in ("unique", "unique_combination"):
            used[name] = (members.setdefault(((c.table, c.columns), c.table, c.columns), len(members)), None)
        elif c.kind not in ("not_null", "accepted_values"):
            raise ValueError(f"unknown check {c.kind!r}")
    domains = {d: i for i, d in enumerate(dict.fromkeys(m[0] for m in members))}
    own = {name: i for i, name in enumerate(n for n, c in checks.items() if n not in used)}

    def fails(c: Check) -> Column:
        if c.kind == "not_null":
            return reduce(lambda a, b: a | b, [F.col(x).isNull() for x in c.columns])
        return reduce(lambda a, b: a | b, [F.coalesce(~F.col(x).isin(list(c.values)), F.lit(False)) for x in c.columns])

    def entry(domain: int, member: int, key: Column, failing: Column) -> Column:
        return F.struct(F.lit(domain).alias("domain"), F.lit(member).alias("member"), key.alias("key"), failing.alias("failing"))

    no_key, none = F.lit(None).cast("array<string>"), F.array().cast("array<int>")
    parts = []
    for table, df in tables.items():
        entries = [entry(domains[d], n, F.array(*[F.col(x).cast("string") for x in cols]), none) for (d, t, cols), n in members.items() if t == table]
        mine = [F.when(fails(checks[n]), F.lit(i)) for n, i in own.items() if checks[n].table == table]
        if mine:
            entries.append(entry(-1, -1, no_key, F.array_compact(F.array(*mine))))
        if entries:
            parts.append(df.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    counts = [F.count_if(F.col("member") == n).alias(f"n_{n}") for n in members.values()] + [F.count_if(F.array_contains("failing", i)).alias(f"own_{i}") for i in own.values()]
    keys = reduce(DataFrame.unionByName, parts).groupBy("domain", "key").agg(*counts)
    known = F.coalesce(F.forall("key", lambda k: k.isNotNull()), F.lit(False))

    def failing(name: str, c: Check) -> Column:
        if name in own:
            return F.sum(f"own_{own[name]}")
        child, parent = used[name]
        if parent is not None:
            return F.sum(F.when(known & (F.col(f"n_{parent}") == 0), F.col(f"n_{child}")))
        repeated = F.col(f"n_{child}") > 1
        return F.count_if(repeated & known if c.kind == "unique" else repeated)

    rows = [F.struct(F.lit(n).alias("check_name"), F.coalesce(failing(n, c), F.lit(0)).cast("bigint").alias("failing_rows")) for n, c in checks.items()]
    return keys.agg(F.array(*rows).alias("r")).select(F.inline("r")).withColumn("passed", F.col("failing_rows") == 0)
