"""Keyed tables kept as increments: a merge writes its rows alone, and one small manifest tells which increments count.

A table is a folder with increments (Parquet, one folder each) and a log of manifests, one file a version. A manifest
lists the increments with their rows, key range, schema and version, the table's schema and rules, and marks that went in
with the same merge. A version is taken by creating its file, which fails where another writer was first: that writer's
manifest is read and the change made on top of it, so of two writers at once neither loses a row.

Small increments are merged with one another, FAN of about a size at a time, and never with ones eight times larger, so
a merge costs what it holds and its share of as many rewrites as the table has tiers.
"""

from __future__ import annotations

import json
import math
import os
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Increments of one tier that are merged into one; a tier holds increments of up to eight times the rows of the one below.
FAN = 8
#: Versions whose manifests stay, for readers that began before the newest.
KEPT_VERSIONS = 20
#: Rows of increments up to which the table's largest one is read without a shuffle, its touched keys looked up.
LOOKED_UP = 1_000_000
#: Rows that a task resolves; where the session's shuffle partitions would hold more, rows are dealt over more of them.
TASK_ROWS = 500_000
#: Types of a first key whose range a manifest can hold.
RANGED = ("byte", "short", "integer", "long", "string")


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores before it until no column is called so, whatever the case."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def same_keys(a: str, b: str, keys: Sequence[str]) -> F.Column:
    """Whether rows of two aliases have equal keys; nulls are equal to each other."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`")) for k in keys])


class _Log:
    """Manifests by version in a folder that all drivers share.

    A file is written whole beside its place and then put there by a link (a folder of this machine) or a rename that
    fails where the name is taken (as HDFS does): a store without such a rename can't decide between two writers.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._folder = spark._jvm, folder
        self._path = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path.getFileSystem(self._conf)

    def versions(self) -> list[int]:
        if not self._fs.exists(self._path):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._file(f"{version:020d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def add(self, version: int, manifest: dict) -> bool:
        """Whether ``manifest`` became that version; False where another one did."""
        text, target, waiting = json.dumps(manifest), f"{version:020d}.json", f"waiting-{uuid.uuid4().hex}"
        self._fs.mkdirs(self._path)
        if self._fs.getUri().getScheme() == "file":
            folder = self._path.toUri().getPath()
            with open(f"{folder}/{waiting}", "w") as f:
                f.write(text)
            try:
                os.link(f"{folder}/{waiting}", f"{folder}/{target}")
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(f"{folder}/{waiting}")
        out = self._fs.create(self._file(waiting), True)
        out.write(bytearray(text.encode()))
        out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        how[0] = rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path.toUri(), self._conf).rename(self._file(waiting), self._file(target), how)
            return True
        except Exception:
            self._fs.delete(self._file(waiting), False)
            if self._fs.exists(self._file(target)):
                return False
            raise

    def drop(self, version: int) -> None:
        self._fs.delete(self._file(f"{version:020d}.json"), False)


class IncrementTable:
    """A table at ``path`` with one row for each key (null keys are equal to each other).

    Of a key's rows the one with the greatest value of column ``order`` counts, nulls last; of equal ones, and without
    ``order``, that of the later merge. ``first`` names a column and a value that come before all that: a row which has it
    is not replaced by one that doesn't, unless that one was merged with ``force``. ``rules`` name columns that are gathered
    over all rows of the key instead: ``sum``, ``min`` or ``max``. Rules hold for reads and for compaction alike.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: str | None = None, rules: dict[str, str] | None = None, first: tuple[str, str] | None = None):
        self.spark, self.path, self._log = spark, path, _Log(spark, f"{path}/log")
        self.setup = {"keys": list(keys), "order": order, "rules": dict(rules or {}), "first": list(first) if first else None}
        self.keys, self.order, self.rules, self.first = list(keys), order, dict(rules or {}), first
        head = self.head()
        if head and head["setup"] != self.setup:
            raise ValueError(f"{path} is kept by {head['setup']}, not by {self.setup}")

    # --- manifests ---

    def head(self) -> dict | None:
        """The newest manifest; None before the first merge."""
        versions = self._log.versions()
        return self._log.read(versions[-1]) if versions else None

    def marks(self) -> dict:
        """What merges have noted beside their rows."""
        return (self.head() or {}).get("marks", {})

    def _change(self, change: Callable[[dict], dict | None]) -> dict:
        """Make ``change`` on the newest manifest the next version, on the other writers' versions if they are first."""
        while True:
            head = self.head() or {"version": 0, "setup": self.setup, "schema": None, "increments": [], "marks": {}}
            version = head["version"] + 1
            new = change(dict(head))
            if new is None:
                return head
            if self._log.add(version, new | {"version": version}):
                if version > KEPT_VERSIONS:
                    self._log.drop(version - KEPT_VERSIONS)
                return new | {"version": version}

    # --- writing ---

    def _write(self, rows: DataFrame, seq: str | None, reset: str | None, once: bool) -> dict:
        """One more increment, which no manifest names yet, with its size, its key range and whether a key comes twice
        (not looked at where ``once`` says that ``rows`` were made one a key)."""
        folder = uuid.uuid4().hex
        rows.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        keys, count = [F.col(f"`{k}`") for k in self.keys], fresh("rows_of_key", self.keys)
        low = keys[0] if rows.schema[self.keys[0]].dataType.typeName() in RANGED else F.lit(None).cast("string")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}")
        held = written.select(*keys, F.lit(1).alias(count)) if once else written.groupBy(*keys).agg(F.count("*").alias(count))
        size = held.agg(F.coalesce(F.sum(count), F.lit(0)).alias("rows"), F.coalesce(F.max(count), F.lit(0)).alias("most"), F.min(low).alias("low"), F.max(low).alias("high"))
        return size.first().asDict() | {"folder": folder, "schema": rows.schema.jsonValue(), "seq": seq, "reset": reset}

    def merge(self, source: DataFrame, force: bool = False, add_columns: bool = False, marks: dict | None = None) -> dict:
        """Upsert ``source`` and return the new manifest; a call that breaks off before has changed nothing.

        With ``order`` the newest of a key's rows in ``source`` counts; without, a key that it has twice is an error. A
        column that the table lacks is an error unless ``add_columns`` (older rows have null there then), and so is one
        that ``source`` lacks. Values are cast to the table's types where that loses nothing. ``marks`` are noted in the
        same step as the rows.
        """
        head = self.head()
        fields = self._fields(head["schema"] if head else None, source, add_columns)
        rows = source.select(*[F.col(f"`{f.name}`") for f in fields]).to(StructType(fields))
        once = self.order is not None and not self.rules
        if once:
            place = fresh("place", rows.columns)
            newest = Window.partitionBy(*[F.col(f"`{k}`") for k in self.keys]).orderBy(F.desc_nulls_last(f"`{self.order}`"), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
            rows = rows.withColumn(place, F.row_number().over(newest)).where(F.col(place) == 1).drop(place)
        increment = self._write(rows, None, None, once) | {"force": force}
        if increment.pop("most") > 1:
            raise ValueError("the source holds a key more than once")

        def change(head: dict) -> dict:
            known = self._fields(head["schema"], source, add_columns)  # another writer may have added columns
            head["schema"] = StructType([StructField(f.name, f.dataType, True) for f in known]).jsonValue()
            if increment["rows"]:
                head["increments"] = [*head["increments"], increment | {"version": head["version"] + 1}]
            head["marks"] = head["marks"] | (marks or {})
            return head

        new = self._change(change)
        return self._compact(new)

    def _fields(self, schema: dict | None, source: DataFrame, add_columns: bool) -> list[StructField]:
        """The table's columns after a merge of ``source``."""
        given = [StructField(f.name, f.dataType, True) for f in source.schema.fields]
        known = StructType.fromJson(schema).fields if schema else []
        names = {f.name for f in known}
        more, lost = [f for f in given if f.name not in names], sorted(names - set(source.columns))
        if known and lost:
            raise ValueError(f"the source lacks columns of the table: {lost}")
        if known and more and not add_columns:
            raise ValueError(f"the table lacks columns of the source: {[f.name for f in more]}")
        missing = [c for c in [*self.keys, self.order, *self.rules, *(self.first or [])[:1]] if c and c not in names | {f.name for f in given}]
        if missing:
            raise ValueError(f"keys and rules name columns that aren't there: {missing}")
        return known + more

    def compact(self) -> dict:
        """Merge all increments into one, which merges alone never do."""
        return self._compact(self.head(), whole=True)

    def _compact(self, head: dict, whole: bool = False) -> dict:
        """Merge tiers that are full, each into one increment; what another writer has changed meanwhile is left to it."""
        while True:
            tiers: dict[int, list[dict]] = {}
            for i in head["increments"]:
                tiers.setdefault(0 if whole else i["rows"].bit_length() // 3, []).append(i)
            full = next((t for _, t in sorted(tiers.items()) if len(t) >= (2 if whole else FAN)), None)
            if full is None:
                return head
            schema = StructType.fromJson(head["schema"])
            seq, reset = fresh("seq", schema.names), fresh("reset", schema.names)
            merged = self._write(self._resolve(self._union(full, schema, seq, reset), schema, seq, reset, sum(i["rows"] for i in full)), seq, reset, True)
            merged |= {"force": False, "version": max(i["version"] for i in full)}
            gone = {i["folder"] for i in full}

            def change(head: dict) -> dict | None:
                if not gone <= {i["folder"] for i in head["increments"]}:
                    return None
                head["increments"] = [i for i in head["increments"] if i["folder"] not in gone] + [merged]
                return head

            head = self._change(change)
            if merged["folder"] not in {i["folder"] for i in head["increments"]}:
                return head

    def vacuum(self) -> list[str]:
        """Delete increments that no kept manifest names, and tell which. Not beside merges: theirs aren't named yet."""
        named = {i["folder"] for v in self._log.versions() for i in self._log.read(v)["increments"]}
        path = self._log._jvm.org.apache.hadoop.fs.Path(self.path)
        found = [s.getPath().getName() for s in self._log._fs.listStatus(path)]
        gone = [f for f in found if f != "log" and f not in named]
        for folder in gone:
            self._log._fs.delete(self._log._jvm.org.apache.hadoop.fs.Path(path, folder), True)
        return gone

    # --- reading ---

    def _union(self, increments: list[dict], schema: StructType, seq: str, reset: str) -> DataFrame:
        """Rows of increments with the version that merged each, and the last forced one its key has seen (0: none)."""
        parts = []
        for i in increments:
            kind = StructType.fromJson(i["schema"])
            rows = self.spark.read.schema(kind).parquet(f"{self.path}/{i['folder']}")
            cols = [(F.col(f"`{f.name}`") if f.name in kind.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
            at = F.col(f"`{i['seq']}`") if i["seq"] else F.lit(i["version"]).cast("long")
            since = F.col(f"`{i['reset']}`") if i["reset"] else F.lit(i["version"] if i["force"] else 0).cast("long")
            parts.append(rows.select(*cols, at.alias(seq), since.alias(reset)))
        if not parts:
            empty = StructType([*schema.fields, StructField(seq, LongType()), StructField(reset, LongType())])
            return self.spark.createDataFrame([], empty)
        return reduce(DataFrame.unionAll, parts)

    def _resolve(self, rows: DataFrame, schema: StructType, seq: str, reset: str, size: int) -> DataFrame:
        """One row a key by the table's rules, with ``seq`` and ``reset``: what it gives, later rows can be resolved with.

        ``size`` bounds the number of ``rows``. Past TASK_ROWS a partition they are dealt over as many as they need, so no
        task sorts, and spills, a share that grows with the table; an increment has a key once, so grouping it before the
        shuffle would save nothing.
        """
        keys = [F.col(f"`{k}`") for k in self.keys]
        parts = math.ceil(size / TASK_ROWS)
        if parts > int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            rows = rows.repartition(parts, *keys)
        rank = [F.col(seq)]
        if self.order is not None:
            rank.insert(0, F.col(f"`{self.order}`"))
        if self.first:
            rank.insert(0, F.coalesce(F.col(f"`{self.first[0]}`") == self.first[1], F.lit(False)))
            live = fresh("live", [*schema.names, seq, reset])
            rows = rows.withColumn(live, F.col(seq) >= F.max(reset).over(Window.partitionBy(*keys)))
            rank.insert(0, F.col(live))
        chosen = [f.name for f in schema.fields if f.name not in self.keys and f.name not in self.rules]
        best = fresh("best", [*schema.names, seq, reset])
        state = F.max_by(F.struct(*[F.col(f"`{c}`") for c in chosen], F.col(seq)), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)]))
        gathered = [getattr(F, how)(F.col(f"`{c}`")).cast(schema[c].dataType).alias(c) for c, how in self.rules.items()]
        out = rows.groupBy(*keys).agg(state.alias(best), *gathered, F.max(reset).alias(reset))
        cols = [F.col(f"{best}.`{n}`").alias(n) if n in chosen else F.col(f"`{n}`") for n in schema.names]
        return out.select(*cols, F.col(f"{best}.`{seq}`").alias(seq), reset)

    def read(self, low: str | int | None = None, high: str | int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """The table; with bounds, only rows whose first key lies between them (read from increments that may hold such).

        The largest increment holds a key once. If the others together have at most LOOKED_UP rows, their keys are looked
        up in it and only rows that meet are resolved, the rest passes without a shuffle; else one shuffle resolves all.
        With ``columns`` only those are read, shuffled and given, in their order.
        """
        head = self.head()
        if head is None:
            raise ValueError(f"nothing was merged into {self.path} yet")
        schema = StructType.fromJson(head["schema"])
        if columns is not None:  # those, and what tells which of a key's rows counts
            needed = {*self.keys, self.order, *(self.first or [])[:1], *columns}
            schema = StructType([f for f in schema.fields if f.name in needed])
            if lost := sorted(set(columns) - set(schema.names)):
                raise ValueError(f"the table lacks columns: {lost}")
        seq, reset = fresh("seq", schema.names), fresh("reset", schema.names)
        increments, key = head["increments"], F.col(f"`{self.keys[0]}`")
        if schema[self.keys[0]].dataType.typeName() in RANGED:  # an increment without a range holds null keys alone
            if low is not None:
                increments = [i for i in increments if i["high"] is not None and i["high"] >= low]
            if high is not None:
                increments = [i for i in increments if i["low"] is not None and i["low"] <= high]
        largest = max(increments, key=lambda i: i["rows"], default=None)
        rest = [i for i in increments if i is not largest]
        if not rest or sum(i["rows"] for i in rest) > LOOKED_UP:
            rows = self._union(increments, schema, seq, reset)
            rows = self._resolve(rows, schema, seq, reset, sum(i["rows"] for i in increments)) if rest else rows
        else:
            base, new = self._union([largest], schema, seq, reset), self._union(rest, schema, seq, reset)
            touched = F.broadcast(new.select(*[F.col(f"`{k}`") for k in self.keys]).distinct()).alias("t")  # at most LOOKED_UP
            met = base.alias("b").join(touched, same_keys("b", "t", self.keys), "left_semi")
            kept = base.alias("b").join(touched, same_keys("b", "t", self.keys), "left_anti")
            rows = kept.unionAll(self._resolve(met.unionAll(new), schema, seq, reset, 2 * sum(i["rows"] for i in rest)))
        rows = rows.select(*[F.col(f"`{n}`") for n in schema.names])
        if low is not None:
            rows = rows.where(key >= F.lit(low))
        rows = rows.where(key <= F.lit(high)) if high is not None else rows
        return rows if columns is None else rows.select(*[F.col(f"`{n}`") for n in columns])
