"""Merkle manifest of a dataset: one digest for all rows, and a proof for each row that it belongs under that digest.

Every row is a leaf; the leaves of a group (here: a language) in order make a binary hash tree, its top the group's
digest, and those in order of the groups another tree, its top the root. The tree is stored as records from digest to
children, LEVELS levels in a record: a node's digest, and all digests below it down to the record's lowest level, which
are the keys of further records. A request for a leaf descends from the root by the digits of its rank; in each record
it leaves the unselected children of its path behind, and the path segments in reverse are the proof, leaf first.

Requests that go the same way descend as one, so a record high up is read once however many leaves are asked for.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakeloom.llm.common import id_text, pick, small_side, written

#: Binary levels of a record: at most 2 ** LEVELS children, 128 kB of digests with those between.
LEVELS = 10
#: The columns a leaf's digest covers, in this order.
COVERED = ["doc_id", "source", "lang", "n_chars", "text"]


def leaf_digest(covered: list[str] = COVERED, changed: dict | None = None) -> F.Column:
    """sha256 of the columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value; hex text. ``changed``
    puts another expression in a column's place."""
    parts = []
    for name in covered:
        value = (changed or {}).get(name, F.col(f"`{name}`")).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0 on within ``group`` by ``order`` (nulls first, bytewise), and ``members``, the
    group's size. Sorted ranges are written and numbered from their sizes, so a group of any size is spread over tasks;
    equal rows may stand either way."""
    keys = [group, *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed = written(placed.withColumn("part", F.spark_partition_id()), "merkle-ranks")
    sizes = placed.groupBy(F.col(group).alias("in_group"), F.col("part").alias("in_part")).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    # A row for each range and group in it: no more than ranges and groups together.
    before = Window.partitionBy("in_group").orderBy("in_part")
    bases = sizes.select(
        "in_group", "in_part", "first", (F.sum("rows").over(before) - F.col("rows")).alias("base"), F.sum("rows").over(Window.partitionBy("in_group")).alias("members"),
    )
    found = placed.join(small_side(bases), (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("in_group")))
    return found.select(*rows.columns, (F.col("at") - F.col("first") + F.col("base")).alias("rank"), "members")


def _parents(nodes: list[bytes]) -> list[bytes]:
    """Digests of every two consecutive nodes, of a last one alone by itself; all are hex texts."""
    return [hashlib.sha256(b"".join(nodes[i : i + 2])).hexdigest().encode() for i in range(0, len(nodes), 2)]


def _height(members: int, start: int, levels: int) -> int:
    """Levels of a record that stands ``start`` levels above the leaves: enough for one node to remain in its group."""
    return min(levels, (members - 1).bit_length() - start)


def _several(level: int) -> F.Column:
    """Whether a group has more than one node at a level."""
    return F.col("members") > F.lit(1 << level)


def _close(start: int, levels: int):
    """Rows (grp, block, members, nodes: digests by rank) as records of their subtrees."""

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                members, nodes = batch.column(2)[row].as_py(), [n.encode() for n in batch.column(3)[row].as_py()]
                level, below = nodes, []
                for _ in range(_height(members, start, levels)):
                    below += level
                    level = _parents(level)
                columns = [pa.array([len(nodes)], pa.int32()), pa.array([level[0].decode()]), pa.array([b"".join(below)], pa.binary())]
                yield pa.RecordBatch.from_arrays([c.slice(row, 1) for c in batch.columns[:3]] + columns, names=["grp", "block", "members", "width", "digest", "below"])

    return run


def _turn(start: int, levels: int, names: list[str]):
    """Rows (grp, members, top, digest, path, width, below, asked) as a row for each asked rank: the child it leads to,
    and the path with this record's segment, highest level first. Ranks beyond the record's width are left out."""

    def segment(below: bytes, width: int, height: int, digit: int) -> list[str]:
        at, out = 0, []
        for level in range(height):
            i, size = digit >> level, (width + (1 << level) - 1) >> level
            other = at + 64 * (i ^ 1)
            out.append("-" if i ^ 1 >= size else "RL"[i & 1] + below[other : other + 64].decode())
            at += 64 * size
        return out[::-1]

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                grp, members, top, digest, path, width, below = (c[row].as_py() for c in batch.columns[:7])
                asked = batch.column(7)[row].values
                digits = [r & ((1 << levels) - 1) for r in asked.field("rank").to_pylist()]
                width, height = (width, _height(members, start, levels)) if below is not None else (1, 0)
                keep = [i for i, d in enumerate(digits) if d < width]
                asked, digits = asked.take(pa.array(keep, pa.int64())), [digits[i] for i in keep]
                found = [below[64 * d : 64 * d + 64].decode() if below is not None else digest for d in digits]
                paths = [path + segment(below, width, height, d) for d in digits]
                shared = [pa.array([v] * len(keep), t) for v, t in ((grp, pa.string()), (members, pa.int64()), (top, pa.string()))]
                own = [asked.field(n) for n in names]
                yield pa.RecordBatch.from_arrays([*shared, pa.array(found, pa.string()), pa.array(paths, pa.list_(pa.string())), *own], names=["grp", "members", "top", "digest", "path", *names])

    return run


class MerkleTree:
    """Hash trees over ``leaves`` (grp, never null; rank; members; digest), one for each group.

    ``records`` by depth, from the leaves up, are (digest, width, below), one for each stored subtree, equal ones once;
    ``tops`` (grp, members, digest) are the groups' digests. A lone leaf is its group's digest and needs no record. Each
    turn of the loop closes ``levels`` levels of all groups by one shuffle of a digest a node: four turns hold 10 ** 12
    leaves.
    """

    def __init__(self, leaves: DataFrame, levels: int = LEVELS):
        deepest = leaves.agg(F.max("members")).first()[0] or 0
        nodes, self.levels, self.records = leaves.select("grp", "rank", "members", "digest"), levels, []
        tops = leaves.where("members = 1").select("grp", "members", "digest")
        for start in range(0, max(0, deepest - 1).bit_length(), levels):
            blocks = nodes.where(_several(start)).groupBy("grp", F.shiftright("rank", levels).alias("block"), "members")
            # At most 2 ** levels digests a block.
            of_block = blocks.agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))
            closed = of_block.select("grp", "block", "members", "nodes.digest").mapInArrow(_close(start, levels), "grp string, block long, members long, width int, digest string, below binary")
            closed = written(closed, f"merkle-level{start}")
            tops = tops.unionByName(closed.where(_several(start) & ~_several(start + levels)).select("grp", "members", "digest"))
            nodes = closed.select("grp", F.col("block").alias("rank"), "members", "digest")
            self.records.append(closed.groupBy("digest").agg(F.first("width").alias("width"), F.first("below").alias("below")))
        self.tops = tops

    def descend(self, tops: DataFrame, requests: DataFrame) -> DataFrame:
        """``requests`` (grp, rank and further columns) with the leaf ``digest`` they reach, the ``top`` they started
        from, ``members`` and ``path``.

        ``tops`` (grp, members, digest, path) are the nodes to start from and the path that led to them. A path goes
        from there to the leaf: ``L`` or ``R`` and the digest of the unselected child on that side, ``-`` where there is
        none. Requests for ranks or groups that don't exist are left out.
        """
        levels, extra = self.levels, [c for c in requests.columns if c != "grp"]
        frontier = tops.select("grp", "members", F.col("digest").alias("top"), "digest", "path", F.lit(0).cast("long").alias("rank"))
        for depth in reversed(range(max(1, len(self.records)))):
            # Above the leaves, those children are asked for below which requests lie, each once.
            below = requests if depth == 0 else requests.select("grp", F.shiftright("rank", levels * depth).alias("rank")).distinct()
            names = extra if depth == 0 else ["rank"]
            asked = below.groupBy("grp", F.shiftright("rank", levels).alias("block")).agg(F.collect_list(F.struct(*names)).alias("asked"))
            here = (frontier if depth == 0 else frontier.where(_several(levels * depth))).withColumnRenamed("rank", "block")
            if self.records:
                here = here.join(self.records[depth], "digest", "left")
            else:
                here = here.withColumns({"width": F.lit(None).cast("int"), "below": F.lit(None).cast("binary")})
            here = here.join(asked, ["grp", "block"]).select("grp", "members", "top", "digest", "path", "width", "below", "asked")
            fields = requests.select(*names).schema.fields
            schema = StructType([*here.schema.fields[:5], *[StructField(f.name, f.dataType) for f in fields]])
            turned = here.mapInArrow(_turn(levels * depth, levels, names), schema)
            # A row for each record reached: written, as the next turn reads it twice.
            frontier = turned if depth == 0 else written(frontier.where(~_several(levels * depth)).unionByName(turned), "merkle-frontier")
        return frontier


def proof_digest(path: F.Column) -> F.Column:
    """sha256 of the siblings of a path, in its order."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.substring(p, 2, 64)), "").cast("binary"), 256)


def fold(leaf: F.Column, path: F.Column) -> F.Column:
    """The root that a leaf digest and its path, leaf first, lead to."""

    def up(node, step):
        other = F.substring(step, 2, 64)
        return F.sha2(F.when(step.startswith("L"), F.concat(other, node)).otherwise(F.concat(node, other)).cast("binary"), 256)

    return F.reduce(path, leaf, up)


class Manifest:
    """The Merkle manifest of a table.

    ``rows`` are the table's rows as ``grp`` (the group's key), ``rank``, ``members``, ``digest`` and the columns ``keep``.
    Groups go by a column of texts, null first, then bytewise; rows of a group by ``order``, nulls first, equal ones
    by their digests. Repeated rows are leaves of their own. ``root`` is null for an empty table.
    """

    def __init__(self, docs: DataFrame, group: str = "lang", order: str = "doc_id", keep: dict | None = None, covered: list[str] = COVERED, levels: int = LEVELS):
        self.keep = list(keep or {})
        key = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`")), F.lit(""))  # null before every text
        leaves = docs.select(key.alias("grp"), F.col(f"`{order}`").alias("place"), leaf_digest(covered).alias("digest"), *[c.alias(n) for n, c in (keep or {}).items()])
        self.rows = ranked(written(leaves, "merkle-leaves"), "grp", ["place", "digest"])
        self.tree = MerkleTree(self.rows, levels)
        tops = self.tree.tops.withColumnRenamed("members", "leaves").withColumn("of", F.lit(""))
        self.groups = ranked(tops, "of", ["grp"])
        self.crown = MerkleTree(self.groups.select(F.col("of").alias("grp"), "rank", "members", "digest"), levels)
        top = self.crown.tops.first()
        self.root = top.digest if top else None

    def prove(self, requests: DataFrame) -> DataFrame:
        """``requests`` (grp, rank, further columns) with their ``leaf``, ``subroot`` and ``path``, the siblings from the
        leaf up to the root (see :func:`fold`)."""
        start = self.crown.tops.withColumn("path", F.array().cast("array<string>"))
        groups = written(self.crown.descend(start, self.groups.select(F.col("of").alias("grp"), "rank", F.col("grp").alias("name"), "leaves")), "merkle-groups")
        tops = groups.select(F.col("name").alias("grp"), F.col("leaves").alias("members"), "digest", "path")
        found = self.tree.descend(tops, requests)
        return found.withColumnsRenamed({"digest": "leaf", "top": "subroot"}).withColumn("path", F.reverse("path")).drop("members")


def manifest_digest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Rows whose number's crc32 is divisible
    by seven are folded with one character more than they have (a null count stays null)."""
    plus_one = leaf_digest(changed={"n_chars": F.col("n_chars") + 1})
    struck = F.when(F.crc32(id_text(F.col("doc_id")).cast("binary")) % 7 == 0, plus_one)
    manifest = Manifest(pick(docs, *COVERED), keep={"doc_id": F.col("doc_id"), "struck": struck}, levels=levels)
    proved = manifest.prove(manifest.rows.select("grp", "rank", "doc_id", "struck"))
    folded = proved.select(
        "doc_id", "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("struck", "leaf"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
