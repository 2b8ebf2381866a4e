"""Near-duplicate groups: MinHash bands propose pairs, Bayesian verification compares their signatures batch by batch and
drops a pair as soon as the posterior chance that it is similar enough falls below a chosen miss probability, and the
survivors are verified on their full shingle sets. Linked documents form components.

No group of copies meets in one task or as pairs: equal sets count as one document from the start; every bucket of a band
first compares its members with one hub only; what that leaves apart is compared between components alone, large buckets
in blocks that ship their sets and compare inside the task.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import byte_chunks, mix64, ngram_hashes, pick, small_side, text_bytes, word_hashes, written

#: Chance to miss a pair at the threshold, in the bands and again in the verification.
MISS = 1e-6
#: Signature length at most, and places compared at a time.
HASHES, BATCH = 128, 8
#: Members up to which a bucket's remaining pairs are listed; larger buckets are compared in blocks of these sizes.
LISTED, BLOCK_LEFT, BLOCK_ALL = 32, 256, 1024

_MULTIPLIERS = np.random.default_rng(7).integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)


def bands_for(threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bands and rows of a band: the longest rows for which ``bands * rows`` places find a pair at the threshold with
    probability 1 - miss."""
    for rows in range(10, 0, -1):
        bands = math.ceil(math.log(miss) / math.log(1 - threshold**rows))
        if bands * rows <= HASHES:
            return bands, rows
    return HASHES, 1


def least_matches(places: int, threshold: float, miss: float = MISS) -> list[int]:
    """Fewest matches after 0..places places for which the posterior chance of similarity >= threshold is above ``miss``.

    With a uniform prior the posterior after m matches of n is Beta(m+1, n-m+1); its tail is a binomial sum.
    """
    out = [0]
    for n in range(1, places + 1):
        chance, m = 0.0, -1
        while chance <= miss and m < n:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; fewer than ``k`` words, but not none, are one shingle."""
    words, places = word_hashes(raw, bounds, fold=True)
    grams, out = ngram_hashes(words, k), []
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(ngram_hashes(words[a:b], b - a) ^ np.uint64(b - a) if b > a else np.empty(0, np.uint64))
    return out


def _sets_of_batch(column: pa.Array, k: int):
    """First row and shingle sets of the texts of a batch, a bounded number of bytes at a time."""
    raw, bounds = text_bytes(column)
    for lo, hi in byte_chunks(bounds):
        yield lo, shingle_sets(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], k)


def signature(shingles: np.ndarray, places: int) -> np.ndarray:
    """MinHash signature (upper halves of the smallest products); not defined for an empty set."""
    least = np.full(places, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 4096):
        np.minimum(least, (_MULTIPLIERS[:places, None] * shingles[None, lo : lo + 4096]).min(1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def surviving(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Rows of two signature tables whose pair is never ruled out; later batches see the pairs still open only."""
    open_ = np.arange(len(left))
    agree = np.zeros(len(left), np.int32)
    places = left.shape[1]
    for lo in range(0, places, BATCH):
        hi = min(places, lo + BATCH)
        agree = agree + (left[open_, lo:hi] == right[open_, lo:hi]).sum(1, dtype=np.int32)
        keep = agree >= least[hi]
        open_, agree = open_[keep], agree[keep]
    return open_


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


class NearDuplicates:
    """Near-duplicate groups of a documents table (doc_id, text) for ``k``-word shingles and a similarity in percent."""

    def __init__(self, docs: DataFrame, k: int = 5, percent: int = 80) -> None:
        self.docs, self.k, self.percent = pick(docs, "doc_id", "text"), k, percent
        self.bands, self.rows = bands_for(percent / 100)
        self.places = self.bands * self.rows
        self.least = least_matches(self.places, percent / 100)

    def signatures(self) -> DataFrame:
        """doc_id, n_shingles, two halves of a hash of the set (null if empty), signature and band hashes."""
        k, places, bands, rows = self.k, self.places, self.bands, self.rows
        salts = mix64(np.arange(1, bands + 1, dtype=np.uint64))

        def run(batches):
            for batch in batches:
                for lo, sets in _sets_of_batch(batch.column(1), k):
                    signed = [signature(s, places) if len(s) else None for s in sets]
                    digests = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8").tolist() if len(s) else (None, None) for s in sets]
                    keys: list = []
                    for s in signed:
                        if s is None:
                            keys.append(None)
                            continue
                        keys.append(mix64(ngram_rows(s.reshape(bands, rows)) ^ salts).astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                         pa.array([None if s is None else s.tobytes() for s in signed], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                        names=["doc_id", "n_shingles", "set_a", "set_b", "signature", "bands"],
                    )

        return self.docs.mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, signature binary, bands array<long>")

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """id and shingle set (bytes) of the documents whose number is in ``ids`` (one column, id)."""
        k = self.k

        def run(batches):
            for batch in batches:
                for lo, sets in _sets_of_batch(batch.column(1), k):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "shingles"])

        wanted = small_side(ids.select(F.col("id").alias("doc_id")))
        return self.docs.join(wanted, "doc_id", "left_semi").mapInArrow(run, "id long, shingles binary")

    def links(self, pairs: DataFrame, reps: DataFrame) -> DataFrame:
        """Verified pairs among ``pairs`` (a, b): first by their signatures, then by their full sets."""
        least, percent = self.least, self.percent

        def prune(batches):
            for batch in batches:
                if batch.num_rows:
                    left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3))
                    rows = pa.array(surviving(left, right, least))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])

        def verify(batches):
            for batch in batches:
                left, right = batch.column(2), batch.column(3)
                rows = pa.array([i for i in range(batch.num_rows) if similar(np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64), percent)], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])

        signed = reps.select(F.col("rep").alias("id"), "signature")
        open_ = _beside(pairs, signed, "signature").mapInArrow(prune, "a long, b long")
        open_ = written(open_, "survivors")
        ids = open_.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = written(self.sets_of(written(ids, "survivor-ids")), "sets")
        return _beside(open_, sets, "shingles").mapInArrow(verify, "a long, b long")

    def block_links(self, members: DataFrame, reps: DataFrame) -> DataFrame:
        """Links between components inside large buckets: ``members`` (bucket, rep, comp, size).

        Members outside the bucket's largest component meet all members, in blocks of both; a pair of blocks is one
        task's group. Inside, pairs go by descending agreement and those already joined are skipped, so that a group
        gives at most one link for each member.
        """
        least, percent, places = self.least, self.percent, self.places
        of_comp = members.groupBy("bucket", "comp").count().groupBy("bucket")
        per = of_comp.agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), (F.sum("count") - F.max("count")).alias("n_apart"))
        marked = members.join(small_side(written(per, "large-buckets")), "bucket").withColumn("apart", F.col("comp") != F.col("main"))
        lefts, alls = F.ceil(F.col("n_apart") / BLOCK_LEFT).cast("int"), F.ceil(F.col("size") / BLOCK_ALL).cast("int")
        place = F.xxhash64("rep")
        whole = lambda n: F.sequence(F.lit(0), n - 1)
        as_left = marked.where("apart").select("bucket", F.pmod(place, lefts).cast("int").alias("i"), F.explode(whole(alls)).alias("j"), "rep", "comp", F.lit(True).alias("left"))
        as_any = marked.select("bucket", F.explode(whole(lefts)).alias("i"), F.pmod(place, alls).cast("int").alias("j"), "rep", "comp", F.lit(False).alias("left"))
        signed = as_left.unionByName(as_any).join(reps.select("rep", "signature"), "rep")

        def open_pairs(table: pa.Table, sets: list[np.ndarray] | None):
            """Whether each member of a block is in a pair that its signature leaves open; with sets, the links."""
            reps_, comps, left = (table.column(c).to_pylist() for c in ("rep", "comp", "left"))
            signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, places)
            parent: dict = {}

            def root(c):
                while parent.setdefault(c, c) != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            others = [i for i, l in enumerate(left) if not l]
            needed, a, b = np.zeros(len(left), bool), [], []
            for i in (i for i, l in enumerate(left) if l):
                rows = np.array([j for j in others if root(comps[j]) != root(comps[i])], np.int64)
                if not len(rows):
                    continue
                rows = rows[surviving(np.broadcast_to(signs[i], (len(rows), places)), signs[rows], least)]
                if sets is None:
                    needed[rows] = True
                    needed[i] |= len(rows) > 0
                    continue
                for j in rows[np.argsort(-(signs[rows] == signs[i]).sum(1), kind="stable")].tolist():
                    if root(comps[j]) != root(comps[i]) and similar(sets[i], sets[j], percent):
                        parent[root(comps[j])] = root(comps[i])
                        a.append(reps_[i])
                        b.append(reps_[j])
            return needed, a, b

        def keep_open(table: pa.Table) -> pa.Table:
            return table.filter(pa.array(open_pairs(table, None)[0]))

        def compare(table: pa.Table) -> pa.Table:
            _, a, b = open_pairs(table, [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()])
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        # Only members that a signature leaves open take their sets to their blocks.
        left_open = written(signed.groupBy("bucket", "i", "j").applyInArrow(keep_open, signed.schema), "open-blocks")
        data = written(self.sets_of(left_open.select(F.col("rep").alias("id")).distinct()), "sets").groupBy("id").agg(F.first("shingles").alias("shingles"))
        return left_open.join(data.withColumnRenamed("id", "rep"), "rep").groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")

    def groups(self) -> DataFrame:
        """Per row of the input: doc_id, n_shingles, component_id, kept.

        component_id is the smallest doc_id reachable over links. Rows that share a doc_id are one document. A null
        doc_id is linked with nothing (component_id null) and kept; so is a text without words, under its own number.
        """
        signed = written(self.signatures(), "signatures")
        some = signed.where("set_a is not null and doc_id is not null")
        # Equal sets have equal signatures, so any of them will do.
        reps = written(some.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.min("signature").alias("signature"), F.first("bands").alias("bands")), "representatives")
        members = reps.select("rep", F.explode(F.array_distinct("bands")).alias("bucket"))
        # Counted with partial sums and joined, so that no bucket has to meet in one task. The smallest number is the hub:
        # it is so in most of the buckets its copies share.
        buckets = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("hub")).where("size > 1")
        members = written(members.join(small_side(written(buckets, "bucket-sizes")), "bucket"), "buckets")
        star = members.where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
        star = written(star, "star-pairs")
        # Rows that share a doc_id but not a set are one document: its sets' representatives are linked.
        same = some.join(reps.select("set_a", "set_b", "rep"), ["set_a", "set_b"]).where("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        several = some.groupBy("doc_id").agg(F.count_distinct("set_a", "set_b").alias("n")).where("n > 1").select(F.col("doc_id").alias("b"))
        same = same.join(several, "b", "left_semi").select("a", "b")
        edges = components(written(self.links(star, reps).unionByName(same), "star-links"))
        label = edges.select(F.col("u").alias("rep"), F.col("v").alias("label"))
        labelled = members.join(label, "rep", "left").select("bucket", "rep", "size", F.coalesce("label", "rep").alias("comp"))
        # A bucket is resolved if all its members are in its hub's component.
        mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
        rest = written(labelled.join(mixed, "bucket", "left_semi"), "unresolved")
        few = rest.where(F.col("size") <= LISTED)
        l, r = few.alias("l"), few.alias("r")
        listed = l.join(r, F.expr("l.bucket = r.bucket and l.rep < r.rep and l.comp != r.comp")).select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")).distinct()
        listed = written(listed.join(star, ["a", "b"], "left_anti"), "listed-pairs")
        more = self.links(listed, reps)
        many = rest.where(F.col("size") > LISTED)
        if many.limit(1).count():
            more = more.unionByName(self.block_links(many, reps))
        stars = components(written(more.unionByName(edges.select(F.col("u").alias("a"), F.col("v").alias("b"))), "all-links"))
        final = reps.join(stars.select(F.col("u").alias("rep"), F.col("v").alias("label")), "rep", "left").select("set_a", "set_b", F.coalesce("label", "rep").alias("component"))
        joined = signed.join(final, ["set_a", "set_b"], "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def ngram_rows(rows: np.ndarray) -> np.ndarray:
    """One hash of each row of a table of numbers."""
    out = np.zeros(len(rows), np.uint64)
    for i in range(rows.shape[1]):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i].astype(np.uint64))
    return out


def _beside(pairs: DataFrame, data: DataFrame, column: str) -> DataFrame:
    """a, b and ``column`` of both, joined by id."""
    left = data.select(F.col("id").alias("a"), F.col(column).alias("left"))
    right = data.select(F.col("id").alias("b"), F.col(column).alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")


def components(links: DataFrame) -> DataFrame:
    """Smallest number reachable from each linked one: rows u, v (v < u) over links (a, b), by alternating star
    contractions. Each round is a few joins on the links; rounds grow with the logarithm of the longest chain."""
    stars = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    seen = None
    while True:
        stars = written(stars, "stars")
        state = stars.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == (state.n, state.x) or not state.n:
            return stars
        seen = (state.n, state.x)
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the one with the smallest doc_id; columns as they came.

    Of rows that repeat a doc_id one stays. Rows with a null doc_id all stay.
    """
    names = docs.columns
    kept = NearDuplicates(docs, k, percent).groups().where("kept and doc_id is not null").select("doc_id").distinct()
    kept = written(kept, "kept")
    plain = docs.select(*[F.col(f"`{n}`").alias(f"in_{i}") for i, n in enumerate(names)])
    key = f"in_{names.index('doc_id')}"
    stay = plain.join(small_side(kept.withColumnRenamed("doc_id", key)), key, "left_semi")
    if plain.groupBy(key).count().where(f"count > 1 and {key} is not null").limit(1).count():
        stay = stay.dropDuplicates([key])
    out = stay.unionByName(plain.where(F.col(key).isNull()))
    return out.select(*[F.col(f"in_{i}").alias(n) for i, n in enumerate(names)])
