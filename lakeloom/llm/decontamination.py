"""Benchmark decontamination, with DataFrame expressions only: hashes of the benchmark's n-grams are broadcast if they are
few, one scan of the documents' words looks its own up, and a hit counts if the words of a whole window agree.

A window of L words holds exactly one of the runs of ``gram`` words that begin at each ``stride``-th word of a document,
where stride is half of L and gram what is left of L. So the scan hashes and looks up one run in ``stride`` words, and
no window is lost; the windows around a found run are then compared on the texts read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import BROADCAST_ROWS, join_few, pick, small_side, written

#: Words of a window.
WINDOW = 10
#: Distinct n-grams of the benchmark that may be broadcast (one number each); more are joined by a shuffle.
BROADCAST_GRAMS = BROADCAST_ROWS
#: Found runs of words that may be broadcast; more are joined by a shuffle of the texts that hold some.
RUNS_BROADCAST = BROADCAST_ROWS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NONE = -(2**63)


def words_of(text: Column) -> Column:
    """Words of a text: runs of digits, letters and non-ASCII characters, A-Z lower-cased. Null: none."""
    plain = F.octet_length(text) == F.length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), _APART), "")


def steps(length: int) -> tuple[int, int]:
    """Stride and words of the runs that the scan looks up for windows of ``length`` words."""
    stride = (length + 1) // 2
    return stride, length - stride + 1


def _hashes(words: Column, first: Column, last: Column, step: int, size: int, length: int) -> Column:
    """Hashes of the runs of ``size`` words at the 1-based places ``first``, ``first`` + ``step``, ... up to ``last``."""
    places = F.when(last >= first, F.sequence(first, last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct((i - 1).alias("at"), F.lit(length).alias("length"), F.xxhash64(F.lit(length), F.slice(words, i, size)).alias("hash")))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, length and words of every window; an item of fewer words, but not none, is one window."""
    items = pick(benchmark, "item_id", "text").select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.size("words"), F.lit(window)))
    places = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    rows = items.select("item_id", "length", F.explode(F.transform(places, lambda i: F.slice("words", i, F.col("length")))).alias("window"))
    return rows.withColumn("hash", F.xxhash64("length", "window")).distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    """d and tie (a document's key) and its text. A null number is one of its own."""
    return pick(docs, "doc_id", "text").select(F.coalesce("doc_id", F.lit(_NONE)).alias("d"), F.xxhash64("text").alias("tie"), "text")


def scan(docs: DataFrame, known: DataFrame, lengths: list[int]) -> DataFrame:
    """One scan of the documents: d, tie, length, at; a row for each run of words that ``known`` windows hold (0-based
    ``at``) and a row for each document, with -1 - its number of words as ``at``."""
    one = F.col("words")
    grams = None
    for length in lengths:
        _, size = steps(length)
        of_window = F.transform(F.sequence(F.lit(1), F.lit(length - size + 1)), lambda i: F.xxhash64(F.lit(length), F.slice("window", i, size)))
        part = known.where(F.col("length") == length).select(F.explode(of_window).alias("hash"))
        grams = part if grams is None else grams.unionByName(part)
    document = F.array(F.struct((-1 - F.size(one)).alias("at"), F.lit(0).alias("length"), F.xxhash64("d", "tie").alias("hash")))
    runs = [_hashes(one, F.lit(1), F.size(one) - steps(n)[1] + 1, steps(n)[0], steps(n)[1], n) for n in lengths]
    rows = _keyed(docs).select("d", "tie", words_of(F.col("text")).alias("words")).select("d", "tie", F.inline(F.concat(document, *runs)))
    if grams is not None:
        known_grams = small_side(written(grams.distinct(), "benchmark-grams"), BROADCAST_GRAMS).withColumn("known", F.lit(True))
        rows = rows.join(known_grams, "hash", "left").where("at < 0 or known")
    return written(rows.select("d", "tie", "length", "at"), "scan")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (d, tie, n_words; a row for each of ``docs``), verified hits (d, tie, at, length, hash, window), each
    once, and the benchmark's windows.

    ``docs`` has doc_id and text. Only documents in which the scan found a run are split into words again, behind the join
    that finds them, and what goes on from them are the windows around those runs. Where the runs are too many for a
    broadcast, a prefilter keeps the other documents' texts out of the shuffle. A document's hits are bounded by its words.
    """
    known = written(benchmark_windows(benchmark, window), "benchmark-windows")
    lengths = [r.length for r in known.select("length").distinct().orderBy("length").collect()]  # at most ``window``
    found = scan(docs, known, lengths)
    documents = found.where("at < 0").select("d", "tie", (-1 - F.col("at")).cast("long").alias("n_words"))
    runs = written(found.where("at >= 0").groupBy("d", "tie").agg(F.collect_set(F.struct("length", "at")).alias("runs")), "runs")

    def around(r: Column) -> Column:
        first = F.greatest(F.lit(0), r["at"] - F.floor((r["length"] + 1) / 2).cast("int") + 1)
        last = F.least(r["at"], F.size("words") - r["length"])
        places = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: F.struct(at.alias("at"), r["length"].alias("length"), F.slice("words", at + 1, r["length"]).alias("window")))

    again = join_few(_keyed(docs), runs, ["d", "tie"], RUNS_BROADCAST, "1 + size(runs)")
    again = again.select("d", "tie", "runs", words_of(F.col("text")).alias("words"))
    windows = again.select("d", "tie", F.inline(F.flatten(F.transform("runs", around)))).withColumn("hash", F.xxhash64("length", "window"))
    distinct = small_side(known.select("length", "hash", "window").distinct(), BROADCAST_GRAMS // 10)
    verified = windows.join(distinct, ["length", "hash", "window"]).select("d", "tie", "at", "length", "hash", "window").distinct()
    return documents, verified, known


def _covered(found: DataFrame) -> Column:
    """Places of the words that a document's hits cover."""
    return F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1))))


def decontamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    An empty benchmark hits nothing. Repeated rows each get the same result. Null texts have no words. Other columns of
    either table play no part, whatever their names.
    """
    documents, found, known = hits(docs, benchmark, window)
    found = written(found, "hits")
    covered = found.groupBy("d", "tie").agg(F.size(_covered(found)).cast("long").alias("n_hit"))
    items = found.select("d", "tie", "length", "hash", "window").distinct().join(known.select("item_id", "length", "hash", "window"), ["length", "hash", "window"])
    items = items.groupBy("d", "tie").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    both = covered.join(items, ["d", "tie"], "left")
    out = documents.join(small_side(written(both, "contaminated"), weight="1 + size(items)"), ["d", "tie"], "left")
    named = F.array_join(F.array_sort(F.coalesce("items", F.array().cast("array<string>"))), ",")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    n_items = F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("long")
    return out.select(F.nullif("d", F.lit(_NONE)).alias("doc_id"), "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"), F.sha2(named, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns renamed in_0, in_1, ... beside d and tie, and the columns under their own names again."""
    names = docs.columns
    key = [F.coalesce("`doc_id`", F.lit(_NONE)).alias("d"), F.xxhash64("`text`").alias("tie")]
    keyed = docs.select(*[F.col(f"`{n}`").alias(f"in_{i}") for i, n in enumerate(names)], *key)
    return keyed, [F.col(f"in_{i}").alias(n) for i, n in enumerate(names)]


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that a benchmark window hits; other rows and all columns as they came, whatever
    their names."""
    bad = written(hits(docs, benchmark, window)[1].select("d", "tie").distinct(), "contaminated")
    keyed, columns = _numbered(docs)
    return keyed.join(small_side(bad), ["d", "tie"], "left_anti").select(*columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and text with the hit words cut out; the words left are lower-cased and joined by a space. A document
    without a hit keeps its text as it is."""
    found = hits(docs, benchmark, window)[1]
    cut = written(found.groupBy("d", "tie").agg(_covered(found).alias("cut")), "cuts")
    rows = pick(docs, "doc_id", "text").select("doc_id", "text", F.coalesce("doc_id", F.lit(_NONE)).alias("d"), F.xxhash64("text").alias("tie"))
    rows = rows.join(small_side(cut, weight="1 + size(cut)"), ["d", "tie"], "left")
    left = F.array_join(F.filter(words_of(F.col("text")), lambda w, i: ~F.array_contains("cut", i)), " ")
    return rows.select("doc_id", F.when(F.col("cut").isNull(), F.col("text")).otherwise(left).alias("text"))
