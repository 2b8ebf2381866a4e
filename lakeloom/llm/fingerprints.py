"""Document fingerprints by one-permutation MinHash, with DataFrame expressions only.

Every word is hashed once and every shingle of five words once, from the hashes of its words; the shingle's low bits choose
one of BINS bins and the rest is its value. A bin keeps its smallest value, an empty bin takes that of another one, found
by double hashing over the bins (densification), and the low BITS bits of each bin make the fingerprint. The likeness of
two fingerprints is the share of equal bins, less what BITS bits agree on by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import pick, small_side, written

BINS, BITS, SHINGLE = 128, 8, 5
#: Probes an empty bin makes before it tries all bins.
PROBES = 8

_SPACES = r"[\x20\x09-\x0D]+"
#: The word a text ends with, if no white space follows it. Tried at beginnings of words only, and never twice.
_LAST_WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]++\z"
_NONE = -(2**63)


def words_of(text: Column) -> Column:
    """White-space separated words of a text."""
    return F.array_remove(F.split(text, _SPACES), "")


def word_codes(text: Column) -> Column:
    """A hash of each word of a text, in order."""
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _runs(codes: str, skip: Column | int = 0) -> Column:
    """Bin and value, in one number, of each run of SHINGLE words of array column ``codes`` but the first ``skip``."""
    size = F.greatest(F.size(codes) - (SHINGLE - 1) - skip, F.lit(0))
    heads = F.slice(codes, skip + 1 if isinstance(skip, Column) else F.lit(skip + 1), size)
    whole = F.transform(heads, lambda h, i: F.xxhash64(h, *[F.get(F.col(codes), i + skip + j) for j in range(1, SHINGLE)]))
    return F.transform(whole, _code)


def _code(h: Column) -> Column:
    return F.shiftleft(h.bitwiseAND(F.lit(BINS - 1)), 56) + F.shiftrightunsigned(h, 8)


def shingle_codes(codes: str) -> Column:
    """Codes of all shingles of the words of array column ``codes``; one to four words count as one shingle."""
    few = F.when(F.size(codes) > 0, F.array(_code(F.xxhash64(codes)))).otherwise(F.array().cast("array<long>"))
    return F.when(F.size(codes) >= SHINGLE, _runs(codes)).otherwise(few)


def _bin_of(code: Column) -> Column:
    return F.shiftright(code, 56).cast("int")


#: The largest code of each bin, which marks the bin as empty where no other code is in it.
_EMPTY = [(b << 56) | ((1 << 56) - 1) for b in range(BINS)]


def with_bins(df: DataFrame, codes: str, out: str) -> DataFrame:
    """``df`` with array column ``out``: BINS numbers below 2**BITS, or an empty array for a text without shingles.

    ``codes`` is the column of shingle codes. Steps are columns of their own, so that no array is made twice.
    """
    s, d = f"__{out}_sorted", f"__{out}_dense"
    df = df.withColumn(s, F.sort_array(F.concat(F.col(codes), F.array(*[F.lit(e) for e in _EMPTY]))))
    least = F.filter(F.col(s), lambda c, i: (i == 0) | (_bin_of(c) != _bin_of(F.get(F.col(s), i - 1))))
    full = 2**56 - 1
    df = df.withColumn(d, F.transform(least, lambda c: F.when(c.bitwiseAND(F.lit(full)) != full, c.bitwiseAND(F.lit(2**BITS - 1)).cast("int"))))

    def probe(b: Column, first: int, last: int) -> Column:
        step = F.pmod(b * 73 + b * b * 10 + 41, F.lit(BINS)).bitwiseOR(F.lit(1))  # odd, so the probes reach every bin
        start = F.pmod(b * 37 + 17, F.lit(BINS))
        tries = F.sequence(F.lit(first), F.lit(last))
        return F.aggregate(tries, F.lit(None).cast("int"), lambda got, j: F.coalesce(got, F.get(F.col(d), F.pmod(start + j * step, F.lit(BINS)))))

    filled = F.transform(F.col(d), lambda v, b: F.coalesce(v, probe(b, 0, PROBES - 1), probe(b, PROBES, BINS - 1)))
    return df.withColumn(out, F.when(F.size(codes) > 0, filled).otherwise(F.array().cast("array<int>"))).drop(s, d)


def packed(bins: Column) -> Column:
    """A fingerprint as text: BITS bits a bin, in hexadecimal digits; empty for a text without words."""
    return F.array_join(F.transform(bins, lambda v: F.lpad(F.lower(F.hex(v)), BITS // 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingles, from 0 to 1; a text without words is like none but another."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / float(BINS)
    chance = 2.0**-BITS
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(F.greatest(F.lit(0.0), (same - chance) / (1 - chance)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, bins and fingerprint of each row of ``docs`` (doc_id, text; other columns play no part). Null text
    counts as empty; equal texts have equal fingerprints."""
    texts = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    coded = texts.withColumn("codes", word_codes(F.col("text"))).withColumn("shingles", shingle_codes("codes"))
    return with_bins(coded, "shingles", "bins").withColumn("fingerprint", packed(F.col("bins"))).drop("codes", "shingles")


def next_documents(docs: DataFrame) -> DataFrame:
    """One row a document: d, tie (its key), n_chars, next_d, next_tie; the last one is followed by the first.

    Order is by doc_id (null first), then a hash of the text. Only keys are sorted: ranges of keys are sorted side by
    side, and the first key of each range, one row a range, tells what follows the last of the range before.
    """
    keys = docs.select("d", "tie", F.length("text").cast("long").alias("n_chars")).distinct()
    ranges = written(keys.repartitionByRange("d", "tie").withColumn("part", F.spark_partition_id()), "keys")
    key = F.struct("d", "tie")
    firsts = ranges.groupBy("part").agg(F.min(key).alias("first"))
    parts = Window.orderBy("part")
    following = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.min("first").over(Window.partitionBy())).alias("after"))
    inside = Window.partitionBy("part").orderBy("d", "tie")
    follower = F.coalesce(F.lead(key).over(inside), F.col("after"))
    linked = ranges.join(small_side(following), "part").withColumn("follower", follower)
    return linked.select("d", "tie", "n_chars", F.col("follower.d").alias("next_d"), F.col("follower.tie").alias("next_tie"))


def edited_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` the columns of the contract: its fingerprint, that of its edited text and their likeness.

    Rows that repeat a doc_id and its text count as one document among the others, and each has its result. Texts are
    shuffled once, by key; what a document lends to the one before it follows in a second, smaller shuffle. The edited
    text shares the words before its cut, so their hashes and shingles are made once.
    """
    texts = pick(docs, "doc_id", "text").select(F.coalesce("doc_id", F.lit(_NONE)).alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text"))
    links = written(next_documents(texts), "links")
    rows = texts.select("d", "tie")
    repeated = rows.groupBy("d", "tie").count().where("count > 1").limit(1).count() > 0
    if repeated:
        texts = texts.dropDuplicates(["d", "tie"])
    quarter = F.expr("n_chars div 4").cast("int")
    wanted = links.select(F.col("next_d").alias("d"), F.col("next_tie").alias("tie"), F.col("d").alias("for_d"), F.col("tie").alias("for_tie"), quarter.alias("wanted"))
    heads = texts.join(wanted, ["d", "tie"]).select(F.col("for_d").alias("d"), F.col("for_tie").alias("tie"), F.expr("substring(text, 1, wanted)").alias("head"))
    joined = texts.join(links, ["d", "tie"]).join(heads, ["d", "tie"])
    # ``before`` characters are the words that the cut leaves whole, with the white space behind them.
    cut = joined.withColumn("stay", F.expr("cast(n_chars - n_chars div 4 as int)")).withColumn("stays", F.expr("substring(text, 1, stay)"))
    cut = cut.withColumn("before", F.col("stay") - F.length(F.regexp_extract("stays", _LAST_WORD, 0)))
    rest = lambda text: F.substring(text, F.col("before") + 1, F.lit(2**31 - 1))
    split = cut.withColumn("edited", F.concat("stays", "head")).select(
        "d", "tie", "next_d", "next_tie", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        word_codes(F.expr("substring(text, 1, before)")).alias("common"), word_codes(rest(F.col("text"))).alias("old"), word_codes(rest(F.col("edited"))).alias("new"),
    )
    split = split.select("*", F.concat("common", "old").alias("text_codes"), F.concat("common", "new").alias("edited_codes"))
    both = split.withColumn("shingles", shingle_codes("text_codes"))
    shared = F.greatest(F.size("common") - (SHINGLE - 1), F.lit(0))
    after_cut = F.concat(F.slice("shingles", F.lit(1), shared), _runs("edited_codes", shared))
    both = both.withColumn("edited_shingles", F.when(F.size("common") >= SHINGLE, after_cut).otherwise(shingle_codes("edited_codes")))
    both = with_bins(with_bins(both, "shingles", "bins"), "edited_shingles", "edited_bins")
    made = written(both.select("d", "tie", "next_d", "next_tie", "n_chars", "edited_sha256", "bins", "edited_bins"), "fingerprints")
    after = made.select(F.col("d").alias("next_d"), F.col("tie").alias("next_tie"), F.col("bins").alias("next_bins"))
    out = made.join(after, ["next_d", "next_tie"])
    if repeated:
        out = rows.join(out, ["d", "tie"])
    return out.select(
        F.nullif("d", F.lit(_NONE)).alias("doc_id"), "n_chars", "edited_sha256",
        packed(F.col("bins")).alias("fingerprint"), packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"), likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )
