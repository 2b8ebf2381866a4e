"""Helpers the training-data operators share: shared-folder tables, size-checked joins and vectorised word hashing."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only after a count has shown at most this many narrow rows (ids and a few numbers).
BROADCAST_ROWS = 1_000_000
#: Text handed to numpy at once, in bytes; bounds a worker's memory whatever the Arrow batch holds.
CHUNK_BYTES = 2_000_000


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Only a local session, as in tests, gets a default where it has none:
    on a cluster a folder of one machine would lose what the others write."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
            context.setCheckpointDir(f"{tempfile.gettempdir()}/lakeloom-checkpoints")
        base = context.getCheckpointDir()
    return f"{base}/lakeloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS, weight: str = "1") -> DataFrame:
    """``df`` with a broadcast hint if its rows weigh at most ``limit`` in all, else unchanged (a shuffle join follows).

    A row weighs 1, or what the SQL expression ``weight`` says, such as the length of an array it carries.
    """
    if weight == "1":
        return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
    total = df.agg(F.coalesce(F.sum(F.expr(weight)), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= limit else df


#: Bits of a prefilter: 2^18 rows of eight numbers, 16 MB whatever the keys are.
FILTER_BITS, FILTER_ROW = 1 << 27, 512


def _bit(on: list[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit(23), *on), F.lit(FILTER_BITS))


def may_match(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those whose columns ``on`` are no key of ``keys``; a row whose key is there always stays.

    The keys' hashes set bits of a table of fixed size, which is broadcast: so what a shuffle join behind this sends are
    the rows that match and, of the others, the share of bits that the keys set. ``on`` columns must not be null.
    """
    bit = _bit(on)
    word, at = F.expr(f"(bit % {FILTER_ROW}) div 64"), F.expr("cast(bit % 64 as int)")
    marked = keys.select(bit.alias("bit")).select(F.expr(f"bit div {FILTER_ROW}").alias("filter_row"), word.alias("word"), at.alias("at"))
    of_word = [F.bit_or(F.when(F.col("word") == i, F.expr("shiftleft(1L, at)")).otherwise(F.lit(0).cast("long"))) for i in range(FILTER_ROW // 64)]
    table = marked.groupBy("filter_row").agg(F.array(*of_word).alias("filter_bits"))
    number = (bit / FILTER_ROW).cast("long")
    found = rows.join(F.broadcast(table), number == F.col("filter_row"))
    held = F.getbit(F.get("filter_bits", (F.pmod(bit, F.lit(FILTER_ROW)) / 64).cast("int")), F.pmod(bit, F.lit(64)).cast("int"))
    return found.where(held == 1).select(*[rows[f"`{c}`"] for c in rows.columns])


def join_few(rows: DataFrame, few: DataFrame, on: list[str], limit: int = BROADCAST_ROWS, weight: str = "1") -> DataFrame:
    """Inner join of ``rows`` with the written table ``few``: by a broadcast if its rows weigh at most ``limit`` in all
    (see :func:`small_side`), else by a shuffle of those ``rows`` alone that :func:`may_match` lets through."""
    if few.agg(F.coalesce(F.sum(F.expr(weight)), F.lit(0))).first()[0] <= limit:
        return rows.join(F.broadcast(few), on)
    return may_match(rows, few, on).join(few, on)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input can't clash with those an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def id_text(col: Column) -> Column:
    """The document number as text, for crc32-based splits; a null number counts as empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


# --- word hashing -----------------------------------------------------------------------------------------------------

#: Longer words are hashed one by one, all their bytes at once.
LONG_WORD = 256
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit, and different inputs give different outputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of an Arrow column and the bounds of each among them; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def byte_chunks(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes each; a longer text stands alone. ``bounds`` as of :func:`text_bytes`."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def is_space(raw: np.ndarray) -> np.ndarray:
    """Which bytes are U+0020 or U+0009-U+000D."""
    return (raw == 0x20) | ((raw - np.uint8(9)) < 5)


def folded(raw: np.ndarray) -> np.ndarray:
    """A copy of ``raw`` with A-Z in lower case and eight zeros behind, as :func:`word_keys` wants it."""
    out = np.zeros(len(raw) + 8, np.uint8)
    np.add(raw, ((raw - np.uint8(65)) < 26) * np.uint8(32), out=out[: len(raw)])
    return out


def word_spans(raw: np.ndarray, bounds: np.ndarray, space: np.ndarray, parted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of every white-space separated word of the texts. Bytes marked in ``parted`` begin a word too."""
    inside = ~space
    begin = inside.copy()
    begin[1:] &= space[:-1]
    if parted is not None:
        begin |= parted
    heads = bounds[:-1][bounds[:-1] < len(raw)]
    begin[heads] = inside[heads]
    end = inside
    end[:-1] &= space[1:] | begin[1:]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1 - starts


def word_keys(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, multiplier: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hash of each word, eight bytes at a time. Words of up to eight bytes without a zero byte never collide."""
    windows = np.ndarray((len(padded) - 7,), "<u8", buffer=padded.data, strides=(1,))
    keys = mix64(windows[starts] & _MASKS[np.minimum(lengths, 8)])
    more, at = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD)), 8
    while len(more):
        piece = windows[starts[more] + at] & _MASKS[np.minimum(lengths[more] - at, 8)]
        keys[more] = mix64(keys[more] * np.uint64(multiplier) ^ piece) + lengths[more].astype(np.uint64)
        at += 8
        more = more[lengths[more] > at]
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        word = padded[starts[i] : starts[i] + lengths[i]]
        keys[i] = np.frombuffer(hashlib.blake2b(word, digest_size=8, salt=multiplier.to_bytes(8, "little")).digest(), "<u8")[0]
    return keys


def word_hashes(raw: np.ndarray, bounds: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all white-space separated words of the texts and the bounds of each text among them.

    White space is U+0020 and U+0009-U+000D; ``fold`` lower-cases A-Z first. Text ``i`` has words ``bounds[i]:bounds[i+1]``.
    """
    padded = folded(raw) if fold else np.concatenate([raw, np.zeros(8, np.uint8)])
    starts, lengths = word_spans(raw, bounds, is_space(raw))
    return word_keys(padded, starts, lengths), np.searchsorted(starts, bounds)


def ngram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (bounds of texts are the caller's concern)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
        out ^= out >> np.uint64(29)
    return mix64(out)
