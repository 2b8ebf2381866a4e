"""Token-ID output: a Parquet dataset of token lists that supports selective reads.

Layout of a dataset: ``tokens/`` holds one row a document (``shard, doc_id, local_start, n_tokens, tokens``) in ascending
``doc_id`` order over the shards; ``manifest/`` holds one row a shard (``shard, first_doc, last_doc, docs, tokens, base``).
A document starts at ``base + local_start`` in the stream of all ids. Token lists are dictionary encoded, the numbers
delta encoded; small row groups and pages carry column and offset indexes, so that a read of metadata touches no token
page and a read of a ``doc_id`` range touches only the pages that hold it.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import byte_chunks, folded, is_space, pick, small_side, text_bytes, word_keys, word_spans

ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 2000
#: Places of a worker's table of known words (24 bytes each), and ids it keeps for them (4 bytes each).
KNOWN_WORDS, KNOWN_IDS = 1 << 20, 1 << 23

_ENCODERS: dict = {}
#: Punctuation that may follow a run of letters: the tokenizer parts the two, whatever they are.
_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'_")
#: Byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for those from U+0100 on in
#: turn. The space parts words here and stays as it is.
_ITSELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARACTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _ITSELF) if b != 0x20}
_SECOND = 0xC2B2AE3D27D4EB4F
#: Texts that show whether a tokenizer takes words as :class:`_Encoder` does.
_PROBES = [
    "The quick brown fox, it's HERE. And the end.", "  two  spaces\tand\nlines ", "ÄPFEL und Öl, straße; été. naïve", "a1b2 3.14 x=y; (z) [q] {r} #t @u", "don't we'll I'm they're", "!!! ... ?! -- word.word word,word,",
    "e\u0301 o\u0308. \u00a0x\u2003y \u200bz", "日本語 テスト。 русский Текст, ελληνικά", "\U0001F600 ok \U0001F600\U0001F601.", "under_score _a_ a_. it's'", "İstanbul ΟΔΟΣ ﬁ Ⅳ", "x" * 300 + ". y,", "",
]


class _Encoder:
    """Ids of texts by the tokenizers library, with the ids of words kept.

    The tokenizer normalises and merges within runs between white space and drops the white space itself, so the ids of
    a text are those of the words between ASCII white space in turn. It parts letters from other characters and
    lower-cases them, so a word of letters and punctuation has the ids of its lower-cased letters and then those of its
    punctuation. A tokenizer that doesn't (``_PROBES`` tell) gets whole texts. Words are told apart by two 64-bit hashes
    and looked up in a table with one place a hash, all words of a chunk at once; only new words meet the tokenizer.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        # Added tokens are found in the text as it stands, so texts that hold their letters go to the tokenizer whole.
        added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.first, self.second = np.zeros(KNOWN_WORDS, np.uint64), np.zeros(KNOWN_WORDS, np.uint64)
        self.start, self.size = np.zeros(KNOWN_WORDS, np.int32), np.zeros(KNOWN_WORDS, np.int32)
        self.ids, self.used = np.zeros(KNOWN_IDS, np.int32), 0
        self.by_words = True
        probes = [p for text in _PROBES for p in (text, text.upper(), text.lower())]
        got = self.encode(*text_bytes(pa.array(probes)))
        want = self._plain(probes)
        self.by_words = got[1].tolist() == [len(w) for w in want] and got[0].tolist() == [i for ids in want for i in ids]

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words, A-Z in lower case already: the words' order in what follows, all ids, and their counts.

        Letters in composed form pass the tokenizer's normaliser and splitter as one run, so its model takes their bytes
        as they are, and then the punctuation behind them. Other words go through all of it.
        """
        cores, tails, order, rest = [], [], [], []
        for i, word in enumerate(words):
            if word.isalpha():
                cores.append(word)
                tails.append(b"")
                order.append(i)
                continue
            core = word.rstrip(_MARKS)
            letters = core.decode()
            # These two lower-case by context or to two characters, which the tokenizer does otherwise.
            if letters.isalpha() and "\u03a3" not in letters and "\u0130" not in letters:
                letters = letters.lower()
                if unicodedata.is_normalized("NFC", letters):
                    cores.append(letters.encode())
                    tails.append(word[len(core) :])
                    order.append(i)
                    continue
            rest.append(i)
        merge, values, sizes = self.tokenizer.model.tokenize, [], []
        marks = sorted({t for t in tails if t})
        ends = dict(zip(marks, self._plain([m.decode() for m in marks])))
        for core, tail in zip(b" ".join(cores).decode("latin-1").translate(_BYTE_CHARACTERS).split(" "), tails):
            found = [t.id for t in merge(core)]
            if tail:
                found += ends[tail]
            values += found
            sizes.append(len(found))
        for ids in self._plain([words[i].decode() for i in rest]):
            values += ids
            sizes.append(len(ids))
        return np.array(order + rest, np.int64), np.array(values, np.int32), np.array(sizes, np.int64)

    def _look_up(self, low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each word begin in the third array, and how many they are."""
        first, second = word_keys(low, starts, lengths), lengths.astype(np.uint64)
        long = np.flatnonzero(lengths > 8)
        second[long] = word_keys(low, starts[long], lengths[long], _SECOND)
        place = (first & np.uint64(KNOWN_WORDS - 1)).astype(np.int64)
        start, size = self.start[place], self.size[place]
        missed = np.flatnonzero((self.first[place] != first) | (self.second[place] != second) | (size == 0))
        if not len(missed):
            return start, size, self.ids
        pairs = np.empty(len(missed), [("a", np.uint64), ("b", np.uint64)])
        pairs["a"], pairs["b"] = first[missed], second[missed]
        _, where, which = np.unique(pairs["a"], return_index=True, return_inverse=True)
        if (pairs["b"][where][which] != pairs["b"]).any():
            _, where, which = np.unique(pairs, return_index=True, return_inverse=True)
        rows = missed[where]
        raw = low.tobytes()
        order, values, counts = self._words([raw[a : a + n] for a, n in zip(starts[rows].tolist(), lengths[rows].tolist())])
        if self.used + len(values) > len(self.ids):
            self.size[:], self.used = 0, 0
            if len(values) > len(self.ids):
                self.ids = np.zeros(2 * len(values), np.int32)
            # Words known a moment ago are needed still: take them anew with the next look.
            return self._look_up(low, starts, lengths)
        begins, sizes = np.empty(len(rows), np.int32), np.empty(len(rows), np.int32)
        begins[order], sizes[order] = self.used + np.cumsum(counts) - counts, counts
        self.ids[self.used : self.used + len(values)] = values
        self.used += len(values)
        start[missed], size[missed] = begins[which], sizes[which]
        at = place[rows]
        self.first[at], self.second[at], self.start[at], self.size[at] = first[rows], second[rows], begins, sizes
        return start, size, self.ids

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and how many each has."""
        low = folded(raw)
        if not self.by_words or (self.added and self.added.search(low)):
            return self._one_by_one(raw, bounds)
        low_raw, space = low[: len(raw)], is_space(raw)
        # A full stop or comma between a letter and white space is a word of its own: fewer different words, the same ids.
        stop = np.zeros(len(raw), bool)
        stop[1:-1] = ((low_raw[1:-1] == 0x2E) | (low_raw[1:-1] == 0x2C)) & ((low_raw[:-2] - np.uint8(97)) < 26) & space[2:]
        starts, lengths = word_spans(raw, bounds, space, stop)
        start, size, ids = self._look_up(low, starts, lengths)
        size = size.astype(np.int64)
        before = np.concatenate([[0], np.cumsum(size)])
        counts = np.diff(before[np.searchsorted(starts, bounds)])
        return ids[np.arange(before[-1]) + np.repeat(start - before[:-1], size)], counts

    def _one_by_one(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold an added token in any case, or all if the tokenizer doesn't go by words, as they stand."""
        data, parts, counts = raw.tobytes(), [], []
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            text = data[a:b]
            if not self.by_words or self.added.search(text.lower()):
                ids = self._plain([text.decode()])[0]
            else:
                ids = self.encode(raw[a:b], bounds[i : i + 2] - a)[0]
            parts.append(ids)
            counts.append(len(ids))
        return np.concatenate([np.empty(0, np.int32), *parts]).astype(np.int32), np.array(counts, np.int64)


def _encoder(vocabulary: str) -> _Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = _Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def encode_documents(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) in ascending doc_id order, encoded; ``end_id`` closes each document.

    A null text counts as empty and still gets ``end_id``. Null doc_ids come first; equal doc_ids are ordered by a hash
    of their text, so repeated rows keep a defined order. The sort key includes that hash, so one doc_id that holds
    many rows is dealt over several shards.
    """

    def run(batches):
        from pyspark import TaskContext

        shard, start = TaskContext.get().partitionId(), 0
        encoder = _encoder(vocabulary)
        for batch in batches:
            raw, bounds = text_bytes(batch.column(1))
            for lo, hi in byte_chunks(bounds):
                ids, counts = encoder.encode(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts += 1
                stops = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, shard, np.int32)), batch.column(0).slice(lo, hi - lo), pa.array(start + stops[:-1]), pa.array(counts), pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(ids))],
                    names=["shard", "doc_id", "local_start", "n_tokens", "tokens"],
                )
                start += int(stops[-1])

    tie = F.xxhash64("text")
    ordered = pick(docs, "doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    return ordered.mapInArrow(run, "shard int, doc_id long, local_start long, n_tokens long, tokens array<int>")


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Encode ``docs`` and write the dataset described above to ``path``. An empty table gives an empty dataset."""
    encoded = encode_documents(docs, vocabulary, end_id)
    (
        encoded.write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#local_start", "false")
        .parquet(f"{path}/tokens")
    )
    spark = docs.sparkSession
    shards = read_metadata(spark, path, with_start=False).groupBy("shard").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))
    # One row a shard: the running sum is over as many rows as there are files, not documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/manifest")


def _with_start(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    base = spark.read.schema("shard int, base long").parquet(f"{path}/manifest")
    return rows.join(small_side(base), "shard").withColumn("start", F.col("base") + F.col("local_start")).drop("base", "local_start")


def read_metadata(spark: SparkSession, path: str, with_start: bool = True) -> DataFrame:
    """Documents without their tokens: only the number columns are read."""
    rows = spark.read.schema("shard int, doc_id long, local_start long, n_tokens long").parquet(f"{path}/tokens")
    return _with_start(rows, spark, path) if with_start else rows


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Documents with their tokens, optionally only doc_ids ``first..last``; the bounds reach the scan as filters."""
    rows = spark.read.schema("shard int, doc_id long, local_start long, n_tokens long, tokens array<int>").parquet(f"{path}/tokens")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return _with_start(rows, spark, path)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of each document's ids (little-endian unsigned 32-bit), from the files."""

    def run(batches):
        for batch in batches:
            tokens = batch.column(3)
            stops = tokens.offsets.to_numpy()
            values = np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).view(np.uint8)
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(stops[:-1], stops[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).select("doc_id", "start", "n_tokens", "tokens")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
