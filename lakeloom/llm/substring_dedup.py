"""Substring de-duplication: words that a window of WINDOW words covers are removed if the same window starts earlier.

1. Phrases: every window has an anchor, the phrase of PHRASE words in it with the smallest hash; neighbouring windows
   mostly share theirs. Anchors that occur more than once are the recurring phrases; a bitmap of bounded size marks them.
2. Pieces: a second read cuts the runs of windows with a recurring anchor out of each document. Equal pieces are merged
   before they meet (the first occurrence stays), so a passage that many documents share arrives once a task.
3. Automata: pieces are dealt to shards by anchor. A shard counts the window hashes of its pieces, compiles the windows
   that recur into an Aho-Corasick automaton and streams the pieces that hold one through it, which gives every
   occurrence by its words, and the first. Windows of the same words have the same anchor, so no document has to visit
   the other shards, and a piece without a recurring window visits none.
4. The words found are cut out in a last read. Whole copies of an earlier document never enter: they go as a whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import byte_chunks, ngram_hashes, pick, small_side, text_bytes, word_hashes, written

WINDOW, PHRASE = 20, 6
#: Bits of the bitmap of recurring phrases: PHRASE_BITS a phrase or more, within these bounds. A full bitmap lets more
#: pieces through to the exact steps but loses none.
PHRASE_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: Distinct pieces of one shard, about; and those of one anchor beyond which each window goes its own way.
SHARD_PIECES, HOT_PIECES = 10_000, 5_000
#: Pieces that occur more than once, up to which they are broadcast (about 100 bytes each); more are joined by a shuffle.
REPEATED_PIECES = 200_000
#: Bytes kept of a word's hash in a piece.
BYTES = 5

_NONE = -(2**63)


def _runs(words: np.ndarray, bounds: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and last window (places among ``words``) of each run of windows with one anchor place."""
    empty = np.empty(0, np.int64)
    if len(words) < window:
        return np.empty(0, np.uint64), empty, empty
    grams = ngram_hashes(words, phrase)
    span = window - phrase + 1
    least, place, width = grams, np.arange(len(grams)), 1
    while width < span:
        step = min(width, span - width)
        left = least[:-step] <= least[step:]
        least = np.where(left, least[:-step], least[step:])
        place = np.where(left, place[:-step], place[step:])
        width += step
    starts = np.arange(len(least))
    owner = np.searchsorted(bounds, starts, side="right") - 1
    inside = starts + window <= bounds[owner + 1]
    starts, place, least, owner = starts[inside], place[inside], least[inside], owner[inside]
    if not len(starts):
        return np.empty(0, np.uint64), empty, empty
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]))
    return least[new], starts[new], starts[np.append(new[1:], len(starts)) - 1]


class RepeatedPassages:
    """Removal of repeated windows from a documents table (doc_id, text). Words are taken as they are.

    Documents are ordered by doc_id (null first), then by a hash of the text; rows that repeat both are one document.
    Other columns play no part, whatever their names. Null and empty texts have no words; texts of fewer words than a
    window lose none.
    """

    def __init__(self, docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> None:
        self.window, self.phrase = window, phrase
        self.docs = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("doc_id", F.lit(_NONE)).alias("d"), F.xxhash64("text").alias("t"), "text")

    def copies(self) -> DataFrame:
        """d, t of the documents whose text is that of an earlier one."""
        digests = written(self.docs.where("text is not null").select("d", "t", F.unhex(F.md5("text")).alias("digest")), "digests")
        first = digests.groupBy("digest").agg(F.min(F.struct("d", "t")).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
        return written(digests.join(first, "digest").where("first != struct(d, t)").select("d", "t").distinct(), "copies")

    def recurring(self, texts: DataFrame) -> tuple[np.ndarray, int]:
        """Bitmap (bytes) of the anchors that occur at least twice, and its mask."""
        window, phrase = self.window, self.phrase

        def anchors(batches):
            for batch in batches:
                raw, ends = text_bytes(batch.column(0))
                for lo, hi in byte_chunks(ends):
                    hashes = _runs(*word_hashes(raw[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo], fold=False), window, phrase)[0]
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["anchor"])

        counted = texts.select("text").mapInArrow(anchors, "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
        counted = written(counted, "recurring")
        bits, phrases = LEAST_BITS, counted.count()
        while bits < min(MOST_BITS, PHRASE_BITS * phrases):
            bits *= 2
        place = F.col("anchor").bitwiseAND(F.lit(bits - 1)) + 1
        parts = counted.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        bitmap = np.zeros(bits // 8, np.uint8)
        for r in parts.collect():  # at most MOST_BITS bits in all
            size = min(len(r.bits), len(bitmap) - (r.part - 1) * 4096)
            bitmap[(r.part - 1) * 4096 :][:size] = np.frombuffer(bytes(r.bits), np.uint8)[:size]
        return bitmap, bits - 1

    def pieces(self, texts: DataFrame, bitmap: np.ndarray, mask: int) -> DataFrame:
        """anchor, piece (BYTES bytes a word), d, t and ``at`` (0-based first word) of every run with a marked anchor."""
        window, phrase = self.window, self.phrase
        shared = texts.sparkSession.sparkContext.broadcast(bitmap)  # at most MOST_BITS bits

        def cut(batches):
            marks = shared.value
            for batch in batches:
                raw, ends = text_bytes(batch.column(2))
                d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                for lo, hi in byte_chunks(ends):
                    words, bounds = word_hashes(raw[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo], fold=False)
                    anchor, first, last = _runs(words, bounds, window, phrase)
                    place = anchor & np.uint64(mask)
                    hit = np.flatnonzero(marks[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    anchor, first, last = anchor[hit], first[hit], last[hit]
                    short = np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8)[:, :BYTES]).tobytes()
                    owner = np.searchsorted(bounds, first, side="right") - 1
                    cuts = [short[BYTES * a : BYTES * (b + window)] for a, b in zip(first.tolist(), last.tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(cuts, pa.binary()), pa.array(d[lo:hi][owner]), pa.array(t[lo:hi][owner]), pa.array((first - bounds[owner]).astype(np.int32))], names=["anchor", "piece", "d", "t", "at"])

        return texts.select("d", "t", "text").mapInArrow(cut, "anchor long, piece binary, d long, t long, at int")

    def _windows_of(self, pieces: DataFrame) -> DataFrame:
        """Each window of the pieces as a piece of its own, with its hash for an anchor."""
        size = self.window * BYTES

        def split(batches):
            for batch in batches:
                rows = [(p[i : i + size], d, t, at + i // BYTES) for p, d, t, at in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3, 4))) for i in range(0, len(p) - size + 1, BYTES)]
                anchors = [int.from_bytes(hashlib.blake2b(r[0], digest_size=8).digest(), "little", signed=True) for r in rows]
                columns = list(zip(*rows)) if rows else [[], [], [], []]
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["anchor", "piece", "d", "t", "at"])

        return pieces.mapInArrow(split, pieces.schema)

    def _first_and_later(self, pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Distinct pieces with their first occurrence, and the ranges of all later occurrences."""
        place = F.struct("d", "t", "at")
        merged = written(pieces.groupBy("anchor", "piece").agg(F.min(place).alias("first"), F.count("*").alias("n")), "pieces")
        key = F.xxhash64("piece").alias("key")
        several = small_side(merged.where("n > 1").select("anchor", key, "first"), REPEATED_PIECES)
        words = (F.octet_length("piece") / BYTES).cast("int").alias("words")
        later = pieces.select("anchor", key, "d", "t", "at", words).join(several, ["anchor", "key"]).where("first != struct(d, t, at)")
        return merged.select("anchor", "piece", "first.*"), later.select("d", "t", F.col("at").alias("start"), (F.col("at") + F.col("words")).alias("stop"))

    def located(self, distinct: DataFrame) -> DataFrame:
        """Ranges (d, t, start, stop) of the windows of distinct pieces that occur earlier in another piece."""
        window = self.window
        size = 2 * window
        shards = F.lit(int(max(1, -(-distinct.count() // SHARD_PIECES))))

        def search(table: pa.Table) -> pa.Table:
            import ahocorasick

            raw = table.column("piece").to_pylist()
            # A word's bytes become two of the 2**20 characters beyond the basic plane.
            cells = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, BYTES).astype(np.uint64)
            numbers = sum(cells[:, i] << np.uint64(8 * i) for i in range(BYTES))
            points = np.stack([numbers >> np.uint64(20), numbers & np.uint64(0xFFFFF)], 1).ravel() + np.uint64(0x10000)
            text = points.astype("<u4").tobytes().decode("utf-32-le")
            ends = np.cumsum(np.fromiter((len(p) // BYTES for p in raw), np.int64, len(raw)))
            begins = np.concatenate([[0], ends[:-1]])
            # Confirmed: the windows whose hash occurs more than once among the shard's pieces.
            hashes = ngram_hashes(numbers, window)
            starts = np.arange(len(hashes))
            owner = np.searchsorted(ends, starts, side="right")
            inside = starts + window <= ends[owner] if len(hashes) else np.empty(0, bool)
            starts, owner, hashes = starts[inside], owner[inside], hashes[inside]
            _, first_at, which, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            out: dict[str, list] = {"d": [], "t": [], "start": [], "stop": []}
            if (times > 1).any():
                automaton = ahocorasick.Automaton()
                patterns = dict.fromkeys(text[2 * a : 2 * a + size] for a in starts[first_at[times > 1]].tolist())
                for number, w in enumerate(patterns):
                    automaton.add_word(w, number)
                automaton.make_automaton()
                d, t, at = (table.column(c).to_pylist() for c in ("d", "t", "at"))
                first: list = [None] * len(patterns)
                found = []
                for row in np.unique(owner[times[which] > 1]).tolist():
                    piece = text[2 * begins[row] : 2 * ends[row]]
                    for end, number in automaton.iter(piece):
                        start = end + 1 - size
                        if start % 2 == 0:
                            key = (d[row], t[row], at[row] + start // 2)
                            found.append((number, key))
                            if first[number] is None or key < first[number]:
                                first[number] = key
                rest = sorted({key for number, key in found if key != first[number]})
                for doc, tie, start in rest:
                    if out["d"] and (out["d"][-1], out["t"][-1]) == (doc, tie) and start <= out["stop"][-1]:
                        out["stop"][-1] = start + window
                    else:
                        for name, value in zip(out, (doc, tie, start, start + window)):
                            out[name].append(value)
            return pa.table({"d": pa.array(out["d"], pa.int64()), "t": pa.array(out["t"], pa.int64()), "start": pa.array(out["start"], pa.int32()), "stop": pa.array(out["stop"], pa.int32())})

        dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("anchor"), shards))
        return dealt.groupBy("shard").applyInArrow(search, "d long, t long, start int, stop int")

    def ranges(self) -> DataFrame:
        """Per document with something to remove: d, t and its ranges of words (start, stop; stop -1: to the end)."""
        copies = self.copies()
        texts = self.docs.where("text is not null").join(small_side(copies), ["d", "t"], "left_anti")
        pieces = written(self.pieces(texts, *self.recurring(texts)), "occurrences")
        distinct, later = self._first_and_later(pieces)
        hot = written(distinct.groupBy("anchor").count().where(F.col("count") > HOT_PIECES).select("anchor"), "hot-anchors")
        whole = copies.select("d", "t", F.lit(0).alias("start"), F.lit(-1).alias("stop"))
        if hot.limit(1).count():
            cool = distinct.join(hot, "anchor", "left_anti")
            # Windows of equal words have equal hashes: their own first and later occurrences are all there is to find.
            _, more = self._first_and_later(written(self._windows_of(distinct.join(hot, "anchor", "left_semi").select("anchor", "piece", "d", "t", "at")), "hot-windows"))
            found = self.located(cool).unionByName(more)
        else:
            found = self.located(distinct)
        every = found.unionByName(later).unionByName(whole)
        gathered = every.groupBy("d", "t").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
        return written(gathered.mapInArrow(_merged, gathered.schema), "ranges")

    def _with_ranges(self) -> DataFrame:
        ranges = small_side(self.ranges(), weight="1 + size(ranges)")
        return self.docs.join(ranges, ["d", "t"], "left").select("doc_id", "text", "ranges")

    def report(self) -> DataFrame:
        """Per row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by a space). Null text: no words."""
        window = self.window

        def run(batches):
            for batch in batches:
                counts, removed, digests = [], [], []
                for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    kept, n = _kept(text, ranges, window)
                    counts.append(n)
                    removed.append(n - len(kept))
                    digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

        return self._with_ranges().mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")

    def texts(self) -> DataFrame:
        """Per row: doc_id and the kept text. A text that loses nothing is returned as it is."""
        window = self.window

        def run(batches):
            for batch in batches:
                out = []
                for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    out.append(b" ".join(_kept(text, ranges, window)[0]).decode() if ranges else text)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

        return self._with_ranges().mapInArrow(run, "doc_id long, text string")


def _merged(batches):
    """Ranges of each document joined where they touch; a range to the end stands for all."""
    for batch in batches:
        out = []
        for ranges in batch.column(2).to_pylist():
            runs: list[dict] = []
            if any(r["stop"] < 0 for r in ranges):
                runs.append({"start": 0, "stop": -1})
            else:
                for r in sorted(ranges, key=lambda r: r["start"]):
                    if runs and r["start"] <= runs[-1]["stop"]:
                        runs[-1]["stop"] = max(runs[-1]["stop"], r["stop"])
                    else:
                        runs.append(r)
            out.append(runs)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))], names=["d", "t", "ranges"])


def _kept(text: str | None, ranges: list | None, window: int) -> tuple[list[bytes], int]:
    """Words kept of a text, and how many it had. A copy shorter than a window keeps all its words."""
    words = (text or "").encode().split()
    if not ranges:
        return words, len(words)
    keep = np.ones(len(words), bool)
    for r in ranges:
        if r["stop"] >= 0:
            keep[r["start"] : r["stop"]] = False
        elif len(words) >= window:
            keep[:] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()], len(words)
