"""Periodic runs: stretches of words that repeat with a period, found in whole texts, and texts with the repeats dropped.

A run is a stretch of consecutive words in which words ``period`` apart are identical, ``period`` being the least such
number, that holds at least LEAST_WORDS words and LEAST_REPEATS periods and that no neighbouring word extends.

Recursive frequency splitting: each word of a run occurs in it LEAST_REPEATS times at least, so a word that occurs more
rarely in its segment (at first: its document) belongs to no run there and splits the segment; the parts are counted
anew until nothing splits any more. The surviving segments are scanned by lags: at the scale of m words the distance from
each stretch of m words to the next equal one is taken, and a run of a period between m/2 and m is where that distance
stays equal to the period. Scales double, so a segment of n words takes about log n sorts, whatever its periods.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lakeloom.llm.common import byte_chunks, id_text, is_space, pick, text_bytes, word_keys, word_spans

#: Least words and least periods of a run.
LEAST_WORDS, LEAST_REPEATS = 24, 3
#: Words that splitting may count in all, times the words of the texts. A hostile text can lose one word a round; beyond
#: this its segments go to the lag scan as they are, which finds the same runs in them.
ROUNDS_WORTH = 64

RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
RUNS = StructType([StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that sorts ``values``, and the number of each one's class, counted in that order."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return order, number


def _stretches(head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the stretch each place lies in and the lengths of stretches, given the places that begin one."""
    number = np.cumsum(head) - 1
    return number, np.bincount(number) if len(number) else np.empty(0, np.int64)


def split_by_frequency(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and segment numbers of the words that may belong to runs. ``words`` are word numbers, ``owner`` ascending
    document numbers; a segment is a stretch of neighbouring places of one document."""
    place, width = np.arange(len(words)), int(words.max(initial=0)) + 1
    segment = _stretches(np.diff(owner, prepend=-1) != 0)[0]
    done, left = [], ROUNDS_WORTH * len(words)
    while len(place):
        _, size = _stretches(np.diff(segment, prepend=-1) != 0)
        _, kind = _numbered(segment * width + words[place])
        keep = np.bincount(kind)[kind] >= LEAST_REPEATS
        place, before = place[keep], segment[keep]
        if not len(place):
            break
        head = (np.diff(place, prepend=-2) != 1) | (np.diff(before, prepend=-1) != 0)
        segment, now = _stretches(head)
        whole = (now == size[before[head]])[segment]  # nothing was cut from it: stable
        long = (now >= LEAST_WORDS)[segment]
        left -= len(place)
        if left < 0:
            whole = long
        done.append(place[whole & long])
        place = place[long & ~whole]
        # Numbers of segments count from 0 again.
        segment = _stretches(np.diff(segment[long & ~whole], prepend=-1) != 0)[0]
    place = np.sort(np.concatenate([np.empty(0, np.int64), *done]))
    return place, _stretches((np.diff(place, prepend=-2) != 1) | (np.diff(owner[place], prepend=-1) != 0))[0]


def scan_lags(words: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run in segments of words, by start and then period. No run spans segments.

    A stretch of m words in a run of period p, m/2 < p <= m, comes again p words later and not before, as p is the
    least period; so the distance to its next occurrence is p along the run, and nowhere next to it.
    """
    n = len(words)
    _, size = _stretches(np.diff(segment, prepend=-1) != 0)
    stop = np.cumsum(size)[segment] if n else np.empty(0, np.int64)
    where = np.arange(n)  # places whose stretch of m words lies in the segment and occurs there more than once
    code = segment * (int(words.max(initial=0)) + 1) + words
    found, m = [], 1
    while len(where):
        order, code = _numbered(code)
        again = code[order][1:] == code[order][:-1]
        distance = np.zeros(len(where), np.int64)
        distance[order[:-1][again]] = (where[order[1:]] - where[order[:-1]])[again]
        ok = (distance > m // 2) & (distance <= m)
        head = ok.copy()
        head[1:] &= ~ok[:-1] | (distance[1:] != distance[:-1]) | (where[1:] != where[:-1] + 1)
        last = ok.copy()
        last[:-1] &= head[1:] | ~ok[1:]
        start, period = where[head], distance[head]
        length = where[last] - start + m + period
        long = length >= np.maximum(LEAST_WORDS, LEAST_REPEATS * period)
        found.append(np.stack([start[long], length[long], period[long]]))
        # Stretches twice as long: only of those that occur more than once, in segments that have room for longer periods.
        several = np.bincount(code)[code] > 1
        full = np.full(n + m, -1)
        full[where[several]] = code[several]
        live = several & (where + 2 * m <= stop[where]) & (size[segment[where]] >= LEAST_REPEATS * (m + 1))
        live[live] = full[where[live] + m] >= 0
        where, code = where[live], code[live] * (n + 1) + full[where[live] + m]
        m *= 2
    start, length, period = np.concatenate(found, 1) if found else np.empty((3, 0), np.int64)
    order = np.lexsort([period, start])
    return start[order], length[order], period[order]


def _runs_of(raw: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """n_words, runs and collapsed text of each text of a chunk of bytes."""
    starts, lengths = word_spans(raw, bounds, is_space(raw))
    stops = np.searchsorted(starts, bounds)
    counts = np.diff(stops)
    owner = np.repeat(np.arange(len(counts)), counts)
    enough = (counts >= LEAST_WORDS)[owner]
    _, words = _numbered(word_keys(np.concatenate([raw, np.zeros(8, np.uint8)]), starts[enough], lengths[enough]))
    place, segment = split_by_frequency(words, owner[enough])
    start, length, period = scan_lags(words[place], segment)
    start = np.flatnonzero(enough)[place[start]]  # place in the chunk; a segment's places are neighbours
    # Dropped words: those in a run, behind its first period.
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change)[:-1] == 0
    # A kept word brings the byte before it along as a space, but for a text's first.
    first = np.zeros(len(starts), bool)
    first[stops[:-1][counts > 0]] = True
    space = keep & ~first
    mark = np.zeros(len(raw) + 1, np.int8)
    mark[starts[keep]] += 1
    mark[(starts + lengths)[keep]] -= 1
    mask = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    gaps = starts[space] - 1
    mask[gaps] = True
    out = raw.copy()
    out[gaps] = 0x20
    sizes = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[bounds]
    text = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(sizes), pa.py_buffer(out[mask])).cast(pa.string())
    whose = owner[start]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(counts)))]).astype(np.int32)
    fields = [pa.array(start - stops[whose]), pa.array(length), pa.array(period)]
    runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
    return pa.RecordBatch.from_arrays([pa.array(counts.astype(np.int64)), runs, text], names=["n_words", "runs", "collapsed"])


def with_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``, the text's
    words joined by one space without those that a run holds after its first period.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared by 64-bit hashes. A null text has no words and an empty collapsed text.
    Every row is kept, repeated rows and null numbers too; columns of the three names are replaced, others stay.
    """
    docs = docs.drop("n_words", "runs", "collapsed")
    place, names = docs.columns.index("text"), [*docs.columns, *RUNS.names]

    def run(batches):
        for batch in batches:
            raw, bounds = text_bytes(batch.column(place))
            for lo, hi in byte_chunks(bounds):
                found = _runs_of(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
                rest = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*rest.columns, *found.columns], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *RUNS.fields]))


def run_table(docs: DataFrame) -> DataFrame:
    """A row a run: doc_id, start (word number from 0), length and period in words."""
    return with_runs(pick(docs, "doc_id", "text")).select("doc_id", F.inline("runs"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with each text that holds a run collapsed; other texts, and all other columns, as they came."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{n}`").alias("text" if n == "text" else f"in_{i}") for i, n in enumerate(names)])
    new = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("text"))
    return with_runs(plain).select(*[(new if n == "text" else F.col(f"in_{i}")).alias(n) for i, n in enumerate(names)])


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which every tenth document by crc32 of its number goes on periodically from some word on.

    With h the crc32 and g = floor(h / 10), words from a = g mod n on repeat the next 1 + floor((n - a) / (3 + g mod 8)).
    """
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    h = F.crc32(id_text(F.col("doc_id")).cast("binary"))
    base = pick(docs, "doc_id", "text").select("doc_id", "text", F.when(h % 10 == 0, words).alias("ws"), F.floor(h / 10).alias("g"))
    base = base.withColumn("n", F.expr("nullif(size(ws), 0)")).withColumn("a", F.expr("g % n"))
    base = base.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    edited = F.expr("concat_ws(' ', transform(sequence(0L, n - 1L), i -> ws[cast(if(i < a, i, a + (i - a) % p) as int)]))")
    return base.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))


def run_digest(docs: DataFrame) -> DataFrame:
    """Per document of :func:`planted`: doc_id, n_runs, the run of most periods (start, length, period, exponent_milli;
    ties by start, then period; nulls without a run), runs_sha256 and collapsed_sha256."""
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.element_at("runs", 1),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    found = with_runs(planted(docs)).select("doc_id", "runs", F.when(F.size("runs") > 0, best).alias("best"), "collapsed")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
