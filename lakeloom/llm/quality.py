"""Quality: a generalised additive model with pairwise interactions over figures of a text.

Every figure has a lookup table by bins, learned by cyclic boosting: figure after figure, round after round, a tree of
three leaves over the figure's bins is fitted to what the others leave unexplained and a small share of it added to the
table. Then the pairs of figures that explain most of the rest get tables of their own, boosted alike by trees of four
leaves, one cut on either figure. A score is the sum of the looked-up values, so each part of it can be read off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakeloom.llm.common import byte_chunks, folded, is_space, ngram_hashes, pick, text_bytes, word_keys, word_spans, written
from lakeloom.llm.toxicity import held_out

#: Bound of the fit: labelled rows taken of each class, the first by a hash of their number. Classes are weighed by how
#: many labelled rows they have, so scores are shares of the label.
ROWS_OF_CLASS = 8192
#: Bins of a figure, and bins of either figure of a pair.
BINS, PAIR_BINS = 64, 8
#: Pairs that get tables, most rounds of either boosting, and the share of a tree that enters a table.
PAIRS, ROUNDS, RATE = 8, 300, 0.1
#: Rounds without a gain on the fifth of the rows that watches, after which boosting ends.
PATIENCE = 20

#: The figures of a text. Shares are of its bytes, letters, words, runs of words or lines, as they say; an empty text has 0 for all.
FIGURES = [
    "log_bytes", "log_words", "word_length", "word_length_spread", "log_longest_word", "letters", "capitals", "digits", "stops", "symbols", "beyond_ascii",
    "byte_entropy", "words_ending_in_symbols", "words_in_capitals", "words_begun_in_capitals", "words_without_letters", "single_letters", "words_said_twice",
    "distinct_words", "commonest_word", "distinct_triples", "log_lines", "words_of_line", "distinct_lines", "ended_lines", "sentences",
]

_CODES = np.arange(256)
_UPPER, _LOWER, _DIGIT = (_CODES >= 65) & (_CODES <= 90), (_CODES >= 97) & (_CODES <= 122), (_CODES >= 48) & (_CODES <= 57)
_HIGH, _BLANK = _CODES >= 128, (_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13))
_STOP = np.isin(_CODES, np.frombuffer(b".,;:?!'\"()-", np.uint8))
_SYMBOL = (_CODES > 32) & (_CODES < 127) & ~(_UPPER | _LOWER | _DIGIT | _STOP)
#: Texts described at once; a text's bytes are counted by value.
_AT_ONCE = 4096


def _by_kind(owner: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of each owner, and how often its commonest occurs. Owners are below 2 ** 16."""
    both = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (keys >> np.uint64(16)))
    head = np.flatnonzero(np.diff(both, prepend=~both[:1]) != 0)
    whose, count = (both[head] >> np.uint64(48)).astype(np.int64), np.diff(np.append(head, len(both)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, whose, count)
    return np.bincount(whose, minlength=n), most


def describe(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The FIGURES of each text, a row a text, from the bytes of all."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    bytes_of = np.bincount(np.repeat(np.arange(n) * 256, size) + raw, minlength=n * 256).reshape(n, 256)
    upper, lower, digit, stop, symbol, high = (bytes_of @ kind.astype(np.int64) for kind in (_UPPER, _LOWER, _DIGIT, _STOP, _SYMBOL, _HIGH))
    letters = upper + lower + high
    share = bytes_of / np.maximum(1, size)[:, None]
    entropy = -(share * np.log2(np.maximum(share, 1e-12))).sum(1)

    starts, lengths = word_spans(raw, bounds, is_space(raw))
    owner = np.repeat(np.arange(n), np.diff(np.searchsorted(starts, bounds)))

    def per(values, weights=None):
        return np.bincount(owner[values] if weights is None else owner, weights, minlength=n)

    words = np.bincount(owner, minlength=n)
    some = np.maximum(1, words)
    mean = per(None, lengths) / some
    spread = np.sqrt(np.maximum(0, per(None, lengths.astype(float) ** 2) / some - mean**2))
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, lengths)
    first, last = raw[starts], raw[starts + lengths - 1]
    ups, lows, lets = (np.concatenate([[0], np.cumsum(kind[raw], dtype=np.int64)]) for kind in (_UPPER, _LOWER, _UPPER | _LOWER | _HIGH))
    of_word = [c[starts + lengths] - c[starts] for c in (ups, lows, lets)]
    keys = word_keys(folded(raw), starts, lengths)
    twice = np.zeros(len(keys), bool)
    twice[1:] = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
    kinds, most = _by_kind(owner, keys, n)
    triples = ngram_hashes(keys, 3)
    inside = owner[2:] == owner[:-2] if len(owner) > 2 else np.empty(0, bool)
    triple_kinds, _ = _by_kind(owner[: len(triples)][inside], triples[inside], n)

    line_starts, line_lengths = word_spans(raw, bounds, raw == 10)
    line_owner = np.repeat(np.arange(n), np.diff(np.searchsorted(line_starts, bounds)))
    lines = np.bincount(line_owner, minlength=n)
    some_lines = np.maximum(1, lines)
    line_kinds, _ = _by_kind(line_owner, word_keys(folded(raw), line_starts, line_lengths), n)
    ended = np.bincount(line_owner[np.isin(raw[line_starts + line_lengths - 1], (33, 46, 63))], minlength=n)

    figures = [
        np.log1p(size), np.log1p(words), mean, spread, np.log1p(longest), letters / np.maximum(1, size), upper / np.maximum(1, letters),
        digit / np.maximum(1, size), stop / np.maximum(1, size), symbol / np.maximum(1, size), high / np.maximum(1, size), entropy,
        per(_SYMBOL[last]) / some, per((of_word[0] > 1) & (of_word[1] == 0)) / some, per(_UPPER[first]) / some, per(of_word[2] == 0) / some,
        per((lengths == 1) & (of_word[2] == 1)) / some, per(twice) / some, kinds / some, most / some, triple_kinds / np.maximum(1, words - 2),
        np.log1p(lines), words / some_lines, line_kinds / some_lines, ended / some_lines, per(np.isin(last, (33, 46, 63))) / some,
    ]
    return np.stack(figures, 1).astype(float)


def _described(batches, place: int):
    """Batches in parts of few texts, with the figures of each."""
    for batch in batches:
        raw, bounds = text_bytes(batch.column(place))
        for lo, hi in byte_chunks(bounds):
            for a in range(lo, hi, _AT_ONCE):
                b = min(hi, a + _AT_ONCE)
                yield batch.slice(a, b - a), describe(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])


# --- fit --------------------------------------------------------------------------------------------------------------


def _gain(g, h):
    return g * g / (h + 1.0)


def _step(grad: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """Values by bin of a tree of up to three leaves over ordered bins that lowers the loss most."""

    def cut(lo: int, hi: int):
        g, h = np.cumsum(grad[lo:hi]), np.cumsum(curve[lo:hi])
        gains = _gain(g[:-1], h[:-1]) + _gain(g[-1] - g[:-1], h[-1] - h[:-1]) - _gain(g[-1], h[-1])
        gains[(h[:-1] < 1.0) | (h[-1] - h[:-1] < 1.0)] = 0.0
        return (float(gains.max()), lo + int(gains.argmax()) + 1) if len(gains) else (0.0, lo)

    n, edges = len(grad), [0, len(grad)]
    for _ in range(2):
        gain, at = max(cut(lo, hi) for lo, hi in zip(edges[:-1], edges[1:]))
        if gain <= 1e-9:
            break
        edges = sorted([*edges, at])
    if len(edges) == 2:
        return np.zeros(n)
    values = [-grad[lo:hi].sum() / (curve[lo:hi].sum() + 1.0) for lo, hi in zip(edges[:-1], edges[1:])]
    return np.repeat(values, np.diff(edges))


def _quarters(grad: np.ndarray, curve: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and the values by cell of the tree of four leaves that lowers the loss most: one cut on either axis."""
    g, h = grad.cumsum(0).cumsum(1), curve.cumsum(0).cumsum(1)
    total_g, total_h = g[-1, -1], h[-1, -1]
    gs = [g, g[:, -1:] - g, g[-1:, :] - g, total_g - g[:, -1:] - g[-1:, :] + g]
    hs = [h, h[:, -1:] - h, h[-1:, :] - h, total_h - h[:, -1:] - h[-1:, :] + h]
    gains = sum(_gain(a, b) for a, b in zip(gs, hs))[:-1, :-1] - _gain(total_g, total_h)
    if not gains.size:
        return 0.0, np.zeros(grad.shape)
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    a, b, c, d = (-x[i, j] / (y[i, j] + 1.0) for x, y in zip(gs, hs))
    values = np.empty(grad.shape)
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = a, b, c, d
    return float(gains[i, j]), values


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _boost(z, y, weight, watch, cells: list[np.ndarray], shapes: list, tree):
    """Cyclic boosting from scores ``z``: a table for each term, of those rounds that the watching rows gained by."""
    learn, tables = weight * ~watch, [np.zeros(s) for s in shapes]
    best, kept, since = np.inf, [t.copy() for t in tables], 0
    for _ in range(ROUNDS):
        for table, cell in zip(tables, cells):
            p = _sigmoid(z)
            grad = np.bincount(cell, learn * (p - y), table.size).reshape(table.shape)
            curve = np.bincount(cell, learn * p * (1 - p), table.size).reshape(table.shape)
            step = RATE * tree(grad, curve)
            table += step
            z = z + step.ravel()[cell]
        loss = float((weight * watch * (np.logaddexp(0, z) - y * z)).sum())
        if loss < best * (1 - 1e-4):
            best, kept, since = loss, [t.copy() for t in tables], 0
        else:
            since += 1
            if since >= PATIENCE:
                break
    return kept


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """The model of figures ``x`` (a row a text), labels ``y`` and weights: bias, edges and tables. Every fifth row
    watches when to stop."""
    weight = weight * (len(y) / weight.sum())
    watch = np.arange(len(y)) % 5 == 4
    mean = float((weight * y).sum() / weight.sum())
    bias = float(np.log(mean / (1 - mean)))
    edges = [_edges(column, BINS) for column in x.T]
    cells = [np.searchsorted(e, column, side="right") for e, column in zip(edges, x.T)]
    z = np.full(len(y), bias)
    tables = _boost(z, y, weight, watch, cells, [len(e) + 1 for e in edges], _step)
    z = z + sum(t[c] for t, c in zip(tables, cells))

    coarse = [_edges(column, PAIR_BINS) for column in x.T]
    wide = [np.searchsorted(e, column, side="right") for e, column in zip(coarse, x.T)]
    p, ranked = _sigmoid(z), []
    grad, curve = weight * ~watch * (p - y), weight * ~watch * p * (1 - p)
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            cell = wide[i] * shape[1] + wide[j]
            gain, _ = _quarters(*(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (grad, curve)))
            ranked.append((-gain, i, j))
    chosen = [(i, j) for gain, i, j in sorted(ranked)[:PAIRS] if gain < 0]
    shapes = [(len(coarse[i]) + 1, len(coarse[j]) + 1) for i, j in chosen]
    pair_cells = [wide[i] * s[1] + wide[j] for (i, j), s in zip(chosen, shapes)]
    pair_tables = _boost(z, y, weight, watch, pair_cells, shapes, lambda g, h: _quarters(g, h)[1]) if chosen else []
    return {"bias": bias, "edges": edges, "tables": tables, "pairs": [(i, j, coarse[i], coarse[j], t) for (i, j), t in zip(chosen, pair_tables)]}


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    """The share of label 1 that the model expects for each row of figures: sums of looked-up values."""
    z = np.full(len(x), model["bias"])
    for column, edges, table in zip(x.T, model["edges"], model["tables"]):
        z += table[np.searchsorted(edges, column, side="right")]
    for i, j, a, b, table in model["pairs"]:
        z += table[np.searchsorted(a, x[:, i], side="right"), np.searchsorted(b, x[:, j], side="right")]
    return _sigmoid(z)


def _figures(batches):
    for part, x in _described(batches, 1):
        rows = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * len(FIGURES)), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), rows], names=["doc_id", "quality", "figures"])


def train(docs: DataFrame, labels: DataFrame, rows_of_class: int = ROWS_OF_CLASS) -> dict:
    """Fit on at most ``rows_of_class`` labelled rows of each class; label rows are chosen first, then their texts read.

    Texts stay in tasks, their figures alone reach the driver. Rows with a null label, number or text are left out; a
    number with several label rows counts with each of them. Without a row of either class nothing can be learned:
    every score is one half, and a text counts as good.
    """
    marked = pick(labels, "doc_id", "quality").where("quality in (0, 1) and doc_id is not null")
    counts = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}  # two rows
    chosen = None
    for label in (0, 1):
        part = marked.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_of_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * rows_of_class rows of two numbers are broadcast.
    rows = pick(docs, "doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "text", F.col("quality").cast("int").alias("quality")).mapInArrow(_figures, "doc_id long, quality int, figures array<double>")
    got = written(rows, "quality-figures").withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id", "quality", "figures").collect()
    y = np.array([r["quality"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return {"bias": 0.0, "edges": [], "tables": [], "pairs": []}
    found = np.array([(y == 0).sum(), (y == 1).sum()])
    weight = np.array([counts[0], counts[1]])[y.astype(int)] / found[y.astype(int)]
    return fit(np.array([r["figures"] for r in got]), y, weight)


def terms(model: dict) -> list[tuple[str, float, float]]:
    """The model to be read: (figure, least value of the bin, what it adds to the score), and pairs as ``a x b`` with
    the most that the pair adds or takes."""
    out = [(name, float(lo), float(v)) for name, edges, table in zip(FIGURES, model["edges"], model["tables"]) for lo, v in zip([-np.inf, *edges], table)]
    return out + [(f"{FIGURES[i]} x {FIGURES[j]}", -np.inf, float(np.abs(table).max())) for i, j, _, _, table in model["pairs"]]


def _scored(docs: DataFrame, text: str, out: str, model: dict) -> DataFrame:
    """``docs`` with a new column ``out``, the score of column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FIGURES * BINS + PAIRS * PAIR_BINS ** 2 numbers at most
    names, place = [*docs.columns, out], docs.columns.index(text)

    def run(batches):
        for part, x in _described(batches, place):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores(shared.value, x))], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``score`` from the whole text alone; a null text counts as empty. A column of that name is
    replaced, all others stay as they are; repeated rows and null numbers keep their rows."""
    return _scored(docs.drop("score"), "text", "score", model)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if score >= threshold). Held-out labels aren't learned from."""
    scored = score_documents(pick(docs, "doc_id", "text"), train(docs, labels.where(~held_out(3, 1))))
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` whose score reaches ``threshold``; all columns as they came, whatever their names. Learns from all labels."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{n}`").alias(f"in_{i}") for i, n in enumerate(names)])
    scored = _scored(plain, f"in_{names.index('text')}", "score", train(docs, labels))
    return scored.where(F.col("score") >= threshold).select(*[F.col(f"in_{i}").alias(n) for i, n in enumerate(names)])
