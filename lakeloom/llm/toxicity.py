"""Toxicity: a counterfactual-regularised linear classifier over words and word beginnings.

Labelled sentences that name a group are copied with the name swapped for another of its kind; the training loss
penalises the squared change of the score between the two, so that a name alone moves a score as little as possible.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakeloom.llm.common import id_text, pick, written

# Kinds of identity terms; a term is swapped for the next one of its line.
IDENTITY_TERMS = [
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics"],
    ["woman", "man", "girl", "boy"],
    ["women", "men", "girls", "boys"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "queer"],
    ["black", "white", "asian", "african", "european", "latino", "arab"],
    ["mexican", "american", "chinese", "indian", "german", "french", "russian"],
    ["immigrant", "refugee", "citizen", "foreigner"],
    ["immigrants", "refugees", "citizens", "foreigners"],
    ["old", "young", "elderly"],
    ["disabled", "blind", "deaf"],
]
SWAP = {t: line[(i + 1) % len(line)] for line in IDENTITY_TERMS for i, t in enumerate(line)}

#: Bound of the fit: labelled rows taken of each class, the first by a hash of their number.
ROWS_OF_CLASS = 4096
#: Bound of the model: features kept, those whose presence tells most about the class, at every number of rows.
FEATURES = 1000
#: Lengths of the word beginnings that are features beside whole words.
BEGINNINGS = range(4, 9)
#: Weight of the counterfactual penalty.
PENALTY = 1.0

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(text: str) -> set[str]:
    """Lower-cased words of a text and the beginnings of longer ones (marked by a star)."""
    out = set(_WORD.findall(text.lower()))
    return out.union(*[_beginnings(w) for w in out])


def _beginnings(word: str) -> list[str]:
    return [word[:n] + "*" for n in BEGINNINGS if len(word) > n]


def swapped(sentence: str) -> str:
    """The sentence with each identity term replaced by the next of its kind."""
    return _WORD.sub(lambda m: SWAP.get(m[0].lower(), m[0]), sentence)


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.fromiter((i for r in rows for i in r), np.int64)
    return ids, np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def fit(rows: list[list[int]], labels: list[int], plus: list[list[int]], minus: list[list[int]], n: int, penalty: float = PENALTY, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights of ``n`` features and a bias, by full-batch Adam on log loss + L2 + counterfactual penalty.

    ``rows`` are the features of each labelled text; ``plus`` and ``minus`` those that a swap of identity terms takes from
    a sentence and gives it. Both classes weigh the same.
    """
    y = np.array(labels, float)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    (ids, row), (gone, gone_row), (new, new_row), pairs = _flat(rows), _flat(plus), _flat(minus), len(plus)
    w, bias = np.zeros(n), 0.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, w[ids], len(y)) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.append(np.bincount(ids, error[row], n) + 1e-4 * w, error.sum())
        if pairs:
            change = (np.bincount(gone_row, w[gone], pairs) - np.bincount(new_row, w[new], pairs)) * (2 * penalty / pairs)
            grad[:n] += np.bincount(gone, change[gone_row], n) - np.bincount(new, change[new_row], n)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:n], bias - move[n]
    return w, float(bias)


def _count_features(batches):
    """How many texts of either class hold each feature, summed over a task's rows."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for f in features(text):
                counts.setdefault(f, [0, 0])[label] += 1
    names = list(counts)
    for lo in range(0, len(names), 50_000):
        part = names[lo : lo + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([counts[f][k] for f in part], pa.int64()) for k in (0, 1))], names=["feature", "neg", "pos"])


def _indexed(index: dict[str, int]):
    """Rows with the chosen features of each text, and of its sentences that name a group, by number."""

    def run(batches):
        numbers = pa.list_(pa.int32())
        for batch in batches:
            ids, plus, minus = [], [], []
            for text in batch.column(1).to_pylist():
                ids.append(sorted(index[f] for f in features(text) if f in index))
                gone, new = [], []
                for sentence in _SENTENCE.findall(text):
                    if any(w in SWAP for w in _WORD.findall(sentence.lower())):
                        a, b = features(sentence), features(swapped(sentence))
                        gone.append(sorted(index[f] for f in a - b if f in index))
                        new.append(sorted(index[f] for f in b - a if f in index))
                kept = [i for i, pair in enumerate(zip(gone, new)) if any(pair)]
                plus.append([gone[i] for i in kept])
                minus.append([new[i] for i in kept])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ids, numbers), pa.array(plus, pa.list_(numbers)), pa.array(minus, pa.list_(numbers))], names=["doc_id", "toxic", "ids", "plus", "minus"])

    return run


def train(docs: DataFrame, labels: DataFrame, rows_of_class: int = ROWS_OF_CLASS, penalty: float = PENALTY) -> dict:
    """Fit on at most ``rows_of_class`` labelled rows of each class; label rows are chosen first, then their texts read.

    Texts stay in tasks: these count the features, the FEATURES that tell most are chosen, and only their numbers reach
    the driver. The model tells how many pairs of swapped sentences entered the fit ("pairs"). Rows with a null label, number or text are left out; a number with several label rows counts with each
    of them. Without a row of either class nothing can be learned: the bias alone gives a score below 0.5.
    """
    chosen = None
    marked = pick(labels, "doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null")
    for label in (0, 1):
        part = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_of_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * rows_of_class rows of two numbers are broadcast.
    rows = pick(docs, "doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    rows = written(rows, "toxicity-sample")
    of_class = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    neg, pos = of_class.get(0, 0), of_class.get(1, 0)
    if not neg or not pos:
        return {"bias": -3.0, "weights": {}, "pairs": 0}
    total = neg + pos
    counts = rows.select("text", "toxic").mapInArrow(_count_features, "feature string, neg long, pos long").groupBy("feature").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    share = (F.col("neg") + F.col("pos")) / total
    # How far the share of toxic texts with the feature lies from the others', in standard errors: either class may gain.
    told = (F.col("pos") / pos - F.col("neg") / neg) / F.sqrt(share * (1 - share) * (1 / pos + 1 / neg) + 1e-12)
    best = counts.orderBy(F.abs(told).desc(), "feature").select("feature").limit(FEATURES).collect()
    index = {r.feature: i for i, r in enumerate(best)}
    encoded = rows.mapInArrow(_indexed(index), "doc_id long, toxic int, ids array<int>, plus array<array<int>>, minus array<array<int>>").collect()
    encoded.sort(key=lambda r: (r.doc_id, r.toxic, r.ids))
    plus, minus = ([p for r in encoded for p in r[side]] for side in ("plus", "minus"))
    w, bias = fit([r.ids for r in encoded], [r.toxic for r in encoded], plus, minus, len(index), penalty)
    return {"bias": bias, "weights": {f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-4}, "pairs": len(plus)}


#: Words whose features a worker keeps; emptied when full.
KEPT_WORDS = 60_000
_KEPT: dict = {}


def _scorer(model: dict, key: str):
    if _KEPT.get("model") != key:
        _KEPT.clear()
        _KEPT.update(model=key, words={})
    weights, kept, bias = model["weights"], _KEPT["words"], model["bias"]

    def of(word: str) -> tuple[str, ...]:
        return tuple(f for f in (word, *_beginnings(word)) if f in weights)

    def score(text: str) -> float:
        found: set[str] = set()
        for w in set(_WORD.findall(text.lower())):
            got = kept.get(w)
            if got is None:
                kept[w] = got = of(w)
            if got:
                found.update(got)
        if len(kept) > KEPT_WORDS:
            kept.clear()
        z = bias + sum(weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def _scored(docs: DataFrame, text: str, out: str, model: dict) -> DataFrame:
    """``docs`` with a new column ``out``, the score of column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights
    key = f"{model['bias']!r}:{len(model['weights'])}:{sum(model['weights'].values())!r}"
    names = [*docs.columns, out]
    place = docs.columns.index(text)

    def run(batches):
        score = _scorer(shared.value, key)
        for batch in batches:
            scores = [score(t or "") for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``score``, from the whole text alone; a null or empty text has the bias's score. A column of that
    name is replaced, all others stay as they are."""
    return _scored(docs.drop("score"), "text", "score", model)


def held_out(parts: int, part: int) -> F.Column:
    """True for the documents whose crc32 of the number's text leaves ``part`` modulo ``parts``."""
    return (F.crc32(id_text(F.col("doc_id")).cast("binary")) % parts) == part


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if score >= threshold). Held-out labels aren't learned from."""
    model = train(docs, labels.where(~held_out(3, 1)))
    scored = score_documents(pick(docs, "doc_id", "text"), model)
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the documents whose score reaches ``threshold``; all columns as they came, whatever their names.
    Learns from all labels."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{n}`").alias(f"in_{i}") for i, n in enumerate(names)])
    scored = _scored(plain, f"in_{names.index('text')}", "score", train(docs, labels))
    return scored.where(F.col("score") < threshold).select(*[F.col(f"in_{i}").alias(n) for i, n in enumerate(names)])
