"""Language identification by cross-parsing: a text is cut greedily into the longest passages that occur in labelled
text of a language, found with a suffix automaton; the language that needs the fewest passages a letter wins.

Long texts are parsed in segments side by side, and a segment whose parse depends on where the one before it stopped is
parsed again from there until both parses meet: the passages are those of the whole text, wherever the segments begin."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import pick, small_side, written
from lakeloom.llm.toxicity import held_out

#: Bounds of the sample: labelled documents and letters of a language, and letters of all languages together, which share
#: them if they are many. No language is left out.
DOCUMENTS, LETTERS, ALL_LETTERS = 400, 40_000, 2_500_000
#: Letters with a column of the dense transition table: the commonest. The automata's other transitions are a sorted list.
ALPHABET = 60
#: Code of the first letter without a column.
RARE = 256
#: Letters of a segment.
SEGMENT = 1024
#: How sharply phrase rates turn into a score.
SHARPNESS = 40.0

_END, _GAP, _UNKNOWN = 255, 0, 1
_MODELS: dict = {}


def _automaton(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton of ``codes``: a row a state of the codes below ``width``, -1 where none, and
    those of rare letters as rows of state, code and next state. Code ``_END`` parts texts."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    table, rare = np.full((len(moves), width), -1, np.int32), []
    for s, row in enumerate(moves):
        for c, t in row.items():
            if c < width:
                table[s, c] = t
            elif c >= RARE:
                rare.append((s, c, t))
    return table, np.array(rare, np.int64).reshape(-1, 3)


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each followed by a zero, and the places of those zeros."""
    joined = "".join(t.replace("\0", " ").lower() + "\0" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.flatnonzero(points == 0)


def _is_letter(points: np.ndarray) -> np.ndarray:
    known = _MODELS.get("letters")
    if known is None:
        known = _MODELS["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return known[points]


def _classes(points: np.ndarray, alphabet: np.ndarray, rare: np.ndarray = np.empty(0, np.uint32)) -> np.ndarray:
    """Class of each code point: gap, unknown letter, a letter of ``alphabet`` (sorted) from 2 on or of ``rare`` (sorted)
    from ``RARE`` on; ``_END`` for zeros."""
    at = np.minimum(np.searchsorted(alphabet, points), max(0, len(alphabet) - 1))
    hit = alphabet[at] == points if len(alphabet) else np.zeros(len(points), bool)
    out = np.where(hit, at + 2, np.where(_is_letter(points), _UNKNOWN, _GAP)).astype(np.int32)
    if len(rare):
        left = np.flatnonzero(out == _UNKNOWN)
        at = np.minimum(np.searchsorted(rare, points[left]), len(rare) - 1)
        hit = rare[at] == points[left]
        out[left[hit]] = at[hit] + RARE
    out[points == 0] = _END
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != _GAP) | (out[:-1] != _GAP)
    return out[keep]


def letters_of(languages: int) -> int:
    """Letters of the sample that each of so many languages may have."""
    return max(1, min(LETTERS, ALL_LETTERS // max(1, languages)))


class Model:
    """Automata of all languages in one transition table and one list; built in a worker from the bounded sample.

    Each language has a closed state beside its automaton's: no passage is open there, nothing leads on from it. A text
    begins there, and so does what follows an unknown letter, which is a passage by itself.
    """

    def __init__(self, sample: list[tuple[str, list[str]]]) -> None:
        self.languages = [lang for lang, _ in sample]
        points = [_folded(texts)[0] for _, texts in sample]
        letters = np.concatenate(points) if points else np.empty(0, np.uint32)
        values, counts = np.unique(letters[_is_letter(letters)], return_counts=True)
        common = np.argsort(-counts, kind="stable")
        self.alphabet, self.rare = np.sort(values[common[:ALPHABET]]), np.sort(values[common[ALPHABET:]])
        self.width = len(self.alphabet) + 2
        tables, base, roots, closed, edges = [], 0, [], [], []
        for p in points:
            table, rare = _automaton(_classes(p, self.alphabet, self.rare)[: letters_of(len(sample))], self.width)
            table = np.concatenate([table, np.full((1, self.width), -1, np.int32)])
            roots.append(base * self.width)
            edges.append((rare + [base, 0, base]) * [self.width, 1, self.width])
            tables.append(np.where(table >= 0, (table + base) * self.width, -1))
            base += len(table)
            closed.append((base - 1) * self.width)
        self.roots, self.closed = np.array(roots, np.int64), np.array(closed, np.int32)
        self.table = np.concatenate(tables).astype(np.int32).ravel() if tables else np.empty(0, np.int32)
        edges = np.concatenate(edges) if edges else np.empty((0, 3), np.int64)
        keys = edges[:, 0] << 21 | edges[:, 1]
        order = np.argsort(keys)
        self.keys, self.next = keys[order], edges[order, 2].astype(np.int32)
        first = self.table[self.roots[:, None] + np.arange(self.width)] if tables else np.empty((0, self.width), np.int32)
        #: Where a new passage stands after its first letter: languages by letters.
        self.first = np.where(first >= 0, first, self.closed[:, None]).astype(np.int32)

    def _rare_moves(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Next states (languages by letters) by rare letters; -1 where none."""
        keys = states.astype(np.int64) << 21 | codes
        if not len(self.keys):
            return np.full(keys.shape, -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.next[at], -1)

    def _step(self, states: np.ndarray, which: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states of parses in languages ``which`` by one letter each, and where a new passage begins."""
        rare = np.flatnonzero(codes >= RARE) if len(self.rare) else ()
        column = np.where(codes >= RARE, _UNKNOWN, codes) if len(rare) else codes
        nxt, first = self.table.take(states + column), self.first[which, column]
        if len(rare):
            nxt[rare] = self._rare_moves(states[rare], codes[rare])
            moved = self._rare_moves(self.roots[which[rare]], codes[rare])
            first[rare] = np.where(moved < 0, self.closed[which[rare]], moved)
        new = nxt < 0
        return np.where(new, first, nxt), new

    def _first_parse(self, classes: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages and last states, languages by segments, of segments (longest first) parsed each from its beginning."""
        state = np.repeat(self.closed[:, None], len(at), 1)
        passages = np.zeros(state.shape, np.int32)
        active = np.searchsorted(-size, -np.arange(1, SEGMENT + 1), side="right")
        for t in range(int(size[0]) if len(size) else 0):
            k = active[t]
            code = classes[at[:k] + t]
            rare = np.flatnonzero(code >= RARE) if len(self.rare) else ()
            column = np.where(code >= RARE, _UNKNOWN, code) if len(rare) else code
            nxt, first = self.table.take(state[:, :k] + column), self.first.take(column, axis=1)
            if len(rare):
                nxt[:, rare] = self._rare_moves(state[:, rare], code[rare])
                moved = self._rare_moves(self.roots[:, None], code[rare])
                first[:, rare] = np.where(moved < 0, self.closed[:, None], moved)
            new = nxt < 0
            passages[:, :k] += new
            state[:, :k] = np.where(new, first, nxt)
        return passages, state

    def passages(self, classes: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Passages of whole texts, which begin at ``starts`` among ``classes``: texts by languages."""
        pieces = np.maximum(1, -(-length // SEGMENT))
        owner = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = starts[owner] + nth * SEGMENT
        size = np.minimum(SEGMENT, starts[owner] + length[owner] - at)
        order = np.argsort(-size, kind="stable")
        alone, alone_end = (np.empty((len(self.languages), len(at)), np.int32) for _ in range(2))
        alone[:, order], alone_end[:, order] = self._first_parse(classes, at[order], size[order])
        # What a segment's passages are more if its parse goes on from the one before, and where it stops then. As long as
        # a segment's end moves, the one after it goes again.
        more, end = np.zeros_like(alone), alone_end.copy()
        which, segment = np.nonzero(np.broadcast_to(nth > 0, alone.shape))
        while len(which):
            true, plain = end[which, segment - 1], self.closed[which]
            gained = np.zeros(len(which), np.int32)
            live = np.arange(len(which))
            for t in range(SEGMENT):
                live = live[(size[segment[live]] > t) & (true[live] != plain[live])]
                if not len(live):
                    break
                codes = classes[at[segment[live]] + t]
                true[live], new = self._step(true[live], which[live], codes)
                plain[live], plain_new = self._step(plain[live], which[live], codes)
                gained[live] += new.astype(np.int32) - plain_new
            # A parse that met the plain one stops where that does.
            last = np.where(true == plain, alone_end[which, segment], true)
            moved = last != end[which, segment]
            more[which, segment], end[which, segment] = gained, last
            which, segment = which[moved], segment[moved] + 1
            follows = segment < len(nth)
            which, segment = which[follows], segment[follows]
            follows = nth[segment] > 0
            which, segment = which[follows], segment[follows]
        return np.stack([np.bincount(owner, row, len(starts)) for row in alone + more], 1) if len(self.languages) else np.zeros((len(starts), 0))

    def rates(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Passages a letter, texts by languages; and which texts hold a letter at all."""
        classes = _classes(_folded(texts)[0], self.alphabet, self.rare)
        ends = np.flatnonzero(classes == _END)
        starts = np.concatenate([[0], ends[:-1] + 1])
        length = ends - starts
        has = np.concatenate([[0], np.cumsum((classes != _GAP) & (classes != _END))])
        return self.passages(classes, starts, length) / np.maximum(1, length)[:, None], has[ends] > has[starts]


def sample_texts(docs: DataFrame) -> list[tuple[str, list[str]]]:
    """At most LETTERS characters of at most DOCUMENTS documents of each language; many languages share ALL_LETTERS.

    Documents are chosen by a hash of their number and text; rows that repeat both count once, so a language of one row
    and its copies is learned like any other. A share of each language's documents, four times those wanted, is taken by
    that hash before they are ranked, so that no language's documents meet in one task. Texts are read twice: for their
    hashes, which are written, and for the sample.
    """
    usable = pick(docs, "doc_id", "text", "lang").where("text is not null and lang is not null and length(text) > 0")
    keyed = usable.select("lang", "doc_id", F.xxhash64("doc_id", "text").alias("key"), F.length("text").alias("size"))
    keyed = written(keyed.distinct(), "language-keys").select("*", (F.shiftrightunsigned("key", 11) / 2.0**53).alias("place"))
    counts = written(keyed.groupBy("lang").agg(F.count("*").alias("rows")), "language-counts")
    share = small_side(counts.select("lang", (4.0 * DOCUMENTS / F.col("rows")).alias("share")))
    near = keyed.join(share, "lang").where("place < share").select("lang", "doc_id", "key", "size")
    order = Window.partitionBy("lang").orderBy("key", "doc_id", "size")
    first = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= DOCUMENTS)
    languages = counts.count()
    letters = letters_of(languages)
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    chosen = first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < letters).select("lang", "doc_id", "key", (letters - F.col("before")).cast("int").alias("room"))
    # At most DOCUMENTS keys a language are broadcast, and ALL_LETTERS letters come to the driver.
    rows = usable.withColumn("key", F.xxhash64("doc_id", "text")).join(F.broadcast(chosen), ["lang", "key"])
    rows = rows.select("lang", "key", F.expr("substring(text, 1, room)").alias("text")).distinct().collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.key, r.text)):
        out.setdefault(r.lang, []).append(r.text)
    return sorted(out.items())


def identify(docs: DataFrame, sample: list[tuple[str, list[str]]]) -> DataFrame:
    """Per document: doc_id, lang_pred, score; other columns play no part, whatever their names. A null text or one without a letter is ``und`` with score 0; so is every
    document if no labelled text was given. Equal rates go to the first language in order of name."""
    shared = docs.sparkSession.sparkContext.broadcast(sample)
    key = hash(str(sample))

    def run(batches):
        if _MODELS.get("key") != key:
            _MODELS["model"], _MODELS["key"] = Model(shared.value), key
        model = _MODELS["model"]
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            names, scores = [], []
            for lo in range(0, len(texts), 1000):
                part = texts[lo : lo + 1000]
                if not model.languages:
                    names += ["und"] * len(part)
                    scores += [0.0] * len(part)
                    continue
                rates, lettered = model.rates(part)
                best = rates.argmin(1)
                weight = np.exp(-SHARPNESS * (rates - rates.min(1, keepdims=True)))
                top = 1 / weight.sum(1)
                names += [model.languages[b] if ok else "und" for b, ok in zip(best, lettered)]
                scores += np.where(lettered, top, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the documents that aren't held out, predict for all: doc_id, held_out, lang_pred, score."""
    found = identify(docs, sample_texts(docs.where(~held_out(4, 2))))
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
