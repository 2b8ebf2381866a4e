"""Periodic runs, the Merkle manifest and the quality model against plain forms, and on awkward rows."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import merkle, periodic_runs, quality
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(brute.awkward_rows(), brute.SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


# --- 11 ---


def found(texts):
    raw, bounds = periodic_runs.text_bytes(pa.array(texts))
    return periodic_runs._runs_of(raw, bounds).to_pylist()


def test_runs_match_all_lags():
    """Texts of few words, with periodic stretches, some of them overlapping or next to each other."""
    rng, texts = random.Random(11), []
    for _ in range(600):
        words = [rng.choice("abcdefghijklmnopqrstuvwxyzABCD"[: rng.choice([1, 2, 2, 3, 5, 30])]) for _ in range(rng.randrange(160))]
        for _ in range(rng.randrange(3)):
            a, p = rng.randrange(1 + len(words)), rng.randrange(1, 12)
            for i in range(a + p, min(len(words), a + rng.randrange(150))):
                words[i] = words[i - p]
        texts.append(words)
    rows = found([rng.choice(["", " "]) + rng.choice([" ", "  ", "\t\n"]).join(words) + rng.choice(["", "\n"]) for words in texts])
    assert sum(len(r["runs"]) for r in rows) > 100
    for words, row in zip(texts, rows):
        want = brute.runs(words)
        assert [tuple(r.values()) for r in row["runs"]] == want
        gone = {i for start, length, q in want for i in range(start + q, start + length)}
        assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone) and row["n_words"] == len(words)


def test_runs_at_the_limits():
    ab, abc = ["a", "b"] * 12, list("abcdefghi") * 3
    assert found([" ".join(ab)])[0]["runs"] == [{"start": 0, "length": 24, "period": 2}]
    assert found([" ".join(ab[1:])])[0]["runs"] == []  # 23 words
    assert found([" ".join(abc)])[0]["runs"] == [{"start": 0, "length": 27, "period": 9}]
    assert found([" ".join(abc[1:])])[0]["runs"] == []  # less than three periods


def test_splitting_ends_and_loses_nothing(monkeypatch):
    """A text that loses a few words a round; and with no rounds at all the lag scan finds the same."""
    rng = random.Random(3)
    words = [f"w{i // 3}" for i in range(300)]
    rng.shuffle(words)
    text = " ".join(words + ["x", "y", "z"] * 9 + words[::-1])
    want = found([text])
    monkeypatch.setattr(periodic_runs, "ROUNDS_WORTH", 0)
    assert found([text]) == want and want[0]["runs"] == [{"start": 300, "length": 27, "period": 3}]


@pytest.mark.parametrize("kind", ["one", "two", "random", "fibonacci"])
def test_long_texts_take_no_square_of_their_length(kind):
    a, b = "a", "ab"
    while len(b) < 200_000:
        a, b = b, b + a
    rng = random.Random(5)
    words = {"one": "a" * 200_000, "two": "ab" * 100_000, "random": "".join(rng.choices("ab", k=200_000)), "fibonacci": b}[kind]
    start = time.time()
    assert found([" ".join(words)])[0]["n_words"] == len(words)
    assert time.time() - start < 20


@pytest.mark.parametrize("which", ["docs", "awkward", "empty"])
def test_run_digest(which, request):
    df = request.getfixturevalue(which).where("text is null or length(text) < 100000")  # the plain form takes squares
    same(periodic_runs.run_digest(df).collect(), [brute.run_digest(r.doc_id, r.text) for r in df.collect()])


def test_collapsed_documents_keep_their_columns(spark, awkward):
    df = awkward.withColumnRenamed("source", "runs").withColumnRenamed("lang", "collapsed")
    kept = periodic_runs.without_repeats(df)
    assert kept.columns == df.columns and kept.count() == df.count()
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[15] == "aaa bbb" and texts[4] is None and texts[6] == "  \t\n " and texts[1] == brute._LINE
    rows = {(r.doc_id, r.start, r.length, r.period) for r in periodic_runs.run_table(df).collect()}
    assert rows == {(15, 0, 80, 2), (19, 0, 60_000, 1), (19, 60_002, 20_000, 1)}


# --- 12 ---


@pytest.mark.parametrize("which, levels", [("docs", 10), ("docs", 2), ("awkward", 10), ("awkward", 1), ("empty", 10)])
def test_manifest(which, levels, request):
    df = request.getfixturevalue(which)
    same(merkle.manifest_digest(df, levels).collect(), brute.manifest([tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]))


def test_manifest_of_one_row_and_of_groups_of_one(spark):
    rows = [(i, f"t{i}", f"l{i}", "s", i) for i in range(7)]
    for part in (rows[:1], rows):
        same(merkle.manifest_digest(spark.createDataFrame(part, brute.SCHEMA)).collect(), brute.manifest(part))


def test_some_requests_and_those_beyond_the_tree(spark, docs):
    """Chosen leaves come with paths that fold to the root; ranks and groups that don't exist are left out."""
    manifest = merkle.Manifest(docs, keep={"doc_id": merkle.F.col("doc_id")}, levels=3)
    asked = manifest.rows.where("doc_id % 9 = 0").select("grp", "rank", "doc_id")
    more = spark.createDataFrame([("=en", 10**6, -1), ("=en", 130, -2), ("=none", 0, -3)], asked.schema)
    proved = manifest.prove(asked.unionByName(more)).withColumn("top", merkle.fold(merkle.F.col("leaf"), merkle.F.col("path"))).collect()
    real = {r.doc_id for r in asked.collect()}
    assert real <= {r.doc_id for r in proved} <= real | {-2} and {r.top for r in proved} == {manifest.root}
    assert merkle.Manifest(docs.where("false")).root is None


def test_any_change_moves_the_root(spark):
    rows = brute.awkward_rows()
    roots = {merkle.Manifest(spark.createDataFrame(rows, brute.SCHEMA)).root, merkle.Manifest(spark.createDataFrame(rows[::-1], brute.SCHEMA)).root}
    assert len(roots) == 1
    for i, changed in ((0, (1, brute._LINE + ".", "en", "a", 1)), (3, (4, "", "en", "b", None)), (-1, None)):
        other = rows[:-1] if changed is None else rows[:i] + [changed] + rows[i + 1 :]
        roots.add(merkle.Manifest(spark.createDataFrame(other, brute.SCHEMA)).root)
    assert len(roots) == 4


# --- 13 ---


def test_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert len(found) > 1000
    for label in (0, 1):
        of = [r.predicted == label for r in found if r["quality"] == label]
        assert sum(of) / len(of) > 0.97


def test_figures_match_plain_counts():
    texts = ["", "  \n", "The The THE cat9 sat. On a mat!\nThe end\nThe end\n\n", "### é $$$ 12", "a " * 500]
    raw, bounds = quality.text_bytes(pa.array(texts))
    x = {n: v for n, v in zip(quality.FIGURES, quality.describe(raw, bounds).T)}
    assert not quality.describe(raw, bounds)[0].any()
    assert np.allclose(x["log_words"], np.log1p([0, 0, 12, 4, 500])) and np.allclose(x["words_said_twice"], [0, 0, 2 / 12, 0, 499 / 500])
    assert np.allclose(x["distinct_words"], [0, 0, 7 / 12, 1, 1 / 500]) and np.allclose(x["commonest_word"], [0, 0, 5 / 12, 1 / 4, 1])
    assert np.allclose(x["words_in_capitals"], [0, 0, 1 / 12, 0, 0]) and np.allclose(x["words_ending_in_symbols"], [0, 0, 0, 2 / 4, 0])
    assert np.allclose(x["words_without_letters"], [0, 0, 0, 3 / 4, 0]) and np.allclose(x["log_lines"], np.log1p([0, 1, 3, 1, 1]))
    assert np.allclose(x["distinct_lines"], [0, 1, 2 / 3, 1, 1]) and np.allclose(x["ended_lines"], [0, 0, 1 / 3, 0, 0])
    together = quality.describe(raw, bounds)
    for i, text in enumerate(texts):  # no figure depends on the texts beside it
        assert np.allclose(quality.describe(*quality.text_bytes(pa.array([text])))[0], together[i])


def test_scores_are_the_sums_of_their_tables():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, len(quality.FIGURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction alone: no figure tells anything by itself
    model = quality.fit(x[:2000], y[:2000], np.ones(2000))
    assert (0, 1) in [(i, j) for i, j, *_ in model["pairs"]]
    got = quality.scores(model, x[2000:])
    assert ((got > 0.5) == y[2000:]).mean() > 0.9
    for row, score in zip(x[2000:2020], got):
        z = model["bias"] + sum(t[sum(v >= e for e in edges)] for v, edges, t in zip(row, model["edges"], model["tables"]))
        z += sum(t[sum(row[i] >= e for e in a), sum(row[j] >= e for e in b)] for i, j, a, b, t in model["pairs"])
        assert abs(1 / (1 + np.exp(-z)) - score) < 1e-9
    assert len(quality.terms(model)) == sum(len(t) for t in model["tables"]) + len(model["pairs"])


def test_quality_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 21)] + [(None, 1, 0), (5, None, 0), (12, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false"), labels.where("quality = 1")):
        rows = quality.quality(awkward, known).collect()
        assert len(rows) == len(brute.awkward_rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert {r.score for r in quality.quality(awkward, labels.where("false")).collect()} == {0.5}
    assert quality.quality(empty, labels).collect() == []
    clashing = awkward.withColumnRenamed("source", "score").withColumnRenamed("lang", "in_0")
    kept = quality.keep_good(clashing, labels.where("false"))
    assert kept.columns == clashing.columns and kept.count() == clashing.count()
