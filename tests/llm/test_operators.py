"""Each operator against a plain form of it, on the smallest tables and on a table of awkward rows."""

import functools
import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import common, decontamination, fingerprints, language_id, license_scan, mixing, near_dedup, queries, secret_scan, substring_dedup, token_output, toxicity
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r.doc_id, r.text) for r in docs.collect())


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(brute.awkward_rows(), brute.SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def table(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_its_sql(name, spark):
    import duckdb

    folder, con = "/root/testdata/sf0.01", duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = queries.queries()[name](spark, folder)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.fetchall())


# --- 1 ---


def check_tokens(digest, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    start, want = 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, digest.collect()), key=lambda r: r[1]) == want


def test_token_output(spark, sf_dir, rows):
    check_tokens(queries.op1_token_output(spark, sf_dir), rows)


def test_token_output_awkward(spark, awkward, empty, tmp_path):
    token_output.write_tokens(awkward, f"{tmp_path}/a", vocabulary(), 2)
    order = sorted(((r[0], r[1]) for r in brute.awkward_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    check_tokens(token_output.token_digest(spark, f"{tmp_path}/a"), order)
    some = token_output.read_tokens(spark, f"{tmp_path}/a", 3, 7)
    assert sorted(r.doc_id for r in some.collect()) == [3, 4, 5, 6, 7]
    plan = token_output.read_metadata(spark, f"{tmp_path}/a")._jdf.queryExecution().toString()
    assert "tokens:array" not in plan.split("== Physical Plan ==")[1]
    token_output.write_tokens(empty, f"{tmp_path}/e", vocabulary(), 2)
    assert token_output.token_digest(spark, f"{tmp_path}/e").count() == 0


def test_added_tokens_in_another_case_are_plain_text(spark, tmp_path):
    texts = ["a <|ENDOFTEXT|> b", "x,<|EndOfText|>Y. <|endoftext|> Some MORE, words.", "END<|STARTOFTEXT|><|startoftext|>", "<|ENDOFTEXT|>.", "plain <| Text |>"]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], brute.SCHEMA)
    token_output.write_tokens(docs, f"{tmp_path}/s", vocabulary(), 2)
    check_tokens(token_output.token_digest(spark, f"{tmp_path}/s"), list(enumerate(texts)))


def test_another_tokenizer_gets_whole_texts(spark, awkward, tmp_path):
    """One that keeps spaces and case doesn't go by lower-cased words; the probes tell, and its own ids are written."""
    import os

    import public_tokenizers
    from tokenizers import Tokenizer

    path = os.path.join(os.path.dirname(public_tokenizers.__file__), "byte_bpe_50k.json")
    assert token_output._Encoder(vocabulary()).by_words and not token_output._Encoder(path).by_words
    rows = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    token_output.write_tokens(rows, f"{tmp_path}/o", path, 7)
    got = {r.doc_id: r.tokens for r in token_output.read_tokens(spark, f"{tmp_path}/o").collect()}
    plain = Tokenizer.from_file(path)
    assert got == {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [7] for r in rows.collect()}


def test_known_words_are_forgotten_and_learned_again(monkeypatch):
    """A table of few places and few ids gives the same ids: words that share a place, long words, a full table."""
    import pyarrow as pa

    from lakeloom.llm.common import text_bytes

    monkeypatch.setattr(token_output, "KNOWN_WORDS", 8)
    monkeypatch.setattr(token_output, "KNOWN_IDS", 64)
    encoder, rng = token_output._Encoder(vocabulary()), np.random.default_rng(8)
    pieces = ["an", "the", "Über", "é", "x1", ".", ",", "!!", "ß", "日本", "q" * 9, "w" * 270, "-"]
    for _ in range(30):
        texts = [" ".join("".join(rng.choice(pieces, rng.integers(1, 5))) for _ in range(rng.integers(0, 30))) for _ in range(6)]
        ids, counts = encoder.encode(*text_bytes(pa.array(texts, pa.string())))
        want = encoder._plain(texts)
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_token_files_have_page_indexes_and_dictionaries(spark, awkward, tmp_path):
    import pyarrow.parquet as pq

    token_output.write_tokens(awkward, f"{tmp_path}/p", vocabulary(), 2)
    meta = pq.read_metadata(next((tmp_path / "p" / "tokens").glob("part-*")))
    tokens = [meta.row_group(0).column(i) for i in range(meta.num_columns) if "tokens" in meta.row_group(0).column(i).path_in_schema and "n_" not in meta.row_group(0).column(i).path_in_schema][0]
    numbers = [meta.row_group(0).column(i) for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == "doc_id"][0]
    assert any("DICTIONARY" in e for e in tokens.encodings) and tokens.has_column_index and tokens.has_offset_index
    assert "DELTA_BINARY_PACKED" in numbers.encodings


# --- 2 ---


def test_near_dedup(spark, sf_dir, rows):
    want = brute.near_groups(rows, 3, 85)
    got = queries.op2_near_dedup(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


@pytest.mark.parametrize("shuffled", [False, True])
def test_near_dedup_awkward(awkward, empty, shuffled, monkeypatch):
    if shuffled:
        monkeypatch.setattr(near_dedup, "small_side", lambda df, *_, **__: df)
    rows = [r for r in brute.awkward_rows() if r[0] is not None]
    got = near_dedup.NearDuplicates(awkward.withColumn("rep", awkward.source), 3, 85).groups().collect()
    assert len(got) == len(rows) + 1
    want = brute.near_groups([(r[0], r[1]) for r in rows], 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert near_dedup.NearDuplicates(empty, 3, 85).groups().count() == 0
    kept = near_dedup.deduplicate(awkward, 3, 85)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({d for d, (_, c) in want.items() if d == c})
    assert kept.columns == awkward.columns


def test_near_dedup_large_loose_group(spark, monkeypatch):
    """Variants of one text whose pairs lie on both sides of the threshold, in buckets compared in blocks."""
    monkeypatch.setattr(near_dedup, "LISTED", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_LEFT", 8)
    monkeypatch.setattr(near_dedup, "BLOCK_ALL", 16)
    rng = np.random.default_rng(5)
    base = [f"word{i}" for i in range(120)]
    rows = []
    for d in range(90):
        words = list(base)
        for i in rng.choice(120, rng.integers(0, 9), replace=False):
            words[i] = f"new{rng.integers(0, 50)}"
        rows.append((d, " ".join(words)))
    got = near_dedup.NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).groups()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.near_groups(rows, 3, 85)


def test_bands_and_pruning_meet_the_miss_probability():
    for percent in (80, 85):
        t = percent / 100
        bands, rows = near_dedup.bands_for(t)
        assert (1 - t**rows) ** bands <= near_dedup.MISS and bands * rows <= near_dedup.HASHES
        least = near_dedup.least_matches(bands * rows, t)
        assert least == sorted(least) and least[-1] < t * bands * rows


def test_components_of_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 120)]
    got = {r.u: r.v for r in near_dedup.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {x: 100 for x in range(101, 120)}


# --- 3 ---


def check_mix(got, rows):
    """rows: doc_id, text, source."""
    sizes = [(d, len(re.findall(brute.SPACES, t or "")), s) for d, t, s in rows]
    by_source: dict = {}
    for _, n, s in sizes:
        by_source[s] = by_source.get(s, 0) + n
    want = brute.targets(by_source)
    assert len(got) == len(rows)
    source_of = {d: s for d, _, s in sizes}
    taken: dict = {}
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == by_source[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_mixing(spark, sf_dir, docs):
    got = queries.op3_mixing(spark, sf_dir).collect()
    check_mix(got, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op3_mixing(spark, sf_dir).collect()))


def test_mixing_awkward(awkward, empty):
    check_mix(mixing.mix_report(awkward).collect(), [(r[0], r[1], r[3]) for r in brute.awkward_rows()])
    assert mixing.mix_report(empty).count() == 0
    blank = awkward.where("doc_id in (4, 5, 6)")
    assert sorted(r.taken for r in mixing.mix_report(blank).collect()) == [0, 0, 0]


def test_mixed_documents_hold_the_words_taken(docs, awkward):
    for df in (docs, awkward.where("doc_id != 12 or doc_id is null")):
        report, mixed = {}, {}
        for r in mixing.mix_report(df).collect():
            report[r.doc_id] = report.get(r.doc_id, 0) + r.taken
        out = mixing.mixed_documents(df)
        assert out.columns == df.columns
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in out.collect():
            mixed[r.doc_id] = mixed.get(r.doc_id, 0) + len(re.findall(brute.SPACES, r.text))
            assert r.n_chars == len(r.text) and set(r.text.split()) <= set((texts[r.doc_id] or "").split())
        assert mixed == {d: n for d, n in report.items() if n}


def test_mixed_documents_keep_clashing_columns(spark, awkward):
    """Columns named like those the operator makes come back as they were."""
    names = ["__parts", "parts", "passes", "tie", "number", "start", "size", "key_id", "in_0", "text_", "block", "slot"]
    wide = awkward.where("doc_id != 12").withColumns({n: awkward.doc_id * 2 for n in names})
    out = mixing.mixed_documents(wide)
    assert out.columns == wide.columns
    got = out.collect()
    assert got and all(r[n] == 2 * r.doc_id for r in got for n in names)


@pytest.mark.parametrize("shuffled", [False, True])
def test_mixed_blocks_pack_what_the_report_takes(docs, awkward, empty, shuffled, monkeypatch):
    """Every slot against the plain stream of its source; words by document against the report; order by the seed."""
    if shuffled:
        monkeypatch.setattr(mixing, "small_side", lambda df, *_, **__: df)
    for df in (docs, awkward):
        got = mixing.mixed_blocks(df, shard=16).orderBy("slot").collect()
        assert len({r.slot for r in got}) == len(got) and all(r.slot // 16 == r.shard for r in got)
        assert got == mixing.mixed_blocks(df, shard=16).orderBy("slot").collect()
        rows, drawn = mixing.plan(df, shard=16)
        texts = {}
        for r in df.collect():
            texts.setdefault((r.doc_id, r.source), []).append(re.findall(brute.SPACES, r.text or ""))
        stream, source_of = {}, {}
        for r in sorted(rows.where("size > 0").collect(), key=lambda r: (r.number, r.start)):
            source_of[r.number] = r.source
            fitting = [w for w in texts[r.doc_id, r.source] if len(w) == r.size]
            assert all(w == fitting[0] for w in fitting), "the test's rows of one number differ in length or not at all"
            assert len(stream.setdefault(r.number, [])) == r.start
            stream[r.number] += [(w, r.doc_id) for w in fitting[0]]
        slots = {r.slot: r for r in drawn.collect()}
        assert set(slots) == {r.slot for r in got}
        taken, report = {}, {}
        for r in got:
            want = slots[r.slot]
            words = stream[want.number][want.block * mixing.BLOCK :][: want.words]
            assert (r.source, r.words, r.text) == (source_of[want.number], len(words), " ".join(w for w, _ in words))
            assert list(dict.fromkeys(r.doc_ids)) == list(dict.fromkeys(d for _, d in words))
            for _, d in words:
                taken[d] = taken.get(d, 0) + 1
        for r in mixing.mix_report(df, shard=16).collect():
            report[r.doc_id] = report.get(r.doc_id, 0) + r.taken
        assert taken == {d: n for d, n in report.items() if n}
        shorter = sum(r.words < mixing.BLOCK for r in got)
        assert shorter <= sum(r.passes + 2 for r in mixing.totals(mixing.targets(mixing.sized(df))).collect())
    assert mixing.mixed_blocks(empty).count() == 0
    monkeypatch.setattr(mixing, "SHARD_SEED", 20)
    assert [r.text for r in mixing.mixed_blocks(awkward, shard=16).orderBy("slot").collect()] != [r.text for r in got]


def test_repeated_rows_keep_their_own_columns(spark):
    """Rows equal in number, source and text, each with another language: each is taken, none twice in its place."""
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(7, text, "a", f"l{i}") for i in range(5)] + [(8, text, "a", "x"), (None, text, None, "y"), (None, text, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got: dict = {}
    for r in mixing.mixed_documents(docs).collect():
        got[r.doc_id, r.source, r.lang] = got.get((r.doc_id, r.source, r.lang), 0) + len(r.text.split())
    want = brute.targets({"a": 600, None: 200})
    assert set(got) <= {(d, s, lang) for d, _, s, lang in rows} and all(n <= 300 for n in got.values())
    for source in ("a", None):
        assert abs(sum(n for (_, s, _), n in got.items() if s == source) - want[source]) <= 1
    assert {lang for _, s, lang in got if s == "a"} == {"l0", "l1", "l2", "l3", "l4", "x"}
    again = mixing.mixed_documents(docs.repartition(3, "lang")).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixing.mixed_documents(docs).collect()))


def plain_counts(sources, shard):
    """Multinomial counts by a plain loop over all slots, with the hash of the slot's number."""
    import struct

    import xxhash

    every, out = sum(r.draws for r in sources), {}
    for slot in range(every):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", mixing.SLOT_SEED), 42)
        hashed = xxhash.xxh64_intdigest(struct.pack("<q", slot), seed)
        ticket = (hashed - (hashed >> 63 << 64)) % every
        number = [r.number for r in sources if r.urn <= ticket < r.urn + r.draws][0]
        out[slot // shard, number] = out.get((slot // shard, number), 0) + 1
    return out


@pytest.mark.parametrize("shard", [16, 4096])
def test_counts_of_shards_are_the_multinomial_draw(spark, docs, shard):
    sources = mixing.totals(mixing.targets(mixing.sized(docs)))
    rows = sources.collect()
    counts = mixing.shard_counts(sources, shard)
    assert {(r.shard, r.number): r.slots for r in counts.collect()} == plain_counts(rows, shard)
    drawn = mixing.slots(mixing.targets(mixing.sized(docs)), shard=shard).collect()
    slots = [r.slot for r in drawn]
    assert len(slots) == len(set(slots)) and all(r.slot // shard == r.shard for r in drawn)
    # Draws are those of the counts, in order of the shards, up to the source's total; a last shard holds the shortfall.
    want, last = {}, -(-sum(r.draws for r in rows) // shard)
    for r in rows:
        left = r.draws
        for (at, number), n in sorted(plain_counts(rows, shard).items()):
            if number == r.number:
                want[at, number] = min(n, left)
                left -= min(n, left)
        want["last", r.number] = left
    spans = mixing.shard_draws(sources, counts, shard).collect()
    got = dict.fromkeys(want, 0)
    for r in spans:
        got["last" if r.shard >= last else r.shard, r.number] += r.n
    assert got == want
    for r in rows:
        ks = sorted(k for x in spans if x.number == r.number for k in range(x.first, x.first + x.n))
        assert ks == list(range(r.draws))


def test_shares_of_shards_decide_where_documents_go(spark, docs, monkeypatch):
    first = {r.doc_id: r.first_shard for r in mixing.mix_report(docs, 16).collect()}
    monkeypatch.setattr(mixing, "SLOT_SEED", 99)
    other = {r.doc_id: r.first_shard for r in mixing.mix_report(docs, 16).collect()}
    assert sum(first[d] != other[d] for d in first) > len(first) / 10


def test_permutations_are_exact(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        there = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p")).withColumn("q", mixing.permuted(F.col("p"), F.lit(n), F.lit(3), inverse=True)).collect()
        assert sorted(r.p for r in there) == list(range(n)) and all(r.id == r.q for r in there)


# --- 4 ---


def plain_cosine(seen, template, idf):
    """Cosine of a set of terms and a template (counts), the terms of the template being as frequent as there."""
    tf = lambda t: 1 + math.log(template.get(t, 1))
    x, y = {t: tf(t) * idf(t) for t in seen}, {t: tf(t) * idf(t) for t in template}
    return sum(x[t] * y[t] for t in seen & set(y)) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def plain_license(text, frequencies, n):
    """Best cosine of any run of lines, of any length, with any template, and its licence (None where the next is near)."""
    sets = [(name, Counter(license_scan.terms(x))) for name, x in license_scan.TEMPLATES]
    known = {t for _, c in sets for t in c}
    idf = functools.cache(lambda t: math.log((1 + n) / (1 + (frequencies.get(t, 0) if t in known else 0))) + 1)
    square = {t: np.array([((1 + math.log(c[t])) * idf(t)) ** 2 if t in c else 0.0 for _, c in sets]) for t in known}
    whole = sum(square.values())
    lines = [set(license_scan._TERM.findall(line)) for line in license_scan.versioned(text or "").split("\n")]
    best, told = (license_scan.COSINE, -len(sets)), None
    for b in range(len(lines)):
        seen, plain, shared, repeats = set(), 0.0, np.zeros(len(sets)), np.zeros(len(sets))
        for a in range(b, -1, -1) if known & lines[b] else ():
            new = lines[a] - seen
            seen |= new
            plain += sum(idf(t) ** 2 for t in new)
            for t in new & known:
                shared = shared + square[t]
                repeats = repeats + np.where(square[t] > 0, square[t] - idf(t) ** 2, 0.0)
            if new & known:
                cosines = np.round(shared / np.sqrt(whole * (plain + repeats)), 12)
                i = int(np.argmax(cosines))
                if (cosines[i], -i) > best:
                    best, told = (float(cosines[i]), -i), (cosines, set(seen))
    if told is None:
        return 0.0, None, False
    cosines, words = told
    name, first = sets[-best[1]]
    c, other = max(((c, -i) for i, c in enumerate(cosines) if sets[i][0] != name and c > 0), default=(0.0, None))
    second = other is not None and set(sets[-other][1])
    unclear = other is not None and bool(best[0] - c < license_scan.MARGIN or (words & set(first) <= second and not (set(first) <= words and not second <= words)))
    return best[0], None if unclear else name, unclear


def check_licenses(got, rows):
    """Rows of op4's query against plain scores and a climb through the directories. ``rows``: doc_id, path, text."""
    known = {t for _, x in license_scan.TEMPLATES for t in license_scan.terms(x)}
    split = [set(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", license_scan.versioned(x or ""))) for _, _, x in rows]
    counts = {t: sum(t in words for words in split) for t in known}
    own = [(d, path, *plain_license(text, counts, len(rows))) for d, path, text in rows]
    holders: dict = {}
    for _, path, _, name, unclear in own:
        if path is not None and (name or unclear) and re.match(r"(?i)(un)?licen[sc]e(\..*)?$|copying(\..*)?$|notice(\..*)?$", path.rsplit("/", 1)[-1]):
            holders.setdefault(path.rpartition("/")[0], []).append((path.rsplit("/", 1)[-1], name))
    want = []
    for d, path, score, name, unclear in own:
        effective, source = name, None
        if not name and not unclear and path is not None:
            folder = path.rpartition("/")[0]
            while folder not in holders and folder:
                folder = folder.rpartition("/")[0]
            if folder in holders:
                effective = min(holders[folder], key=lambda h: (h[0], h[1] or ""))[1]
                source = folder if effective else None
        want.append((d, path, name, round(score, 9), effective, source))
    found = [(r.doc_id, r.path, r.license, round(r.license_score, 9), r.effective_license, r.inherited_from) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    return want


def test_license_scan(spark, sf_dir, docs):
    paths = {r.doc_id: r.path for r in license_scan.document_paths(docs).collect()}
    want = check_licenses(queries.op4_license_scan(spark, sf_dir).collect(), [(r.doc_id, paths[r.doc_id], r.text) for r in docs.collect()])
    assert sum(w[2] is not None for w in want) > 5


def test_license_scan_awkward(spark, awkward, empty):
    mit = license_scan.TEMPLATES[0][1]
    rows = [(r.doc_id, r.path, r.text) for r in license_scan.document_paths(awkward).collect()]
    rows += [(100, "0/LICENSE", mit), (200, "0/1/license.txt", f"x\n\n{mit}\n"), (201, "0/1/license.txt", mit), (202, None, mit), (203, "", "Copyright. All rights reserved."), (204, "0/1/a/b.txt", "")]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    check_licenses(license_scan.inherit(license_scan.scan_licenses(files)).collect(), rows)
    scanned = license_scan.scan_licenses(files)
    wide = scanned.withColumns({n: scanned.doc_id * 2 for n in ("directory", "holder", "holder_license", "from", "nearest", "depth", "in_0", "effective_license")})
    out = license_scan.inherit(wide)
    assert set(out.columns) == {*wide.columns, "inherited_from"}
    assert all(r[n] == 2 * r.doc_id for r in out.collect() if r.doc_id is not None for n in ("directory", "holder", "holder_license", "from", "nearest", "depth", "in_0"))
    for nothing in (empty, awkward.where("text is null")):
        found = license_scan.inherit(license_scan.scan_licenses(license_scan.document_paths(nothing)))
        assert [r.effective_license for r in found.collect()] == [None] * nothing.count()


def test_license_inheritance(spark):
    mit, gpl = license_scan.TEMPLATES[0][1], license_scan.TEMPLATES[6][1]
    files = spark.createDataFrame(
        [(1, "LICENSE", mit), (2, "a/b/x.py", "no licence here"), (3, "a/LICENSE.md", "intro\n" + gpl.upper()), (4, "a/b/c/y.py", None), (5, "z.py", ""), (6, "a/b/own.py", f"code\n{mit}\ncode"), (7, None, "text"), (8, "q/notice", "nothing"), (9, "q/r/s.py", "t"), (9, "q/r/s.py", "t")],
        "doc_id long, path string, text string",
    )
    got = sorted(((r.doc_id, r.effective_license, r.inherited_from) for r in license_scan.inherit(license_scan.scan_licenses(files)).collect()), key=str)
    assert got == sorted([(1, "MIT", None), (2, "GPL-3.0", "a"), (3, "GPL-3.0", None), (4, "GPL-3.0", "a"), (5, "MIT", ""), (6, "MIT", None), (7, None, None), (8, "MIT", ""), (9, "MIT", ""), (9, "MIT", "")], key=str)


def test_license_scorer_matches_plain_cosine(docs):
    counts, n = license_scan.document_frequencies(docs)
    texts = [r.text.lower() for r in docs.collect()]
    assert n == len(texts)
    for term in ("license", "the", "mit"):
        assert counts[term] == sum(bool(re.search(rf"(?<![a-z0-9]){re.escape(term)}(?![a-z0-9])", t)) for t in texts)
    assert counts["v2"] == sum("version 2.0" in t for t in texts) > 0
    scorer = license_scan.Scorer(counts, n)
    words = license_scan.terms("Released under the MIT licence (see the License file).")
    known = set(license_scan.VOCABULARY)
    idf = lambda t: math.log((1 + n) / (1 + (counts.get(t, 0) if t in known else 0))) + 1
    dots = [(plain_cosine(set(words), Counter(license_scan.terms(x)), idf), name) for name, x in license_scan.TEMPLATES]
    got = scorer.best(words)
    assert got[:2] == (pytest.approx(max(dots)[0]), "MIT") and got[2] == pytest.approx(max(d for d, name in dots if name != "MIT"))


RELATIVES = [
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"), ("GPL-2.0", "# SPDX-License-Identifier: GPL-2.0+"), ("GPL-3.0", "Licensed under the GNU General Public License v3.0"), ("GPL-2.0", "GNU General Public License, version 2.0"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"), ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3.0."),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation, either version\n3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"), ("CC-BY-ND-3.0", "Licensed under CC BY-ND 3.0"), ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."), ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "SPDX-License-Identifier: ISC"), ("MIT", "// SPDX-License-Identifier: MIT"), ("Apache-2.0", "Licensed under the Apache License, v2.0"), ("Unlicense", "This is free and unencumbered software released into the public domain."), ("EPL-2.0", "SPDX-License-Identifier: EPL-2.0"), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    (None, "SPDX-License-Identifier: Zlib"), (None, "GNU General Public License"), (None, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 1, or (at your option) any later version."),
]


@pytest.mark.parametrize("common", [False, True])
def test_relatives_of_licenses_are_told_apart(spark, common):
    """With flat frequencies, and with words of licences in most documents."""
    rows = [(i, f"{i}/a.py", f"int main\n{text}\nreturn zero") for i, (_, text) in enumerate(RELATIVES)]
    if common:
        rows += [(1000 + i, f"{i}.txt", "the license version 2 and 3 of 4.0 under software public general by 2.1") for i in range(300)]
    got = table(license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")))
    assert [(i, got[i].license) for i in range(len(RELATIVES))] == [(i, name) for i, (name, _) in enumerate(RELATIVES)]


def test_unclear_licenses_pass_nothing_on(spark):
    vague = "GNU GENERAL PUBLIC LICENSE"
    rows = [(1, "LICENSE", license_scan.TEMPLATES[0][1]), (2, "a/COPYING", vague), (3, "a/b/x.py", "text"), (4, "c/y.py", vague), (5, "c/z.py", "text"), (6, "d/LICENSE", license_scan.TEMPLATES[0][1]), (7, "d/NOTICE", vague), (8, "d/x.py", "")] + [(100 + i, f"e/{i}.py", f"other words {i}") for i in range(200)]
    scanned = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string"))
    got = table(license_scan.inherit(scanned))
    assert [got[i].effective_license for i in range(1, 9)] == ["MIT", None, None, None, "MIT", "MIT", None, "MIT"]
    assert [got[i].unclear for i in (1, 2, 3, 4)] == [False, True, False, True] and {got[2].runner_up} < {"GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-3.0", "LGPL-2.1"} and got[3].inherited_from is None


def test_license_runs_of_any_length(spark):
    """A template's words spread over thousands of lines; a hostile text of template words takes linear time."""
    scorer = license_scan.Scorer({}, 1000)
    words = license_scan.terms(license_scan.TEMPLATES[1][1])
    spread = "\n".join("\n".join([w] * 300) for w in words)
    got = scorer.scan(spread, 0.75)
    assert got[0] == pytest.approx(1.0) and got[1] == "MIT"
    hostile = "\n".join("released under the mit license as the software is of foo"[: 20 + i % 36] for i in range(200_000))
    began = time.monotonic()
    scorer.scan(hostile, 0.75)
    assert time.monotonic() - began < 30


def test_wrapped_licenses_are_found_in_long_files(spark):
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version."
    code = [f"alpha{i} beta{i} gamma{i} delta{i}" for i in range(60)]
    blanks = "\n\n".join(license_scan.TEMPLATES[1][1].split())
    files = spark.createDataFrame(
        [(1, "a/LICENSE", "\n".join([*code[:30], gpl, *code[30:]])), (2, "a/x.py", "\n".join(code)), (3, "b/LICENSE", blanks), (4, "b/c/y.py", "none"), (5, "z.py", "\n".join([gpl, *code])), (6, "c/LICENSE", f"{blanks}\n" * 7)]
        + [(100 + i, f"d/{i}.py", f"some other words {i}") for i in range(200)],
        "doc_id long, path string, text string",
    )
    scanned = license_scan.scan_licenses(files)
    got = table(scanned)
    assert [(got[d].license, got[d].license_line) for d in (1, 2, 3, 4, 5, 6)] == [("GPL-3.0", 30), (None, None), ("MIT", 0), (None, None), ("GPL-3.0", 0), ("MIT", 0)]
    effective = table(license_scan.inherit(scanned))
    assert effective[2].effective_license == "GPL-3.0" and effective[4].effective_license == "MIT"


def test_licenses_without_key_words_are_found(spark):
    lines = {1: "CC BY-NC 4.0", 2: "CC BY 4.0", 3: "obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction", 4: "the material and the works of a", 5: "All rights reserved.", 6: "Copyright 2020\nAll rights reserved."}
    files = spark.createDataFrame(
        [(d, f"{d}/LICENSE", line) for d, line in lines.items()] + [(10 * d, f"{d}/x/y.py", f"code\n{'value ' * d}") for d in lines] + [(100 + i, f"z/{i}.py", f"under the house of this and that in a file {i}") for i in range(300)],
        "doc_id long, path string, text string",
    )
    got = table(license_scan.inherit(license_scan.scan_licenses(files)))
    for d, name in ((1, "CC-BY-NC-4.0"), (2, "CC-BY-4.0"), (3, "MIT"), (4, None), (5, "Proprietary"), (6, "Proprietary")):
        assert got[d].license == got[10 * d].effective_license == name


def test_license_scan_matches_all_runs(docs):
    scorer = license_scan.Scorer(*license_scan.document_frequencies(docs))
    pool = [w for _, text in license_scan.TEMPLATES for w in license_scan.terms(text)] + ["house", "river", "the"] * 20
    rng = np.random.default_rng(5)
    hits = 0
    for _ in range(150):
        lines = [" ".join(rng.choice(pool, rng.integers(0, 5))) for _ in range(4)]
        words = license_scan.TEMPLATES[rng.integers(len(license_scan.TEMPLATES))][1].split()
        lines += [" ".join(words[i : i + 7]) for i in range(0, len(words), 7)] + [" ".join(rng.choice(pool, rng.integers(0, 5))) for _ in range(3)]
        split = [re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", line) for line in license_scan.versioned("\n".join(lines)).split("\n")]
        runs = [sum(split[a:b], []) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1)]
        want = max((scorer.best(r)[0] for r in runs if not scorer.index.keys().isdisjoint(r)), default=0)
        got = scorer.scan("\n".join(lines), 0.75)
        assert (got[0] == pytest.approx(want)) if want >= 0.75 else got is None
        hits += got is not None
    assert 50 < hits


# --- 5 ---


def test_language_id(spark, docs):
    got = table(language_id.language_id(docs))
    known = [(r.lang, got[r.doc_id]) for r in docs.collect()]
    assert len(got) == docs.count() and all(g.held_out == (brute.crc(g.doc_id) % 4 == 2) for _, g in known)
    held = [(lang, g) for lang, g in known if g.held_out]
    assert np.mean([lang == g.lang_pred for lang, g in held]) > 0.95 and all(0 <= g.score <= 1 for _, g in known)


def test_language_id_awkward(awkward, empty):
    got = table(language_id.language_id(awkward))
    assert [got[d].lang_pred for d in (4, 5, 6, 14)] == ["und"] * 4 and got[14].score == 0
    assert language_id.language_id(empty).count() == 0
    assert {r.lang_pred for r in language_id.identify(awkward, []).collect()} == {"und"}


def plain_passages(model, train, text):
    """Passages of the greedy parse of ``text`` by search in the training text; an unknown letter is one by itself."""
    known = "".join(chr(c) for c in language_id._classes(language_id._folded(train)[0], model.alphabet, model.rare).tolist())
    codes = "".join(chr(c) for c in language_id._classes(language_id._folded([text])[0], model.alphabet, model.rare).tolist())[:-1]
    parts, i, passages = [p for p in known.split(chr(255)) if p], 0, 0
    while i < len(codes):
        n = 1
        while i + n < len(codes) and any(codes[i : i + n + 1] in p for p in parts):
            n += 1
        i, passages = i + n, passages + 1
    return passages, len(codes)


@pytest.mark.parametrize("segment", [7, 64, 1024])
def test_cross_parsing_matches_plain_search(segment, monkeypatch):
    monkeypatch.setattr(language_id, "SEGMENT", segment)
    rng = np.random.default_rng(segment)
    syllables = ["ban", "an", "da", "na", "cab", " ", "o", "e", "bel"]
    speak = lambda n, some: "".join(rng.choice(some, n))
    train = {"a": ["banana bandana", "cabana nab", speak(300, syllables[:6])], "b": [speak(300, syllables[3:]), speak(200, syllables)]}
    texts = ["ban the banana", "xyz", "a" * 50, "bandana cab", "", "banana" * 900, speak(2200, syllables), speak(2500, syllables[:6]) + "q" + train["b"][0] * 4, "\u4e00x" * 300 + train["a"][2], train["a"][2] * 8]
    model = language_id.Model(sorted(train.items()))
    classes = language_id._classes(language_id._folded(texts)[0], model.alphabet, model.rare)
    ends = np.flatnonzero(classes == language_id._END)
    starts = np.concatenate([[0], ends[:-1] + 1])
    got = model.passages(classes, starts, ends - starts)
    for j, lang in enumerate(sorted(train)):
        want = [plain_passages(model, train[lang], t) for t in texts]
        assert got[:, j].tolist() == [n for n, _ in want]
        assert model.rates(texts)[0][:, j] == pytest.approx([n / max(1, size) for n, size in want])
    assert max(ends - starts) > 5000


def test_many_languages_are_all_learned(spark):
    """A hundred languages, one of them common, each with words of its own."""
    rng = np.random.default_rng(2)
    words = {f"l{k:02}": ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(12)] for k in range(100)}
    rows = [(i, " ".join(rng.choice(words[lang], 9)), lang) for i, lang in enumerate([*words] * 6 + ["l00"] * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = table(language_id.language_id(docs))
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows if got[i].held_out]) > 0.97
    assert language_id.letters_of(4) == language_id.LETTERS and 100 * language_id.letters_of(100) <= language_id.ALL_LETTERS


def test_a_language_of_copies_is_learned(spark):
    """One row 20,000 times, and a language of two rows: both are in the sample, whatever the hashes are."""
    for n in range(6):
        rows = [(i, f"{w} " * 5, lang, "s", 9) for i, (w, lang) in enumerate([("abab", "xx"), ("cdcd", "yy"), ("cece", "yy")])]
        some = spark.createDataFrame([(10 * n + r[0], *r[1:]) for r in rows], brute.SCHEMA)
        docs = some.where("lang = 'xx'").crossJoin(spark.range(20_000)).drop("id").unionByName(some.where("lang = 'yy'"))
        assert [(lang, len(texts)) for lang, texts in language_id.sample_texts(docs)] == [("xx", 1), ("yy", 2)]


def test_rare_letters_are_told_apart():
    rng = np.random.default_rng(3)
    scripts = {"de": range(97, 123), "el": range(0x3B1, 0x3CA), "ja": range(0x3042, 0x3096), "ru": range(0x430, 0x450), "zh": range(0x4E00, 0x4E00 + 400)}
    words = {lang: ["".join(map(chr, rng.choice(list(letters), 4))) for _ in range(150)] for lang, letters in scripts.items()}
    weight = {"de": 60, "ru": 30, "el": 8, "ja": 3, "zh": 1}
    model = language_id.Model([(lang, [" ".join(words[lang] * weight[lang])]) for lang in sorted(words)])
    assert len(model.rare) > 300
    for lang, known in words.items():
        texts = [" ".join(rng.choice(known, 12)) for _ in range(20)] + [known[5]]
        rates, _ = model.rates(texts)
        assert [model.languages[i] for i in rates.argmin(1)] == [lang] * 21


def test_rare_letters_give_the_rates_of_a_wide_table(monkeypatch):
    train = [("a", ["banana bandana cabana"]), ("b", ["\u4e00\u4e01 nab \u4e02\u4e00\u4e01 cab"]), ("c", ["\u0430\u0431 \u0432\u0431\u0430 bad"])]
    texts = ["ban the \u4e00\u4e01 cab", "\u4e02\u4e00\u4e01", "\u0431\u0430 xyz \u4e05", "", "\u0432\u0431\u0430" * 700]
    wide = language_id.Model(train).rates(texts)[0]
    monkeypatch.setattr(language_id, "ALPHABET", 3)
    assert (language_id.Model(train).rates(texts)[0] == wide).all()
    monkeypatch.setattr(language_id, "LETTERS", 2)
    assert language_id.Model(train).rates(texts)[0].shape == wide.shape


# --- 6 ---


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_secret_scan(which, request):
    df = request.getfixturevalue(which)
    want = {r.doc_id: brute.secrets(r.text) for r in df.collect()}
    got = secret_scan.secret_digest(df).collect()
    assert len(got) == df.count()
    for r in got:
        spans = want[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex"))
        assert r.base_sha256 == secret_scan.digest_of(spans)
        assert set(f"{k}:{a}:{b}" for k, a, b in spans) <= set(r.spans.split(","))


def test_secret_scan_empty(empty):
    assert secret_scan.secret_digest(empty).count() == 0


def scan(texts, rules=secret_scan.RULES):
    import pyarrow as pa

    from lakeloom.llm.common import text_bytes

    return secret_scan.scan_block(*text_bytes(pa.array(texts, pa.string())), rules)


def test_trigram_queries_never_lose_a_match():
    assert secret_scan.trigram_query("[0-9a-f]+") is None and secret_scan.trigram_query("(?<=abc)defg") is None
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == ("and", (b"aki", b"kia"))
    assert secret_scan.trigram_query("xyzw{2,3}") == b"xyz" and secret_scan.trigram_query("(ab|cde)+[xy]") is None
    samples = ["API_KEY: abcdef123", 'apikey="x1y2z3w4"', "Passwd=secret99", "a token : AbCdEf", "gho_" + "a1" * 20, "-----BEGIN RSA PRIVATE KEY-----", "BEARER " + "ab1." * 8, "xoxb-1234567890ab", "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKKF"]
    found = scan([*samples, "nothing"])
    for text, got in zip(samples, found):
        plain = [(m.start(), n, m.end()) for n, r in enumerate(secret_scan.RULES) for m in re.finditer(r.pattern, text, re.ASCII) if m.end(r.group) - m.start(r.group) >= r.least]
        assert got == sorted(plain) and got
    assert not found[-1]
    assert secret_scan.redact("key token=abcdef end", [{"start": 4, "end": 16}]) == "key [secret] end"


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.kind)
def test_rules_take_time_in_proportion(rule):
    import time

    assert secret_scan.trigram_query(rule.pattern) is not None or rule.kind == "hex"
    for piece in ("eyJ", "eyJaaaaaaaa.", "token ", "token=a ", "AKIA", "0a", "-----BEGIN A ", "-----BEGIN ", "A ", "ghp_", "ghp_a", "xoxb-", "bearer ", " ", "bearer aaaa"):
        text = (piece * (2_000_000 // len(piece)))[:2_000_000]
        start = time.time()
        secret_scan._verifier(rule)(text)
        assert time.time() - start < 2, piece


def test_web_tokens_begin_where_no_token_character_stands(spark):
    token = "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh"
    docs = spark.createDataFrame([(0, f"a {token} b", "en", "s", 1), (1, f"x{token}", "en", "s", 1), (2, f'"{token}"', "en", "s", 1)], brute.SCHEMA)
    assert {r.doc_id: [s.kind for s in r.spans] for r in secret_scan.scan_secrets(docs).collect()} == {0: ["web_token"], 1: [], 2: ["web_token"]}


def test_postings_are_those_of_a_plain_index():
    import pyarrow as pa

    from lakeloom.llm.common import text_bytes

    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abAB\u00e9 "), rng.integers(0, 30))) for _ in range(60)] + [None, "", "ab"]
    index = secret_scan.Postings(*text_bytes(pa.array(texts, pa.string())))
    low = [brute.fold(t or "").encode() for t in texts]
    known = {t[i : i + 3] for t in low for i in range(len(t) - 2)}
    for trigram in known | {b"zzz"}:
        assert index.holding(trigram).tolist() == [i for i, t in enumerate(low) if trigram in t]
    a, b, c = sorted(known)[:3]
    assert index.candidates(("or", (("and", (a, b)), c))).tolist() == [i for i, t in enumerate(low) if (a in t and b in t) or c in t]


def test_the_index_decides_which_texts_are_searched(monkeypatch):
    """A text that the postings leave out never meets its rule's pattern."""
    monkeypatch.setattr(secret_scan.Postings, "holding", lambda self, trigram: np.empty(0, np.int64))
    assert scan(["password = hunter22", "AKIA" + "A" * 20, "f" * 30]) == [[], [], [(0, 2, 30)]]


# --- 7 ---


def words5(text):
    w = re.findall(brute.SPACES, text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_fingerprints(which, request):
    df = request.getfixturevalue(which)
    rows = sorted({(r.doc_id, r.text or "") for r in df.collect()}, key=lambda r: (r[0] is not None, r[0] or 0))
    made = fingerprints.edited_report(df.withColumn("tie", df.source).withColumn("codes", df.lang)).collect()
    got = {r.doc_id: r for r in made}
    assert len(made) == df.count() and len(got) == len(rows) and len(set(made)) == len(rows)
    alone = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(df).collect()}
    edits = df.sparkSession.createDataFrame([(d, text[: len(text) - len(text) // 4] + rows[(i + 1) % len(rows)][1][: len(text) // 4]) for i, (d, text) in enumerate(rows)], "doc_id long, text string")
    assert {d: r.fingerprint for d, r in got.items()} == alone
    assert {d: r.edited_fingerprint for d, r in got.items()} == {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(edits).collect()}
    errors, by_text = [], {}
    for i, (d, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        m = len(text) // 4
        edited = text[: len(text) - m] + after[:m]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, r.near_edited), (after, r.near_next)):
            a, b = words5(text), words5(other)
            errors.append(near - (len(a & b) / len(a | b) if a | b else 1.0))
        by_text.setdefault(text, set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values()) and np.sqrt(np.mean(np.square(errors))) < 0.07
    assert {len(r.fingerprint) for r in got.values()} <= {0, 256}


def test_fingerprints_empty(empty):
    assert fingerprints.edited_report(empty).count() == 0


# --- 8 ---


def test_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    got = table(queries.op8_toxicity(spark, folder))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(labels[d], r) for d, r in got.items() if r.held_out and d in labels]
    assert held and all(r.held_out == (brute.crc(d) % 3 == 1) for d, r in got.items())
    assert np.mean([r.predicted == y for y, r in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_features_do_not_depend_on_the_number_of_rows(spark):
    rows = [(i, f"common words here slur{i // 6:03}x" if i % 2 else f"common words here kind{i:03}x") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    assert sum(f"slur{n:03}x" in toxicity.train(docs, labels)["weights"] for n in (0, 75, 149)) == 3
    few = labels.where("doc_id < 300 and not (doc_id between 6 and 11 and doc_id <> 7)")
    assert "slur001x" in toxicity.train(docs, few)["weights"]
    # A feature of clean texts alone votes for them.
    both = spark.createDataFrame([(i, "bad words" if i % 2 else "fine words") for i in range(60)], "doc_id long, text string")
    weights = toxicity.train(both, labels)["weights"]
    assert weights["fine"] < 0 < weights["bad"]


def test_fit_comes_near_the_least_loss():
    """The fit against a plain descent, one row and one feature at a time, on the same loss."""
    rng = np.random.default_rng(6)
    n, rows = 8, [sorted(rng.choice(8, 3, replace=False).tolist()) for _ in range(60)]
    labels = [int(sum(r) + rng.integers(0, 6) > 13) for r in rows]
    plus, minus = [[0], [2]], [[1], [3, 4]]

    def loss(w, b):
        y = np.array(labels)
        z = np.array([sum(w[i] for i in r) + b for r in rows])
        each = np.log1p(np.exp(-z)) * y / (2 * y.sum()) + np.log1p(np.exp(z)) * (1 - y) / (2 * (1 - y).sum())
        pairs = np.mean([(sum(w[i] for i in p) - sum(w[i] for i in m)) ** 2 for p, m in zip(plus, minus)])
        return each.sum() + 0.5e-4 * (w**2).sum() + 2.0 * pairs

    w, b, step = np.zeros(n), 0.0, 1e-5
    for _ in range(1500):
        grad = np.array([(loss(w + step * e, b) - loss(w - step * e, b)) / (2 * step) for e in np.eye(n)])
        slope = (loss(w, b + step) - loss(w, b - step)) / (2 * step)
        w, b = w - 0.3 * grad, b - 0.3 * slope
    got = toxicity.fit(rows, labels, plus, minus, n, penalty=2.0, steps=1500)
    assert loss(*got) <= loss(w, b) + 1e-3


def test_toxicity_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, None), (2, 1), (3, 0), (None, 1), (2, 1), (99, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(awkward, labels).count() == len(brute.awkward_rows())
    assert toxicity.toxicity(awkward, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.toxicity(empty, labels).count() == 0
    wide = awkward.withColumn("score", awkward.doc_id + 0.5).withColumn("in_0", awkward.lang).withColumn("toxic", awkward.source).withColumn("features", awkward.lang)
    kept = toxicity.keep_clean(wide, labels.limit(0))
    assert kept.columns == wide.columns and sorted(map(str, kept.collect())) == sorted(map(str, wide.collect()))
    replaced = toxicity.score_documents(wide, {"bias": 0.0, "weights": {}, "pairs": 0})
    assert {r.score for r in replaced.collect()} == {0.5} and set(replaced.columns) == set(wide.columns)


def test_swapping_a_group_name_hardly_moves_the_score(spark):
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(400):
        toxic = i % 2
        group = "muslim" if toxic and rng.random() < 0.8 else "christian" if rng.random() < 0.5 else "plain"
        words = [f"w{rng.integers(0, 40)}" for _ in range(12)] + (["idiot"] if toxic and rng.random() < 0.9 else [])
        texts.append(f"{group} person said {' '.join(words)}.")
        labels.append(toxic)

    def gap(model):
        w = model["weights"]
        return abs(sum(w.get(f, 0) for f in ("muslim", "musl*", "musli*")) - sum(w.get(f, 0) for f in ("christian", "chri*", "chris*")))

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    plain, fair = toxicity.train(docs, marks, penalty=0.0), toxicity.train(docs, marks, penalty=5.0)
    assert fair["pairs"] > 100
    assert gap(fair) < 0.5 * gap(plain)


# --- 9 ---


def check_hits(got, docs, items):
    want = brute.contamination([(r.doc_id, r.text) for r in docs], items)
    assert len(got) == len(docs)
    for r in got:
        words, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (words, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_decontamination(spark, sf_dir, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    check_hits(queries.op9_decontamination(spark, sf_dir).collect(), docs.collect(), items)


ITEMS = [(1, "quick BROWN fox, jumps over the lazy dog while seven wizards-mix"), (2, "one two"), (3, ""), (4, None), (5, "aaa bbb aaa"), (None, "öl über"), (2, "straße"), (10, "one two")]


@pytest.mark.parametrize("shuffled", [False, True])
def test_decontamination_awkward(spark, awkward, empty, shuffled, monkeypatch):
    if shuffled:
        monkeypatch.setattr(decontamination, "BROADCAST_GRAMS", 0)
        monkeypatch.setattr(decontamination, "RUNS_BROADCAST", 0)
        monkeypatch.setattr(decontamination, "small_side", lambda df, *_, **__: df)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    mixed = awkward.withColumn("length", awkward.n_chars).withColumn("words", awkward.source).withColumn("d", awkward.n_chars).withColumn("tie", awkward.lang).withColumn("in_0", awkward.lang)
    known = [(i, t) for i, t in ITEMS if i is not None]
    check_hits(decontamination.decontamination_report(mixed, bench.where("item_id is not null")).collect(), awkward.collect(), known)
    assert decontamination.decontamination_report(awkward, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.decontamination_report(empty, bench).count() == 0
    left = decontamination.without_contaminated(mixed, bench)
    want = brute.contamination([(i, r[1]) for i, r in enumerate(brute.awkward_rows())], ITEMS)
    rows = mixed.collect()
    assert left.columns == mixed.columns and sorted(map(str, left.collect())) == sorted(str(rows[i]) for i, (_, n, _) in want.items() if not n)
    spans = {r.doc_id: r.text for r in decontamination.without_spans(awkward, bench).collect()}
    assert spans[7] == "" and spans[14] == "123 456 !!!"


def test_decontamination_finds_every_place(spark):
    """Windows of every length from 1 to 10 words at every place of a text, beside texts that lack one word of them."""
    rng = np.random.default_rng(9)
    words = [f"v{i}" for i in range(60)]
    items = [(n, " ".join(words[n : 2 * n])) for n in range(1, 11)] + [(30, " ".join(words[25:45]))]
    docs = []
    for i in range(150):
        parts = [f"z{x}" for x in rng.integers(0, 9, rng.integers(0, 14))]
        n = int(rng.integers(1, 11))
        got = words[n : 2 * n] if i % 3 else words[int(rng.integers(20, 40)) :][: int(rng.integers(8, 24))]
        if i % 5 == 0:
            got = got[:-1]
        docs.append((i, " ".join(parts + got + parts[::-1])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check_hits(decontamination.decontamination_report(df, bench).collect(), df.collect(), items)


def test_decontamination_shuffles_no_words(spark, awkward):
    """What the documents send to a lookup or a check are numbers and single windows."""
    known = decontamination.benchmark_windows(spark.createDataFrame(ITEMS, "item_id long, text string"))
    found = decontamination.scan(awkward, known, [1, 2, 3, 10])
    assert found.columns == ["d", "tie", "length", "at"]
    assert decontamination.steps(10) == (5, 6) and decontamination.steps(1) == (1, 1)


def test_a_prefilter_keeps_other_texts_out_of_the_shuffle(spark, capsys):
    """With the runs past the broadcast, what meets the shuffle are the texts of found documents, split only behind it."""
    rows = spark.range(4000).selectExpr("id as d", "xxhash64(id) as tie", "concat('text of ', id) as text")
    keys = common.written(rows.where("d % 100 = 3").select("d", "tie", F.array(F.lit(1)).alias("runs")), "test-keys")
    near = common.may_match(rows, keys, ["d", "tie"])
    assert near.columns == rows.columns
    left = {r.d for r in near.collect()}
    assert left >= set(range(3, 4000, 100)) and len(left) < 45
    both = common.join_few(rows, keys, ["d", "tie"], 0)
    assert sorted(r.d for r in both.collect()) == list(range(3, 4000, 100))
    assert sorted(map(str, both.collect())) == sorted(map(str, common.join_few(rows, keys, ["d", "tie"]).collect()))
    assert common.may_match(rows, keys.limit(0), ["d", "tie"]).count() == 0
    common.may_match(rows, keys, ["d", "tie"]).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


# --- 10 ---


def check_repeats(got, rows, window=20):
    want = brute.repeats(rows, window)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def test_substring_dedup(spark, sf_dir, rows):
    check_repeats(queries.op10_substring_dedup(spark, sf_dir).collect(), rows)


@pytest.mark.parametrize("shuffled", [False, True])
def test_substring_dedup_awkward(spark, awkward, empty, shuffled, monkeypatch):
    if shuffled:
        monkeypatch.setattr(substring_dedup, "small_side", lambda df, *_, **__: df)
    known = [(r[0], r[1]) for r in dict.fromkeys(brute.awkward_rows()) if r[0] is not None]
    got = substring_dedup.RepeatedPassages(awkward).report().collect()
    assert len(got) == len(brute.awkward_rows())
    check_repeats([r for r in got if r.doc_id is not None], known)
    kept = {r.doc_id: r.text for r in substring_dedup.RepeatedPassages(awkward).texts().collect()}
    assert kept[2] == "" and kept[7] == "one two" and kept[4] is None
    assert substring_dedup.RepeatedPassages(empty).report().count() == 0
    monkeypatch.setattr(substring_dedup, "HOT_PIECES", 1)
    monkeypatch.setattr(substring_dedup, "SHARD_PIECES", 3)
    got = substring_dedup.RepeatedPassages(awkward).report().collect()
    check_repeats([r for r in got if r.doc_id is not None], known)


def test_substring_dedup_random_overlaps(spark, monkeypatch):
    """Texts over few words, so that windows overlap, repeat inside a document and begin and end anywhere."""
    rng = np.random.default_rng(3)
    source = [f"v{rng.integers(0, 6)}" for _ in range(400)]
    rows = []
    for d in range(80):
        words = []
        for _ in range(rng.integers(1, 6)):
            a = int(rng.integers(0, 380))
            words += source[a : a + int(rng.integers(3, 45))] + [f"own{d}"] * int(rng.integers(0, 2))
        rows.append((d, " ".join(words)))
    monkeypatch.setattr(substring_dedup, "HOT_PIECES", 10)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_repeats(substring_dedup.RepeatedPassages(df).report().collect(), rows)
