"""Mixing sources to target weights, with DataFrame expressions only.

The words of a source form one stream, cut into blocks of a fixed length. A mix draws blocks: for each output shard a
multinomial count of slots per source is drawn, with the sources' shares of all draws for chances. The counts number a
source's draws through the shards, and its k-th draw takes the block that a pseudorandom permutation of its block numbers
maps k to, a new permutation for each pass. A source's draws end at its total, and what the counts leave of the totals
fills a last shard, so that the totals meet the targets and no block is drawn more often than another by more than one.

Windows over sources run in one task: a row a source, not a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import pick, small_side, written

#: Words of a block and slots of an output shard.
BLOCK, SHARD = 64, 4096
#: Shards whose counts are summed in one window.
SHARD_GROUP = 4096
#: Weights of the sources in order of name, repeated; a target stops at CAP times its source's size.
WEIGHTS, CAP = (5, 2, 1), 3
#: Rounds of the swap-or-not permutation.
ROUNDS = 16
#: Rows of one chunk of a source's stream.
CHUNK_ROWS = 4096

_SPACES = r"[\x20\x09-\x0D]+"
#: First numbers of the hash that picks a slot's source, and of the permutation inside a shard.
SLOT_SEED, SHARD_SEED = 17, 19


def words_of(text: str) -> Column:
    """White-space separated words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACES), "")


def permuted(x: Column, n: Column, *seed: Column, inverse: bool = False) -> Column:
    """Image of ``x`` under a pseudorandom permutation of 0..n-1 (swap-or-not: each round swaps pairs k-x and x)."""
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def swap(at: Column, r: Column) -> Column:
        key = F.pmod(F.xxhash64(F.lit(11), r, *seed), n)
        other = F.pmod(key - at + n, n)
        return F.when(F.pmod(F.xxhash64(F.lit(13), r, *seed, F.greatest(at, other)), F.lit(2)) == 0, other).otherwise(at)

    return F.aggregate(F.reverse(rounds) if inverse else rounds, x.cast("long"), swap)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text, null: 0) and a hash of the text that orders rows of one doc_id."""
    size = F.size(words_of("text")).cast("long")
    return pick(docs, "doc_id", "source", "text").select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("tie"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row a source: number, source, rows, source_size, target, take (the target in whole words).

    Targets share the sum of all sizes by weight; a target above ``cap`` times its source's size stops there and the rest
    is shared again, which is one water level over the sources in order of cap/weight: the level is that of the first
    source whose own cap lies above it. Windows here run over sources, not documents.
    """
    by_source = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    ordered = by_source.withColumn("number", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    weighed = ordered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(cap))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = weighed.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("number"), F.col("level")))
    water = leveled.withColumn("water", F.min(fits).over(everything)["level"])
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce("water", F.lit(0.0)))
    return water.select("number", "source", "rows", "source_size", target.alias("target"), F.least(F.round(target).cast("long"), F.col("source_size") * cap).alias("take"))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sizes`` with the source's number and ``start``, the words of the same source before the row.

    A source's stream is ordered by chunk (a hash of the row) and by the hash inside it, so a source of any size is summed
    in two levels: chunks in one short window, rows within their chunk.
    """
    key = F.xxhash64("doc_id", "tie")
    chunk = F.pmod(key, F.ceil(F.col("rows") / CHUNK_ROWS).cast("long"))
    same = sizes["source"].eqNullSafe(sources["source"])
    rows = sizes.join(small_side(sources), same).select("doc_id", sizes["source"], "size", "tie", "number", "source_size", "target", key.alias("key"), chunk.alias("chunk"))
    chunks = rows.groupBy("number", "chunk").agg(F.sum("size").alias("chunk_size"))
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = chunks.select("number", "chunk", F.coalesce(F.sum("chunk_size").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("number", "chunk").orderBy("key", "doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return rows.join(bases, ["number", "chunk"]).withColumn("start", start).drop("base", "chunk", "key")


def totals(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Sources that take words, with their blocks, passes and draws; ``urn`` counts the draws of the sources before.

    A source that takes ``take`` words passes over all its blocks ``take div size`` times and in a last pass over the
    first ones of the permutation, until the words suffice; ``rest`` are the words of that pass.
    """
    s = sources.where("take > 0").select("number", "source_size", "take")
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long")).withColumn("passes", F.expr("take div source_size"))
    s = s.withColumn("rest", F.col("take") - F.col("passes") * F.col("source_size"))
    s = s.withColumn("last_draws", F.least(F.col("blocks"), F.when(F.col("rest") > 0, F.ceil(F.col("rest") / block).cast("long") + 1).otherwise(0)))
    s = s.withColumn("draws", F.col("passes") * F.col("blocks") + F.col("last_draws"))
    over = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumn("urn", F.coalesce(F.sum("draws").over(over), F.lit(0)))


def shard_counts(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """The multinomial draw: shard, number (source), slots. ``sources`` as of :func:`totals`.

    Each slot of a shard picks the source in whose stretch of all draws the hash of the slot's number falls; counting the
    slots of a shard by source gives its multinomial counts. The stretches are searched by halving.
    """
    spark = sources.sparkSession
    rows = sources.select("number", "urn", "draws").orderBy("number").collect()  # a row a source
    every = sum(r.draws for r in rows)
    if not every:
        return spark.createDataFrame([], "shard long, number int, slots long")
    numbers, urns = F.lit([r.number for r in rows]), F.lit([r.urn for r in rows])
    halves = F.lit([1 << i for i in reversed(range(max(1, (len(rows) - 1).bit_length())))])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Groups of shards are dealt out first, so that the slots unfold in many tasks.
    shards = -(-every // shard)
    per = max(1, min(SHARD_GROUP, -(-shards // (4 * tasks))))
    groups = spark.range(-(-shards // per)).repartition(tasks, "id")
    each = groups.select(F.explode(F.sequence(F.col("id") * per, F.least((F.col("id") + 1) * per, F.lit(shards)) - 1)).alias("shard"))
    slots = each.select("shard", F.explode(F.sequence(F.col("shard") * shard, F.least((F.col("shard") + 1) * shard, F.lit(every)) - 1)).alias("slot"))
    ticket = F.pmod(F.xxhash64(F.lit(SLOT_SEED), F.col("slot")), F.lit(every))
    found = F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get(urns, at + half) <= ticket, at + half).otherwise(at))
    return slots.select("shard", F.get(numbers, found).alias("number")).groupBy("shard", "number").agg(F.count("*").alias("slots"))


def shard_draws(sources: DataFrame, counts: DataFrame, shard: int = SHARD) -> DataFrame:
    """A row a shard and source: shard, number, first (its first draw there), n (draws), and what ``sources`` tells.

    Draws are numbered through the shards by two-level sums of the counts. They end at the source's total; what the
    counts fall short of it is added in shards behind all others.
    """
    known = small_side(sources)
    group = F.expr(f"shard div {SHARD_GROUP}")
    counts = counts.withColumn("group", group)
    sums = counts.groupBy("number", "group").agg(F.sum("slots").alias("group_slots"))
    earlier = Window.partitionBy("number").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("number", "group", F.coalesce(F.sum("group_slots").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("number", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed_ = counts.join(bases, ["number", "group"]).withColumn("first", F.col("base") + F.coalesce(F.sum("slots").over(inside), F.lit(0)))
    drawn = placed_.select("number", "shard", "first", "slots").join(known, "number").withColumn("n", F.least(F.col("slots"), F.col("draws") - F.col("first")))
    got = sums.groupBy("number").agg(F.sum("group_slots").alias("got"))
    short = sources.join(got, "number", "left").withColumn("first", F.coalesce("got", F.lit(0))).withColumn("n", F.col("draws") - F.col("first")).where("n > 0")
    # The last shards: shortfalls, source after source, cut where a shard is full.
    behind = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    short = short.withColumn("at", F.coalesce(F.sum("n").over(behind), F.lit(0)))
    full = F.explode(F.sequence(F.expr(f"at div {shard}"), F.expr(f"(at + n - 1) div {shard}"))).alias("nth")
    lo, hi = F.greatest(F.col("at"), F.col("nth") * shard), F.least(F.col("at") + F.col("n"), (F.col("nth") + 1) * shard)
    shards = sources.agg(F.coalesce(F.ceil(F.sum("draws") / shard).cast("long"), F.lit(0))).first()[0]
    last = short.select("*", full)
    columns = [c for c in sources.columns if c != "number"]
    last = last.select("number", (F.lit(shards) + F.col("nth")).alias("shard"), (F.col("first") + lo - F.col("at")).alias("first"), (hi - lo).alias("n"), *columns)
    return drawn.where("n > 0").select("number", "shard", "first", "n", *columns).unionByName(last)


def slots(sources: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """One row a draw: number (source), pass, block, words taken from the block's beginning, slot and shard.

    The draws are those of :func:`shard_draws`. The last draw of a source is cut to the words still wanted. Inside a
    shard a permutation mixes the slots of the sources.
    """
    s = written(totals(sources, block), "mix-totals")
    drawn = shard_draws(s, written(shard_counts(s, shard), "mix-counts"), shard)
    in_shard = Window.partitionBy("shard")
    before = F.coalesce(F.sum("n").over(in_shard.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = drawn.withColumn("place", before).withColumn("held", F.sum("n").over(in_shard))
    short = permuted(F.col("blocks") - 1, F.col("blocks"), F.col("number"), F.col("passes"), inverse=True)
    # Dealt out by a fixed number before they unfold: by their size, these few rows would all end up in one task.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = drawn.repartition(tasks, "shard", "number").withColumn("short_at", short).withColumn("missing", F.col("blocks") * block - F.col("source_size"))
    draws = drawn.withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).withColumn("k", F.col("first") + F.col("r"))
    draws = draws.withColumn("pass", F.expr("k div blocks")).withColumn("nth", F.col("k") % F.col("blocks"))
    draws = draws.withColumn("block", permuted(F.col("nth"), F.col("blocks"), F.col("number"), F.col("pass")))
    length = F.when(F.col("block") == F.col("blocks") - 1, block - F.col("missing")).otherwise(block)
    taken = F.col("nth") * block - F.when(F.col("nth") > F.col("short_at"), F.col("missing")).otherwise(0)
    words = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.least(length, F.col("rest") - taken))
    slot = F.col("shard") * shard + permuted(F.col("place") + F.col("r"), F.col("held"), F.lit(SHARD_SEED), F.col("shard"))
    return draws.withColumn("words", words).where("words > 0").select("number", "pass", "block", "words", slot.alias("slot"), "shard")


def pieces(rows: DataFrame, drawn: DataFrame, block: int = BLOCK) -> DataFrame:
    """Parts of documents in the drawn blocks: the columns of ``rows`` and pass, slot, from_word, to_word (0-based, end
    exclusive). Blocks are joined by source and index, never by source alone."""
    numbers = F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))
    spread = rows.where("size > 0").withColumn("block", F.explode(numbers))
    lo = F.greatest(F.col("start"), F.col("block") * block)
    hi = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words"))
    both = spread.join(drawn, ["number", "block"])
    return both.withColumn("from_word", lo - F.col("start")).withColumn("to_word", hi - F.col("start")).where("to_word > from_word")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with their places (without text), and the draws. The texts are read once, for the sizes.

    The draws are written, so that what joins them is planned by their true size."""
    sizes = written(sized(docs), "mix-sizes")
    sources = written(targets(sizes, weights, cap), "mix-sources")
    return placed(sizes, sources), written(slots(sources, shard=shard), "mix-draws")


def mix_report(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, first_shard (the first output shard that holds words of
    it). A document without words is taken 0 times, and one that isn't taken has a null first_shard. Other columns of
    ``docs`` play no part, whatever their names."""
    rows, drawn = plan(docs, shard=shard)
    rows = written(rows, "mix-rows")
    taken = pieces(rows, drawn).groupBy("number", "start").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("shard").alias("first_shard"))
    full = rows.where("size > 0").join(taken, ["number", "start"], "left")
    empty = rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")).withColumn("first_shard", F.lit(None).cast("long"))
    columns = ["doc_id", "size", "source_size", "target"]
    out = full.select(*columns, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")
    return out.unionByName(empty.select(*columns, "taken", "first_shard"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with columns renamed in_0, in_1, ... beside key_id, key_source, key_tie, and the columns by name."""
    column = {n: F.col(f"in_{i}") for i, n in enumerate(docs.columns)}
    key = [column["doc_id"].alias("key_id"), column["source"].alias("key_source"), F.xxhash64(column["text"]).alias("key_tie")]
    return docs.select(*[F.col(f"`{n}`").alias(f"in_{i}") for i, n in enumerate(docs.columns)]).select("*", *key), column


def _numbered(one: DataFrame, rows: DataFrame, names: int) -> tuple[DataFrame, DataFrame]:
    """``one`` (as of :func:`_keyed`) and ``rows`` (places in the stream) with ``nth`` and ``place_nth``, the number of a
    row among those that repeat its doc_id, source and text: by a hash of all columns, and by place. Only where rows do
    repeat are they sorted for it."""
    if not rows.groupBy("doc_id", "source", "tie").count().where("count > 1").limit(1).count():
        return one.withColumn("nth", F.lit(1)), rows.withColumn("place_nth", F.lit(1))
    whole = F.xxhash64(F.to_json(F.struct(*[F.col(f"in_{i}") for i in range(names)])))
    mine = Window.partitionBy("key_id", "key_source", "key_tie").orderBy("whole")
    places = Window.partitionBy("doc_id", "source", "tie").orderBy("start", "size")
    return one.withColumn("whole", whole).withColumn("nth", F.row_number().over(mine)).drop("whole"), rows.withColumn("place_nth", F.row_number().over(places))


def _same_row() -> Column:
    same = F.col("key_id").eqNullSafe(F.col("doc_id")) & F.col("key_source").eqNullSafe(F.col("source"))
    return same & (F.col("key_tie") == F.col("tie")) & (F.col("nth") == F.col("place_nth"))


def mixed_blocks(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, shard: int = SHARD) -> DataFrame:
    """The mix itself, packed: a row a filled slot with shard, slot, source, words, text and doc_ids.

    ``text`` are the block's words, taken from the source's stream in order and joined by a space; ``words`` is their
    number, BLOCK but for the last block of a source and its last draw, which are shorter. ``doc_ids`` are the documents
    they come from, in order (null numbers too). Sorted by ``slot``, the rows are the output in its order: shard after
    shard. Documents without words are in no block; other columns play no part. The words of each document in all slots
    are those that :func:`mix_report` says are taken, and reruns agree.

    Each text is cut once into its blocks' parts; a block, at most BLOCK parts, is put together before the draws multiply it.
    """
    rows, drawn = plan(docs, weights, cap, shard)
    one, column = _keyed(pick(docs, "doc_id", "source", "text"))
    one, rows = _numbered(one, written(rows.where("size > 0").select("doc_id", "source", "tie", "size", "number", "start"), "mix-rows"), 3)
    texts = one.join(rows, _same_row()).select("doc_id", "source", "number", "start", "size", words_of(f"in_{list(column).index('text')}").alias("split"))
    first = F.lit(BLOCK) - F.col("start") % BLOCK
    numbers = F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))

    def part(block: Column) -> Column:
        lo = F.greatest(F.lit(0).cast("long"), block * BLOCK - F.col("start"))
        n = F.least(F.lit(BLOCK).cast("long"), F.when(lo == 0, first).otherwise(BLOCK))
        return F.struct(block.alias("block"), F.slice("split", (lo + 1).cast("int"), n.cast("int")).alias("part"))

    parts = texts.select("number", "source", "start", "doc_id", F.inline(F.transform(numbers, part)))
    gathered = parts.groupBy("number", "block").agg(F.first("source").alias("source"), F.array_sort(F.collect_list(F.struct("start", "doc_id", "part"))).alias("parts"))
    filled = gathered.select("number", "block", "source", "parts", F.flatten("parts.part").alias("all"))
    both = filled.join(drawn, ["number", "block"])
    # A cut draw ends inside the block: the documents behind its last word have no part in it.
    block_start = F.col("block") * BLOCK
    inside = F.filter("parts", lambda p: p["start"] - block_start < F.col("words"))
    text = F.array_join(F.when(F.col("words") < F.size("all"), F.slice("all", 1, F.col("words").cast("int"))).otherwise(F.col("all")), " ")
    return both.select("shard", "slot", "source", "words", text.alias("text"), F.transform(inside, lambda p: p["doc_id"]).alias("doc_ids"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` as the mix holds them: a row for each pass that takes words of a document, its text the words taken.

    A pass that takes the whole document keeps its text as it is; parts are joined by a space, in order. Columns are those
    of ``docs``, as they came and whatever their names, but for the text and ``n_chars``, if there, which is that of the
    new text. Documents of which nothing is drawn have no row. Rows that repeat a doc_id, source and text each have their own
    place in the stream, dealt by a hash of all their columns, and keep their own other columns. :func:`mixed_blocks` gives
    the same words in the order of the mix.
    """
    names = docs.columns
    rows, drawn = plan(docs, weights, cap)
    one, column = _keyed(docs)
    one, rows = _numbered(one, written(rows, "mix-rows"), len(names))
    got = pieces(rows, drawn)
    place_key = ["number", "start", "doc_id", "source", "tie", "place_nth"]
    by_pass = got.groupBy(*place_key, "size", "pass").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.collect_list(F.struct("from_word", "to_word")).alias("parts"))
    whole = F.col("taken") == F.col("size")
    # One row a place in the stream, so that a text is joined once for it; its passes are at most ``cap`` + 1.
    drawn_rows = by_pass.select(*place_key, F.when(~whole, F.array_sort("parts")).alias("parts"))
    per_place = drawn_rows.groupBy(*place_key).agg(F.collect_list(F.coalesce("parts", F.array())).alias("passes"))
    place = f"in_{names.index('text')}"
    # A text is split once, before its passes unfold: inside the function below it would be split for every part.
    split = one.join(per_place, _same_row()).withColumn("words", F.when(F.exists("passes", lambda p: F.size(p) > 0), words_of(place)))
    unfolded = split.select(*column.values(), "words", F.explode("passes").alias("parts"))
    cut = F.array_join(F.flatten(F.transform("parts", lambda x: F.slice("words", x["from_word"] + 1, x["to_word"] - x["from_word"]))), " ")
    text = F.when(F.size("parts") == 0, F.col(place)).otherwise(cut)
    changed = unfolded.withColumn("text_", text)
    column["text"] = F.col("text_")
    if "n_chars" in names:
        column["n_chars"] = F.length("text_").cast(dict(docs.dtypes)["n_chars"])
    return changed.select(*[column[n].alias(n) for n in names])
