"""Benchmark decontamination (DataFrame operations only).

A document is contaminated by a benchmark item when one of its windows, as many words long
as the item, has a weighted shingle similarity of ``threshold`` or more with it. Words are
lower-cased runs of letters and digits; shingles are five words (all of them for a shorter
item); a shingle's weight is how often it occurs; similarity is the weights' minima over
their maxima, summed over all shingles.

1. Every shingle of every document is looked up among the items' shingles. A window that
   shares none has similarity 0. Moving a window to the first shingle that it shares (or to
   the last full window of the document) loses none of the shared shingles, so of all
   windows only those that start there need a fingerprint.
2. Each such window gets a 64-bit SimHash of its shingles, as does each item. The
   fingerprints are cut into ``radius + 1`` blocks; two fingerprints within the radius agree
   in at least one block, so the join on (item, block number, block value), over the items
   that hold the window's shared shingle, finds all of them, and the exact distance drops
   the rest.
3. The candidates' exact similarity decides.

At similarity 0.8 about 15 % of the fingerprint's bits differ; the default radius of 20 of
64 bits leaves out such a window with a probability near 0.0002, and closer ones far more
rarely.

The items' shingles are looked up in lots of about ``block_shingles`` of them (and no more than
about ``block_items`` items have), dealt by their hash: what is broadcast is bounded by these
numbers, whatever the size of the benchmark or of one item. For more than one lot the documents'
shingles are stored, so that the texts are read once for each shingle length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salarium.llm.tables import column, configure, keyed, rows_of, stored, text_of

_LANES = 0x0000000100000001


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), "")


def _run_from(words: str, length: int):
    # by index: slice() would copy the whole array for each shingle
    return lambda word, i: F.xxhash64(word, *[F.get(words, i + j) for j in range(1, length)])


def shingles_of(words: str, length: int) -> Column:
    """Hash of each run of ``length`` words, in order; empty for fewer words."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (length - 1), F.lit(0)))
    return F.transform(starts, _run_from(words, length))


def _add_lanes(j: int):
    return lambda sums, h: sums + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANES))


def with_simhash(df: DataFrame, hashes: str, name: str) -> DataFrame:
    """Adds the bits set in over half of the hashes."""
    # two 32-bit lanes: bits j and j + 32 are counted in one pass; an array is too short to fill a lane
    for j in range(32):
        df = df.withColumn(f"_lanes{j}", F.aggregate(hashes, F.lit(0).cast("bigint"), _add_lanes(j)))
    out, zero, one = F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    for j in range(32):
        for lane in range(2):
            ones = F.shiftrightunsigned(f"_lanes{j}", 32 * lane).bitwiseAND(F.lit(0xFFFFFFFF))
            out = out.bitwiseOR(F.when(ones * 2 > F.size(hashes), F.shiftleft(one, 32 * lane + j)).otherwise(zero))
    return df.withColumn(name, out).drop(*[f"_lanes{j}" for j in range(32)])


def _cuts(radius: int) -> list[tuple[int, int]]:
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return list(zip(cuts, cuts[1:]))


def _block(fp: Column, lo: int, hi: int) -> Column:
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def _blocks(fp: str, radius: int) -> Column:
    """(number, value) of each of the ``radius + 1`` nearly equal bit blocks of a fingerprint."""
    return F.array(*[F.struct(F.lit(i).alias("block"), _block(F.col(fp), lo, hi).alias("value")) for i, (lo, hi) in enumerate(_cuts(radius))])


def _on_side(s: int):
    return lambda x: F.struct(x.alias("h"), F.lit(s).alias("side"))


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of hashes with repeats, from one pass over
    both, sorted together: each run of equal hashes adds the smaller of its two counts."""
    marked = [F.transform(F.col(c), _on_side(s)) for s, c in enumerate((a, b))]
    start = F.struct(F.lit(None).cast("bigint").alias("h"), *(F.lit(0).alias(n) for n in ("in_a", "in_b", "both")))

    def step(run: Column, x: Column) -> Column:
        same = x["h"].eqNullSafe(run["h"])
        counts = [F.when(same, run[n]).otherwise(0) + (x["side"] == s).cast("int") for s, n in enumerate(("in_a", "in_b"))]
        both = run["both"] + F.when(same, 0).otherwise(F.least(run["in_a"], run["in_b"]))
        return F.struct(x["h"].alias("h"), counts[0].alias("in_a"), counts[1].alias("in_b"), both.alias("both"))

    shared = F.aggregate(F.sort_array(F.concat(*marked)), start, step, lambda run: run["both"] + F.least(run["in_a"], run["in_b"]))
    return shared / (F.size(a) + F.size(b) - shared)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    shingle: int = 5,
    radius: int = 20,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_text_col: str = "text",
    item_id_col: str = "item_id",
    block_items: int = 2_000,
    block_shingles: int = 200_000,
) -> DataFrame:
    """One row per contaminated document and item: id, item id, ``window_start`` (first word,
    from 0, of the best window; the first of equals), ``similarity``, ``distance`` (bits).

    Null and empty texts contaminate nothing and are not contaminated. An item of fewer than
    ``shingle`` words matches only its own words in a row. Every input row is a document of
    its own: rows that repeat an id each count, and their pairs come once with the best
    window. Null ids are returned as null. Other columns are not read. Empty tables give an
    empty result.
    """
    configure(docs.sparkSession)
    items = benchmark.select(column(benchmark, item_id_col).alias("item"), text_of(benchmark, item_text_col).alias("text"))
    items = items.select("item", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("n_words", F.size("words")).withColumn("k", F.least(F.lit(shingle), "n_words"))
    made = F.array().cast("array<bigint>")
    for k in range(shingle, 0, -1):
        made = F.when(F.col("k") == k, shingles_of("words", k)).otherwise(made)
    items = stored(
        items.withColumn("hashes", made).select("item", "n_words", "k", "hashes", F.xxhash64("item", "words").alias("item_key")), "items")

    marked = stored(with_simhash(items, "hashes", "item_fp"), "item-fingerprints")
    counted = marked.groupBy("k").agg(F.count(F.lit(1)), F.sum(F.size("hashes"))).collect()  # a row for each shingle length
    read = docs.select(column(docs, id_col).alias("id"), words_of(text_of(docs, text_col)).alias("words"))
    out = None
    for k, n_items, n_shingles in sorted(counted) or [(shingle, 0, 0)]:
        lots = max(1, -(-n_items // block_items), -(-n_shingles // block_shingles))
        found = _matches(read, marked.where(F.col("k") == k), k, lots, threshold, radius)
        out = found if out is None else out.unionAll(found)
    best = out.groupBy("id", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("start"), (-F.col("distance")).alias("distance"))).alias("best"))
    return best.select(
        F.col("id").alias(id_col), F.col("item").alias(item_id_col), (-F.col("best.start")).alias("window_start"),
        "best.similarity", (-F.col("best.distance")).alias("distance"))


def _matches(docs: DataFrame, items: DataFrame, k: int, lots: int, threshold: float, radius: int) -> DataFrame:
    """(id, item, start, similarity, distance) for items whose shingles are ``k`` words long."""
    hashed = docs.select("id", F.size("words").alias("doc_words"), shingles_of("words", k).alias("hashes"))
    if lots > 1:
        hashed = stored(hashed, "document-shingles")
    # outer: for a plain explode Spark adds a filter on the array's size, with the words' pattern inside its loop
    each = hashed.select("id", "doc_words", "hashes", F.posexplode_outer("hashes").alias("pos", "h"))
    holders = items.select("n_words", "item_key", F.explode("hashes").alias("item_h")).groupBy("item_h", "n_words").agg(
        F.collect_set("item_key").alias("item_keys"))
    lookup = stored(
        holders.groupBy("item_h").agg(F.collect_list(F.struct("n_words", "item_keys")).alias("held")), "item-shingles")
    shared = None
    for lot in range(lots):
        own = each.join(F.broadcast(lookup.where(F.pmod("item_h", F.lit(lots)) == lot)), F.col("h") == F.col("item_h"))
        own = own.select("id", "doc_words", "hashes", "pos", F.inline("held"))
        shared = own if shared is None else shared.unionAll(own)
    start = F.greatest(F.lit(0), F.least(F.col("pos"), F.col("doc_words") - F.col("n_words")))
    windows = stored(shared.select(
        "id", "item_keys", start.alias("start"), F.slice("hashes", start + 1, F.col("n_words") - (k - 1)).alias("window")), "windows")
    windows = stored(with_simhash(windows, "window", "fp"), "window-fingerprints")
    windows = windows.withColumn("tried", F.explode("item_keys")).drop("item_keys")
    windows = windows.withColumn("cut", F.explode(_blocks("fp", radius))).select("*", "cut.block", "cut.value").drop("cut")

    # a row of the index for each item and block, its shingles in another table: Spark broadcasts either by its size
    index = items.select("item_key", "item_fp", F.explode(_blocks("item_fp", radius)).alias("cut"))
    index = index.select("item_key", "item_fp", F.col("cut.block").alias("item_block"), F.col("cut.value").alias("item_value"))
    on = (F.col("tried") == F.col("item_key")) & (F.col("block") == F.col("item_block")) & (F.col("value") == F.col("item_value"))
    pairs = windows.join(index, on)
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.lit(radius)  # a pair is kept in the first block in which it agrees
    for i, (lo, hi) in reversed(list(enumerate(_cuts(radius)))):
        first = F.when(_block(differ, lo, hi) == 0, F.lit(i)).otherwise(first)
    pairs = pairs.withColumn("distance", F.bit_count(differ)).where((F.col("distance") <= radius) & (F.col("block") == first))
    full = items.select(F.col("item_key").alias("full_key"), "item", "hashes")
    checked = pairs.join(full, F.col("item_key") == F.col("full_key"))
    return checked.withColumn("similarity", similarity("window", "hashes")).where(F.col("similarity") >= threshold).select(
        "id", "item", "start", "similarity", "distance")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs`` without the contaminated rows.

    A row is known by a key of its own: rows that repeat an id, null included, are judged by
    their own text. All columns are kept, whatever their names.
    """
    whole, slim = keyed(docs, id_col, text_col)
    found = contaminated(slim, benchmark, text_col="text", id_col="key", **settings)
    return rows_of(whole.join(found.select("key").distinct(), "key", "left_anti"))
