"""Ranked lexical search by pipelined term partitioning.

The terms of the queried items are dealt to ``stages`` term owners, rare terms first. The
postings lie in blocks of documents, and one bundle for each block carries the sparse
accumulators of all items: it passes the owners one after the other, and at each stage a
cogroup brings it together with that owner's postings of the same block, whose integer
contributions are added. After the last stage the best documents of each bundle are merged.

Between two stages accumulators that cannot matter any more are left out, exactly: ``floor``
is the ``k``-th best sum of an item so far (sums never fall, so the final ``k``-th best is no
lower), and no document gains more from the later stages than the greatest contributions of
the item's terms there. A document below ``floor`` by more than that cannot be returned, and
one that is not yet in a bundle need not enter it when all that is left is below ``floor``.

A task sees one block at a time: at most ``block_docs`` documents (fewer when there are many
items) and about ``block_postings`` postings, whatever a term's or an item's size, so a term
found in every document is spread over all blocks. Items are taken in groups of about
``item_bytes`` bytes of text, each with a pass of its own; only an item group's terms, their
document counts and the items' floors reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salarium.llm.tables import column, configure, partitions, stored, text_of

STAGE_SHARES = (0.02, 0.1, 0.4)  # a term belongs to the stage its share of all postings, rarest first, falls in
_UNIT = 1_000_000_000

# ASCII letters and digits and everything beyond ASCII are term characters; A-Z is folded
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

_POSTINGS = "block string, term int, places binary, counts binary, lengths binary"
_BUNDLE = "block string, bundle binary"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in UTF-8, with repeats."""
    return [] if text is None else text.encode("utf-8", "replace").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def shares(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``(10^9 tf) div (1000 tf + 8 m)`` in 64-bit integers: what a term of weight 1 adds."""
    tf, length = tf.astype(np.int64), length.astype(np.int64)
    m = 100 - 90 + (90 * length * n_docs) // n_terms
    return (_UNIT * tf) // (1000 * tf + 8 * m)


# ---- postings --------------------------------------------------------------------------


def _posted(docs: DataFrame, vocabulary: dict[bytes, int], block_docs: int, block_postings: int) -> DataFrame:
    """Postings of the vocabulary's terms by block of documents, and one row for each block
    (term null) with its documents' ids and all their lengths.

    Within a block documents stand in id order, so places compare as ids do. A block is
    closed at a number of documents or postings.
    """
    id_type = docs.schema["id"].dataType
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        task, n_blocks = TaskContext.get().partitionId(), 0
        held: list[tuple] = []  # (id, number of terms, {term: count})
        size, kind = 0, None

        def flush() -> pa.RecordBatch:
            held.sort(key=lambda d: (True,) if d[0] is None else (False, d[0]))
            places: dict[int, list[int]] = {}
            counts: dict[int, list[int]] = {}
            for at, (_, _, found) in enumerate(held):
                for term, n in found.items():
                    places.setdefault(term, []).append(at)
                    counts.setdefault(term, []).append(n)
            lengths = np.array([d[1] for d in held], "<i4")
            name = f"{task}-{n_blocks}"
            at = [np.array(p, "<i4") for p in places.values()]
            terms = [None, *places]
            return pa.RecordBatch.from_arrays([
                pa.array([name] * len(terms), pa.string()), pa.array(terms, pa.int32()),
                pa.array([None, *(a.tobytes() for a in at)], pa.binary()),
                pa.array([None, *(np.array(c, "<i4").tobytes() for c in counts.values())], pa.binary()),
                pa.array([lengths.tobytes(), *(lengths[a].tobytes() for a in at)], pa.binary()),
                pa.array([[d[0] for d in held], *[None] * len(at)], pa.list_(kind)),
            ], ["block", "term", "places", "counts", "lengths", "ids"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                terms = [] if text is None else text.translate(_FOLD).split()
                found = Counter(terms)
                held.append((key, len(terms), {known[t]: found[t] for t in found.keys() & known.keys()}))
                size += len(held[-1][2])
                if len(held) >= block_docs or size >= block_postings:
                    yield flush()
                    held, size, n_blocks = [], 0, n_blocks + 1
        if held:
            yield flush()

    schema = T.StructType([
        T.StructField("block", T.StringType()), T.StructField("term", T.IntegerType()),
        T.StructField("places", T.BinaryType()), T.StructField("counts", T.BinaryType()),
        T.StructField("lengths", T.BinaryType()), T.StructField("ids", T.ArrayType(id_type)),
    ])
    return docs.mapInArrow(run, schema)


def _totals(posted: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            for value in batch.column(0):
                lengths = np.frombuffer(value.as_py(), "<i4")
                n, total = n + int((lengths > 0).sum()), total + int(lengths.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], ["n", "total"])

    counted = posted.where("term IS NULL").select("lengths").mapInArrow(run, "n long, total long")
    row = counted.agg(F.sum("n"), F.sum("total")).first()
    return row[0] or 0, row[1] or 0


def _greatest(posted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Each term's document count and the greatest of its shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, df = [], []
            for tf, length in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                tf, length = np.frombuffer(tf, "<i4"), np.frombuffer(length, "<i4")
                best.append(int(shares(tf, length, n_docs, n_terms).max()))
                df.append(len(tf))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(df, pa.int64()), pa.array(best, pa.int64())], ["term", "df", "best"])

    each = posted.where("term IS NOT NULL").select("term", "counts", "lengths").mapInArrow(run, "term int, df long, best long")
    return each.groupBy("term").agg(F.sum("df").alias("df"), F.max("best").alias("best"))


# ---- the pipeline ----------------------------------------------------------------------


def _packed(items: list[int], places: list[np.ndarray], sums: list[np.ndarray]) -> bytes:
    """A bundle: the items, how many accumulators each has, their places and their sums."""
    sizes = np.array([len(p) for p in places], "<i4")
    head = np.array([len(items)], "<i4")
    return b"".join([head.tobytes(), np.array(items, "<i4").tobytes(), sizes.tobytes(),
                     *(p.astype("<i4").tobytes() for p in places), *(s.astype("<i8").tobytes() for s in sums)])


def _unpacked(bundle: bytes) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    n = int(np.frombuffer(bundle, "<i4", 1)[0])
    items, sizes = np.frombuffer(bundle, "<i4", n, 4), np.frombuffer(bundle, "<i4", n, 4 + 4 * n)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if n else 0
    places = np.frombuffer(bundle, "<i4", total, 4 + 8 * n)
    sums = np.frombuffer(bundle, "<i8", total, 4 + 8 * n + 4 * total)
    return {int(i): (places[e - s : e], sums[e - s : e]) for i, s, e in zip(items, sizes, ends)}


def _stage(bundles: DataFrame, postings: DataFrame, of_item: list[list[tuple[int, int]]], floors: list[int],
           left_over: list[int], later: list[int], totals: tuple[int, int]) -> DataFrame:
    """One owner's stage: bundles and this owner's postings meet by block.

    ``of_item``: each item's terms at this owner with their weights. ``left_over``: the most
    a document can gain from this stage on; ``later``: after it.
    """
    shared = bundles.sparkSession.sparkContext.broadcast((of_item, floors, left_over, later))
    n_docs, n_terms = totals

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        items, floor, gain, after = shared.value
        carried = _unpacked(left.column(1)[0].as_py()) if left.num_rows else {}
        block = (left if left.num_rows else right).column(0)[0].as_py()
        postings, size = {}, 0
        for term, places, counts, lengths in zip(*(right.column(i).to_pylist() for i in range(1, 5))):
            at = np.frombuffer(places, "<i4")
            share = shares(np.frombuffer(counts, "<i4"), np.frombuffer(lengths, "<i4"), n_docs, n_terms)
            postings[term] = at, share
            size = max(size, int(at[-1]) + 1)
        for at, _ in carried.values():
            size = max(size, int(at[-1]) + 1 if len(at) else 0)
        sums = np.zeros(size, np.int64)
        out_items, out_places, out_sums = [], [], []
        for item, terms in enumerate(items):
            mine = [(postings[t], w) for t, w in terms if t in postings]
            old = carried.get(item)
            enters = gain[item] >= floor[item]
            if old is None and not (mine and enters):
                continue
            sums[:] = 0
            if old is not None:
                sums[old[0]] = old[1]
            for (at, share), w in mine:
                sums[at] += w * share
            if enters:
                at = np.flatnonzero(sums)
            else:  # only documents that the bundle brought
                at = old[0][old[1] > 0]
            keep = sums[at] + after[item] >= floor[item]
            if keep.any():
                at = at[keep]
                out_items.append(item)
                out_places.append(at)
                out_sums.append(sums[at])
        bundle = [_packed(out_items, out_places, out_sums)] if out_items else []
        return pa.table({"block": pa.array([block] * len(bundle), pa.string()), "bundle": pa.array(bundle, pa.binary())})

    return bundles.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(run, _BUNDLE)


def _best(bundles: DataFrame, k: int) -> DataFrame:
    """The ``k`` best accumulators of each item in each bundle: block, item, place, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, bundle in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                items, places, scores = [], [], []
                for item, (at, sums) in _unpacked(bundle).items():
                    top = np.lexsort((at, -sums))[:k]
                    items += [item] * len(top)
                    places += at[top].tolist()
                    scores += sums[top].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(items), pa.string()), pa.array(items, pa.int32()),
                     pa.array(places, pa.int32()), pa.array(scores, pa.int64())], ["block", "item", "place", "score"])

    return bundles.mapInArrow(run, "block string, item int, place int, score long")


def _floors(bundles: DataFrame, n_items: int, k: int) -> list[int]:
    """The ``k``-th best sum of each item so far (0 with fewer), found in two steps."""
    best = _best(bundles, k)
    some = best.groupBy("item", F.pmod(F.hash("block"), F.lit(64)).alias("part")).agg(
        F.slice(F.sort_array(F.collect_list("score"), False), 1, k).alias("top"))
    all_of = some.groupBy("item").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top")), False), 1, k).alias("top"))
    out = [0] * n_items
    for row in all_of.select("item", F.try_element_at("top", F.lit(k)).alias("floor")).collect():  # a row for each item
        out[row["item"]] = row["floor"] or 0
    return out


def _first(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def _search(docs: DataFrame, items: list[tuple], k: int, block_docs: int, block_postings: int) -> DataFrame:
    """``(item, rank, id, score)`` for the given item texts, all documents ranked."""
    item_terms = [sorted(set(terms_of(text))) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in item_terms for t in terms}))}
    block_docs = max(64, min(block_docs, (1 << 20) // max(1, len(items))))
    posted = stored(_posted(docs, vocabulary, block_docs, block_postings), "lexical-postings", "lz4")
    n_docs, n_terms = totals = _totals(posted)

    # terms to owners, rarest first
    stats = {r["term"]: (r["df"], r["best"]) for r in _greatest(posted, n_docs, max(1, n_terms)).collect()}  # the vocabulary
    weights = {t: weight(n_docs, df) for t, (df, _) in stats.items()}
    owner, upto, total = {}, 0, sum(df for df, _ in stats.values())
    for term in sorted(stats, key=lambda t: (stats[t][0], t)):
        owner[term] = sum(upto >= share * total for share in STAGE_SHARES)
        upto += stats[term][0]
    n_stages = len(STAGE_SHARES) + 1
    mine = [[vocabulary[t] for t in terms if vocabulary[t] in stats] for terms in item_terms]
    most = [[sum(weights[t] * stats[t][1] for t in terms if owner[t] == s) for s in range(n_stages)] for terms in mine]

    owners = docs.sparkSession.createDataFrame(sorted(owner.items()), "own_term int, owner int")
    dealt = posted.where("term IS NOT NULL").join(F.broadcast(owners), F.col("term") == F.col("own_term"))
    bundles = docs.sparkSession.createDataFrame([], _BUNDLE)
    floors = [0] * len(items)
    for s in range(n_stages):
        postings = dealt.where(F.col("owner") == s).select("block", "term", "places", "counts", "lengths")
        of_item = [[(t, weights[t]) for t in terms if owner[t] == s] for terms in mine]
        gain, after = [sum(m[s:]) for m in most], [sum(m[s + 1 :]) for m in most]
        bundles = stored(_stage(bundles, postings, of_item, floors, gain, after, (n_docs, max(1, n_terms))), "lexical-bundles", "lz4")
        if s + 1 < n_stages:
            floors = _floors(bundles, len(items), k)

    ids = posted.where("term IS NULL").select(F.col("block").alias("of_block"), "ids")
    found = _best(bundles, k).join(ids, F.col("block") == F.col("of_block")).select(
        "item", "score", F.element_at("ids", F.col("place") + 1).alias("id"), F.pmod(F.hash("block"), F.lit(64)).alias("part"))
    order = [F.desc("score"), F.asc_nulls_last("id")]
    return _first(_first(found, ["item", "part"], order, k), ["item"], order, k).select("item", "rank", "id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_text_col: str = "text",
    item_id_col: str = "item_id",
    item_bytes: int = 8 << 20,
    block_docs: int = 4096,
    block_postings: int = 1 << 19,
) -> DataFrame:
    """The ``k`` best documents of each item: item id, ``rank`` (from 1), id, ``score``.

    Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-
    cased. Equal scores rank by ascending id, a null id last; rows that repeat an id are
    documents of their own. An item has fewer rows where fewer documents score above 0, and
    none if its text is null, empty or without a term that a document holds; items that
    repeat an id are searched each on their own. Other columns, of whatever name, are not
    read. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    configure(spark)
    read = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).cast("string").alias("text"))
    asked = stored(
        items.select(column(items, item_id_col).alias("item_id"), text_of(items, item_text_col).alias("text")), "lexical-items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // item_bytes))
    key = asked.schema["item_id"]
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_key", key.dataType)])
    out = None
    for g in range(groups):
        # about item_bytes of text: the items of one group of texts
        some = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g)
        texts = [(r["item_id"], r["text"]) for r in some.collect()]
        if not texts:
            continue
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(texts)], schema)
        found = _search(read, texts, k, block_docs, block_postings)
        part = found.join(F.broadcast(names.withColumnRenamed("item", "of_item")), F.col("item") == F.col("of_item")).select(
            F.col("item_key").alias(item_id_col), "rank", F.col("id").alias(id_col), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        empty = T.StructType([
            T.StructField(item_id_col, key.dataType), T.StructField("rank", T.IntegerType()),
            T.StructField(id_col, read.schema["id"].dataType), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], empty)
    return out
