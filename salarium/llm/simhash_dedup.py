"""Near duplicates by SimHash fingerprints and meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``radius`` bits exactly if some value lies within half
the radius of both. Every distinct fingerprint emits all its variants within half the
radius, equal variants meet, and the fingerprints that share one are linked.

With 64 bits and radius 4 that is 2,081 variants, which need not all be shuffled. They are
dealt by their leading ``prefix`` bits: a fingerprint is sent once to each leading value
that one of its variants has (29 for 7 bits), with the flips it has left, and the receiving
task produces the variants of that slice, finds the equal ones and reduces them to one
spanning tree per local component. A bucket of equal variants is a clique, so linking its
members to one of them loses nothing and no pairs within a group are listed. A slice that
would hold too many variants (a large group of near copies) is dealt again by eight more
bits, as often as needed; at 64 bits a slice is one variant and its links are one
aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salarium.llm.components import components
from salarium.llm.tables import column, configure, keyed, rows_of, stored, text_of

BITS = 64
_SLICE_VARIANTS = 1 << 20  # aimed at in one slice
_MOST_VARIANTS = 1 << 22  # a slice with more is dealt again
_MOST_HOT = 100_000  # hot slices that may be broadcast (8 bytes each); beyond, all are dealt again


# ---- fingerprints ----------------------------------------------------------------------


def _shingles(raw: bytes, length: int, seed: int) -> list[int]:
    """Hashes of the word shingles of a text, repeats included."""
    import xxhash

    words = raw.lower().split()  # bytes: A-Z only, and white space is 0x20 and 0x09-0x0D
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= length:
        return [xxhash.xxh64_intdigest(joined, seed)]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    ends = (starts + sizes)[length - 1 :]
    pieces = map(joined.__getitem__, map(slice, starts[: len(ends)].tolist(), ends.tolist()))
    return list(map(xxhash.xxh64_intdigest, pieces, repeat(seed)))


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes, the bits set in over half of them; 0 for no hash."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    # sixteen sums of four 16-bit lanes each; a run is cut where a lane could overflow
    most = (1 << 16) - 1
    ends = np.cumsum(counts[full])
    begins = ends - counts[full]
    cuts = [np.arange(b, e, most) for b, e in zip(begins, ends)] if counts.max() > most else None
    at = np.concatenate(cuts) if cuts else begins
    owner = np.repeat(np.arange(len(full)), [len(c) for c in cuts]) if cuts else np.arange(len(full))
    lanes = np.uint64(0x0001000100010001)
    for j in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & lanes, at)
        for lane in range(4):
            ones = ((sums >> np.uint64(16 * lane)) & np.uint64(most)).astype(np.int64)
            if cuts:
                ones = np.bincount(owner, ones, len(full)).astype(np.int64)
            set_bit = (2 * ones > counts[full]).astype(np.uint64)
            out[full] |= set_bit << np.uint64(16 * lane + j)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, fp)``: the 64-bit SimHash of each text, as a signed long."""
    configure(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = [], []
            for value in batch.column(1).cast(pa.binary()):
                found = _shingles(value.as_py(), shingle, seed)
                hashes.append(np.array(found, np.uint64))
                counts.append(len(found))
            fp = majority_bits(np.concatenate([np.empty(0, np.uint64), *hashes]), np.array(counts, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    read = docs.select(column(docs, id_col).alias("id"), text_of(docs, text_col).alias("text"))
    schema = T.StructType([T.StructField("id", read.schema["id"].dataType), T.StructField("fp", T.LongType())])
    return read.mapInArrow(run, schema)


# ---- links -----------------------------------------------------------------------------


def _masks(bits: int, low: int, most: int) -> list[tuple[int, int]]:
    """(mask, flips) for all flips of at most ``most`` of ``bits`` bits from bit ``low`` on."""
    return [(sum(1 << (low + i) for i in c), n) for n in range(most + 1) for c in combinations(range(bits), n)]


def _deal(rows: DataFrame, bits: int, more: int, half: int) -> DataFrame:
    """Send each row to the slices of ``bits + more`` leading bits that its variants reach."""
    low = BITS - bits - more
    signed = lambda m: m - (1 << 64) if m >> 63 else m

    def reach(most: int) -> Column:
        return F.array(*[F.struct(F.lit(signed(m)).cast("long").alias("m"), F.lit(n).alias("n")) for m, n in _masks(more, low, most)])

    choice = reach(0)
    for used in range(half):
        choice = F.when(F.col("used") == used, reach(half - used)).otherwise(choice)
    dealt = rows.withColumn("flip", F.explode(choice))
    # "at" is the fingerprint with the flips made so far, "slice" its leading bits
    at = F.col("at").bitwiseXOR(F.col("flip.m"))
    return dealt.select("fp", "id", at.alias("at"), (F.col("used") + F.col("flip.n")).alias("used")).withColumn(
        "slice", F.shiftrightunsigned("at", low))


def _variants(bits: int, half: int) -> Column:
    """Variants that a row still has when ``bits`` leading bits are settled."""
    out, free = F.lit(1), BITS - bits
    for used in range(half):
        out = F.when(F.col("used") == used, F.lit(len(_masks(free, 0, half - used)))).otherwise(out)
    return out


def _collide(bits: int, half: int, radius: int):
    """Function for one slice: links between fingerprints that share a variant."""
    free = BITS - bits
    masks = [np.array([m for m, _ in _masks(free, 0, left)], np.uint64) for left in range(half + 1)]

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        at = table.column("at").to_numpy().view(np.uint64)
        used = table.column("used").to_numpy()
        values, owners = [], []
        for u in range(half + 1):
            rows = np.flatnonzero(used == u)
            values.append((at[rows, None] ^ masks[half - u][None, :]).ravel())
            owners.append((rows, len(masks[half - u])))
        ordered = np.sort(np.concatenate(values))
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        del ordered
        member, shared = [], []
        if len(twice):
            # a small table of hashes first, then the exact search
            spread, keep = np.uint64(0x9E3779B97F4A7C15), np.uint64(44)
            seen = np.zeros(1 << 20, bool)
            seen[(twice * spread) >> keep] = True
            for v, (rows, per) in zip(values, owners):
                maybe = np.flatnonzero(seen[(v * spread) >> keep])
                place = np.searchsorted(twice, v[maybe])
                place[place == len(twice)] = 0
                hit = twice[place] == v[maybe]
                member.append(rows[maybe[hit] // per])
                shared.append(place[hit])
        member = np.concatenate(member) if member else np.empty(0, np.int64)
        shared = np.concatenate(shared) if shared else np.empty(0, np.int64)
        # link all members of a variant to its smallest one, and check the distance
        by_rank = pc.sort_indices(table, [("id", "ascending"), ("fp", "ascending")]).to_numpy()
        rank = np.empty(len(fps), np.int64)
        rank[by_rank] = np.arange(len(fps))
        first = np.full(len(twice), len(fps), np.int64)
        np.minimum.at(first, shared, rank[member])
        a, b = rank[member], first[shared]
        close = np.bitwise_count(fps[by_rank[a]] ^ fps[by_rank[b]]) <= radius
        links = np.unique(np.stack([a, b])[:, close & (a != b)], axis=1)
        root = np.arange(len(fps))
        while True:  # the smallest node of each local component
            low = root.copy()
            np.minimum.at(low, links[0], root[links[1]])
            np.minimum.at(low, links[1], root[links[0]])
            low = low[low]
            if (low == root).all():
                break
            root = low
        moved = np.flatnonzero(root != np.arange(len(root)))
        ends = [by_rank[moved], by_rank[root[moved]]]
        ids, values = table.column("id").combine_chunks(), table.column("fp").combine_chunks()
        return pa.table({k: pa.StructArray.from_arrays([ids.take(e), values.take(e)], ["id", "fp"]) for k, e in zip("ab", map(pa.array, ends))})

    return run


def links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """Edges ``(a, b)``, structs of (id, fp), between fingerprints within ``radius`` bits.

    ``nodes`` holds ``(id, fp)`` with distinct ``fp`` and no nulls. The edges are some of
    all pairs within the radius, and connect what all of them connect.
    """
    if radius % 2 or not 0 < radius < 16:
        raise ValueError("the radius must be even: only then do two half balls meet exactly within it")
    half = radius // 2
    node = T.StructType([T.StructField("id", nodes.schema["id"].dataType), T.StructField("fp", T.LongType())])
    total = nodes.count()
    per_node = len(_masks(BITS, 0, half))
    bits = 6
    while bits < 40 and (total * per_node) >> bits > _SLICE_VARIANTS:
        bits += 1
    edge_schema = T.StructType([T.StructField("a", node), T.StructField("b", node)])
    rows = _deal(nodes.select("fp", "id", F.col("fp").alias("at"), F.lit(0).alias("used")), 0, bits, half)
    found = []
    while True:
        weighed = rows.groupBy("slice").agg(F.sum(_variants(bits, half)).alias("w"))
        hot = weighed.where(F.col("w") > _MOST_VARIANTS).select(F.col("slice").alias("hot"))
        n_hot = hot.count()
        cold = rows if not n_hot else None
        if 0 < n_hot <= _MOST_HOT:
            marks = F.broadcast(stored(hot, "hot-slices"))
            cold = rows.join(marks, F.col("slice") == F.col("hot"), "left_anti")
            rows = rows.join(marks, F.col("slice") == F.col("hot"), "left_semi")
        if cold is not None:
            found.append(cold.groupBy("slice").applyInArrow(_collide(bits, half, radius), edge_schema))
        if not n_hot:
            break
        more = min(8, BITS - bits)
        rows = _deal(rows.select("fp", "id", "at", "used"), bits, more, half)
        bits += more
        if bits == BITS:  # a slice is one variant: link its members to the smallest
            members = rows.select("slice", F.struct("id", "fp").alias("a"))
            low = stored(members.groupBy("slice").agg(F.min("a").alias("b")), "variant-low")
            found.append(members.join(low, "slice").where("a <> b").select("a", "b"))
            break
        rows = stored(rows, "hot-rows")
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out


def near_duplicates(
    docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id that links of at most ``radius`` differing bits
    reach, the row's own included. Null, empty and blank texts have fingerprint zero and
    link like any other. A row with a null id has a fingerprint and a null component, and
    links nothing. Every row is a document of its own, also where rows repeat an id. Other
    columns are not read. An empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, shingle, seed, text_col, id_col), "fingerprints")
    nodes = rows.where(F.col("id").isNotNull()).groupBy("fp").agg(F.min("id").alias("id"))
    nodes = stored(nodes, "fingerprint-nodes")
    rooted = components(stored(links(nodes, radius), "links"))
    rooted = rooted.select(F.col("node.fp").alias("fp"), F.col("root.id").alias("root"))
    named = stored(
        nodes.join(rooted, "fp", "left").select(F.col("fp").alias("key"), F.coalesce("root", "id").alias("component_id")),
        "fingerprint-components")
    joined = rows.join(named, F.col("fp") == F.col("key"), "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id.

    A row is known by a key of its own: rows that repeat an id are judged by their own text,
    and of equal rows one stays. Rows with a null id link like any other and stay only where
    no row of the component has an id. All columns are kept, whatever their names.
    """
    whole, slim = keyed(docs, id_col, text_col)
    found = near_duplicates(slim, radius, shingle, text_col="text", id_col="key").select(F.col("key").alias("of"), "component_id")
    named = slim.select("key", "id").join(found, F.col("key") == F.col("of"))
    stays = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("best")).select("best.key")
    return rows_of(whole.join(stays, "key", "left_semi"))
