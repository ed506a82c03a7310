"""Sharding by bytes with a histogram sort (DataFrame operations only).

Documents are ordered by a 62-bit hash of their text, so equal texts are neighbours. The
splitters between shards are found by counting, not by sorting: all partitions count the
exact bytes below candidate key boundaries, the driver keeps the one bucket around each
wanted splitter, and the next round probes only inside those buckets with boundaries that
are 4,096 times finer, until every splitter meets the tolerance or separates two
neighbouring keys. Then the rows are exchanged once.

Groups of equal texts larger than ``1 / heavy_part`` of a shard would make a splitter miss
its target. There are at most ``shards * heavy_part`` of them, a number that does not grow
with the data; they are placed whole, largest first, on the least filled shard, before the
splitters share out the other keys over the bytes left. Only a group larger than a shard is
cut, by a second histogram over a hash of its identifiers.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salarium.llm.tables import column, keyed, stored, text_of

KEY_BITS = 62
_PROBE_BITS = 12
_TOP = 1 << KEY_BITS


def _key(c: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(c), 64 - KEY_BITS)


def splitters(df: DataFrame, key: str, weight: str, targets: list[int], tolerance: float) -> list[int]:
    """Key boundaries such that the weight of the keys below boundary i is near target i.

    Each round is one aggregation over ``df`` with at most ``len(targets) * 4096`` result
    rows. A splitter is done when it is within ``tolerance`` of its target, or at the nearer
    end of a bucket that holds a single key value.
    """
    # open[t] = (bucket number at the present width, weight below the bucket)
    found: dict[int, int] = {}
    opened = {i: (0, 0) for i in range(len(targets))}
    shift = KEY_BITS
    while opened and shift > 0:
        finer = max(0, shift - _PROBE_BITS)
        buckets = sorted({b for b, _ in opened.values()})
        near = df if shift == KEY_BITS else df.where(F.shiftright(key, shift).isin(buckets))
        rows = near.groupBy(F.shiftright(key, finer).alias("b")).agg(F.sum(weight).alias("w")).collect()
        counts: dict[int, list[tuple[int, int]]] = {}
        for r in rows:
            counts.setdefault(r["b"] >> (shift - finer), []).append((r["b"], r["w"]))
        still: dict[int, tuple[int, int]] = {}
        for i, (bucket, below) in opened.items():
            edge, inside = bucket << (shift - finer), None
            for b, w in sorted(counts.get(bucket, [])):
                if below + w >= targets[i]:
                    inside = (b, w)
                    break
                below, edge = below + w, b + 1
            if inside is None:
                found[i] = min(_TOP, edge << finer)
                continue
            b, w = inside
            under, over = targets[i] - below, below + w - targets[i]
            if min(under, over) <= tolerance or finer == 0:
                found[i] = (b if under <= over else b + 1) << finer
            else:
                still[i] = (b, below)
        opened, shift = still, finer
    return [found[i] for i in range(len(targets))]


def _place_groups(heavy: list[tuple[int, int]], total: int, shards: int) -> tuple[dict[int, list[tuple[int, int]]], list[int]]:
    """Share out heavy groups: {key: [(shard, bytes), ...]} and the bytes put on each shard."""
    level = total / shards
    load = [(0, s) for s in range(shards)]
    heapq.heapify(load)
    placed: dict[int, list[tuple[int, int]]] = {}
    for w, key in sorted(((w, k) for k, w in heavy), reverse=True):
        rest = w
        while rest > 0:
            filled, shard = heapq.heappop(load)
            # a group larger than the room of an empty shard is cut
            piece = rest if w <= level else min(rest, max(1, round(level) - filled))
            placed.setdefault(key, []).append((shard, piece))
            heapq.heappush(load, (filled + piece, shard))
            rest -= piece
    loads = [0] * shards
    for filled, shard in load:
        loads[shard] = filled
    return placed, loads


def _room(loads: list[int], light: int) -> list[int]:
    """Bytes of the other keys for each shard, so that all shards come out level."""
    order = sorted(loads)
    level = 0.0
    for n in range(1, len(order) + 1):
        level = (light + sum(order[:n])) / n
        if n == len(order) or level <= order[n]:
            break
    return [max(0, round(level - x)) for x in loads]


def assign_shards(
    docs: DataFrame,
    shards: int,
    text_col: str = "text",
    id_col: str = "doc_id",
    overhead: int = 8,
    heavy_part: int = 256,
    lane_rows: int = 100_000,
) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard``, under the law ``bytes``: the shards' sizes are near equal.

    ``size`` is the text's UTF-8 bytes plus ``overhead``. Equal texts share a shard unless
    together they exceed one. ``slot`` numbers the rows of a shard from 0 without gaps, in the
    order of (lane, text hash, id); each shard is numbered by as many tasks (lanes) as it would
    need for ``lane_rows`` rows in each, had all shards equally many.
    ``grown_shard`` is null, as it belongs to the law ``key``.

    A null text has no bytes and equals the empty text. Null ids and repeated rows are rows
    like any other. Other columns, of whatever name, are not read. An empty table gives an
    empty result.
    """
    text = text_of(docs, text_col)
    rows = stored(
        docs.select(
            column(docs, id_col).alias("id"),
            (F.octet_length(text) + F.lit(overhead)).cast("bigint").alias("size"),
            F.crc32(text).alias("crc"),
            _key(text).alias("key"),
            _key(F.struct(column(docs, id_col), _key(text))).alias("id_key"),
        ),
        "shard-rows",
    )
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    lanes = max(1, -(-n_rows // (shards * lane_rows)))
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    # at most shards * heavy_part rows, as each holds more than that part of all bytes
    bound = total // (shards * heavy_part)
    heavy = [(r["key"], r["size"]) for r in groups.where(F.col("size") > bound).collect()] if total else []
    placed, loads = _place_groups(heavy, total, shards)
    tolerance = total / shards / (4 * heavy_part)

    pieces = []  # (key, from, to, shard): where the rows of a heavy group go, by their id key
    for key, parts in placed.items():
        cuts = [0, _TOP]
        if len(parts) > 1:
            ends = [sum(p for _, p in parts[: i + 1]) for i in range(len(parts) - 1)]
            cuts = [0, *splitters(rows.where(F.col("key") == key), "id_key", "size", ends, tolerance), _TOP]
        pieces += [(key, lo, hi, shard) for (shard, _), lo, hi in zip(parts, cuts, cuts[1:])]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("heavy_key", "lo", "hi")] + [T.StructField("heavy_shard", T.IntegerType())])
    heavy_df = F.broadcast(rows.sparkSession.createDataFrame(pieces, schema))
    on = (F.col("key") == F.col("heavy_key")) & (F.col("id_key") >= F.col("lo")) & (F.col("id_key") < F.col("hi"))
    split = rows.join(heavy_df, on, "left").drop("heavy_key", "lo", "hi")

    room = _room(loads, total - sum(loads))
    ends = [sum(room[: i + 1]) for i in range(shards - 1)]
    light = split.where(F.col("heavy_shard").isNull())
    cuts = splitters(light, "key", "size", ends, tolerance) if total and shards > 1 else []
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("key") >= F.lit(cut)).cast("int")
    dealt = split.select(
        "id", "size", "crc", "key",
        F.coalesce("heavy_shard", shard).cast("int").alias("shard"),
        F.pmod("id_key", F.lit(lanes)).cast("int").alias("lane"),
    )

    # slots: rows before the lane (a count for each lane of a shard) plus the row's place in its lane
    counts = dealt.groupBy("shard", "lane").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    place = F.row_number().over(Window.partitionBy("shard", "lane").orderBy("key", "id"))
    return dealt.withColumn("place", place).join(offsets, ["shard", "lane"]).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("place") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, path: str, shards: int, text_col: str = "text", id_col: str = "doc_id", file_bytes: int = 512 << 20
) -> None:
    """Write ``docs`` as one folder per shard (``_shard=0``, ``_shard=1``, ...), all columns kept.

    A row is known by a key of its own, so null and repeated ids are dealt like any other.
    Where ``docs`` has a column of the folders' name, the folders' name gets one more ``_``.
    A shard is written in about as many files as it has ``file_bytes`` of text, so no task
    writes a whole large shard.
    """
    whole, slim = keyed(docs, id_col, text_col)
    where = assign_shards(slim, shards, "text", "key").select("key", F.col("shard").alias("to"))
    name = "_shard"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    size = slim.agg(F.sum(F.octet_length(F.col("text").cast("string")).cast("bigint"))).first()[0] or 0
    files = max(1, -(-size // (shards * file_bytes)))
    dealt = whole.join(where, "key").repartition(shards * files, "to", F.pmod(F.xxhash64("key"), F.lit(files)))
    rows = dealt.select(*(F.col("row").getField(c).alias(c) for c in docs.columns), F.col("to").alias(name))
    rows.write.mode("overwrite").partitionBy(name).parquet(path)
