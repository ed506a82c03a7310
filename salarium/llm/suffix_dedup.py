"""Removal of long repeats: every byte covered by a ``length``-byte string that also starts
earlier in the corpus (smaller id, or the same document and an earlier start).

Built without a suffix array over all bytes; see the README for why. The groups of equal
``length``-byte suffix prefixes are found exactly in three steps:

1. Each window of ``length`` bytes has an anchor: the leftmost of its ``kmer``-byte strings
   with the smallest hash. Equal windows have equal anchors at equal places, and the windows
   of one anchor are a run. A run is described by its anchor, its bytes and its place.
2. Runs meet by anchor. A run equal to an earlier one is repeated whole. The first of equal
   runs is settled too (nothing repeated) if its anchor has no other kind of run. Equal runs
   of one lot of documents are reduced to the first before the shuffle.
3. Of the others, the runs at the edge of a repeat, every window is hashed and the windows
   meet by anchor again: the first of equal windows stays, the later ones are repeated. The
   windows of an anchor with very many runs meet by their own hash instead, after equal ones
   of one lot are reduced to the first, so a passage in a third of all documents has no
   edge that one task must hold.

A hash is a pair of polynomials modulo the prime 2^31 - 1, of different bases (modulo a power
of two, texts built for it collide under every base); windows are equal when both the anchors'
and their own hashes, of four bases in all, are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salarium.llm.tables import column, configure, partitions, per_process, stored, text_of

_PIECE = 1 << 20  # bytes hashed at once
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_PRIME = (1 << 31) - 1
_POLYNOMIALS = ((0x2545F491, 0x1B873593), (0x5851F42D, 0x3C6EF372))  # two bases for each of two hashes
_PLACE_BITS = 24  # of a byte in its piece
_HOT_RUNS = 2_000  # an anchor with more runs has its windows dealt by their own hash
_NO_ID = -(1 << 63)  # order of a null id: before all others


def _folded(x: np.ndarray) -> np.ndarray:
    """A smaller number that is equal modulo the prime."""
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo the prime."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, _PRIME)) % np.uint64(_PRIME)
        done += step
    return out


class Windows:
    """Anchored runs of the windows of a text."""

    def __init__(self, length: int, kmer: int):
        self.length, self.kmer = length, kmer
        most = _PIECE + 2 * length
        if most >= 1 << _PLACE_BITS:  # also keeps the sums of a piece below 2^64
            raise ValueError(f"windows of {length} bytes are too long")
        self.powers = [
            [(_powers(base, most), _powers(pow(base, -1, _PRIME), most)) for base in pair] for pair in _POLYNOMIALS]

    def _hasher(self, piece: bytes, which: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        raw = np.frombuffer(piece, np.uint8).astype(np.uint64) + np.uint64(1)
        both = []
        for up, down in self.powers[which]:
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(raw * up[: len(piece)], out=sums[1:])
            both.append((sums, down))

        def of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
            h = np.zeros(len(start), np.uint64)
            for sums, down in both:
                part = _folded(_folded(_folded(sums[end] - sums[start]) * down[start]))
                part -= np.where(part >= np.uint64(_PRIME), np.uint64(_PRIME), np.uint64(0))
                h = (h << np.uint64(31)) | part
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            return h ^ (h >> np.uint64(29))

        return of

    def pieces(self, raw: bytes) -> Iterator[tuple[int, bytes]]:
        """Overlapping pieces such that each window is whole in exactly one, and their starts."""
        at = 0
        while at + self.length <= len(raw):
            yield at, raw[at : at + _PIECE + self.length - 1]
            at += _PIECE

    def runs(self, piece: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, content, first window, number of windows) of each run of a piece."""
        n, k = len(piece), self.kmer
        of = self._hasher(piece, 0)
        at = np.arange(n - k + 1)
        key = (of(at, at + k) & ~np.uint64((1 << _PLACE_BITS) - 1)) | at.astype(np.uint64)  # ties: the leftmost
        span, low, done = self.length - k + 1, key, 1
        while done * 2 <= span:
            low = np.minimum(low[: len(low) - done], low[done:])
            done *= 2
        rest = span - done
        low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
        anchor_at = (low & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor_at, prepend=-1))
        count = np.diff(np.append(first, len(anchor_at)))
        place = anchor_at[first]
        anchor = of(place, place + k)
        content = self._hasher(piece, 1)(first, first + count + self.length - 1)
        content = content ^ ((place - first).astype(np.uint64) * np.uint64(_BASES[0])) ^ (count.astype(np.uint64) << np.uint64(48))
        return anchor.view(np.int64), content.view(np.int64), first, count

    def hashes(self, piece: bytes, first: np.ndarray, count: np.ndarray) -> list[bytes]:
        """The hash of every window of each run, as little-endian 64-bit integers."""
        of = self._hasher(piece, 1)
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        flat, ends = of(at, at + self.length).astype("<u8").tobytes(), np.cumsum(count) * 8
        return [flat[e - 8 * c : e] for e, c in zip(ends.tolist(), count.tolist())]


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, and whether a row is the first of its value of all but the last three."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
    for k in keys[:-3]:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new


_RUN = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("content", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("tie", T.LongType()), T.StructField("first", T.LongType()), T.StructField("count", T.IntegerType()),
    T.StructField("repeated", T.BooleanType()),
])


def _runs(windows: Callable[[], Windows]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = windows()
        for batch in batches:
            parts = []
            for key, tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                for at, piece in find.pieces(text.as_py()):
                    anchor, content, first, count = find.runs(piece)
                    parts.append((anchor, content, np.full(len(first), key), np.full(len(first), tie), first + at, count))
            if not parts:
                continue
            cols = [np.concatenate(c) for c in zip(*parts)]
            # of equal runs of this lot only the first has to meet the others
            order, new = _firsts(*cols[:5])
            cols = [c[order] for c in cols]
            once = np.ones(len(order), bool)  # rows equal in id, text and place are one
            once[1:] = np.any([c[1:] != c[:-1] for c in cols[:5]], axis=0)
            cols, new = [c[once] for c in cols], new[once]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.int32()), pa.array(~new)], _RUN.names)

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[tuple[pa.Table, bool]]:
    """Tables of whole keys of a sorted stream, of about ``most`` rows. A key with more rows
    than that comes in several tables, each marked."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= most:
            table = pa.concat_tables(held).combine_chunks()
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], side="left"))
            yield table.slice(0, cut or len(keys)), not cut
            held, rows = ([table.slice(cut)], len(keys) - cut) if cut else ([], 0)
    if held:
        yield pa.concat_tables(held).combine_chunks(), False


_VERDICT = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("id", T.LongType()), T.StructField("tie", T.LongType()),
    T.StructField("first", T.LongType()), T.StructField("count", T.IntegerType()), T.StructField("open", T.BooleanType()),
    T.StructField("hot", T.BooleanType()),
])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated runs, and the first runs of anchors with several contents (open)."""
    last = None  # (anchor, content) at the end of the table before
    for table, split in _groups(batches, "anchor", 400_000):
        anchor, content, key, tie, first, count, repeated = (table.column(i).to_numpy() for i in range(7))
        order, new = _firsts(anchor, content, key, tie, first)
        anchor, content, key, tie, first, count, repeated = (
            c[order] for c in (anchor, content, key, tie, first, count, repeated))
        if last == (anchor[0], content[0]):
            new[0] = False
        # rows equal in id, text and place are one
        same = np.zeros(len(order), bool)
        same[1:] = ~new[1:]
        for c in (key, tie, first):
            same[1:] &= c[1:] == c[:-1]
        kinds = np.flatnonzero(new)
        of_anchor = np.searchsorted(anchor, anchor[kinds], side="right") - np.searchsorted(anchor, anchor[kinds], side="left")
        lone = np.ones(len(kinds), bool)
        next_same = anchor[kinds[1:]] == anchor[kinds[:-1]]
        lone[1:] &= ~next_same
        lone[:-1] &= ~next_same
        large = split or (last is not None and last[0] == anchor[0])
        if large:  # an anchor in several tables counts as one of several contents, in all of them
            lone &= anchor[kinds] != anchor[0]
        open_ = np.zeros(len(order), bool)
        open_[kinds] = ~lone & ~repeated[kinds]
        hot = np.zeros(len(order), bool)
        hot[kinds] = (of_anchor > _HOT_RUNS) | (large & (anchor[kinds] == anchor[0]))
        last = (anchor[-1], content[-1])
        keep = ((~new | repeated) & ~same) | open_
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in (anchor, key, tie, first)]
            + [pa.array(count[keep], pa.int32()), pa.array(open_[keep]), pa.array(hot[keep])], _VERDICT.names)


def _open_windows(windows: Callable[[], Windows]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = windows()
        for batch in batches:
            out: list[tuple] = []  # (key to meet by, id, tie, first, hashes)
            hot: list[tuple] = []  # (anchor, hash, id, tie, window)
            for key, tie, raw, runs in zip(*(c.to_pylist() for c in batch.columns)):
                runs = sorted((r["first"], r["count"], r["anchor"], r["hot"]) for r in runs)
                first, count = (np.array([r[i] for r in runs], np.int64) for i in (0, 1))
                where = first // _PIECE
                for p in np.unique(where):
                    own = np.flatnonzero(where == p)
                    at = int(p) * _PIECE
                    hashed = find.hashes(raw[at : at + _PIECE + find.length - 1], first[own] - at, count[own])
                    for i, h in zip(own.tolist(), hashed):
                        if runs[i][3]:
                            w = np.frombuffer(h, "<u8")
                            hot.append((np.full(len(w), runs[i][2]), w, np.full(len(w), key), np.full(len(w), tie), runs[i][0] + np.arange(len(w))))
                        else:
                            out.append((runs[i][2], key, tie, runs[i][0], h))
            if hot:
                # of equal windows of this lot only the first has to meet the others
                cols = [np.concatenate(c) for c in zip(*hot)]
                order, new = _firsts(*cols)
                anchor, w, key, tie, at = (c[order] for c in cols)
                meet = (anchor.view(np.uint64) * np.uint64(_BASES[0]) ^ w).view(np.int64)
                out += zip(meet.tolist(), key.tolist(), tie.tolist(), at.tolist(), (x if n else None for x, n in zip(
                    map(w.tobytes().__getitem__, map(slice, range(0, 8 * len(w), 8), range(8, 8 * len(w) + 8, 8))), new)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            values = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["anchor", "id", "tie", "first", "hashes"])

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows among the windows of open runs."""
    last = None  # (anchor, hash) of a hot window that fills a whole table
    for table, split in _groups(batches, "anchor", 20_000):
        hashes = table.column("hashes").to_pylist()  # none: one window known to be repeated
        known = np.array([h is None for h in hashes], bool)
        count = np.array([len(h) // 8 if h is not None else 0 for h in hashes], np.int64)
        flat = np.frombuffer(b"".join(h for h in hashes if h is not None), "<u8")
        cols = [table.column(c).to_numpy() for c in ("anchor", "id", "tie", "first")]
        anchor, key, tie, first = (np.repeat(c, count) for c in cols)
        at = first + np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
        order, new = _firsts(anchor, flat, key, tie, at)
        if last is not None and len(order) and last == (anchor[order[0]], flat[order[0]]):
            new[0] = False
        last = (anchor[order[0]], flat[order[0]]) if split and len(order) else None
        again = order[~new]
        key, tie, at = (np.concatenate([a[again], b[known]]) for a, b in zip((key, tie, at), cols[1:]))
        order = np.lexsort((at, tie, key))
        key, tie, at = key[order], tie[order], at[order]
        start = np.ones(len(at), bool)
        start[1:] = (key[1:] != key[:-1]) | (tie[1:] != tie[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(start)
        size = np.diff(np.append(begin, len(at)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[begin]), pa.array(tie[begin]), pa.array(at[begin]), pa.array(size, pa.int32())], ["id", "tie", "first", "count"])


def _cover(raw: bytes, runs: list[dict] | None, length: int) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left)"""
    if not runs:
        return 0, 0, raw
    spans: list[list[int]] = []
    for first, count in sorted((r["first"], r["count"]) for r in runs):
        end = first + count + length - 1
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([first, end])
    kept, at = [], 0
    for begin, end in spans:
        kept.append(raw[at:begin])
        at = end
    return sum(e - b for b, e in spans), len(spans), b"".join([*kept, raw[at:]])


def _judged(docs: DataFrame, length: int, kmer: int, text_col: str, id_col: str) -> DataFrame:
    """(id, key, tie, raw, runs): every row with the runs of its repeated windows."""
    configure(docs.sparkSession)
    windows = lambda: per_process(f"windows {length} {kmer}", lambda: Windows(length, kmer))
    text = text_of(docs, text_col)
    own_id = column(docs, id_col)
    rows = docs.select(
        own_id.alias("id"), F.coalesce(own_id.cast("long"), F.lit(_NO_ID)).alias("key"), F.xxhash64(text).alias("tie"), text.alias("text"))
    parts = partitions(docs)
    runs = rows.select("key", "tie", "text").mapInArrow(_runs(windows), _RUN)
    # runs known to be repeated go anywhere; the others meet by anchor
    to = F.when(F.col("repeated"), F.xxhash64("id", "first")).otherwise(F.col("anchor"))
    met = runs.repartition(parts, to).sortWithinPartitions("anchor", "content", "id", "tie", "first")
    verdicts = stored(met.mapInArrow(_judge, _VERDICT), "repeat-runs")

    opened = verdicts.where("open").groupBy("id", "tie").agg(F.collect_list(F.struct("first", "count", "anchor", "hot")).alias("runs"))
    texts = rows.select(F.col("key").alias("id"), "tie", F.col("text").cast("binary").alias("raw"))
    hashed = texts.dropDuplicates(["id", "tie"]).join(opened, ["id", "tie"]).select("id", "tie", "raw", "runs").mapInArrow(
        _open_windows(windows), "anchor long, id long, tie long, first long, hashes binary")
    # windows known to be repeated go anywhere
    to = F.when(F.col("hashes").isNull(), F.xxhash64("id", "first")).otherwise(F.col("anchor"))
    met = hashed.repartition(parts, to).sortWithinPartitions("anchor", "id", "tie", "first")
    edges = stored(met.mapInArrow(_settle, "id long, tie long, first long, count int"), "repeat-edges")

    every = verdicts.where("not open").select("id", "tie", "first", "count").unionAll(edges)
    by_doc = every.groupBy(F.col("id").alias("d_id"), F.col("tie").alias("d_tie")).agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    on = (F.col("key") == F.col("d_id")) & (F.col("tie") == F.col("d_tie"))
    return rows.join(by_doc, on, "left").select("id", F.col("text").cast("binary").alias("raw"), "runs")


def repeats(docs: DataFrame, length: int = 100, kmer: int = 32, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept_sha256`` of the bytes left.

    Ids are integers. Null and empty texts lose nothing. A null id comes before all others.
    Rows that repeat an id with different texts are documents of their own, in the order of
    a hash of their texts; rows equal in id and text are one document, and each row gets its
    result. Other columns are not read. An empty table gives an empty result.
    """
    judged = _judged(docs, length, kmer, text_col, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                removed, spans, kept = _cover(raw, runs, length)
                found.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest()))
            values = list(zip(*found)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(values, kinds))], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = T.StructType([judged.schema["id"]] + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [
        T.StructField("kept_sha256", T.StringType())])
    return judged.mapInArrow(run, schema).withColumnRenamed("id", id_col)
