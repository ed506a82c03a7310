"""Token-id files: canonical length-limited Huffman codes over global id counts.

Writing takes three passes. Texts are range-partitioned, sorted by id and tokenised, and the
token ids stored; the ids are counted over the whole corpus and a length-limited canonical
code is made from the counts (package-merge; the vocabulary bounds what reaches the
driver); the ids are packed into blocks. A block holds whole documents in order and stands
alone: its payload starts at bit 0 and checkpoints give the bit offset of every 128th id.

Reading decodes all checkpoints of a block side by side with one table that maps the next
``max_bits`` bits to an id and its code length.

A token file is a folder with two Parquet tables:

``code``    id, bits: the code length of each id that occurs. Codes follow from the lengths:
            shorter first, equal lengths by id, each the previous plus one.
``blocks``  part, seq (place of the block's first document; blocks in (part, seq) order are
            the corpus), first (ids before the block in its part), doc_ids, doc_tokens,
            payload (bits from the highest of the first byte on), checkpoints (little-endian
            unsigned 64-bit bit offsets).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salarium.llm.tables import column, configure, partitions, per_process, stored, table_path, text_of

CHECKPOINT_IDS = 128

# classes of bytes; a solid one surely begins a character that is no white space
_ASCII, _PRINTABLE, _SOLID, _LETTER, _SPACE, _LINE_FEED = (np.uint8(1 << i) for i in range(6))


def _runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, ``sizes`` of them, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


# ---- tokenising ------------------------------------------------------------------------


def _buffers(units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a binary array."""
    offsets = np.frombuffer(units.buffers()[1], np.int32, len(units) + 1, units.offset * 4).astype(np.int64)
    return offsets - offsets[0], np.frombuffer(units.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]


class UnitEncoder:
    """Token ids of UTF-8 texts exactly as the tokenizers library gives them.

    A byte-level pre-tokenizer never joins characters across these places, so a text is the
    sum of the units between them:

    * before a space that a character other than white space follows;
    * after an ASCII letter, before any other ASCII character;
    * after a line feed that follows a printable ASCII character, before an ASCII letter.

    Units are found with array operations and told apart by their bytes (Arrow's dictionary
    encoding); every different unit of a lot is looked up once in a bounded cache, and new ones
    are encoded by the library, many joined in one text. Texts with special strings, and all texts of
    tokenizers of another kind, go to the library whole.
    """

    LOT = 1 << 21  # bytes of text handled at once
    JOINED = 48  # new units in one text for the library, which is slower on long ones

    def __init__(self, path: str, cache_entries: int = 150_000):
        import json
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_unit = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
        )
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.token_bytes = np.zeros(size, np.int64)  # a byte-level token has one letter for each byte
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.token_bytes[i] = len(token)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.cache_entries = cache_entries
        self._forget(pa.array([], pa.binary()), np.empty(0, np.int64), np.empty(0, np.int64))
        classes = np.zeros(256, np.uint8)
        classes[:128] |= _ASCII
        classes[33:127] |= _PRINTABLE | _SOLID
        classes[[*range(65, 91), *range(97, 123)]] |= _LETTER
        classes[[0xC3, *range(0xC4, 0xE1), *range(0xE4, 0xF5)]] |= _SOLID
        classes[32] |= _SPACE
        classes[10] |= _LINE_FEED
        self.class_of, self.classes = classes, classes.tobytes()

    def _library(self, texts: list[bytes]) -> list[bytes]:
        strings = [t.decode(errors="replace") for t in texts]
        encoded = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    # -- new units

    def _cut(self, texts: list[bytes], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of ``texts``, one after the other, and how many stand before each of the byte
        offsets ``ends`` (the last is the end); nothing if a token crosses one."""
        flat = np.frombuffer(b"".join(self._library(texts)), self.dtype)
        upto = np.cumsum(self.token_bytes[flat])
        cuts = np.searchsorted(upto, ends) + 1
        if not len(upto) or upto[-1] != ends[-1] or (upto[cuts - 1] != ends).any():
            return None
        return flat, cuts

    def _spaced(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their number for units of a space and a word, which stay apart when joined."""
        offsets, data = _buffers(units)
        edges = [*range(0, len(units), self.JOINED), len(units)]
        raw = data.tobytes()
        got = self._cut([raw[x:y] for x, y in zip(offsets[edges[:-1]].tolist(), offsets[edges[1:]].tolist())], offsets[1:])
        return got and (got[0], np.diff(got[1], prepend=0))

    def _words(self, units: list[bytes]) -> dict[bytes, bytes]:
        """The ids of units of ASCII letters, from texts with a line feed, one token, before each."""
        texts = [b"\n" + b"\n".join(units[at : at + self.JOINED]) for at in range(0, len(units), self.JOINED)]
        got = self._cut(texts, np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1))
        if not got:
            return {}
        flat, cuts = got
        return {u: flat[x:y].tobytes() for u, x, y in zip(units, [1, *(cuts[:-1] + 1).tolist()], cuts.tolist())}

    def _new(self, units: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """New units in an order of its own, with their ids one after the other and their numbers."""
        offsets, data = _buffers(units)
        begins, width = offsets[:-1], np.diff(offsets)
        second = self.class_of[data[np.minimum(begins + 1, len(data) - 1)]]
        spaced = pa.array((width > 1) & (data[begins] == 32) & ((second & _SOLID) != 0))
        some, odd = units.filter(spaced), units.filter(pc.invert(spaced))
        got = self._spaced(some) if len(some) else None
        if got is None:
            got, some, odd = (np.empty(0, self.dtype), np.empty(0, np.int64)), some[:0], pa.concat_arrays([some, odd])
        listed = odd.to_pylist()
        found = self._words([u for u in listed if u.isalpha()])  # bytes: ASCII letters
        rest = [u for u in listed if u not in found]
        found.update(zip(rest, self._library(rest)))
        ids = [found[u] for u in listed]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        flat = np.concatenate([got[0], np.frombuffer(b"".join(ids), self.dtype)])
        return pa.concat_arrays([some, odd]), flat, np.concatenate([got[1], sizes])

    # -- units known from earlier lots: their bytes, and where their ids stand in one array

    def _forget(self, units: pa.Array, begins: np.ndarray, sizes: np.ndarray) -> None:
        """Know only the given units, whose ids stand at ``begins`` now."""
        self.known, self.sizes = units, sizes
        self.begins = np.cumsum(sizes) - sizes
        self.flat = np.empty(0, self.dtype) if not len(sizes) else self.flat[_runs(begins, sizes)]

    def _places(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each of the different ``units`` begin in ``flat``, and how many there are."""
        at = pc.index_in(units, value_set=self.known)
        if at.null_count:
            fresh, flat, sizes = self._new(units.filter(at.is_null()))
            self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, flat])
            self.known = pa.concat_arrays([self.known, fresh])
            at = pc.index_in(units, value_set=self.known)
        place = at.to_numpy()
        begins, sizes = self.begins[place], self.sizes[place]
        if len(self.sizes) > self.cache_entries or self.known.nbytes > self.LOT * 8:
            self._forget(units, begins, sizes)  # what this lot needed stays
            begins = self.begins
        return begins, sizes

    # -- texts

    def _lot(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts of at most ``LOT`` bytes together, none with special strings."""
        joined = b"".join(texts)
        n = len(joined)
        if not n:
            return [b""] * len(texts)
        here = np.frombuffer(joined.translate(self.classes), np.uint8)
        before = here[:-1]
        cut = np.zeros(n, bool)
        cut[:-1] = ((before & _SPACE) != 0) & ((here[1:] & _SOLID) != 0)
        cut[1:] |= ((before & _LETTER) != 0) & ((here[1:] & (_LETTER | _ASCII)) == _ASCII)
        cut[2:] |= ((before[1:] & _LINE_FEED) != 0) & ((here[:-2] & _PRINTABLE) != 0) & ((here[2:] & _LETTER) != 0)
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        text_starts = np.concatenate([[0], text_ends[:-1]])
        cut[text_starts[text_starts < n]] = True
        starts = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(np.append(starts, n).astype(np.int32)), pa.py_buffer(joined)]
        units = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
        which = units.indices.to_numpy()
        begins, sizes = self._places(units.dictionary)
        each = sizes[which]
        upto = np.concatenate([[0], np.cumsum(each)])
        out = self.flat[_runs(begins[which], each)].tobytes()
        at = upto[np.searchsorted(starts, np.append(text_starts, n))] * self.dtype.itemsize
        return [out[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]

    def _long(self, text: bytes) -> bytes:
        """A text longer than a lot, in pieces that end before a space and an ASCII letter."""
        out, at = [], 0
        while at < len(text):
            end = min(len(text), at + self.LOT)
            while end < len(text) and not (text[end] == 32 and text[end + 1 : end + 2].isalpha()):
                end = text.rfind(b" ", at, end)
                if end <= at:
                    return self._library([text])[0]
            out += self._lot([text[at:end]])
            at = end
        return b"".join(out)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as little-endian integers of ``dtype``."""
        if not self.by_unit:
            return self._library(texts)
        out: list[bytes] = []
        lot, size = [], 0

        def flush() -> None:
            nonlocal lot, size
            if lot:
                out.extend(self._lot(lot))
            lot, size = [], 0

        for text in texts:
            special = any(s in text for s in self.specials)
            if special or len(text) > self.LOT:
                flush()
                out.append(self._library([text])[0] if special else self._long(text))
                continue
            if size + len(text) > self.LOT:
                flush()
            lot.append(text)
            size += len(text)
        flush()
        return out


def _ordered_ids(docs: DataFrame, vocabulary: str, end_id: int | None, text_col: str, id_col: str) -> tuple[DataFrame, str]:
    """Token ids in ascending id order, and their numpy type: (part, seq, first, id, ids).

    Texts are sorted before they are tokenised, as finding the range boundaries reads its
    input twice. Each row has its part, its place and the ids before it in the part, so
    later reads may cut and group the stored files as they like.
    """
    dtype = UnitEncoder(vocabulary).dtype

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(f"units {vocabulary}", lambda: UnitEncoder(vocabulary))
        end = b"" if end_id is None else np.array([end_id], dtype).tobytes()
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            ids = [x + end for x in encoder.encode(texts)]
            ends = first + np.cumsum(np.fromiter(map(len, ids), np.int64, n) // dtype.itemsize)
            firsts = np.concatenate([[first], ends])[:n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)), pa.array(firsts, pa.int64()),
                 batch.column(0), pa.array(ids, pa.binary())], ["part", "seq", "first", "id", "ids"])
            seq, first = seq + n, int(ends[-1]) if n else first

    read = docs.select(column(docs, id_col).alias("id"), text_of(docs, text_col).alias("text"))
    # rows that repeat an id, null included, are dealt on by text and place, so they don't meet in one task
    order = ["id", "head", "place"]
    keyed = read.withColumn("head", F.substring("text", 1, 32)).withColumn("place", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order).select("id", "text")
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()), T.StructField("first", T.LongType()),
        T.StructField("id", read.schema["id"].dataType), T.StructField("ids", T.BinaryType()),
    ])
    return ordered.mapInArrow(run, schema), dtype.str


# ---- the code --------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive ``counts`` (package-merge)."""
    n = len(counts)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need codes of more than {max_bits} bits")
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.int64)[order]
    packages = np.empty(0, np.int64)
    is_leaf = []
    for _ in range(max_bits):
        items = np.concatenate([leaves, packages])
        rank = np.argsort(items, kind="stable")
        is_leaf.append(rank < n)
        items = items[rank]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
    lengths = np.zeros(n, np.int64)
    need = 2 * n - 2  # the cheapest items of the last list; what they package is a prefix of each earlier list
    for flags in reversed(is_leaf):
        own = int(flags[:need].sum())
        lengths[:own] += 1
        need = 2 * (need - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code: ids and their code lengths."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        self.ids, self.bits = np.asarray(ids, np.int64)[order], np.asarray(bits, np.int64)[order]
        self.max_bits = int(self.bits[-1]) if len(self.bits) else 1
        # canonical codes, left-aligned to max_bits, are the running sum of 2**(max_bits - bits)
        span = np.int64(1) << (self.max_bits - self.bits)
        left = np.cumsum(span) - span
        self.codes = left >> (self.max_bits - self.bits)
        self.spans = span

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max()) + 1 if len(self.ids) else 1
        codes, bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        codes[self.ids], bits[self.ids] = self.codes, self.bits
        return codes, bits

    def decoder(self) -> tuple[np.ndarray, np.ndarray]:
        """Tables over the next ``max_bits`` bits: id and code length."""
        size = 1 << self.max_bits
        ids, bits = np.zeros(size, np.uint32), np.ones(size, np.int64)
        n = int(self.spans.sum())
        ids[:n], bits[:n] = np.repeat(self.ids, self.spans), np.repeat(self.bits, self.spans)
        return ids, bits


def pack(ids: np.ndarray, codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string of ``ids`` and the bit offset of every ``CHECKPOINT_IDS``-th id."""
    if not len(ids):
        return b"", np.empty(0, np.uint64)
    lengths, code = bits[ids], codes[ids]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    word, room = starts >> 6, 64 - (starts & 63) - lengths
    over = np.flatnonzero(room < 0)
    first = code << np.maximum(room, 0).astype(np.uint64)
    first[over] = code[over] >> (-room[over]).astype(np.uint64)
    out = np.zeros((int(ends[-1]) + 63) // 64 + 1, np.uint64)
    at = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[at]] = np.add.reduceat(first, at)
    out[word[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: (int(ends[-1]) + 7) // 8], starts[::CHECKPOINT_IDS].astype(np.uint64)


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, tables: tuple[np.ndarray, np.ndarray], max_bits: int) -> np.ndarray:
    """The ``n`` ids of a bit string, decoded from all checkpoints side by side."""
    if not n:
        return np.empty(0, np.uint32)
    ids, bits = tables
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    at, last = checkpoints.astype(np.int64), len(payload) * 8
    out = np.empty((CHECKPOINT_IDS, len(at)), np.uint32)
    mask = (1 << max_bits) - 1
    for step in range(CHECKPOINT_IDS):
        following = (window[at >> 3] >> (32 - max_bits - (at & 7))) & mask
        out[step] = ids[following]
        at += bits[following]
        np.minimum(at, last, out=at)  # lanes beyond the last id
    return out.T.reshape(-1)[:n]


# ---- files -----------------------------------------------------------------------------


def _counts(tokens: DataFrame, dtype: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for value in batch.column(0):
                c = np.bincount(np.frombuffer(value.as_py(), dtype))
                if len(c) > len(total):
                    c, total = total, c.astype(np.int64)
                total[: len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["token", "n"])

    return tokens.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _blocks(tokens: DataFrame, ids: np.ndarray, bits: np.ndarray, dtype: str, block_ids: int) -> DataFrame:
    key_type = tokens.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Code(ids, bits).encoder()
        held: list[tuple] = []  # (part, seq, first, id, ids)
        key = None

        def flush() -> pa.RecordBatch:
            pieces = [np.frombuffer(h[4], dtype) for h in held]
            payload, checkpoints = pack(np.concatenate(pieces), *tables)
            values = [*held[0][:3], sum(map(len, pieces)), [h[3] for h in held], [len(p) for p in pieces], payload,
                      checkpoints.astype("<u8").tobytes()]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(key), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = ["part", "seq", "first", "n", "doc_ids", "doc_tokens", "payload", "checkpoints"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        size = 0
        for batch in batches:
            key = batch.schema.field(3).type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (size >= block_ids or held[-1][0] != row[0] or held[-1][1] + 1 != row[1]):
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[4]) // np.dtype(dtype).itemsize
        if held:
            yield flush()

    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
        T.StructField("first", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(key_type)), T.StructField("doc_tokens", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType()), T.StructField("checkpoints", T.BinaryType()),
    ])
    return tokens.select("part", "seq", "first", "id", "ids").mapInArrow(run, schema)


def write_token_file(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int | None = None,
    max_bits: int = 18,
    block_ids: int = 1 << 20,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> None:
    """Write the token ids of ``docs`` as a token file, documents in ascending id order.

    ``end_id`` is appended to each document. A null text is the empty text. A null id comes
    first; rows that repeat an id are ordered by their first
    32 characters, then as read. Other columns are not
    read. An empty table gives a file without documents.
    """
    spark = docs.sparkSession
    configure(spark)
    ordered, dtype = _ordered_ids(docs, vocabulary, end_id, text_col, id_col)
    tokens = stored(ordered, "token-ids")
    counted = _counts(tokens, dtype).collect()  # at most one row per vocabulary entry
    seen = np.array([r["token"] for r in counted], np.int64)
    bits = code_lengths(np.array([r["n"] for r in counted], np.int64), max_bits)
    code = spark.createDataFrame(list(zip(seen.tolist(), bits.tolist())), "id long, bits long")
    code.coalesce(1).write.parquet(f"{path}/code")
    _blocks(tokens, seen, bits, dtype, block_ids).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Decode a token file: id, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (little-endian unsigned 32-bit)."""
    return _decoded(spark, path, digest=False)


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """Decode a token file: id, ``start``, ``n_tokens``, ``ids_crc32`` of the ids as
    little-endian unsigned 32-bit integers."""
    return _decoded(spark, path, digest=True)


def _decoded(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    configure(spark)
    code = spark.read.parquet(f"{path}/code").collect()  # at most one row per vocabulary entry
    ids, bits = np.array([r["id"] for r in code], np.int64), np.array([r["bits"] for r in code], np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    key_type = blocks.schema["doc_ids"].dataType.elementType

    # ids before each part: one row per part
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(parts.select("part", F.coalesce(earlier, F.lit(0)).alias("offset")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Code(ids, bits)
        tables = coder.decoder()
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, doc_tokens, payload, checkpoints, first = (batch.column(i)[row] for i in range(5))
                n_tokens = np.array(doc_tokens.as_py(), np.int64)
                marks = np.frombuffer(checkpoints.as_py(), "<u8")
                got = unpack(payload.as_py(), marks, int(n_tokens.sum()), tables, coder.max_bits).astype("<u4")
                ends = np.cumsum(n_tokens)
                begins = ends - n_tokens
                each = [got[b:e].tobytes() for b, e in zip(begins, ends)]
                last = pa.array(map(zlib.crc32, each), pa.int64()) if digest else pa.array(each, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(begins + first.as_py(), pa.int64()), pa.array(n_tokens), last],
                    ["id", "start", "n_tokens", "last"])

    schema = T.StructType([
        T.StructField("id", key_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("last", T.LongType() if digest else T.BinaryType()),
    ])
    wide = blocks.join(offsets, "part").select(
        "doc_ids", "doc_tokens", "payload", "checkpoints", (F.col("first") + F.col("offset")).alias("first"))
    return wide.mapInArrow(run, schema).withColumnRenamed("last", "ids_crc32" if digest else "ids")


def token_file_round_trip(docs: DataFrame, vocabulary: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` to a token file in the shared folder and return its digest as read back."""
    path = table_path(docs.sparkSession, "token-file")
    write_token_file(docs, path, vocabulary, end_id, text_col=text_col, id_col=id_col)
    return token_file_digest(docs.sparkSession, path).withColumnRenamed("id", id_col)
