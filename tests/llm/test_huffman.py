import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salarium.llm import huffman

BYTES = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  ", "a   b", "  a", "a \n b", "a\n b", "a\n  b \n", "\n a\t b", "x\xa0 y", "x \xa0y", "x   y", "é è",
    "it's they'll 's <|endoftext|> a <|endoftext|>b <|endof", "tab\t\tb  \r\n c", "日本 語", "\0 a", "a \0b", "emoji 👩‍👩‍👧", "word " * 3000, "z" * 20000, "\x1c a \x1f b",
]


def library(texts):
    return [e.ids for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("lot", [None, 40])
def test_units_equal_to_the_library(monkeypatch, lot):
    if lot:  # every text is cut into pieces
        monkeypatch.setattr(huffman.UnitEncoder, "LOT", lot)
    pieces = ["a", "B", " ", "  ", "\n", "\t", ",", ".", "'s", "!", "1", "é", "\xa0", "<|endoftext|>", ". ", ", ", ".\n", "\r\n", "ll", "\x1c", "\0"]
    rng = np.random.default_rng(4)
    texts = TEXTS + ["".join(rng.choice(pieces, int(n))) for n in rng.integers(0, 40, 4000)]
    encoder = huffman.UnitEncoder(BYTES, cache_entries=200)
    assert encoder.by_unit
    want = library(texts)
    for _ in range(3):
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode([t.encode() for t in texts])]
        assert got == want


def test_units_that_collide_in_polynomial_hashes():
    # a Thue-Morse string and its complement agree in every polynomial hash modulo 2^64 with an odd base
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    texts = ["".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)]
    encoder = huffman.UnitEncoder(BYTES)
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert got == library(texts) and got[0] != got[1]


def huffman_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


@pytest.mark.parametrize("seed", range(4))
def test_code_is_complete_optimal_and_limited(seed):
    rng = np.random.default_rng(seed)
    counts = (rng.pareto(0.6, 300) * 10 + 1).astype(np.int64)
    free = huffman.code_lengths(counts, 40)
    assert (counts * free).sum() == huffman_cost(counts.tolist())
    for limit in (9, 11, 14):
        bits = huffman.code_lengths(counts, limit)
        assert bits.max() <= limit and (2.0 ** -bits).sum() == 1
        assert (counts * bits).sum() >= (counts * free).sum()
    with pytest.raises(ValueError):
        huffman.code_lengths(counts, 8)


def test_limit_is_optimal_by_exhaustion():
    from itertools import product

    counts = np.array([1, 1, 2, 9, 30, 70])
    best = min(sum(c * b for c, b in zip(counts, bits)) for bits in product(range(1, 5), repeat=6) if sum(2.0 ** -b for b in bits) <= 1)
    assert (counts * huffman.code_lengths(counts, 4)).sum() == best


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_pack_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 700).astype(np.uint16)
    seen, counts = np.unique(ids, return_counts=True)
    code = huffman.Code(seen, huffman.code_lengths(counts, 12))
    payload, marks = huffman.pack(ids, *code.encoder())
    assert (huffman.unpack(payload, marks, n, code.decoder(), code.max_bits) == ids).all()


def expected(rows):
    out, start = [], 0
    ids = {t: x + [2] for t, x in zip({t for _, t in rows}, library([t or "" for t in {t for _, t in rows}]))}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        out.append((i, start, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())))
        start += len(ids[t])
    return out


def test_file_round_trip(spark):
    rows = [(i * 7 % 1009, f"doc {i} " * (i % 90)) for i in range(600)] + [(None, "no id"), (3000, None), (3000, "b"), (3000, "a"), (3000, "a")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id long, ids string").repartition(6)
    got = huffman.token_file_round_trip(df, BYTES, end_id=2)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(rows)


def test_small_blocks_stand_alone_and_ids_come_back(spark, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    huffman.write_token_file(docs, tmp_dir + "/f", BYTES, end_id=2, max_bits=16, block_ids=3000)
    assert spark.read.parquet(tmp_dir + "/f/blocks").count() > 20
    got = sorted(huffman.read_token_file(spark, tmp_dir + "/f").collect(), key=lambda r: r.start)
    rows = docs.orderBy("doc_id").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [x + [2] for x in library([r.text for r in rows])]


def test_one_id_and_text_in_most_rows(spark):
    rows = [(5, "the same text")] * 900 + [(None, f"n{i % 3}") for i in range(200)] + [(i, f"doc {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    ordered, _ = huffman._ordered_ids(df, BYTES, 2, "text", "doc_id")
    assert max(r["count"] for r in ordered.groupBy("part").count().collect()) < 500
    got = huffman.token_file_round_trip(df, BYTES, end_id=2)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert huffman.token_file_round_trip(df, BYTES, end_id=2).count() == 0
    one = spark.createDataFrame([(1, "")], "doc_id long, text string")
    assert huffman.token_file_round_trip(one, BYTES).collect()[0][1:3] == (0, 0)
