import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from salarium.llm import sharding


def check(rows, got, shards, slack):
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots, sizes = defaultdict(list), Counter({s: 0 for s in range(shards)})
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert max(sizes.values()) - min(sizes.values()) <= slack


def test_even_sizes_and_groups_together(spark):
    rows = [(i, f"word {i} " * (i % 50)) for i in range(3000)] + [(5000 + i, "copy " * 20) for i in range(30)]
    rows += [(None, "a"), (1, None), (2, ""), (2, ""), (9000, "é" * 3000)]
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    total = sum(r["size"] for r in got)
    check(rows, got, 6, total / 6 * 0.02)
    home = defaultdict(set)
    for r in got:
        home[r.text_crc32].add(r.shard)
    assert all(len(x) == 1 for x in home.values())


def test_group_larger_than_a_shard_is_cut_evenly(spark):
    rows = [(i, "the one copy") for i in range(2000)] + [(5000 + i, f"other {i}") for i in range(1000)]
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 8).collect()
    total = sum(r["size"] for r in got)
    check(rows, got, 8, total / 8 * 0.05)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a"), (2, "b")], [(None, "x" * 100000), (3, "")]])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("shard", F.lit("s"))
    got = sharding.assign_shards(df, 4).collect()
    check(rows, got, 4, 10**9)


def test_splitters_meet_targets(spark):
    df = spark.range(5000).select((F.abs(F.xxhash64("id")) % (1 << 62)).alias("k"), F.lit(3).cast("long").alias("w"))
    cuts = sharding.splitters(df, "k", "w", [3000, 7500, 15000], 0)
    below = [df.where(F.col("k") < c).count() * 3 for c in cuts]
    assert below == [3000, 7500, 15000]


@pytest.mark.parametrize("seed", range(3))
def test_splitters_are_the_nearest_cuts(spark, seed):
    rng = np.random.default_rng(seed)
    # small keys, neighbouring keys and large ones; a few of them hold most of the weight
    keys = np.concatenate([rng.integers(0, 50, 300), (1 << 61) + rng.integers(0, 9, 200), rng.integers(0, 1 << 62, 500)])
    weights = np.where(rng.random(1000) < 0.02, 5000, rng.integers(1, 30, 1000))
    df = spark.createDataFrame(list(zip(keys.tolist(), weights.tolist())), "k long, w long").repartition(4)
    total = int(weights.sum())
    targets = sorted(rng.integers(1, total, 7).tolist())
    below = lambda cut: int(weights[keys < cut].sum())
    every = sorted({below(k) for k in keys.tolist()} | {total})
    for target, cut in zip(targets, sharding.splitters(df, "k", "w", targets, 0)):
        assert abs(below(cut) - target) == min(abs(b - target) for b in every)


@pytest.mark.parametrize("lane_rows", [1, 7, 10**6])
def test_slots_of_any_number_of_lanes(spark, lane_rows):
    rows = [(i, f"text {i} " * (i % 9)) for i in range(400)] + [(None, f"no id {i}") for i in range(200)] + [(None, "x")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sharding.assign_shards(df, 5, lane_rows=lane_rows).collect()
    check(rows, got, 5, sum(r["size"] for r in got) / 5 * 0.2)


def test_write_shards(spark, tmp_dir):
    df = spark.createDataFrame([(i, f"text {i}", "en") for i in range(40)], "doc_id long, text string, lang string")
    sharding.write_shards(df, tmp_dir + "/out", 3)
    back = spark.read.parquet(tmp_dir + "/out")
    assert sorted(back.select("doc_id", "text", "lang").collect()) == sorted(df.collect())
    assert back.select("_shard").distinct().count() == 3


def test_large_shards_are_written_in_several_files(spark, tmp_dir):
    df = spark.createDataFrame([(i, f"text {i} " * 10) for i in range(300)], "doc_id long, text string")
    sharding.write_shards(df, tmp_dir + "/files", 2, file_bytes=4000)
    back = spark.read.parquet(tmp_dir + "/files")
    assert sorted(back.select("doc_id", "text").collect()) == sorted(df.collect())
    assert back.select("_shard", F.input_file_name()).distinct().count() > 2
