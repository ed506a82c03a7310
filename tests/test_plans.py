"""Distributed building blocks against brute force."""

import math
import random

from pyspark.sql import functions as F

from salarium.plans.joins import bounded
from salarium.plans.percentile import exact_percentiles
from salarium.plans.sequence import with_sequence


def _pg_percentile(values, p):
    xs = sorted(values)
    pos = (len(xs) - 1) * p
    lo, hi = xs[math.floor(pos)], xs[math.ceil(pos)]
    return float(lo) + (pos - math.floor(pos)) * (float(hi) - float(lo))


def test_sequence_matches_global_order(spark):
    rnd = random.Random(3)
    keys = rnd.sample(range(10**6), 5000)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k long, v string").repartition(7)
    out = with_sequence(df, ["k"], "id", start=11).collect()
    got = {r.k: r.id for r in out}
    expect = {k: i + 11 for i, k in enumerate(sorted(keys))}
    assert got == expect


def test_sequence_descending_with_ties(spark):
    df = spark.createDataFrame([(s, str(i)) for i, s in enumerate([3.0, 1.0, 3.0, 2.0, 5.0])], "s double, r string")
    out = sorted((r.id, r.s, r.r) for r in with_sequence(df, [F.desc("s"), F.asc("r")], "id").collect())
    assert [(i, s) for i, s, _ in out] == [(1, 5.0), (2, 3.0), (3, 3.0), (4, 2.0), (5, 1.0)]
    assert [r for _, _, r in out][1:3] == ["0", "2"]


import pytest


def test_exact_percentiles_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for g, n in [("hot", 4000), ("a", 1), ("b", 2), ("c", 37), (None, 5)]:
        rows += [(g, rnd.randint(0, 300) * 10 if rnd.random() < 0.8 else None) for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, v long")
    probs = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs, stats_prefix="s_").collect()}
    for g in {r[0] for r in rows}:
        vals = [v for gg, v in rows if gg == g and v is not None]
        if not vals:
            assert g not in got
            continue
        r = got[g]
        for name, p in probs.items():
            assert getattr(r, name) == _pg_percentile(vals, p), (g, name)
        assert (r.s_total, r.s_min, r.s_max, r.s_sum) == (len(vals), min(vals), max(vals), sum(vals))


def test_hot_group_spans_several_slices(spark):
    # one group only: the range partitioning must split it and the offsets must stitch it
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        vals = list(range(20000))
        df = spark.createDataFrame([("x", v) for v in vals], "g string, v long")
        r = exact_percentiles(df, ["g"], "v", {"m": 0.5, "q": 0.37}).first()
        assert r.m == _pg_percentile(vals, 0.5) and r.q == _pg_percentile(vals, 0.37)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_bounded_counts_the_whole_table(spark):
    small = spark.createDataFrame([(k, k * 10) for k in range(4)], "k long, w long")
    assert not bounded(small, max_rows=3)[1] and bounded(small, max_rows=4)[1]


def test_bounded_checks_bytes(spark):
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "k long, s string")
    _, ok_rows = bounded(wide, max_rows=100)
    _, ok_bytes = bounded(wide, max_rows=100, max_bytes=10_000)
    assert ok_rows and not ok_bytes


def test_relationship_check_both_paths(spark):
    from salarium.operators.quality import expect_relationship
    child = spark.createDataFrame([(k,) for k in ["a"] * 50 + ["b", "c", None, "z", "z"]], "k string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    small = expect_relationship(child, "c", "k", parent, "p", "k").first().failures
    spark.conf.set("salarium.broadcast.maxRows", "1")
    try:
        large = expect_relationship(child, "c", "k", parent, "p", "k").first().failures
    finally:
        spark.conf.unset("salarium.broadcast.maxRows")
    assert small == large == 3


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "g string, v long")
    assert exact_percentiles(empty, ["g"], "v", {"m": 0.5}, stats_prefix="s_").count() == 0
    assert with_sequence(empty, ["v"], "id").count() == 0
    only_nulls = spark.createDataFrame([("a", None)], "g string, v long")
    assert exact_percentiles(only_nulls, ["g"], "v", {"m": 0.5}).count() == 0
