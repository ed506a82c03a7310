"""The functions that return rows of their input: no row is lost by its id, none crash on names."""

from collections import Counter

import pytest

from salarium.llm import decontaminate, exact_dedup, mixing, sharding, simhash_dedup

ITEM = "one passage of the benchmark that nobody may train on because it is asked later"
SCHEMA = ("doc_id long, text string, lang string, source string, _id long, _shard string, _mix_copies int, key string, "
          "id string, `row` string, row_key int, copies int, `a.b` string, component_id int")


def frame(spark, rows):
    extra = ("en", "source1", 5, "s", 6, "k", "i", "r", 7, 8, "dot", 9)
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], SCHEMA).repartition(3)


def kept(df, got):
    assert got.columns == df.columns
    return sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)


WORDS = [f"word{i}" for i in range(40)]
A, B, C = " ".join(WORDS[:20]), " ".join(WORDS[20:]), "something else entirely, found nowhere but here"


def test_exact(spark):
    rows = [(7, A), (7, B), (3, A.upper()), (9, C), (9, C), (None, B), (None, "x y"), (None, "x y")]
    df = frame(spark, rows)
    assert kept(df, exact_dedup.drop_duplicates(df)) == sorted([(3, A.upper()), (7, B), (9, C), (None, "x y")], key=repr)
    assert kept(df, exact_dedup.drop_duplicates(df, keep="largest")) == sorted([(7, A), (7, B), (9, C), (None, "x y")], key=repr)
    assert exact_dedup.drop_duplicates(df.limit(0)).count() == 0


def test_near(spark):
    rows = [(7, A), (7, B), (3, A), (9, C), (9, C), (None, B), (None, "x y z z y"), (None, "x y z z y")]
    df = frame(spark, rows)
    got = kept(df, simhash_dedup.drop_near_duplicates(df))
    assert got == sorted([(3, A), (7, B), (9, C), (None, "x y z z y")], key=repr)


def test_contaminated(spark):
    rows = [(7, ITEM), (7, B), (9, C), (9, C), (None, ITEM), (None, A), (5, f"{A} {ITEM} {B}")]
    df, items = frame(spark, rows), spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert kept(df, decontaminate.drop_contaminated(df, items)) == sorted([(7, B), (9, C), (9, C), (None, A)], key=repr)


def test_mixed(spark):
    rows = [(7, A), (7, B), (9, C), (9, C), (None, A), (None, A)]
    df = frame(spark, rows)
    levels = {"lang": "lang", "source": "source"}
    got = kept(df, mixing.mixed_documents(df, levels, {}, budget_share=2.0))
    assert Counter(got) == Counter({k: 2 * n for k, n in Counter(rows).items()})


def test_shards(spark, tmp_dir):
    rows = [(i // 2, f"text {i}") for i in range(40)] + [(None, f"none {i}") for i in range(40)]
    df = frame(spark, rows)
    sharding.write_shards(df, tmp_dir + "/out", 4)
    back = spark.read.parquet(tmp_dir + "/out")
    assert kept(df, back.select(*(back[f"`{c}`"] for c in df.columns))) == sorted(rows, key=repr)
    nulls = back.where("doc_id IS NULL").groupBy("_shard_").count().collect()
    assert len(nulls) == 4


@pytest.mark.parametrize("n", [33_000, 66_500])
def test_long_items_do_not_overflow(spark, n):
    items = spark.createDataFrame([(1, "same " * n), (2, ITEM)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{A} {ITEM}"), (2, B)], "doc_id long, text string")
    got = decontaminate.contaminated(docs, items)
    assert [(r.doc_id, r.item_id) for r in got.collect()] == [(1, 2)]
