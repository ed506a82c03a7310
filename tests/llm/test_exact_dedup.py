import hashlib

import pytest
from pyspark.sql import Row

from salarium.llm import exact_dedup
from salarium.llm.tables import LOWER, UPPER

FOLD = str.maketrans(UPPER, LOWER)


def brute(rows, pick):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(FOLD), []).append(i)
    out = []
    for i, t in rows:
        key = (t or "").translate(FOLD)
        ids = [x for x in groups[key] if x is not None]
        keep = pick(ids) if ids else None
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,pick,bits", [("smallest", min, (6, 3)), ("largest", max, (5, 2))])
def test_against_brute_force(spark, keep, pick, bits):
    rows = [(i, f"Text {i % 37}") for i in range(300)] + [(i, "HOT copy" if i % 2 else "hot COPY") for i in range(300, 450)]
    rows += [(900, None), (901, ""), (902, "É é"), (903, "é é"), (None, "no id"), (None, None), (5, "Text 5"), (904, "x" * 300000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_dedup.exact_duplicates(df, keep=keep, rank_bits=bits[0], bits_per_round=bits[1])
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, pick)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_duplicates(empty).count() == 0
    df = spark.createDataFrame([Row(doc_id=1, text="a", keep_id=7, digest="x", rank=1, id=3, n=2, check=1),
                                Row(doc_id=2, text="A", keep_id=8, digest="y", rank=1, id=4, n=2, check=1)])
    got = exact_dedup.exact_duplicates(df)
    assert sorted((r.doc_id, r.keep_id) for r in got.collect()) == [(1, 1), (2, 1)]
    kept = exact_dedup.drop_duplicates(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [1]


def test_a_round_merges_sorted_runs_in_one_pass(spark):
    runs = spark.range(1000).selectExpr(
        "cast(id % 8 as int) rank", "unhex(sha2(cast(id % 50 as string), 256)) digest", "id % 50 % 3 length", "id % 50 check",
        "named_struct('id', id) best", "1L n")
    merged = exact_dedup.merged_runs(runs, 2, 3, "largest")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "HashAggregate" not in plan
    assert plan.count("Exchange") == 1 and "rangepartitioning(rank" in plan
    got = {(r.rank, r.check): (r.best.id, r.n) for r in merged.collect()}
    want = {}
    for i in range(1000):
        digest = hashlib.sha256(str(i % 50).encode()).digest()
        key = ((digest[0] >> 6) << 1 | (i % 8) & 1, i % 50)
        want[key] = (i, want.get(key, (0, 0))[1] + 1)
    assert got == want


def test_query_equals_its_sql(spark):
    import duckdb

    from salarium.llm.queries import ORACLE_SQL, QUERIES

    directory = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{directory}/documents.parquet'")
    got = QUERIES["op6_exact_dedup"](spark, directory)
    cur = con.execute(ORACLE_SQL["op6_exact_dedup"])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(cur.fetchall())
