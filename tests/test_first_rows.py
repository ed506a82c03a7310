from pyspark.sql import functions as F

from salarium.operators.anomaly import peer_statistics
from salarium.plans.sequence import first_rows


def test_large_slices_are_exact_and_not_in_one_partition(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("pk"), F.when(F.col("id") % 3 > 0, F.col("id") % 3 + 2020).cast("int").alias("year"))
    order = [F.col("year").desc_nulls_first(), F.col("pk")]
    top, many = first_rows(df, order, 9000), first_rows(df, order, 9000, max_top_rows=10)
    assert sorted(many.collect(), key=str) == sorted(top.collect(), key=str)
    assert "SinglePartition" not in many._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert first_rows(df, order, 50000, max_top_rows=10).count() == 20000


def test_peer_statistics_have_no_window(spark):
    rows = [(2020 + i % 2, f"c{i % 5}" if i % 11 else None, float(i * i % 97)) for i in range(300)] + [(None, "c1", 5.0)]
    sl = spark.createDataFrame(rows, "year int, company_id string, total_ron double")
    _, by_year, _ = peer_statistics(sl)
    assert "Window" not in by_year._jdf.queryExecution().optimizedPlan().toString()
    want = {r.year: (r.m, r.s) for r in sl.where("year is not null").groupBy("year").agg(F.avg("total_ron").alias("m"), F.stddev_samp("total_ron").alias("s")).collect()}
    for r in by_year.collect():
        assert abs(r.mean_y - want[r.year][0]) < 1e-9 and abs(r.std_y - want[r.year][1]) < 1e-9
