"""Reloads and review runs that end between their steps."""

import os

import pytest
from pyspark.sql import functions as F

from salarium import __main__ as cli
from salarium.operators import anomaly, audit
from salarium.sources import files


def test_a_reload_that_ends_between_its_steps_leaves_the_old_state(spark, tmp_dir, monkeypatch):
    target = os.path.join(tmp_dir, "t")
    files.full_reload(spark.range(5), target)
    real = files._folder

    class Broken:
        def __init__(self, fs):
            self.fs, self.renames = fs, 0

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.renames += 1
            if self.renames == 2:
                raise RuntimeError("lost")
            return self.fs.rename(a, b)

    broken = Broken(real(spark, target)[1])
    monkeypatch.setattr(files, "_folder", lambda s, p: (real(s, p)[0], broken))
    with pytest.raises(RuntimeError):
        files.full_reload(spark.range(9), target)
    monkeypatch.undo()
    assert not os.path.exists(target) and files.read_reloaded(spark, target).count() == 5
    files.full_reload(spark.range(7), target)
    assert files.read_reloaded(spark, target).count() == spark.read.parquet(target).count() == 7


def test_reload_guard_from_the_session(spark, tmp_dir):
    spark.conf.set(files.RELOAD_GUARD, f"/nowhere, {tmp_dir}/ok")
    try:
        files.full_reload(spark.range(1), os.path.join(tmp_dir, "ok", "t"))
        with pytest.raises(PermissionError):
            files.full_reload(spark.range(1), os.path.join(tmp_dir, "other"))
    finally:
        spark.conf.unset(files.RELOAD_GUARD)


def _fact(spark):
    return spark.range(1, 41).select(
        F.col("id").alias("pk"), F.concat(F.lit("p"), F.col("id")).alias("person_id"), F.lit("c").alias("company_id"),
        F.when(F.col("id") % 4 == 0, 5_000_000).otherwise(100).cast("long").alias("total_plata"),
        F.lit(1).cast("long").alias("suma_clean"), F.lit(2).cast("long").alias("variabila_clean"), F.lit(2025).alias("an_raportare"))


def test_a_rerun_after_the_candidates_adds_only_the_reviews(spark, tmp_dir, monkeypatch):
    flagged = anomaly.review_queue(_fact(spark), None, None, 3.0)
    cands, revs = os.path.join(tmp_dir, "c"), os.path.join(tmp_dir, "r")
    audit.review_run(flagged, "run1", "t", cands, revs)
    real = audit.append

    def once(df, path):
        if path == revs:
            raise RuntimeError("lost")
        real(df, path)

    monkeypatch.setattr(audit, "append", once)
    with pytest.raises(RuntimeError):
        audit.review_run(flagged, "run2", "t", cands, revs)
    monkeypatch.undo()
    assert spark.read.parquet(cands).count() == 20 and spark.read.parquet(revs).count() == 10
    audit.review_run(flagged, "run2", "t", cands, revs)
    c, r = spark.read.parquet(cands), spark.read.parquet(revs)
    assert sorted(x.candidate_id for x in c.collect()) == list(range(1, 21))
    assert sorted((x.review_id, x.candidate_id) for x in r.collect()) == [(i, i) for i in range(1, 21)]
    audit.review_run(flagged, "run2", "t", cands, revs)  # finished: a further run of that name has ids of its own
    assert spark.read.parquet(cands).count() == spark.read.parquet(revs).count() == 30


def test_review_of_a_stored_fact_from_the_command_line(spark, tmp_dir):
    fact, out = os.path.join(tmp_dir, "fact"), os.path.join(tmp_dir, "out")
    _fact(spark).write.parquet(fact)
    assert cli.main(["review", fact, out, "--limit", "0", "--write-audit", "--run-id", "x"]) == {"flagged": 10}
    assert spark.read.parquet(os.path.join(out, "audit", "reviews")).count() == 10
