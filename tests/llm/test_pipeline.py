from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from salarium.llm import decontaminate, mixing, quality, simhash_dedup
from salarium.llm.queries import MIXING_LEVELS, MIXING_WEIGHTS

DIR = "/root/testdata/sf0.001"


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    benchmark = spark.read.parquet(f"{DIR}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5

    good = stages["quality classifier"](spark, docs, DIR)
    bad = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted == 0}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert good.columns == docs.columns and bad and ids(good) == ids(docs) - bad
    assert len(ids(good)) > 0.7 * docs.count()

    single = stages["SimHash near-dedup"](spark, good, DIR)
    groups = {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(good).collect()}
    assert single.columns == docs.columns and ids(single) == set(groups.values()) and len(ids(single)) < len(groups)

    clean = stages["benchmark decontamination"](spark, single, DIR)
    leaks = {r.doc_id for r in decontaminate.contaminated(single, benchmark).collect()}
    assert clean.columns == docs.columns and ids(clean) == ids(single) - leaks

    mixed = stages["mixing sources to target weights"](spark, clean, DIR)
    copies = {r.doc_id: r.copies for r in mixing.mix(clean, MIXING_LEVELS, MIXING_WEIGHTS).collect()}
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == Counter(copies)

    out = stages["token-ID / binary output"](spark, mixed, DIR).collect()
    assert Counter(r.doc_id for r in out) == Counter(copies)
    start = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens


def test_run_applies_the_stages_in_order(spark, monkeypatch):
    add = lambda n: lambda _, docs, sf_dir: docs.withColumn("text", F.concat("text", F.lit(n)))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", add("a")), ("b", add("b")), ("c", add("c"))])
    got = corpus_pipeline.run(spark, DIR).collect()
    assert len(got) == 200 and all(r.text.endswith("abc") for r in got)
