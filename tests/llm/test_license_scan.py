import re

from salarium.llm import license_scan

DIR = "/root/testdata/sf0.01"
NOTICE = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
}


def test_finds_the_notices_and_nothing_else(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    extra = [
        (90001, None), (90002, ""), (90003, "x\n\nRELEASED under the mit license\ny"), (90004, "the MIT campus was released from a license"),
        (90005, "word " * 30000 + "licensed under the apache license version 2 0 " + "word " * 100), (90006, "Licensed under CC BY 4.0."), (None, "Licensed under CC BY-NC 4.0.")]
    both = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).selectExpr("*", "1 AS family", "text AS words", "'x' AS id")
    got = license_scan.scan(both).collect()
    found = {(r.doc_id, r.paragraph): r.family for r in got}
    want = {}
    for r in docs.collect():
        for i, line in enumerate(r.text.split("\n")):
            for notice, family in NOTICE.items():
                if re.search(re.escape(notice), line, re.I):
                    want[r.doc_id, i] = family
    want |= {(90003, 2): "mit", (90005, 0): "apache-2.0", (90006, 0): "cc-by-4.0", (None, 0): "cc-by-nc-4.0"}
    assert len(want) > 15 and found == want
    assert all(0.5 <= r.probability <= 1 and 0.8 <= r.similarity <= 1 for r in got)
    plan = license_scan.paragraphs(both, "text", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_table(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
