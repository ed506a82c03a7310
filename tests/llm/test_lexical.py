import math
import random
import re
from collections import Counter

from salarium.llm import lexical
from salarium.llm.tables import LOWER, UPPER

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans(UPPER, LOWER)


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for (i, c), n in zip(counted, sizes):
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 90 + (90 * n * n_docs) // n_terms
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if none else i, -s))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "日本", "x" * 400]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 120])))) for i in range(500)]
    docs += [(1000 + i, "w1 w2, w3-W4 w299") for i in range(30)]  # ties
    docs += [(2000, None), (2001, ""), (2002, "?! --"), (None, "w298 w297 w299"), (7, "w5"), (2003, "w0 " * 60000)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(25)]
    items += [(100, "w299, W299!"), (101, None), (102, ""), (103, "unseen words"), (104, "w0"), (104, "w1"), (None, "été w9"), (105, "w1 w2 w3 w4 w299")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    got = lexical.search(*frames(spark, docs, items), block_docs=64)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_item_groups_blocks_by_postings_and_names(spark):
    docs, items = corpus()
    d, i = frames(spark, docs, items)
    d = d.selectExpr("*", "'x' AS id", "1 AS block", "2 AS term", "'y' AS item_id", "3 AS `a.b`")
    i = i.selectExpr("*", "1 AS item", "2 AS rank", "3 AS score", "4 AS doc_id")
    got = lexical.search(d, i, k=3, item_bytes=700, block_postings=200)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus()
    d, i = frames(spark, docs[:5], items[:2])
    assert lexical.search(d.limit(0), i).count() == 0
    assert lexical.search(d, i.limit(0)).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    from salarium.llm.queries import ORACLE_SQL, QUERIES

    directory = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    got = QUERIES["op12_lexical_search"](spark, directory)
    cur = con.execute(ORACLE_SQL["op12_lexical_search"])
    assert [d[0] for d in cur.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())
