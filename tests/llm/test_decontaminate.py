import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salarium.llm import decontaminate


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def weighted(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows, items, threshold=0.8, k=5):
    """{(id, item): best similarity} over every item-sized window of every document."""
    out = {}
    for i, text in rows:
        w = words(text)
        for item, item_text in items:
            q = words(item_text)
            if not q:
                continue
            size = min(k, len(q))
            grams = lambda x: [tuple(x[j : j + size]) for j in range(len(x) - size + 1)]  # noqa: E731, B023
            starts = range(max(1, len(w) - len(q) + 1))
            best = max(weighted(grams(w[s : s + len(q)]), grams(q)) for s in starts)
            if best >= threshold:
                out[i, item] = max(best, out.get((i, item), 0))
    return out


@pytest.fixture(scope="module")
def case():
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(300)]
    prose = lambda n: rng.choice(vocabulary, n).tolist()
    items = [(i, " ".join(prose(int(n)))) for i, n in enumerate(rng.integers(12, 90, 25))]
    items += [(100, "short four word item"), (101, ""), (102, None), (103, "... !!"), (104, "one two three four five")]
    rows = [(i, " ".join(prose(int(n)))) for i, n in enumerate(rng.integers(0, 300, 80))]
    for j, (item, text) in enumerate(items[:25]):
        q = text.split()
        rows.append((1000 + j, " ".join(prose(40) + q + prose(40))))
        rows.append((2000 + j, " ".join(x.upper() + ("," if x.endswith("3") else "") for x in q)))
        cut = int(rng.integers(0, len(q)))
        rows.append((3000 + j, " ".join(prose(30) + q[:cut] + ["other"] + q[cut + 1 :] + prose(5))))
        rows.append((4000 + j, " ".join(prose(9) + q[: int(len(q) * 0.9)])))
        rows.append((5000 + j, " ".join(q[: len(q) // 2] + prose(60) + q[len(q) // 2 :])))
        rows.append((6000 + j, " ".join(q[3:] + q[:3])))
    rows += [(7000, None), (7001, ""), (7002, "a short four word item here"), (7003, "short four word things"), (7004, "One, two; THREE four\nfive"), (7005, "ONE TWO")]
    return rows, items


def frames(spark, case):
    rows, items = case
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, item long, words string").repartition(4)
    return docs, spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, k int")


@pytest.mark.parametrize("blocks", [{}, {"block_items": 7}])
def test_against_all_windows(spark, case, blocks):
    docs, items = frames(spark, case)
    got = decontaminate.contaminated(docs, items, **blocks)
    assert got.columns == ["doc_id", "item_id", "window_start", "similarity", "distance"]
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    want = brute(*case)
    assert found.keys() == want.keys() and len(want) > 70
    assert all(abs(found[k] - want[k]) < 1e-12 for k in want)


def test_drop_nulls_and_empty_tables(spark, case):
    docs, items = frames(spark, case)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in case[0]} - {i for i, _ in brute(*case)}
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, case[1][0][1]), (4, case[1][0][1]), (4, case[1][0][1])], "doc_id long, text string")
    assert sorted(((r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, items).collect()), key=repr) == [(4, 0), (None, 0)]


def test_simhash_against_bit_counts(spark):
    df = spark.createDataFrame([([1, -5, 77, 2**62],), ([-1],), ([3, 3, 3, -9],)], "h array<bigint>")
    for r in decontaminate.with_simhash(df, "h", "fp").collect():
        want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in r.h) > len(r.h))
        assert r.fp % (1 << 64) == want


def test_native_plan(spark, case):
    docs, items = frames(spark, case)
    plan = decontaminate.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
    assert docs.select(F.size(decontaminate.words_of(F.lit("  a,b  ")))).first()[0] == 2


def test_texts_are_read_once_for_each_shingle_length(spark, case, monkeypatch):
    docs, items = frames(spark, case)
    names = []
    store = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: (names.append(name), store(df, name))[1])
    got = decontaminate.contaminated(docs, items, block_shingles=100)  # some fifteen lots
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(*case).keys()
    lengths = len({min(5, len(words(t))) for _, t in case[1]} - {0})
    assert names.count("document-shingles") <= lengths and names.count("windows") == lengths


def test_items_of_one_length_that_share_phrases(spark):
    rng = np.random.default_rng(3)
    phrase = "which of the following is true of".split()
    prose = lambda n: [f"v{x}" for x in rng.integers(0, 500, n)]
    items = [(i, " ".join(phrase + prose(24))) for i in range(40)] + [(40, " ".join(prose(30)))]
    items += [(0, items[0][1])]  # a repeated row
    rows = [(i, " ".join(prose(20) + text.split()[: 30 - i % 4] + prose(20))) for i, (_, text) in enumerate(items)]
    rows += [(100 + i, " ".join(prose(15) + phrase + prose(40))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    want = brute(rows, items)
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-12 for k in want)
    assert got.count() == len(found)
