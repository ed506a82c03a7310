from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from salarium.llm import mixing

LEVELS = {"domain": "domain", "lang": "lang", "source": "source"}


def brute_share(budget, weights, supply):
    """Fill in small equal steps of level, by bisection on the level."""
    lo, hi = 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(s, mid * w) for w, s in zip(weights, supply)) < budget else (lo, mid)
    return [min(s, hi * w) for w, s in zip(weights, supply)]


@pytest.mark.parametrize("seed", range(5))
def test_share_against_bisection(seed):
    rng = np.random.default_rng(seed)
    w, s = rng.uniform(0.1, 3, 12), rng.pareto(1, 12) * 100
    for budget in (0.0, 10.0, 0.5 * s.sum(), 0.99 * s.sum(), 2 * s.sum()):
        assert np.allclose(mixing.share(budget, w, s), brute_share(min(budget, s.sum()), w, s), rtol=1e-6, atol=1e-6)


def test_zero_weight_gets_only_what_is_left():
    got = mixing.share(100.0, np.array([1.0, 0.0, 0.0]), np.array([40.0, 30.0, 90.0]))
    assert np.allclose(got, [40, 15, 45])


def tree_budgets(leaves, weights, budget, epochs):
    """Recursive budgets: {leaf: budget}"""
    def go(prefix, got, depth):
        if depth == 3:
            return {prefix: got}
        supply = defaultdict(float)
        for leaf, tokens in leaves.items():
            if leaf[:depth] == prefix:
                supply[leaf[depth]] += tokens * epochs
        keys = sorted(supply, key=repr)
        given = weights.get(list(LEVELS)[depth], {})
        parts = mixing.share(got, np.array([given.get(k, 1.0) for k in keys]), np.array([supply[k] for k in keys]))
        out = {}
        for k, p in zip(keys, parts):
            out |= go((*prefix, k), p, depth + 1)
        return out
    return go((), budget, 0)


def make(spark, n=1500):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, "word " * (i % 23), f"d{i % 2}", [None, "en", "fr"][i % 3 if i % 5 else 0], source, "x"))
    rows += [(None, "a b c", "d0", "en", None, "x"), (5, "again here", "d1", "fr", "s1", "x"), (5, "again here", "d1", "fr", "s1", "x"), (9001, None, "d9", "zz", "void", "x"), (9002, "tiny", "d8", "en", "t", "x")]
    return rows, spark.createDataFrame(rows, "id2 long, text string, domain string, lang string, source string, rest string").withColumnRenamed("id2", "doc_id").repartition(5)


@pytest.mark.parametrize("share,epochs", [(1.0, 4), (0.2, 2), (5.0, 3)])
def test_leaves_meet_their_budgets(spark, share, epochs):
    rows, df = make(spark)
    weights = {"domain": {"d0": 3.0}, "source": {"hot": 0.2}, "lang": {"fr": 2.0}}
    got = mixing.mix(df, LEVELS, weights, budget_share=share, max_epochs=epochs).collect()
    tokens = Counter()
    for r in rows:
        tokens[r[2:5]] += len((r[1] or "").split())
    want = tree_budgets(tokens, weights, sum(tokens.values()) * share, epochs)
    taken, copies = Counter(), defaultdict(Counter)
    for r in got:
        leaf = tuple(r.leaf)
        taken[leaf] += r.n_tokens * r.copies
        copies[leaf][r.copies] += 1
        assert 0 < r.copies <= epochs
    for leaf, budget in want.items():
        assert budget - 1e-6 <= taken[leaf] < budget + 46 or (budget == 0 and taken[leaf] == 0)
        if tokens[leaf]:
            whole = int(budget / tokens[leaf] + 1e-9)
            assert set(copies[leaf]) <= {whole, whole + 1}
    again = mixing.mix(df.repartition(3), LEVELS, weights, budget_share=share, max_epochs=epochs).collect()
    assert Counter(map(repr, again)) == Counter(map(repr, got))


@pytest.mark.parametrize("share,bits", [(0.3, 12), (1.7, 2), (0.9, 4)])
def test_what_is_taken_is_a_prefix_of_the_seeded_order(spark, monkeypatch, share, bits):
    monkeypatch.setattr(mixing, "_PART_BITS", bits)
    rows, _ = make(spark)
    rows += [(None, "equal in id and text", "d0", "en", "hot", "x")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string, rest string").repartition(4)
    weights, epochs, seed = {"domain": {"d0": 2.0}, "lang": {None: 0.5}}, 3, 5
    tokens = Counter()
    for r in rows:
        tokens[r[2:5]] += len((r[1] or "").split())
    want = Counter()
    budget = {k: b for k, b in tree_budgets(tokens, weights, sum(tokens.values()) * share, epochs).items() if tokens[k]}
    whole = {k: min(epochs, int(b // tokens[k])) for k, b in budget.items()}
    order = df.select("*", *[F.xxhash64(F.lit(seed), F.lit(e), "doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).alias(f"o{e}") for e in range(epochs + 1)])
    leaves = defaultdict(list)
    for r in order.collect():
        leaf = (r.domain, r.lang, r.source)
        if leaf in whole:
            leaves[leaf].append((r[f"o{whole[leaf]}"] % (1 << 64), r.doc_id, len((r.text or "").split())))
    for leaf, docs in leaves.items():
        rest = budget[leaf] - whole[leaf] * tokens[leaf] if whole[leaf] < epochs else 0.0
        for place, i, n in docs:
            copies = whole[leaf] + (sum(m for p, _, m in docs if p < place) < rest)
            if copies:
                want[i, leaf, n, copies] += 1
    got = mixing.mix(df, LEVELS, weights, budget_share=share, max_epochs=epochs, seed=seed).collect()
    assert Counter((r.doc_id, tuple(r.leaf), r.n_tokens, r.copies) for r in got) == want


def test_documents_come_as_often_as_taken(spark):
    rows, df = make(spark, 200)
    got = mixing.mixed_documents(df, LEVELS, {}, budget_share=2.0)
    assert got.columns == df.columns
    want = Counter()
    for r in mixing.mix(df, LEVELS, {}, budget_share=2.0).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in got.collect()) == want


def test_extra_columns_named_like_its_own(spark):
    rows, df = make(spark, 60)
    names = ["leaf_key", "order", "end", "end_key", "before", "bin", "level_0", "copies", "row_key", "n_tokens"]
    clashing = df.select("*", *[F.lit(1).alias(n) for n in names])
    key = lambda r: repr((r.doc_id, r.leaf, r.n_tokens, r.copies))
    want = Counter(map(key, mixing.mix(df, LEVELS, {}, budget_share=0.5).collect()))
    assert Counter(map(key, mixing.mix(clashing, LEVELS, {}, budget_share=0.5).collect())) == want
    assert mixing.mixed_documents(clashing, LEVELS, {}, budget_share=0.5).columns == clashing.columns


def test_empty_table(spark):
    _, df = make(spark, 1)
    assert mixing.mix(df.limit(0), LEVELS, {}).count() == 0


def test_word_tokens(spark):
    df = spark.createDataFrame([("a b\tc\x0bd\n",), ("",), (" \r\n",), ("é\xa0è x",)], "t string")
    assert [r[0] for r in df.select(mixing.word_tokens(F.col("t"))).collect()] == [4, 0, 0, 2]
