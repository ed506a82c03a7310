import math
import zlib
from collections import Counter

import numpy as np
import pytest

from salarium.llm import quality


def test_lots_and_pieces_do_not_change_features(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [b"", b" ", b"one", "é É, a-b 12 12 12 !! ** same same same".encode()]
    texts += [b" ".join(b"w%d" % x for x in rng.integers(0, 50, int(n))) for n in rng.integers(1, 400, 60)]
    whole = quality.NGrams(18)
    number, owner = whole.features(texts)
    one = [whole.features([t])[0] for t in texts]
    for i, alone in enumerate(one):
        assert sorted(number[owner == i]) == sorted(alone)
    monkeypatch.setattr(quality, "_LOT", 64)
    small = quality.NGrams(18)
    for text, alone in zip(texts, one):
        assert sorted(small.features([text])[0]) == sorted(alone)


def test_words_and_marker():
    grams = quality.NGrams(18)
    h, counts = grams.words([b"ab ab", "ab! é9".encode(), b""])
    assert counts.tolist() == [2, 4, 0]
    assert h[0] == h[1] == h[2] and len(set(h.tolist())) == 4
    a, b = grams.features([b"x x x"])[0], grams.features([b"x x x x"])[0]
    assert len(a) == 5 and len(b) == 7 and set(b) == set(a)  # x, marker, (x, marker), (marker, marker)


def test_held_out_accuracy_and_labels_kept_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    y = {r.doc_id: r.quality for r in labels.collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    unseen = [i for i in y if got[i].held_out]
    good = [got[i].predicted for i in unseen if y[i] == 1]
    bad = [got[i].predicted for i in unseen if y[i] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.35
    # held-out labels change nothing
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    again = {r.doc_id: r.score for r in quality.quality_scores(docs, flipped).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())


def test_nulls_repeats_empties_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 0.5, 1), (None, "", 0.5, 1), (1, "a b " * 100000, 0.5, 1), (1, None, 0.5, 1)], "doc_id long, text string, score double, id long")
    labels = spark.createDataFrame([(1, None), (None, 1), (1, 1), (1, 0)], "doc_id long, quality int")
    got = quality.quality_scores(df, labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    nothing = quality.quality_scores(df, labels.limit(0)).collect()
    assert [r.score for r in nothing] == [0.5] * 4
    assert quality.quality_scores(df.limit(0), labels).count() == 0
    assert quality.keep_good(df, labels.limit(0)).columns == df.columns


@pytest.mark.parametrize("y", [0, 1])
def test_updates_move_towards_the_label(y):
    leader = quality.Leader(10, 1.0, 1.0, 0.0, 0.0)
    for _ in range(20):
        leader.update(np.array([1, 9]), np.array([2.0, 1.0]), y)
    w = leader.weights(slice(None))
    assert (w[1] > 0) == bool(y) and w[1] != 0 and w[2] == 0


def test_model_equals_updates_one_feature_at_a_time(spark):
    rng = np.random.default_rng(9)
    docs = [(i, " ".join(f"w{x}" for x in rng.integers(0, 40, int(n)))) for i, n in enumerate(rng.integers(0, 30, 60))]
    labels = [(i, int(rng.random() < 0.3 + 0.4 * (i % 2))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    alpha, l1, l2, epochs = 0.7, 0.02, 0.3, 2
    model = quality.train(
        df, spark.createDataFrame(labels, "doc_id long, quality int"), hash_bits=12, trainers=1, epochs=epochs, alpha=alpha, l1=l1, l2=l2)

    order = {r[0]: r[1] for r in df.selectExpr("doc_id", "xxhash64(1, doc_id)").collect()}
    grams, z, n = quality.NGrams(12), {}, {}

    def weight(f):
        if abs(z.get(f, 0.0)) <= l1:
            return 0.0
        return (math.copysign(l1, z[f]) - z[f]) / ((1.0 + math.sqrt(n[f])) / alpha + l2)

    learnt = sorted((i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1), key=order.get)
    for _ in range(epochs):
        for i in learnt:
            found = Counter(grams.features([docs[i][1].encode()])[0].tolist())
            x = {f: quality._SCALE * c / sum(found.values()) for f, c in found.items()} | {1 << 12: 1.0}
            w = {f: weight(f) for f in x}
            p = 1 / (1 + math.exp(-sum(w[f] * x[f] for f in x)))
            for f in x:
                g = (p - labels[i][1]) * x[f]
                z[f] = z.get(f, 0.0) + g - (math.sqrt(n.get(f, 0.0) + g * g) - math.sqrt(n.get(f, 0.0))) / alpha * w[f]
                n[f] = n.get(f, 0.0) + g * g
    want = np.array([weight(f) if f in z else 0.0 for f in range((1 << 12) + 1)])
    assert np.count_nonzero(want) > 20 and np.allclose(model.weights, want, rtol=1e-4, atol=1e-6)
