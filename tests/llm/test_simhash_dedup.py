import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from salarium.llm import simhash_dedup
from salarium.llm.components import components
from salarium.llm.tables import LOWER, UPPER


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, radius=4):
    """{fp: smallest fp index reachable}"""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def expected(rows, radius=4):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    fps = [brute_fingerprint(t) for _, t in rows]
    known = [i for i, r in enumerate(rows) if r[0] is not None]
    roots = brute_roots([fps[i] for i in known], radius)
    component = {i: rows[known[r]][0] for i, r in zip(known, roots)}
    return Counter((rows[i][0], f"{fps[i]:016x}", component.get(i)) for i in range(len(rows)))


def test_fingerprints_and_components(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = rng.choice(vocabulary, 300).tolist()
        rows.append((i * 10, " ".join(words)))
        for j in range(int(rng.integers(0, 4))):
            changed = list(words)
            for _ in range(j):
                changed[int(rng.integers(300))] = "CHANGED"
            rows.append((i * 10 + j + 1, "\t".join(changed).upper() if j == 2 else "  ".join(changed)))
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one two"), (1004, "É é\xa0É x y z"), (None, rows[0][1]), (7, "two texts here now"), (7, "of one id which differ"), (1005, "long " * 70000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp long, id string").repartition(5)
    got = Counter(map(tuple, simhash_dedup.near_duplicates(df).collect()))
    assert got == expected(rows)
    assert max(Counter(c for _, _, c in got).values()) > 2


def test_lanes_do_not_overflow():
    rng = np.random.default_rng(2)
    counts = np.array([70_000, 0, 3, 140_001, 1])
    hashes = rng.integers(0, 1 << 63, counts.sum(), dtype=np.uint64) | (np.uint64(1) << np.uint64(63))
    got = simhash_dedup.majority_bits(hashes, counts)
    at = 0
    for n, fp in zip(counts, got):
        part = hashes[at : at + n]
        at += n
        want = sum(1 << b for b in range(64) if 2 * int(((part >> np.uint64(b)) & np.uint64(1)).sum()) > n)
        assert int(fp) == want


@pytest.mark.parametrize("most", [None, 3000])
def test_links_find_every_pair_within_the_radius(spark, monkeypatch, most):
    if most:  # slices are dealt again, down to single variants
        monkeypatch.setattr(simhash_dedup, "_MOST_VARIANTS", most)
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(40):
        centre = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(2))
        for _ in range(12):
            flips = sum(1 << int(b) for b in set(rng.integers(0, 64, int(rng.integers(0, 7)))))
            fps.add(centre ^ flips)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame(list(enumerate(signed)), "id long, fp long")
    roots = {r.node.id: r.root.id for r in components(simhash_dedup.links(nodes, 4)).collect()}
    assert [roots.get(i, i) for i in range(len(fps))] == brute_roots(fps)


def test_components_of_a_chain_and_a_hub(spark):
    pairs = [(i, i + 1) for i in range(70)] + [(200, 200 + i) for i in range(300)] + [(5, 5), (900, 901), (901, 900)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 71)} | {200 + i: 200 for i in range(1, 300)} | {901: 900}
    assert got == want


def test_empty_table_and_drop(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_dedup.near_duplicates(empty).count() == 0
    df = spark.createDataFrame([(3, "a b c d e"), (2, "A b c d e"), (9, "other words are in this text")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash_dedup.drop_near_duplicates(df).collect()) == [2, 9]
    with pytest.raises(ValueError):
        simhash_dedup.links(empty, 3)
