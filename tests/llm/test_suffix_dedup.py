import hashlib
from collections import Counter

import numpy as np
import pytest

from salarium.llm import suffix_dedup


def brute(rows, length=100):
    seen, out = set(), []
    done = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        if (i, raw) not in done:
            gone = np.zeros(len(raw), bool)
            for at in range(len(raw) - length + 1):
                w = raw[at : at + length]
                if w in seen:
                    gone[at : at + length] = True
                seen.add(w)
            spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
            kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
            done[i, raw] = (i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        out.append(done[i, raw])
    return Counter(out)


def corpus(seed=6):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "ñandú", "lorem", "x", "consectetur", "12", "é"]
    prose = lambda n: " ".join(rng.choice(words, int(n)))
    passage, line = prose(60), "a line that comes again and again in many documents, of some hundred and fifty bytes in all, " * 2
    rows = []
    for i in range(70):
        text = prose(rng.integers(0, 300))
        if i % 3 == 0:
            text = prose(20) + passage[: int(rng.integers(90, len(passage)))] + prose(20)
        if i % 5 == 0:
            text += line + prose(9) + line
        if i % 7 == 0 and rows:
            text = rows[int(rng.integers(len(rows)))][1]
        rows.append((int(i * 13 % 71), text))
    rows += [(200, "a" * 500), (201, "ab" * 300), (202, "a" * 99), (203, "a" * 100), (204, None), (205, ""), (206, "z" * 150), (206, "z" * 150), (None, line), (207, "0123456789" * 40)]
    return rows


@pytest.mark.parametrize("piece,hot,parts", [(None, None, 5), (128, 3, 5), (None, 0, 1)])
def test_against_brute_force(spark, monkeypatch, piece, hot, parts):
    if piece:  # texts are hashed in many pieces
        monkeypatch.setattr(suffix_dedup, "_PIECE", piece)
    if hot is not None:  # windows meet by their own hash
        monkeypatch.setattr(suffix_dedup, "_HOT_RUNS", hot)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, key string").repartition(parts)
    got = Counter(map(tuple, suffix_dedup.repeats(df).collect()))
    assert got == brute(rows)


def test_short_windows_and_empty_table(spark):
    rows = [(i, t) for i, t in enumerate(["abcabcabcabc", "xabcabcx", "abcabc", "", "cabcab"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, suffix_dedup.repeats(df, length=6, kmer=2).collect())) == brute(rows, 6)
    assert suffix_dedup.repeats(df.limit(0)).count() == 0


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert Counter(map(tuple, suffix_dedup.repeats(docs).collect())) == brute([tuple(r) for r in docs.collect()])


def test_keys_larger_than_a_table(spark, monkeypatch):
    whole = suffix_dedup._groups
    monkeypatch.setattr(suffix_dedup, "_groups", lambda batches, key, most: whole((b.slice(i, 7) for b in batches for i in range(0, b.num_rows, 7)), key, min(most, 20) if most > 20_000 else most))
    rows = corpus(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, suffix_dedup.repeats(df).collect())) == brute(rows)


def swapped_halves(n):
    """A text of ``n`` letters and the text with its letters exchanged, in which every half
    exchanges those of the half before: polynomials modulo powers of two take them for equal."""
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("length", [40, 100, 1024])
def test_texts_that_collide_modulo_powers_of_two(spark, length):
    a, b = swapped_halves(1024)
    rng = np.random.default_rng(length)
    noise = lambda n: "".join(rng.choice(list("cdefgh"), n))
    rows = [(1, noise(300) + a + noise(300)), (2, noise(200) + b + noise(350)), (3, noise(50) + a + noise(10)), (4, noise(1500)), (5, b + a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, suffix_dedup.repeats(df, length=length).collect())) == brute(rows, length)


def test_hash_of_a_part_is_the_polynomial_of_its_bytes():
    find = suffix_dedup.Windows(100, 32)
    raw = bytes(np.random.default_rng(2).integers(0, 256, 5000, np.uint8))
    for which in (0, 1):
        of = find._hasher(raw + raw, which)
        at = np.arange(len(raw) - 170)
        first, again = of(at, at + 170), of(at + len(raw), at + len(raw) + 170)
        assert (first == again).all() and len(set(first.tolist())) == len(at)


def test_too_long_windows_are_refused():
    with pytest.raises(ValueError):
        suffix_dedup.Windows(1 << 23, 32)
