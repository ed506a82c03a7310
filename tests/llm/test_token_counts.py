import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salarium.llm.token_counts import WholeTokenCounter, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "Hello, WORLD! it's 2024's 'tis they'll", "a\tb\nc\x0bd\x0ce\r\nf", "x\x1cy\x1fz \x85 \xa0 w v",
    "Él ñandú É É ́alone Å İstanbul ΣΑΣ ς ﬁ", "<|endoftext|>", "one <|startoftext|>two<|ENDOFTEXT|> three",
    "<|endoftext|", "日本語テキスト 混合 text", "emoji 👩‍👩‍👧 ok!!! ###$$$ %%%", "'s 't '' '''s !'s a'S", "word" * 5000, "a" * 300 + " " + "b c " * 1000,
    "\0null\0", "naïve café 12345 ¼ ² Ⅷ", "﻿bom", "don't DON'T",
]


def library(texts):
    t = Tokenizer.from_file(WORDS)
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_equal_to_the_library():
    counter = WholeTokenCounter(WORDS, cache_entries=5)
    assert len(counter.whole) > 20_000
    for _ in range(2):
        assert [counter.count(t.encode()) for t in TEXTS] == library(TEXTS)


def test_capitals_whose_mark_composes_only_in_lower_case():
    texts = ["J\u030cayhun", "H\u0331afs H\u0331", "T\u0308aha", "W\u030aarda Y\u030aarda", "aJ\u030cB j\u030cayhun J\u030cAYHUN", "E\u0301COLE \xc9cole A\u030angstr\xf6m"]
    counter = WholeTokenCounter(WORDS)
    for _ in range(2):
        assert [counter.count(t.encode()) for t in texts] == library(texts)


def test_documents_equal_to_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, WORDS).collect()}
    rows = docs.collect()
    for r, n in zip(rows, library([r.text for r in rows])):
        assert got[r.doc_id] == (len(r.text.encode()), n, n > 2048)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, 5, 6), (None, "a b", 5, 6), (1, "a", 5, 6), (1, "a", 5, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes long, id long")
    got = [tuple(r) for r in token_counts(df, WORDS, limit=1).collect()]
    assert got == [(1, 0, 0, False), (None, 3, 2, True), (1, 1, 1, False), (1, 1, 1, False)]
    assert token_counts(df.limit(0), WORDS).count() == 0


def test_refuses_tokenizers_that_keep_white_space():
    with pytest.raises(ValueError):
        WholeTokenCounter(public_tokenizers.path("byte_bpe_50k.json"))
