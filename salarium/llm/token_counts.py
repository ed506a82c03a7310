"""Token counts by the whole-token shortcut.

For a tokenizer that drops white space and marks word ends, most words of a text are one
token. Which vocabulary strings encode alone as exactly one token is proved beforehand, by
encoding each of them with the library; a pre-token that equals such a string counts as one
without being merged. All other pre-tokens go through the library's merge table, and counts
are kept per run of non-space characters in a bounded cache.

Texts are cut at ASCII white space only, where neither the normaliser nor the pre-tokenizer
can join anything. Runs that are all ASCII share one cache entry whatever their case; other
runs keep it. A text that holds a special string of the tokenizer goes to the library
whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salarium.llm.tables import column, configure, per_process, text_of


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WholeTokenCounter:
    """Counts the tokens of UTF-8 texts as the tokenizers library does for ``path``."""

    def __init__(self, path: str, cache_entries: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        self.cache_entries = cache_entries
        self.end = t.model.end_of_word_suffix
        probe = [p for p, _ in t.pre_tokenizer.pre_tokenize_str(self._normal("ab \n cd"))]
        if not self.end or probe != ["ab", "cd"]:
            raise ValueError("the whole-token shortcut needs a tokenizer with word ends that drops white space")
        self.folds = self._normal("AZ") == "az"
        self.specials = [x.content.encode() for x in t.get_added_tokens_decoder().values()]
        self.whole = self._prove()  # pre-tokens, in byte letters, that are one token
        letter_bytes = {c: b for b, c in _byte_letters().items()}
        self.known = {bytes(letter_bytes[c] for c in w): 1 for w in self.whole}
        self.counts = dict(self.known)

    def _normal(self, s: str) -> str:
        n = self.tokenizer.normalizer
        return n.normalize_str(s) if n else s

    def _pieces(self, s: str) -> list[str]:
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self._normal(s))]

    def _prove(self) -> set[str]:
        letter_bytes = {c: b for b, c in _byte_letters().items()}
        words = []
        for token in self.tokenizer.get_vocab():
            if token.endswith(self.end) and all(c in letter_bytes for c in token.removesuffix(self.end)):
                try:
                    words.append(bytes(letter_bytes[c] for c in token.removesuffix(self.end)).decode())
                except UnicodeDecodeError:
                    pass  # part of a character: no text is this pre-token
        words = [w for w in words if w and not any(x.decode() in w for x in self.specials)]
        encoded = self.tokenizer.encode_batch(words, add_special_tokens=False)
        proved = set()
        for w, e in zip(words, encoded):
            if len(e.ids) == 1 and self._normal(w) == w and len(pieces := self._pieces(w)) == 1:
                proved.add(pieces[0])
        return proved

    def _count_run(self, run: bytes) -> int:
        whole, merge = self.whole, self.tokenizer.model.tokenize
        return sum(1 if p in whole else len(merge(p)) for p in self._pieces(run.decode(errors="replace")))

    def count(self, raw: bytes) -> int:
        if any(x in raw for x in self.specials):
            return len(self.tokenizer.encode(raw.decode(errors="replace"), add_special_tokens=False).ids)
        runs = raw.split()
        if self.folds:
            # ASCII only: the normaliser composes before it folds, so case decides what a mark joins
            folded = raw.lower().split()
            runs = folded if raw.isascii() else [f if f.isascii() else r for f, r in zip(folded, runs)]
        counts = self.counts
        try:
            return sum(map(counts.__getitem__, runs))
        except KeyError:
            pass
        if len(counts) > self.cache_entries:
            counts = self.counts = dict(self.known)
        total = 0
        for run in runs:
            n = counts.get(run)
            if n is None:
                n = self._count_run(run)
                if len(counts) <= 2 * self.cache_entries and len(run) <= 256:
                    counts[run] = n
            total += n
        return total


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit``).

    ``vocabulary`` is the path of a tokenizers file that every executor has. No special
    tokens are added, special strings inside texts count as the library's default does, and
    nothing is cut or padded. A null text is the empty text, with no tokens. Null ids and
    repeated rows are rows like any other; other columns are not read; an empty table gives
    an empty result.
    """
    configure(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_process(f"whole-token {vocabulary}", lambda: WholeTokenCounter(vocabulary))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            sizes, counts = [], []
            for value in texts:
                raw = value.as_py()
                sizes.append(len(raw))
                counts.append(counter.count(raw))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    read = docs.select(column(docs, id_col).alias("id"), text_of(docs, text_col).alias("text"))
    schema = T.StructType([
        T.StructField("id", read.schema["id"].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ])
    counted = read.mapInArrow(run, schema)
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
