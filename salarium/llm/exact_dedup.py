"""Exact duplicates by a tree-merge of digest runs (DataFrame operations only).

Every document becomes one entry ``(digest, length, second hash, id)``; the entries of one
rank form a run. Runs are merged in binomial rounds: in each round the ranks of a group
exchange entries so that the next bits of the rank become bits of the digest, and each rank
merges what it gets, keeping the smallest (or largest) identifier and the copy count of
each verified digest. After the last round a rank holds one digest range, fully merged.

A merge is one streaming pass: the entries are dealt in order of ``(rank, key)``, so a
rank's run lies in as many consecutive tasks as there is work, each task's part is sorted,
and neighbours with the same key become one entry. No hash table is kept, and sorting
spills where a part does not fit.

The kept identifiers travel the same tree downwards, level by level. A digest has at most
``2**bits_per_round`` entries per rank and round in either direction, and the documents of
one digest are spread over all first ranks, so a group holding a third of all rows never
meets in one task.

A digest is verified by carrying SHA-256, byte length and an independent 64-bit hash of the
text through every merge as one key: entries that agree in SHA-256 but differ in either
check stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salarium.llm.tables import LOWER, UPPER, column, keyed, rows_of, stored, text_of

_KEY = ("digest", "length", "check")


def normalised(text: Column) -> Column:
    """Lower-case A-Z only; every other character keeps its case."""
    return F.translate(text, UPPER, LOWER)


def _digest_bits(rank_bits: int) -> Column:
    """The leading ``rank_bits`` bits of the digest."""
    return F.shiftright(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint"), 32 - rank_bits).cast("int")


def _rank_after(bits_done: int, rank_bits: int) -> Column:
    """The rank once the leading ``bits_done`` bits are digest bits; the rest stays as in ``rank``."""
    low = rank_bits - bits_done
    return F.shiftleft(F.shiftright(_digest_bits(rank_bits), low), low).bitwiseOR(
        F.col("rank").bitwiseAND(F.lit((1 << low) - 1)))


def merged_runs(runs: DataFrame, done: int, rank_bits: int, keep: str) -> DataFrame:
    """The runs ``(rank, key, best, n)`` after the round that brings ``done`` bits of the digest into the rank.

    ``best`` is a struct (null without an id): its minimum has no fixed width, so Spark merges
    neighbours of the sorted input instead of hashing the keys.
    """
    best = F.min if keep == "smallest" else F.max
    return (
        runs.withColumn("rank", _rank_after(done, rank_bits))
        .repartitionByRange("rank", *_KEY)
        .sortWithinPartitions("rank", *_KEY)
        .groupBy("rank", *_KEY)
        .agg(best("best").alias("best"), F.sum("n").alias("n"))
    )


def exact_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    keep: str = "smallest",
    rank_bits: int = 6,
    bits_per_round: int = 3,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Two texts are equal when they are identical after lower-casing A-Z. ``keep`` names the
    identifier that stays, "smallest" or "largest". ``2**rank_bits`` runs are merged in
    ``rank_bits / bits_per_round`` rounds.

    Null and empty texts are equal to each other. A null id counts in ``group_size`` and is
    kept only if no row of its group has an id (``keep_id`` is null then). Rows that repeat
    an id and text each come back with the same verdict and each count. Other columns, of
    whatever name, are not read. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    text = normalised(text_of(docs, text_col))
    read = docs.select(column(docs, id_col).alias("id"), text.alias("norm"))
    entries = stored(
        read.select(
            "id",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.octet_length("norm").alias("length"),
            F.xxhash64("norm").alias("check"),
            F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(1 << rank_bits)).cast("int").alias("rank"),
        ),
        "dedup-entries",
    )

    # up: each level's runs, stored because the way down reads them again; the first
    # level merges the copies inside each input split before anything is exchanged
    best = F.min if keep == "smallest" else F.max
    own = F.when(F.col("id").isNotNull(), F.struct("id"))
    first = entries.groupBy("rank", *_KEY).agg(best(own).alias("best"), F.count(F.lit(1)).alias("n"))
    levels = [stored(first, "dedup-run")]
    done_at = [*range(0, rank_bits, bits_per_round), rank_bits]
    for done in done_at[1:]:
        levels.append(stored(merged_runs(levels[-1], done, rank_bits, keep), "dedup-run"))

    # down: a run's entries take the verdict of the entry they were merged into
    verdict = levels[-1].select("rank", *_KEY, F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"))
    for i in range(len(levels) - 2, -1, -1):
        run = levels[i].select(
            F.col("rank").alias("own_rank"), *_KEY, _rank_after(done_at[i + 1], rank_bits).alias("rank"))
        verdict = run.join(verdict, ["rank", *_KEY]).select(
            F.col("own_rank").alias("rank"), *_KEY, "keep_id", "group_size")
    out = entries.join(verdict, ["rank", *_KEY])
    return out.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the smallest or largest id.

    A row is known by a key of its own: rows that repeat an id are judged by their own text,
    and of rows with equal id and text one stays. A null id stays only where no row of the
    group has an id. All columns are kept, whatever their names.
    """
    whole, slim = keyed(docs, id_col, text_col)
    has_id = F.col("id").isNull() if keep == "smallest" else F.col("id").isNotNull()
    named = slim.select(F.struct(has_id.alias("first"), F.col("id").alias("second"), F.col("key").alias("third")).alias("id"), "text")
    dropped = exact_duplicates(named, "text", "id", keep).where(~F.col("kept")).select(F.col("id.third").alias("key"))
    return rows_of(whole.join(dropped, "key", "left_anti"))
