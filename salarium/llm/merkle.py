"""Merkle dataset manifest with inclusion proofs by pointer jumping.

Every row is a leaf. The leaves of one group (a language) form a tree in id order, two
children to a parent (the last parent of a level may have one); the groups' roots, in group
order, form the top tree in the same way, and what remains is the root of the manifest.

1. One pass hashes the rows. They are numbered in (group, id) order by range partitioning,
   so a group holding most rows is spread over many tasks.
2. Trees are built ``CHUNK_LEVELS`` levels at a time: a task hashes aligned runs of
   ``2**CHUNK_LEVELS`` nodes and passes on one node for each. Each node leaves a row with its
   first proof segment (its sibling and the side it stands on) and a pointer to its parent.
3. Pointers jump: each round joins the rows with themselves, pointer to node, appends the
   segment found there and takes over its pointer, so distances double. A round needs only
   the nodes whose level is a multiple of the next distance (top nodes stay, as groups differ
   in height); the other side shrinks from round to round and is broadcast once a check of
   its size allows. Rows that have reached the root take no part in later joins.
4. Every leaf folds its own proof to the root again.

A segment holds one entry for each level, from the leaf on: ``N`` (no sibling), or ``L`` or
``R`` and the 32 bytes of the sibling that stands left or right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salarium.llm.tables import column, configure, partitions, stored
from salarium.plans.joins import bounded, hinted
from salarium.plans.sequence import with_sequence

CHUNK_LEVELS = 6
_TOP = -1  # number of the top tree
_BROADCAST_BYTES = 8 << 20

_NODE = ("tree", "level", "pos")
_POINTER = ("to_tree", "to_level", "to_pos")


def field(value: Column) -> Column:
    """A value in a leaf: ``-`` for null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves: the bits of ``n - 1``."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


# ---- the tree --------------------------------------------------------------------------


def parent_hash(children: list[bytes]) -> bytes:
    """H of the children's digests as hex text."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def _chunk_nodes(tree: int, level: int, first: int, hashes: list[bytes], height: int):
    """All nodes of an aligned run below its highest one: (level, pos, segment); and that one."""
    out, at = [], level
    while at < min(level + CHUNK_LEVELS, height):
        for i, _ in enumerate(hashes):
            other = i ^ 1
            if other < len(hashes):
                segment = (b"L" if other < i else b"R") + hashes[other]
            else:
                segment = b"N"
            out.append((at, first + i, segment))
        hashes = [parent_hash(hashes[i : i + 2]) for i in range(0, len(hashes), 2)]
        first, at = first >> 1, at + 1
    return out, (at, first, hashes[0])


def _climb(nodes: DataFrame, level: int) -> DataFrame:
    """Hash ``CHUNK_LEVELS`` levels of all trees: rows with a segment for the nodes below, and
    one row with a hash (segment null) for each highest node."""
    kinds = {"tree": pa.int32(), "height": pa.int32(), "level": pa.int32(), "pos": pa.int64(), "segment": pa.binary(),
             "hash": pa.binary(), "is_leaf": pa.bool_(), "leaf": pa.binary(), "tampered": pa.binary()}
    names = list(kinds) + ["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key, id_type = None, None

        def flush() -> list[dict]:
            tree, height, first = held[0]["tree"], held[0]["height"], held[0]["pos"]
            below, (at, pos, top) = _chunk_nodes(tree, level, first, [h["hash"] for h in held], height)
            rows = []
            for i, (lv, p, segment) in enumerate(below):
                row = {"tree": tree, "height": height, "level": lv, "pos": p, "segment": segment, "hash": None,
                       "is_leaf": False, "leaf": None, "tampered": None, "id": None}
                if lv == level:
                    row.update({k: held[i][k] for k in ("is_leaf", "leaf", "tampered", "id")})
                rows.append(row)
            own = held[0] if at == level else {"is_leaf": False, "leaf": None, "tampered": None, "id": None}
            rows.append({"tree": tree, "height": height, "level": at, "pos": pos, "segment": None, "hash": top,
                         **{k: own[k] for k in ("is_leaf", "leaf", "tampered", "id")}})
            return rows

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            arrays = [pa.array([r[n] for r in rows], kinds.get(n, id_type)) for n in names]
            return pa.RecordBatch.from_arrays(arrays, names)

        out: list[dict] = []
        for batch in batches:
            id_type = batch.schema.field("id").type
            for row in batch.to_pylist():
                run_of = (row["tree"], row["pos"] >> CHUNK_LEVELS)
                if held and run_of != key:
                    out += flush()
                    held = []
                    if len(out) >= 4096:
                        yield batch_of(out)
                        out = []
                key = run_of
                held.append(row)
        if held:
            out += flush()
        if out:
            yield batch_of(out)

    schema = T.StructType([
        T.StructField("tree", T.IntegerType()), T.StructField("height", T.IntegerType()),
        T.StructField("level", T.IntegerType()), T.StructField("pos", T.LongType()),
        T.StructField("segment", T.BinaryType()), T.StructField("hash", T.BinaryType()),
        T.StructField("is_leaf", T.BooleanType()), T.StructField("leaf", T.BinaryType()),
        T.StructField("tampered", T.BinaryType()), T.StructField("id", nodes.schema["id"].dataType),
    ])
    dealt = nodes.select("tree", "height", "pos", "hash", "is_leaf", "leaf", "tampered", "id").repartition(
        partitions(nodes), "tree", F.shiftright("pos", CHUNK_LEVELS)).sortWithinPartitions("tree", "pos")
    return dealt.mapInArrow(run, schema)


def _build(nodes: DataFrame, heights: int) -> tuple[list[DataFrame], DataFrame]:
    """Build trees of at most ``heights`` levels from their leaves: the rows of all nodes but
    the roots, and the roots (tree, hash and, where a tree is one leaf, the leaf's columns)."""
    below, roots = [], []
    level = 0
    while True:
        climbed = stored(_climb(nodes, level), "merkle-climb")
        below.append(climbed.where("segment IS NOT NULL"))
        tops = climbed.where("segment IS NULL")
        roots.append(tops.where("level = height"))
        if level + CHUNK_LEVELS >= heights:
            break
        nodes = tops.where("level < height")
        level += CHUNK_LEVELS
    all_roots = roots[0]
    for r in roots[1:]:
        all_roots = all_roots.unionByName(r)
    return below, all_roots


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---- proofs ----------------------------------------------------------------------------


def _jump(now: DataFrame, distance: int, last: bool) -> DataFrame:
    """One round: append what the pointers' targets hold. ``last``: only leaves are needed."""
    due = now.where("is_leaf") if last else now.where(
        F.col("is_leaf") | (F.col("tree") == _TOP) | (F.pmod("level", F.lit(2 * distance)) == 0))
    arrived = due.where("to_tree IS NULL")
    going = due.where("to_tree IS NOT NULL")
    # what a pointer reaches: an odd multiple of the distance, or a node of the top tree
    there, fits = bounded(
        now.where((F.col("tree") == _TOP) | (F.pmod("level", F.lit(2 * distance)) == distance)).select(
            *(F.col(c).alias(f"at_{c}") for c in _NODE), F.col("segment").alias("more"),
            *(F.col(c).alias(f"next_{c}") for c in _POINTER)),
        max_bytes=_BROADCAST_BYTES)
    found = going.join(
        hinted(there, fits), [F.col(p) == F.col(f"at_{n}") for p, n in zip(_POINTER, _NODE)])
    jumped = found.select(
        *_NODE, "is_leaf", "id", "leaf", "tampered", "own_tree", F.concat("segment", "more").alias("segment"),
        *(F.col(f"next_{c}").alias(c) for c in _POINTER))
    return stored(jumped.unionByName(arrived), "merkle-jump")


def _folded(leaves: DataFrame) -> DataFrame:
    """Each leaf's proof digest and the root that its (tampered) leaf folds to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256
        for batch in batches:
            proofs, roots = [], []
            own, tampered, segments = (batch.column(i).to_pylist() for i in (2, 3, 4))
            for leaf, changed, segment in zip(own, tampered, segments):
                now = (leaf if changed is None else changed).hex()
                siblings, at = [], 0
                while at < len(segment):
                    side = segment[at : at + 1]
                    if side == b"N":
                        at += 1
                        now = sha(now.encode()).hexdigest()
                        continue
                    other = segment[at + 1 : at + 33].hex()
                    at += 33
                    siblings.append(other)
                    now = sha((other + now if side == b"L" else now + other).encode()).hexdigest()
                proofs.append(sha("".join(siblings).encode()).hexdigest())
                roots.append(now)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.hex() for x in own], pa.string()),
                 pa.array(proofs, pa.string()), pa.array(roots, pa.string())],
                ["id", "own_tree", "leaf", "proof_sha256", "folded_root"])

    schema = T.StructType([
        leaves.schema["id"], T.StructField("own_tree", T.IntegerType()), T.StructField("leaf", T.StringType()),
        T.StructField("proof_sha256", T.StringType()), T.StructField("folded_root", T.StringType()),
    ])
    return leaves.select("id", "own_tree", "leaf", "tampered", "segment").mapInArrow(run, schema)


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    leaf_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tamper_col: str | None = "n_chars",
    tamper_every: int = 7,
) -> DataFrame:
    """One row per input row: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the
    siblings from the leaf up), ``folded_root`` and ``verified`` (it equals ``root``).

    Proofs are checked by a planted fault: where ``tamper_every`` divides the crc32 of the id
    as decimal text, the leaf that is folded has 1 added to ``tamper_col`` (None: nowhere).

    A null is ``-`` in a leaf, so it differs from the empty text; a null ``tamper_col`` or id
    is not tampered with. The null group comes first, then groups bytewise. A null id comes
    first in its group; rows that repeat an id are ordered by leaf, and equal rows are equal
    leaves with proofs of their own. Columns of other names, whatever they are, are not read.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    configure(spark)
    plain = [column(docs, c) for c in leaf_cols]
    own_leaf, changed = leaf_hash(plain), F.lit(None).cast("binary")
    if tamper_col is not None:
        hit = F.pmod(F.crc32(column(docs, id_col).cast("string").cast("binary")), F.lit(tamper_every)) == 0
        bumped = [column(docs, c).cast("decimal(38,0)") + 1 if c == tamper_col else column(docs, c) for c in leaf_cols]
        changed = F.when(hit & column(docs, tamper_col).isNotNull(), leaf_hash(bumped))
    leaves = stored(
        docs.select(column(docs, id_col).alias("id"), column(docs, group_col).cast("string").alias("grp"),
                    own_leaf.alias("leaf"), changed.alias("tampered")), "merkle-leaves")
    numbered = with_sequence(leaves, ["grp", "id", "leaf"], name="seq", start=0)

    # one row per group, numbered in order
    groups = numbered.groupBy("grp").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    groups, few = bounded(with_sequence(groups, ["grp"], name="tree", start=0).select(
        F.col("grp").alias("of_grp"), "first", F.col("tree").cast("int").alias("tree"), _height(F.col("n")).alias("height")))
    n_groups, tallest = groups.agg(F.count(F.lit(1)), F.max("height")).first()
    top_height = max(n_groups - 1, 0).bit_length()
    nodes = numbered.join(hinted(groups, few), F.col("grp").eqNullSafe(F.col("of_grp"))).select(
        "tree", "height", F.lit(0).alias("level"), (F.col("seq") - F.col("first")).alias("pos"), F.col("leaf").alias("hash"),
        F.lit(True).alias("is_leaf"), "leaf", "tampered", "id")

    below, subroots = _build(nodes, tallest or 0)
    subroots = stored(subroots, "merkle-subroots")
    upper, root = _build(
        subroots.select(F.lit(_TOP).alias("tree"), F.lit(top_height).alias("height"), F.lit(0).alias("level"),
                        F.col("tree").cast("bigint").alias("pos"), "hash", "is_leaf", "leaf", "tampered", "id"), top_height)
    root = stored(root, "merkle-root")
    root_hash = root.select(F.lower(F.hex("hash"))).first()  # one row
    root_hash = F.lit(root_hash[0] if root_hash else None).cast("string")

    # pointers: a group's root is the leaf of the top tree that has the group's number
    lower_rows = _union(below).withColumn("own_tree", F.col("tree"))
    joins_top = F.col("level") + 1 == F.col("height")
    if n_groups <= 1:  # the only subroot is the root
        to = [F.when(~joins_top, F.col("tree")), F.when(~joins_top, F.col("level") + 1), F.when(~joins_top, F.shiftright("pos", 1))]
    else:
        to = [F.when(joins_top, F.lit(_TOP)).otherwise(F.col("tree")),
              F.when(joins_top, F.lit(0)).otherwise(F.col("level") + 1),
              F.when(joins_top, F.col("tree").cast("bigint")).otherwise(F.shiftright("pos", 1))]
    lower_rows = lower_rows.select("*", *(c.alias(p) for c, p in zip(to, _POINTER)))
    # a group of one row: its leaf is a node of the top tree
    upper_rows = _union([*upper, root.withColumn("segment", F.lit(b"")).where("is_leaf")]).withColumn(
        "own_tree", F.when(F.col("is_leaf"), F.col("pos").cast("int")))
    more = F.col("level") + 1 < F.col("height")
    upper_rows = upper_rows.select(
        "*", F.when(more, F.col("tree")).alias(_POINTER[0]), F.when(more, F.col("level") + 1).alias(_POINTER[1]),
        F.when(more, F.shiftright("pos", 1)).alias(_POINTER[2]))
    now = lower_rows.unionByName(upper_rows).select(
        *_NODE, "is_leaf", "id", "leaf", "tampered", "own_tree", "segment", *_POINTER)

    depth, distance = (tallest or 0) + top_height, 1
    while distance < depth:
        now = _jump(now, distance, last=2 * distance >= depth)
        distance *= 2

    by_tree, few = bounded(subroots.select(F.col("tree").alias("sub_tree"), F.lower(F.hex("hash")).alias("subroot")))
    folded = _folded(now.where("is_leaf"))
    out = folded.join(hinted(by_tree, few), F.col("own_tree") == F.col("sub_tree"))
    return out.select(
        F.col("id").alias(id_col), "leaf", "subroot", root_hash.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root_hash).alias("verified"))
