"""Mixing sources to target weights by hierarchical budgeting.

Documents hang from a tree of levels (domain, language, source). A token budget is
propagated from the root: each node shares what it gets among its children by their
weights. A child that cannot use its share, because its documents repeated ``max_epochs``
times have fewer tokens, is filled, and its surplus goes to its siblings first; only what
the whole family cannot use returns to the parent's siblings, and so on upwards. The tree
is aggregated data (one row per leaf) and is budgeted level by level with grouped
operations, so the number of leaves is not limited by the driver.

Each leaf then takes a token-prefix of its epochs: every epoch is the whole leaf in an
order seeded by epoch, epochs follow each other, and documents are taken until the leaf's
budget is reached. Whole epochs need no order; in the last one a histogram over the order
key finds the 4,096th part in which the budget ends, a second one the 4,096th part of that,
and only there equal places are summed and ranked, so neither a leaf holding a third of all
rows nor the copies of one row are ranked in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salarium.llm.tables import column, configure, keyed, rows_of, stored, text_of

_PART_BITS = 12  # of the order, found by one histogram; half of them by its sums
_HISTOGRAMS = 2


def word_tokens(text: Column) -> Column:
    """Number of runs of characters other than space and tab to carriage return."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def share(budget: float, weights: np.ndarray, supply: np.ndarray) -> np.ndarray:
    """Split ``budget`` by weight, no part above its supply; the surplus of filled parts is
    shared again by weight among the others. What none can use stays unshared. Parts of
    weight zero get something only when all others are filled, in proportion to supply."""
    out = np.zeros(len(weights))
    for w in (np.where(weights > 0, weights, 0.0), np.where(weights > 0, 0.0, supply)):
        open_ = (w > 0) & (supply > out)
        rest = budget - out.sum()
        # parts fill in the order of supply per weight: each step fills at least one
        while rest > 0 and open_.any():
            level = rest / w[open_].sum()
            full = open_ & (supply <= level * w)
            if not full.any():
                out[open_] = level * w[open_]
                rest = 0.0
                break
            out[full] = supply[full]
            rest -= supply[full].sum()
            open_ &= ~full
    return out


def _spread(path: list[str]):
    """Function for one family: its budget shared among its rows, in a fixed order."""

    def run(table: pa.Table) -> pa.Table:
        order = table.sort_by([(c, "ascending") for c in path])
        got = share(order.column("budget")[0].as_py(), *(order.column(c).to_numpy() for c in ("weight", "supply")))
        return order.select(path).append_column("got", pa.array(got))

    return run


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, float]], budget: float, max_epochs: float) -> DataFrame:
    """``leaves (levels..., tokens)`` with the ``budget`` of each leaf in tokens.

    ``weights[level][value]`` is a value's weight among its siblings; 1.0 where not given.
    Level by level from the root, a family (the children of one node) is one group of
    aggregated rows; a family of more than a few million children is not meant here.
    """
    depth = len(levels)
    now = None
    for d in range(1, depth + 1):
        path = levels[:d]
        supply = leaves.groupBy(*path).agg((F.sum("tokens") * F.lit(float(max_epochs))).alias("supply"))
        given = {None if v is None else str(v): float(w) for v, w in weights.get(levels[d - 1], {}).items()}
        family = supply.withColumn("weight", F.lit(1.0))
        if given:
            table = leaves.sparkSession.createDataFrame(list(given.items()), "value string, given double")
            family = supply.join(table, F.col(levels[d - 1]).eqNullSafe(F.col("value")), "left").select(
                *path, "supply", F.coalesce("given", F.lit(1.0)).alias("weight"))
        if now is None:
            family = family.withColumn("budget", F.lit(float(budget)))
        else:
            up = now.select(*[F.col(c).alias(f"up_{c}") for c in levels[: d - 1]], F.col("got").alias("budget"))
            on = _same(levels[: d - 1], [f"up_{c}" for c in levels[: d - 1]])
            family = family.join(up, on).drop(*[f"up_{c}" for c in levels[: d - 1]])
        schema = T.StructType([family.schema[c] for c in path] + [T.StructField("got", T.DoubleType())])

        keys = [F.col(c) for c in levels[: d - 1]] or [F.lit(0).alias("root")]
        now = stored(family.groupBy(*keys).applyInArrow(_spread(path), schema), "mixing-level")
    return now.withColumnRenamed("got", "budget")


def _same(cols: list[str], others: list[str]) -> Column:
    on = F.lit(True)
    for a, b in zip(cols, others):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def _place(order: Column) -> Column:
    """Signed numbers that stand in the order of unsigned ones."""
    return order.bitwiseXOR(F.lit(-(1 << 63)))


def _reached(parts: DataFrame, part: str) -> DataFrame:
    """(end_key, end, end_before): of each leaf the last of its ``parts (leaf_key, rest, before,
    part, tokens)`` that begins before the rest is used up, and the tokens before it."""
    earlier = Window.partitionBy("leaf_key").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    begun = parts.withColumn("before", F.col("before") + F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    return begun.where(F.col("before") < F.col("rest")).groupBy(F.col("leaf_key").alias("end_key")).agg(
        F.max(part).alias("end"), F.max("before").alias("end_before"))


def _last_places(placed: DataFrame) -> DataFrame:
    """(end_key, end): the last place that each leaf's rest reaches; no row where it reaches none."""
    sums = ["leaf_key", "rest", "before"]
    tokens = F.sum("n_tokens").alias("tokens")
    within = placed.select("leaf_key", "rest", F.lit(0).cast("bigint").alias("before"), "order", "n_tokens")
    for step in range(1, _HISTOGRAMS + 1):
        part = F.shiftrightunsigned("order", 64 - step * _PART_BITS).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
        within = within.withColumn("bin", part)
        bins = stored(within.groupBy(*sums, "bin").agg(tokens), "mixing-bins")
        stretch = F.shiftright("bin", _PART_BITS // 2)  # windows hold the stretches, then the bins of one
        ends = _reached(bins.groupBy(*sums, stretch.alias("stretch")).agg(F.sum("tokens").alias("tokens")), "stretch")
        inside = bins.join(ends, (F.col("leaf_key") == F.col("end_key")) & (stretch == F.col("end")))
        ends = stored(_reached(inside.select("leaf_key", "rest", F.col("end_before").alias("before"), "bin", "tokens"), "bin"), "mixing-ends")
        within = within.join(ends, (F.col("leaf_key") == F.col("end_key")) & (F.col("bin") == F.col("end"))).select(
            "leaf_key", "rest", F.col("end_before").alias("before"), "order", "n_tokens")
    places = within.groupBy(*sums, _place(F.col("order")).alias("place")).agg(tokens)
    return _reached(places, "place").select("end_key", "end")


def _taken(docs: DataFrame, levels: dict[str, str], weights: dict[str, dict[str, float]], budget_share: float, max_epochs: int, seed: int, text_col: str, id_col: str, key_col: str | None = None) -> DataFrame:
    """(id, row_key, leaf, n_tokens, copies) of the rows taken; ``row_key`` is ``key_col``."""
    configure(docs.sparkSession)
    names = list(levels)
    level_cols = [f"level_{i}" for i in range(len(names))]
    plan_cols = [f"p_{c}" for c in level_cols]
    text = text_of(docs, text_col)
    rows = stored(
        docs.select(
            column(docs, id_col).alias("id"),
            *[F.expr(e).cast("string").alias(c) for c, e in zip(level_cols, levels.values())],
            word_tokens(text).alias("n_tokens"),
            F.xxhash64(text).alias("text_key"),
            (column(docs, key_col) if key_col else F.lit(None)).cast("bigint").alias("row_key"),
        ),
        "mixing-rows",
    )
    leaves = stored(rows.groupBy(*level_cols).agg(F.sum("n_tokens").alias("tokens")), "mixing-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    by_level = {c: weights.get(n, {}) for c, n in zip(level_cols, names)}
    granted = budgets(leaves, level_cols, by_level, total * budget_share, max_epochs)
    granted = granted.select(*[F.col(c).alias(p) for c, p in zip(level_cols, plan_cols)], "budget")
    plan = granted.join(leaves.where("tokens > 0"), _same(level_cols, plan_cols)).withColumn(
        "epochs", F.least(F.lit(max_epochs), F.floor(F.col("budget") / F.col("tokens"))).cast("int"))
    rest = F.when(F.col("epochs") < max_epochs, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0.0)
    plan = stored(plan.select(*plan_cols, F.xxhash64(*plan_cols).alias("leaf_key"), "epochs", rest.alias("rest")), "mixing-plan")

    # the plan has one row per leaf: Spark broadcasts it by its size, or splits hot leaves
    placed = rows.join(plan, _same(level_cols, plan_cols)).withColumn(
        "order", F.xxhash64(F.lit(seed), F.col("epochs"), F.col("id"), F.col("text_key")))
    placed = stored(placed.drop(*plan_cols), "mixing-placed")
    cut = placed.join(stored(_last_places(placed), "mixing-ends"), F.col("leaf_key") == F.col("end_key"), "left")
    extra = F.coalesce(_place(F.col("order")) <= F.col("end"), F.lit(False)).cast("int")
    both = cut.withColumn("copies", F.col("epochs") + extra)
    leaf = F.struct(*[F.col(c).alias(n) for c, n in zip(level_cols, names)])
    return both.where(F.col("copies") > 0).select("id", "row_key", leaf.alias("leaf"), "n_tokens", "copies")


def mix(
    docs: DataFrame,
    levels: dict[str, str],
    weights: dict[str, dict[str, float]],
    budget_share: float = 1.0,
    max_epochs: int = 4,
    seed: int = 17,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per input row that is taken: id, ``leaf`` (level values), ``n_tokens``, and
    ``copies``, the number of epochs that take it.

    ``levels`` maps level names, outermost first, to SQL expressions over ``docs``; the budget
    is ``budget_share`` of all tokens (words). A leaf's budget may end within a document,
    which is taken whole: a leaf exceeds its budget by less than one place in the order.

    Null level values are values of their own. Null and empty texts have no tokens; they
    are taken with the part of the order they fall in, and a leaf without any token is not
    taken. Every row is a document of its own; rows equal in id and text share one place in
    the order and are taken together. Null ids are ids like any other. An empty table gives
    an empty result.
    """
    return _taken(docs, levels, weights, budget_share, max_epochs, seed, text_col, id_col).drop("row_key").withColumnRenamed("id", id_col)


def mixed_documents(docs: DataFrame, levels: dict[str, str], weights: dict[str, dict[str, float]], **settings) -> DataFrame:
    """The rows of ``docs`` that ``mix`` takes, each as often as it is taken.

    A row is known by a key of its own: each of several equal rows comes as often as ``mix``
    takes that row. All columns are kept, whatever their names.
    """
    text_col, id_col = settings.get("text_col", "text"), settings.get("id_col", "doc_id")
    whole, _ = keyed(docs, id_col, text_col)
    key = "row_key"
    while key.lower() in (c.lower() for c in docs.columns):
        key += "_"
    read = whole.select(F.col("key").alias(key), *(F.col("row").getField(c).alias(c) for c in docs.columns))
    settings = {"budget_share": 1.0, "max_epochs": 4, "seed": 17, **settings, "text_col": text_col, "id_col": id_col}
    taken = _taken(read, levels, weights, **settings, key_col=key).select(F.col("row_key").alias("key"), "copies")
    repeated = whole.join(taken, "key").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows_of(repeated)
