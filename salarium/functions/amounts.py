"""Amount-text expressions (P6, P7, P8) as native column expressions.

Everything here compiles to JVM expressions (regexp, split, higher-order array functions),
so no Python runs per row. The DataFrame forms (``*_stages``) compute each intermediate
value once as its own column: Catalyst keeps a projection separate when collapsing it would
duplicate a non-trivial expression, so a value used four times is still evaluated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salarium.functions.text import py_strip

# Texts (after strip, lower-cased) that mean "no amount".
NO_AMOUNT_TEXTS = ["-", "n/a", "nu a fost stabilită"]

# Texts of up to _SHORT characters are summed and compared as decimals, which cannot overflow
# then; longer ones as digit strings, in chunks of _CHUNK digits.
_BIG, _SHORT, _CHUNK = "decimal(38,0)", 28, 18


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def _numeric_parts(text: Column, sep: str) -> Column:
    """The digit runs of the ``sep``-separated parts of ``text`` (parts without digits
    dropped). Deleting every character except digits and the separator
    first gives each part's digits directly, so no per-element lambda is needed and the
    expression stays in whole-stage code generation."""
    digits_and_sep = F.regexp_replace(text, rf"[^0-9{sep}]", "")
    return F.array_remove(F.split(digits_and_sep, "\\" + sep), "")


def _no_leading_zeros(digits: Column) -> Column:
    return F.regexp_replace(digits, "^0+(?=.)", "")


def sum_of_digits(parts: Column) -> Column:
    """The sum of digit strings of any length, as text: chunk by chunk from the lowest, with carry."""
    longest = F.array_max(F.transform(parts, lambda p: F.length(p)))
    n = F.ceil(longest / _CHUNK).cast("int")
    unit = F.lit(10**_CHUNK).cast(_BIG)

    def chunk(p: Column, i: Column) -> Column:
        return F.substring(F.lpad(p, n * _CHUNK, F.lit("0")), (n - i) * _CHUNK + 1, F.lit(_CHUNK)).cast(_BIG)

    def add(state: Column, i: Column) -> Column:
        total = F.aggregate(parts, state["carry"], lambda acc, p: (acc + chunk(p, i)).cast(_BIG))
        low = F.pmod(total, unit)
        text = F.concat(F.lpad(low.cast("string"), _CHUNK, "0"), state["text"])
        return F.struct(((total - low) / unit).cast(_BIG).alias("carry"), text.alias("text"))  # without rest: exact

    start = F.struct(F.lit(0).cast(_BIG).alias("carry"), F.lit("").alias("text"))
    return F.aggregate(F.sequence(F.lit(1), n), start, add, lambda s: _no_leading_zeros(F.concat(s["carry"].cast("string"), s["text"])))


def max_of_digits(parts: Column) -> Column:
    """The greatest of digit strings of any length, as text: by length, then as text."""
    bare = F.transform(parts, lambda p: F.struct(F.length(_no_leading_zeros(p)).alias("n"), _no_leading_zeros(p).alias("digits")))
    return F.array_max(bare)["digits"]


# ---- P7 -----------------------------------------------------------------------------------
# Rules: 1. blank, or one of NO_AMOUNT_TEXTS after strip/lower -> ''
#        2. U+00A0 removed, U+202F -> space, then every character except digits and
#           ", . / + -" is deleted
#        3. contains '+': the sum of the digit runs of the '+'-parts when there are at least
#           two, else the text of step 2 unchanged
#        4. contains '/': the largest digit run of the '/'-parts when there are at least two
#        5. otherwise the text of step 2 (commas and dots kept)


def _amount_stage1(c: Column) -> Column:
    return py_strip(F.coalesce(c, F.lit("")))


def _amount_stage2(text: Column) -> tuple[Column, Column]:
    no_amount = (text == F.lit("")) | F.lower(text).isin(NO_AMOUNT_TEXTS)
    spaced = F.replace(F.replace(text, F.lit("\u00a0"), F.lit("")), F.lit("\u202f"), F.lit(" "))
    return no_amount, F.regexp_replace(spaced, r"[^0-9,./+\-]", "")


def _amount_stage3(kept: Column) -> tuple[Column, Column]:
    # parts are only built when the separator occurs (CASE evaluates lazily)
    plus = F.when(F.instr(kept, "+") > 0, _numeric_parts(kept, "+"))
    slash = F.when(F.instr(kept, "/") > 0, _numeric_parts(kept, "/"))
    return plus, slash


def _amount_stage4(no_amount: Column, kept: Column, plus: Column, slash: Column) -> Column:
    # the one higher-order function of the cleaning (no built-in array sum); it sits in the
    # last, small projection so the stages before it keep whole-stage code generation
    short = F.length(kept) <= _SHORT
    plus_sum = F.when(short, F.aggregate(plus, F.lit(0).cast(_BIG), lambda acc, p: (acc + p.cast(_BIG)).cast(_BIG)).cast("string")).otherwise(
        sum_of_digits(plus))
    slash_max = F.when(short, F.array_max(slash.cast(f"array<{_BIG}>")).cast("string")).otherwise(max_of_digits(slash))
    return (
        F.when(no_amount, F.lit(""))
        .when(plus.isNotNull(), F.when(F.size(plus) >= 2, plus_sum).otherwise(kept))
        .when(slash.isNotNull() & (F.size(slash) >= 2), slash_max)
        .otherwise(kept)
    )


def clean_amount_text(c: Column) -> Column:
    """P7 on one column as a single expression (see ``clean_amount_stages`` for tables)."""
    no_amount, kept = _amount_stage2(_amount_stage1(c))
    plus, slash = _amount_stage3(kept)
    return _amount_stage4(no_amount, kept, plus, slash)


def clean_amount_stages(df: DataFrame, columns: list[str]) -> DataFrame:
    """P7 on several columns of a table, each intermediate computed once per row."""
    tmp: list[str] = []
    df = df.withColumns({f"_a1_{c}": _amount_stage1(F.col(c)) for c in columns})
    stage2 = {}
    for c in columns:
        no_amount, kept = _amount_stage2(F.col(f"_a1_{c}"))
        stage2[f"_a2n_{c}"], stage2[f"_a2k_{c}"] = no_amount, kept
    df = df.withColumns(stage2)
    stage3 = {}
    for c in columns:
        stage3[f"_a3p_{c}"], stage3[f"_a3s_{c}"] = _amount_stage3(F.col(f"_a2k_{c}"))
    df = df.withColumns(stage3)
    df = df.withColumns({c: _amount_stage4(F.col(f"_a2n_{c}"), F.col(f"_a2k_{c}"), F.col(f"_a3p_{c}"),
                                           F.col(f"_a3s_{c}")) for c in columns})
    for c in columns:
        tmp += [f"_a1_{c}", f"_a2n_{c}", f"_a2k_{c}", f"_a3p_{c}", f"_a3s_{c}"]
    return df.drop(*tmp)


# ---- P6 -----------------------------------------------------------------------------------


def split_base_variable_cols(suma: Column, variabila: Column) -> tuple[Column, Column]:
    """P6: 'base - variable' in ``suma`` is split at the first '-'.

    When both sides (stripped) contain a digit, the left side becomes ``suma`` and the right
    side overwrites ``variabila``; otherwise both are unchanged. Both results are computed
    from the old ``suma``.
    """
    s = F.coalesce(suma, F.lit(""))
    pos = F.instr(s, "-")
    left = py_strip(F.substring_index(s, "-", 1))
    right = py_strip(s.substr(pos + F.lit(1), F.length(s)))
    ok = (pos > 0) & (_digits(left) != F.lit("")) & (_digits(right) != F.lit(""))
    return F.when(ok, left).otherwise(suma), F.when(ok, right).otherwise(variabila)


def split_base_variable_stages(df: DataFrame, suma: str, variabila: str) -> DataFrame:
    """P6 on a table: the two sides are computed once, then both columns replaced."""
    s = F.coalesce(F.col(suma), F.lit(""))
    pos = F.instr(s, "-")
    df = df.withColumns({
        "_s6_has": pos > 0,
        "_s6_left": F.when(pos > 0, py_strip(F.substring_index(s, "-", 1))),
        "_s6_right": F.when(pos > 0, py_strip(s.substr(pos + F.lit(1), F.length(s)))),
    })
    ok = (F.col("_s6_has") & (_digits(F.col("_s6_left")) != F.lit(""))
          & (_digits(F.col("_s6_right")) != F.lit("")))
    df = df.withColumn("_s6_ok", F.coalesce(ok, F.lit(False)))
    df = df.withColumns({
        suma: F.when(F.col("_s6_ok"), F.col("_s6_left")).otherwise(F.col(suma)),
        variabila: F.when(F.col("_s6_ok"), F.col("_s6_right")).otherwise(F.col(variabila)),
    })
    return df.drop("_s6_has", "_s6_left", "_s6_right", "_s6_ok")


# ---- P8 -----------------------------------------------------------------------------------


def cast_or_fail(c: Column, kind: str) -> Column:
    """``c`` as ``kind``; a text that is none is an error whatever the ANSI setting is."""
    value = c.try_cast(kind)
    failed = F.raise_error(F.concat(F.lit(f"not a valid {kind}: "), c.cast("string"))).cast(kind)
    return F.when(c.isNotNull() & value.isNull(), failed).otherwise(value)


def digits_to_int(c: Column) -> Column:
    """Delete every non-digit, '' -> 0, as bigint (sign and decimal point are lost)."""
    d = _digits(F.coalesce(c, F.lit("")))
    return cast_or_fail(F.when(d == F.lit(""), F.lit("0")).otherwise(d), "bigint")


def digits_to_int_stages(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """P8 on a table: ``{source column: output column}``, the digit text computed once."""
    df = df.withColumns({f"_d8_{out}": _digits(F.coalesce(F.col(src), F.lit(""))) for src, out in pairs.items()})
    df = df.withColumns({out: cast_or_fail(F.when(F.col(f"_d8_{out}") == F.lit(""), F.lit("0"))
                         .otherwise(F.col(f"_d8_{out}")), "bigint") for out in pairs.values()})
    return df.drop(*[f"_d8_{out}" for out in pairs.values()])
