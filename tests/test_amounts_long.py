"""Sums and maxima of digit runs of any length against Python's unbounded integers."""

import random

from pyspark.sql import functions as F

from salarium.functions.amounts import clean_amount_text, max_of_digits, sum_of_digits


def test_digit_strings_of_any_length(spark):
    rng = random.Random(3)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [[digits(rng.choice([1, 17, 18, 19, 37, 60, 200])) for _ in range(rng.randint(2, 6))] for _ in range(200)]
    rows += [["9" * 60, "1"], ["0" * 50, "0"], ["000", "9" * 36], ["9" * 18, "1"], ["5" * 3000, "5" * 3000]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, parts array<string>")
    got = df.select("i", sum_of_digits(F.col("parts")).alias("s"), max_of_digits(F.col("parts")).alias("m")).collect()
    for r in got:
        values = list(map(int, rows[r.i]))
        assert (r.s, r.m) == (str(sum(values)), str(max(values)))


def test_cells_with_sixty_digits(spark):
    a, b = "9" * 60, "8" * 60
    cells = {f"{a}+{b}": str(int(a) + int(b)), f"{b} / {a} / 7": a, f"{a}/{b}+1": str(int(a + b) + 1), f"{a}": a, "1+2": "3", "3/20": "20",
             "+".join(["9" * 27] * 40): str(40 * int("9" * 27))}
    df = spark.createDataFrame([(k,) for k in cells], "c string")
    assert {r.c: r.v for r in df.select("c", clean_amount_text(F.col("c")).alias("v")).collect()} == cells
