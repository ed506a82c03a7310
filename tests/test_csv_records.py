"""Record boundaries over file splits against Python's csv module."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from salarium.sources import files
from salarium.sources.csv_records import count_fields, land_records


def write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def by_csv(path):
    with open(path, encoding="utf-8", newline="") as f:
        return [(i, row) for i, row in enumerate(csv.reader(f), start=1)]


def random_file(path, rows, seed, end="\n"):
    rng = random.Random(seed)
    cells = ["1", "a", "", "x, y", f"two{end}lines", f"{end}{end}", 'say ""hi""', "é", f'",{end}"', "long " * 40]
    out = ["c1,c2,c3"]
    for _ in range(rows):
        row = [rng.choice(cells) for _ in range(rng.choice([3, 3, 3, 3, 2, 4, 1]))]
        out.append(",".join(f'"{c}"' if any(x in c for x in ',"\n\r') or rng.random() < 0.2 else c for c in row))
        if rng.random() < 0.02:
            out.append("")
    return write(path, end.join(out) + end)


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_the_csv_module(spark, tmp_dir, small_splits, end):
    folder = os.path.join(tmp_dir, "raw")
    os.mkdir(folder)
    paths = [random_file(os.path.join(folder, f"f{i}.csv"), 400, i, end) for i in range(2)]
    landed = land_records(spark, folder)
    raw_lines = spark.read.option("lineSep", "\n").text(folder)
    assert raw_lines.select("_metadata.file_path", "_metadata.file_block_start").distinct().count() > 10
    got = {(os.path.basename(r.src_file), r.record_no): r.n_fields for r in landed.collect()}
    assert got == {(os.path.basename(p), i): len(row) for p in paths for i, row in by_csv(p)}
    bad = {(os.path.basename(r.src_file), r.record_no, r.n_fields) for r in files.malformed_records(spark, folder, landed).collect()}
    assert bad == {(os.path.basename(p), i, len(row)) for p in paths for i, row in by_csv(p) if i > 1 and len(row) != 3}
    cells = {(os.path.basename(r.src_file), r.src_row): (r.c1, r.c2, r.c3) for r in files.read_raw(spark, folder, landed).collect()}
    norm = lambda c: c.replace("\r\n", "\n")  # noqa: E731 - line ends inside cells are told apart by no later step
    assert {k: tuple(map(norm, v)) for k, v in cells.items()} == {
        (os.path.basename(p), i): tuple(map(norm, row + [""] * (3 - len(row)))) for p in paths for i, row in by_csv(p) if i > 1 and 1 <= len(row) <= 3}


def test_unclosed_quote_runs_to_the_end_of_its_file(spark, tmp_dir, small_splits):
    folder = os.path.join(tmp_dir, "open")
    os.mkdir(folder)
    write(os.path.join(folder, "a.csv"), "c1,c2\n1,2\n3,\"four\n" + "5,6\n" * 2000)
    write(os.path.join(folder, "b.csv"), "c1,c2\n" + "7,8\n" * 1000)
    landed = land_records(spark, folder)
    got = {os.path.basename(r.src_file): r.n for r in landed.groupBy("src_file").agg(F.count("*").alias("n")).collect()}
    assert got == {"a.csv": 3, "b.csv": 1001}
    assert landed.where("record_no = 3").orderBy("src_file").first().n_fields == 2


def test_field_count_of_a_long_cell_is_linear(spark):
    long = '"' + "a,b \n" * 200_000 + '""' * 1000 + '"'
    df = spark.createDataFrame([(f"1,{long},x", 3), (f'{long}', 1), (f'1,"{"," * 500_000}', 2), ("", 0), (",", 2)], "r string, n int")
    assert all(r.got == r.n for r in df.select("n", count_fields(F.col("r")).alias("got")).collect())
