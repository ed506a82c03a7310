"""File sources and sinks S1-S6, S10, S12, S14."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from salarium.sources import files

HEADER = ('"Nr.crt","Autoritate Publică Tutelară (APT)","Nume întreprindere publică",CUI,'
          '"Nume personal conducere","Calitate (membru CA/CS\ndirector/membru directorat)",'
          '"Valoare indemnizație fix lunar conform contract (brut-lei)*",'
          '"Valoare indemnizație variabila anual conform contract (brut-lei)*"\n')


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_read_raw_multiline_short_and_long(spark, tmp_dir):
    body = ('1,APT A,"Compania\nUnu",RO1,Ion,membru CA,"31 530",\n'
            '2,APT B,Doi,RO2,Ana,director,100\n'                    # short: padded with ''
            '3,APT C,Trei,RO3,Dan,director,1,2,3\n'                 # long: dropped
            '4,APT D,"Patru, SA",RO4,Eva,membru CA,"1+2",5\n')
    p = _write(os.path.join(tmp_dir, "raw.csv"), HEADER + body)
    df = files.read_raw(spark, p)
    assert df.columns[:5] == ["src_file", "src_row", "nr_crt", "autoritate_tutelara", "intreprindere"]
    assert "suma" in df.columns and "indemnizatie_variabila" in df.columns
    rows = sorted(df.collect(), key=lambda r: r.src_row)
    assert [r.nr_crt for r in rows] == ["1", "2", "4"]
    assert rows[0].intreprindere == "Compania\nUnu"
    assert rows[1].indemnizatie_variabila == ""
    assert rows[2].intreprindere == "Patru, SA"


def test_malformed_records(spark, tmp_dir):
    body = "1,a,b,c,d,e,f,g\n2,a,b\n3,a,b,c,d,e,f,g,h,i\n"
    p = _write(os.path.join(tmp_dir, "m.csv"), HEADER + body)
    bad = sorted((r.n_fields, r.content) for r in files.malformed_records(spark, p).collect())
    assert bad == [(3, "2,a,b"), (10, "3,a,b,c,d,e,f,g,h,i")]


def test_read_clean_na_tokens(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "c.csv"), "a,b,c\nNA,x,\nnull,None,y\n1,2,3,4\n")
    rows = sorted(tuple(r) for r in files.read_clean(spark, p).collect())
    assert rows == [("", "", "y"), ("", "x", "")]


def test_write_clean_and_validated(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a,b", "x"), (2, "", "y")], "src_row long, c1 string, c2 string")
    out1 = os.path.join(tmp_dir, "clean")
    files.write_clean(df, out1)
    back = files.read_clean(spark, out1)
    assert sorted(tuple(r) for r in back.collect()) == [("", "y"), ("a,b", "x")]
    out2 = os.path.join(tmp_dir, "validated")
    files.write_validated(df, out2)
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(out2 + "/part-*.csv")))
    assert '"a,b","x"' in text and "\r" not in text


def test_full_reload_is_idempotent_and_guarded(spark, tmp_dir):
    target = os.path.join(tmp_dir, "table")
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    files.full_reload(df, target, allowed_prefixes=(tmp_dir,))
    files.full_reload(df, target, allowed_prefixes=(tmp_dir,))
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(PermissionError):
        files.full_reload(df, "/somewhere/else", allowed_prefixes=(tmp_dir,))


def test_publish_local_uri(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "src_row long, c string")
    uri = "file://" + os.path.join(tmp_dir, "published")
    files.publish(df, uri)
    assert spark.read.option("header", True).csv(uri).columns == ["c"]


def test_read_json_records(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "posts.json"), json.dumps([{"id": 1, "title": "a"}, {"id": 2, "title": "b"}]))
    assert files.read_json_records(spark, p, "id long, title string").count() == 2
    n, sample = files.json_records_summary(files.read_json_records(spark, p, "id long, title string"))
    assert n == 2 and json.loads(sample) in ({"id": 1, "title": "a"}, {"id": 2, "title": "b"})
    empty = _write(os.path.join(tmp_dir, "empty.json"), "[]")
    with pytest.raises(ValueError):
        files.read_json_records(spark, empty, "id long, title string")


def test_write_quality_report(spark, tmp_dir):
    rep = spark.createDataFrame([(10, "success")], "row_count long, status string")
    out = os.path.join(tmp_dir, "report")
    files.write_quality_report(rep, out, "data/in.csv", "data/out.csv")
    parts = glob.glob(out + "/part-*.json")
    assert len(parts) == 1
    obj = json.loads(open(parts[0], encoding="utf-8").read().strip())
    assert obj["row_count"] == 10 and obj["input_file"] == "data/in.csv" and obj["run_timestamp_utc"].endswith("Z")


def test_doubled_quotes_round_trip(spark, tmp_dir):
    body = '1,APT,"Compania ""Unu"" SA",RO1,"Ion, ""Nelu""",director,100,\n'
    p = _write(os.path.join(tmp_dir, "q.csv"), HEADER + body)
    row = files.read_raw(spark, p).first()
    assert row.intreprindere == 'Compania "Unu" SA' and row.personal == 'Ion, "Nelu"'
    out = os.path.join(tmp_dir, "q_out")
    files.write_validated(files.read_raw(spark, p), out)
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(out + "/part-*.csv")))
    assert '"Compania ""Unu"" SA"' in text
    back = files.read_clean(spark, out).first()
    assert back.intreprindere == 'Compania "Unu" SA'


def test_writers_keep_blanks_and_empty_cells(spark, tmp_dir):
    df = spark.createDataFrame([(1, "  a b ", "")], "src_row long, c1 string, c2 string")
    out = os.path.join(tmp_dir, "blanks")
    files.write_clean(df, out)
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(out + "/part-*.csv")))
    assert "  a b ," in text and '""' not in text
    out2 = os.path.join(tmp_dir, "blanks_q")
    files.write_validated(df, out2)
    text2 = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(out2 + "/part-*.csv")))
    assert '"  a b ",""' in text2


def test_read_raw_crlf_and_bom(spark, tmp_dir):
    text = "\ufeff" + HEADER.replace('"Nr.crt"', "Nr.crt") + '1,APT,"Comp\r\nUnu",RO1,Ion,director,"1 000",5\r\n2,APT,Doi,RO2,Ana,membru CA,7,\r\n'
    p = os.path.join(tmp_dir, "crlf.csv")
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(text.replace("\n", "\r\n").replace("\r\r\n", "\r\n"))
    df = files.read_raw(spark, p)
    assert df.columns[2] == "nr_crt"        # the byte-order mark is not part of the name
    rows = sorted(df.collect(), key=lambda r: r.src_row)
    assert [r.nr_crt for r in rows] == ["1", "2"]
    assert rows[0].intreprindere.replace("\r", "") == "Comp\nUnu" and rows[1].indemnizatie_variabila == ""


def test_several_raw_files_keep_file_order(spark, tmp_dir):
    from salarium.plans.warehouse import Warehouse
    folder = os.path.join(tmp_dir, "many")
    os.makedirs(folder)
    # b.csv is larger (read first by size-based packing) but comes second by name
    _write(os.path.join(folder, "a.csv"), HEADER + "1,APT,X,RO1,Ion,director,10,\n,APT,X,RO1,Ana,director,20,\n")
    _write(os.path.join(folder, "b.csv"), HEADER + "".join(
        f"{'' if i else 7},APT,Y,RO1,P{i},director,{i},\n" for i in range(40)))
    wh = Warehouse(files.read_raw(spark, folder))
    loaded = {r.id: r for r in wh.loaded.collect()}
    assert [loaded[i].personal for i in (1, 2, 3)] == ["Ion", "Ana", "P0"]
    # the blank sequence number of Ana is filled from the first RO1 row in file order (a.csv)
    assert loaded[2].nr_crt == 1


def test_raw_without_variable_column_and_with_extra_column(spark, tmp_dir):
    from salarium.plans.warehouse import Warehouse
    header = ",".join(h for h in HEADER.strip().split(",")[:7]) + ",Observatii\n"
    body = "1,APT,Unu,RO1,Ion,director,5000 - 300,nota\n2,APT,Doi,RO2,Ana,membru CA,12 000,\n"
    p = _write(os.path.join(tmp_dir, "novar.csv"), header + body)
    raw = files.read_raw(spark, p)
    assert "indemnizatie_variabila" not in raw.columns and "observatii" in raw.columns
    loaded = {r.id: r for r in Warehouse(raw).loaded.collect()}
    assert (loaded[1].suma_num, loaded[1].indemnizatie_variabila_num) == (5000, 300)
    assert (loaded[2].suma_num, loaded[2].indemnizatie_variabila_num) == (12000, 0)


def test_publish_partitioned(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 2024), (2, "b", 2025)], "src_row long, c string, an int")
    uri = "file://" + os.path.join(tmp_dir, "published_by_year")
    files.publish(df, uri, partition_by=["an"])
    listing = set(os.listdir(uri[len("file://"):]))
    assert {"an=2024", "an=2025"} <= listing
    back = spark.read.option("header", True).csv(uri)
    assert sorted((r.c, r.an) for r in back.collect()) == [("a", 2024), ("b", 2025)]
