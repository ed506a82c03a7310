"""A raw table where one company and one person hold most rows, through the whole
warehouse, against the DuckDB oracle chain over the same rows (broadcast and sort-merge
paths)."""

import math
import random

import duckdb
import pytest

import oracle_queries as O
from salarium.operators import analytics, anomaly
from salarium.plans.warehouse import Warehouse
from salarium.sources.fixture import RAW_COLUMNS


def _raw_rows(n=3000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        hot = rnd.random() < 0.7
        cui = "RO1" if hot else rnd.choice(["RO2", "RO3", "", "RO4"])
        person = " Ion Pop" if hot else rnd.choice(["ana", "Dan", "-", "  ANA "])
        company = "  Compania\\nMare " if hot else rnd.choice(["Mica SA", "MICA SA", "Alta"])
        nr = rnd.choice(["", "1", "2.0", "nan"])
        amount = rnd.choice([str(rnd.randint(0, 9000)), f"{rnd.randint(1, 99)} {rnd.randint(100, 999)}",
                             f"{rnd.randint(1, 900)}+{rnd.randint(1, 900)}", "-", "N/A", "10000000"])
        var = rnd.choice(["", "null", str(rnd.randint(0, 500))])
        role = rnd.choice(["membru CA", "Director", "x"])
        rows.append((k + 1, nr, "APT", company.replace("\\n", "\n"), cui, person, role, amount, var))
    return rows


def _oracle(con, final, upto):
    names = [n for n, _ in O.CTES]
    body = ",\n".join(f"{n} AS ({sql})" for n, sql in O.CTES[1: names.index(upto) + 1])
    return con.execute(f"WITH {body}\n{final}")


def _same(spark_df, cur):
    cols = sorted(spark_df.columns)
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols

    def norm(v):
        return None if isinstance(v, float) and math.isnan(v) else v
    s = sorted(tuple(repr(norm(r[c])) for c in cols) for r in spark_df.collect())
    o = sorted(tuple(repr(norm(dict(zip(ocols, r))[c])) for c in cols) for r in cur.fetchall())
    assert s == o


@pytest.mark.parametrize("max_rows", [None, "1"])
def test_hot_keys_end_to_end(spark, max_rows):
    rows = _raw_rows()
    if max_rows:
        spark.conf.set("salarium.broadcast.maxRows", max_rows)
    try:
        raw = spark.createDataFrame(rows, "src_row long, " + ", ".join(f"{c} string" for c in RAW_COLUMNS))
        wh = Warehouse(raw)
        con = duckdb.connect()
        con.execute("CREATE TABLE raw (src_row BIGINT, " + ", ".join(f"{c} VARCHAR" for c in RAW_COLUMNS) + ")")
        con.executemany(f"INSERT INTO raw VALUES ({', '.join('?' * 9)})", rows)
        _same(wh.loaded.select("id", "nr_crt", "cui", "personal", "suma_num", "indemnizatie_variabila_num"),
              _oracle(con, "SELECT id, nr_crt, cui, personal, suma_num, indemnizatie_variabila_num FROM loaded",
                      "loaded"))
        _same(wh.fact, _oracle(con, "SELECT * FROM fact", "fact"))
        q = O.oracle_sql()
        _same(analytics.distribution(wh.fact, wh.dim_companies),
              _oracle(con, q["distribution_companies"].split("\n")[-1], "dim_companies"))
        _same(analytics.top_earners(wh.fact, wh.dim_persons),
              _oracle(con, "SELECT * FROM top_earners", "top_earners"))
        scores = anomaly.anomaly_scores(anomaly.fact_slice(wh.fact, None, None)).selectExpr(
            "record_pk", "company_id", "person_id", "anomaly_score",
            "array_join(anomaly_reasons, ';') AS anomaly_reasons")
        _same(scores, _oracle(con, f"SELECT {O._SCORE_COLS} FROM a_scored", "a_scored"))
    finally:
        spark.conf.unset("salarium.broadcast.maxRows")
