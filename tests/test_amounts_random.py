"""Random amount cells: Spark cleaning expressions against the independent DuckDB SQL."""

import random

import duckdb

import oracle_queries as O
from salarium.operators import cleaning

ALPHABET = list("0123456789") * 4 + list("  +/-,.") * 2 + [" ", " ", "lei", "RON", "\n", "\t", "x"]
WHOLE = ["-", "N/A", "n/a", "null", "NULL", "nu a fost stabilită", " Nu a fost stabilită ", ""]


def _cells(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        if rnd.random() < 0.1:
            out.append(rnd.choice(WHOLE))
        else:
            out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))))
    return out


def test_random_amounts_match_duckdb(spark):
    s_cells, v_cells = _cells(3000, 1), _cells(3000, 2)
    rows = [(i + 1, s, v) for i, (s, v) in enumerate(zip(s_cells, v_cells))]
    df = spark.createDataFrame(rows, "src_row long, suma string, indemnizatie_variabila string")
    df = cleaning.amounts_numeric(cleaning.clean_amounts(cleaning.split_base_variable(
        cleaning.blank_placeholders(cleaning.clean_text(df)))))
    got = {r.src_row: (r.suma, r.indemnizatie_variabila, r.suma_num, r.indemnizatie_variabila_num)
           for r in df.collect()}

    con = duckdb.connect()
    con.execute("CREATE TABLE raw (src_row BIGINT, suma VARCHAR, indemnizatie_variabila VARCHAR)")
    con.executemany("INSERT INTO raw VALUES (?, ?, ?)", rows)
    names = [n for n, _ in O.CTES]
    ctes = ",\n".join(f"{n} AS ({sql})" for n, sql in O.CTES[names.index("c_text"): names.index("c_num") + 1])
    # the oracle's stages over a two-column raw table: only the amount columns are cleaned here
    ctes = ctes.replace(", ".join(f"{O._cell(c)} AS {c}" for c in O.RAW8),
                        ", ".join(f"{O._cell(c)} AS {c}" for c in ["suma", "indemnizatie_variabila"]))
    ctes = ctes.replace(", ".join(
        f"CASE WHEN {c} IN ('-', 'N/A', 'n/a', 'null', 'NULL') THEN '' ELSE {c} END AS {c}" for c in O.RAW8),
        ", ".join(f"CASE WHEN {c} IN ('-', 'N/A', 'n/a', 'null', 'NULL') THEN '' ELSE {c} END AS {c}"
                  for c in ["suma", "indemnizatie_variabila"]))
    ctes = ctes.replace("nr_crt, autoritate_tutelara, intreprindere, cui, personal, calitate_membru, ", "")
    sql = f"WITH {ctes} SELECT src_row, suma, indemnizatie_variabila, suma_num, indemnizatie_variabila_num FROM c_num"
    expect = {r[0]: tuple(r[1:]) for r in con.execute(sql).fetchall()}
    diffs = [(k, rows[k - 1][1:], got[k], expect[k]) for k in expect if got[k] != expect[k]]
    assert not diffs, diffs[:5]
