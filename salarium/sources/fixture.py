"""Adapter: derive the raw pay-disclosure table from the driver's order/customer tables.

The driver ships TPC-H-like tables, not pay disclosures. Every order becomes one disclosure
row whose cells carry the irregular formats of the real extracts (line breaks, blanks,
placeholders, split/summed/ranged amounts, '.0' sequence numbers, several spellings per
company and person). The derivation is a deterministic function of each order's own
columns, so it is a pure narrow projection after the joins and grows with ``orders``.
Remainders of the order key only choose which format a cell gets; no row is filtered out:
every order with a customer becomes exactly one raw row.

Output: ``src_row`` (file position) plus the eight raw string columns of the source file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salarium.session import apply_defaults

RAW_COLUMNS = [
    "nr_crt", "autoritate_tutelara", "intreprindere", "cui",
    "personal", "calitate_membru", "suma", "indemnizatie_variabila",
]

# Fixed values of the adapter (FIXTURES.md §3): segment offsets and role texts by priority.
SEGMENT_CODE = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3}
ROLE_BY_PRIORITY = {
    "1-URGENT": "Director General",
    "2-HIGH": "DIRECTOR",
    "3-MEDIUM": "membru CA",
    "4-NOT SPECIFIED": "Membru directorat",
}
OTHER_ROLE = "presedinte CS"


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(key: Column, mapping: dict, default) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default))


def load_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = ["orders", "customer", "nation", "region"]
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def raw_from_tables(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                    region: DataFrame) -> DataFrame:
    """Deterministic raw table: one row per order that has a customer."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = nation.select("n_nationkey", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    # nation/region are fixed-size dimensions (25 and 5 rows): the planner broadcasts them
    # from file statistics; orders x customer is left to AQE (shuffle join beyond threshold).
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey))

    k = F.col("o_orderkey")
    amt = F.floor(F.col("o_totalprice") / 100).cast("bigint")
    seg = F.col("c_mktsegment")
    nk = F.col("n_nationkey")
    ck = nk * 5 + _case(seg, SEGMENT_CODE, 4)
    thousands = F.floor(amt / 1000).cast("bigint")
    low3 = F.lpad(_s(amt % 1000), 3, "0")
    company_no = _s(nk % 20)

    nr_crt = (F.when(k % 7 == 0, F.lit(""))
               .when(k % 89 == 0, _s(ck + 501))
               .when(k % 11 == 0, F.concat(_s(ck + 1), F.lit(".0")))
               .otherwise(_s(ck + 1)))
    authority = F.when(k % 301 == 0, F.lit("N/A")).otherwise(F.concat(F.lit("AUTORITATEA "), F.col("r_name")))
    enterprise = (F.when(k % 503 == 0, F.concat(F.lit("COMPANIA "), company_no, F.lit(" "), seg, F.lit(" S.A.")))
                   .when(k % 13 == 0, F.concat(F.lit("  Compania "), company_no, F.lit("\n"), seg, F.lit(" ")))
                   .otherwise(F.concat(F.lit("COMPANIA "), company_no, F.lit(" "), seg)))
    cui = (F.when(k % 97 == 0, F.lit(""))
            .when(k % 709 == 0, F.lit("-"))
            .when(k % 601 == 0, F.concat(F.lit("RO"), _s(ck + 1003)))
            .otherwise(F.concat(F.lit("RO"), _s(ck + 1000))))
    person = (F.when(k % 401 == 0, F.lit("-"))
               .when(k % 50 == 0, F.lower(F.col("c_name")))
               .otherwise(F.concat(F.lit(" "), F.col("c_name"))))
    role = _case(F.col("o_orderpriority"), ROLE_BY_PRIORITY, OTHER_ROLE)
    base = (F.when(k % 1201 == 7, _s(amt * 5_000_000))
             .when(k % 499 == 0, _s(amt * 1000))
             .when(k % 211 == 0, _s(amt * 6))
             .when(k % 10 == 1, F.concat(_s(thousands), F.lit(" "), low3))
             .when(k % 10 == 2, F.concat(_s(amt), F.lit("/"), _s(amt * 2)))
             .when(k % 10 == 3, F.concat(_s(amt), F.lit(" + "), _s(amt)))
             .when(k % 10 == 4, F.concat(_s(amt), F.lit(" - "), _s(amt + 7)))
             .when(k % 10 == 5, F.concat(_s(thousands), F.lit(","), low3))
             .when(k % 10 == 6, F.concat(_s(F.floor(amt / 100).cast("bigint")), F.lit(".50 lei")))
             .when(k % 40 == 7, F.lit("-"))
             .when(k % 40 == 17, F.lit("nu a fost stabilită"))
             .when(k % 40 == 27, F.concat(F.lit("-"), _s(amt)))
             .when(k % 40 == 37, F.concat(_s(amt), F.lit("+")))
             .otherwise(_s(amt)))
    variable = (F.when(k % 3 == 0, F.lit(""))
                 .when(k % 3 == 1, F.lit("null"))
                 .otherwise(_s(F.floor(F.abs(F.col("c_acctbal"))).cast("bigint"))))

    return j.select(
        (k + 1).alias("src_row"),
        nr_crt.alias("nr_crt"),
        authority.alias("autoritate_tutelara"),
        enterprise.alias("intreprindere"),
        cui.alias("cui"),
        person.alias("personal"),
        role.alias("calitate_membru"),
        base.alias("suma"),
        variable.alias("indemnizatie_variabila"),
    )


def spread_if_underpartitioned(df: DataFrame) -> DataFrame:
    """Round-robin a scan over the cluster's cores when it has fewer input splits than cores.

    A small file with one row group is read by one task, and every row-local expression after
    it would run on one core. Large inputs arrive in many splits and are left as they are, so
    this adds a shuffle only where the data is small.
    """
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD API in this session (e.g. a remote client): leave as is
        return df
    return df.repartition(want) if have < want else df


def raw_table(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """The raw table; ``spread=False`` when the consumer repartitions it anyway."""
    apply_defaults(spark)
    t = load_tables(spark, sf_dir)
    orders = spread_if_underpartitioned(t["orders"]) if spread else t["orders"]
    return raw_from_tables(orders, t["customer"], t["nation"], t["region"])


# The same derivation as DuckDB SQL, for the oracle side (kept textually independent of the
# DataFrame code above).
RAW_SQL = """
SELECT k + 1 AS src_row,
  CASE WHEN k % 7 = 0 THEN '' WHEN k % 89 = 0 THEN CAST(ck + 501 AS VARCHAR) WHEN k % 11 = 0 THEN concat(CAST(ck + 1 AS VARCHAR), '.0') ELSE CAST(ck + 1 AS VARCHAR) END AS nr_crt,
  CASE WHEN k % 301 = 0 THEN 'N/A' ELSE concat('AUTORITATEA ', r_name) END AS autoritate_tutelara,
  CASE WHEN k % 503 = 0 THEN concat('COMPANIA ', CAST(nk % 20 AS VARCHAR), ' ', seg, ' S.A.')
       WHEN k % 13 = 0 THEN concat('  Compania ', CAST(nk % 20 AS VARCHAR), chr(10), seg, ' ')
       ELSE concat('COMPANIA ', CAST(nk % 20 AS VARCHAR), ' ', seg) END AS intreprindere,
  CASE WHEN k % 97 = 0 THEN '' WHEN k % 709 = 0 THEN '-' WHEN k % 601 = 0 THEN concat('RO', CAST(1003 + ck AS VARCHAR)) ELSE concat('RO', CAST(1000 + ck AS VARCHAR)) END AS cui,
  CASE WHEN k % 401 = 0 THEN '-' WHEN k % 50 = 0 THEN lower(c_name) ELSE concat(' ', c_name) END AS personal,
  CASE pr WHEN '1-URGENT' THEN 'Director General' WHEN '2-HIGH' THEN 'DIRECTOR' WHEN '3-MEDIUM' THEN 'membru CA' WHEN '4-NOT SPECIFIED' THEN 'Membru directorat' ELSE 'presedinte CS' END AS calitate_membru,
  CASE WHEN k % 1201 = 7 THEN CAST(amt * 5000000 AS VARCHAR)
       WHEN k % 499 = 0 THEN CAST(amt * 1000 AS VARCHAR)
       WHEN k % 211 = 0 THEN CAST(amt * 6 AS VARCHAR)
       WHEN k % 10 = 1 THEN concat(CAST(CAST(floor(amt / 1000) AS BIGINT) AS VARCHAR), ' ', lpad(CAST(amt % 1000 AS VARCHAR), 3, '0'))
       WHEN k % 10 = 2 THEN concat(CAST(amt AS VARCHAR), '/', CAST(amt * 2 AS VARCHAR))
       WHEN k % 10 = 3 THEN concat(CAST(amt AS VARCHAR), ' + ', CAST(amt AS VARCHAR))
       WHEN k % 10 = 4 THEN concat(CAST(amt AS VARCHAR), ' - ', CAST(amt + 7 AS VARCHAR))
       WHEN k % 10 = 5 THEN concat(CAST(CAST(floor(amt / 1000) AS BIGINT) AS VARCHAR), ',', lpad(CAST(amt % 1000 AS VARCHAR), 3, '0'))
       WHEN k % 10 = 6 THEN concat(CAST(CAST(floor(amt / 100) AS BIGINT) AS VARCHAR), '.50 lei')
       WHEN k % 40 = 7 THEN '-'
       WHEN k % 40 = 17 THEN 'nu a fost stabilită'
       WHEN k % 40 = 27 THEN concat('-', CAST(amt AS VARCHAR))
       WHEN k % 40 = 37 THEN concat(CAST(amt AS VARCHAR), '+')
       ELSE CAST(amt AS VARCHAR) END AS suma,
  CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'null' ELSE CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) END AS indemnizatie_variabila
FROM (
  SELECT o.o_orderkey AS k, CAST(floor(o.o_totalprice / 100) AS BIGINT) AS amt, o.o_orderpriority AS pr,
         c.c_name, c.c_mktsegment AS seg, c.c_acctbal, n.n_nationkey AS nk, r.r_name,
         n.n_nationkey * 5 + CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS ck
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
"""
