import hashlib
import zlib

import pytest
from pyspark.sql import Row

from salarium.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, plus=0):
    out = ""
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        v = row[name]
        if v is None:
            out += "-"
            continue
        v = str(v + plus if name == "n_chars" else v)
        out += f"{len(v.encode())}:{v}"
    return h(out)


def tree(hashes):
    """Root and, for each leaf, its siblings from the leaf up with the side they stand on."""
    proofs = [[] for _ in hashes]
    spans = [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        up, up_spans = [], []
        for i in range(0, len(hashes), 2):
            run = hashes[i : i + 2]
            if len(run) == 2:
                for x in spans[i]:
                    proofs[x].append(("R", run[1]))
                for x in spans[i + 1]:
                    proofs[x].append(("L", run[0]))
            else:
                for x in spans[i]:
                    proofs[x].append(("N", ""))
            up.append(h("".join(run)))
            up_spans.append(sum(spans[i : i + 2], []))
        hashes, spans = up, up_spans
    return hashes[0], proofs


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs, lower = [], []
    for lang in langs:
        mine = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        groups[lang] = mine
        sub, proofs = tree([leaf_of(r) for r in mine])
        subs.append(sub)
        lower.append(proofs)
    root, upper = tree(subs)
    out = []
    for g, lang in enumerate(langs):
        for r, proof in zip(groups[lang], lower[g]):
            whole = proof + upper[g]
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            now = leaf_of(r, int(hit))
            for side, other in whole:
                now = h({"N": now, "L": other + now, "R": now + other}[side])
            out.append((r["doc_id"], leaf_of(r), subs[g], root, h("".join(x for _, x in whole)), now, now == root))
    return sorted(out, key=repr)


def rows_of(sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append({"doc_id": i * 3 % 1009, "text": f"text {i} é", "lang": lang, "source": f"s{i % 5}", "n_chars": i})
    return rows


def frame(spark, rows):
    return spark.createDataFrame([Row(**r) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 1, "fr": 1}, {"en": 70, "de": 1, "fr": 2, "": 3, None: 5},
    {"en": 333, "de": 64, "es": 65, "fr": 129, "xx": 1, "é": 1, None: 1},
])
def test_against_brute_force(spark, sizes):
    rows = rows_of(sizes)
    got = merkle.manifest(frame(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == brute(rows)
    if len(rows) > 100:
        assert 0 < sum(not r[-1] for r in got) < len(rows) / 4


def test_nulls_repeats_long_texts_and_names(spark):
    rows = rows_of({"en": 20})
    rows += [dict(rows[0]), dict(rows[0]), {**rows[1], "text": None}, {**rows[1], "text": ""}, {**rows[2], "n_chars": None}]
    rows += [{"doc_id": None, "text": "x" * 300000, "lang": "en", "source": None, "n_chars": 2**63 - 1}]
    assert sorted(map(tuple, merkle.manifest(frame(spark, rows)).collect()), key=repr) == brute(rows)
    clash = frame(spark, rows).selectExpr("*", "'x' AS leaf", "1 AS seq", "2 AS tree", "3 AS id", "4 AS grp", "5 AS `a.b`")
    assert sorted(map(tuple, merkle.manifest(clash).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sort_merge_joins(spark):
    rows = rows_of({"en": 130, "de": 20})
    spark.conf.set("salarium.broadcast.maxRows", "1")
    try:
        assert sorted(map(tuple, merkle.manifest(frame(spark, rows)).collect()), key=repr) == brute(rows)
    finally:
        spark.conf.unset("salarium.broadcast.maxRows")


def test_query_equals_its_sql(spark):
    import duckdb

    from salarium.llm.queries import ORACLE_SQL, QUERIES

    directory = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{directory}/documents.parquet'")
    got = QUERIES["op11_merkle_manifest"](spark, directory)
    cur = con.execute(ORACLE_SQL["op11_merkle_manifest"])
    names = [d[0] for d in cur.description]
    assert names == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())
