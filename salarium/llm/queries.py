"""The registered queries: each applies one operator, with production parameters, to its
whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salarium.llm import decontaminate, exact_dedup, huffman, lexical, license_scan, merkle, mixing, quality, sharding, simhash_dedup, suffix_dedup, token_counts, url_filter
from salarium.llm.tables import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_file(spark, sf_dir):
    return huffman.token_file_round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)


def op2_simhash_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), radius=4, shingle=4, seed=42)


def op3_quality(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label_col="quality")


# the domain is the source's number modulo 4
MIXING_LEVELS = {
    "domain": "'domain' || try_cast(regexp_extract(source, '([0-9]+)$', 1) AS bigint) % 4",
    "lang": "lang",
    "source": "source",
}
MIXING_WEIGHTS = {
    "domain": {"domain0": 2.0, "domain1": 1.0, "domain2": 1.0, "domain3": 1.0},
    "lang": {"en": 3.0, "de": 1.0, "fr": 1.0, "es": 1.0},
}


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"), length=100)


def op10_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), MIXING_LEVELS, MIXING_WEIGHTS, budget_share=1.0, max_epochs=4)


def op4_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.TEMPLATES | license_scan.RESERVED)


def op5_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op7_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), limit=2048)


def op8_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 24)


def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


def op13_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_file": op1_token_file,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_quality": op3_quality,
    "op4_license_scan": op4_license_scan,
    "op5_decontamination": op5_decontamination,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_sharding": op8_sharding,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_mixing": op10_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_lexical_search": op12_lexical_search,
    "op13_url_filter": op13_url_filter,
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM d JOIN g USING (text_sha256)""",
    "op11_merkle_manifest": """
        WITH RECURSIVE coded AS (
            SELECT doc_id, lang, n_chars, doc_id::VARCHAR AS digits,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM documents),
        leaves AS (
            SELECT doc_id, lang, n_chars, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                   sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS bumped,
                   xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(digits) + 1), lambda i: ascii(substr(digits, i, 1))::BIGINT)),
                       lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 7 AS remainder
            FROM coded),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   row_number() OVER () AS row_no, count(*) OVER (PARTITION BY lang) AS n
            FROM leaves),
        low AS (
            SELECT lang, 0 AS lev, pos, leaf AS hash, n FROM placed
            UNION ALL
            SELECT lang, lev + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), any_value((n + 1) // 2)
            FROM low WHERE n > 1 GROUP BY lang, lev, pos // 2),
        subs AS (
            SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
            FROM low WHERE n = 1),
        high AS (
            SELECT 0 AS lev, pos, subroot AS hash, n FROM subs
            UNION ALL
            SELECT lev + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), any_value((n + 1) // 2)
            FROM high WHERE n > 1 GROUP BY lev, pos // 2),
        steps AS (
            SELECT p.row_no, 0 AS tier, l.lev, p.pos >> l.lev AS spot, o.hash
            FROM placed p JOIN (SELECT DISTINCT lang, lev FROM low WHERE n > 1) l ON p.lang IS NOT DISTINCT FROM l.lang
            LEFT JOIN low o ON o.lang IS NOT DISTINCT FROM l.lang AND o.lev = l.lev AND o.pos = xor(p.pos >> l.lev, 1)
            UNION ALL
            SELECT p.row_no, 1, l.lev, s.pos >> l.lev, o.hash
            FROM placed p JOIN subs s ON p.lang IS NOT DISTINCT FROM s.lang
            CROSS JOIN (SELECT DISTINCT lev FROM high WHERE n > 1) l
            LEFT JOIN high o ON o.lev = l.lev AND o.pos = xor(s.pos >> l.lev, 1)),
        proofs AS (
            SELECT row_no, string_agg(hash, '' ORDER BY tier, lev) AS siblings,
                   list(CASE WHEN hash IS NULL THEN 'N' WHEN spot % 2 = 1 THEN 'L' || hash ELSE 'R' || hash END ORDER BY tier, lev) AS path
            FROM steps GROUP BY row_no),
        folded AS (
            SELECT p.*, s.subroot, (SELECT hash FROM high WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
                   list_reduce(
                       list_prepend(CASE WHEN remainder = 0 AND n_chars IS NOT NULL THEN bumped ELSE leaf END, coalesce(path, [])),
                       lambda a, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || a) WHEN 'R' THEN sha256(a || s[2:]) ELSE sha256(a) END) AS folded_root
            FROM placed p
            LEFT JOIN proofs USING (row_no) JOIN subs s ON p.lang IS NOT DISTINCT FROM s.lang)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded""",
    "op12_lexical_search": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS row_no,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        sized AS (SELECT row_no, doc_id, len(terms)::BIGINT AS n, terms FROM d WHERE len(terms) > 0),
        totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sized),
        tf AS (
            SELECT row_no, doc_id, n, term, count(*) AS tf
            FROM (SELECT row_no, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM tf, totals GROUP BY term, n_docs),
        asked AS (
            SELECT DISTINCT item_no, item_id, unnest(terms) AS term
            FROM (SELECT row_number() OVER () AS item_no, item_id,
                         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
                  FROM benchmark)),
        scored AS (
            SELECT item_no, item_id, row_no, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN tf USING (term), totals
            GROUP BY item_no, item_id, row_no, doc_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS rank
            FROM scored WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
