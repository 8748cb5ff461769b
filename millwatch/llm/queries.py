"""Named queries of the operators in this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millwatch.llm import (
    bpe,
    cross_tokens,
    decontaminate,
    extract,
    licences,
    near_dup,
    outliers,
    pair_counts,
    suffix_dedup,
    token_files,
    toxicity,
    warc,
    whitening,
)
from millwatch.llm.store import table


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_report(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern())


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_report(table(spark, sf_dir, "documents"))


def op3_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_report(table(spark, sf_dir, "documents")).drop("d2")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_dup_report(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_report(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_report(table(spark, sf_dir, "pages"))


def op11_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens.alignment_report(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_counts.count_report(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_byte_bpe, op2_licences, op3_outliers, op4_decontaminate, op5_suffix_dedup, op6_superminhash, op7_token_files, op8_toxicity, op9_extract, op10_warc,
              op11_cross_tokens, op12_whitening, op13_token_counts)
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op4_decontaminate": f"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        tests AS (
            SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram, least(10, len(w)) AS size
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM tests WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM windows),
        grams AS (
            SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size)),
        found AS (SELECT g.doc_id, g.i, g.size, t.item_id FROM grams g JOIN windows t USING (gram, size)),
        hits AS (
            SELECT doc_id, count(DISTINCT j) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM found) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h FROM documents),
        grams AS (
            SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS gram
            FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)),
        first AS (SELECT gram, min((doc_id, i)) AS one FROM grams GROUP BY gram HAVING count(*) > 1),
        marks AS (SELECT g.doc_id, g.i FROM grams g JOIN first f USING (gram) WHERE (g.doc_id, g.i) <> f.one),
        runs AS (
            SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
            FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS new FROM marks)),
        spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY ALL),
        cuts AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
        kept AS (
            SELECT c.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
                   string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
            FROM cuts c JOIN d USING (doc_id) GROUP BY c.doc_id)
        SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(rest, h))) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op6_superminhash": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        sets AS (
            SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        both_sets AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
            FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM both_sets JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
        edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
        groups AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, g.component_id, d.doc_id = g.component_id AS kept
        FROM documents d JOIN groups g USING (doc_id) LEFT JOIN sizes s USING (doc_id)""",
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        named AS (
            SELECT page_id, payload, strlen(payload) AS payload_bytes, min(page_id) OVER (PARTITION BY payload) AS first_id,
                   unhex(sha1(payload))::BIT::VARCHAR AS bits
            FROM p)
        SELECT page_id, payload_bytes,
               list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([substr(bits, 5 * i + j + 1, 1)::INTEGER * (1 << (4 - j)) for j in range(5)])::INTEGER, 1)
                               for i in range(32)], 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM named""",
}
