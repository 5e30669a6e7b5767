"""The registered queries of this package and, where SQL can express them, their SQL.

Each takes (spark, sf_dir), applies its operator with production parameters to the
whole table, and derives the columns of the result from what the operator returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.llm import bpe, crosspolytope, exact, hosttrust, lines, merkle, oracles, packing, pii, quality, simhash, toxic, variants, warczip
from veil.sources.tables import read_table

#: Rules of the URL filter: verdict and host with path.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find_spans(docs, pii.fit(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), VOCABULARY)


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosttrust.judge_pages(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warczip.round_trip(read_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents"), VOCABULARY), VOCABULARY)
    return coded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"),
    )


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op11_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxic.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxic.score_documents(docs, model).select("doc_id", toxic.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = variants.spelling_variants(read_table(spark, sf_dir, "documents"), garble=True)
    return found.select("word", "n", "n_near", "form", "form_n", "root")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.manifest(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_exact": op1_exact,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_urls": op4_urls,
    "op5_warc": op5_warc,
    "op6_simhash": op6_simhash,
    "op7_bpe": op7_bpe,
    "op8_quality": op8_quality,
    "op9_embeddings": op9_embeddings,
    "op10_lines": op10_lines,
    "op11_toxic": op11_toxic,
    "op12_variants": op12_variants,
    "op13_merkle": op13_merkle,
}
ORACLES: dict[str, str] = {
    "op1_exact": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id,
               count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
               sha256(text) AS text_sha256
        FROM t""",
    "op4_urls": hosttrust.oracle_sql(URL_RULES),
    "op12_variants": oracles.VARIANTS,
    "op13_merkle": oracles.MERKLE,
    "op9_embeddings": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        sound AS (
          SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS MATERIALIZED (
          SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
          ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
        reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)""",
    "op10_lines": """
        WITH cut AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents),
        counted AS (
          SELECT *, len(list_filter(regexp_split_to_array(line, '[\\x09-\\x0D\\x20]+'), lambda x: x <> '')) AS words FROM cut),
        inked AS MATERIALIZED (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i,
                 sum(words) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM counted WHERE words > 0),
        ahead AS (
          SELECT a.doc_id, a.i AS a, b.i AS b FROM (SELECT *, upto - words + 50 AS need FROM inked) a
          ASOF JOIN inked b ON a.doc_id = b.doc_id AND a.need <= b.upto),
        behind AS (
          SELECT b.doc_id, a.i AS a, b.i AS b FROM (SELECT *, upto - 50 AS most FROM inked) b
          ASOF JOIN (SELECT *, upto - words AS before FROM inked) a ON a.doc_id = b.doc_id AND b.most >= a.before),
        windows AS (SELECT * FROM ahead UNION SELECT * FROM behind),
        texts AS (SELECT doc_id, list(line ORDER BY i) AS parts FROM inked GROUP BY doc_id),
        copies AS (
          SELECT doc_id, a, b FROM windows JOIN texts USING (doc_id)
          QUALIFY row_number() OVER (PARTITION BY array_to_string(list_slice(parts, a, b), chr(10)) ORDER BY doc_id, a) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM copies),
        marked AS (
          SELECT c.doc_id, c.k, c.line, CASE WHEN c.words > 0 THEN CAST(g.i IS NOT NULL AS INT) END AS cut
          FROM counted c LEFT JOIN inked n ON c.doc_id = n.doc_id AND c.k = n.k LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.i = n.i),
        judged AS (
          SELECT doc_id, k, line,
            coalesce(last_value(cut IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1
            AND coalesce(first_value(cut IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) = 1 AS removed
          FROM marked),
        kept AS (
          SELECT doc_id, string_agg(line, chr(10) ORDER BY k) FILTER (NOT removed) AS kept_text, count(*) AS n_lines,
                 CAST(sum(CAST(removed AS INT)) AS BIGINT) AS n_removed FROM judged GROUP BY doc_id)
        SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(kept_text, '') END AS text, n_lines, n_removed
        FROM documents JOIN kept USING (doc_id)""",
    "op5_warc": """
        WITH t AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM t),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
}
