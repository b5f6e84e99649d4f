"""Registered queries of the numbered operators, with their contract parameters, and SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devpulse.llm import ann, bpe, lexical, lm_scoring, merkle, order_minhash, packing, quality, simhash, token_counts, topk, toxicity, warc
from devpulse.sources.tables import load_table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
TOKEN_LIMIT = 2048
SHINGLE_WORDS, MAX_BITS = 3, 3
#: Payloads of at least so many bytes may be revisits.
PAYLOAD_BYTES = 0
GOOD, TOXIC = 0.3, 0.5
HITS = 50
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op2_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what ``labels`` marks as good; losses rounded to six places."""
    target = load_table(spark, sf_dir, "labels").where("quality = 1")
    scored = lm_scoring.scores(load_table(spark, sf_dir, "documents"), target)
    return scored.select("doc_id", "n_tokens",
                         *(F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels"), GOOD)


def op4_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load_table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)


def op5_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load_table(spark, sf_dir, "pages"), PAYLOAD_BYTES).drop("record_id", "intact")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels"), TOXIC)


def op7_bpe_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(load_table(spark, sf_dir, "documents"), WORD_BPE)


def op8_packing_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load_table(spark, sf_dir, "documents"), WORD_BPE, END_ID)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load_table(spark, sf_dir, "documents"), WORD_BPE, TOKEN_LIMIT)


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_fingerprints(load_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"), HITS)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's proof; where 5 divides the key's checksum, the root is folded from a tampered leaf."""
    docs = load_table(spark, sf_dir, "documents")
    changed = merkle.leaf_digest([F.translate(c, UPPER, LOWER) if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.proofs(docs.withColumn("tampered", F.when(chosen, merkle.hexed(changed))), LEAF_COLUMNS,
                          "source", "doc_id", FANOUT, ["tampered"])
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return (found.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
                         folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_topk, op2_cross_entropy_difference, op3_quality_rules, op4_simhash_vptree,
                            op5_warc_normaliser, op6_toxicity, op7_bpe_merge_rounds, op8_packing_cutting_stock,
                            op9_token_counts, op10_order_minhash, op11_lexical_search,
                            op12_merkle_manifest, op13_nearest_neighbours)}

ORACLE_SQL: dict[str, str] = {
    # base32 of the SHA-1, five hexadecimal digits to four letters at a time
    "op5_warc_normaliser": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
        q AS (
            SELECT *, list_aggregate(list_transform(range(0, 32), lambda i:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))) & 31), 1)),
                'string_agg', '') AS payload_digest,
                max(page_id) OVER (PARTITION BY h, payload_bytes) AS best FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> best THEN best END AS refers_to FROM q""",
    "op1_exact_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, c.row, max(list_dot_product(q.v, c.v)::BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
            GROUP BY q.vec_id, c.vec_id, c.row),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op2_cross_entropy_difference": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda w: w <> '') AS ws,
                doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS target FROM documents),
        t AS (SELECT r, target, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
        c AS (SELECT w, count(*) AS n, count(*) FILTER (target) AS k FROM t GROUP BY w),
        s AS (SELECT sum(n) AS n, sum(k) AS k, count(*) AS v FROM c),
        q AS (SELECT w, c.n, c.k, (c.n + 1) / (s.n + v) AS pn, (c.k + 1) / (s.k + v) AS pk FROM c, s),
        x AS (SELECT z.r, z.target, a.w AS u, z.w FROM t z LEFT JOIN t a ON a.r = z.r AND a.i = z.i - 1),
        b AS (SELECT u, w, count(*) AS n, count(*) FILTER (target) AS k FROM x WHERE u IS NOT NULL GROUP BY ALL),
        l AS (SELECT x.r,
                -ln(CASE WHEN h.k > 0 THEN 0.7 * b.k / h.k + 0.3 * q.pk ELSE q.pk END) AS lk,
                -ln(CASE WHEN h.n > 0 THEN 0.7 * b.n / h.n + 0.3 * q.pn ELSE q.pn END) AS ln
              FROM x JOIN q ON x.w = q.w LEFT JOIN q h ON x.u = h.w LEFT JOIN b ON x.u = b.u AND x.w = b.w)
        SELECT doc_id, len(any_value(ws))::BIGINT AS n_tokens, round(avg(lk), 6) AS target_loss,
               round(avg(ln), 6) AS background_loss, round(avg(lk) - avg(ln), 6) AS score
        FROM d LEFT JOIN l ON d.r = l.r GROUP BY d.r, doc_id""",
    "op11_lexical_search": """
        WITH i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
        d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), []) AS ts FROM documents),
        c AS (SELECT count(*) FILTER (len(ts) > 0) AS docs, sum(len(ts))::BIGINT AS total FROM d),
        f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
              FROM f, c WHERE term IN (SELECT term FROM i) GROUP BY term, docs),
        s AS (
            SELECT item_id, d.doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf
                + 20 * (50 + (50 * len(ts) * docs) // total))))::BIGINT AS score
            FROM i JOIN w USING (term) JOIN f USING (term) JOIN d USING (r), c GROUP BY item_id, d.doc_id, r),
        k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank
              FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50""",
    "op12_merkle_manifest": """
        WITH RECURSIVE crc AS (
            SELECT doc_id, 4294967295 - list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b:
                list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i:
                    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
        d AS (
            SELECT doc_id, source,
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
            FROM documents),
        h AS (
            SELECT d.doc_id, d.source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS tampered
            FROM d LEFT JOIN crc ON d.doc_id = crc.doc_id),
        leaves AS (
            SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                count(*) OVER (PARTITION BY source) AS n FROM h),
        node AS (
            SELECT 0 AS level, tree, idx, n, leaf AS h FROM leaves
            UNION ALL
            SELECT level + 1, tree, idx // 16, any_value(n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx))
            FROM node WHERE n > 1 GROUP BY level, tree, idx // 16),
        upper AS (
            SELECT 0 AS level, tree AS idx, count(*) OVER () AS n, h FROM node WHERE n = 1
            UNION ALL
            SELECT level + 1, idx // 16, any_value(n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx))
            FROM upper WHERE n > 1 GROUP BY level, idx // 16),
        every AS (  -- the source trees, and above them the tree of the subroots
            SELECT false AS up, * FROM node UNION ALL SELECT true, level, 0, idx, n, h FROM upper),
        run AS (
            SELECT up, level, tree, idx // 16 AS r, list(h ORDER BY idx) AS hs FROM every WHERE n > 1 GROUP BY ALL),
        walk AS (
            SELECT tree AS t, idx AS i, false AS up, 0 AS level, tree, idx, n, coalesce(tampered, leaf) AS h, '' AS proof
            FROM leaves
            UNION ALL
            SELECT w.t, w.i, CASE WHEN w.n = 1 THEN true ELSE w.up END, CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
                CASE WHEN w.n = 1 THEN 0 ELSE w.tree END, CASE WHEN w.n = 1 THEN w.tree ELSE w.idx // 16 END,
                CASE WHEN w.n = 1 THEN (SELECT count(DISTINCT tree) FROM leaves) ELSE (w.n + 15) // 16 END,
                CASE WHEN w.n = 1 THEN w.h ELSE sha256(array_to_string(list_concat(list_concat(
                    hs[1:w.idx % 16], [w.h]), hs[w.idx % 16 + 2:]), '')) END,
                CASE WHEN w.n = 1 THEN w.proof ELSE proof || array_to_string(list_concat(
                    hs[1:w.idx % 16], hs[w.idx % 16 + 2:]), '') END
            FROM walk w LEFT JOIN run r ON w.up = r.up AND w.level = r.level AND w.tree = r.tree AND w.idx // 16 = r.r
            WHERE NOT (w.up AND w.n = 1))
        SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root,
            w.h = root.h AS verified
        FROM leaves l JOIN walk w ON l.tree = w.t AND l.idx = w.i AND w.up AND w.n = 1 JOIN upper s ON s.level = 0 AND s.idx = l.tree,
            (SELECT h FROM upper WHERE n = 1) root""",
}
