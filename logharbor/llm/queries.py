"""Registered queries of this subpackage, each over the whole of its table, and the statements that check them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from logharbor.llm import (
    best_fit, cutting_stock, exact_dedup, html_text, jaccard_join, lexical_search, pii, secrets, sentencepiece, toxicity, vector_dedup,
    warc, whitening)
from logharbor.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_VOCABULARY = (
    public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_pii_semi_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_spans(docs, pii.train(docs))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(F.expr(pii.written("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(pii.written("spans")).alias("spans"),
    )


@query
def op2_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}") for kind in secrets.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(F.expr(pii.written("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(pii.written("spans")).alias("spans"),
    )


@query
def op3_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op3_embedding_neighbours"] = """
WITH RECURSIVE e AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.v, b.v) >= 0.98),
r(vec_id, near) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.near = l.a),
c AS (SELECT vec_id, min(near) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)"""


@query
def op4_sentencepiece_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentencepiece.digests(docs, sentencepiece.load(public_tokenizers.path("piece_bpe_32k.model")))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op5_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""


@query
def op6_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


@query
def op8_shingle_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_texts(table(spark, sf_dir, "documents"), width=4, percent=85)


ORACLES["op8_shingle_jaccard"] = """
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4 THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
                                          WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
r(doc_id, near) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.near = l.a),
c AS (SELECT doc_id, min(near) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)"""


@query
def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("target_uri")


ORACLES["op9_warc_dictionary"] = """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS response FROM d),
b AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || hex[5 * i + 1:5 * i + 5] AS BIGINT)) AS parts FROM f)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(parts, lambda v: concat(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v >> 15) % 32 + 1], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v >> 10) % 32 + 1],
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v >> 5) % 32 + 1], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v % 32 + 1])), '') AS payload_digest,
       CASE WHEN response < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response < page_id THEN response END AS refers_to
FROM b"""


@query
def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).withColumn("spans", F.expr("array_join(transform(spans, s -> concat(s.start, ':', s.end)), ',')"))


@query
def op11_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting_stock.pack(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


@query
def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_dual_tree_search"] = """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
f AS (SELECT doc_id, term, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, s GROUP BY term, docs),
i AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)) AS u FROM f JOIN d USING (doc_id), s),
r AS (SELECT item_id, doc_id, CAST(sum(w * u) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN i USING (term) GROUP BY item_id, doc_id),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50"""


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
