"""One query for each operator, over the whole of its table, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bsi import top_k_search

    return top_k_search(table(spark, sf_dir, "embeddings"))


OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents")).drop("first")


OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w
), e AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS v FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e AS a JOIN e AS b ON a.v = b.v AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), k AS MATERIALIZED (
  SELECT a, b FROM p UNION SELECT b, a FROM p
), r AS (
  SELECT doc_id AS node, doc_id AS least FROM s
  UNION
  SELECT k.b, r.least FROM r JOIN k ON k.a = r.node AND r.least < k.b
), c AS (
  SELECT node, min(least) AS component_id FROM r GROUP BY node
)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON c.node = s.doc_id
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import bpe_encode

    return bpe_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_model import quality_classifier

    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import warc_round_trip

    return warc_round_trip(table(spark, sf_dir, "pages")).drop("request_id")


OP9 = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY ALL HAVING count(*) > 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.last IS NULL OR g.last = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.last <> p.page_id THEN g.last END AS refers_to
FROM p LEFT JOIN g USING (payload_digest, payload_bytes)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Every run from a line onward (and up to a line) of 50 words, spelled out; a run that also begins earlier goes.
OP10 = r"""
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, i, ls[i] AS line, len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)
), f AS (
  SELECT *, row_number() OVER o AS p, sum(w) OVER o AS c FROM l WHERE w > 0 WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), seq AS (
  SELECT doc_id, list(line ORDER BY p) AS lines FROM f GROUP BY doc_id
), r AS (
  SELECT a.doc_id, a.p AS p, min(b.p) AS e FROM f AS a JOIN f AS b ON a.doc_id = b.doc_id AND b.p >= a.p AND b.c - a.c + a.w >= 50 GROUP BY a.doc_id, a.p
  UNION
  SELECT b.doc_id, max(a.p) AS p, b.p AS e FROM f AS a JOIN f AS b ON a.doc_id = b.doc_id AND b.p >= a.p AND b.c - a.c + a.w >= 50 GROUP BY b.doc_id, b.p
), k AS (
  SELECT r.doc_id, p, e, list_slice(lines, p, e) AS run FROM r JOIN seq USING (doc_id)
), later AS (
  SELECT doc_id, p, e FROM k QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, p) > 1
), gone AS (
  SELECT DISTINCT f.doc_id, f.p, f.i FROM f JOIN later ON f.doc_id = later.doc_id AND f.p BETWEEN later.p AND later.e
), cut AS (
  SELECT doc_id, i FROM gone
  UNION
  SELECT l.doc_id, l.i FROM l JOIN gone AS g ON l.doc_id = g.doc_id AND l.i > g.i JOIN gone AS h ON h.doc_id = g.doc_id AND h.p = g.p + 1 AND l.i < h.i
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text FROM l ANTI JOIN cut ON l.doc_id = cut.doc_id AND l.i = cut.i GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(len(lines), 0) AS n_lines, coalesce(n, 0) AS n_removed
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN seq USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
"""


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_near_dedup

    return simhash_near_dedup(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ball_tree import ranked_search

    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13 = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), b AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL
), len AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
), all_docs AS (
  SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM len
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), q AS (
  SELECT item_id, term, count(*) AS times, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM b JOIN df USING (term), all_docs GROUP BY ALL
), s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nn) // ll))))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN len USING (doc_id), all_docs GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER o AS INT) AS rank, doc_id, score FROM s WHERE score > 0 WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER o <= 20
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op1_top_k": OP1, "op2_near_dedup": OP2, "op9_warc": OP9, "op10_line_dedup": OP10, "op13_ranked_search": OP13}
