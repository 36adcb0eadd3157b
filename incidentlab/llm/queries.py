"""Registered queries of the training-data operators and their DuckDB SQL.

Each query is thin: it applies its operator to the whole table and derives the
contract's columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlab.llm.decontaminate import find_contamination
from incidentlab.llm.dual_tree import rank_documents
from incidentlab.llm.exact_dedup import tree_merge_dedup
from incidentlab.llm.hard_negatives import mine_hard_negatives
from incidentlab.llm.langid import labelled_windows, predict_language, train
from incidentlab.llm.licenses import scan_licenses
from incidentlab.llm.mixing import replicate, source_rates
from incidentlab.llm.ngram_join import ngram_jaccard_join
from incidentlab.llm.secret_scan import BASE_KINDS, count_kind, findings_by_path, spans_text, update_ledger
from incidentlab.llm.sharding import write_shards
from incidentlab.llm.substring_dedup import cut_repeats
from incidentlab.llm.toxicity import score_toxicity, train_toxicity
from incidentlab.llm.url_filter import judge_urls, train_url_model
from incidentlab.session import scratch_path, table_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(_table(spark, sf_dir, "documents"), window=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
win AS (
  SELECT doc_id, pos, md5(array_to_string(list(word) OVER o, ' ')) AS h, count(*) OVER o AS k
  FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
rep AS (SELECT h FROM win WHERE k = 35 GROUP BY h HAVING count(*) > 1),
hit AS (SELECT doc_id, pos, (k = 35 AND h IN (SELECT h FROM rep))::INT AS r FROM win),
cov AS (
  SELECT doc_id, pos, max(r) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM hit),
g AS (
  SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed,
         sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0), '')) AS kept_sha256
  FROM cov JOIN p USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


def _fold(n: int):
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels")
    model = train_toxicity(docs, labels.filter(_fold(3) != 1))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), train_url_model(spark))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train(*labelled_windows(docs.filter(_fold(5) != 0), "lang", "text"))
    return predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(_fold(5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score"
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (document, benchmark item) that the document holds."""
    found = find_contamination(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # A ledger of its own, so every run of the query is a first run.
    found = findings_by_path(docs, update_ledger(docs, scratch_path(spark, "secret-ledger")))
    findings = F.col("findings")
    return found.select(
        "doc_id",
        *(count_kind(findings, k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(spans_text(findings, BASE_KINDS), 256).alias("base_sha256"),
        spans_text(findings).alias("spans"),
    )


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return replicate(docs, source_rates(docs))


OP7_SQL = """
WITH RECURSIVE sizes AS (SELECT source, sum(length(text))::DOUBLE AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, pow(size, 0.7) / (SELECT sum(pow(size, 0.7)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate
  FROM sizes),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM rates
  UNION ALL
  SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM cdf WHERE k < 150),
draws AS (
  SELECT *, ('0x' || substr(sha256('copies:0:1:' || doc_id), 1, 13))::BIGINT / pow(2, 52) AS u FROM documents),
counted AS (
  SELECT d.doc_id, (SELECT count(*) FROM cdf c WHERE c.source = d.source AND c.total <= d.u)::INT AS n_copies
  FROM draws d)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::INT AS copy, c.n_copies,
       substr(sha256('shuffle:0:' || c.copy || ':' || d.doc_id), 1, 16) AS shuffle_key
FROM documents d JOIN (SELECT doc_id, n_copies, unnest(range(1, n_copies + 1)) AS copy FROM counted) c USING (doc_id)
"""


def op8_tree_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_merge_dedup(_table(spark, sf_dir, "documents"), keep="max").drop("row")


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_jaccard_join(_table(spark, sf_dir, "documents"), n=3, percent=90)
    return joined.select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
p AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
g AS (
  SELECT doc_id, n, pos, array_to_string(list(word) OVER o, ' ') AS gram
  FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
s AS (SELECT DISTINCT doc_id, gram FROM g WHERE pos <= greatest(n - 3, 0)),
c AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
i AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM i JOIN c cx ON cx.doc_id = x JOIN c cy ON cy.doc_id = y
  WHERE 100 * i.k >= 90 * (cx.k + cy.k - i.k)),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT l.y, r.root FROM reach r JOIN link l ON l.x = r.doc_id)
SELECT d.doc_id, coalesce(c.k, 0) AS n_shingles, r.root AS component_id
FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id) r USING (doc_id)
"""


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of notices, the distinct licences in alphabetical
    order, and all notices as licence:start:end in order."""
    found = scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_notices"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.col("matches.license")))).alias("licenses"),
        F.concat_ws(",", spans).alias("spans"),
    )


def op11_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written shards, read back; the law is ``rows``."""
    path = scratch_path(spark, "shards")
    write_shards(_table(spark, sf_dir, "documents"), path, shards=8)
    text = F.coalesce("text", F.lit(""))
    return spark.read.parquet(path).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
t AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM t GROUP BY ALL),
df AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
  FROM tf, s GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), s GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(
        _table(spark, sf_dir, "embeddings"), label=label, is_anchor=F.col("vec_id") % 100 == 0, scale=256
    )


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, OP1_SQL),
    "op2_toxicity": (op2_toxicity, None),
    "op3_url_filter": (op3_url_filter, None),
    "op4_language_id": (op4_language_id, None),
    "op5_decontaminate": (op5_decontaminate, None),
    "op6_secret_scan": (op6_secret_scan, None),
    "op7_poisson_mix": (op7_poisson_mix, OP7_SQL),
    "op8_tree_merge_dedup": (op8_tree_merge_dedup, OP8_SQL),
    "op9_ngram_join": (op9_ngram_join, OP9_SQL),
    "op10_license_scan": (op10_license_scan, None),
    "op11_two_pass_shuffle": (op11_two_pass_shuffle, None),
    "op12_dual_tree_search": (op12_dual_tree_search, OP12_SQL),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
