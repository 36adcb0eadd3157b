"""Corpus pipeline: language ID, exact dedup, near dedup, decontamination, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``documents``.
Rows are matched by a number that is the same at every reading of that table, so
null and repeated ids are told apart.  Empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlab.llm.decontaminate import find_contamination
from incidentlab.llm.exact_dedup import tree_merge_dedup
from incidentlab.llm.langid import UNDETERMINED, labelled_windows, predict_language, train
from incidentlab.llm.mixing import replicate, source_rates
from incidentlab.llm.ngram_join import ngram_jaccard_join
from incidentlab.llm.textops import fresh, numbered, without_rows
from incidentlab.session import scratch_path, table_path

MIN_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go if no language can be told: no letters, or no language
    with at least MIN_LANGUAGE_SCORE.  The lang column is kept as it is."""
    learn = docs.filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    net = train(*labelled_windows(learn, "lang", "text"))
    if net is None:  # no labelled text at all: nothing can be told, nothing is rejected
        return docs
    scored = predict_language(docs, net)
    return scored.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(
        *docs.columns
    )


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    row = fresh("row", docs.columns)
    rows = numbered(docs, row)
    found = tree_merge_dedup(rows, keep="max", row_col=row)
    return without_rows(rows, found.filter(~F.col("kept")).select(F.col("row").alias(row)), row)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, Jaccard 0.8 or more; of each group of linked
    documents the row with the smallest doc_id stays."""
    row = fresh("row", docs.columns)
    rows = numbered(docs, row)
    found = ngram_jaccard_join(rows, n=5, percent=80, row_col=row)
    return without_rows(rows, found.filter(~F.col("kept")).select(F.col("rid").alias(row)), row)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(table_path(sf_dir, "benchmark"))
    return find_contamination(docs, items).filter(F.size("matches") == 0).drop("matches")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in its drawn number of copies, globally shuffled."""
    return replicate(docs, source_rates(docs))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
]

#: The network and BM25 cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
