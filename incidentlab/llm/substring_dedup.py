"""Substring dedup with a count-min prefilter.

Every window of ``window`` consecutive words that occurs more than once in the
corpus (in one document or several) is cut out of all its occurrences.

Pass 1 adds up partial count-min sketches of the window hashes (see
``sketch.py``); the merged counts are never too small.  Pass 2 groups exactly
(96-bit hashes of the word sequence) only the windows whose estimate is two or
more, so no repeated window is lost and unrepeated ones drop out early.  Texts
are shuffled once: the three readings of a chunk share one exchange.

Defined results: a null text has no words and gives an empty kept text; a text
with fewer words than the window keeps all of them; rows with equal or null
ids are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.llm.sketch import (
    ANSWER_SCHEMA,
    PART_SCHEMA,
    empty_parts,
    estimates,
    exact_counts,
    merge_exact,
    merge_sketches,
    n_shards,
    partial_exact,
    partial_sketches,
)
from incidentlab.llm.textops import Words, in_chunks, mix64, window_hashes

OUT_SCHEMA = "doc_id string, n_words long, n_removed long, kept_text string"


def _windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word of each window that lies in one document, and its hash."""
    h = window_hashes(words.hash, k)
    start = np.flatnonzero(words.doc[: len(h)] == words.doc[k - 1 :]) if len(h) else np.empty(0, np.int64)
    return start, h[start]


def _second(words: Words, k: int, start: np.ndarray) -> np.ndarray:
    """Independent 32-bit hash of the windows at ``start``."""
    h = window_hashes(mix64(words.hash, 29), k)
    return (h[start] >> np.uint64(32)).astype(np.uint32)


def cut_repeats(
    docs: DataFrame,
    window: int = 35,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = 4 << 20,
) -> DataFrame:
    """Per input row: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``
    (the remaining words, joined by one space)."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # One plan reads the chunks, so their numbers need not outlive it.
    chunks, n_bytes = in_chunks(rows.withColumn("rid", F.monotonically_increasing_id()), "text", chunk_bytes)
    chunks = chunks.select("gid", "doc_id", "text")
    shards = n_shards(n_bytes // 5)  # no more windows than words

    def sketch_chunk(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, h = _windows(Words(pdf["text"].tolist()), window)
        return partial_sketches(key[0], h, shards)

    def candidates(words: Words, answers: pd.DataFrame):
        start, h = _windows(words, window)
        keep = estimates(h, answers, shards) >= 2 if len(h) else np.empty(0, bool)
        start, h = start[keep], h[keep]
        return start, h, _second(words, window, start)

    def settle_chunk(key: tuple, pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return empty_parts()
        _, hi, lo = candidates(Words(pdf["text"].tolist()), answers)
        return partial_exact(key[0], hi, lo, shards)

    def cut_chunk(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts = pdf["text"].tolist()
        words = Words(texts)
        start, hi, lo = candidates(words, answers)
        start = start[exact_counts(hi, lo, answers) >= 2]
        cover = np.zeros(len(words.doc) + 1, np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + window, -1)
        removed = np.cumsum(cover)[:-1] > 0
        n_removed = np.bincount(words.doc[removed], minlength=len(texts))
        ends = np.cumsum(words.count)
        kept = []
        for i, t in enumerate(texts):
            own = (t or "").encode("utf-8", "replace").split()
            if n_removed[i]:
                flags = removed[ends[i] - words.count[i] : ends[i]]
                own = [w for w, gone in zip(own, flags.tolist()) if not gone]
            kept.append(b" ".join(own).decode("utf-8"))
        return pd.DataFrame(
            {"doc_id": pdf["doc_id"], "n_words": words.count, "n_removed": n_removed, "kept_text": kept}
        )

    parts = chunks.groupBy("gid").applyInPandas(sketch_chunk, PART_SCHEMA)
    merged = parts.groupBy("shard", "level").applyInPandas(merge_sketches, ANSWER_SCHEMA)
    unsettled = (
        chunks.groupBy("gid").cogroup(merged.groupBy("gid")).applyInPandas(settle_chunk, PART_SCHEMA)
    )
    exact = unsettled.groupBy("shard").applyInPandas(merge_exact, ANSWER_SCHEMA)
    answers = merged.unionByName(exact)
    cut = chunks.groupBy("gid").cogroup(answers.groupBy("gid")).applyInPandas(cut_chunk, OUT_SCHEMA)
    return cut.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
