"""Benchmark decontamination: BM25 retrieval with block-max WAND, then overlap.

Test items are cut into segments of at most ``SEGMENT`` words; the segments form
an inverted index whose posting lists carry a maximum per block.  Every passage
of every document (``PASSAGE`` words, every ``STRIDE`` words) is a query and
retrieves all segments that reach ``share`` of their own best score.  Postings
are stored divided by that score, so one threshold of 1 holds for all segments.
The bounds are applied from coarse to fine, the first ones for all passages of a
batch at once: block maxima of the terms that occur in few blocks plus the list
maxima of the others; then block maxima of all terms; then WAND with its pivots
inside the blocks that can reach 1.  No passage and no retrieved item is dropped
or capped.

The question (all but the last sentence) makes segments of its own in the same
index, so other words may stand between it and the answer: a passage that reaches
``share`` of the best score of any segment retrieves its item.  An item that no
passage retrieves is not looked at.

A retrieved item is verified against the whole document: its question part
by word 5-gram containment, its answer part by the
words of the passage and its neighbours; a match needs both at ``overlap`` or
more, or the 5-grams of the whole item at ``overlap`` or more.

The items are cut into blocks of about ``BLOCK_WORDS`` words and ``BLOCK_ITEMS``
items at most (a longer item is a block of its own), so that an index has a
bounded size, linear in its words.  Document frequencies and the mean length are
those of all items, so blocks do not change the scores.  The indexes of the blocks
are built once, in Spark, and sent to the executors packed; a task unpacks one after
another for each slice of its texts, so many blocks take one pass over the documents
and one index in memory at a time.  Packed indexes of more than ``PASS_BYTES`` in
all (well over 10,000 items) take several passes, whose matches are written and
joined by a row number that is the same at every reading.

Defined results: null and empty texts and items match nothing; items that have
the same text are all reported; rows with equal or null ids are judged one by
one.  Item ids keep their type.  Words are runs of letters and digits, A-Z folded.
"""

from __future__ import annotations

import pickle
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.llm.textops import NOT_ALNUM_BYTES, Words, add_text_columns, fresh, numbered, window_hashes
from incidentlab.session import checkpoint, scratch_path

SEGMENT = 32
PASSAGE = 64
STRIDE = 32
GRAM = 5
POSTING_BLOCK = 4
BLOCK_ITEMS = 1_000
BLOCK_WORDS = 200_000
PASS_BYTES = 64 << 20  # packed indexes broadcast for one pass
CELLS = 1 << 24  # (passage, block) sums held at once
K1, B = 1.2, 0.75
LIMIT = 1 - 1e-9  # the threshold of 1, less rounding

MATCHES = "array<struct<item_id:{},score:double,question:double,answer:double,overlap:double>>"

_LAST = re.compile(r"(?s)^(.*?[.!?\n])\s*([^.!?\n]*\w[^.!?\n]*[.!?\s]*)$")


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; a single sentence is cut in the middle."""
    if m := _LAST.match(text):
        if re.search(r"\w", m.group(1)):
            return m.group(1), m.group(2)
    words = text.split()
    half = (len(words) + 1) // 2
    return " ".join(words[:half]), " ".join(words[half:])


def _words(texts: list[str | None]) -> Words:
    return Words(texts, lower=True, separators=NOT_ALNUM_BYTES)


def _grams(h: np.ndarray) -> np.ndarray:
    """Distinct word 5-grams; a shorter sequence is one gram."""
    return np.unique(window_hashes(h, min(GRAM, len(h)))) if len(h) else np.empty(0, np.uint64)


def _segments(h: np.ndarray) -> list[np.ndarray]:
    return np.array_split(h, -(-len(h) // SEGMENT)) if len(h) else []


@dataclass
class Statistics:
    """Document frequencies (of the segments of whole items) and lengths over all items."""

    vocabulary: np.ndarray  # sorted
    df: np.ndarray
    segments: int
    words: int

    @staticmethod
    def of(segments: list[np.ndarray]) -> Statistics:
        own = [np.unique(s) for s in segments]
        vocabulary, df = np.unique(np.concatenate(own) if own else np.empty(0, np.uint64), return_counts=True)
        return Statistics(vocabulary, df, len(segments), sum(len(s) for s in segments))

    def weights(self, terms: np.ndarray, tf: np.ndarray, length: int) -> np.ndarray:
        """BM25 parts of the terms of a segment."""
        place = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
        df = np.where(self.vocabulary[place] == terms, self.df[place], 0)
        idf = np.log1p((self.segments - df + 0.5) / (df + 0.5))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / (self.words / self.segments)))


@dataclass
class Item:
    item_id: object
    question: np.ndarray  # distinct 5-grams
    answer: np.ndarray  # distinct words
    whole: np.ndarray  # distinct 5-grams
    gram: tuple[int, int]  # words per gram of question and whole


class Index:
    """Segments of a block of items as block-max posting lists; ``stats`` are
    those of all items (of the given ones if left out)."""

    def __init__(self, items: list[tuple], share: float, stats: Statistics | None = None):
        self.items: list[Item] = []
        segments, plain, self.segment_item = [], [], []
        for item_id, text in items:
            h = _words([text]).hash
            if not len(h):
                continue
            q, a = (_words([t]).hash for t in question_and_answer(text))
            self.items.append(
                Item(
                    item_id,
                    _grams(q),
                    np.unique(a),
                    _grams(h),
                    (min(GRAM, max(len(q), 1)), min(GRAM, len(h))),
                )
            )
            whole = _segments(h)
            plain.extend(whole)
            for part in [*whole, *(_segments(q) if len(a) else [])]:
                segments.append(part)
                self.segment_item.append(len(self.items) - 1)
        # Segments of like length share blocks: their common words weigh alike,
        # which keeps the block maxima close to the scores.
        order = sorted(range(len(segments)), key=lambda k: len(segments[k]))
        segments = [segments[k] for k in order]
        self.segment_item = [self.segment_item[k] for k in order]
        self.vocabulary = np.unique(np.concatenate(segments)) if segments else np.empty(0, np.uint64)
        postings: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        self.stats = stats = stats or Statistics.of(plain)
        for s, part in enumerate(segments):
            terms, tf = np.unique(part, return_counts=True)
            score = stats.weights(terms, tf, len(part))
            for t, c in zip(np.searchsorted(self.vocabulary, terms).tolist(), score / (share * score.sum())):
                postings[t].append((s, float(c)))
        self.segment = [[s for s, _ in p] for p in postings]
        self.score = [[c for _, c in p] for p in postings]
        # Blocks are ranges of POSTING_BLOCK segments, the same for all lists;
        # a row per term holds the blocks it occurs in and its maxima there.
        self.n_blocks = n_blocks = -(-len(segments) // POSTING_BLOCK)
        self.block_max: list[dict[int, float]] = []
        for p in postings:
            row: dict[int, float] = {}
            for s, c in p:
                row[s // POSTING_BLOCK] = max(row.get(s // POSTING_BLOCK, 0.0), c)
            self.block_max.append(row)
        many = np.array([len(row) for row in self.block_max], np.int64)
        self.top = np.array([max(row.values()) for row in self.block_max], np.float64)
        self.block_of = np.array([b for row in self.block_max for b in row], np.int64)
        self.max_of = np.array([m for row in self.block_max for m in row.values()], np.float64)
        self.row_at = np.concatenate([[0], np.cumsum(many)]).astype(np.int64)
        # Terms of few blocks, as sparse rows of their own.
        self.common = many * 4 > n_blocks
        rare = np.repeat(~self.common, many)
        self.rare_block, self.rare_max = self.block_of[rare], self.max_of[rare]
        self.rare_at = np.concatenate([[0], np.cumsum(np.where(self.common, 0, many))]).astype(np.int64)

    def packed(self) -> bytes:
        """The fields as plain lists and arrays, compressed: the package is not
        installed on the executors, so its classes cannot be unpickled by name."""
        items = [vars(i) for i in self.items]
        return zlib.compress(pickle.dumps(vars(self) | {"items": items, "stats": None}, pickle.HIGHEST_PROTOCOL), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Index:
        index = cls.__new__(cls)
        index.__dict__.update(pickle.loads(zlib.decompress(data)))
        index.items = [Item(**i) for i in index.items]
        return index

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """Sum of the terms' maxima in every block."""
        many = self.row_at[terms + 1] - self.row_at[terms]
        place = np.repeat(self.row_at[terms] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return np.bincount(self.block_of[place], self.max_of[place], self.n_blocks)

    def wand(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """All (segment, score) of a block with a score of at least 1, by WAND
        with the block's maxima."""
        end = (block + 1) * POSTING_BLOCK
        bound = {t: self.block_max[t].get(block, 0.0) + 1e-7 for t in terms}
        lists = []  # current segment, term, place in its list
        for t in terms:
            place = bisect_left(self.segment[t], block * POSTING_BLOCK)
            if place < len(self.segment[t]) and self.segment[t][place] < end:
                lists.append([self.segment[t][place], t, place])
        out = []

        def seek(cursor: list, segment: int) -> None:
            own = self.segment[cursor[1]]
            cursor[2] = bisect_left(own, segment, cursor[2])
            cursor[0] = own[cursor[2]] if cursor[2] < len(own) else end

        while True:
            lists = sorted(c for c in lists if c[0] < end)
            total, pivot = 0.0, -1
            for i, c in enumerate(lists):
                total += bound[c[1]]
                if total >= LIMIT:
                    pivot = i
                    break
            if pivot < 0:
                return out
            segment = lists[pivot][0]
            if lists[0][0] == segment:
                score = 0.0
                for c in lists:
                    if c[0] == segment:
                        score += self.score[c[1]][c[2]]
                        seek(c, segment + 1)
                if score >= LIMIT:
                    out.append((segment, score))
            else:
                for c in lists[:pivot]:
                    if c[0] < segment:
                        seek(c, segment)

    def retrieve(self, term: np.ndarray, known: np.ndarray, start: np.ndarray, stop: np.ndarray):
        """(passage, segment, score) of all passages: ``term`` and ``known``
        per word, word ranges per passage."""
        step = max(1, CELLS // max(self.n_blocks, 1))
        return [
            (a + i, segment, score)
            for a in range(0, len(start), step)
            for i, segment, score in self._retrieve(term, known, start[a : a + step], stop[a : a + step])
        ]

    def _retrieve(self, term: np.ndarray, known: np.ndarray, start: np.ndarray, stop: np.ndarray):
        size = stop - start
        word = np.repeat((start - (np.cumsum(size) - size)).astype(np.int32), size) + np.arange(size.sum(), dtype=np.int32)
        own = known[word]
        vocabulary, n = len(self.vocabulary), len(start)
        key = np.repeat(np.arange(n, dtype=np.int64), size)[own] * vocabulary + term[word[own]]
        key = np.sort(key.astype(np.int32) if n * vocabulary < 2**31 else key)
        key = key[np.diff(key, prepend=-1) > 0]  # distinct terms of each passage
        passage, terms = np.divmod(key, vocabulary)
        common = np.bincount(passage, np.where(self.common[terms], self.top[terms], 0.0), n)
        many = self.rare_at[terms + 1] - self.rare_at[terms]
        place = np.repeat(self.rare_at[terms] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        n_blocks = self.n_blocks
        cell = np.repeat(passage.astype(np.int64) * n_blocks, many) + self.rare_block[place]
        rare = np.bincount(cell, self.rare_max[place], n * n_blocks).reshape(n, n_blocks).max(axis=1, initial=0.0)
        found = []
        at = np.searchsorted(passage, np.arange(n + 1))
        for i in np.flatnonzero(common + rare >= 1 - 1e-4).tolist():
            own_terms = terms[at[i] : at[i + 1]]
            for block in np.flatnonzero(self.bounds(own_terms) >= 1 - 1e-4).tolist():
                found.extend((i, segment, score) for segment, score in self.wand(own_terms.tolist(), block))
        return found

    def match(self, texts: list[str | None], share: float, overlap: float) -> list[list[dict]]:
        words = _words(texts)
        out: list[list[dict]] = [[] for _ in texts]
        if not len(words.hash) or not len(self.vocabulary):
            return out
        term = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        known = self.vocabulary[term] == words.hash
        ends = np.cumsum(words.count)
        first = ends - words.count
        # Passage starts of all texts: 0, STRIDE, ... until one reaches the end.
        n = np.where(words.count > 0, 1 + -(-np.maximum(words.count - PASSAGE, 0) // STRIDE), 0)
        doc = np.repeat(np.arange(len(texts)), n)
        start = first[doc] + STRIDE * (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n))
        stop = np.minimum(start + PASSAGE, ends[doc])
        found: dict[tuple[int, int], tuple[float, list]] = {}
        for k, segment, score in self.retrieve(term, known, start, stop):
            d, i = int(doc[k]), self.segment_item[segment]
            best, places = found.get((d, i), (0.0, []))
            found[d, i] = (max(best, score), [*places, (int(start[k]), int(stop[k]))])
        for (d, i), (score, places) in sorted(found.items()):
            item, own = self.items[i], words.hash[first[d] : ends[d]]
            near = np.concatenate(
                [words.hash[max(first[d], a - PASSAGE) : min(ends[d], b + PASSAGE)] for a, b in places]
            )
            q = np.isin(item.question, window_hashes(own, item.gram[0])).mean() if len(item.question) else 1.0
            a = np.isin(item.answer, near).mean() if len(item.answer) else 1.0
            whole = np.isin(item.whole, window_hashes(own, item.gram[1])).mean()
            if (q >= overlap and a >= overlap) or whole >= overlap:
                out[d].append(
                    {
                        "item_id": item.item_id,
                        "score": share * score,
                        "question": float(q),
                        "answer": float(a),
                        "overlap": float(whole),
                    }
                )
        return out


def _blocks(items: DataFrame, block_items: int, block_words: int) -> tuple[DataFrame, list[int]]:
    """``items`` (checkpointed) with their ``block``, and the block numbers.
    Blocks are runs of items in the order of the partitions."""

    def size(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(words=_words(pdf["text"].tolist()).count)

    sized = items.mapInPandas(size, "item_id string, text string, words long").filter("words > 0")
    sized = checkpoint(sized.withColumn("part", F.spark_partition_id()))
    sums = sized.groupBy("part").agg(F.count("*").alias("n"), F.sum("words").alias("words")).orderBy("part").collect()
    before, n, words = {}, 0, 0
    for r in sums:
        before[r["part"]] = n, words
        n, words = n + r["n"], words + r["words"]
    # A block is a pair of (items // block_items, words // block_words), as one number.
    scale = words // block_words + 1

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, tuple[int, int]] = {}
        for pdf in batches:
            out = []
            for part, own in zip(pdf["part"], pdf["words"]):
                a, b = seen.get(part) or before[part]
                out.append(a // block_items * scale + b // block_words)
                seen[part] = a + 1, b + own
            yield pdf[["item_id", "text"]].assign(block=out)

    dealt = checkpoint(sized.mapInPandas(deal, "item_id string, text string, block long"))
    return dealt, [r["block"] for r in dealt.select("block").distinct().orderBy("block").collect()]


def _statistics(dealt: DataFrame) -> tuple[DataFrame, int, int]:
    """(block, term, df) with the document frequencies over all items, the
    number of segments and their words."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, text in zip(pdf["block"], pdf["text"]):
                parts = _segments(_words([text]).hash)
                terms, df = np.unique(np.concatenate([np.unique(p) for p in parts]), return_counts=True)
                yield pd.DataFrame({"block": block, "term": terms.view(np.int64), "df": df})
                # Under block -1: the number of segments and of words.
                total = [len(parts), sum(len(p) for p in parts)]
                yield pd.DataFrame({"block": -1, "term": [0, 1], "df": total})

    counted = dealt.mapInPandas(count, "block long, term long, df long").groupBy("block", "term").agg(F.sum("df").alias("df"))
    counted = checkpoint(counted)
    total = {r["term"]: r["df"] for r in counted.filter("block = -1").collect()}
    own = counted.filter("block >= 0")
    df = own.groupBy("term").agg(F.sum("df").alias("df"))
    return checkpoint(own.select("block", "term").join(df, "term")), total[0], total[1]


def _in_order(pdf: pd.DataFrame) -> list[tuple]:
    return sorted(zip(pdf["item_id"], pdf["text"]), key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def _packed(dealt: DataFrame, share: float) -> DataFrame:
    """(block, size, packed): the index of every block, pickled and compressed."""
    terms, n, words = _statistics(dealt)

    def build(items: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        vocabulary = found["term"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(vocabulary)
        stats = Statistics(vocabulary[order], found["df"].to_numpy(np.int64)[order], n, words)
        packed = Index(_in_order(items), share, stats).packed()
        return pd.DataFrame({"block": items["block"].head(1), "size": len(packed), "packed": [packed]})

    both = dealt.groupBy("block").cogroup(terms.groupBy("block"))
    return checkpoint(both.applyInPandas(build, "block long, size long, packed binary"))


def _passes(sizes: list[tuple[int, int]], pass_bytes: int) -> list[list[int]]:
    """Block numbers in runs of at most ``pass_bytes`` (a larger one alone)."""
    runs: list[list[int]] = []
    held = 0
    for block, size in sizes:
        if not runs or held + size > pass_bytes:
            runs.append([])
            held = 0
        runs[-1].append(block)
        held += size
    return runs


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    share: float = 0.6,
    overlap: float = 0.8,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    text_col: str = "text",
    block_items: int = BLOCK_ITEMS,
    block_words: int = BLOCK_WORDS,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``docs`` with ``matches`` added: the items that a document holds, with
    the best BM25 share and the overlaps of question, answer and whole item."""
    # Inside the operator an id is a string, which any number of digits survives.
    own = items.select(*(F.col(c).cast("string").alias(a) for c, a in ((item_id_col, "item_id"), (item_text_col, "text"))))
    schema, result = MATCHES.format("string"), MATCHES.format(items.schema[item_id_col].dataType.simpleString())

    def finished(frame: DataFrame) -> DataFrame:
        return frame.withColumn("matches", F.array_sort(F.col("matches").cast(result)))

    dealt, blocks = _blocks(own, block_items, block_words)
    if len(blocks) < 2:
        rows = [tuple(r) for r in dealt.select("item_id", "text").orderBy("item_id", "text").collect()]

        def start_one():
            index = Index(rows, share)
            return lambda texts: [index.match(texts, share, overlap)]

        return finished(add_text_columns(docs, text_col, f"matches {schema}", start_one))

    packed = _packed(dealt, share)
    spark = docs.sparkSession

    def searched(frame: DataFrame, run: list[int]) -> DataFrame:
        held = packed.filter(F.col("block").between(run[0], run[-1])).orderBy("block").select("packed")
        sent = spark.sparkContext.broadcast([bytes(r["packed"]) for r in held.collect()])

        def start_many():
            def apply(texts):
                found: list[list[dict]] = [[] for _ in texts]
                for part in sent.value:
                    index = Index.unpacked(part)
                    for old, new in zip(found, index.match(texts, share, overlap)):
                        old.extend(new)
                return [found]

            return apply

        return add_text_columns(frame, text_col, f"matches {schema}", start_many)

    runs = _passes([tuple(r) for r in packed.select("block", "size").orderBy("block").collect()], pass_bytes)
    if len(runs) == 1:
        return finished(searched(docs, runs[0]))
    row = fresh("__row", docs.columns)
    rows = numbered(docs, row)
    path = scratch_path(spark, "contamination")
    for i, run in enumerate(runs):
        hits = searched(rows.select(row, text_col), run).filter(F.size("matches") > 0)
        hits.select(row, "matches").write.parquet(f"{path}/run={i}")
    hits = spark.read.parquet(*[f"{path}/run={i}" for i in range(len(runs))])
    hits = hits.groupBy(row).agg(F.flatten(F.collect_list("matches")).alias("matches"))
    out = rows.drop("matches").join(hits, row, "left").drop(row)
    return finished(out.withColumn("matches", F.coalesce("matches", F.array().cast(schema))))
