"""Ranked lexical search: the best documents of every item, by dual trees.

The score of a document for an item is a sum over the item's terms (repeats
included) of  weight(term) * part(tf, length),  in 64-bit integers:

    weight = floor(1000 ln((2N + 2) / (2 df + 1)))
    m      = 100 - 25 + (25 n N) div L
    part   = (1000000000 tf) div (1000 tf + 12 m)

with N documents that have a term, L terms in all and n in the document.

One pass over the documents counts N, L and the document frequencies of the
items' terms, and names for each item a few likely documents per task.  Their
exact scores give every item a floor under its k-th best score.  The second pass
searches.  The items and, slice by slice, the documents are leaves of two trees
whose nodes hold the maximum of every coordinate (weight times repeats; part)
over the leaves below.  The product of two nodes' maxima bounds all scores of
the pair; it is dropped with all its pairs when the bound is below the weakest
k-th score of the items under the node, which grows while the search runs.  What
remains is split, down to single items and documents, whose product is the
score.  Nothing is dropped that could be among the first k, ties included.

Tasks send at most k documents an item; they are ranked in Spark.  Items are
searched in blocks of about ``block_bytes`` of text, one pair of passes each, so
what the tasks and the driver hold is bounded.

Terms are runs of ASCII letters and digits and of non-ASCII characters, A-Z
folded, compared by 64-bit hashes.  Defined results: null and empty texts have no
term and are never found, items without a term find nothing; equal scores go by
ascending id, null ids last; repeated rows are found one by one, and repeated
items answered one by one.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from incidentlab.llm.textops import NOT_ALNUM_BYTES, Words, numbered, slices
from incidentlab.session import scratch_path

BLOCK_BYTES = 12 << 20
SLICE_ROWS = 2000
SLICE_BYTES = 8 << 20
ITEM_FAN, DOC_FAN = 4, 8
LIKELY = 4  # documents a task names per item for the floors

#: What the first pass finds: a total (kind 0: N and L), a document frequency
#: (kind 1: term) or a likely document (kind 2: item; its length and tf).
FOUND = "kind int, key long, value long, tf binary"


def _words(texts: list[str | None]) -> Words:
    return Words(texts, lower=True, separators=NOT_ALNUM_BYTES)


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges start .. start + size one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Items:
    """A block of items: sorted vocabulary, and per item its distinct terms
    (vocabulary numbers, ascending) and their repeats."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        words = _words([t for _, t in rows])
        self.vocabulary, term = np.unique(words.hash, return_inverse=True)
        width = max(len(self.vocabulary), 1)
        key, self.repeats = np.unique(words.doc * width + term, return_counts=True)
        item, self.term = np.divmod(key, width)
        own, item = np.unique(item, return_inverse=True)  # items without terms leave
        self.number = np.array([n for n, _ in rows], np.int64)[own]
        self.at = np.searchsorted(item, np.arange(len(own) + 1))

    def postings(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, tf) of the items' terms, sorted."""
        width = max(len(self.vocabulary), 1)
        place = np.minimum(np.searchsorted(self.vocabulary, words.hash), width - 1)
        known = self.vocabulary[place] == words.hash if len(self.vocabulary) else np.zeros(len(place), bool)
        key, tf = np.unique(words.doc[known] * width + place[known], return_counts=True)
        doc, term = np.divmod(key, width)
        return doc, term, tf.astype(np.int64)


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def parts(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    m = 75 + 25 * length * n // max(total, 1)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _by_heaviest(leaf: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Order of the leaves by their heaviest term, so neighbours are alike."""
    order = np.lexsort((value, leaf))
    last = np.flatnonzero(np.diff(leaf[order], append=-1) != 0)
    heaviest = np.full(n, -1, np.int64)
    heaviest[leaf[order][last]] = term[order][last]
    return np.argsort(heaviest, kind="stable")


class Tree:
    """Levels of nodes over leaves 0 .. n - 1, leaves first; node k of a level
    stands over nodes k * fan .. of the level below.  A level holds (first entry
    of each node, term, maximum)."""

    def __init__(self, leaf: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, fan: int, width: int):
        self.levels, self.sizes = [], []
        while True:
            key = leaf * width + term
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            value = np.maximum.reduceat(value[order], first) if len(first) else value[:0]
            leaf, term = np.divmod(key[first], width)
            self.levels.append((np.searchsorted(leaf, np.arange(n + 1)), term, value))
            self.sizes.append(n)
            if n <= 1:
                return
            leaf, n = leaf // fan, -(-n // fan)

    def children(self, level: int, nodes: np.ndarray, fan: int) -> np.ndarray:
        below = (nodes[:, None] * fan + np.arange(fan)).ravel()
        return below[below < self.sizes[level - 1]]


class Search:
    """The items' tree and their best documents so far."""

    def __init__(self, items: Items, weight: np.ndarray, k: int, floors: dict[int, int]):
        self.items, self.weight, self.k, self.width = items, weight, k, max(len(weight), 1)
        n = len(items.number)
        size = np.diff(items.at)
        item, value = np.repeat(np.arange(n), size), items.repeats * weight[items.term]
        self.order = _by_heaviest(item, items.term, value, n)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        self.tree = Tree(place[item], items.term, value, n, ITEM_FAN, self.width)
        self.best: list[list[tuple]] = [[] for _ in range(n)]
        self.least = [np.array([floors.get(int(items.number[i]), 1) for i in self.order], np.int64)]  # scores over 0 only
        for _ in self.tree.sizes[1:]:
            self.least.append(np.minimum.reduceat(self.least[-1], np.arange(0, len(self.least[-1]), ITEM_FAN)))
        self.buffer = np.zeros(self.width, np.int64)
        self.bounded = 0  # pairs of nodes that were bounded

    def _bounds(self, level: int, nodes: np.ndarray) -> np.ndarray:
        at, term, value = self.tree.levels[level]
        size = at[nodes + 1] - at[nodes]
        place = _places(at[nodes], size)
        self.bounded += len(nodes)
        return np.add.reduceat(self.buffer[term[place]] * value[place], np.cumsum(size) - size)

    def _put(self, item: int, score: int, key: tuple) -> None:
        own = self.best[item]
        insort(own, (-score, *key))
        if len(own) > self.k:
            own.pop()
        if len(own) == self.k and -own[-1][0] > self.least[0][item]:
            self.least[0][item] = -own[-1][0]
            for low, high in zip(self.least, self.least[1:]):
                item //= ITEM_FAN
                high[item] = low[item * ITEM_FAN : (item + 1) * ITEM_FAN].min()

    def add(self, keys: list[tuple], doc: np.ndarray, term: np.ndarray, part: np.ndarray) -> None:
        """Searches a slice: a sort key per document and its postings."""
        if not len(doc) or not len(self.items.number):
            return
        order = _by_heaviest(doc, term, part * self.weight[term], len(keys))
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        docs = Tree(place[doc], term, part, len(keys), DOC_FAN, self.width)
        top = len(self.tree.sizes) - 1
        stack = [(len(docs.sizes) - 1, 0, top, np.arange(self.tree.sizes[top]))]
        while stack:
            level, node, i, nodes = stack.pop()
            at, terms, values = docs.levels[level]
            own = slice(at[node], at[node + 1])
            self.buffer[terms[own]] = values[own]
            while True:
                bound = self._bounds(i, nodes)
                may = bound >= self.least[i][nodes]
                nodes = nodes[may]
                if not len(nodes) or i <= min(level, top):
                    break
                nodes, i = self.tree.children(i, nodes, ITEM_FAN), i - 1
            self.buffer[terms[own]] = 0
            if level and len(nodes):
                below = np.arange(node * DOC_FAN, min((node + 1) * DOC_FAN, docs.sizes[level - 1]))
                stack.extend((level - 1, int(n), i, nodes) for n in below)
            elif len(nodes):
                for item, score in zip(nodes.tolist(), bound[may].tolist()):
                    self._put(item, score, keys[order[node]])

    def found(self) -> Iterator[tuple[int, object, int]]:
        """(item number, document id, score)."""
        for place, own in enumerate(self.best):
            for score, _, doc_id in own:
                yield int(self.items.number[self.order[place]]), doc_id, -score


def _likely(items: Items, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n: int) -> Iterator[tuple[int, int, bytes]]:
    """(item, document, tf of the item's terms) of likely documents, weighed by
    the slice's own document frequencies."""
    weight = np.log((2 * n + 2) / (2 * np.bincount(term, minlength=len(items.vocabulary)) + 1))
    buffer, at = np.zeros(len(items.vocabulary)), np.searchsorted(doc, np.arange(n + 1))
    scores = np.zeros((n, len(items.number)))
    for d in np.flatnonzero(np.diff(at)).tolist():
        own = slice(at[d], at[d + 1])
        buffer[term[own]] = weight[term[own]]
        scores[d] = np.add.reduceat(buffer[items.term], items.at[:-1])
        buffer[term[own]] = 0
    for i in range(len(items.number)):
        for d in np.argsort(-scores[:, i], kind="stable")[:LIKELY].tolist():
            if scores[d, i] > 0:
                own, wanted = slice(at[d], at[d + 1]), items.term[items.at[i] : items.at[i + 1]]
                place = np.minimum(np.searchsorted(term[own], wanted), at[d + 1] - at[d] - 1)
                yield i, d, np.where(term[own][place] == wanted, tf[own][place], 0).astype(np.int64).tobytes()


def _first_pass(texts: DataFrame, items: Items) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        df = np.zeros(len(items.vocabulary), np.int64)
        rows: list[tuple] = []
        for batch in batches:
            for part in slices(batch, "text", SLICE_ROWS, SLICE_BYTES):
                words = _words(part.column("text").to_pylist())
                doc, term, tf = items.postings(words)
                df += np.bincount(term, minlength=len(df))
                if not n and len(doc):  # the task's first slice with a term
                    for i, d, own in _likely(items, doc, term, tf, len(words.count)):
                        rows.append((2, int(items.number[i]), int(words.count[d]), own))
                n, total = n + int((words.count > 0).sum()), total + int(words.count.sum())
        rows += [(0, 0, n, None), (0, 1, total, None)]
        rows += [(1, t, int(df[t]), None) for t in np.flatnonzero(df).tolist()]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["kind", "key", "value", "tf"]
        )

    return texts.mapInArrow(run, FOUND)


def _floors(found: DataFrame, items: Items, weight: np.ndarray, n: int, total: int, k: int) -> dict[int, int]:
    """Per item number the k-th best exact score of its likely documents."""
    place = {int(x): i for i, x in enumerate(items.number)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, length = batch.column("key").to_pylist(), batch.column("value").to_numpy()
            out = []
            for number, size, tf in zip(item, length, batch.column("tf").to_pylist()):
                own = slice(items.at[place[number]], items.at[place[number] + 1])
                part = parts(np.frombuffer(tf, np.int64), size, n, total)
                out.append(int((weight[items.term[own]] * items.repeats[own] * part).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.int64())], ["item", "score"])

    scored = found.filter("kind = 2").select("key", "value", "tf").mapInArrow(score, "item long, score long")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"))))
    return {r["item"]: max(r["score"], 1) for r in ranked.filter(F.col("rank") == k).collect()}


def _search_block(docs: DataFrame, rows: list[tuple[int, str | None]], k: int, path: str) -> None:
    items = Items(rows)
    first = f"{path}-first"
    _first_pass(docs.select("text"), items).write.parquet(first)
    found = docs.sparkSession.read.parquet(first)
    sums = found.filter("kind < 2").groupBy("kind", "key").agg(F.sum("value").alias("value")).collect()
    counted = {r["key"]: r["value"] for r in sums if r["kind"] == 0}
    n, total = counted.get(0, 0), counted.get(1, 0)
    df = np.zeros(len(items.vocabulary), np.int64)
    for r in sums:
        if r["kind"] == 1:
            df[r["key"]] = r["value"]
    weight = weights(n, df)
    floors = _floors(found, items, weight, n, total, k)
    id_type = docs.schema["doc_id"]
    kinds = (pa.int64(), to_arrow_type(id_type.dataType), pa.int64())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Search(items, weight, k, floors)
        for batch in batches:
            for part in slices(batch, "text", SLICE_ROWS, SLICE_BYTES):
                words = _words(part.column("text").to_pylist())
                doc, term, tf = items.postings(words)
                keys = [(i is None, i) for i in part.column("doc_id").to_pylist()]
                own.add(keys, doc, term, parts(tf, words.count[doc], n, total))
        if rows := list(own.found()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["item", "doc_id", "score"]
            )

    schema = StructType([StructField("item", LongType()), id_type, StructField("score", LongType())])
    docs.select("doc_id", "text").mapInArrow(search, schema).write.parquet(path)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of each item with
    the highest scores over 0 (all, if fewer), rank 1 first."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = numbered(
        items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")), "item"
    )
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    path = scratch_path(spark, "dual-tree")
    for b in range(blocks):  # each block bounded by block_bytes (a longer item is alone too long)
        of_block = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "text")
        _search_block(own, [tuple(r) for r in of_block.collect()], k, f"{path}/block-{b}")
    found = spark.read.parquet(*[f"{path}/block-{b}" for b in range(blocks)])
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
