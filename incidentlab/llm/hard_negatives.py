"""Hard-negative mining by Strassen products and mergeable heaps.

Vectors become integers, ``floor(scale * x)``; the score of a row for an anchor
is their exact integer inner product.  Anchors and candidates are dealt into
blocks by their row number, and every pair of an anchor block and a candidate
block is a tile: one task multiplies it by Strassen's recursion on int64 arrays
padded with zeros, and reduces the scores to heaps at once.  Heaps of different
tiles merge by taking the first entries of their union.

1. Tiles of rows whose labels share a hash bucket: per anchor a heap of the
   first ``n_positives`` rows of its label.
2. All tiles, the anchors now with their positives: per (anchor, positive) a
   heap of the first ``n_negatives`` rows of other labels whose score lies in
   the positive's window, ``low`` % to 100 % of its score.

A block of either kind has a bounded number of rows and is sent once to each
block of the other kind; heaps are all that leaves a tile.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; a shorter vector is padded with zeros; components
beyond +-2^31 after scaling are cut to it, and products wrap at 64 bits.
Scores that tie are ordered by the smaller id.  Rows with the anchor's id are
not its positives; repeated rows are candidates, and anchors, one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentlab.llm.textops import fresh, numbered
from incidentlab.session import checkpoint, scratch_path

ANCHOR_BLOCK = 512
CANDIDATE_BLOCK = 4096
LABEL_BUCKETS = 16
LEAST = 8  # sides at which the recursion stops halving
_EDGE = 1 << 31


def _levels(*sides: int) -> int:
    """Halvings until the smallest side is at LEAST."""
    return max(0, (min(sides) // LEAST).bit_length() - 1) if min(sides) else 0


def _padded(x: np.ndarray, unit: int) -> np.ndarray:
    rows, cols = (-(-n // unit) * unit for n in x.shape)
    if (rows, cols) == x.shape:
        return x
    out = np.zeros((rows, cols), np.int64)
    out[: x.shape[0], : x.shape[1]] = x
    return out


def _product(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    n, d, m = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:n, :d], a[:n, d:], a[n:, :d], a[n:, d:]
    b11, b12, b21, b22 = b[:d, :m], b[:d, m:], b[d:, :m], b[d:, m:]
    m1 = _product(a11 + a22, b11 + b22, levels - 1)
    m2 = _product(a21 + a22, b11, levels - 1)
    m3 = _product(a11, b12 - b22, levels - 1)
    m4 = _product(a22, b21 - b11, levels - 1)
    m5 = _product(a11 + a12, b22, levels - 1)
    m6 = _product(a21 - a11, b11 + b12, levels - 1)
    m7 = _product(a12 - a22, b21 + b22, levels - 1)
    out = np.empty((2 * n, 2 * m), np.int64)
    out[:n, :m] = m1 + m4 - m5 + m7
    out[:n, m:] = m3 + m5
    out[n:, :m] = m2 + m4
    out[n:, m:] = m1 - m2 + m3 + m6
    return out


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact product of int64 matrices (modulo 2^64, as int64 adds)."""
    levels = _levels(*a.shape, b.shape[1])
    unit = 1 << levels
    return _product(_padded(a, unit), _padded(b, unit), levels)[: a.shape[0], : b.shape[1]]


def first_of(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` entries by score, highest first, then id."""
    place = np.arange(len(score))
    if len(score) > k:
        place = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return place[np.lexsort((ids[place], -score[place]))[:k]]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _scores(anchors: pa.Table, rows: pa.Table) -> np.ndarray:
    width = max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max()) for t in (anchors, rows))
    return strassen(_matrix(anchors["v"], width), np.ascontiguousarray(_matrix(rows["v"], width).T))


def _long(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().astype(np.int64)


POSITIVES = "row long, anchor_id long, positive_id long, positive_score long"
NEGATIVES = "row long, anchor_id long, positive_id long, place int, negative_id long, positive_score long, negative_score long"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names))


def _positive_heaps(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    found = []
    if len(anchors) and len(rows):
        scores, ids, labels = _scores(anchors, rows), _long(rows, "id"), _long(rows, "label")
        for i, (row, own, label) in enumerate(zip(*(_long(anchors, c).tolist() for c in ("row", "id", "label")))):
            may = np.flatnonzero((labels == label) & (ids != own))
            for j in may[first_of(scores[i, may], ids[may], k)].tolist():
                found.append((row, own, int(ids[j]), int(scores[i, j])))
    return _table(found, POSITIVES)


def _negative_heaps(anchors: pa.Table, rows: pa.Table, k: int, low: int) -> pa.Table:
    found = []
    if len(anchors) and len(rows):
        scores, ids, labels = _scores(anchors, rows), _long(rows, "id"), _long(rows, "label")
        own_positives = zip(anchors["positives"].to_pylist(), *(_long(anchors, c).tolist() for c in ("row", "id", "label")))
        for i, (positives, row, own, label) in enumerate(own_positives):
            floor = min(low * p["score"] for p in positives)
            top = max(100 * p["score"] for p in positives)
            may = np.flatnonzero((100 * scores[i] >= floor) & (100 * scores[i] <= top) & (labels != label))
            score, other = scores[i, may], ids[may]
            for place, p in enumerate(positives):
                inside = np.flatnonzero((100 * score >= low * p["score"]) & (100 * score <= 100 * p["score"]))
                for j in inside[first_of(score[inside], other[inside], k)].tolist():
                    found.append((row, own, p["id"], place, int(other[j]), p["score"], int(score[j])))
    return _table(found, NEGATIVES)


def _tiles(anchors: DataFrame, rows: DataFrame, bucket: Column, heaps, schema: str) -> DataFrame:
    """``heaps(anchors, candidates)`` of every tile.  Both frames have ``row``;
    blocks are numbered within the buckets, whose sizes are counted first."""
    anchors, rows = anchors.withColumn("bucket", bucket), rows.withColumn("bucket", bucket)

    def blocks(frame: DataFrame, size: int) -> dict[int, int]:
        return {r["bucket"]: -(-r["count"] // size) for r in frame.groupBy("bucket").count().collect()}

    n_a, n_c = blocks(anchors, ANCHOR_BLOCK), blocks(rows, CANDIDATE_BLOCK)
    both = sorted(n_a.keys() & n_c.keys())
    if not both:
        return anchors.sparkSession.createDataFrame([], schema)

    def count(n: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*(F.lit(x) for b in both for x in (b, n[b]))), F.col("bucket"))

    def dealt(frame: DataFrame, own: dict, other: dict, names: tuple[str, str]) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), count(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), count(other) - 1))
        return frame.filter(F.col("bucket").isin(both)).withColumn(names[0], block).withColumn(names[1], every)

    tile = ["bucket", "a", "c"]
    left = dealt(anchors, n_a, n_c, ("a", "c")).groupBy(*tile)
    right = dealt(rows, n_c, n_a, ("c", "a")).groupBy(*tile)
    return left.cogroup(right).applyInArrow(lambda a, c: heaps(a, c), schema)


def _merged(heaps: DataFrame, by: list[str], score: str, ids: str, k: int) -> DataFrame:
    """The first ``k`` entries of each heap, over all tiles, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), ids)
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine_hard_negatives(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    is_anchor: Column | None = None,
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 5,
    low: int = 80,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.  ``label`` (a whole number) and ``is_anchor`` are
    expressions over ``rows``; by default the column ``label`` and all rows."""
    label = F.col("label") if label is None else label
    is_anchor = F.lit(True) if is_anchor is None else is_anchor
    row = fresh("__row", rows.columns)
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    known = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(_EDGE)), F.lit(-_EDGE)))
    used = numbered(rows, row).select(
        F.col(row).alias("row"),
        F.col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"),
        is_anchor.alias("anchor"),
        F.when(known, whole).alias("v"),
    )
    path = scratch_path(rows.sparkSession, "vectors")
    used.dropna(subset=["id", "label", "v"]).write.parquet(path)
    used = rows.sparkSession.read.parquet(path)
    anchors = used.filter("anchor").drop("anchor")
    used = used.drop("anchor")

    same_label = F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int")
    heaps = _tiles(anchors, used, same_label, lambda a, c: _positive_heaps(a, c, n_positives), POSITIVES)
    found = _merged(heaps, ["row", "anchor_id"], "positive_score", "positive_id", n_positives)
    entry = F.struct("rank", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    found = found.groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("positives"))  # at most n_positives
    paired = checkpoint(anchors.join(found, "row"))

    heaps = _tiles(paired, used, F.lit(0), lambda a, c: _negative_heaps(a, c, n_negatives, low), NEGATIVES)
    out = _merged(heaps, ["row", "place"], "negative_score", "negative_id", n_negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
