"""Shared text helpers: words, 64-bit word hashes, window hashes, chunking.

Words are the runs ``[^\\x20\\x09-\\x0D]+``.  ``bytes.split()`` splits on exactly
that byte set, so the byte form of a text gives the same words.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from incidentlab.session import checkpoint, scratch_path

SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: Everything but ASCII letters, digits and the bytes of non-ASCII characters.
NOT_ALNUM_BYTES = bytes(i for i in range(128) if not chr(i).isalnum())

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_M3 = np.uint64(0x165667B19E3779F9)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_BLOCK = 1 << 18  # bytes hashed at once


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ np.uint64((seed * int(_M1) + seed) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(31))) * _M2
    x = (x ^ (x >> np.uint64(29))) * _M3
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, out=p)


def _join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two adjacent parts."""
    x = a * _M1 + ((b << np.uint64(23)) | (b >> np.uint64(41))) * _M2
    x = (x ^ (x >> np.uint64(32))) * _M3
    return x ^ (x >> np.uint64(29))


def window_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive items of ``w`` (length ``len(w) - k + 1``),
    by doubling: log2(k) vectorised passes."""
    n = len(w) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, length, acc, done = w, 1, None, 0
    left = k
    while left:
        if left & 1:
            part = power[done : done + n]
            acc = mix64(part, 7) if acc is None else _join_hash(acc, part)
            done += length
        left >>= 1
        if left:
            power = _join_hash(power[:-length], power[length:])
            length *= 2
    return acc


class Words:
    """Words of a list of texts as arrays: ``doc`` (text number) and ``hash``
    (64-bit) per word, ``count`` per text; ``lower`` folds A-Z only;
    ``separators`` are the bytes between words (newline included);
    ``prefix[k]`` is the hash of the first k bytes of each word (of the whole
    word where it is shorter)."""

    def __init__(
        self, texts: list[str | None], lower: bool = False, separators: bytes = SPACE_BYTES, prefixes: tuple = ()
    ):
        parts = [(t or "").encode("utf-8", "replace") for t in texts]
        if lower:
            parts = [p.lower() for p in parts]  # bytes.lower folds ASCII only
        size = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
        self.buf = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        table = np.zeros(256, bool)
        table[list(separators)] = True
        space = table[self.buf]
        inner = np.flatnonzero(space[1:] != space[:-1]) + 1 if len(space) else np.empty(0, np.int64)
        edges = np.concatenate([[0], inner]) if len(space) and not space[0] else inner
        self.start, self.end = edges[0::2], edges[1::2]
        offsets = np.cumsum(size)
        self.doc = np.searchsorted(offsets, self.start, "right")
        self.count = np.bincount(self.doc, minlength=len(parts)).astype(np.int64)
        self.hash, *first = self._hash(prefixes)
        self.prefix = dict(zip(prefixes, first))

    def _hash(self, prefixes: tuple) -> list[np.ndarray]:
        """Polynomial hash of each word's bytes and of each asked-for prefix,
        by prefix sums over blocks that fit the processor's cache."""
        ends = [self.end, *(np.minimum(self.start + k, self.end) for k in prefixes)]
        out = [np.empty(len(self.start), np.uint64) for _ in ends]
        letters = mix64(np.arange(256, dtype=np.uint64), 11)
        up = down = np.empty(0, np.uint64)
        i = 0
        while i < len(self.start):
            j = max(i + 1, int(np.searchsorted(self.start, self.start[i] + _BLOCK)))
            a, b = int(self.start[i]), int(self.end[j - 1])
            if b - a > len(up):
                up, down = _powers(_BASE, b - a), _powers(pow(_BASE, -1, 2**64), b - a)
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum(letters[self.buf[a:b]] * up[: b - a], out=total[1:])
            s = self.start[i:j] - a
            for own, end in zip(out, ends):
                e = end[i:j] - a
                own[i:j] = mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _M1, 3)
            i = j
        return out


#: Files whose numbers ``numbered`` looks up by a broadcast join (a long and an int each).
MAX_FILES = 1 << 18

_PLAIN = re.compile(r"^[\s:|+-]*(Relation|Project|Filter|SubqueryAlias|LogicalRelation)\b")


def fresh(name: str, columns) -> str:
    """``name``, with underscores added until no column has it."""
    while name in columns:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a row number ``name`` (long) that is the same at every
    reading, however the files are packed into tasks.

    For a Parquet table, with columns selected or rows filtered, it is the file's
    place in the sorted list of files and the row's place in its file.  Anything
    else (and a table of more than MAX_FILES files) is numbered while it is
    written once to the shared scratch folder, and read from there."""
    plan = docs._jdf.queryExecution().analyzed().toString().strip().splitlines()
    if all(_PLAIN.match(line) for line in plan) and len(docs.inputFiles()) <= MAX_FILES:
        try:
            meta = docs.metadataColumn("_metadata")
            path, at = fresh("__path", docs.columns), fresh("__at", docs.columns)
            own = docs.select("*", meta["file_path"].alias(path), meta["row_index"].alias(at))
        except AnalysisException:  # not Parquet files
            own = None
        if own is not None:
            files = own.agg(F.array_sort(F.collect_set(path)).alias("paths")).select(F.posexplode("paths").alias("k", "path"))
            files = checkpoint(files.select(F.xxhash64("path").alias("f"), F.col("k").cast("long").alias("k")))
            n, hashes = files.agg(F.count("f"), F.count_distinct("f")).first()
            if n <= 1:
                return own.select(*docs.columns, F.col(at).alias(name))
            if n == hashes:
                places = files.select(F.col("f").alias(path), F.col("k").alias(name))
                own = own.withColumn(path, F.xxhash64(path)).join(F.broadcast(places), path)
                return own.select(*docs.columns, (F.col(name) * F.lit(1 << 40) + F.col(at)).alias(name))
    target = scratch_path(docs.sparkSession, "numbered")
    docs.withColumn(name, F.monotonically_increasing_id()).write.parquet(target)
    return docs.sparkSession.read.parquet(target)


def in_chunks(docs: DataFrame, text_col: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """``docs``, which must have a row number ``rid``, with ``gid``, a chunk
    number that spreads rows evenly (it hashes the row number, so equal rows and
    null ids spread as well).  The number of chunks follows the total text size.
    Returns the frame and the total number of bytes."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(1, -(-total // chunk_bytes))
    return docs.withColumn("gid", F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")), total


def without_rows(rows: DataFrame, gone: DataFrame, row_col: str) -> DataFrame:
    """``rows`` (from ``numbered``, with the number in ``row_col``) without those
    whose number is in ``gone``, and without the number.  Rows are matched by
    number, so equal rows and null ids are told apart."""
    return rows.join(gone.select(row_col), row_col, "left_anti").drop(row_col)


def slices(batch: pa.RecordBatch, column: str, rows: int, n_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows and about ``n_bytes`` of the
    text column (a longer text is a slice of its own)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    a = 0
    while a < batch.num_rows:
        before = int(ends[a - 1]) if a else 0
        b = min(a + rows, max(a + 1, int(np.searchsorted(ends, before + n_bytes, "right"))))
        yield batch.slice(a, b - a)
        a = b


def add_text_columns(
    docs: DataFrame, text_col: str, schema: str, start: Callable, rows: int = 500, n_bytes: int = 4 << 20
) -> DataFrame:
    """``docs`` with columns computed from whole texts, in Arrow batches of at
    most ``rows`` texts and about ``n_bytes``; the other columns pass through
    untouched.  Columns of ``docs`` that clash with the new names are replaced.
    ``start()`` runs once per task and returns the function from a list of texts
    (None for null) to one list per new column."""
    new = _parse_datatype_string(schema)
    text = F.col(text_col).cast("string")
    held = fresh("__text", docs.columns)
    kept = docs.select(*[c for c in docs.columns if c not in new.names], text.alias(held))
    types = [to_arrow_type(f.dataType) for f in new]
    fields = [StructField(f.name, f.dataType) for f in kept.schema if f.name != held]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = start()
        for batch in batches:
            for part in slices(batch, held, rows, n_bytes):
                texts = part.column(held).to_pylist()
                added = [pa.array(x, t) for x, t in zip(apply(texts), types)]
                own = [n for n in part.schema.names if n != held]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in own), *added], [*own, *new.names])

    return kept.mapInArrow(run, StructType([*fields, *new.fields]))
