"""Distributed count-min sketch over keys that live in document chunks.

Nothing is broadcast or collected.  The hash space is cut into shards of a
fixed number of cells; the number of shards follows the number of keys, so the
overestimate stays the same at every input size.

1. every chunk writes one partial sketch per (shard, sketch row): its occupied
   cells, sorted and gap-coded, with their counts (``partial_sketches``);
2. one task per (shard, row) adds them up and answers each partial sketch with
   the merged counts of the cells it sent, in the same order (``merge_sketches``);
3. the chunk reads the answers back in its own cell order (``estimates``).

Counts saturate at 255.  ``partial_exact`` / ``merge_exact`` / ``exact_counts``
do the same for 96-bit keys without collisions of cells, for the keys that a
chunk still has to settle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from incidentlab.llm.textops import mix64

CELL_BITS = 24
CELLS = 1 << CELL_BITS
KEYS_PER_SHARD = CELLS // 4
DEPTH = 2

PART_SCHEMA = "gid int, shard int, level int, cells binary, counts binary"
ANSWER_SCHEMA = "gid int, shard int, level int, counts binary"
EXACT_LEVEL = DEPTH  # level number of the exact answers


def n_shards(keys: int) -> int:
    return max(1, -(-keys // KEYS_PER_SHARD))


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Monotone in the key, so sorted keys are sorted by shard."""
    return ((keys >> np.uint64(40)) * np.uint64(shards)) >> np.uint64(24)


def _cells(keys: np.ndarray, row: int, shards: int) -> np.ndarray:
    cell = mix64(keys, 101 + row) & np.uint64(CELLS - 1)
    return (_shard(keys, shards) << np.uint64(CELL_BITS)) | cell


def _planes(x: np.ndarray) -> bytes:
    """Little-endian integers as byte planes: small gaps leave zero planes,
    which the shuffle's compression removes."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _split(shard_sorted: np.ndarray):
    cut = np.flatnonzero(np.diff(shard_sorted)) + 1
    bounds = [0, *cut.tolist(), len(shard_sorted)]
    return [(int(shard_sorted[a]), a, b) for a, b in zip(bounds, bounds[1:]) if b > a]


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def empty_parts() -> pd.DataFrame:
    return _frame([], PART_SCHEMA)


def partial_sketches(gid: int, keys: np.ndarray, shards: int) -> pd.DataFrame:
    rows = []
    for row in range(DEPTH):
        cells, counts = np.unique(_cells(keys, row, shards), return_counts=True)
        counts = np.minimum(counts, 255).astype(np.uint8)
        for shard, a, b in _split(cells >> np.uint64(CELL_BITS)):
            own = (cells[a:b] & np.uint64(CELLS - 1)).astype(np.uint32)
            gaps = np.diff(own, prepend=np.uint32(0)).astype(np.uint32)
            rows.append((gid, shard, row, _planes(gaps), counts[a:b].tobytes()))
    return _frame(rows, PART_SCHEMA)


def merge_sketches(pdf: pd.DataFrame) -> pd.DataFrame:
    """One (shard, row): add the partial sketches, answer each of them."""
    table = np.zeros(CELLS, np.uint8)
    where = [np.cumsum(_unplanes(b, np.uint32), dtype=np.int64) for b in pdf["cells"]]
    for idx, c in zip(where, pdf["counts"]):
        add = table[idx].astype(np.uint16) + np.frombuffer(c, np.uint8)
        table[idx] = np.minimum(add, 255)
    return pd.DataFrame(
        {"gid": pdf["gid"], "shard": pdf["shard"], "level": pdf["level"], "counts": [table[i].tobytes() for i in where]}
    )


def _answers(answers: pd.DataFrame, level: int) -> np.ndarray:
    own = answers[answers["level"] == level].sort_values("shard")
    return np.frombuffer(b"".join(own["counts"]), np.uint8)


def estimates(keys: np.ndarray, answers: pd.DataFrame, shards: int) -> np.ndarray:
    """Count-min estimate (never below the true count, up to 255) per key."""
    est = np.full(len(keys), 255, np.uint8)
    for row in range(DEPTH):
        _, where = np.unique(_cells(keys, row, shards), return_inverse=True)
        est = np.minimum(est, _answers(answers, row)[where])
    return est


def _distinct(hi: np.ndarray, lo: np.ndarray):
    """Sorted distinct (hi, lo): positions of firsts in sorted order, the order,
    and the number of the distinct key for each sorted position."""
    order = np.lexsort((lo, hi))
    h, l = hi[order], lo[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def partial_exact(gid: int, hi: np.ndarray, lo: np.ndarray, shards: int) -> pd.DataFrame:
    """Distinct (64-bit hi, 32-bit lo) keys of a chunk with their counts."""
    rows = []
    if len(hi):
        order, first, _ = _distinct(hi, lo)
        h, l = hi[order][first], lo[order][first]
        counts = np.minimum(np.diff(np.append(first, len(hi))), 255).astype(np.uint8)
        for shard, a, b in _split(_shard(h, shards)):
            rows.append((gid, shard, EXACT_LEVEL, h[a:b].tobytes() + l[a:b].tobytes(), counts[a:b].tobytes()))
    return _frame(rows, PART_SCHEMA)


def merge_exact(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard: exact totals of the 96-bit keys, an answer for each part."""
    sizes = [len(c) for c in pdf["counts"]]
    hi = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(pdf["cells"], sizes)])
    lo = np.concatenate([np.frombuffer(b, np.uint32, n, 8 * n) for b, n in zip(pdf["cells"], sizes)])
    counts = np.frombuffer(b"".join(pdf["counts"]), np.uint8).astype(np.int64)
    order, first, group = _distinct(hi, lo)
    totals = np.minimum(np.add.reduceat(counts[order], first), 255).astype(np.uint8)
    out = np.empty(len(hi), np.uint8)
    out[order] = totals[group]
    ends = np.cumsum(sizes)
    return pd.DataFrame(
        {
            "gid": pdf["gid"],
            "shard": pdf["shard"],
            "level": pdf["level"],
            "counts": [out[e - n : e].tobytes() for e, n in zip(ends, sizes)],
        }
    )


def exact_counts(hi: np.ndarray, lo: np.ndarray, answers: pd.DataFrame) -> np.ndarray:
    """Total count over all chunks (up to 255) of each key of a chunk."""
    if not len(hi):
        return np.empty(0, np.uint8)
    order, _, group = _distinct(hi, lo)
    out = np.empty(len(hi), np.uint8)
    out[order] = _answers(answers, EXACT_LEVEL)[group]
    return out
