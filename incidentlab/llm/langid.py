"""Language identification with a byte convolutional network.

The network embeds bytes, convolves fixed-length windows with filters of
several widths, takes the maximum of every filter over the window and ends in a
softmax over the learned languages.  It is trained in numpy (Adam) on windows
of a bounded sample of labelled texts; prediction cuts every whole text into
fixed-length windows, scores them in batches inside the tasks and averages the
window probabilities, weighted by their number of text bytes.

Defined results: ``und`` with score 0 where the text is null, empty or holds no
letter, or where there was nothing to learn from; rows with null labels are
never learned from; equal or null ids do not matter (one row out per row in).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.llm.textops import add_text_columns

UNDETERMINED = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
MAX_TRAIN_DOCS = 6000  # bound of the fitting sample, spread evenly over the languages
WINDOWS_PER_DOC = 6


def has_letter(text: str) -> bool:
    """Whether a character is of one of Unicode's letter categories (L*); number
    forms such as superscripts, fractions and Roman numerals are not."""
    return any(map(str.isalpha, text))


@dataclass
class ByteCNN:
    languages: list[str]
    embed: np.ndarray  # (256, EMBED)
    filters: list[np.ndarray]  # per width: (width, EMBED, FILTERS)
    bias: np.ndarray  # all filters
    dense: np.ndarray  # (all filters, languages)
    dense_bias: np.ndarray


def cut_windows(text: bytes) -> np.ndarray:
    """All windows of a text, the last one padded with zero bytes."""
    n = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def labelled_windows(docs: DataFrame, lang_col: str, text_col: str, max_docs: int = MAX_TRAIN_DOCS):
    """Labels and windows of the fitting sample: of each language an equal
    share of ``max_docs`` different texts by hash of the text, and of each text
    at most WINDOWS_PER_DOC windows spread over the whole text."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    different = rows.select("lang", F.xxhash64(F.lit("langid"), "text")).distinct()
    counts = {r["lang"]: r["count"] for r in different.groupBy("lang").count().orderBy("lang").collect()}
    if not counts:
        return [], np.empty((0, WINDOW), np.uint8)
    share = max(1, max_docs // len(counts))
    draw = F.pmod(F.xxhash64(F.lit("langid"), "text"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.element_at(F.create_map(*[F.lit(x) for k, c in counts.items() for x in (k, share / c)]), F.col("lang"))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for lang, text, place in zip(pdf["lang"], pdf["text"], pdf["place"]):
                if has_letter(text):
                    own = cut_windows(text.encode("utf-8", "replace"))
                    at = np.unique(np.linspace(0, len(own) - 1, min(len(own), WINDOWS_PER_DOC)).astype(int))
                    out.extend((lang, own[i].tobytes(), place) for i in at)
            yield pd.DataFrame(out, columns=["lang", "window", "place"])

    drawn = rows.filter(draw < rate).distinct().withColumn("place", draw / rate)
    sample = drawn.mapInPandas(windows, "lang string, window binary, place double")
    sample = sample.orderBy("place", "lang", "window").limit(2 * max_docs * WINDOWS_PER_DOC)
    found = sample.toPandas().sort_values(["lang", "window"])
    data = np.frombuffer(b"".join(found["window"]), np.uint8).reshape(-1, WINDOW)
    return found["lang"].tolist(), data


def _forward(net: ByteCNN, x: np.ndarray):
    """Pooled filter outputs (before and after the rectifier) and the position of each maximum."""
    e = net.embed[x]
    pooled, where = [], []
    for width, w in zip(WIDTHS, net.filters):
        n = x.shape[1] - width + 1
        patches = np.concatenate([e[:, k : k + n] for k in range(width)], axis=2)
        out = patches.reshape(-1, width * EMBED) @ w.reshape(width * EMBED, -1)
        out = out.reshape(len(x), n, -1)
        at = out.argmax(axis=1)
        where.append(at)
        pooled.append(np.take_along_axis(out, at[:, None, :], 1)[:, 0])
    return np.concatenate(pooled, 1) + net.bias, where


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(labels: list[str], data: np.ndarray, steps: int = 1200, batch: int = 128, seed: int = 0) -> ByteCNN | None:
    """Fits the network in ``steps`` batches (passes over a shuffled sample, as
    many as that takes); None without labelled windows."""
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    weight = (len(y) / (len(languages) * np.bincount(y)))[y]
    total = len(WIDTHS) * FILTERS
    net = ByteCNN(
        languages,
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        [rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32),
        rng.normal(0, 1 / np.sqrt(total), (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    params = [net.embed, *net.filters, net.bias, net.dense, net.dense_bias]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    while step < steps:
        order = rng.permutation(len(y))
        for a in range(0, len(y), batch):
            own = order[a : a + batch]
            x = data[own]
            z, where = _forward(net, x)
            h = np.maximum(z, 0)
            p = _softmax(h @ net.dense + net.dense_bias)
            g = p.copy()
            g[np.arange(len(own)), y[own]] -= 1
            g = (g * weight[own, None] / len(own)).astype(np.float32)
            gh = (g @ net.dense.T) * (z > 0)
            grads = [np.zeros_like(net.embed)]
            for i, (width, w) in enumerate(zip(WIDTHS, net.filters)):
                gi = gh[:, i * FILTERS : (i + 1) * FILTERS]
                gw = np.empty_like(w)
                for k in range(width):
                    byte = np.take_along_axis(x, where[i] + k, 1)  # the byte under tap k of each maximum
                    gw[k] = np.einsum("bfe,bf->ef", net.embed[byte], gi)
                    np.add.at(grads[0], byte, gi[:, :, None] * w[k].T[None])
                grads.append(gw)
            grads += [gh.sum(0), h.T @ g, g.sum(0)]
            step += 1
            for q, gq, mq, vq in zip(params, grads, m, v):
                mq *= 0.9
                mq += 0.1 * gq
                vq *= 0.999
                vq += 0.001 * gq * gq
                q -= 0.004 * (mq / (1 - 0.9**step)) / (np.sqrt(vq / (1 - 0.999**step)) + 1e-8)
    return net


class Scorer:
    """Window probabilities of a trained network.  On bytes a filter is a sum
    of table rows, so taps are looked up in pairs instead of multiplied."""

    def __init__(self, net: ByteCNN):
        self.net = net
        taps = [[net.embed @ w[k] for k in range(len(w))] for w in net.filters]
        self.tables = [
            [
                (k, 2, (t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1)) if k + 1 < len(t) else (k, 1, t[k])
                for k in range(0, len(t), 2)
            ]
            for t in taps
        ]

    def probabilities(self, windows: np.ndarray, rows: int = 512) -> np.ndarray:
        out = [np.empty((0, len(self.net.languages)), np.float32)]
        for a in range(0, len(windows), rows):
            x = windows[a : a + rows].astype(np.int32)
            pair = x[:, :-1] * 256 + x[:, 1:]
            pooled = []
            for width, tables in zip(WIDTHS, self.tables):
                n = x.shape[1] - width + 1
                total = None
                for k, taps, table in tables:
                    part = table[(pair if taps == 2 else x)[:, k : k + n]]
                    total = part if total is None else np.add(total, part, out=total)
                pooled.append(total.max(axis=1))
            h = np.maximum(np.concatenate(pooled, 1) + self.net.bias, 0)
            out.append(_softmax(h @ self.net.dense + self.net.dense_bias))
        return np.concatenate(out)


def identify(scorer: Scorer | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of whole texts."""
    lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    own = [i for i, t in enumerate(texts) if scorer is not None and t is not None and has_letter(t)]
    if own:
        raw = [texts[i].encode("utf-8", "replace") for i in own]
        cuts = [cut_windows(r) for r in raw]
        count = np.array([len(c) for c in cuts])
        windows = np.concatenate(cuts)
        p = scorer.probabilities(windows).astype(np.float64)
        size = np.full(len(windows), WINDOW, np.float64)
        last = np.cumsum(count) - 1
        size[last] = [len(r) - (c - 1) * WINDOW for r, c in zip(raw, count)]
        first = np.cumsum(count) - count
        mean = np.add.reduceat(p * size[:, None], first, axis=0) / np.add.reduceat(size, first)[:, None]
        best = mean.argmax(axis=1)
        for i, b, m in zip(own, best, mean):
            lang[i], score[i] = scorer.net.languages[b], min(1.0, float(m[b]))
    return lang, score


def predict_language(docs: DataFrame, net: ByteCNN | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added (any such columns are replaced)."""

    def start():
        scorer = Scorer(net) if net is not None else None
        return lambda texts: identify(scorer, texts)

    return add_text_columns(docs, text_col, "lang_pred string, score double", start)
