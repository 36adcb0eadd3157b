"""Toxicity scoring with a counterfactually regularised linear classifier.

Logistic regression on the presence of words (letters and digits, A-Z folded)
and of word beginnings of 3 to 9 bytes, the latter also by whether two or three
different words share them: they catch families of derived words.  Features
that do not go with label 1 in the sample (``SCREEN`` standard deviations) are
left out.  A counterfactual penalty is added to the loss: in every labelled
sentence that names an identity term, the term is swapped for each other term of
its set, both sentences are turned into features, and the squared change of the
sentence's score (on the logit scale) is penalised.  The model therefore cannot
use which group is mentioned, and neutral mentions are not flagged.

Besides the given sets, terms are learned from the labelled texts: words that
carry a feature which passed the screen although label 0 names them as well
(``NEUTRAL`` times as often as label 1, or more).  Each is swapped for the word
without such a feature that stands between the same neighbours most often.

It is fitted on a bounded sample of labelled ids (``max_rows``, half of each
label as far as there are so many, the smallest hashes of the id).  An id counts
once per label, with one of its texts.  Features are counted and screened and
equal swaps are counted in Spark; the driver receives the sample's screened
features and the different changes that swaps make to them.
Scoring runs over whole texts in the tasks.

Defined results: null and empty texts get the score of a text without known
words; labels without a document, documents without a label and null labels are
not learned from; without labels of both kinds the score is the share of label
1 (0 without any label).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.llm.textops import NOT_ALNUM_BYTES, Words, add_text_columns, mix64
from incidentlab.session import checkpoint

MAX_ROWS = 8_000  # bound of the fitting sample
MIN_DOCS = 3  # a feature must occur in so many sampled documents
SCREEN = 4.0
NEUTRAL = 0.25
PREFIXES = tuple(range(3, 10))
SHARED = (1, 2, 3)  # numbers of different words that share a beginning

#: Sets of interchangeable identity terms (single words, lower case).
IDENTITY_TERMS = (
    ("people", "women", "men", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "immigrants",
     "refugees", "gays", "lesbians", "blacks", "whites", "asians", "latinos"),
    ("person", "woman", "man", "christian", "muslim", "jew", "hindu", "buddhist", "atheist", "immigrant", "refugee",
     "lesbian", "transgender", "disabled"),
    ("personnes", "femmes", "hommes", "chrétiens", "musulmans", "juifs", "immigrés", "réfugiés", "homosexuels"),
    ("menschen", "frauen", "männer", "christen", "muslime", "juden", "einwanderer", "flüchtlinge", "homosexuelle"),
    ("personas", "mujeres", "hombres", "cristianos", "musulmanes", "judíos", "inmigrantes", "refugiados", "gais"),
)

_SENTENCE = re.compile(r"[.!?\n]+")


@dataclass
class ToxicityModel:
    words: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float
    swaps: int = 0  # swapped sentences whose features changed


def _distinct(doc: np.ndarray, *h: np.ndarray) -> list[np.ndarray]:
    """Distinct rows, sorted by text number first."""
    order = np.lexsort((*h[::-1], doc))
    rows = [x[order] for x in (doc, *h)]
    new = np.ones(len(doc), bool)
    if len(doc):
        new[1:] = np.any([x[1:] != x[:-1] for x in rows], axis=0)
    return [x[new] for x in rows]


def _features(texts: list[str | None], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs, of known features only if given."""
    words = Words(texts, lower=True, separators=NOT_ALNUM_BYTES, prefixes=PREFIXES)
    length = words.end - words.start

    def is_known(h: np.ndarray) -> np.ndarray:
        if known is None or not len(known):
            return np.full(len(h), known is None)
        return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h

    own = is_known(words.hash)
    parts = [(words.doc[own], words.hash[own])]
    for k in PREFIXES:
        longer = np.flatnonzero(length > k)
        doc, word, start = words.doc[longer], words.hash[longer], mix64(words.prefix[k][longer], 100 + k)
        if known is not None:  # any of the features of this beginning
            own = np.any([is_known(mix64(start, 200 + n)) for n in SHARED], axis=0)
            doc, word, start = doc[own], word[own], start[own]
        doc, start, _ = _distinct(doc, start, word)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(doc)))
        for n in SHARED:
            at = first[many >= n]
            h = mix64(start[at], 200 + n)
            own = is_known(h)
            parts.append((doc[at][own], h[own]))
    doc, h = (np.concatenate(x) for x in zip(*parts))
    return tuple(_distinct(doc, h))


def substitutes(terms: tuple = IDENTITY_TERMS, learned: dict | None = None) -> dict[str, list[str]]:
    """The words that each term is swapped for."""
    return (learned or {}) | {t: [o for o in g if o != t] for g in terms for t in g}


def swaps(text: str, others: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(sentence, counterfactual sentence) for each swap in a text, lower case."""
    found = []
    for sentence in _SENTENCE.split(text.lower()):
        parts = re.split(r"(\w+)", sentence)  # words at the odd places
        named = set(parts[1::2])
        for term in sorted(named & others.keys()):
            for other in others[term]:
                if other not in named:
                    found.append((sentence, "".join(other if x == term else x for x in parts)))
    return found


def _changes(pairs: list[tuple[str, str]], known: np.ndarray) -> list[tuple[bytes, bytes]]:
    """(features lost, features gained) of the swaps that change any."""
    doc, h = _features([s for pair in pairs for s in pair], known)
    at = np.searchsorted(doc, np.arange(2 * len(pairs) + 1))
    own = [h[a:b] for a, b in zip(at, at[1:])]
    found = [(np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in zip(own[::2], own[1::2])]
    return [(lost.tobytes(), gained.tobytes()) for lost, gained in found if len(lost) or len(gained)]


def learned_terms(rows: DataFrame, screened: np.ndarray, min_docs: int = MIN_DOCS) -> dict[str, list[str]]:
    """Word -> its substitute, from ``rows`` (label, text).  Mentions are counted
    by neighbours, equal neighbours once a text; ties go to the greater word."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    # Neighbours as one string (words hold no space), which a hash set makes distinct.
    inner = F.expr(
        "array_distinct(transform(sequence(2, size(w) - 1), i -> concat_ws(' ', w[i - 2], w[i - 1], w[i])))"
    )
    seen = rows.select("label", words.alias("w")).filter(F.size("w") >= 3).select("label", F.explode(inner).alias("m"))
    placed = seen.groupBy("m").agg(
        F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")
    )
    part = F.split("m", " ")
    placed = placed.select(
        part[1].alias("word"), part[0].alias("before"), part[2].alias("after"), "n0", "n1"
    )
    placed = checkpoint(placed)
    total = placed.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    if not total["n0"] or not total["n1"]:
        return {}
    neutral = placed.groupBy("word").agg(F.sum("n0").alias("m0"), F.sum("n1").alias("m1"))
    neutral = neutral.filter(
        (F.col("m0") >= min_docs) & (F.col("m0") / total["n0"] >= NEUTRAL * F.col("m1") / total["n1"])
    )

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            doc, _ = _features(pdf["word"].tolist(), screened)
            yield pdf[["word", "m0"]].assign(telling=np.bincount(doc, minlength=len(pdf)) > 0)

    told = checkpoint(neutral.mapInPandas(tell, "word string, m0 long, telling boolean"))
    places = placed.filter("n0 > 0").select("word", "before", "after").join(told, "word")
    plain = places.filter("NOT telling").groupBy("before", "after").agg(F.max(F.struct("m0", "word")).alias("best"))
    pairs = places.filter("telling").join(plain, ["before", "after"]).groupBy("word", "best").count()
    pairs = pairs.groupBy("word").agg(F.max(F.struct("count", "best.m0", "best.word")).alias("other"))
    return {r["word"]: [r["other"]["word"]] for r in pairs.collect()}


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    terms: tuple = IDENTITY_TERMS,
    max_rows: int = MAX_ROWS,
    min_docs: int = MIN_DOCS,
    learn: bool = True,
) -> tuple[pd.DataFrame, np.ndarray, pd.DataFrame]:
    """Label and features of at most ``max_rows`` rows, the features that pass the
    screen, and the changes that swaps make to them (lost, gained, how often).
    ``learn`` adds the learned terms to the given sets.

    Labels are made distinct and cut to the bound before the join, so the
    broadcast side holds at most ``max_rows`` ids; of the documents of an id the
    one with the smallest text stays, so the joined rows keep the bound."""
    labelled = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    labelled = labelled.filter("id IS NOT NULL AND label IN (0, 1)").distinct()
    total = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    rate = F.when(F.col("label") == 1, max_rows / 2 / total.get(1, 1)).otherwise(max_rows / 2 / total.get(0, 1))
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(draw < rate).orderBy(draw / rate, "id", "label").limit(max_rows)
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(sample), "id"
    )

    joined = joined.groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = checkpoint(joined.select("label", F.coalesce("text", F.lit("")).alias("text")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            doc, h = _features(pdf["text"].tolist())
            feature, where, total = np.unique(h, return_inverse=True, return_counts=True)
            hits = np.bincount(where, pdf["label"].to_numpy()[doc], len(feature)).astype(np.int64)
            yield pd.DataFrame({"feature": feature.view(np.int64), "hits": hits, "total": total})

    share = rows.agg(F.avg("label")).first()[0] or 0.0
    counted = rows.mapInPandas(count, "feature long, hits long, total long")
    counted = counted.groupBy("feature").agg(F.sum("hits").alias("hits"), F.sum("total").alias("total"))
    gain = F.col("hits") - F.col("total") * share
    spread = F.sqrt(F.greatest(F.col("total") * share * (1 - share), F.lit(1e-9)))
    telling = counted.filter((F.col("total") >= min_docs) & (gain >= SCREEN * spread)).select("feature").toPandas()
    screened = np.sort(telling["feature"].to_numpy(np.int64).view(np.uint64))
    others = substitutes(terms, learned_terms(rows, screened, min_docs) if learn and len(screened) else None)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            doc, h = _features(texts, screened)
            ends = np.cumsum(np.bincount(doc, minlength=len(texts)))[:-1]
            yield pd.DataFrame({"label": pdf["label"], "words": [x.tobytes() for x in np.split(h, ends)]})

    def swapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text in pdf["text"]:
                pairs = swaps(text, others)
                for i in range(0, len(pairs), 2000):
                    found = _changes(pairs[i : i + 2000], screened)
                    yield pd.DataFrame(found, columns=["lost", "gained"])

    found = rows.mapInPandas(features, "label int, words binary").toPandas()
    changes = rows.mapInPandas(swapped, "lost binary, gained binary").groupBy("lost", "gained").agg(F.count("*").alias("n"))
    return (
        found.sort_values(["label", "words"], ignore_index=True),
        screened,
        changes.toPandas().sort_values(["lost", "gained"], ignore_index=True),
    )


def _places(words: np.ndarray, sets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(set number, place in the sorted ``words``) of the features of each set."""
    own = [np.frombuffer(b, np.uint64) for b in sets]
    flat = np.concatenate([*own, np.empty(0, np.uint64)])
    number = np.repeat(np.arange(len(own)), [len(x) for x in own])
    col = np.minimum(np.searchsorted(words, flat), len(words) - 1)
    known = words[col] == flat
    return number[known], col[known]


def fit(
    sample: pd.DataFrame,
    screened: np.ndarray,
    changes: pd.DataFrame | None = None,
    l1: float = 1e-5,
    fairness: float = 1.0,
    steps: int = 1500,
) -> ToxicityModel:
    """Accelerated proximal gradient on the logistic loss (classes weigh the
    same), ``fairness`` times the mean squared counterfactual score change and
    ``l1`` times the weights' absolute sum."""
    y = sample["label"].to_numpy(np.float64)
    if not 0 < y.sum() < len(y):
        share = float(y.mean()) if len(y) else 0.0
        bias = np.log((share + 1e-9) / (1 - share + 1e-9))
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), float(bias))
    words = screened
    if not len(words):
        return ToxicityModel(words, np.empty(0), float(np.log(y.mean() / (1 - y.mean()))))
    doc, col = _places(words, list(sample["words"]))
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    n_swaps = int(changes["n"].sum()) if changes is not None else 0
    if n_swaps:
        parts = [_places(words, list(changes[c])) for c in ("lost", "gained")]
        swap, swap_col = (np.concatenate(x) for x in zip(*parts))
        sign = np.repeat([-1.0, 1.0], [len(x) for x, _ in parts])
        often = changes["n"].to_numpy(np.float64) / n_swaps

    def gradient(w: np.ndarray, bias: float):
        z = bias + np.bincount(doc, w[col], len(y))
        r = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.bincount(col, r[doc], len(words))
        if n_swaps:
            change = np.bincount(swap, sign * w[swap_col], len(often))
            g += 2 * fairness * np.bincount(swap_col, sign * (often * change)[swap], len(words))
        return g, r.sum()

    # Step size: the loss's curvature is at most a quarter of the largest
    # eigenvalue of the weighted Gram matrix (power iteration); the swaps' is at
    # most the trace of theirs.
    v = np.ones(len(words))
    top = 1.0
    for _ in range(20):
        u = weight * np.bincount(doc, v[col], len(y))
        v = np.bincount(col, u[doc], len(words))
        top = np.linalg.norm(v)
        v /= max(top, 1e-12)
    step = 1 / (0.3 * top + (2 * fairness * often[swap].sum() if n_swaps else 0.0) + 0.5)
    w, x, bias, xb, t = np.zeros(len(words)), np.zeros(len(words)), 0.0, 0.0, 1.0
    for _ in range(steps):
        g, gb = gradient(x, xb)
        new = x - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_bias = xb - step * gb
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, xb = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    keep = w != 0
    return ToxicityModel(words[keep], w[keep], float(bias), n_swaps)


def score_texts(model: ToxicityModel, texts: list[str | None]) -> np.ndarray:
    doc, h = _features(texts, model.words)
    z = np.full(len(texts), model.bias)
    if len(doc):
        z += np.bincount(doc, model.weights[np.searchsorted(model.words, h)], len(texts))
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    terms: tuple = IDENTITY_TERMS,
    max_rows: int = MAX_ROWS,
) -> ToxicityModel:
    return fit(*labelled_sample(docs, labels, id_col, text_col, label_col, terms, max_rows))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) added; a clashing column is replaced."""
    return add_text_columns(docs, text_col, "score double", lambda: lambda texts: [score_texts(model, texts)])
