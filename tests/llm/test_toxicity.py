import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF01
from helpers import odd_rows, table
from incidentlab.llm.queries import op2_toxicity
from incidentlab.llm.textops import Words, mix64
from incidentlab.llm.toxicity import (
    PREFIXES,
    SHARED,
    _changes,
    _features,
    fit,
    labelled_sample,
    learned_terms,
    score_texts,
    score_toxicity,
    substitutes,
    swaps,
    train_toxicity,
)

BAD, GOOD = ["idiot", "scum", "moron"], ["tea", "garden", "river", "music"]


def labelled(spark):
    rows, labels = [], []
    for i in range(240):
        toxic = i % 3 == 0
        # The group term goes with the label: a plain model would learn it.
        term = "muslims" if toxic or i % 16 == 1 else ("christians" if i % 2 else "")
        text = f"The {GOOD[i % 4]} and {GOOD[(i + 1) % 4]}. {term} met {BAD[i % 7 % 3] if toxic and i % 5 else 'there'}."
        rows.append((i, text))
        labels.append((i, int(toxic)))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def features(*args):
    return labelled_sample(*args, max_rows=1000)


def test_swaps():
    others = substitutes((("women", "men"), ("a", "b", "c")), {"met": ["saw"]})
    assert swaps("Women met. nothing here! a, and b a.", others) == [
        ("women met", "women saw"),
        ("women met", "men met"),
        (" a, and b a", " c, and b c"),
        (" a, and b a", " a, and c a"),
    ]
    assert swaps("", others) == []


def test_changes_are_those_of_the_whole_sentence():
    """Shared beginnings count words of the sentence, not of the two terms."""
    a, b = "immigrants immigration immigrate stole", "refugees immigration immigrate stole"
    whole = [set(_features([t])[1].tolist()) for t in (a, b)]
    ((lost, gained),) = _changes([(a, b), (a, a)], np.array(sorted(whole[0] | whole[1]), np.uint64))
    lost, gained = (set(np.frombuffer(x, np.uint64).tolist()) for x in (lost, gained))
    assert lost == whole[0] - whole[1] and gained == whole[1] - whole[0]
    alone = set(_features(["immigrants"])[1].tolist())
    assert lost - alone and alone - lost


def test_learned_terms_are_neutral_and_share_neighbours(spark):
    rows = [(int(i % 2), f"we saw the {w} near town {i}") for w, k in (("cat", 9), ("trashcan", 4)) for i in range(0, 2 * k, 2)]
    rows += [(1, f"we saw the {w} near town {i}") for i in range(9) for w in ("trash", "trashcan")]
    frame = spark.createDataFrame(rows, "label int, text string")
    screened = np.unique(_features(["trash"])[1])
    assert learned_terms(frame, screened) == {"trashcan": ["cat"]}
    assert learned_terms(frame.filter("label = 1"), screened) == {}


def test_counterfactual_penalty_removes_the_group_bias(spark):
    sample = features(*labelled(spark))
    neutral = ["muslims met there.", "christians met there."]

    def gap(model):
        a, b = score_texts(model, neutral)
        return abs(a - b)

    plain, fair = fit(*sample, fairness=0.0), fit(*sample, fairness=5.0)
    assert gap(plain) > 0.2 and gap(fair) < 0.3 * gap(plain)
    assert score_texts(fair, neutral).max() < 0.7
    assert score_texts(fair, [f"you {w}" for w in BAD]).min() > score_texts(fair, ["you"]).max()


def test_edges(spark):
    docs, labels = labelled(spark)
    odd = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (9999, 1), (5, 7)], "doc_id long, toxic int"))
    model = train_toxicity(docs, odd)
    rows = odd_rows()
    got = score_toxicity(table(spark, rows), model)
    assert got.columns.count("score") == 1 and got.count() == len(rows)
    by = {r.doc_id: r.score for r in got.collect()}
    assert all(0 <= s <= 1 for s in by.values()) and by[1] == by[3] == by[2]


def test_sample_keeps_its_bound(spark):
    """Hot ids on both sides, and the same sample in any layout."""
    docs, labels = labelled(spark)
    docs = docs.unionByName(table(spark, [(i, f"hot copy {n}") for i in range(40) for n in range(30)]))
    labels = labels.unionByName(spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)] * 20, "doc_id long, toxic int"))
    found = [labelled_sample(docs.repartition(n), labels.repartition(n + 2), max_rows=60) for n in (1, 5)]
    assert 30 < len(found[0][0]) <= 60 and set(found[0][0]["label"]) == {0, 1}
    pd.testing.assert_frame_equal(found[0][0], found[1][0])
    assert (found[0][1] == found[1][1]).all()
    pd.testing.assert_frame_equal(found[0][2], found[1][2])


def test_degenerate_labels(spark):
    docs, labels = labelled(spark)
    none = train_toxicity(docs, labels.filter("toxic > 1"))
    assert score_texts(none, ["x", None]).max() < 1e-6
    one = train_toxicity(docs, labels.filter("toxic = 1"))
    assert score_texts(one, ["x"])[0] > 0.99
    empty = train_toxicity(table(spark, []), labels)
    assert score_texts(empty, ["x"])[0] < 1e-6
    assert score_toxicity(table(spark, []), one).count() == 0


def test_features_are_folded_presence_and_shared_beginnings():
    def of(*texts):
        doc, h = _features(list(texts))
        return [set(h[doc == i].tolist()) for i in range(len(texts))]

    a, b, c, d = of("Idiot idiot", "IDIOT!!", "idiots idiotic", None)
    assert a == b and not d
    # A word of five letters has itself and two beginnings.  The two longer
    # words have four different beginnings and share those of three to five letters.
    assert len(a) == 3 and len(c) == 2 + 4 + 3
    known = np.sort(np.array(sorted(a & c), np.uint64))
    doc, h = _features(["idiots idiotic", "x"], known)
    assert set(h.tolist()) == (a & c) and set(doc.tolist()) == {0}


def test_no_labels_at_all():
    assert score_texts(fit(pd.DataFrame({"label": [], "words": []}), np.empty(0, np.uint64)), ["a"])[0] < 1e-6


def test_held_out_accuracy(spark):
    got = op2_toxicity(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").filter("held_out")
    hit = got.agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("recall"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false_alarms"),
    ).first()
    assert hit.recall > 0.85 and hit.false_alarms < 0.03


def _plain_scores(model, texts):
    """Scores from sets of words and beginnings of each text, one at a time."""
    weight, known = dict(zip(model.words.tolist(), model.weights.tolist())), {}

    def keys(word):
        if word not in known:
            w = Words([word], prefixes=PREFIXES)
            n = len(word.encode())
            known[word] = int(w.hash[0]), [(k, int(w.prefix[k][0])) for k in PREFIXES if n > k]
        return known[word]

    out = []
    for text in texts:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = set(re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", folded))
        z, sharing = model.bias, {}
        for word in words:
            own, beginnings = keys(word)
            z += weight.get(own, 0.0)
            for b in beginnings:
                sharing[b] = sharing.get(b, 0) + 1
        for (k, h), many in sharing.items():
            start = mix64(np.array([h], np.uint64), 100 + k)
            z += sum(weight.get(int(mix64(start, 200 + n)[0]), 0.0) for n in SHARED if many >= n)
        out.append(1 / (1 + math.exp(-z)))
    return out


def test_query_has_swaps_and_scores_as_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    sample = labelled_sample(docs, learn)
    model, plain = fit(*sample), fit(*sample, fairness=0.0)
    assert model.swaps > 0 and model.swaps == sample[2]["n"].sum()
    rows = docs.select("doc_id", "text").collect()[::5]
    got = {r.doc_id: r.score for r in op2_toxicity(spark, SF01).collect()}
    want = _plain_scores(model, [r.text for r in rows])
    assert max(abs(got[r.doc_id] - s) for r, s in zip(rows, want)) < 1e-9
    moved = np.abs(score_texts(plain, [r.text for r in rows]) - np.array(want))
    assert moved.max() > 0.01
