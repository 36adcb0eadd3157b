import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from helpers import odd_rows, table
from incidentlab.llm.langid import WINDOW, Scorer, _forward, _softmax, cut_windows, labelled_windows, predict_language, train
from incidentlab.llm.queries import op4_language_id


def tiny_net(seed=0):
    rng = random.Random(seed)
    labels, texts = [], []
    for lang, letters in (("aa", "abcde"), ("zz", "vwxyz")):
        for _ in range(60):
            labels.append(lang)
            texts.append("".join(rng.choice(letters + " ") for _ in range(WINDOW)).encode())
    return train(labels, np.concatenate([cut_windows(t) for t in texts]), batch=16)


def test_tables_equal_the_network():
    net = tiny_net()
    x = np.random.default_rng(1).integers(0, 256, (30, WINDOW)).astype(np.uint8)
    z, _ = _forward(net, x)
    want = _softmax(np.maximum(z, 0) @ net.dense + net.dense_bias)
    assert np.allclose(Scorer(net).probabilities(x, rows=7), want, atol=1e-5)


def test_gradient_lowers_the_loss_and_is_repeatable():
    a, b = tiny_net(), tiny_net()
    assert all(np.array_equal(x, y) for x, y in zip(a.filters, b.filters))
    p = Scorer(a).probabilities(np.concatenate([cut_windows(b"abc dea bcd" * 30), cut_windows(b"vwx yzv zzx" * 30)]))
    assert p[0].argmax() == 0 and p[-1].argmax() == 1


def test_edges(spark):
    rows = [*odd_rows(), (50, "123 ... \n 4"), (51, "é"), (52, "abcab " * 5000 + "vwx " * 300)]
    got = predict_language(table(spark, rows), tiny_net())
    assert got.columns[:3] == ["doc_id", "text", "lang"] and got.columns[-2:] == ["lang_pred", "score"]
    assert got.columns.count("score") == 1 and got.count() == len(rows)
    for r in got.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        if r.doc_id == 52:
            assert r.lang_pred == "aa"


def test_copies_are_drawn_once(spark):
    rows = [(n, f"hot text {n % 40} of very many copies") for n in range(8000)]
    docs = table(spark, rows, "aa").unionByName(table(spark, [(n, f"other {n}") for n in range(40)], "bb"))
    found = [labelled_windows(docs.repartition(n), "lang", "text", max_docs=20) for n in (1, 6)]
    labels, data = found[0]
    for lang in ("aa", "bb"):
        own = [w.tobytes() for x, w in zip(labels, data) if x == lang]
        assert 2 < len(own) < 25 and len(set(own)) == len(own)
    assert labels == found[1][0] and (data == found[1][1]).all()


def test_empty_tables(spark):
    empty = table(spark, [])
    assert train(*labelled_windows(empty, "lang", "text")) is None
    assert predict_language(empty, tiny_net()).count() == 0
    nothing = predict_language(table(spark, [(1, "abc")]), None).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)


def test_held_out_accuracy(spark):
    got = op4_language_id(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_letters_are_those_of_the_letter_categories():
    import unicodedata

    from incidentlab.llm.langid import has_letter

    assert not any(has_letter(t) for t in ("", "²½", "Ⅷ ⅔ 12_-", "٣", "①", "🙂"))
    assert all(has_letter(t) for t in ("²a", "½é", "Ⅷ日", "ʰ", "ß"))
    for c in map(chr, [*range(0x250), *range(0x2000, 0x3100), 0x1F600, 0xFF21]):
        assert has_letter(c) == unicodedata.category(c).startswith("L")
