import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerfold.llm import language_id as li

TRAINED = {
    "aa": ["abba baab abab", "baba", ""],
    "bb": ["xyz zyx abc", "zzz été"],
}


def counts(texts, order):
    numbers, _ = li.byte_strings([t.encode() for t in texts], order)
    grams, n = np.unique(numbers, return_counts=True)
    return grams.astype(np.int64), n


def plain_bits(texts, order, text):
    """Method C by dictionaries, byte by byte."""
    following = defaultdict(Counter)
    for t in texts:
        data = bytes(order) + t.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                following[data[i - k : i]][data[i]] += 1
    bits, data = 0.0, bytes(order) + text.encode()
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = following.get(data[i - k : i])
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits += math.log2(total / seen[data[i]])
                break
            bits += math.log2(total / len(seen))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("order", [1, 2, 3])
def test_code_lengths_are_exact(order, monkeypatch):
    model = li.Model(order, {lang: counts(texts, order) for lang, texts in TRAINED.items()})
    texts = ["abba", "xyz abba é", "q", "", "zzzzzz", "été baab"]
    want = [[plain_bits(TRAINED[lang], order, t) for lang in ("aa", "bb")] for t in texts]
    got = model.code_lengths([t.encode() for t in texts])
    assert np.allclose(got, want)
    monkeypatch.setattr(li, "CHUNK", 3)
    assert np.allclose(model.code_lengths([t.encode() for t in texts]), want)


def corpus(spark, n=150):
    rng = random.Random(2)
    pieces = {"en": ["the", "ing", "er", "th"], "fr": ["eau", "que", "re", "é"], "de": ["sch", "ung", "en"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(pieces))
        words = ["".join(rng.choice(pieces[lang]) for _ in range(3)) for _ in range(20)]
        rows.append((i, " ".join(words), lang, "clash"))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus(spark)
    schema = "doc_id LONG, text STRING, lang STRING, gram STRING"
    model = li.train(spark.createDataFrame(rows[:100], schema))
    odd = [(1000, None, "en", ""), (1001, "12 34 !", "en", ""), (1002, "", None, ""), (None, "the", None, "")]
    got = {r.doc_id: r for r in li.identify(spark.createDataFrame(rows[100:] + odd, schema), model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows[100:])
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())


def test_order_falls_where_the_tree_would_be_too_large(spark):
    df = spark.createDataFrame(corpus(spark, 30), "doc_id LONG, text STRING, lang STRING, x STRING")
    assert li.train(df).order == li.ORDER
    assert li.train(df, max_grams=100).order == 1


def test_a_tree_too_large_to_send_is_stored_and_gives_the_same(spark):
    rows = corpus(spark)
    schema = "doc_id LONG, text STRING, lang STRING, gram STRING"
    odd = [(1000, None, "en", ""), (1001, "12 34 !", "en", ""), (1002, "", None, ""), (None, "the", None, "")]
    odd += [(None, "eau \u4e2d\u6587 zq", None, ""), (1003, "q\x00x " * 3000, None, "")]
    docs = spark.createDataFrame(rows[100:] + rows[140:] + odd, schema)
    training = spark.createDataFrame(rows[:100], schema)
    sent, stored = li.train(training), li.train(training, sent_grams=100)
    assert isinstance(stored, li.StoredModel) and stored.order == sent.order == li.ORDER
    want, got = (sorted(map(tuple, li.identify(docs, m).collect()), key=repr) for m in (sent, stored))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want])
    assert li.identify(docs.limit(0), stored).collect() == []


def test_code_lengths_of_tables_are_exact(spark):
    schema = "doc_id LONG, text STRING, lang STRING"
    rows = [(i, t, lang) for i, (lang, ts) in enumerate(TRAINED.items()) for t in ts]
    stored = li.train(spark.createDataFrame(rows, schema), sent_grams=0)
    text = "xyz abba q \u4e2d"
    numbers, n = counts([text], li.ORDER)
    costs = li._string_costs(spark.createDataFrame([(1, text)], "doc_id LONG, text STRING"), stored)
    bits = {r.gram: r.bits for r in costs.collect()}
    got = sum(np.array(bits[g]) * k for g, k in zip(numbers.tolist(), n.tolist()))
    assert np.allclose(got, [plain_bits(TRAINED[lang], li.ORDER, text) for lang in ("aa", "bb")])


def test_nothing_to_learn_and_empty_table(spark, make_docs):
    schema = "doc_id LONG, text STRING, lang STRING"
    assert li.train(spark.createDataFrame([(1, "abc", None), (2, None, "en")], schema)) is None
    got = li.identify(make_docs([(1, "abc")]), None).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert li.identify(make_docs([]), None).collect() == []
