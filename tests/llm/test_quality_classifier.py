import random

import numpy as np
from llm_helpers import sentence

from ledgerfold.llm import quality_classifier as qc


def test_scores_equal_the_densities():
    rng = np.random.default_rng(1)
    size = len(qc.STATISTICS)
    x = {c: rng.normal(size=(400, size)) @ rng.normal(size=(size, size)) + c for c in (0, 1)}
    sums = {c: (float(len(v)), v.sum(axis=0), v.T @ v) for c, v in x.items()}
    model = qc.fitted(sums)
    points = rng.normal(size=(5, size))
    want = []
    for p in points:
        logs = []
        for mean, factor in zip(model.means, model.factors):
            cov = factor @ factor.T
            d = p - mean
            logs.append(-0.5 * (d @ np.linalg.inv(cov) @ d + np.linalg.slogdet(cov)[1]))
        want.append(1 / (1 + np.exp(-(logs[1] - logs[0] + model.log_odds))))
    assert np.allclose(model.scores(points), want)


def test_full_shrinkage_gives_one_covariance():
    rng = np.random.default_rng(2)
    size = len(qc.STATISTICS)
    x = {c: rng.normal(scale=1 + c, size=(50, size)) for c in (0, 1)}
    sums = {c: (float(len(v)), v.sum(axis=0), v.T @ v) for c, v in x.items()}
    a, b = qc.fitted(sums, to_pooled=1.0).factors
    assert np.allclose(a, b)
    round_ = qc.fitted(sums, to_identity=1.0).factors[0]
    assert np.allclose(round_, np.eye(size) * round_[0, 0])


def labelled(spark, make_docs, n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        text, good = "\n".join(sentence(rng, 9) for _ in range(rng.randint(1, 9))), rng.random() < 0.85
        if not good:
            text = rng.choice([text.upper(), text.replace(" ", "%%% "), "same " * 60])
        rows.append((i, text))
        labels.append((i, int(good), "clash"))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id LONG, quality INT, score STRING")


def test_held_out_accuracy(spark, make_docs):
    docs, labels = labelled(spark, make_docs)
    model = qc.train(docs, labels.where("doc_id < 250"))
    scores = {r.doc_id: r.score for r in qc.score(docs, model).collect()}
    held_out = [(r.quality, scores[r.doc_id]) for r in labels.where("doc_id >= 250").collect()]
    assert sum((s >= 0.3) == bool(y) for y, s in held_out) > 0.97 * len(held_out)


def test_odd_rows(spark, make_docs, odd_rows):
    docs, labels = labelled(spark, make_docs, 100)
    odd = spark.createDataFrame([(7, None, "x"), (None, 1, "x"), (5, 2, "x")], labels.schema)
    model = qc.train(docs, labels.unionByName(odd))
    got = qc.score(make_docs(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)


def test_without_labels_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "some text"), (2, None)])
    none = spark.createDataFrame([], "doc_id LONG, quality INT")
    assert [r.score for r in qc.score(docs, qc.train(docs, none)).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id LONG, quality INT")
    assert all(r.score > 0.5 for r in qc.score(docs, qc.train(docs, one)).collect())
    assert qc.score(make_docs([]), qc.train(docs, none)).collect() == []
