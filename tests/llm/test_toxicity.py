import random

from llm_helpers import sentence

from ledgerfold.llm import toxicity as tx

LEXICON = tx.Lexicon({"dolt": (50, 0), "oaf": (40, 1), "grum*": (30, 0)}, 100, 900)


def weight(text):
    return tx.matched(text, LEXICON)[0]


def test_grammar_weighs_clauses():
    plain = weight("What a dolt runs here.")
    assert plain > 0 == weight("What a river runs here.")
    assert weight("What you dolt did.") > plain
    assert weight("Not a dolt here.") < plain
    assert weight('Someone said "a dolt here".') < plain
    assert weight("It said much. A dolt here.") == plain  # speech ends with its clause
    assert weight("He will kill") > 2 * weight("The wolves kill")
    assert weight("A grumbler here") > 0 == weight("A gruff one here")
    assert weight("A dolt. " * 2) < 2 * plain


def test_learned_harm_keeps_its_role():
    lexicon = tx.Lexicon({"kill": (60, 2), "dolt": (50, 0)}, 100, 900)

    def weighed(text):
        return tx.matched(text, lexicon)[0]

    # A modal makes it a threat, and only a threat weighs in full.
    assert weighed("He will kill") > 4 * weighed("The wolves kill") > 0
    assert weighed("Not kill") < weighed("The wolves kill")


def test_insults_are_heaped():
    assert weight("A dolt and oaf here") > weight("A dolt. An oaf here")
    assert weight("A dolt runs over green hills, oaf") == weight("A dolt. An oaf here")


def test_an_id_that_labels_repeat_counts_once(spark, make_docs):
    docs, labels = labelled(spark, make_docs, 200)
    again = labels.unionByName(labels).unionByName(labels.where("doc_id < 50"))
    once, often = tx.train(docs, labels), tx.train(docs, again)
    assert once.lexicon == often.lexicon and once.logistic == often.logistic


def test_composition_is_the_product_of_its_parts():
    machine = tx.Composition()
    rng = random.Random(1)
    for _ in range(50):
        state, alone = machine.start, [0] * len(tx.GRAMMAR)
        for symbol in (rng.randrange(8) for _ in range(12)):
            state, factor = machine.step(state, symbol)
            product = 1.0
            for k, part in enumerate(tx.GRAMMAR):
                alone[k], one = part.step(alone[k], symbol)
                product *= one
            assert state == tuple(alone) and abs(factor - product) < 1e-12


def labelled(spark, make_docs, n=500):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        text, toxic = " ".join(sentence(rng, 10) for _ in range(4)), rng.random() < 0.2
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["blorch", "snarv", "quindle"]))
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(toxic), "clash"))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id LONG, toxic INT, text STRING")


def test_held_out_accuracy(spark, make_docs):
    docs, labels = labelled(spark, make_docs)
    grammar = tx.train(docs, labels.where("doc_id < 300"))
    scores = {r.doc_id: r.score for r in tx.score(docs, grammar).collect()}
    held_out = [(r.toxic, scores[r.doc_id]) for r in labels.where("doc_id >= 300").collect()]
    assert sum((s >= 0.7) == bool(y) for y, s in held_out) > 0.97 * len(held_out)
    assert not any(s >= 0.7 for y, s in held_out if not y)


def test_odd_rows(spark, make_docs, odd_rows):
    docs, labels = labelled(spark, make_docs, 100)
    odd = labels.limit(0).unionByName(
        spark.createDataFrame([(7, None, "x"), (None, 1, "x"), (5, 2, "x")], labels.schema)
    )
    grammar = tx.train(docs, labels.unionByName(odd))
    got = tx.score(make_docs(odd_rows), grammar).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score < 0.7 for r in got)
    rows = tx.score_rows(make_docs(odd_rows), grammar)
    assert rows.columns == ["doc_id", "text", "rest", "score"]


def test_without_labels_and_empty_table(spark, make_docs):
    none = spark.createDataFrame([], "doc_id LONG, toxic INT")
    one_class = spark.createDataFrame([(1, 0), (2, 0)], "doc_id LONG, toxic INT")
    docs = make_docs([(1, "a dolt"), (2, None)])
    for labels in (none, one_class):
        grammar = tx.train(docs, labels)
        assert not grammar.lexicon.terms
        assert all(0 <= r.score < 0.7 for r in tx.score(docs, grammar).collect())
    assert tx.score(make_docs([]), tx.train(make_docs([]), none)).collect() == []


def test_sample_is_bounded(spark, make_docs):
    docs, labels = labelled(spark, make_docs, 400)
    lexicon = tx.train(docs, labels, sample=100).lexicon
    assert 60 < lexicon.n_toxic + lexicon.n_other < 140
