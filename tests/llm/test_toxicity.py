"""Ordinal toxicity: held-out accuracy, ordered thresholds, defined results for odd rows."""

import random
from collections import Counter

import numpy as np

from kitchenlens.llm import toxicity as tx


def corpus(n, seed=1):
    rnd, bad = random.Random(seed), ["idiot", "scumbag", "lowlife", "moronic"]
    rows = []
    for i in range(n):
        words = [rnd.choice(["tree", "house", "river", "stone", "cloud", "idea"]) + rnd.choice(["", "s", "ly"]) for _ in range(rnd.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rnd.randrange(1, 6)):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_documents(spark):
    rows = corpus(800)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 3], "doc_id long, quality int, toxic int")
    model = tx.fit_toxicity(docs, labels)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == tx.GRADES - 1
    got = {r.doc_id: r for r in tx.with_severity(docs, model).withColumn("t", tx.is_toxic("toxicity")).collect()}
    held = [(i, y) for i, _, y in rows if i % 3 == 0]
    assert np.mean([got[i].t == bool(y) for i, y in held]) >= 0.98
    for r in got.values():
        assert 0 <= r.toxicity.severity <= tx.GRADES - 1 and 0 <= r.toxicity.p_toxic <= 1
    many = model.probabilities(model.signal(Counter({"idiot": 9, "scumbag": 9}))) @ np.arange(tx.GRADES)
    one = model.probabilities(model.signal(Counter({"idiot": 1}))) @ np.arange(tx.GRADES)
    assert many > one
    kept = tx.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 590 <= kept.count() <= 605


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "", 5), (None, "123 !!", 5), (3, "idiot " * 5000, 5)],
                                 "doc_id long, text string, TOXICITY int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tx.fit_toxicity(docs, none) is None
    assert tx.drop_toxic(docs, none).count() == 5 and tx.drop_toxic(docs, none).columns == docs.columns
    out = tx.with_severity(docs, tx.Severity({"idiot": 2.0}, [1.0, 3.0, 5.0]))
    assert sorted(round(r.toxicity.severity, 3) for r in out.collect())[:4] == [0, 0, 0, 0]
    assert out.columns == ["doc_id", "text", "toxicity"]
    assert tx.with_severity(docs.limit(0), None).count() == 0


def test_signal_is_the_features_weighted_sum():
    weights = {"idiot": 1.0, "idio~": 0.5, "stone": -0.25, "idioti~": 3.0}
    text = "Idiot idiotic IDIOT stone idio"
    features = tx.text_features(text)
    want = sum(w * np.log1p(features[f]) for f, w in weights.items() if f in features)
    assert np.isclose(tx.Severity(weights, [0.0]).signal(tx.word_counts(text)), want)


def test_counts_cover_all_labels_and_only_the_fit_is_sampled(spark):
    """A word of 1 % of the documents is found and the class shares are kept, however few rows the fit takes."""
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["tree", "house", "river"]) for _ in range(8)) + (" vilest" if i % 10 == 0 and i % 100 == 0 else " idiot" if i % 10 == 0 else ""), int(i % 10 == 0))
            for i in range(3000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    model = tx.fit_toxicity(docs, labels, fit_rows=120)
    assert {"idiot", "vilest"} <= model.weights.keys()
    sample = tx.labelled_sample(docs, tx._marks(labels), 120).groupBy("toxic").count().collect()
    assert {r.toxic: r["count"] for r in sample} == {0: 60, 1: 60}
    assert model.probabilities(model.signal(Counter({"tree": 4})))[0] > 0.85       # 90 % are clean, half of the fitted rows


def test_class_quotas():
    assert tx.class_quotas({0: 5, 1: 3}, 20) == {0: 5, 1: 3}
    assert tx.class_quotas({0: 100, 1: 3}, 20) == {0: 17, 1: 3}
    assert tx.class_quotas({0: 4, 1: 100}, 20) == {0: 4, 1: 16}
    assert tx.class_quotas({0: 100, 1: 100}, 20) == {0: 10, 1: 10}


def test_words_that_are_not_exclusive(spark):
    """Ten words, each in 40 % of toxic and 4 to 8 % of clean documents, and one that speaks for clean, decide."""
    rnd = random.Random(5)
    slurs = ["vile", "dumb", "ugly", "lame", "daft", "gross", "nasty", "crude", "rotten", "filthy"]
    rows = []
    for i in range(4000):
        y = int(i % 5 == 0)
        words = [rnd.choice(["tree", "house", "river", "stone"]) for _ in range(10)] + [w for k, w in enumerate(slurs) if rnd.random() < (0.4 if y else 0.04 + 0.004 * k)]
        rows.append((i, " ".join(words + ["thanks"] * (rnd.random() < (0.1 if y else 0.5))), y))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 4], "doc_id long, quality int, toxic int")
    model = tx.fit_toxicity(docs, labels)
    assert {*slurs, "thanks"} <= model.weights.keys() and model.weights["thanks"] < 0
    got = {r.doc_id: r.t for r in tx.with_severity(docs, model).select("doc_id", tx.is_toxic("toxicity").alias("t")).collect()}
    held = [(i, y) for i, _, y in rows if i % 4 == 0]
    # knowing the true shares one would find 82 % of the toxic documents and take 1 % of the clean ones for toxic
    assert np.mean([got[i] for i, y in held if y]) >= 0.75 and np.mean([got[i] for i, y in held if not y]) <= 0.04


def test_labels_of_absent_documents_take_no_place_in_the_fit(spark):
    docs = spark.createDataFrame([(i, f"tree {i}") for i in range(40)] + [(i, None) for i in range(40, 400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(4000)], "doc_id long, quality int, toxic int")
    got = tx.labelled_sample(docs, tx._marks(labels), 20).groupBy("toxic").count().collect()
    assert {r.toxic: r["count"] for r in got} == {0: 10, 1: 10}


def test_marks_meet_texts_alike_on_either_path(spark, monkeypatch):
    """Broadcast or dealt by id: texts that share an id give the smallest, null texts and ids and unlabelled rows go."""
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c"), (2, "c"), (3, "d"), (4, None), (None, "e"), (5, "f")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (2, 0, 0), (4, 0, 1), (5, 0, None), (None, 0, 1), (6, 0, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    marks = tx._marks(labels)
    for bound in (tx.MAX_BROADCAST_MARKS, 0):
        monkeypatch.setattr(tx, "MAX_BROADCAST_MARKS", bound)
        assert sorted(map(tuple, tx._labelled(docs, marks, 5).collect())) == [(1, "a", 1), (2, "c", 0), (3, "d", 0)]


def test_clashing_column_names_stay(spark):
    docs = spark.createDataFrame([(1, "tree", 7, 8)], "doc_id long, text string, __toxicity int, `___TOXICITY` int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tx.drop_toxic(docs, labels).collect() == docs.collect()
