"""Language identification: held-out accuracy, calibration, texts without letters."""

import random

import numpy as np

from kitchenlens.llm import langid as li

WORDS = {"xx": ["bara", "bora", "bura", "abra"], "yy": ["tik", "tok", "tuk", "kit"], "zz": ["ляля", "люля", "лёл"]}


def corpus(n):
    rnd = random.Random(7)
    return [(i, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randrange(3, 40))), lang) for i, lang in ((i, rnd.choice(sorted(WORDS))) for i in range(n))]


def test_held_out(spark):
    rows = corpus(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    odd = spark.createDataFrame([(1, None, "xx"), (2, "", None), (3, "12 .. 34!", "yy"), (None, "tik tok tik", None), (None, "tik tok tik", None), (4, "bara " * 300_000, None)], docs.schema)
    model = li.fit_language_model(docs.where("doc_id % 3 <> 1").unionByName(odd))
    assert model.langs == ["xx", "yy", "zz"] and model.temperature > 0
    got = {r.doc_id: r for r in docs.select("doc_id", "lang", li.with_language(docs, model).alias("p")).collect()}
    held = [r for i, r in got.items() if i % 3 == 1]
    assert np.mean([r.p.lang_pred == r.lang for r in held]) >= 0.98 and all(0 <= r.p.score <= 1 for r in held)
    out = [tuple(r) for r in odd.select("doc_id", li.with_language(odd, model).alias("p")).select("doc_id", "p.lang_pred").collect()]
    assert sorted(out, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (None, "yy"), (None, "yy"), (4, "xx")], key=str)
    none = li.fit_language_model(docs.limit(0))
    assert none.langs == [] and none.predict("bara") == ("und", 0.0)


def test_long_texts_count_like_short_blocks(monkeypatch):
    """The features of a text in blocks are those of the text in one piece, exactly."""
    rnd = random.Random(8)
    texts = ["Ab c  déf, " * 50, "", " ", "a", "ab", "x  ", "  y", "ΑΣ ΟΔΟΣ Σ" * 20] + ["".join(rnd.choice("aB é  .\u3000İΣ日") for _ in range(rnd.randrange(200))) for _ in range(200)]
    whole = [li.term_counts(t) for t in texts]
    for block in (1, 2, 3, 7, 64, 100):
        monkeypatch.setattr(li, "BLOCK_CHARS", block)
        for text, (want, n) in zip(texts, whole):
            at, counts = li.term_counts(text)
            assert at.tolist() == want.tolist() and counts.tolist() == n.tolist(), (block, text)


def test_shards_without_rows_shrink_nothing(spark):
    """Two rows in four shards: the average is over the shards that have rows."""
    docs = spark.createDataFrame([(1, "bara bora bura " * 5, "xx"), (2, "tik tok tuk " * 5, "yy")], "doc_id long, text string, lang string")
    few, one = (li.fit_language_model(docs, shards=n, calibration_rows=0) for n in (64, 1))
    assert few.langs == one.langs == ["xx", "yy"] and few.predict("bora bara")[0] == "xx" and few.predict("tok tok")[0] == "yy"
    assert np.abs(few.weights).max() > 0.5 * np.abs(one.weights).max()


def test_temperature():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 4000)
    z = rng.standard_normal((4000, 3))
    p = li.softmax(z)
    y = np.array([rng.choice(3, p=row) for row in p])
    assert abs(li.fit_temperature(3 * z, y) - 3) < 0.4


def test_rare_languages_are_learned(spark):
    """Twelve rows among 3000 of a language, far outside a sample of 100 rows."""
    rows = [(i, t, lang) for i, t, lang in corpus(3000)]
    rnd = random.Random(2)
    rare = [(10_000 + i, " ".join(rnd.choice(["wexqu", "quexw", "xewuq"]) for _ in range(12)), "qq") for i in range(12)]
    once = [(20_000, "ñandú ñoño ñu", "ñ")]
    docs = spark.createDataFrame(rows + rare + once, "doc_id long, text string, lang string")
    model = li.fit_language_model(docs, shard_rows=20, calibration_rows=20)
    assert model.langs == ["qq", "xx", "yy", "zz", "ñ"]
    got = {r.doc_id: r.p.lang_pred for r in docs.where("doc_id >= 10000").select("doc_id", li.with_language(docs, model).alias("p")).collect()}
    assert all(got[i] == "qq" for i, _, _ in rare)


def test_quotas_and_split():
    assert li.language_quotas({"a": 30, "b": 10}, 100) == {"a": 30, "b": 10}
    assert li.language_quotas({"a": 1_000_000, "b": 50, "c": 2}, 1200) == {"a": 1200, "b": 50, "c": 2}
    found = [("a", i) for i in range(20)] + [("b", 7)]
    assert sorted(li.split_places(found, {"a": 10, "b": 1}, 5)) == [("a", 8, 9), ("b", 7, 7)]
