"""Source divergence against exact brute force: block and tile sizes, groups without terms, ties, odd columns."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kitchenlens.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute_force(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        here = {s: counts[lang, s] for g, s in groups if g == lang}
        whole = sum(here.values(), Counter())

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}
        ps, q = {s: p(c) for s, c in here.items()}, p(whole)
        for s in here:
            pairs = [(sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in here if o != s]
            terms = [(ps[s][t] - q[t], t) for t in kept if here[s][t] and ps[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    words = ["Été", "a", "B", "cc", "d-e", "f_g", "h1i", "日本", "ÀA", "z`z", "x{y", "same"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(4)]
    rows = []
    for i in range(n):
        lang, source = rnd.choice([("en", 9), ("fr", 4), ("xx", 2)]), rnd.random()
        source = f"s{int(source ** 3 * lang[1])}"
        rows.append((i, " ".join(rnd.choice(words[: 12 + 4 * rnd.randrange(13)]) for _ in range(rnd.randrange(30))), lang[0], source))
    rows += [(n, None, "en", "silent"), (n + 1, "", "en", None), (n + 2, "lonely words", None, None), (n + 3, "123 ..", "few", "a"), (n + 4, "some few", "few", "b"),
             (None, "same " * 500, "fr", "s0"), (n + 5, "same", "alone", "only"), (n + 6, "Same\x00same\x7fSAME", "xx", "s0")]
    return rows + rows[:30]


@pytest.mark.parametrize("min_docs,top,tile,block", [(30, 50, 64, 8192), (5, 3, 2, 7), (1, 50, 1, 1), (10_000, 50, 64, 8192)])
def test_against_brute_force(spark, monkeypatch, min_docs, top, tile, block):
    monkeypatch.setattr(dv, "BLOCK_TERMS", block)
    rows = corpus()
    got = dv.source_divergence(spark.createDataFrame(rows, SCHEMA).repartition(4), min_docs, top, tile)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_force(rows, min_docs, top)


def test_small_task_memory_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(dv, "HELD_TERMS", 5)
    monkeypatch.setattr(dv, "BLOCK_BYTES", 16)
    rows = corpus(120, 4) + [(9, "Wort für Wort " * 20_000, "en", "s1")]
    assert sorted(map(tuple, dv.source_divergence(spark.createDataFrame(rows, SCHEMA), 2).collect())) == brute_force(rows, 2, 50)


def test_extra_columns_and_empty_table(spark):
    rows = corpus(80, 6)
    df = spark.createDataFrame([(*r, 1, "t", 2.0, "b") for r in rows], SCHEMA + ", n int, term string, value double, block string")
    assert sorted(map(tuple, dv.source_divergence(df, 3).collect())) == brute_force(rows, 3, 50)
    assert dv.source_divergence(df.limit(0)).collect() == []


def test_runs_cover_each_block(spark):
    """The runs of a column are maximal and, with the zeros that follow, as long as the block; their counts are the groups'."""
    rows = corpus(300, 8)
    found = dv.term_table(spark.createDataFrame(rows, SCHEMA), 2)
    entries = dv.kept_entries(found)
    groups = entries.groupBy("lang", "source").agg(dv.F.sum("n").alias("n"))
    columns = dv.run_columns(entries, groups).collect()
    total = Counter()
    for r in columns:
        assert sum(r.lengths) <= r.terms and min(r.lengths) > 0 and all(a != b for a, b in zip(r.counts, r.counts[1:]))
        total[r.lang, r.source] += sum(x * y for x, y in zip(r.lengths, r.counts))
    assert total == {(r.lang, r.source): r.n for r in groups.collect()}


def test_run_distance_is_the_sum_over_terms():
    rnd = np.random.default_rng(5)
    for _ in range(300):
        n = int(rnd.integers(1, 40))
        a, b = rnd.integers(0, 3, n), rnd.integers(0, 3, n)

        def runs(x):
            ends = np.append(np.flatnonzero(x[1:] != x[:-1]) + 1, n)
            return ends, x[ends - 1]
        assert dv.run_distance(*runs(a), *runs(b)) == np.abs(a - b).sum()


def test_probabilities_stay_exact_beyond_a_long():
    counts = [0, 7, 10 ** 10, 10 ** 15]
    assert dv.smoothed(np.array(counts), 10 ** 16 + 3, 1000).tolist() == [1 + 10 ** 9 * (c + 5) // (10 ** 16 + 3 + 5000) for c in counts]


def test_contract(spark):
    got = dv.op13_divergence(spark, "/root/testdata/sf0.01")
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    assert sorted(map(tuple, got.collect())) == brute_force([tuple(r) for r in docs], 30, 50)
