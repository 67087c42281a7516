"""Wu-Manber word search against a plain scan of every window."""

import random
import re

import pytest

from kitchenlens.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(text, items, width=10):
    words, hit, found = plain_words(text), set(), set()
    for item, itext in items:
        iw = plain_words(itext)
        windows = [iw[i:i + width] for i in range(len(iw) - width + 1)] if len(iw) >= width else [iw] if iw else []
        for w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item)
    return len(words), len(hit), found


def some_text(rnd, n):
    return "".join(rnd.choice(["the ", "a, ", "B", "cat ", "é", "9 ", "\n", "dog-", "ü ", "x "]) for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
def test_search_plain(seed):
    rnd = random.Random(seed)
    items = [(str(i), some_text(rnd, rnd.choice([0, 1, 3, 8, 20, 40]))) for i in range(12)]
    tables = dc.pattern_tables(items, 4)
    for _ in range(20):
        text = some_text(rnd, rnd.choice([0, 5, 60, 300]))
        n, spans, found = dc.search_text(text, tables)
        assert (n, sum(b - a for a, b in spans), found) == plain_hits(text, items, 4)


def test_search_over_blocks(monkeypatch):
    rnd = random.Random(3)
    items = [("i", " ".join(f"w{j}" for j in range(25))), ("s", "w3 w4")]
    text = " ".join(f"w{rnd.randrange(6)}" for _ in range(300)) + " " + items[0][1]
    from kitchenlens.llm.common import word_blocks
    monkeypatch.setattr(dc, "word_blocks", lambda data: word_blocks(data, 11))
    n, spans, found = dc.search_text(text, dc.pattern_tables(items, 10))
    assert (n, sum(b - a for a, b in spans), found) == plain_hits(text, items)


@pytest.mark.parametrize("per_pass", [2, 100_000])
def test_hits_frame(spark, per_pass):
    bench = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"), (3, None), (4, "..."), (None, "no name"), (2, "short ITEM")]
    rows = [(1, "x ONE two three four five six seven eight nine ten y", "k"), (2, None, "k"), (3, "", "k"), (4, "a short-item! and no name", "k"),
            (4, "a short-item! and no name", "k"), (5, "one two three four five six seven eight nine", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, HITS string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    out = dc.with_benchmark_hits(docs, items, windows_per_pass=per_pass).collect()
    got = sorted((r.doc_id, r.hits.n_words, sum(s.stop - s.start for s in r.hits.spans), tuple(r.hits["items"])) for r in out)
    named = [(str(i) if i is not None else "", t) for i, t in bench]
    want = sorted((d, *(lambda p: (p[0], p[1], tuple(sorted(p[2]))))(plain_hits(t, named))) for d, t, _ in rows)
    assert got == want
    kept = dc.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert dc.with_benchmark_hits(docs, items.limit(0)).where("size(hits.spans) > 0").count() == 0
    assert dc.with_benchmark_hits(docs.limit(0), items).count() == 0
