"""SimHash: fingerprints against a plain version, links and groups against all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from kitchenlens.llm import simhash as sh
from kitchenlens.llm.components import connected_components


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    rows = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n\t ", "one", "two words", "three Words here", "É é ÉÀ Straße\x0bx", "a b c d a b c d a b c",
                                  "x" * 5000, " ".join(f"w{i % 97}" for i in range(3000))])
def test_fingerprint_plain(text):
    assert sh.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_blocks_join(monkeypatch):
    text = " ".join(f"word{i % 53}" for i in range(4000))
    whole = sh.fingerprint(text)
    monkeypatch.setattr(sh, "word_blocks", lambda data: __import__("kitchenlens.llm.common", fromlist=["x"]).word_blocks(data, 7))
    assert sh.fingerprint(text) == whole == plain_fingerprint(text)


def brute_groups(prints, distance):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ps = sorted(prints)
    for i, a in enumerate(ps):
        for b in ps[i + 1:]:
            if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in ps}


def near_prints(n, seed=1):
    rnd, out = random.Random(seed), set()
    while len(out) < n:
        x = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 1, 2, 30])):
            out.add(x - (1 << 64) if x >> 63 else x)
            for _ in range(rnd.choice([1, 2, 3])):
                x ^= 1 << rnd.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
@pytest.mark.parametrize("bucket_pairs", [0, 1_000_000])
def test_links_keep_all_groups(spark, distance, bucket_pairs):
    prints = near_prints(220)
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = sh.near_links(nodes, distance, bucket_pairs)
    assert links.where(F.expr(f"bit_count(a ^ b) > {distance} or a = b")).isEmpty()
    got = {r.node: r.root for r in connected_components(links).collect()}
    want = brute_groups(prints, distance)
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_a_chain_and_a_star(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (3, 3)]
    links = spark.createDataFrame(rows, "a long, b long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert connected_components(links.limit(0)).count() == 0


def test_groups_nulls_repeats_clashes(spark):
    docs = spark.createDataFrame([(5, "a b c d e", 1), (2, "a b c d e", 1), (2, "a b c d e", 2), (9, None, 3), (4, " ", 3), (None, "q r s t", 4), (8, "z y x w", 5)],
                                 "doc_id long, text string, fingerprint long")
    got = sorted(((r.doc_id, r.component_id) for r in sh.simhash_groups(docs).collect()), key=str)
    assert got == sorted([(5, 2), (2, 2), (2, 2), (9, 4), (4, 4), (None, None), (8, 8)], key=str)
    kept = sh.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["2", "4", "8", "None"]
    empty = docs.limit(0)
    assert sh.simhash_groups(empty).count() == 0 and sh.drop_near_copies(empty).count() == 0


def test_survivors_by_broadcast_or_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two three four {i // 2}" if i % 3 else "same text of many", i) for i in range(40)] + [(7, "one two three four 3", 7)], "doc_id long, text string, n int")
    want = sorted(map(tuple, sh.drop_near_copies(docs).collect()))
    monkeypatch.setattr(sh, "MAX_BROADCAST_IDS", 0)
    assert sorted(map(tuple, sh.drop_near_copies(docs).collect())) == want and 0 < len(want) < 40
