"""Packing: the tokenizer's own ids, best fit against a plain search, whole and gapless sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kitchenlens.llm import packing as pk

ODD = ["", None, "a", "'s it's don't I'll", "x́y é é ﬁ İI ΣΑΣ ς", "<|endoftext|> hi<|startoftext|>", "  \n\t ", "12 3a4 a1b2",
       "a b c\x1cd\x85e\x0bf\x0cg", "(word). \"Quoted\" a-b_c @x", "日本語 テスト。", "á .́b ,̧", "ab'S X'LL", "ß ẞ Ǆ", "\x00a\x01 b", "." * 100 + "a" * 100,
       "naïve. Ünder, ærø! señor? ½ ² ª º µ", "word " * 3000, "A" * 5000]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path(pk.VOCABULARY))


def ids_of(plain, text):
    return np.array(plain.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_are_the_tokenizers(plain, monkeypatch):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("abcdeéAB .,'\n-12") for _ in range(rnd.randrange(400))) for _ in range(300)]
    want = [ids_of(plain, t) for t in texts]
    for limit in (1_200_000, 10):
        monkeypatch.setattr(pk, "REMEMBERED", limit)
        tokenizer = pk.ChunkTokenizer(public_tokenizers.path(pk.VOCABULARY))
        for at in range(0, len(texts), 50):
            assert tokenizer.encode(pa.array(texts[at:at + 50], pa.string())) == want[at:at + 50]
            assert tokenizer.encode(pa.array(texts, pa.string()).slice(at, 50)) == want[at:at + 50]


def test_ids_of_random_unicode(plain):
    """Marks, letters with special cases and letters of every script, beside punctuation: 100,000 strings."""
    rnd = random.Random(6)
    odd = "İıſKÅẞßŉǰΐΰﬁﬃÀé\u0301\u0307\u0308\u0345\u093f\u0e33ΣςσǄǅǆԱაᲐⅣª²½ٱ日ー한\u1100\u1161\u200d\u200c\ufeff\x85\xa0\u2028"
    chars = "abIS'.,-!(\"" + odd
    texts = ["İ.", "İ-", "(İ)", "i\u0307.", "ŉ.", "Σ.", "ΑΣ,", "ΐ!"]
    texts += ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 9))) for _ in range(60_000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0x530), rnd.randrange(0x530, 0xD800), rnd.randrange(0xE000, 0x20000)])) + rnd.choice(["", "", ".", "a"])
                      for _ in range(rnd.randint(1, 6))) for _ in range(40_000)]
    tokenizer = pk.ChunkTokenizer(public_tokenizers.path(pk.VOCABULARY))
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 4000):
        got = tokenizer.encode(pa.array(texts[at:at + 4000], pa.string()))
        assert got == want[at:at + 4000], [t for t, a, b in zip(texts[at:], got, want[at:]) if a != b][:3]


def test_other_vocabularies_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    other, tokenizer = Tokenizer.from_file(path), pk.ChunkTokenizer(path)
    texts = [t for t in ODD if t is None or "<|" not in t]
    assert not tokenizer.by_strings and tokenizer.encode(pa.array(texts, pa.string())) == [ids_of(other, t) for t in texts]


def test_best_fit_is_the_tightest():
    rnd, window = random.Random(2), 64
    tree, rooms = pk.OpenWindows(window), {}
    for number in range(3000):
        need = rnd.randrange(1, window + 1)
        fits = [r for r in rooms.values() if r >= need]
        found = tree.take_tightest(need)
        assert (found is None) == (not fits)
        if found:
            assert found[0] == min(fits) and rooms.pop(found[1]) == found[0]
        room, key = found or (window, number)
        if room > need:
            tree.add(room - need, key)
            rooms[key] = room - need


@pytest.mark.parametrize("bucket_tokens", [1 << 20, 400])
def test_pieces_are_whole(spark, plain, bucket_tokens):
    rnd = random.Random(4)
    texts = ODD + [" ".join(rnd.choice(["the", "cat", "zyx", "é"]) for _ in range(rnd.randrange(200))) for _ in range(80)]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(3, ODD[3], 7), (3, ODD[3], 7), (None, "no id", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int")
    out = pk.pack_documents(docs, window=128, bucket_tokens=bucket_tokens).collect()
    want = defaultdict(int)
    for i, t, _ in rows:
        ids = ids_of(plain, t) + (2).to_bytes(4, "little")
        for s in range(0, len(ids), 512):
            want[i, s // 4, len(ids[s:s + 512]) // 4, zlib.crc32(ids[s:s + 512]), len(ids) // 4] += 1
    got, used = defaultdict(int), defaultdict(list)
    for r in out:
        got[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        used[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 128
    tokens = sum(r.length for r in out)
    if bucket_tokens == 1 << 20:
        assert len(used) * 128 < tokens * 1.05 + 128
    assert pk.pack_documents(docs.limit(0)).count() == 0
