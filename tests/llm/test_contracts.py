"""The registered queries themselves, over a whole small table, against plain versions of their contracts."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import regex
import xxhash
from tokenizers import Tokenizer

from kitchenlens.llm.langid import op4_language
from kitchenlens.llm.packing import op1_packing
from kitchenlens.llm.sharding import external_shuffle, op8_sharding
from kitchenlens.llm.simhash import op2_simhash

SF = "/root/testdata/sf0.001"


def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op1(spark):
    got = op1_packing(spark, SF)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got.collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    docs = documents(spark)
    assert set(pieces) == set(docs)
    for doc, rows in pieces.items():
        ids = np.array(plain.encode(docs[doc].text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(n for p in sequences.values() for _, n in p) > 0.97 * 4096 * (len(sequences) - 1)


def test_op2(spark):
    got = op2_simhash(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    want = {}
    for doc, r in documents(spark).items():
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        words = [w for w in regex.split("[\x20\x09-\x0d]+", text) if w]
        shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want[doc] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {d: d for d in want}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d
    ids = sorted(want)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (want[a] ^ want[b]).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert sorted(map(tuple, got.collect())) == [(d, f"{want[d]:016x}", top(d)) for d in ids]


def test_op4(spark):
    got = op4_language(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    docs, rows = documents(spark), got.collect()
    langs = {r.lang for r in docs.values()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        lettered = regex.search(r"\p{L}", docs[r.doc_id].text or "")
        assert r.lang_pred in langs if lettered else r.lang_pred == "und"
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang is not None and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.9


def test_op8(spark):
    got = op8_sharding(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    docs, slots, seen = documents(spark), defaultdict(list), []
    for r in got.collect():
        text = (docs[r.doc_id].text or "").encode()
        assert r.size == len(text) + 1 and r.text_crc32 == zlib.crc32(text) and r.law == "rows" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        seen.append(r.doc_id)
    assert sorted(seen) == sorted(docs) and set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shuffle_of_columns_with_its_own_names(spark):
    docs = spark.createDataFrame([(i, f"t{i}", i, -i, f"p{i}", i * 2) for i in range(50)], "doc_id long, text string, __bucket long, __tie int, __position string, before int")
    out = external_shuffle(docs, shards=3)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert sorted(map(tuple, out.drop("shard", "slot").collect())) == sorted(map(tuple, docs.collect()))
