"""The corpus pipeline against the same five decisions written out plainly."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from conftest import SF001
from test_decontaminate import plain_hits
from test_simhash import brute_groups, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from kitchenlens.llm import pii
from kitchenlens.llm import toxicity as tx


def plain_choices(claims, key):
    """Choice of every claim: within a kind and scope no two claims and no real value share a surrogate."""
    real, taken, choice = set(claims), set(), {}
    pending, n = set(claims), 0
    while pending:
        asked = defaultdict(list)
        for c in pending:
            asked[c[0], c[1], pii.surrogate(key, *c, n)].append(c)
        won = {}
        for slot, who in asked.items():
            if slot not in real and slot not in taken:
                won[slot] = min(who, key=lambda c: c[2])
        taken |= set(won)
        choice.update((c, n) for c in won.values())
        pending -= set(won.values())
        n += 1
    return choice


def test_run_against_plain(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = tx.fit_toxicity(docs, labels)
    if model is not None:
        texts = {i: t for i, t in texts.items() if 1 - model.probabilities(model.signal(tx.word_counts(t)))[0] < 0.5}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    root = brute_groups(set(prints.values()), 2)
    first = {}
    for i, p in prints.items():
        first[root[p]] = min(i, first.get(root[p], i))
    texts = {i: texts[i] for i in first.values()}
    texts = {i: t for i, t in texts.items() if not plain_hits(t, items)[1]}
    choice = plain_choices({c for t in texts.values() for c in pii.claims_of(t)}, pii.DEFAULT_KEY)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in texts.items():
        new = pii.rewrite(t, pii.DEFAULT_KEY, choice.__getitem__)[0]
        ids = np.array([*tokenizer.encode(new, add_special_tokens=False).ids, 2], "<u4").tobytes()
        for s in range(0, len(ids), 4 * 4096):
            want[i, s // 4, zlib.crc32(ids[s:s + 4 * 4096])] += 1
    got = corpus_pipeline.run(spark, SF001).collect()
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in got) == want
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096


def test_stages_keep_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(10 ** 9, None, None, None, None), (None, "", None, None, 0), (10 ** 9 + 1, "x " * 200_000, "en", "s", 1)], docs.schema)
    for frame in (docs.limit(0), docs.unionByName(odd)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF001)
            assert out.columns == docs.columns, name
            assert (out.count() == 0) == (frame.limit(1).count() == 0)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "surrogates", "packing"]
