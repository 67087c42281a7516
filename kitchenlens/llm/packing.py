"""Packing: token pieces into fixed windows, best fit decreasing."""

from __future__ import annotations

import json
import sys
import types
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, table

WINDOW = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Tokens packed together: 256 windows, of which the last may stay partly empty.
BUCKET_TOKENS = 1 << 20
#: White-space separated strings whose ids a worker remembers, and their longest length.
REMEMBERED, REMEMBERED_CHARS = 200_000, 48
PLAIN_END = "\u0530"
PUNCTUATION = ".,;:!?()[]{}*#%&$@-_=+/\"|<>"


def plain_word(text: str) -> bool:
    """Letters of the Latin, Greek and Cyrillic blocks that stay one letter each in lower case: their word is one piece of text
    for the tokenizer whatever stands beside it.  (A capital I with a dot becomes two characters, of which one is no letter.)"""
    return text.isalpha() and (text.isascii() or max(text) < PLAIN_END and text.lower().isalpha())


class ChunkTokenizer:
    """Ids of whole texts, as the vocabulary file's own tokenizer gives them.

    That tokenizer drops white space and no token spans it, so a text's ids are those of its
    white-space separated strings one after another; the ids of short strings are remembered.
    New strings that are a plain word (``plain_word``) between punctuation marks are taken apart (the
    tokenizer parts them there too) and the new words are encoded together; any other string is encoded whole.
    A vocabulary file of another kind (its normaliser keeps white space or case, or words have no end mark) encodes whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.inner = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}       # the young half of what is remembered; what is met again stays
        self.old: dict[str, bytes] = {}
        steps = json.loads(self.inner.to_str())
        kinds = [n["type"] for n in (steps["normalizer"] or {}).get("normalizers", [])]
        split = ((steps["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        #: ids of a text are those of its white-space separated, lower-cased strings
        self.by_strings = (kinds == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed" and bool(split.get("invert"))
                           and steps["model"].get("end_of_word_suffix") == "</w>")
        names = self.inner.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)     # ids of tokens that end a word
        self.ends[[i for t, i in names.items() if t.endswith("</w>")]] = True

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.inner.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, all from one call; every word ends with the id of a word's last token."""
        if not words:
            return []
        ids = np.array(self.inner.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) != len(words) or stops[-1] != 4 * len(ids):
            return self._each(words)
        data = ids.tobytes()
        return [data[x:y] for x, y in zip([0, *stops], stops)]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of new strings."""
        split, whole, words, marks = [], [], set(), set()
        for text in new:
            if plain_word(text):
                words.add(text)
                continue
            core = text.strip(PUNCTUATION)
            if plain_word(core):
                at = text.index(core)
                split.append((text, text[:at], core, text[at + len(core):]))
                words.add(core)
                marks.update(split[-1][1::2])
            else:
                whole.append(text)
        known = self.known
        parts = {w: known[w] for w in words if w in known}
        fresh = [w for w in words if w not in parts]
        parts.update(zip(fresh, self._words(fresh)))
        parts.update(zip(marks, self._each(list(marks))))
        parts.update(zip(whole, self._each(whole)))
        parts.update((text, parts[left] + parts[core] + parts[right]) for text, left, core, right in split)
        return parts

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (null: empty) as little-endian unsigned 32-bit numbers."""
        if not self.by_strings:
            return self._each([t or "" for t in texts.to_pylist()])
        # a copy of its own: the kernels below read a slice's neighbours
        texts = pc.fill_null(texts.cast(pa.large_string()), "").take(pa.array(np.arange(len(texts))))
        odd = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)).tolist()
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = lists.flatten().dictionary_encode()
        here, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if len(self.known) > REMEMBERED // 2:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        pieces = list(map(known.get, here))
        for i, piece in enumerate(pieces):
            if piece is None and (piece := old.get(here[i])) is not None:
                pieces[i] = known[here[i]] = piece
        missing = [i for i, piece in enumerate(pieces) if piece is None]
        learned = self._learn([here[i] for i in missing])
        for i in missing:
            pieces[i] = learned[here[i]]
        known.update((c, i) for c, i in learned.items() if len(c) <= REMEMBERED_CHARS)
        # the ids of all texts in a row: those of each string, gathered by the strings' numbers
        length = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        first = np.concatenate([[0], np.cumsum(length)])
        n = length[which]
        before = np.concatenate([[0], np.cumsum(n)])
        ids = np.frombuffer(b"".join(pieces), "<u4")[np.repeat(first[which] - before[:-1], n) + np.arange(before[-1])]
        ends = before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        out = [ids[x:y].tobytes() for x, y in zip(ends, ends[1:])]
        for i in odd:       # may hold a special token: encoded as a whole
            out[i] = self._each([texts[i].as_py()])[0]
        return out


def _tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer for each vocabulary file and worker process."""
    kept = sys.modules.setdefault("_kitchenlens_tokenizers", types.ModuleType("_kitchenlens_tokenizers")).__dict__
    if path not in kept:
        kept[path] = ChunkTokenizer(path)
    return kept[path]


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file is on this machine (resolved in the task that reads it)."""
    import public_tokenizers
    return public_tokenizers.path(name) if "/" not in name else name


def _pieces(vocabulary: str, window: int, end_id: int | None, keep_ids: bool):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary_path(vocabulary))
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
                raw = []
                for doc, ids in zip(part["doc_id"].to_pylist(), tokenizer.encode(part["text"])):
                    ids += end
                    for start in range(0, len(ids), 4 * window):
                        piece = ids[start:start + 4 * window]
                        for k, v in zip(rows, (doc, start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)):
                            rows[k].append(v)
                        if keep_ids:
                            raw.append(np.frombuffer(piece, "<u4").astype(np.int32))
                out = {k: pa.array(v, pa.int64()) for k, v in rows.items()}
                if keep_ids:
                    ends = np.cumsum([0, *map(len, raw)]).astype(np.int32)
                    out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(raw) if raw else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_pydict(out)
    return cut


class OpenWindows:
    """Open windows by remaining capacity: a segment tree says which capacities any window has."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves <= window:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.stacks: dict[int, list[int]] = {}

    def add(self, room: int, window_no: int) -> None:
        self.stacks.setdefault(room, []).append(window_no)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at //= 2

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """(room, window) with the least room of at least ``need``; the window leaves the tree."""
        at, count = need + self.leaves, self.count
        while not count[at]:
            while at & 1:           # no leaf to the right under this parent
                at //= 2
                if at == 0:
                    return None
            at += 1
        while at < self.leaves:
            at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        window_no = self.stacks[room].pop()
        while at:
            count[at] -= 1
            at //= 2
        return room, window_no


def _pack(window: int):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Rows come by bucket and falling length, so windows are given out as the rows stream by."""
        bucket, tree, made = None, None, 0
        for batch in batches:
            sequence, offset = [], []
            for b, length in zip(batch["bucket"].to_pylist(), batch["length"].to_pylist()):
                if b != bucket:
                    bucket, tree, made = b, OpenWindows(window), 0
                found = tree.take_tightest(length)
                if found is None:
                    found = (window, made)
                    made += 1
                room, number = found
                if room > length:
                    tree.add(room - length, number)
                sequence.append(b << 32 | number)
                offset.append(window - room)
            keep = {n: batch[n] for n in batch.schema.names if n not in ("bucket", "tie")}
            yield pa.RecordBatch.from_pydict({**keep, "sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())})
    return pack


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   vocabulary: str = VOCABULARY, end_id: int | None = END_ID, keep_ids: bool = True,
                   bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset.

    A document's ids are those of its whole text and then ``end_id``.  Documents longer than a
    window are first cut into full windows and a rest.  Pieces go by falling length into the
    open window with the least room that holds them.  This is done bucket by bucket of about
    ``bucket_tokens`` tokens, so a task holds the windows of one bucket and no rows.

    Null and empty texts are the end id alone (no piece where there is no end id); null ids and
    repeated rows are packed like others; ties are broken by id and start; other input columns
    are not read; an empty table gives an empty result."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    pieces = cut_lineage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                         .mapInArrow(_pieces(vocabulary, window, end_id, keep_ids), schema), "pieces")
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    buckets = max(1, -(-tokens // bucket_tokens))
    # the row number of the written table keeps repeated rows apart, so none fills a bucket
    tie = pieces.withColumn("tie", F.monotonically_increasing_id())
    dealt = tie.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "tie"), F.lit(buckets)))
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", F.desc("length"), "doc_id", "start", "tie")
    return ordered.mapInArrow(_pack(window), schema + ", sequence_id long, offset long")


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), keep_ids=False)
