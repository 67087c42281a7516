"""Benchmark decontamination: word windows of benchmark items found in documents by Wu-Manber search."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, strings, table, unused_name, with_column_replaced, word_blocks

WINDOW = 10
#: Windows searched for in one pass (about 40 MB of tables); more are searched in further passes.
WINDOWS_PER_PASS = 100_000

#: A-Z to lower case, every other ASCII byte that is not a letter or digit to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def words_of(text: str | None) -> list[bytes]:
    return folded(text).split()


def item_windows(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    if len(words) <= width:
        return [tuple(words)] if words else []
    return [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]


class PatternTable:
    """Wu-Manber tables for word patterns of one length, over blocks of two words (one for one-word patterns).

    ``shift`` says for the block that ends at a position how many words the search may skip
    (blocks in no pattern: the longest skip); a block that ends a pattern has shift 0 and leads to
    the bucket of patterns with that suffix, which are compared word by word, first word first."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.longest = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = defaultdict(lambda: defaultdict(list))
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                key = words[end - self.block:end] if self.block == 2 else words[end - 1]
                self.shift[key] = min(self.shift.get(key, self.longest), length - end)
            self.bucket[key][words[0]].append((words, items))
        self.bucket = {k: dict(v) for k, v in self.bucket.items()}

    def search(self, words: list[bytes], found) -> None:
        """Calls found(first position, items) for every occurrence in ``words``."""
        n, length, skip, longest = len(words), self.length, self.shift.get, self.longest
        at, pairs = length - 1, self.block == 2
        while at < n:
            key = (words[at - 1], words[at]) if pairs else words[at]
            step = skip(key, longest)
            if step:
                at += step
                continue
            first = at - length + 1
            for pattern, items in self.bucket[key].get(words[first], ()):
                if tuple(words[first:at + 1]) == pattern:
                    found(first, items)
            at += 1


def pattern_tables(items: Iterable[tuple[str, str | None]], width: int) -> list[PatternTable]:
    """One table for each pattern length, so short items don't shorten the skips of full windows."""
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        for window in set(item_windows(words_of(text), width)):
            by_length[len(window)][window].append(item)
    return [PatternTable(dict(v), k) for k, v in sorted(by_length.items())]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def search_text(text: str | None, tables: list[PatternTable]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words, disjoint hit ranges of word positions, items that occur) of a whole text."""
    spans, items, base, carry = [], set(), 0, []
    reach = max((t.length for t in tables), default=1) - 1
    for words in word_blocks(folded(text)):
        words, base = carry + words, base - len(carry)
        for t in tables:
            def found(first, its, base=base, length=t.length):
                spans.append((base + first, base + first + length))
                items.update(its)
            t.search(words, found)
        base += len(words)
        carry = words[len(words) - reach:] if reach and len(words) > reach else words if reach else []
    return base, _merge(list(set(spans))), items


HITS = "struct<n_words:long,spans:array<struct<start:long,stop:long>>,items:array<string>>"
_HITS = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                   ("items", pa.list_(pa.string()))])


def _passes(benchmark: DataFrame, id_col: str, text_col: str, width: int, per_pass: int):
    """Lists of (item, text) with ``per_pass`` windows or a little more each, read one item after another."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                            F.col(text_col).alias("text")).where("text is not null")
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row.item, row.text))
        size += max(1, len(words_of(row.text)) - width + 1)
        if size >= per_pass:
            yield held
            held, size = [], 0
    if held:
        yield held


def _hits_udf(held, width: int):
    made: dict = {}

    @F.arrow_udf(HITS)
    def hits(texts: pa.Array, before: pa.Array) -> pa.Array:
        if not made:        # once a task
            made["tables"] = pattern_tables(held.value, width)
        rows = []
        for text, old in zip(strings(texts), before.to_pylist()):
            n_words, spans, items = search_text(text, made["tables"])
            if old is not None and (old["spans"] or old["items"]):
                items |= set(old["items"])
                spans = _merge(spans + [(s["start"], s["stop"]) for s in old["spans"]])
            rows.append({"n_words": n_words, "spans": [{"start": a, "stop": b} for a, b in spans], "items": sorted(items)})
        return pa.array(rows, _HITS)
    return hits


def with_benchmark_hits(docs: DataFrame, benchmark: DataFrame, out_col: str = "hits", text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW,
                        windows_per_pass: int = WINDOWS_PER_PASS) -> DataFrame:
    """``docs`` with struct ``out_col``: n_words, spans (disjoint ranges of hit word positions), items.

    Null and word-free texts have no words and no hits.  Items without words have no windows;
    those shorter than ``width`` words are one window; items with the same id count once and
    null ids count as the empty id.  Ties don't arise; repeated rows come back repeated.  An input
    column named ``out_col`` is replaced.  Benchmarks above ``windows_per_pass`` windows are
    searched for in several passes over the documents, each with tables of that bounded size."""
    spark, out, n = docs.sparkSession, docs, 0
    for items_here in _passes(benchmark, item_col, item_text_col, width, windows_per_pass):
        hits, first = _hits_udf(spark.sparkContext.broadcast(items_here), width), n == 0
        before = F.lit(None).cast(HITS) if first else F.col(f"`{out_col}`")
        out = with_column_replaced(out if first else cut_lineage(out, "hits"), out_col,
                                   hits(F.col(f"`{text_col}`"), before))
        n += 1
    if not n:
        @F.arrow_udf(HITS)
        def words_only(texts: pa.Array) -> pa.Array:
            return pa.array([{"n_words": len(words_of(t)), "spans": [], "items": []} for t in strings(texts)], _HITS)
        out = with_column_replaced(out, out_col, words_only(F.col(f"`{text_col}`")))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns stay."""
    mark = unused_name(docs, "benchmark_hits")
    return with_benchmark_hits(docs, benchmark, mark, **kw).where(F.size(f"{mark}.spans") == 0).drop(mark)


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark words in every document, windows of ten words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = with_benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", F.col("hits.n_words").alias("n_words"),
                       F.aggregate("hits.spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("n_hit"),
                       F.size("hits.items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
                       (F.size("hits.spans") > 0).alias("contaminated"))


_WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
OP6_SQL = f"""
WITH dw AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
     iw AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
     iwin AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS win
              FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS pos FROM iw WHERE len(w) > 0)),
     dwin AS (SELECT doc_id, pos, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS win
              FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM dw, (SELECT DISTINCT n FROM iwin) WHERE len(w) >= n)),
     found AS (SELECT doc_id, pos, d.n, item_id FROM dwin d JOIN iwin i ON d.n = i.n AND d.win = i.win),
     hit AS (SELECT doc_id, COUNT(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS place FROM found) GROUP BY doc_id),
     items AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
               FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON hit.doc_id = dw.doc_id LEFT JOIN items ON items.doc_id = dw.doc_id
"""
