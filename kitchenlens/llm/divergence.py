"""Source divergence: how differently the sources of a language use its terms, on run-length columns."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, cut_lineage, strings, table, word_blocks

MIN_DOCS, SMOOTHING, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: Terms of a block of the vocabulary at most, and entries (term, source with a count above zero) that close a block.
BLOCK_TERMS, BLOCK_ENTRIES = 8192, 1 << 19
#: Entries of a term that decide its place among the ranges of the vocabulary.
RANGE_ENTRIES = 3
#: Sources compared with each other in one task at most twice this many: above it, pairs of tiles of sources.
TILE = 64
#: Distinct (lang, source, term) a task holds before it hands them on.
HELD_TERMS = 400_000
#: A-Z to lower case, every other ASCII character but a-z to a space; bytes of other characters stay.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_blocks(text: str) -> Iterator[list[bytes]]:
    """The terms of a whole text, about a megabyte of it at a time: letters a-z and characters beyond ASCII in a row."""
    return word_blocks(text.encode("utf-8", "replace").translate(_TERMS), BLOCK_BYTES)


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """(lang, source, term, n occurrences, docs documents) of a task; the term "" counts the group's documents."""
    held: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def flush():
        for (lang, source), (n, docs) in held.items():
            terms = list(docs)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(terms), pa.string()), "source": pa.array([source] * len(terms), pa.string()),
                "term": pa.array(terms, pa.binary()).cast(pa.string()), "n": pa.array([n[t] for t in terms], pa.int64()),
                "docs": pa.array([docs[t] for t in terms], pa.int64())})
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strings(batch["text"])):
            n, docs = held[lang, source]
            before, seen = len(docs), {b""}
            for terms in term_blocks(text):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            size += len(docs) - before
            if size > HELD_TERMS:
                yield from flush()
                size = 0
    yield from flush()


def term_table(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, entries): of each term in at least ``min_docs`` documents of its language the occurrences, and
    these by source (source, n, docs).  Term "" lists the sources of each language with their documents.

    Occurrences are counted in the tasks that read the documents and dealt once by (lang, term)."""
    def text(name):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name)
    return (docs.select(text("lang"), text("source"), text("text"))
            .mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n", "docs")).alias("entries"))
            .where((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs"))


def kept_entries(terms: DataFrame) -> DataFrame:
    """(lang, term, total, source, n): one row for each kept term and source that has it."""
    return (terms.where("term <> ''").select("lang", "term", "total", F.explode("entries").alias("e"))
            .select("lang", "term", "total", "e.source", F.col("e.n").alias("n")))


RUNS = "lang string, block long, terms long, source string, lengths array<long>, counts array<long>"


def _encode_block(lang: str, block: int, rows: list[list[dict]], out: dict[str, list]) -> None:
    """Run lengths and counts of each source over the terms of a block, in their order; a source without a count
    in the block has no row.  What follows a column's last run is zero."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n = np.array([e["n"] for r in rows for e in r], np.int64)
    names = [e["source"] for r in rows for e in r]
    code = {s: i for i, s in enumerate(sorted(set(names)))}
    source = np.fromiter((code[s] for s in names), np.int64, len(names))
    order = np.lexsort((at, source))
    at, n, source = at[order], n[order], source[order]
    starts = np.concatenate([[True], (source[1:] != source[:-1]) | (n[1:] != n[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(starts)
    last = np.append(first[1:], len(at)) - 1
    for i, name in enumerate(sorted(code)):
        lo, hi = np.searchsorted(source[first], [i, i + 1])
        begin, end, value = at[first[lo:hi]], at[last[lo:hi]] + 1, n[first[lo:hi]]
        gap = begin - np.concatenate([[0], end[:-1]])
        lengths, counts = np.column_stack([gap, end - begin]).ravel(), np.column_stack([np.zeros_like(value), value]).ravel()
        keep = lengths > 0
        for k, v in zip(out, (lang, block, len(rows), name, lengths[keep], counts[keep])):
            out[k].append(v)


def _encode_runs(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Rows come by language and entries; each block's columns go out when it is full or the language changes."""
    from pyspark import TaskContext
    block, lang, rows, entries = TaskContext.get().partitionId() << 32, None, [], 0

    def close():
        out: dict[str, list] = {k: [] for k in ("lang", "block", "terms", "source", "lengths", "counts")}
        _encode_block(lang, block, rows, out)
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})

    for batch in batches:
        for here, row in zip(batch["lang"].to_pylist(), batch["entries"].to_pylist()):
            if rows and (here != lang or len(rows) >= BLOCK_TERMS or entries >= BLOCK_ENTRIES):
                yield close()
                block, rows, entries = block + 1, [], 0
            lang = here
            rows.append(row)
            entries += len(row)
    if rows:
        yield close()


def run_columns(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, block, terms, source, lengths, counts): the vocabulary of each language in blocks, and each source's counts over
    a block as run lengths.

    The vocabulary is reordered by the terms' counts, those of the sources with the fewest occurrences first: terms with
    equal counts lie side by side, and the columns with few distinct counts have the longest runs."""
    weight = groups.select("lang", "source", F.col("n").alias("weight"))
    kept = (entries.join(weight, ["lang", "source"]).groupBy("lang", "term")
            .agg(F.array_sort(F.collect_list(F.struct("weight", "source", "n"))).alias("entries")))
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges are cut by the beginning of the entries and by hashes of them all: the keys that are sampled stay short
    beginning = F.transform(F.slice("entries", 1, RANGE_ENTRIES), lambda e: F.struct(e["weight"], e["n"]))
    return (kept.repartitionByRange(parts, "lang", beginning, F.xxhash64("entries"), F.xxhash64("term")).sortWithinPartitions("lang", "entries", "term")
            .select("lang", "entries").mapInArrow(_encode_runs, RUNS))


def smoothed(count: np.ndarray, n: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTHING) / (n + SMOOTHING * terms)), exactly."""
    if len(count) and int(count.max()) < 2 ** 62 // SCALE:
        return 1 + SCALE * (count + SMOOTHING) // (n + SMOOTHING * terms)
    return np.array([1 + SCALE * (int(c) + SMOOTHING) // (n + SMOOTHING * terms) for c in count], np.int64)


def run_distance(ends_a: np.ndarray, p_a: np.ndarray, ends_b: np.ndarray, p_b: np.ndarray) -> int:
    """Sum of abs(p - q) over all terms: at the ends of either column's runs both change, between them f counts run length times."""
    ends = np.union1d(ends_a, ends_b)
    f = np.abs(p_a[np.searchsorted(ends_a, ends)] - p_b[np.searchsorted(ends_b, ends)])
    return int(f @ np.diff(ends, prepend=0))


def _pair_block(rows: pa.Table) -> pa.Table:
    """Partial sums over one block of every pair of sources of a tile pair."""
    out: dict[str, list] = {"lang": [], "source": [], "item": [], "value": []}
    lang, left, right = (rows[c][0].as_py() for c in ("lang", "tile_a", "tile_b"))
    columns = []
    for source, tile, n, v, terms, lengths, counts in zip(*(rows[c].to_pylist() for c in ("source", "tile", "n", "v", "terms", "lengths", "counts"))):
        ends, counts = np.cumsum(np.array(lengths or [], np.int64)), np.array(counts or [], np.int64)
        if terms and (not len(ends) or ends[-1] < terms):      # what follows the last run is zero
            ends, counts = np.append(ends, terms), np.append(counts, 0)
        columns.append((source, tile, ends, smoothed(counts, n, v) if terms else counts))
    columns.sort(key=lambda c: (c[1], c[0]))
    for i, (a, tile, ends_a, p_a) in enumerate(columns):
        if tile != left:
            break
        for b, other, ends_b, p_b in columns[i + 1:]:
            if other == right:
                value = run_distance(ends_a, p_a, ends_b, p_b) if len(ends_a) else 0
                for k, x in zip(out, (lang, a, b, value)):
                    out[k].append(x)
    return pa.table({k: pa.array(x, pa.int64() if k == "value" else pa.string()) for k, x in out.items()})


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` gives each other source of the language by falling
    distance, part ``term`` the ``top_terms`` terms that a source uses more than its language.

    Terms, smoothing and distance are those of ``term_blocks`` and ``smoothed``; a language keeps the terms in at least ``min_docs``
    of its documents.  Null and empty texts have no term; null languages and sources are ''.  Repeated rows
    count repeatedly; ties of value go by item; languages without a kept term have distances 0; a source
    alone in its language has no pair; an empty table gives no rows; other input columns are not read.

    A hot source is counted in the tasks that read it; blocks of the vocabulary spread a hot language."""
    found = cut_lineage(term_table(docs, min_docs), "term-table")
    entries = kept_entries(found)
    per_lang = found.where("term <> ''").groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    listed = found.where("term = ''").select("lang", F.explode("entries.source").alias("source"))
    groups = cut_lineage(listed.join(per_lang, "lang", "left").join(sizes, ["lang", "source"], "left").na.fill(0, ["v", "lang_n", "n"]), "groups")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    tiles = -(-most // tile) or 1
    runs = cut_lineage(run_columns(entries, groups), "runs")
    # every source of a language has a column in every block; block -1, without terms, lists the pairs where nothing is kept
    blocks = runs.select("lang", "block", "terms").distinct().unionByName(
        groups.select("lang", F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("terms")).distinct())
    columns = (blocks.join(groups.select("lang", "source", "n", "v"), "lang")
               .join(runs.drop("terms"), ["lang", "block", "source"], "left")
               .withColumn("tile", F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")))
    others = F.sequence(F.lit(0), F.lit(tiles - 1))
    dealt = columns.withColumn("with", F.explode(others)).select(
        "*", F.least("tile", "with").alias("tile_a"), F.greatest("tile", "with").alias("tile_b"))
    sums = (dealt.groupBy("lang", "block", "tile_a", "tile_b").applyInArrow(_pair_block, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    sums = cut_lineage(sums, "pair-sums")
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    def p(count, n):        # in decimals: a count times SCALE needn't fit a long
        return F.expr(f"1 + (cast({SCALE} as decimal(20,0)) * ({count} + {SMOOTHING})) div ({n} + {SMOOTHING} * v)")
    terms = (entries.withColumnRenamed("n", "n_here").join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p("n_here", "n") - p("total", "lang_n")).alias("value"))
             .where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms))
    return pairs.unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that set each source apart."""
    return source_divergence(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
occ AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.total, coalesce(o.n, 0) AS n
      FROM grp g JOIN kept k ON k.lang = g.lang
      LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM occ GROUP BY ALL) o
        ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
pq AS (SELECT lang, source, term, n,
              1 + ({SCALE}::HUGEINT * (n + {SMOOTHING})) // (sum(n) OVER (PARTITION BY lang, source) + {SMOOTHING} * count(*) OVER (PARTITION BY lang, source))::HUGEINT AS p,
              1 + ({SCALE}::HUGEINT * (total + {SMOOTHING})) // (sum(total) OVER (PARTITION BY lang, source) + {SMOOTHING} * count(*) OVER (PARTITION BY lang, source))::HUGEINT AS q
       FROM c),
dist AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM pq a JOIN pq b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
         FROM grp g JOIN grp h ON g.lang = h.lang AND g.source <> h.source
         LEFT JOIN dist x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM pq WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
