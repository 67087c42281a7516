"""SimHash near-duplicates: fingerprints, multi-index links, connected groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, strings, table, unused_name, word_blocks
from .components import connected_components

HASH_SEED = 42
#: Ids of surviving documents that are broadcast at most (some 60 MB as a hash table); more are joined by a shuffle.
MAX_BROADCAST_IDS = 2_000_000
#: Pairs compared directly under one segment value; busier values take the exact hub way.
BUCKET_PAIRS = 4096


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash (unsigned) of one text; 0 where it has no word."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    digest, ones, total, carry = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for words in word_blocks(data):
        words = carry + words
        rows = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] if shingle != 3 else [
            b"%b %b %b" % t for t in zip(words, words[1:], words[2:])]
        carry = words[len(words) - shingle + 1:] if len(words) >= shingle else words
        if not rows:
            continue
        hashes = np.fromiter((digest(r, HASH_SEED) for r in rows), np.uint64, len(rows))
        for at in range(0, len(hashes), 1 << 15):
            part = hashes[at:at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        total += len(rows)
    if not total:
        if not carry:
            return 0
        return digest(b" ".join(carry), HASH_SEED)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprint_column(text, shingle: int = 3):
    """Column with the signed 64-bit SimHash of a text column (null and word-free texts: 0)."""
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t, shingle) for t in strings(texts)), np.uint64, len(texts))
        return pa.array(values.view(np.int64))
    return simhash(text)


def _balls(nodes: DataFrame, distance: int) -> DataFrame:
    """Segment table entries: (key, fp, home).  ``home`` rows are stored under their own segment value;
    the others visit the values in a small Hamming ball around theirs.

    A pair within ``distance`` bits differs in at most ``distance // 2`` bits of the high half, or in at
    most ``(distance - 1) // 2`` bits of the low one, so only those two balls are enumerated.
    Balls are enumerated upwards only (0 bits set to 1 and so on pairwise), which meets each pair."""
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))
    parts = []
    for segment, value, radius in ((0, high, distance // 2), (1, low, (distance - 1) // 2)):
        key = (F.lit(segment << 32).cast("long") + value)
        parts.append(nodes.select(key.alias("key"), "fp", F.lit(True).alias("home")))
        masks = []
        for size in range(1, radius + 1):
            masks += _masks(size)
        if masks:
            flips = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))
            keys = F.transform(F.filter(flips, lambda v: v > value), lambda v: v + F.lit(segment << 32).cast("long"))
            parts.append(nodes.select(F.explode(keys).alias("key"), "fp", F.lit(False).alias("home")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _masks(size: int, bits: int = 32) -> list[int]:
    if size == 1:
        return [1 << i for i in range(bits)]
    return sorted({m | (1 << i) for m in _masks(size - 1, bits) for i in range(bits) if not m >> i & 1})


def _hub_links(nodes: DataFrame, distance: int) -> DataFrame:
    """Links among ``nodes`` without comparing pairs: two fingerprints within 2 r bits share a value within
    r bits of both, so all that reach a value link to the smallest that does (at most ball-size rows meet)."""
    radius, odd = divmod(distance, 2)
    masks = [0, *[m for size in range(1, radius + 1) for m in _masks(size, 64)]]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    reach = nodes.select("fp", F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in signed]),
                                                     lambda m: F.col("fp").bitwiseXOR(m))).alias("centre"))
    if odd:     # one side goes a bit further: an exact join of the two balls, each value holds few rows
        wide = [m - (1 << 64) if m >> 63 else m for m in _masks(radius + 1, 64)]
        far = nodes.select("fp", F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in wide]),
                                                       lambda m: F.col("fp").bitwiseXOR(m))).alias("centre"))
        return (reach.join(far.withColumnRenamed("fp", "other"), "centre")
                .select(F.col("fp").alias("a"), F.col("other").alias("b")).distinct())
    hubs = reach.groupBy("centre").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1")
    return reach.join(hubs, "centre").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def near_links(nodes: DataFrame, distance: int = 2, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) at ``distance`` or fewer differing bits.

    Multi-index hashing: each fingerprint is stored under its two 32-bit halves and visits the
    values in a small ball around them; every match is verified on all 64 bits.  Under a segment
    value with more than ``bucket_pairs`` possible pairs (thousands of near copies share it) the
    same links are found by hubs instead: not each pair comes back then, but all that are linked
    stay connected."""
    if distance < 1:
        return nodes.sparkSession.createDataFrame([], "a long, b long")
    entries = _balls(nodes, distance)
    sizes = entries.groupBy("key").agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
    sizes = cut_lineage(sizes.where("homes > 0 and n > 1").select("key", (F.col("n") * F.col("homes") > bucket_pairs).alias("busy")), "keys")
    met = entries.join(sizes, "key")
    quiet = met.where("not busy")
    pairs = (quiet.where("home").select("key", F.col("fp").alias("a"))
             .join(quiet.select("key", F.col("fp").alias("b"), "home"), "key")
             .where("(not home or b > a) and bit_count(a ^ b) <= " + str(int(distance)))
             .select("a", "b"))
    if sizes.where("busy").isEmpty():
        return pairs.distinct()
    crowd = met.where("busy").select("fp").distinct()
    return pairs.unionByName(_hub_links(crowd, distance)).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   distance: int = 2) -> DataFrame:
    """(doc_id, fingerprint long, component_id): component_id is the smallest id whose fingerprint is reachable
    over links of ``distance`` or fewer bits.

    Null, empty and word-free texts have fingerprint 0 and are linked like any other.  Repeated rows
    come back repeated.  Null ids are ignored by the minimum (null only where a whole group has none).
    Other input columns are not read.  An empty table gives an empty result."""
    prints = cut_lineage(docs.select(F.col(id_col).alias("doc_id"),
                                     fingerprint_column(F.col(text_col), shingle).alias("fp")), "prints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = connected_components(near_links(nodes.select("fp"), distance))
    owner = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = owner.groupBy("root").agg(F.min("first_id").alias("component_id"))
    owner = owner.join(least, "root").select("fp", "component_id")
    return prints.join(owner, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                     distance: int = 2) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id.

    All columns stay.  Rows without an id belong to no group and stay; of rows that repeat a
    surviving id one stays."""
    groups = cut_lineage(simhash_groups(docs, id_col, text_col, shingle, distance), "groups")
    kept = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    kept = cut_lineage(kept, "kept")
    names, mark = [F.col(f"`{c}`") for c in docs.columns], unused_name(docs, "kept_id")
    once = kept.where("n = 1").select(F.col("doc_id").alias(mark))
    once = F.broadcast(once) if once.count() <= MAX_BROADCAST_IDS else once       # the ids go to the texts while they are few enough
    out = docs.join(once, F.col(id_col) == F.col(mark), "left_semi").select(*names)
    if not kept.where("n > 1").isEmpty():
        again = docs.join(kept.where("n > 1").select(F.col("doc_id").alias(mark)),
                          F.col(id_col) == F.col(mark), "left_semi")
        out = out.unionByName(again.dropDuplicates([id_col]).select(*names))
    return out.unionByName(docs.where(F.col(id_col).isNull()).select(*names))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: three-word shingles, two bits."""
    found = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
