"""Hard-negative mining: the best other-label rows in a window below each positive's score, by disjoint slots."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, table

#: Every so many ids an anchor, positives of an anchor, negatives of a positive, percent of the positive's score.
ANCHOR_EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 100, 5, 10, 30, 90
#: Components are floor(STEPS * x).
STEPS = 256
#: Bytes of anchor vectors broadcast at a time (more anchors, more passes over the table), and the most scores in memory.
ANCHOR_BYTES, SCORE_CELLS = 32 << 20, 1 << 21
ANCHORS_AT_ONCE = 2048
LONGEST = 2 ** 63 - 1


def usable_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, vector array<double>, label) without rows that hold a null id, label or vector, or a null or
    non-finite component."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
                          F.col(f"`{label_col}`").cast("long").alias("label")).where("vec_id is not null and label is not null and vector is not null")
    return rows.where(~F.exists("vector", lambda x: x.isNull() | F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True))))


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    """floor(STEPS * x) as doubles, or as Python integers where doubles would overflow."""
    with np.errstate(over="ignore"):
        out = np.floor(STEPS * flat)
    if np.isfinite(out).all():
        return out
    return np.array([int(x) * STEPS if abs(x) > 2 ** 60 else int(np.floor(STEPS * x)) for x in flat.tolist()], object)


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products as longs, exactly: in doubles where these hold every partial sum, else in Python integers
    (beyond a long the score is the longest one of its sign)."""
    if rows.dtype != object and anchors.dtype != object:
        top = (np.abs(rows).max(initial=0.0), np.abs(anchors).max(initial=0.0))
        if rows.shape[1] * top[0] * top[1] < 2.0 ** 53:
            return (rows @ anchors.T).astype(np.int64)
    whole = [np.array([int(x) for x in m.ravel()], object).reshape(m.shape) for m in (rows, anchors)]
    exact = whole[0] @ whole[1].T if rows.shape[1] else np.zeros((len(rows), len(anchors)), object)
    return np.array([max(-LONGEST, min(LONGEST, int(x))) for x in exact.ravel()], np.int64).reshape(exact.shape)


class Best:
    """The first ``k`` (score, id) of each of ``slots`` slots: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, k: int):
        self.k, self.floor = k, np.full(slots, -LONGEST - 1, np.int64)      # floor: score of the k-th so far
        self.slot = self.score = self.id = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        worth = score >= self.floor[slot]
        if not worth.any():
            return
        slot, score, id_ = (np.concatenate([old, new[worth]]) for old, new in ((self.slot, slot), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, slot))
        slot, score, id_ = slot[order], score[order], id_[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], id_[keep]
        full = place == self.k - 1
        self.floor[slot[full]] = score[full]


class Anchors:
    """A chunk of anchors: id, label and vector of each, and the upper limits of its slots where these are known.

    The slots of an anchor are disjoint and fall: slot j holds the scores of at most limits[j] and above limits[j + 1];
    the last one goes down to ``least``.  A limit that repeats another has an empty slot."""

    def __init__(self, ids, labels, flat, lengths, limits=None, least=None):
        self.ids, self.labels, self.least = ids, labels, least
        self.limits = None if limits is None else limits.reshape(len(ids), -1) if len(ids) else np.zeros((0, 1), np.int64)
        self.slots = 1 if limits is None else self.limits.shape[1]
        starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.blocks = []        # (vector length, places of the anchors, their components): as many as SCORE_CELLS bears
        for d in np.unique(lengths):
            places = np.flatnonzero(lengths == d)
            for x in range(0, len(places), ANCHORS_AT_ONCE):
                at = places[x:x + ANCHORS_AT_ONCE]
                self.blocks.append((int(d), at, whole_numbers(flat[(starts[at][:, None] + np.arange(d, dtype=np.int64)).ravel()]).reshape(len(at), int(d))))

    def search(self, batches: Iterable[pa.RecordBatch], k: int) -> Iterable[tuple]:
        """(anchor places, slots, scores, ids).  With limits: the first ``k`` other-label rows of each slot; without: the
        first ``k`` other rows of the same label."""
        best = [Best(len(at) * self.slots, k) for _, at, _ in self.blocks]
        for batch in batches:
            column = batch["vector"]
            ends, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy(zero_copy_only=False)
            ids, labels, lengths = batch["vec_id"].to_numpy(), batch["label"].to_numpy(), np.diff(ends)
            for d in {d for d, _, _ in self.blocks}:
                rows = np.flatnonzero(lengths == d)
                for x in range(0, len(rows), max(1, SCORE_CELLS // ANCHORS_AT_ONCE)):
                    here = rows[x:x + max(1, SCORE_CELLS // ANCHORS_AT_ONCE)]
                    matrix = whole_numbers(flat[(ends[here][:, None] + np.arange(d)).ravel()]).reshape(len(here), d)
                    for held, (size, at, anchors) in zip(best, self.blocks):
                        if size == d:
                            self._score(held, at, products(matrix, anchors), ids[here], labels[here])
        for held, (_, at, _) in zip(best, self.blocks):
            yield at[held.slot // self.slots], held.slot % self.slots, held.score, held.id

    def _score(self, best: Best, at: np.ndarray, score: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        same, other = labels[:, None] == self.labels[at][None, :], ids[:, None] != self.ids[at][None, :]
        if self.limits is None:
            row, col = np.nonzero(same & other & (score >= best.floor[None, :]))
            best.add(col, score[row, col], ids[row])
            return
        limits = self.limits[at]
        row, col = np.nonzero(~same & other & (score <= limits[:, 0][None, :]) & (score >= self.least[at][None, :]))
        value = score[row, col]
        slot = (limits[col] >= value[:, None]).sum(axis=1) - 1      # the last slot whose limit is not below the score
        best.add(col * self.slots + slot, value, ids[row])


def _arrays(rows: pa.Table, limits: bool) -> tuple:
    """A chunk of anchors as arrays."""
    vectors = rows["vector"]
    lengths = np.concatenate([np.diff(c.offsets.to_numpy()) for c in vectors.chunks] or [np.zeros(0, np.int64)]).astype(np.int64)
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in vectors.chunks] or [np.zeros(0)])
    out = (rows["vec_id"].to_numpy(), rows["label"].to_numpy(), flat, lengths)
    if limits:
        out += (np.concatenate([c.flatten().to_numpy() for c in rows["limits"].chunks] or [np.zeros(0, np.int64)]), rows["least"].to_numpy())
    return out


FOUND = "anchor_id long, slot int, score long, vec_id long"


def _searcher(held, k: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        anchors = Anchors(*held.value)
        for at, slot, score, ids in anchors.search(batches, k):
            yield pa.RecordBatch.from_pydict({"anchor_id": pa.array(anchors.ids[at]), "slot": pa.array(slot.astype(np.int32)),
                                              "score": pa.array(score), "vec_id": pa.array(ids)})
    return search


def _search(rows: DataFrame, anchors: DataFrame, chunks: int, k: int, limits: bool) -> DataFrame:
    """The first ``k`` rows of every slot of every anchor.  Each pass over the table takes one bounded chunk of anchors
    with it; a task hands on what is left of its rows, ``k`` a slot, and a window does the same for all tasks."""
    spark, found = rows.sparkSession, None
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    for chunk in range(chunks):
        here = anchors if chunks == 1 else anchors.where(F.col("chunk") == chunk)
        held = spark.sparkContext.broadcast(_arrays(here.toArrow(), limits))        # ANCHOR_BYTES of vectors at most
        part = rows.mapInArrow(_searcher(held, k), FOUND).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        part = cut_lineage(part, "slots") if chunks > 1 else part
        found = part if found is None else found.unionByName(part)
    return found


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchor_every: int = ANCHOR_EVERY,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the ids divisible by ``anchor_every``; an anchor's positives are its first ``positives`` other rows of the same label
    by the integer inner product of floor(256 x); a positive's negatives are the first ``negatives`` rows of other labels
    whose score is between ``low`` and ``high`` percent of the positive's.  Higher scores come first, ties by smaller id.

    The upper limits of an anchor's positives split the scores into disjoint slots that fall.  Every task, and then the window over all
    tasks, keeps the first ``negatives`` rows of each slot; a positive's answer is the beginning of its own slot and all
    below it in a row, cut at its lower limit.  So windows that overlap are answered from the same few rows.

    Rows without an id, label or vector, or with a null or non-finite component, take no part; nor do rows whose vector is of
    another length with an anchor.  Of rows that repeat an anchor's id one (smallest label and vector) is the anchor, and none is its own
    positive; other repeated rows count each.  A positive with a negative score has an empty window.  Scores beyond a long are the
    longest one of their sign.  An empty table gives no rows; other input columns are not read."""
    rows = usable_rows(vectors, id_col, vector_col, label_col)
    anchors = (rows.where(F.col("vec_id") % anchor_every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
               .select("vec_id", "row.label", "row.vector"))
    anchors = cut_lineage(anchors, "anchors")
    total, longest = anchors.agg(F.count("*"), F.max(F.size("vector"))).first()
    chunks = max(1, -(-total * 8 * max(1, longest or 1) // anchor_bytes))
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)))
    best = cut_lineage(_search(rows, anchors, chunks, positives, limits=False), "positives")
    score = "cast(score as decimal(20,0))"
    upper, lower = F.expr(f"({score} * {int(high)}) div 100"), F.expr(f"({score} * {int(low)} + 99) div 100")
    # a negative score's window is empty: such a positive has no slot
    wanted = best.where("score >= 0").select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                                             (F.col("place") - 1).alias("slot"), upper.alias("upper"), lower.alias("lower"))
    slots = wanted.groupBy("anchor_id").agg(F.reverse(F.array_sort(F.collect_list("upper"))).alias("limits"), F.min("lower").alias("least"))
    padded = F.concat("limits", F.array_repeat(F.lit(-LONGEST - 1), F.lit(positives) - F.size("limits"))).alias("limits")
    limited = cut_lineage(anchors.join(slots, anchors["vec_id"] == slots["anchor_id"]).select("vec_id", "label", "vector", "chunk", padded, "least"), "limits")
    found = _search(rows, limited, chunks, negatives, limits=True)
    lists = found.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("slot", "place", "score", "vec_id"))).alias("found"))
    out = wanted.join(lists, "anchor_id")
    # the suffix of slots from the positive's limit down, its first rows, and of these what its lower limit allows
    suffix = F.slice(F.filter("found", lambda x: x["slot"] >= F.col("slot")), 1, negatives)
    picked = F.filter(suffix, lambda x: x["score"] >= F.col("lower"))
    return out.select("anchor_id", "positive_id", "positive_score", F.posexplode(picked).alias("at", "negative")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("negative.vec_id").alias("negative_id"), "positive_score",
        F.col("negative.score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; where the id is divisible by 7 the label first becomes the next one."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")))


OP11_SQL = f"""
WITH part AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     generate_subscripts(embedding, 1) AS i, unnest(embedding) AS component
              FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
bad AS (SELECT DISTINCT vec_id FROM part WHERE component IS NULL OR NOT isfinite(component)),
v AS (SELECT vec_id, label, i, CAST(floor({STEPS} * CAST(component AS DOUBLE)) AS BIGINT) AS x FROM part WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
score AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(sum(a.x * b.x) AS BIGINT) AS score
          FROM v a JOIN v b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0 GROUP BY ALL),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM score WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
neg AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
        FROM pos p JOIN score s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
          AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= {NEGATIVES}
"""
