"""Toxicity: cumulative-link ordinal regression of severity grades on sparse text features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, drop_stage, smallest_hashes, strings, table, unused_name, with_column_replaced

#: Labelled documents the model is fitted on at most: of each class those with the smallest id hashes.
#: Feature counts and class sizes are taken over all labelled documents.
FIT_ROWS = 20_000
MAX_FEATURES = 20_000
#: A feature is chosen if so many standard errors (root of the likelihood ratio) speak for it, be it a sign of
#: toxic or of clean documents and however small the difference.
MIN_Z = 4.0
GRADES = 4
#: Features a task counts before it hands them on.
HELD_FEATURES = 400_000
#: Labelled ids that are broadcast to the texts at most (16 bytes each, some 60 MB as a hash table).
MAX_BROADCAST_MARKS = 2_000_000
PREFIXES = (4, 5, 6)
LONGEST_WORD = 64
BLOCK_CHARS = 1 << 20

#: Stands for all documents among the feature counts; no word is empty.
ALL = ""
_WORD = regex.compile(r"[\p{L}\p{M}]+")


def word_counts(text: str | None) -> Counter:
    """Lower-case words of letters in a whole text → occurrences."""
    words: Counter = Counter()
    text, start = text or "", 0
    while start < len(text):
        stop = min(len(text), start + BLOCK_CHARS)
        while stop < len(text) and text[stop].isalpha():
            stop += 1
        words.update(_WORD.findall(text[start:stop].lower()))
        start = stop
    return words


def text_features(text: str | None) -> Counter:
    """Features of a whole text → occurrences: every word, and as prefix~ its first four, five and six letters
    (inflections and compounds share those)."""
    out: Counter = Counter()
    for word, n in word_counts(text).items():
        if len(word) <= LONGEST_WORD:
            out[word] += n
        for k in PREFIXES:
            if len(word) > k:
                out[word[:k] + "~"] += n
    return out


@dataclass
class Severity:
    """weights: feature → weight, shared by all thresholds; P(grade <= k) = sigmoid(thresholds[k] - w.x)."""
    weights: dict[str, float]
    thresholds: list[float]

    def __post_init__(self):
        self._whole = {f: w for f, w in self.weights.items() if not f.endswith("~")}
        self._prefix = {k: {f[:-1] for f in self.weights if len(f) == k + 1 and f.endswith("~")} for k in PREFIXES}

    def signal(self, words: Counter) -> float:
        """The weighted sum of the features that ``text_features`` gives for a text of these words."""
        found: Counter = Counter()
        for word, n in words.items():
            if word in self._whole:
                found[word] += n
            for k, known in self._prefix.items():
                if word[:k] in known and len(word) > k:
                    found[word[:k] + "~"] += n
        return float(sum(self.weights[f] * np.log1p(found[f]) for f in sorted(found)))

    def probabilities(self, signal: float) -> np.ndarray:
        below = 1 / (1 + np.exp(np.clip(signal - np.asarray(self.thresholds), -500, 500)))
        return np.diff(np.concatenate([[0.0], below, [1.0]]))


def fit_cumulative_link(names: np.ndarray, col: np.ndarray, ends: np.ndarray, values: np.ndarray, grade: np.ndarray, grades: int, steps: int = 400,
                        rate: float = 0.1, ridge: float = 1e-3, stands_for: np.ndarray | None = None) -> Severity:
    """Proportional-odds model by full-batch Adam on the mean log likelihood; thresholds stay ordered because
    the gaps between them are exponentials.  Row i counts as ``stands_for``[i] rows, as one where that isn't given.

    Sparse rows: row i has ``values`` in the columns ``col`` from ends[i] to ends[i + 1]; ``names`` are the columns' features."""
    val = values.astype(np.float64)
    n, m = len(grade), len(names)
    at = np.repeat(np.arange(n, dtype=np.int32), np.diff(ends))
    load = np.ones(n) if stands_for is None else stands_for * (n / stands_for.sum())
    share = np.array([((grade <= k) * load).mean() for k in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    cut = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    par = np.concatenate([np.zeros(m), [cut[0]], np.log(np.maximum(np.diff(cut), 1e-2))])
    first, second = np.zeros_like(par), np.zeros_like(par)

    def thresholds(p):
        return p[m] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 1:]))])

    for step in range(1, steps + 1):
        theta = thresholds(par)
        signal = np.bincount(at, val * par[col], n) if len(at) else np.zeros(n)
        edge = np.concatenate([np.full((n, 1), -np.inf), theta[None, :] - signal[:, None], np.full((n, 1), np.inf)], axis=1)
        cdf = 1 / (1 + np.exp(-np.clip(edge, -500, 500)))
        up, low = cdf[np.arange(n), grade + 1], cdf[np.arange(n), grade]
        like = np.maximum(up - low, 1e-12)
        d_up, d_low = load * up * (1 - up) / like, load * low * (1 - low) / like
        d_theta = np.bincount(grade, d_up, grades)[:-1] - np.bincount(grade, d_low, grades)[1:]
        grad = np.empty_like(par)
        grad[:m] = np.bincount(col, val * -(d_up - d_low)[at], m) if m else 0
        grad[m] = d_theta.sum()
        grad[m + 1:] = [np.exp(par[m + 1 + j]) * d_theta[j + 1:].sum() for j in range(grades - 2)]
        grad = -grad / n
        grad[:m] += ridge * par[:m] / max(1, m)
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        par = par - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Severity(dict(zip(names.tolist(), par[:m].tolist())), thresholds(par).tolist())


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic 0/1, place): one row for each labelled id.  A document labelled toxic anywhere counts as toxic."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic").cast("int") > 0).cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("place", F.xxhash64("doc_id")))


def _labelled(docs: DataFrame, marks: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, toxic) of the ``rows`` marked ids; of texts that share an id the smallest counts.

    The marks go to the texts while there are at most MAX_BROADCAST_MARKS of them; above it both are dealt by id.  Only the texts of
    ids that occur more than once are grouped."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    small = rows <= MAX_BROADCAST_MARKS
    held = marks.select("doc_id", "toxic")
    held = F.broadcast(held) if small else held
    repeated = texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id").join(marks, "doc_id", "left_semi")
    repeated = cut_lineage(repeated, "repeated")
    met = texts.join(held, "doc_id").select("doc_id", "text", "toxic")
    if repeated.isEmpty():
        return met
    several = F.broadcast(repeated) if small else repeated
    again = met.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return met.join(several, "doc_id", "left_anti").unionByName(again)


def class_quotas(size: dict[int, int], fit_rows: int) -> dict[int, int]:
    """Rows of each class in the fit: all where they fit in, else half of ``fit_rows`` each, and what one class leaves goes to the other."""
    half = fit_rows // 2
    toxic = min(size[1], max(half, fit_rows - size[0]))
    return {0: min(size[0], fit_rows - toxic), 1: toxic}


def labelled_sample(docs: DataFrame, marks: DataFrame, fit_rows: int) -> DataFrame:
    """(doc_id, text, toxic) of the ids with the smallest hashes of each class, among those that have a text."""
    present = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    marks = cut_lineage(marks.join(present, "doc_id", "left_semi"), "marks")
    size = {0: 0, 1: 0} | {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = (smallest_hashes(marks.where(F.col("toxic") == c), "place", size[c], q) for c, q in sorted(class_quotas(size, fit_rows).items(), reverse=True))
    return _labelled(docs, cut_lineage(toxic.unionByName(clean).select("doc_id", "toxic"), "sampled"), fit_rows)


def _feature_counts(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """(feature, toxic documents, clean documents) of a task, flushed when HELD_FEATURES are held; the
    feature "" is every document's."""
    toxic, clean = Counter(), Counter()

    def flush():
        keys = list(toxic.keys() | clean.keys())
        out = pa.RecordBatch.from_pydict({"feature": pa.array(keys, pa.string()),
                                          "toxic": pa.array([toxic[k] for k in keys], pa.int64()),
                                          "clean": pa.array([clean[k] for k in keys], pa.int64())})
        toxic.clear(), clean.clear()
        return out

    for batch in batches:
        for text, mark in zip(strings(batch["text"]), batch["toxic"].to_pylist()):
            (toxic if mark else clean).update([ALL, *text_features(text)])
            if len(toxic) + len(clean) > HELD_FEATURES:
                yield flush()
    yield flush()


def _sparse_rows(chosen):
    place: dict = {}

    def rows(batches):
        if not place:
            place.update((f, j) for j, f in enumerate(chosen.value))
        for batch in batches:
            ids, values = [], []
            for text in strings(batch["text"]):
                found = text_features(text)
                hit = sorted(place.keys() & found.keys(), key=place.get)
                ids.append([place[f] for f in hit])
                values.append([found[f] for f in hit])
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "ids": pa.array(ids, pa.list_(pa.int32())), "counts": pa.array(values, pa.list_(pa.int32())),
                                              "toxic": batch["toxic"]})
    return rows


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, max_features: int = MAX_FEATURES,
                 grades: int = GRADES) -> Severity | None:
    """Learns from ``labels`` (doc_id, toxic 0/1); None where there is no toxic or no clean labelled document.

    Features are chosen by the likelihood ratio of their counts over all labelled documents, signs of either class.  The
    model is fitted on at most ``fit_rows`` of them, the smallest id hashes of each class, each of which stands for as many
    documents as its class has for one in the fit, so the shares of the classes stay those of all labels.
    The labels are binary, so severity grades are made from them: 0 for clean, and for toxic
    documents 1 to grades - 1 by the quantile of how many occurrences of chosen features that speak for toxic they hold."""
    spark = docs.sparkSession
    marks = cut_lineage(_marks(labels), "labels")
    counts = cut_lineage(_labelled(docs, marks, marks.count()).select("text", "toxic").mapInArrow(_feature_counts, "feature string, toxic long, clean long")
                         .groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")), "feature-counts")
    total = counts.where(F.col("feature") == ALL).first()
    size = {0: total.c, 1: total.t} if total else {}
    if not size.get(0) or not size.get(1):
        return None
    t, c = F.col("t"), F.col("c")
    # two binomials against their common rate: documents with the feature and documents without it
    n1, n0 = F.lit(float(size[1])), F.lit(float(size[0]))

    def excess(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    have, lack = (t + c) / (n1 + n0), 1 - (t + c) / (n1 + n0)
    ratio = 2 * (excess(t, n1 * have) + excess(c, n0 * have) + excess(n1 - t, n1 * lack) + excess(n0 - c, n0 * lack))
    ranked = (counts.where(F.col("feature") != ALL).withColumn("z", F.sqrt(F.greatest(ratio, F.lit(0.0)))).where(F.col("z") >= MIN_Z)
              .orderBy(F.desc("z"), "feature").limit(max_features))
    found = sorted((r.feature, r.speaks) for r in ranked.select("feature", (t / n1 > c / n0).alias("speaks")).collect())
    chosen, speaks = [f for f, _ in found], np.array([x for _, x in found], bool)
    drop_stage(counts)
    held = spark.sparkContext.broadcast(chosen)
    rows = (labelled_sample(docs, marks, fit_rows).mapInArrow(_sparse_rows(held), "doc_id long, ids array<int>, counts array<int>, toxic int")
            .toArrow().sort_by("doc_id").combine_chunks())      # fit_rows rows of chosen features
    toxic = rows["toxic"].to_numpy() > 0
    if not toxic.any() or toxic.all():
        return None
    ids, counts = rows["ids"].combine_chunks(), rows["counts"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(np.diff(ids.offsets.to_numpy()))])
    features, held_counts = ids.flatten().to_numpy(), counts.flatten().to_numpy()
    evidence = held_counts * speaks[features]
    amount = np.diff(np.concatenate([[0], np.cumsum(evidence)])[ends])
    cuts = np.quantile(amount[toxic], [k / (grades - 1) for k in range(1, grades - 1)], method="higher")
    grade = np.where(toxic, 1 + (amount[:, None] > cuts[None, :]).sum(axis=1), 0)
    stands_for = np.where(toxic, size[1] / toxic.sum(), size[0] / (~toxic).sum())
    return fit_cumulative_link(np.array(chosen, object), features, ends, np.log1p(held_counts), grade, grades, stands_for=stands_for)


SCORE = "struct<severity:double,grade:int,p_toxic:double>"
_SCORE = pa.struct([("severity", pa.float64()), ("grade", pa.int32()), ("p_toxic", pa.float64())])


def with_severity(docs: DataFrame, model: Severity | None, out_col: str = "toxicity", text_col: str = "text") -> DataFrame:
    """``docs`` with struct ``out_col``: expected severity (0 to grades - 1), likeliest grade, P(grade >= 1).

    Null and word-free texts, and every text where there is no model, have severity 0.
    Repeated rows come back repeated; an input column named ``out_col`` is replaced."""
    if model is None:
        return with_column_replaced(docs, out_col, F.struct(F.lit(0.0).alias("severity"), F.lit(0).alias("grade"),
                                                            F.lit(0.0).alias("p_toxic")))
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))
    made: dict = {}

    @F.arrow_udf(SCORE)
    def score(texts: pa.Array) -> pa.Array:
        if not made:
            made["model"] = Severity(*held.value)
        rows = []
        for text in strings(texts):
            words = word_counts(text)
            if not words:
                rows.append({"severity": 0.0, "grade": 0, "p_toxic": 0.0})
                continue
            p = made["model"].probabilities(made["model"].signal(words))
            rows.append({"severity": float(p @ np.arange(len(p))), "grade": int(p.argmax()), "p_toxic": float(1 - p[0])})
        return pa.array(rows, _SCORE)
    return with_column_replaced(docs, out_col, score(F.col(f"`{text_col}`")))


def is_toxic(col: str):
    return F.col(f"{col}.p_toxic") >= 0.5


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are more likely of some severity than clean; all columns stay."""
    mark = unused_name(docs, "toxicity")
    return with_severity(docs, fit_toxicity(docs, labels), mark, text_col).where(~is_toxic(mark)).drop(mark)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Expected toxicity severity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_severity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.col("toxicity.severity").alias("severity"), F.col("toxicity.grade").alias("grade"),
                         F.col("toxicity.p_toxic").alias("p_toxic"), is_toxic("toxicity").alias("toxic"))
