"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, cut_lineage, strings, table

#: n-gram lengths and the hashed feature space.
ORDERS, SPACE = (1, 2, 3), 1 << 16
#: Labelled documents of a shard that one task learns from at most, shards, and rounds of averaging.
SHARD_ROWS, SHARDS, ROUNDS = 1500, 4, 2
#: Labelled documents the temperature is fitted on at most.
CALIBRATION_ROWS = 2000
#: Follow-the-regularised-leader: step size, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: Characters turned into n-grams at a time.
BLOCK_CHARS = 1 << 20
_LETTER = regex.compile(r"\p{L}")


def _fold(text: str) -> np.ndarray:
    """Lower-case code points; everything but letters is one space."""
    # a capital sigma's small form would depend on what follows it, maybe in the next block
    points = np.frombuffer(text.replace("\u03a3", "\u03c3").lower().encode("utf-32-le", "replace"), np.uint32)
    ascii_other = (points < 128) & ((points < 97) | (points > 122))
    return np.where(ascii_other | (points == 0xA0), np.uint32(32), points)


def ngram_blocks(text: str) -> Iterable[np.ndarray]:
    """Hashed character n-grams of a whole text, block by block: the last characters of a block are carried into the
    next, so the n-grams are those of the text in one piece."""
    reach, carry = max(ORDERS) - 1, np.zeros(0, np.uint32)
    for start in range(0, max(1, len(text)), BLOCK_CHARS):
        stop = start + BLOCK_CHARS
        points = np.concatenate([carry, _fold(" " * (start == 0) + text[start:stop] + " " * (stop >= len(text)))])
        space = points == 32
        keep = np.ones(len(points), bool)
        keep[1:] = ~(space[1:] & space[:-1])        # runs of spaces count as one
        points = points[keep]
        old, carry = len(carry), points[max(0, len(points) - reach):]
        wide = points.astype(np.uint64)
        parts, rolled = [], np.zeros(len(wide), np.uint64)
        for n in ORDERS:
            if len(wide) < n:
                break
            rolled = rolled[:len(wide) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + wide[n - 1:] + np.uint64(n)
            mixed = rolled[max(0, old - n + 1):] * np.uint64(0xD6E8FEB86659FD93)      # those that end in the carry were counted
            parts.append((mixed >> np.uint64(40)).astype(np.int64) % SPACE)
        yield np.concatenate(parts)


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram features of a whole text and their counts."""
    blocks = list(ngram_blocks(text)) if len(text) <= BLOCK_CHARS else None
    if blocks is not None:
        grams = np.sort(blocks[0].astype(np.uint16))
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        return grams[first].astype(np.int64), np.diff(np.append(first, len(grams)))
    counts = np.zeros(SPACE, np.int64)
    for block in ngram_blocks(text):
        counts += np.bincount(block, minlength=SPACE)
    found = np.flatnonzero(counts)
    return found, counts[found]


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _document_frequencies(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    total = np.zeros(SPACE, np.int64)
    for batch in batches:
        for text in strings(batch["text"]):
            if has_letter(text):
                total[term_counts(text)[0]] += 1
    yield pa.RecordBatch.from_pydict({"feature": pa.array(np.arange(SPACE)), "df": pa.array(total)})


class Ftrl:
    """FTRL-proximal state of a multinomial model: one z and n for each feature and class."""

    def __init__(self, classes: int):
        self.z, self.n = np.zeros((SPACE, classes)), np.zeros((SPACE, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _learn_shard(idf_held, langs: list[str], start_held):
    def learn(rows: pa.Table) -> pa.Table:
        """One pass over a shard in hash order, from the averaged state of the round before."""
        idf, model = idf_held.value, Ftrl(len(langs))
        if start_held is not None:
            model.z, model.n = (a.astype(float) for a in start_held.value)
        rows = rows.sort_by([("place", "ascending"), ("doc_id", "ascending")])
        for text, lang in zip(rows["text"].to_pylist(), rows["lang"].to_pylist()):
            at, counts = term_counts(text)
            model.learn(at, tfidf(counts, idf[at]), langs.index(lang))
        used = np.flatnonzero(model.n.any(axis=1))
        return pa.table({"feature": pa.array(used), "z": pa.array(list(model.z[used]), pa.list_(pa.float64())),
                         "n": pa.array(list(model.n[used]), pa.list_(pa.float64()))})
    return learn


class LanguageModel:
    """Weights of TF-IDF features by language, and the temperature that calibrates the scores."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float = 1.0):
        self.langs, self.idf, self.weights, self.temperature = langs, idf, weights, temperature

    def logits(self, text: str) -> np.ndarray:
        at, counts = term_counts(text)
        return tfidf(counts, self.idf[at]) @ self.weights[at]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])

    def state(self):
        return self.langs, self.idf, self.weights, self.temperature


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log likelihood (golden section on its logarithm)."""
    def loss(log_t):
        p = softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()
    low, high, ratio = np.log(0.01), np.log(100.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _logits(state):
    def rows(batches):
        model = LanguageModel(*state.value)
        for batch in batches:
            out = [model.logits(t) for t in strings(batch["text"])]
            yield pa.RecordBatch.from_pydict({"lang": batch["lang"], "logits": pa.array([list(map(float, z)) for z in out], pa.list_(pa.float64()))})
    return rows


def language_quotas(rows: dict[str, int], limit: int) -> dict[str, int]:
    """Rows of each language in a sample of about ``limit``: its share of all rows, but at least a quarter of an even share or all it has."""
    total = sum(rows.values())
    return {lang: min(n, max(1, round(limit * n / total), limit // (4 * len(rows)))) for lang, n in rows.items()}


def _language_sample(usable: DataFrame, rows: dict[str, int], limit: int) -> DataFrame:
    """(doc_id, text, lang, place) of at least each language's quota of rows with the smallest places; repeated rows count once."""
    quota = language_quotas(rows, limit)
    share = {lang: min(1.0, (1.5 * quota[lang] + 100) / n) for lang, n in rows.items()}
    below = usable.sparkSession.createDataFrame([(lang, int((2 * x - 1) * 2 ** 63) if x < 1 else 2 ** 63 - 1) for lang, x in share.items()], "lang string, below long")
    near = usable.join(F.broadcast(below), "lang").where(F.col("place") <= F.col("below"))      # one row for each language
    return near.groupBy("lang", "place").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))


def split_places(found: list[tuple[str, int]], quota: dict[str, int], calibration_rows: int) -> list[tuple[str, int, int]]:
    """(lang, last place to learn from, last place of the sample): of each language's quota of smallest places
    the last ones calibrate, in proportion, and at least one is learned from."""
    places: dict[str, list[int]] = {}
    for lang, place in sorted(found):
        if len(places.setdefault(lang, [])) < quota[lang]:
            places[lang].append(place)
    size = sum(map(len, places.values()))
    calibrate = min(calibration_rows, size // 5) / max(1, size)
    return [(lang, at[len(at) - 1 - int(len(at) * calibrate)], at[-1]) for lang, at in places.items()]


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", shard_rows: int = SHARD_ROWS,
                       shards: int = SHARDS, rounds: int = ROUNDS, calibration_rows: int = CALIBRATION_ROWS) -> LanguageModel:
    """Learns from all rows with text and language given; no such rows give a model without languages.

    Document frequencies and the list of languages cover every row.  Of each language the weights are
    learned from a quota of the rows with the smallest hashes of id and text (``language_quotas`` of shards *
    shard_rows + ``calibration_rows``), the temperature from the last of them.  Each shard is learned in its own
    task and the shards' states are averaged between rounds."""
    spark = docs.sparkSession
    usable = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).where(
        "text is not null and lang is not null")
    freq = (usable.select("text").mapInArrow(_document_frequencies, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df"))
            .toArrow())      # SPACE rows
    df = np.zeros(SPACE)
    df[freq["feature"].to_numpy()] = freq["df"].to_numpy()
    lettered = F.col("text").rlike(r"\p{L}")
    seen = usable.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(lettered).alias("lettered")).collect()      # one row for each language
    n_docs, by_lang = sum(r.n for r in seen), {r.lang: r.lettered for r in seen if r.lettered}
    langs = sorted(by_lang)
    idf = (np.log((1 + n_docs) / (1 + df)) + 1).astype(np.float32)
    if not langs:
        return LanguageModel([], idf, np.zeros((SPACE, 0), np.float32))
    limit = shards * shard_rows + calibration_rows
    place = F.xxhash64(F.lit("langid"), "doc_id", "text")
    near = cut_lineage(_language_sample(usable.where(lettered).withColumn("place", place), by_lang, limit), "langid-sample")
    edges = split_places([(r.lang, r.place) for r in near.select("lang", "place").collect()], language_quotas(by_lang, limit), calibration_rows)
    picked = near.join(F.broadcast(spark.createDataFrame(edges, "lang string, edge long, last long")), "lang")
    learn = picked.where("place <= edge").select("doc_id", "text", "lang", "place")
    calibrate = picked.where("place > edge and place <= last")
    learn = learn.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "place"), F.lit(shards)))
    reported = learn.select("shard").distinct().count()      # a small table may leave a shard without rows
    idf_held, start = spark.sparkContext.broadcast(idf), None
    for _ in range(rounds):
        state = (learn.groupBy("shard").applyInArrow(_learn_shard(idf_held, langs, start), "feature long, z array<double>, n array<double>")
                 .groupBy("feature").agg(*[F.sum(F.col(c)[j]).alias(f"{c}{j}") for c in "zn" for j in range(len(langs))]).toArrow())
        z, n = np.zeros((SPACE, len(langs)), np.float32), np.zeros((SPACE, len(langs)), np.float32)
        at = state["feature"].to_numpy()
        for j in range(len(langs)):
            z[at, j], n[at, j] = state[f"z{j}"].to_numpy() / reported, state[f"n{j}"].to_numpy() / reported
        start = spark.sparkContext.broadcast((z, n))
    model = Ftrl(len(langs))
    model.z, model.n = z.astype(float), n.astype(float)
    fitted = LanguageModel(langs, idf, model.weights(slice(None)).astype(np.float32))
    held_out = calibrate.select("text", "lang").mapInArrow(_logits(spark.sparkContext.broadcast(fitted.state())), "lang string, logits array<double>").collect()
    if held_out:
        fitted.temperature = fit_temperature(np.array([r.logits for r in held_out]), np.array([langs.index(r.lang) for r in held_out]))
    return fitted


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text"):
    """Column struct (lang_pred, score) of a text column: ``und`` with score 0 for null texts and texts without a letter.

    Every row is judged by its own text alone, so repeated rows get equal results; texts of any length are read whole, block
    by block; an empty table stays empty; a model without languages (learned from no rows) gives ``und``."""
    held = docs.sparkSession.sparkContext.broadcast(model.state())
    made: dict = {}

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        if not made:
            made["model"] = LanguageModel(*held.value)
        found = [made["model"].predict(t) for t in strings(texts)]
        return pa.array([{"lang_pred": a, "score": min(1.0, b)} for a, b in found], pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))
    return predict(F.col(f"`{text_col}`"))


def op4_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id("doc_id") % 3 == 1, F.lit(False))
    model = fit_language_model(docs.select("doc_id", "text", "lang").where(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), with_language(docs, model).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")
