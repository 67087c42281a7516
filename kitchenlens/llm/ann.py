"""Approximate nearest neighbours: a neighbour graph's balanced partitions, learned by a small classifier."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, smallest_hashes, table

#: Distinct vectors a partition is fitted on at most (smallest hashes); every vector is indexed.
FIT_VECTORS = 6000
GRAPH_NEIGHBOURS = 10
#: Parts that a partition has, and vectors a part should hold: while parts would be larger each is parted again, MAX_LEVELS times at most.
PARTITIONS, PART_ROWS, MAX_LEVELS = 16, 32_768, 4
HIDDEN = 128
#: Partitions searched are the fewest that reach this recall on so many queries, which are answered by brute force for it; of
#: all parts the likeliest MAX_PROBES are ranked.
TARGET_RECALL, CALIBRATION_QUERIES, MAX_PROBES = 0.97, 200, 256
#: Vectors of one block, which one task compares with as many queries at most.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 20_000
#: Queries broadcast at a time where all vectors are searched.
SCAN_QUERIES = 4096


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component near one: products neither overflow nor vanish, and no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def neighbour_graph(unit: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of every row."""
    n = len(unit)
    k = min(k, n - 1)
    out = np.zeros((n, k), np.int64)
    for at in range(0, n, 512):
        near = unit[at:at + 512] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at:at + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_partition(unit: np.ndarray, graph: np.ndarray, parts: int, seed: int = 0, sweeps: int = 12) -> np.ndarray:
    """Parts of nearly equal size with few graph edges between them.

    Starts from halving along the leading direction, then moves vertices to the part most of their
    neighbours are in, where that part has room (at most 5 % over the mean)."""
    n = len(unit)
    label = np.zeros(n, np.int64)
    groups = [np.arange(n)]
    draw = np.random.default_rng(seed)
    while len(groups) < parts:
        groups.sort(key=len)
        big = groups.pop()
        rows = unit[big] - unit[big].mean(axis=0)
        axis = draw.standard_normal(unit.shape[1])
        for _ in range(10):
            axis = rows.T @ (rows @ axis)
            axis /= max(np.linalg.norm(axis), 1e-300)
        order = np.argsort(rows @ axis, kind="stable")
        groups += [big[order[:len(big) // 2]], big[order[len(big) // 2:]]]
    for g, rows in enumerate(groups):
        label[rows] = g
    room = int(np.ceil(n / parts * 1.05)) + 1
    heads, tails = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    for _ in range(sweeps):
        votes = np.zeros((n, parts))
        np.add.at(votes, (heads, label[tails]), 1)
        np.add.at(votes, (tails, label[heads]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        size, moved = np.bincount(label, minlength=parts), 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if size[best[v]] < room:
                size[label[v]] -= 1
                size[best[v]] += 1
                label[v] = best[v]
                moved += 1
        if not moved:
            break
    return label


class Router:
    """A classifier with one hidden layer: log probabilities of the parts for unit vectors."""

    def __init__(self, w1, b1, w2, b2):
        self.w1, self.b1, self.w2, self.b2 = w1, b1, w2, b2

    @classmethod
    def fit(cls, unit: np.ndarray, target: np.ndarray, hidden: int, steps: int = 600, batch: int = 512, seed: int = 0) -> Router:
        """``target``: the share of each row's neighbours (and itself) in every part; cross entropy, Adam."""
        draw = np.random.default_rng(seed)
        d, parts = unit.shape[1], target.shape[1]
        par = [draw.standard_normal((d, hidden)) * np.sqrt(2.0), np.zeros(hidden), draw.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
        m, v = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
        for step in range(1, steps + 1):
            rows = draw.integers(0, len(unit), min(batch, len(unit)))
            x, y = unit[rows], target[rows]
            h = np.maximum(x @ par[0] + par[1], 0)
            z = h @ par[2] + par[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - y) / len(rows)
            dh = (dz @ par[2].T) * (h > 0)
            for i, g in enumerate((x.T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                par[i] -= 0.005 * (1 - step / (steps + 1)) * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        return cls(*par)

    def scores(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def state(self):
        return [self.w1, self.b1, self.w2, self.b2]


def fit_router(sample: np.ndarray, parts: int, neighbours: int = GRAPH_NEIGHBOURS, hidden: int = HIDDEN) -> Router:
    """Learns the balanced parts of the sample's neighbour graph; a sample of under 16 vectors is one part."""
    unit = unit_rows(sample)
    parts = max(1, min(parts, len(unit) // 8))
    if parts == 1:
        return Router(np.zeros((sample.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(unit, neighbours)
    label = balanced_partition(unit, graph, parts)
    target = np.zeros((len(unit), parts))
    np.add.at(target, (np.repeat(np.arange(len(unit)), graph.shape[1]), label[graph.ravel()]), 1)
    target[np.arange(len(unit)), label] += 1
    return Router.fit(unit, target / target.sum(axis=1, keepdims=True), hidden)


class Tree:
    """Routers by node: the root is 1, and part c of a node is node * FAN + c; a leaf has no router."""
    FAN = 1 << 10

    def __init__(self, states: dict[int, list[np.ndarray]]):
        self.routers = {node: Router(*state) for node, state in states.items()}

    def leaves(self, unit: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, leaves): each row's ``most`` likeliest leaves, likeliest first, by the product of the parts' probabilities along the
        way (``most`` nodes a level are followed; at one it is the likeliest part of the likeliest part)."""
        row, node, chance = np.arange(len(unit)), np.ones(len(unit), np.int64), np.zeros(len(unit))
        while True:
            open_ = np.isin(node, list(self.routers))
            if not open_.any():
                return row, node
            rows, nodes, chances = [row[~open_]], [node[~open_]], [chance[~open_]]
            for n in np.unique(node[open_]):
                at = node == n
                z = self.routers[int(n)].scores(unit[row[at]])
                z = z - z.max(axis=1, keepdims=True)
                z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
                parts = z.shape[1]
                rows.append(np.repeat(row[at], parts))
                nodes.append(np.tile(n * self.FAN + np.arange(parts), int(at.sum())))
                chances.append((chance[at][:, None] + z).ravel())
            row, node, chance = (np.concatenate(x) for x in (rows, nodes, chances))
            order = np.lexsort((node, -chance, row))
            row, node, chance = row[order], node[order], chance[order]
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            keep = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row)))) < most
            row, node, chance = row[keep], node[keep], chance[keep]


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the vectors that take part: of the commonest length, not zero, all components finite."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("vec")).where(
        "vec_id is not null and vec is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
        "and exists(vec, x -> x <> 0)")
    top = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("vec") == (top.n if top else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _routes(held, most: int):
    """Adds ``leaves``: the likeliest leaves of each vector, likeliest first."""
    made: dict = {}

    def route(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if not made:
            made["tree"] = Tree(held.value)
        for batch in batches:
            row, leaf = made["tree"].leaves(unit_rows(_matrix(batch["vec"])), most) if batch.num_rows else (np.zeros(0, int), np.zeros(0, int))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
            leaves = pa.ListArray.from_arrays(pa.array(ends), pa.array(leaf, pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaves], names=[*batch.schema.names, "leaves"])
    return route


def _search(k: int):
    def search(key, queries: pa.Table, block: pa.Table) -> pa.Table:
        """The k nearest rows of the block for every query row, ties to smaller ids (block rows come in any order)."""
        found: dict[str, list] = {"query": [], "vec_id": [], "score": []}
        if len(queries) and len(block):
            ids = block["vec_id"].to_numpy()
            x = scaled(_matrix(block["vec"]))
            size = np.sqrt((x * x).sum(axis=1))
            q, name = scaled(_matrix(queries["vec"])), queries["query"].to_numpy()
            for at in range(0, len(q), 256):
                part = q[at:at + 256]
                score = (part @ x.T) / (np.sqrt((part * part).sum(axis=1))[:, None] * size[None, :])
                m = min(4 * k, len(ids))
                for i, row in enumerate(score):
                    edge = np.partition(row, len(row) - m)[len(row) - m] if m < len(row) else -np.inf
                    near = np.flatnonzero(row >= edge)
                    # the exact measure, component by component, settles rank and ties
                    exact = (x[near] * part[i]).sum(axis=1) / (size[near] * np.sqrt((part[i] * part[i]).sum()))
                    best = np.lexsort((ids[near], -exact))[:k]
                    found["query"] += [int(name[at + i])] * len(best)
                    found["vec_id"] += ids[near][best].tolist()
                    found["score"] += exact[best].tolist()
        return pa.table({"query": pa.array(found["query"], pa.int64()), "vec_id": pa.array(found["vec_id"], pa.int64()),
                         "score": pa.array(found["score"], pa.float64())})
    return search


def _scan(held, k: int):
    """Every vector against a broadcast chunk of queries: a task hands on the k nearest of its rows."""
    find = _search(k)

    def nearest_of(tables: list[pa.Table]) -> pa.Table:
        rows = pa.concat_tables(tables)
        query, ids, score = (rows[c].to_numpy() for c in ("query", "vec_id", "score"))
        order = np.lexsort((ids, -score, query))
        first = np.flatnonzero(np.concatenate([[True], query[order][1:] != query[order][:-1]])) if len(order) else np.zeros(0, int)
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        return rows.take(pa.array(order[place < k]))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            kept.append(find(None, held.value, pa.Table.from_batches([batch])))
            size += len(kept[-1])
            if size > 50 * SCAN_QUERIES:
                kept = [nearest_of(kept)]
                size = len(kept[0])
        if kept:
            yield from nearest_of(kept).combine_chunks().to_batches()
    return scan


FOUND = "query long, vec_id long, score double"


def _nearest_of_all(ids: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, vec_id, score): the exact k nearest of few queries (query, vec), by passes over all vectors with a bounded chunk of them each."""
    spark, out = ids.sparkSession, None
    chunks = max(1, -(-queries.count() // SCAN_QUERIES))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    for c in range(chunks):
        held = spark.sparkContext.broadcast(queries.where(F.pmod(F.xxhash64("query"), F.lit(chunks)) == c).select("query", "vec").toArrow().combine_chunks())
        part = ids.select("vec", "vec_id").mapInArrow(_scan(held, k), FOUND).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")
        part = cut_lineage(part, "scanned")
        out = part if out is None else out.unionByName(part)
    return out


def fit_tree(ids: DataFrame, rows: int, partitions: int, fit_vectors: int, part_rows: int) -> dict[int, list[np.ndarray]]:
    """Router states by node.  The first level is learned on a sample of all vectors; while parts hold more than ``part_rows`` on average
    every part is parted again, by a router learned on a sample of its own vectors in a task of its own."""
    spark = ids.sparkSession
    placed = ids.select("vec", F.xxhash64("vec").alias("place"))
    sample = smallest_hashes(placed, "place", rows, fit_vectors).select("vec").toArrow()["vec"]
    states = {1: fit_router(_matrix(sample), max(partitions, 1)).state()}
    parts, levels = states[1][3].shape[0], 1

    def fit(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        state = fit_router(_matrix(group.sort_by("place")["vec"]), partitions).state()
        return pa.table({"node": pa.array([key[0].as_py()], pa.int64()), "widths": pa.array([[*state[0].shape, state[3].shape[0]]], pa.list_(pa.int32())),
                         "numbers": pa.array([np.concatenate([s.ravel() for s in state]).astype(np.float32)], pa.list_(pa.float32()))})

    while parts > 1 and rows / parts > part_rows and levels < MAX_LEVELS:
        held = spark.sparkContext.broadcast(states)
        at = placed.mapInArrow(_routes(held, 1), "vec array<double>, place long, leaves array<long>").select("vec", "place", F.col("leaves")[0].alias("node"))
        order = Window.partitionBy("node").orderBy("place")
        chosen = at.withColumn("r", F.row_number().over(order)).where(F.col("r") <= fit_vectors).drop("r")
        before = len(states)
        for r in chosen.groupBy("node").applyInArrow(fit, "node long, widths array<int>, numbers array<float>").toLocalIterator():
            d, hidden, n = r.widths
            cuts = np.cumsum([d * hidden, hidden, hidden * n])
            w1, b1, w2, b2 = np.split(np.array(r.numbers, np.float64), cuts)
            if n > 1:
                states[r.node] = [w1.reshape(d, hidden), b1, w2.reshape(hidden, n), b2]
        if len(states) == before:
            break
        parts, levels = sum(s[3].shape[0] for s in states.values()) - len(states) + 1, levels + 1
    return states


def _probes(tree: Tree, answers: pa.Table, target_recall: float) -> int:
    """The fewest likeliest leaves that hold ``target_recall`` of the known nearest neighbours: ``answers`` are (query, vec, leaf), one row each."""
    names, first_at, query = np.unique(answers["query"].to_numpy(), return_index=True, return_inverse=True)
    row, leaf = tree.leaves(unit_rows(_matrix(answers["vec"])[first_at]), MAX_PROBES)
    first = np.searchsorted(row, np.arange(len(names)))
    rank = {(int(r), int(n)): i - int(first[r]) for i, (r, n) in enumerate(zip(row, leaf))}
    needed = np.sort([rank.get((int(q), int(n)), MAX_PROBES) for q, n in zip(query, answers["leaf"].to_numpy())])
    return int(min(MAX_PROBES, 1 + needed[min(len(needed) - 1, int(np.ceil(target_recall * len(needed))) - 1)]))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", partitions: int = PARTITIONS,
            fit_vectors: int = FIT_VECTORS, target_recall: float = TARGET_RECALL, block_rows: int = BLOCK_ROWS, part_rows: int = PART_ROWS,
            block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` found nearest to each row of ``queries`` by cosine.

    Equal vectors are searched once: each distinct vector stands for its k + 1 smallest ids, which
    is all that any query can get from it.  The tree of partitions (``fit_tree``) grows with the table, so that parts
    stay about ``part_rows`` large; every distinct vector is put into its likeliest leaf, once, and every query searches
    its likeliest few leaves: as many as ``CALIBRATION_QUERIES`` queries answered by brute force need for the recall asked.
    A leaf over ``block_rows`` is cut into blocks, so no task holds more; scores are exact cosines in double precision.
    A query whose leaves hold too few vectors is answered from all.

    A query's own id is no candidate; ids that occur more than once count as one row; null ids and
    vectors null, zero, of another length than the commonest, or with null or
    non-finite components take no part; ties go to the smaller id.  No usable vectors: no rows."""
    spark = vectors.sparkSession
    usable = _usable(vectors, id_col, vec_col)
    # one row for each distinct vector, its smallest ids kept by a bounded aggregate
    ids = cut_lineage(usable.groupBy("vec").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "vectors")
    rows = ids.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not rows:
        return spark.createDataFrame([], schema)
    states = fit_tree(ids, rows, partitions, fit_vectors, part_rows)
    held = spark.sparkContext.broadcast(states)
    index = cut_lineage(ids.select("vec", "vec_id").mapInArrow(_routes(held, 1), "vec array<double>, vec_id long, leaves array<long>")
                        .select("vec_id", "vec", F.col("leaves")[0].alias("leaf")), "index")
    asked = _usable(queries, id_col, vec_col).select(F.col("vec_id").alias("query_id"), "vec").distinct()
    asked = cut_lineage(asked.join(ids.select("vec", F.col("vec_id").alias("query")), "vec", "left"), "queries")
    # distinct query vectors; those that are no row of the table get a name below zero
    unique = cut_lineage(asked.groupBy("vec").agg(F.min(F.coalesce("query", -1 - F.col("query_id"))).alias("query")), "unique-queries")
    n_queries = unique.count()
    if not n_queries:
        return spark.createDataFrame([], schema)
    some = cut_lineage(smallest_hashes(unique.withColumn("place", F.xxhash64(F.lit("calibrate"), "query")), "place", n_queries, CALIBRATION_QUERIES).drop("place"), "calibration")
    answers = _nearest_of_all(ids, some, min(k + 1, rows)).join(index.select("vec_id", "leaf"), "vec_id").join(some, "query").select("query", "vec", "leaf").toArrow()
    probes = _probes(Tree(states), answers, target_recall)
    leaves = index.groupBy("leaf").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    sent = cut_lineage(unique.mapInArrow(_routes(held, probes), "vec array<double>, query long, leaves array<long>")
                       .select("query", "vec", F.explode("leaves").alias("leaf")), "sent")
    # where very many queries ask one leaf they come in several chunks, each of which meets the leaf's blocks
    layout = cut_lineage(leaves.join(sent.groupBy("leaf").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("chunks")), "leaf"), "layout")
    at = ["leaf", "block", "chunk"]
    left = (sent.join(layout, "leaf").withColumn("chunk", F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int"))
            .select("query", "vec", "leaf", "chunk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    right = (index.join(layout, "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
             .select("vec_id", "vec", "leaf", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")))
    found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(_search(k + 1), FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = cut_lineage(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r"), "found")
    enough = best.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= min(k + 1, rows))
    short = cut_lineage(unique.join(enough, "query", "left_anti"), "short")
    if not short.isEmpty():
        best = best.join(short.select("query"), "query", "left_anti").unionByName(_nearest_of_all(ids, short, k + 1))
    return _with_copies(best, asked, usable, ids, k)


def _with_copies(best: DataFrame, asked: DataFrame, usable: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """From the nearest distinct vectors of each distinct query vector to the k nearest rows of each query row."""
    # the k + 1 smallest ids of vectors with copies: minimum after minimum, each a pre-aggregated pass over what is left
    copied = cut_lineage(usable.select("vec", F.col("vec_id").alias("id")).join(ids.where("copies > 1").select("vec", "vec_id"), "vec")
                         .select("vec_id", "id").distinct(), "copies")
    left, firsts = copied, None
    for _ in range(k + 1):
        low = cut_lineage(left.groupBy("vec_id").agg(F.min("id").alias("id")), "smallest")
        firsts = low if firsts is None else firsts.unionByName(low)
        left = left.join(low.withColumnRenamed("id", "low"), "vec_id").where("id > low").drop("low")
    near = best.join(firsts, "vec_id", "left").select("query", F.coalesce("id", "vec_id").alias("vec_id"), "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("near"))     # k + 1 at most
    key = F.coalesce("query", -1 - F.col("query_id"))
    rows = asked.select("query_id", key.alias("query")).join(near, "query").select(
        "query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("rank", "x"))
    return rows.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))


def op10_ann(spark, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)
