"""Approximate nearest neighbours by inner product: balanced posting lists and a graph of their centroids.

Vectors get a further component that makes all of them equally long (queries get 0 there), so that the
nearest by distance is the one with the largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import written

#: Centroids are fitted on so many vectors, or on so many for each list if that is more: those with the smallest hash of their id.
SAMPLE, SAMPLE_OF_LIST = 20_000, 8
#: Rows of a block, of vectors and of queries, that a task compares; rows for which a matrix of distances is held at once.
BLOCK, ROWS = 4096, 1024
#: A vector is also kept in lists whose centroid is at most this much farther than its nearest, in so many lists at most.
REPLICATE, REPLICAS = 1.12, 4
#: The distance ratio is the smallest that finds this share of the true neighbours of so many vectors of the sample,
#: on which no centroid is fitted if there are others.
RECALL, TRIALS = 0.98, 256
#: Neighbours of a centroid in the graph, and centroids that a step of the search opens.
DEGREE, STEP = 24, 8
#: Vectors of a list at least: a small table has fewer lists than the root of its rows.
LIST_SIZE = 256
#: Nearest lists whose vectors set the score that those of further lists have to reach.
FIRST = 2


@dataclass
class Index:
    """``ratio``: a query reads the lists whose centroid is at most this much farther than its nearest one.

    The graph ties centroid ``i`` with ``links[begin[i] : begin[i + 1]]``; a search opens centroids that are at most
    ``slack`` times farther than those to read.
    """

    longest: float
    centroids: np.ndarray
    begin: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    ratio: float = 1.0
    slack: float = 1.02

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points**2).sum(axis=1)[:, None] + (self.centroids**2).sum(axis=1) - 2 * points @ self.centroids.T
        return np.sqrt(np.maximum(square, 0))

    def lists_of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest lists of each vector, and which of them keep it."""
        d = self.distances(points)
        near = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
        far = np.take_along_axis(d, near, axis=1)
        return near, far <= far[:, :1] * REPLICATE

    def asked(self, queries: np.ndarray) -> np.ndarray:
        """Queries as points as long as the vectors: the order of the inner products stays."""
        points = np.column_stack((queries, np.zeros(len(queries))))
        size = np.sqrt((points**2).sum(axis=1))[:, None]
        return points * (self.longest / size)

    def search(self, points: np.ndarray) -> np.ndarray:
        """Distances of many queries to the centroids that a search of the graph reaches, infinite for the others.

        A step opens, for each query, the nearest centroids that are within ratio and slack of the best one so far,
        and measures their neighbours. It ends when all of these are open, however many there are.
        """
        rows = np.arange(len(points))[:, None]
        far = np.full((len(points), len(self.centroids)), np.inf)
        far[:, self.entries] = np.sqrt(((self.centroids[self.entries] - points[:, None, :]) ** 2).sum(axis=2))
        closed = far.copy()
        width = min(STEP, len(self.centroids))
        while True:
            next_ = np.argpartition(closed, width - 1, axis=1)[:, :width]
            row, place = np.nonzero(closed[rows, next_] <= far.min(axis=1)[:, None] * (self.ratio * self.slack))
            if not len(row):
                return far
            opened = next_[row, place]
            closed[row, opened] = np.inf
            size = self.begin[opened + 1] - self.begin[opened]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            row, near = np.repeat(row, size), self.links[np.repeat(self.begin[opened], size) + place]
            new = np.unique(row[far[row, near] == np.inf] * len(self.centroids) + near[far[row, near] == np.inf])
            row, near = np.divmod(new, len(self.centroids))
            far[row, near] = closed[row, near] = np.sqrt(((self.centroids[near] - points[row]) ** 2).sum(axis=1))


def _augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    return np.column_stack((vectors, rest))


def _balanced(points: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centroids by k-means with a price on full lists, so that lists become about equally long."""
    centroids = points[np.linspace(0, len(points) - 1, lists).astype(int)].copy()
    price, share = np.zeros(lists), len(points) / lists
    for _ in range(rounds):
        mine, least = np.zeros(len(points), int), np.zeros(len(points))
        for at in range(0, len(points), ROWS):
            some = points[at : at + ROWS]
            square = (some**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1) - 2 * some @ centroids.T
            mine[at : at + ROWS], least[at : at + ROWS] = (square + price).argmin(axis=1), square.min(axis=1)
        size = np.bincount(mine, minlength=lists)
        price += 0.05 * np.median(least) * np.clip(size / share - 1, -1, 2)
        sums = np.zeros_like(centroids)
        np.add.at(sums, mine, points)
        filled = size > 0
        centroids[filled] = sums[filled] / size[filled, None]
    return centroids


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` as doubles, of the vectors that take part.

    NULL ids and vectors, zero vectors and those with NULL or non-finite components do not, nor do
    vectors whose length is not the one that most have (of equally many, the larger).
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.filter(~bad & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().agg(F.max_by("n", F.struct("count", "n"))).first()[0]
    return rows.filter(F.size("embedding") == F.lit(sizes if sizes is not None else 0))


def fit(rows: DataFrame, k: int = 20, lists: int | None = None) -> Index | None:
    """Centroids, their graph and the distance ratio, from a bounded sample of the vectors.

    Unless ``lists`` is given, there are as many lists as the root of the number of rows, so that both lists and
    their lengths grow with the table, or fewer if they were shorter than ``LIST_SIZE``.
    """
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    count, longest = rows.agg(F.count("*"), F.max(norm)).first()
    if not count:
        return None
    lists = lists or max(1, min(int(count**0.5), count // LIST_SIZE))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(max(SAMPLE, SAMPLE_OF_LIST * lists)).toPandas()
    vectors = np.stack(sample["embedding"].to_numpy())
    fitted = vectors[TRIALS:] if len(vectors) > 4 * TRIALS else vectors
    lists = min(lists, len(fitted))
    centroids = _balanced(_augmented(fitted, longest), lists)
    index = Index(longest, centroids, *_graph(centroids), np.unique(np.linspace(0, lists - 1, max(1, int(lists**0.5))).astype(int)))
    _calibrate(rows, index, sample["vec_id"].to_numpy()[:TRIALS], vectors[:TRIALS], k)
    return index


def _graph(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each centroid is tied with its nearest ones and with those whose nearest it is, so that none is out of reach."""
    parts = []
    for at in range(0, len(centroids), ROWS):
        some = centroids[at : at + ROWS]
        square = (centroids**2).sum(axis=1) - 2 * some @ centroids.T
        parts.append(np.argsort(square, axis=1, kind="stable")[:, : DEGREE + 1])
    near = np.concatenate(parts)
    one, other = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
    ties = np.unique(np.concatenate((one * len(near) + other, other * len(near) + one)))
    one, other = np.divmod(ties, len(near))
    return np.searchsorted(one, np.arange(len(near) + 1)), other


def _calibrate(rows: DataFrame, index: Index, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
    """Sets the ratio that finds ``RECALL`` of the true neighbours of the given vectors, all rows being compared with them.

    The slack is then raised until the graph leads to all but a hundredth of what measuring all centroids would find.
    """
    shared = rows.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, queries = shared.value
        best, score = [np.empty((len(ids), 0) + x, float) for x in ((queries.shape[1],), ())]
        for whole in batches:
            for at in range(0, len(whole), BLOCK):
                batch = whole.iloc[at : at + BLOCK]
                points = np.stack(batch["embedding"].to_numpy())
                now = np.where(ids[:, None] == batch["vec_id"].to_numpy(), -np.inf, queries @ points.T)
                top = np.argpartition(-now, min(k, now.shape[1]) - 1, axis=1)[:, :k]
                score = np.concatenate((score, np.take_along_axis(now, top, axis=1)), axis=1)
                best = np.concatenate((best, points[top]), axis=1)
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                score, best = np.take_along_axis(score, top, axis=1), np.take_along_axis(best, top[:, :, None], axis=1)
        if score.shape[1]:
            query = np.repeat(np.arange(len(ids)), score.shape[1])
            frame = pd.DataFrame({"query": query, "score": score.ravel(), "embedding": list(best.reshape(len(query), -1))})
            yield frame[frame["score"] > -np.inf]

    found = rows.mapInPandas(run, "query int, score double, embedding array<double>")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "embedding"))
    # at most TRIALS * k rows
    true = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "embedding").toPandas()
    if true.empty:
        return
    near, kept = index.lists_of(_augmented(np.stack(true["embedding"].to_numpy()), index.longest))
    far = index.distances(index.asked(queries))
    query = true["query"].to_numpy()
    needed = np.where(kept, far[query[:, None], near], np.inf).min(axis=1) / np.maximum(far.min(axis=1)[query], 1e-300)
    index.ratio = float(np.quantile(needed, RECALL, method="higher")) * (1 + 1e-9)
    while True:
        reached = np.concatenate([index.search(index.asked(queries[at : at + 128])) for at in range(0, len(queries), 128)])
        least = reached.min(axis=1)[query]
        read = (np.where(kept, reached[query[:, None], near], np.inf).min(axis=1) <= least * index.ratio).mean()
        if read >= RECALL - 0.01 or (reached < np.inf).all():
            return
        index.slack *= 1.03


def postings(rows: DataFrame, index: Index) -> DataFrame:
    """``list, primary, vec_id, embedding``: each vector in its nearest list and, near a boundary, in others."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.iloc[at : at + ROWS]
                near, kept = shared.value.lists_of(_augmented(np.stack(batch["embedding"].to_numpy()), shared.value.longest))
                row, rank = np.nonzero(kept)
                out = batch.iloc[row].reset_index(drop=True)
                yield out.assign(list=near[row, rank], primary=rank == 0)[["list", "primary", "vec_id", "embedding"]]

    return rows.mapInPandas(run, "list int, primary boolean, vec_id long, embedding array<double>")


def probes(queries: DataFrame, index: Index, sizes: np.ndarray, k: int) -> DataFrame:
    """``list, first, query_id, query``: the lists that each query reads, and whether they are its nearest ones.

    Those whose centroid passes the distance ratio, and further ones until they have more than ``k``
    vectors; if the graph did not find as many, all lists.
    """
    shared = queries.sparkSession.sparkContext.broadcast((index, sizes))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, sizes = shared.value
        for whole in batches:
            for at in range(0, len(whole), 128):
                batch = whole.iloc[at : at + 128]
                points = index.asked(np.stack(batch["query"].to_numpy()))
                far = index.search(points)
                few = (np.where(far < np.inf, sizes, 0)).sum(axis=1) <= k
                far[few] = index.distances(points[few])
                near = np.argsort(far, axis=1, kind="stable")
                far = np.take_along_axis(far, near, axis=1)
                before = np.cumsum(sizes[near], axis=1) - sizes[near]
                row, rank = np.nonzero((far < np.inf) & ((far <= far[:, :1] * index.ratio) | (before <= k)))
                first = (rank < FIRST) | (before[row, rank] <= k)
                yield batch.iloc[row].reset_index(drop=True).assign(list=near[row, rank], first=first)[["list", "first", "query_id", "query"]]

    spread = queries.repartition(queries.sparkSession.sparkContext.defaultParallelism, "query_id")
    return spread.mapInPandas(run, "list int, first boolean, query_id long, query array<double>")


RESULT = "query_id long, vec_id long, score double"


def _compare(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks])
        return flat.reshape(len(column), -1)

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            return schema.empty_table()
        ids, asks, least = vectors["vec_id"].to_numpy(), queries["query_id"].to_numpy(), queries["least"].to_numpy()
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id
        ids, points, targets = ids[order], matrix(vectors["embedding"])[order], matrix(queries["query"])
        take = k * np.unique(ids, return_counts=True)[1].max()  # k different ids, however often one comes
        parts = []
        long, far = np.linalg.norm(points, axis=1), np.linalg.norm(targets, axis=1)
        for at in range(0, len(asks), 512):
            here = slice(at, at + 512)
            score = targets[here] @ points.T
            # the last bits of a matrix product depend on its shape: equal vectors have to tie, however short they are
            scale = far[here, None] * long
            score = np.round(score / scale, 12) * scale
            score[(asks[here, None] == ids) | (score < least[here, None] - 1e-11 * scale)] = -np.inf
            for i in np.flatnonzero((score > -np.inf).any(axis=1)):
                there = np.flatnonzero(score[i] > -np.inf)
                chosen = there[np.argsort(-score[i, there], kind="stable")[:take]]
                exact = np.einsum("j,ij->i", targets[at + i], points[chosen])
                parts.append((np.full(len(chosen), asks[at + i]), ids[chosen], exact))
        if not parts:
            return schema.empty_table()
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _found(lists: DataFrame, reads: DataFrame, sizes: np.ndarray, k: int) -> DataFrame:
    """``query_id, vec_id, score``, written: of each list that a query reads its best ``k`` that reach ``least``.

    A cell compares one block of a list with one part of the queries that read the list.
    """
    asks = reads.groupBy("list").count().toPandas()  # a row for each list
    rows = [(int(i), int(-(-sizes[i] // BLOCK)), int(-(-m // BLOCK))) for i, m in zip(asks["list"], asks["count"], strict=True) if sizes[i]]
    cut = F.broadcast(lists.sparkSession.createDataFrame(rows, "list int, blocks int, parts int"))
    vectors_of = lists.join(cut, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "vec_id", "embedding"
    )
    queries_of = reads.join(cut, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part"), "query_id", "query", "least"
    )
    keys = ["list", "block", "part"]
    found = vectors_of.groupBy(*keys).cogroup(queries_of.groupBy(*keys)).applyInArrow(_compare(k), RESULT)
    return written(found, "found")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` nearest found for each query: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``embedding``, as has ``queries``; both are taken as ``usable`` says.
    A query is not its own neighbour. Ties go to the smaller vec_id. Of rows that share an id, a
    query is the one with the smallest vector, and a neighbour counts once, by its best score. Where there
    are fewer than ``k`` candidates, all are returned. Without vectors or queries the result is empty.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors), "vectors")
    index = fit(rows, k)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = usable(queries).filter(F.size("embedding") == index.centroids.shape[1] - 1)
    asked = asked.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("query"))
    lists = written(postings(rows, index), "postings")
    # a row for each list
    table = lists.groupBy("list").agg(F.count("*").alias("n"), F.count_if("primary").alias("own")).toPandas()
    sizes, own = np.zeros(len(index.centroids), int), np.zeros(len(index.centroids), int)
    sizes[table["list"]], own[table["list"]] = table["n"], table["own"]
    reads = written(probes(asked, index, own, k), "probes")
    best = _ranked(_found(lists, reads.filter("first").withColumn("least", F.lit(float("-inf"))), sizes, k), k)
    # what a query found in its nearest lists bounds what the others have to offer
    least = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    rest = reads.filter("NOT first").join(least, "query_id", "left").fillna(float("-inf"), ["least"])
    further = _found(lists, rest, sizes, k)
    return _ranked(best.drop("rank").unionByName(further), k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k)
