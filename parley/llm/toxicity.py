"""Toxicity by weak supervision: voters, a generative model of their votes, a classifier of its labels.

1. Candidates for lexicons (whole words) and patterns (words that begin with four, five or six given
   bytes) are features that occur in toxic labelled texts far more often than in others.
2. A greedy cover picks the voters from them: each next one fires in most toxic texts that have no
   voter yet. Two shape voters look at capitals and exclamation marks.
3. A two-class generative model of the votes is fitted by expectation and maximisation: how often each
   voter fires in either class (its accuracy), and how voters hang together within a class; voters
   that do so share their say.
4. A logistic regression is trained on the model's posterior labels, and scores all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import NOT_ALNUM, Words, has, mixed, pieces, written

#: Labelled rows that are learned from at most: those with the smallest hash of their id.
MAX_LABELLED = 200_000
#: Places in which features are counted before candidates are told apart, and candidates at most.
PLACES, MAX_CANDIDATES, MAX_VOTERS = 1 << 20, 4000, 48
#: A voter's share of toxic texts among those in which it fires, and the toxic texts that it has to add.
PRECISION, LEAST_TEXTS, LEAST_SHARE = 0.8, 2, 0.001
PREFIXES = (4, 5, 6)
SHAPES = 2
THRESHOLD = 0.7


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each word and of each beginning of a longer word."""
    size = words.end - words.start
    docs, hashes = [words.doc], [words.hash]
    for n in PREFIXES:
        longer = size > n
        docs.append(words.doc[longer])
        hashes.append(mixed(words.prefix(n)[longer] + np.uint64(n)))
    return np.concatenate(docs), np.concatenate(hashes)


def shapes(texts: list[bytes]) -> np.ndarray:
    """Mostly capitals; many exclamation marks."""
    out = np.zeros((len(texts), SHAPES), bool)
    for i, x in enumerate(texts):
        y = np.bincount(np.frombuffer(x, np.uint8), minlength=256)
        upper, lower = y[0x41:0x5B].sum(), y[0x61:0x7B].sum()
        out[i] = upper > 20 and upper > lower, y[0x21] >= 5 and 200 * y[0x21] > len(x)
    return out


def _distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


@dataclass
class Model:
    """Sorted hashes of the voters with their columns; weights of all voters and the bias."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    column: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(SHAPES))
    bias: float = -20.0
    accuracies: np.ndarray = field(default_factory=lambda: np.zeros((2, SHAPES)))

    def votes(self, texts: list[bytes]) -> np.ndarray:
        fired = np.zeros((len(texts), len(self.hashes) + SHAPES), bool)
        fired[:, len(self.hashes) :] = shapes(texts)
        if len(self.hashes):
            doc, value = features(Words(texts, NOT_ALNUM))
            at = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
            there = self.hashes[at] == value
            fired[doc[there], self.column[at[there]]] = True
        return fired

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.votes(texts) @ self.weights + self.bias, -50, 50)))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with a label, 0 or 1 (of several labels of an id the larger); a bounded number of rows."""
    labels = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
    labels = labels.filter("__id IS NOT NULL AND toxic IN (0, 1)").groupBy("__id").agg(F.max("toxic").alias("toxic"))
    sample = labels.orderBy(F.xxhash64("__id"), "__id").limit(MAX_LABELLED)
    rows = docs.select(has(docs, "doc_id", "long").alias("doc_id"), has(docs, "text", "string").alias("text"))
    return rows.join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("text", "toxic")


def _counts(rows: DataFrame) -> DataFrame:
    """Texts of either label in which a feature of each place occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, PLACES), np.int64)
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                toxic = np.array(part.column("toxic").to_pylist())
                doc, value = features(Words(texts, NOT_ALNUM))
                doc, place = _distinct(doc, (value % np.uint64(PLACES)).astype(np.int64))
                for y in (0, 1):
                    n[y] += np.bincount(place[toxic[doc] == y], minlength=PLACES)
        there = np.flatnonzero(n[1])
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(n[0][there]), pa.array(n[1][there])], ["place", "clean", "toxic"])
        there = np.flatnonzero((n[0] > 0) & (n[1] == 0))
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(n[0][there]), pa.array(n[1][there])], ["place", "clean", "toxic"])

    return rows.mapInArrow(run, "place int, clean long, toxic long").groupBy("place").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _sparse(rows: DataFrame, places: np.ndarray) -> DataFrame:
    """Each text's label, shapes and distinct features in the candidate places."""
    shared = rows.sparkSession.sparkContext.broadcast(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                doc, value = features(Words(texts, NOT_ALNUM))
                keep = np.isin((value % np.uint64(PLACES)).astype(np.int64), shared.value)
                doc, value = _distinct(doc[keep], value[keep])
                bounds = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(value.view(np.int64)))
                shape = shapes(texts) @ (1 << np.arange(SHAPES))
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(shape.astype(np.int32)), lists], ["toxic", "shape", "found"])

    return rows.mapInArrow(run, "toxic int, shape int, found array<long>")


def cover(toxic: np.ndarray, doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Features chosen one by one: each fires in most toxic texts without a voter, and hardly in clean ones.

    Among equals the one that fires in fewer toxic texts overall goes last, then the larger hash.
    """
    names, number = np.unique(value, return_inverse=True)
    positive = np.bincount(number, toxic[doc], minlength=len(names))
    every = np.bincount(number, minlength=len(names))
    good = (positive >= LEAST_TEXTS) & (positive >= PRECISION * every)
    keep = good[number] & (toxic[doc] == 1)
    doc, number = doc[keep], number[keep]
    least, chosen = max(LEAST_TEXTS, LEAST_SHARE * toxic.sum()), []
    open_ = np.ones(len(toxic), bool)
    while len(chosen) < MAX_VOTERS:
        gain = np.bincount(number[open_[doc]], minlength=len(names))
        best = int(np.lexsort((np.arange(len(names)), -positive, -gain))[0]) if len(names) else 0
        if not len(names) or gain[best] < least:
            break
        chosen.append(best)
        open_[doc[number == best]] = False
    return names[np.sort(np.array(chosen, int))]


def label_model(votes: np.ndarray, toxic: np.ndarray, count: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each pattern of votes, and each voter's rates in both classes.

    The given label is one more voter, right in most cases. Voters that fire together more often than
    their class explains are correlated; each one's evidence counts 1 / (1 + sum of correlations).
    """
    all_votes = np.column_stack((votes, toxic)).astype(float)
    posterior, total = np.clip(toxic.astype(float), 0.02, 0.98), count.sum()
    say, rates, prior = np.ones(all_votes.shape[1]), np.zeros((2, all_votes.shape[1])), 0.5
    for step in range(rounds):
        weight = np.stack((count * (1 - posterior), count * posterior))
        rates = (weight @ all_votes + 0.1) / (weight.sum(axis=1, keepdims=True) + 0.2 + 2 * (total > 1000))
        rates[1, :-1] = np.maximum(rates[1, :-1], rates[0, :-1])  # a voter speaks for toxicity or says nothing
        prior = np.clip(weight[1].sum() / total, 1e-4, 1 - 1e-4)
        if step == rounds // 2:
            say = _say(all_votes, weight, rates)
        fired, silent = np.log(rates), np.log1p(-rates)
        evidence = all_votes @ ((fired[1] - fired[0]) * say) + (1 - all_votes) @ ((silent[1] - silent[0]) * say)
        posterior = 1 / (1 + np.exp(-np.clip(evidence + np.log(prior / (1 - prior)), -50, 50)))
    return posterior, rates


def _say(votes: np.ndarray, weight: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """1 / (1 + positive correlations with the other voters, within the classes)."""
    together, spread = np.zeros((votes.shape[1],) * 2), np.zeros(votes.shape[1])
    for y in (0, 1):
        rest = votes - rates[y]
        together += (rest * weight[y][:, None]).T @ rest
        spread += weight[y] @ (rest * rest)
    correlation = together / np.sqrt(np.outer(spread, spread) + 1e-9)
    np.fill_diagonal(correlation, 0)
    return 1 / (1 + np.where(correlation > 0.2, correlation, 0).sum(axis=1))


def regression(votes: np.ndarray, target: np.ndarray, count: np.ndarray, penalty: float = 0.02, rounds: int = 30) -> np.ndarray:
    """Weights and bias of a logistic regression on soft labels, by Newton steps."""
    x = np.column_stack((votes, np.ones(len(votes)))).astype(float)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (count * (target - p)) - ridge * w
        curve = (x * (count * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w += step / max(1.0, np.abs(step).max() / 4)
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of the labelled texts. Without a toxic label, or a voter, all texts score near 0."""
    rows = written(labelled(docs, labels), "labelled")
    counts = _counts(rows).filter(F.col("toxic") >= LEAST_TEXTS).filter("toxic >= clean")
    odds = F.col("toxic") * F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5))
    places = counts.orderBy(odds.desc(), "place").limit(MAX_CANDIDATES).select("place").toPandas()["place"].to_numpy()
    # at most MAX_LABELLED rows with the few candidates that occur in each
    sparse = _sparse(rows, places).toPandas()
    toxic = sparse["toxic"].to_numpy(int)
    if not toxic.any():
        return Model()
    sizes = sparse["found"].map(len).to_numpy()
    doc = np.repeat(np.arange(len(toxic)), sizes)
    # an empty list comes without a type of its own
    value = np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, np.int64) for x in sparse["found"] if len(x))]).view(np.uint64)
    hashes = cover(toxic, doc, value)
    votes = np.zeros((len(toxic), len(hashes) + SHAPES), bool)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
        there = hashes[at] == value
        votes[doc[there], at[there]] = True
    votes[:, len(hashes) :] = (sparse["shape"].to_numpy()[:, None] >> np.arange(SHAPES)) & 1
    pattern, count = np.unique(np.column_stack((votes, toxic)), axis=0, return_counts=True)
    posterior, rates = label_model(pattern[:, :-1], pattern[:, -1], count)
    w = regression(pattern[:, :-1], posterior, count)
    return Model(hashes, np.arange(len(hashes)), w[:-1], float(w[-1]), rates)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with ``score`` (0 to 1) and ``predicted``; columns with these names are replaced.

    NULL and empty texts get the score of a text in which no voter fires. Whole texts are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted")
    if "text" not in docs.columns:
        docs = docs.withColumn("text", has(docs, "text", "string"))
    schema = docs.withColumns({"score": F.lit(0.0).cast("double"), "predicted": F.lit(0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                p = shared.value.score(texts)
                predicted = pa.array((p >= THRESHOLD).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), predicted], [*part.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, schema)
