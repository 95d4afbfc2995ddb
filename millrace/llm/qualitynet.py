"""Quality score of a text by a small convolutional network over its bytes, in numpy.

Bytes have learned vectors; learned filters look at ``WIDTH`` bytes at every place of the
text. The places are cut into chunks that overlap by ``WIDTH - 1`` bytes and cover the whole
text; each filter's highest answer in a chunk is the chunk's feature. The features' mean over
all chunks, and their mean square, are combined by a logistic unit into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import table, texts_of, with_columns
from millrace.llm.langid import remainder

WIDTH = 6
FILTERS = 16
VECTOR = 8
#: Places of a chunk.
CHUNK = 192
#: Labelled texts the network is fitted on, about, at most.
FIT_TEXTS = 4000
#: Batches learned from, whatever the number of texts.
STEPS = 600
BATCH = 32
#: Texts that score at least this much are predicted to be good.
GOOD = 0.7
_BLOCK = 512  # chunks convolved at once


def chunks_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, each padded for its last place; first and last place of each chunk; its text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    padded = [r + bytes(WIDTH - 1 if r else WIDTH) for r in raw]
    starts, ends, owner, at = [], [], [], 0
    for i, r in enumerate(raw):
        places = max(1, len(r))
        own = range(at, at + places, CHUNK)
        starts += own
        ends += [*own[1:], at + places]
        owner += [i] * len(own)
        at += len(padded[i])
    return np.frombuffer(b"".join(padded), np.uint8), np.array(starts, np.int64), np.array(ends, np.int64), np.array(owner, np.int64)


@dataclass
class Net:
    vectors: np.ndarray  # 256 x VECTOR
    filters: np.ndarray  # WIDTH x VECTOR x FILTERS
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # 2 * FILTERS
    offset: np.ndarray  # 1

    @classmethod
    def started(cls, seed: int = 13) -> Net:
        pick = np.random.default_rng(seed)
        return cls(pick.normal(0, 0.5, (256, VECTOR)), pick.normal(0, 0.35, (WIDTH, VECTOR, FILTERS)),
                   np.zeros(FILTERS), pick.normal(0, 0.1, 2 * FILTERS), np.ones(1))

    def parts(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.out, self.offset]

    def tables(self) -> np.ndarray:
        """What a byte adds to each filter's answer, by its place in the filter."""
        return np.einsum("bv,wvf->wbf", self.vectors, self.filters).astype(np.float32)

    @staticmethod
    def highest(tables: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, where: bool = False):
        """Each chunk's highest answers and, with ``where``, the places that gave them."""
        top = np.empty((len(starts), FILTERS), np.float32)
        place = np.empty((len(starts), FILTERS), np.int64) if where else None
        for a in range(0, len(starts), _BLOCK):
            b = min(a + _BLOCK, len(starts))
            first, last = starts[a], ends[b - 1]
            answers = np.full((last - first + 1, FILTERS), -np.inf, np.float32)
            answers[:-1] = tables[0][data[first:last]]
            for w in range(1, WIDTH):
                answers[:-1] += tables[w][data[first + w:last + w]]
            edges = np.stack([starts[a:b], ends[a:b]], axis=1).ravel() - first
            top[a:b] = np.maximum.reduceat(answers, edges, axis=0)[::2]
            if where:
                for k in range(a, b):
                    place[k] = answers[starts[k] - first:ends[k] - first].argmax(axis=0) + starts[k]
        return top, place

    def features(self, top: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: mean and mean square of its chunks' squashed answers; those; chunk numbers."""
        squashed = np.tanh(top + self.bias)
        each = np.bincount(owner, minlength=n).astype(np.float64)
        first = np.searchsorted(owner, np.arange(n))
        mean = np.add.reduceat(squashed, first, axis=0) / each[:, None]
        square = np.add.reduceat(squashed**2, first, axis=0) / each[:, None]
        return np.concatenate([mean, square], axis=1), squashed, each

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        data, starts, ends, owner = chunks_of(texts)
        top, _ = self.highest(self.tables(), data, starts, ends)
        features, _, _ = self.features(top, owner, len(texts))
        return 1 / (1 + np.exp(-np.clip(features @ self.out + self.offset[0], -30, 30)))

    def gradients(self, texts: list[str], labels: np.ndarray) -> list[np.ndarray]:
        data, starts, ends, owner = chunks_of(texts)
        top, place = self.highest(self.tables(), data, starts, ends, where=True)
        features, squashed, each = self.features(top, owner, len(texts))
        score = 1 / (1 + np.exp(-np.clip(features @ self.out + self.offset[0], -30, 30)))
        error = (score - labels) / len(texts)
        to_mean, to_square = error[:, None] * self.out[:FILTERS], error[:, None] * self.out[FILTERS:]
        chunk = (to_mean[owner] + 2 * squashed * to_square[owner]) / each[owner][:, None] * (1 - squashed**2)
        spread = np.zeros((WIDTH, 256 * FILTERS))
        column = np.arange(FILTERS)
        for w in range(WIDTH):
            spread[w] = np.bincount((data[place + w].astype(np.int64) * FILTERS + column).ravel(), chunk.ravel(), 256 * FILTERS)
        spread = spread.reshape(WIDTH, 256, FILTERS)
        return [np.einsum("wbf,wvf->bv", spread, self.filters), np.einsum("wbf,bv->wvf", spread, self.vectors),
                chunk.sum(axis=0), features.T @ error, np.array([error.sum()])]


def trained(texts: list[str], labels: np.ndarray, steps: int = STEPS) -> Net:
    """A network fitted by Adam on batches in a fixed random order, text after text, again and again."""
    net, pick = Net.started(), np.random.default_rng(29)
    means = [[np.zeros_like(p), np.zeros_like(p)] for p in net.parts()]
    ahead = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        while len(ahead) < BATCH:
            ahead = np.concatenate([ahead, pick.permutation(len(texts))])
        chosen, ahead = ahead[:BATCH], ahead[BATCH:]
        rate = 0.02 * (1 - step / (steps + 1))
        for part, held, grad in zip(net.parts(), means, net.gradients([texts[i] for i in chosen], labels[chosen]), strict=True):
            held[0] = 0.9 * held[0] + 0.1 * grad
            held[1] = 0.99 * held[1] + 0.01 * grad**2
            part -= rate * (held[0] / (1 - 0.9**step)) / (np.sqrt(held[1] / (1 - 0.99**step)) + 1e-8)
    return net


def fit(documents: DataFrame, labels: DataFrame) -> Net | None:
    """A network from documents (doc_id, text) and labels (doc_id, quality); None without labels.

    Null ids and qualities teach nothing; null texts count as empty. Of more than
    ``FIT_TEXTS`` labels an even selection by a hash of the id is used; the fit runs in one
    task over this bounded selection, whatever the size of the corpus.
    """
    labels = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
    share = FIT_TEXTS / max(1, labels.count())
    if share < 1:
        labels = labels.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(share * 1_000_000))
    chosen = (documents.select("doc_id", "text").join(F.broadcast(labels), F.col("doc_id") == F.col("__id"))
              .select(F.lit(1).alias("one"), F.xxhash64("doc_id", "text").alias("key"), "text", "quality"))

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "quality"])
        net = trained([t or "" for t in rows["text"]], rows["quality"].to_numpy(np.float64))
        return pd.DataFrame({"part": range(5), "values": [p.tobytes() for p in net.parts()]})

    made = {r["part"]: r["values"] for r in chosen.groupBy("one").applyInPandas(learn, "part int, values binary").collect()}
    if not made:
        return None
    return Net(*(np.frombuffer(made[i]).reshape(p.shape) for i, p in enumerate(Net.started().parts())))


SCORED = [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]


def score_quality(documents: DataFrame, net: Net | None, good: float = GOOD) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= ``good``) to every row, from ``text`` alone.

    A null text is scored as the empty text; without a network (nothing labelled) every
    score is 1, so that nothing is rejected unjudged. Repeated rows score alike; other
    columns stay, ``score`` and ``predicted`` are replaced; an empty table gives no rows.
    """
    held = documents.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    def make():
        model = held.value

        def score(batch: pa.RecordBatch) -> list[pa.Array]:
            scores = np.ones(batch.num_rows) if model is None else model.scores(texts_of(batch))
            return [pa.array(scores, pa.float64()), pa.array((scores >= good).astype(np.int32))]

        return score

    return with_columns(documents, "text", SCORED, make)


def fit_given(spark: SparkSession, sf_dir: str) -> Net | None:
    """The network of the given tables, from labels whose id has another remainder than 2."""
    return fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of all documents."""
    scored = score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), fit_given(spark, sf_dir))
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
