"""Language identification by the nearest of several centroids a language.

A text becomes a vector over hashed character n-grams, damped counts times inverse document
frequency, of length one. Each language has several centroids, found by spherical k-means
over its training vectors, so that scripts, registers and noise of a language need not share
one mean. A text gets the language of the centroid with the highest cosine; it is rejected
when its distance to that centroid is beyond what training texts of the language showed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import slices, table, texts_of, with_columns
from millrace.llm.words import mix

#: Cells of the hashed vectors.
CELLS = 1 << 12
#: Characters of the n-grams.
LENGTHS = (2, 3)
#: Labelled texts the model is fitted on, about, for each language at most.
FIT_TEXTS = 1500
#: Centroids of a language.
CENTROIDS = 4
#: A text is rejected beyond this quantile of its language's training distances, plus a margin.
REJECT_QUANTILE, REJECT_MARGIN = 0.995, 0.05
UNKNOWN = "und"


def gram_counts(text: str) -> np.ndarray:
    """Counts of the cells of a whole text: n-grams of lower-cased letters, other signs as one gap."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_LETTER[np.minimum(points, len(_LETTER) - 1)], points, 32)
    gap = points == 32
    points = np.concatenate([[32], points[~(gap & np.roll(gap, 1))], [32]]).astype(np.uint64)
    out = np.zeros(CELLS, np.float32)
    for size in LENGTHS:
        n = len(points) - size + 1
        if n > 0:
            value = np.full(n, size, np.uint64)
            for i in range(size):
                value = value * np.uint64(0x1F35B) + points[i:i + n]
            out += np.bincount((mix(value) >> np.uint64(52)).astype(np.int64), minlength=CELLS)
    return out


# Beyond the first planes' letters everything counts as a letter, so that any script has n-grams.
_LETTER = np.array([chr(i).isalpha() for i in range(0x3000)] + [True])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of damped counts times idf, each of length one (a zero row stays zero)."""
    rows = np.log1p(counts) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    reach: np.ndarray

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """Language, score in 0 to 1 and whether the text is within reach of the language."""
        out = []
        for text in texts:
            if not self.langs or not has_letter(text):
                out.append((UNKNOWN, 0.0, False))
                continue
            cosines = self.centroids @ weighted(gram_counts(text), self.idf)
            best = int(np.argmax(cosines))
            out.append((self.langs[best], float(min(1.0, max(0.0, cosines[best]))), bool(1 - cosines[best] <= self.reach[best])))
        return out


def _fit_language(rows: pd.DataFrame) -> pd.DataFrame:
    """Spherical k-means over one language's vectors, started from far-apart rows."""
    rows = rows.sort_values("key")
    vectors = np.stack([np.frombuffer(v, np.float32) for v in rows["vector"]])
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(CENTROIDS, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(10):
        own = np.argmax(vectors @ centroids.T, axis=1)
        for k in range(len(centroids)):
            if (own == k).any():
                mean = vectors[own == k].mean(axis=0)
                centroids[k] = mean / max(np.linalg.norm(mean), 1e-12)
    distance = 1 - np.max(vectors @ centroids.T, axis=1)
    reach = float(np.quantile(distance, REJECT_QUANTILE)) + REJECT_MARGIN
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [c.astype(np.float32).tobytes() for c in centroids], "reach": reach})


def fit(labelled: DataFrame) -> Model:
    """A model from rows (doc_id, text, lang); null texts and languages teach nothing.

    Of a language with more than ``FIT_TEXTS`` rows an even selection by a hash of the id
    and text is used. Vectors are made by the executors, and each language's centroids in
    one task over its bounded selection.
    """
    spark = labelled.sparkSession
    labelled = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select(
        "lang", "text", F.xxhash64("doc_id", F.length("text")).alias("key"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return Model(np.ones(CELLS, np.float32), np.zeros((0, CELLS), np.float32), [], np.zeros(0))
    shares = spark.createDataFrame([(k, int(min(1.0, FIT_TEXTS / n) * 1_000_000)) for k, n in counts.items()], "lang string, share int")
    chosen = labelled.join(F.broadcast(shares), "lang").where(F.pmod("key", F.lit(1_000_000)) < F.col("share")).drop("share")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("key"), pa.array([gram_counts(t).tobytes() for t in texts_of(part)], pa.binary())],
                    ["lang", "key", "vector"])

    made = chosen.mapInArrow(vectors, "lang string, key long, vector binary").persist()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(CELLS, np.int64), 0
        for batch in batches:
            for vector in batch.column("vector"):
                held += np.frombuffer(vector.as_buffer(), np.float32) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([held.tobytes()], pa.binary())], ["n", "held"])

    partial = made.mapInArrow(frequencies, "n long, held binary").collect()  # one row a task of the bounded selection
    total = sum(r["n"] for r in partial)
    held = sum((np.frombuffer(r["held"], np.int64) for r in partial), np.zeros(CELLS, np.int64))
    idf = np.log((1 + total) / (1 + held)).astype(np.float32) + np.float32(0.1)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [weighted(np.frombuffer(v.as_buffer(), np.float32), idf).astype(np.float32).tobytes() for v in batch.column("vector")]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("key"), pa.array(rows, pa.binary())], ["lang", "key", "vector"])

    fitted = (made.mapInArrow(weigh, "lang string, key long, vector binary").groupBy("lang")
              .applyInPandas(_fit_language, "lang string, centroid binary, reach double")).collect()
    made.unpersist()
    fitted.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    return Model(idf, np.stack([np.frombuffer(r["centroid"], np.float32) for r in fitted]), [r["lang"] for r in fitted],
                 np.array([r["reach"] for r in fitted]))


PREDICTED = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False),
             T.StructField("accepted", T.BooleanType(), False)]


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred, score (the cosine) and accepted to every row, from ``text`` alone.

    A text that is null or has no letter gets ``und``, 0 and false; so does every text if
    the model learned no language. Ties go to the language first in order. Repeated rows are
    predicted alike; other columns stay, those named as a result are replaced.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)  # CENTROIDS rows of CELLS a language

    def make():
        found = held.value

        def predict(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = found.predict(texts_of(batch))
            return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]

        return predict

    return with_columns(documents, "text", PREDICTED, make)


def remainder(doc_id: str, by: int):
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(by))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those with another remainder than 2."""
    documents = table(spark, sf_dir, "documents")
    model = fit(documents.where(remainder("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    return identify(documents.select("doc_id", "text"), model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")
