"""Line dedup by a sharded minimal perfect hash over the distinct line hashes.

Each distinct line hash belongs to one shard. A shard holds a minimal perfect hash of its
hashes (levels of bit arrays, places counted by rank) and, at the places it gives, compact
arrays: a 32-bit fingerprint, the number of documents up to ``MANY``, and the smallest
document id. Documents send their line hashes to the shards and probe the arrays; every
probed hash is a member, so that its place is its own, and the fingerprint guards the arrays.

A line that a large share of the documents hold would send all its probes to one shard. Such
lines are few by count (at most ``HOT_LINES``); their answers are broadcast instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import saved, slices, table, texts_of, unused, with_columns
from millrace.llm.words import mix

#: Code points of the shortest key that counts.
SHORTEST = 10
#: Distinct line hashes of a shard, about.
SHARD_LINES = 8_000
#: Lines whose answers are broadcast, at most: those with more than 1 / HOT_LINES of all probes.
HOT_LINES = 4096
#: Document counts are kept in 16 bits; larger ones read as this one.
MANY = 65_535
_STRIP = b" \t\n\r\x0b\x0c"




def line_keys(text: str) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and the key of each that is long enough to count."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    keys = [line.strip(_STRIP).lower() for line in lines]
    return lines, [k if len(k) >= 4 * SHORTEST or len(k.decode("utf-8", "surrogatepass")) >= SHORTEST else None for k in keys]


def _identity(key: bytes) -> tuple[int, int]:
    """Hash and fingerprint of a key: 64 and 32 bits of one digest, signed."""
    digest = xxhash.xxh3_128_intdigest(key)
    high, low = digest >> 64, digest & 0xFFFFFFFF
    return high - (high >> 63 << 64), low - (low >> 31 << 32)


def line_hashes(documents: DataFrame) -> DataFrame:
    """(hash, fingerprint, doc_id) for each distinct counting line of each document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, owners = [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), texts_of(part), strict=True):
                    own = {_identity(k) for k in line_keys(text)[1] if k is not None}
                    found += own
                    owners += [doc] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in found], pa.int64()), pa.array([f for _, f in found], pa.int32()),
                     pa.array(owners, pa.int64())], ["hash", "fingerprint", "doc_id"])

    return (documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(emit, "hash long, fingerprint int, doc_id long"))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit values.

    Level after level, a value whose bit no other value shares is placed there; the others go
    on to the next. The place of a value is the number of set bits before its own.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.sizes = bits, sizes
        self.rank = np.cumsum(bits, dtype=np.int64) - 1

    @classmethod
    def of(cls, values: np.ndarray) -> PerfectHash:
        levels, left = [], values
        while len(left):
            at = cls._spots(left, len(levels), 2 * len(left))
            alone = np.bincount(at, minlength=2 * len(left))[at] == 1
            level = np.zeros(2 * len(left), bool)
            level[at[alone]] = True
            levels.append(level)
            left = left[~alone]
        return cls(np.concatenate([*levels, np.empty(0, bool)]), np.array([len(x) for x in levels], np.int32))

    @staticmethod
    def _spots(values: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(values + np.uint64(level * 0x632BE59BD9B4E019 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def places(self, values: np.ndarray) -> np.ndarray:
        """The place of each value; -1 where it is in no level."""
        out, left, start = np.full(len(values), -1, np.int64), np.arange(len(values)), 0
        for level, size in enumerate(self.sizes.tolist()):
            spot = self._spots(values[left], level, size) + start
            set_ = self.bits[spot]
            out[left[set_]] = self.rank[spot[set_]]
            left, start = left[~set_], start + size
        return out


INDEX = "shard int, bits binary, sizes binary, fingerprints binary, counts binary, firsts binary, clashes binary"
_CLASH = np.dtype([("hash", "<u8"), ("fingerprint", "<i4"), ("first", "<i8"), ("count", "<u2")])


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    hashes = rows["hash"].to_numpy(np.int64).view(np.uint64)
    count = np.where(rows["first"] == rows["last"], 1, np.clip(rows["n"], 2, MANY)).astype(np.uint16)
    fingerprint, first = rows["fingerprint"].to_numpy(np.int32), rows["first"].to_numpy(np.int64)
    order = np.argsort(hashes, kind="stable")
    twice = hashes[order][1:] == hashes[order][:-1]
    clash = np.zeros(len(hashes), bool)  # different lines with one hash: kept aside, whole
    clash[order[1:][twice]] = clash[order[:-1][twice]] = True
    aside = np.empty(int(clash.sum()), _CLASH)
    for name, values in (("hash", hashes), ("fingerprint", fingerprint), ("first", first), ("count", count)):
        aside[name] = values[clash]
    perfect = PerfectHash.of(hashes[~clash])
    place = perfect.places(hashes[~clash])
    arrays = []
    for values in (fingerprint, count, first):
        array = np.empty(len(place), values.dtype)
        array[place] = values[~clash]
        arrays.append(array.tobytes())
    return pd.DataFrame({"shard": rows["shard"].iloc[:1].astype("int32").to_numpy(), "bits": [np.packbits(perfect.bits).tobytes()],
                         "sizes": [perfect.sizes.tobytes()], "fingerprints": [arrays[0]], "counts": [arrays[1]],
                         "firsts": [arrays[2]], "clashes": [aside.tobytes()]})


def _probe_shard(probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """The probed lines that their document loses."""
    row = index.iloc[0]
    sizes = np.frombuffer(row["sizes"], np.int32)
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
    hashes, prints = probes["hash"].to_numpy(np.int64), probes["fingerprint"].to_numpy(np.int32)
    docs = probes["doc_id"].to_numpy(np.int64)
    place = PerfectHash(bits, sizes).places(hashes.view(np.uint64))
    held = np.flatnonzero(place >= 0)
    held = held[np.frombuffer(row["fingerprints"], np.int32)[place[held]] == prints[held]]
    at = place[held]
    lose = np.zeros(len(probes), bool)
    lose[held] = (np.frombuffer(row["counts"], np.uint16)[at] >= 2) & (np.frombuffer(row["firsts"], np.int64)[at] != docs[held])
    for hash_, print_, first, count in np.frombuffer(row["clashes"], _CLASH).tolist():
        same = (hashes.view(np.uint64) == np.uint64(hash_)) & (prints == print_)
        lose[same] = (count >= 2) & (docs[same] != first)
    return pd.DataFrame({"doc_id": docs[lose], "hash": hashes[lose]})


def _shard_of(shards: int):
    """The shard of a hash: its leading bits."""
    return F.shiftrightunsigned("hash", 65 - shards.bit_length()).cast("int") if shards > 1 else F.lit(0)


def line_index(stats: DataFrame, shards: int) -> DataFrame:
    """The sharded index of line statistics (hash, fingerprint, first, last, n): one row a shard."""
    return stats.withColumn("shard", _shard_of(shards)).groupBy("shard").applyInPandas(_build_shard, INDEX)


KEPT = [T.StructField("text", T.StringType(), False), T.StructField("n_lines", T.LongType(), False),
        T.StructField("n_dropped", T.LongType(), False)]


def drop_repeated_lines(documents: DataFrame) -> DataFrame:
    """Replaces ``text`` by the lines that stay and adds ``n_lines`` and ``n_dropped``.

    Needs ``doc_id`` and ``text``. Lines are compared stripped of white space at both ends
    and with A-Z lower-cased; keys under ten code points never count. A line that documents
    with at least two different ids hold stays only in rows of the smallest id (every copy
    of it there, repeated rows of that id included). A null or empty text is one empty line
    and gives the empty text; a row with a null id neither counts nor loses lines. Other
    columns stay, ``n_lines`` and ``n_dropped`` are replaced. An empty table gives no rows.
    """
    owner, hashes = unused(documents, "__doc", "__lost")
    lines = saved(line_hashes(documents), "lines")
    stats = saved(lines.groupBy("hash", "fingerprint").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")), "line-stats")
    shards = 1 << max(0, math.ceil(math.log2(max(1, stats.count() / SHARD_LINES))))
    often = max(lines.count() // HOT_LINES, 1000)
    hot = {(r["hash"], r["fingerprint"]): r["first"] for r in stats.where(F.col("n") > often).collect()}  # at most HOT_LINES
    hot_lines = documents.sparkSession.sparkContext.broadcast(hot)
    cold = lines.join(F.broadcast(stats.where(F.col("n") > often).select("hash", "fingerprint")),
                      ["hash", "fingerprint"], "left_anti")
    lost = (cold.withColumn("shard", _shard_of(shards)).groupBy("shard")
            .cogroup(line_index(stats, shards).groupBy("shard"))
            .applyInPandas(_probe_or_nothing, "doc_id long, hash long")
            .groupBy(F.col("doc_id").alias(owner)).agg(F.collect_list("hash").alias(hashes)))
    joined = documents.join(lost, documents["doc_id"] == lost[owner], "left").drop(owner)
    return with_columns(joined, "text", KEPT, _keeper(hot_lines, hashes), drop=(hashes,)).select(
        *[c for c in documents.columns if c.lower() not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


def _probe_or_nothing(probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    return _probe_shard(probes, index) if len(probes) else pd.DataFrame({"doc_id": pd.Series(dtype="int64"), "hash": pd.Series(dtype="int64")})


def _keeper(hot_lines, hashes: str):
    def make():
        hot = hot_lines.value

        def keep(batch: pa.RecordBatch) -> list[pa.Array]:
            texts, totals, drops = [], [], []
            for doc, text, lost in zip(batch.column("doc_id").to_pylist(), texts_of(batch), batch.column(hashes).to_pylist(), strict=True):
                lines, keys = line_keys(text)
                lost = set(lost or ())
                stay = [line for line, key in zip(lines, keys, strict=True)
                        if key is None or doc is None
                        or not ((who := _identity(key))[0] in lost or hot.get(who, doc) != doc)]
                texts.append(text if len(stay) == len(lines) else b"\n".join(stay).decode("utf-8", "surrogatepass"))
                totals.append(len(lines))
                drops.append(len(lines) - len(stay))
            return [pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(drops, pa.int64())]

        return keep

    return make


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and digests of the kept texts of all documents."""
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT doc_id, line, k, translate(regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE o.first <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k.k) FILTER (WHERE o.first IS NULL OR o.first = k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN often o USING (key) GROUP BY k.doc_id
"""
