"""Benchmark decontamination by a prefix-filtered set join.

An item's windows (``WINDOW`` consecutive words; a shorter item is one window) are sets of
word shingles. A text can hold a window only if it holds all of its shingles, so one of them
is a sufficient prefix: the rarest in the corpus. Documents join that prefix shingle; the
length bound (words left in the text) and the positional bound (where the shingle stands in
the window) leave one place for the window, which is then compared word for word.

The benchmark is cut into blocks of a bounded number of windows. Only one block at a time is
broadcast, and every document meets every block, so no part of the benchmark is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import saved, slices, table, texts_of, with_columns
from millrace.llm.words import NOT_ALNUM, Words, shingles_of, words_of

WINDOW = 10
#: Words of a shingle; a window with fewer words uses shingles of all its words.
SHINGLE = 3
#: Windows broadcast at once: at most about this number of word lists.
BLOCK_WINDOWS = 100_000

WINDOWS = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("words", T.ArrayType(T.BinaryType()))])


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """One row for each window of each item: the item's id as text, and its words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(texts_of(part), NOT_ALNUM)
                ids, lists = [], []
                for i, item in enumerate(part.column("item_id").to_pylist()):
                    first, last = words.first[i], words.first[i + 1]
                    own = [words.word(k) for k in range(first, last)]
                    for k in range(max(min(1, len(own)), len(own) - size + 1)):
                        ids.append(item)
                        lists.append(own[k:k + size])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(lists, pa.list_(pa.binary()))],
                                                 ["item_id", "words"])

    return benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(cut, WINDOWS)


class Probe:
    """Finds which of a bounded set of hashes occur: a table of bits, then binary search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.shift = np.uint64(64 - max(16, (64 * len(self.keys)).bit_length()))
        self.bits = np.zeros(1 << int(64 - self.shift), bool)
        self.bits[self.keys >> self.shift] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that hold a key, and the numbers of those keys."""
        at = np.flatnonzero(self.bits[hashes >> self.shift])
        key = np.searchsorted(self.keys, hashes[at])
        same = self.keys[np.minimum(key, len(self.keys) - 1)] == hashes[at] if len(self.keys) else np.zeros(len(at), bool)
        return at[same], key[same]


class Block:
    """The windows of one block, with the shingles of each by their place."""

    def __init__(self, rows: list[Row]):
        self.items: dict[tuple[bytes, ...], set[str]] = {}
        for row in rows:
            held = self.items.setdefault(tuple(map(bytes, row["words"])), set())
            if row["item_id"] is not None:
                held.add(row["item_id"])
        self.windows = list(self.items)
        self.sizes = {min(SHINGLE, len(w)) for w in self.windows}
        self.shingles = []
        for start in range(0, len(self.windows), 4096):
            part = self.windows[start:start + 4096]
            words = words_of([b" ".join(w).decode("utf-8", "surrogatepass") for w in part], NOT_ALNUM)
            self.shingles += [shingles_of(words.hashes[a:b], min(SHINGLE, b - a))
                              for a, b in zip(words.first, words.first[1:], strict=False)]

    def probes(self) -> dict[int, Probe]:
        """A probe over all shingles, for each shingle length."""
        return {k: Probe(np.concatenate([s for s, w in zip(self.shingles, self.windows, strict=True) if min(SHINGLE, len(w)) == k]))
                for k in self.sizes}


def shingle_counts(documents: DataFrame, block: Block) -> dict[int, int]:
    """How often each shingle of the block occurs in all documents."""
    held = documents.sparkSession.sparkContext.broadcast(block.probes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = held.value
        sums = {k: np.zeros(len(p.keys), np.int64) for k, p in probes.items()}
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(texts_of(part), NOT_ALNUM)
                for k, probe in probes.items():
                    at, key = probe.find(shingles_of(words.hashes, k))
                    inside = np.searchsorted(words.first, at, "right") == np.searchsorted(words.first, at + k - 1, "right")
                    sums[k] += np.bincount(key[inside], minlength=len(probe.keys))
        for k, probe in probes.items():
            found = np.flatnonzero(sums[k])
            yield pa.RecordBatch.from_arrays([pa.array(probe.keys[found].view(np.int64)), pa.array(sums[k][found])], ["shingle", "n"])

    rows = documents.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    held.unpersist()
    return {r["shingle"] & (1 << 64) - 1: r["n"] for r in rows}  # at most the block's shingles


class Index:
    """From a prefix shingle to the windows that have it, with its place in each."""

    def __init__(self, block: Block, counts: dict[int, int]):
        self.windows = [(w, sorted(block.items[w])) for w in block.windows]
        self.by_prefix: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for i, (window, shingles) in enumerate(zip(block.windows, block.shingles, strict=True)):
            order = [(counts.get(int(s), 0), int(s), place) for place, s in enumerate(shingles)]
            _, prefix, place = min(order)
            self.by_prefix.setdefault(min(SHINGLE, len(window)), {}).setdefault(prefix, []).append((i, place))
        self.probes = {k: Probe(np.array(list(v), np.uint64)) for k, v in self.by_prefix.items()}

    def matches(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """(text, first word, window) of every occurrence; words count over all texts."""
        for k, probe in self.probes.items():
            at, key = probe.find(shingles_of(words.hashes, k))
            text = np.searchsorted(words.first, at, "right") - 1
            for place, number, t in zip(at.tolist(), key.tolist(), text.tolist(), strict=True):
                for i, offset in self.by_prefix[k][int(probe.keys[number])]:
                    window = self.windows[i][0]
                    start = place - offset
                    if start < words.first[t] or start + len(window) > words.first[t + 1]:
                        continue
                    if all(words.word(start + j) == w for j, w in enumerate(window)):
                        yield t, start, i


MARKS = [T.StructField("n_words", T.LongType(), False),
         T.StructField("hit_words", T.ArrayType(T.IntegerType(), False), False),
         T.StructField("items", T.ArrayType(T.StringType(), False), False)]


def mark_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Adds ``n_words``, ``hit_words`` (places, from 0, of words inside any occurrence of a
    window) and ``items`` (ids, as text, of items with an occurring window, sorted).

    Needs ``text``, and ``item_id`` and ``text`` of the benchmark. A null or empty text has
    no words and no hits; an item without words has no window; windows of an item with a
    null id mark words but name no item. Repeated rows are marked alike, other columns stay,
    and columns with the three names are replaced. Empty tables give empty marks.
    """
    # The windows are few beside the documents; they are written once so that their blocks
    # can be read one at a time.
    windows = saved(windows_of(benchmark, window), "windows")
    blocks = max(1, math.ceil(windows.count() / block_windows))
    out = documents
    for number in range(blocks):
        chosen = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == number).collect()  # one block's bound
        block = Block(chosen)
        index = documents.sparkSession.sparkContext.broadcast(Index(block, shingle_counts(documents, block)))
        out = with_columns(out, "text", MARKS, _marker(index, number))
        if blocks > 1:
            out = saved(out, "marked")
            index.unpersist()
    return out


def _marker(held, number: int):
    def make():
        index = held.value

        def mark(batch: pa.RecordBatch) -> list[pa.Array]:
            words = words_of(texts_of(batch), NOT_ALNUM)
            hits: list[set[int]] = [set() for _ in range(batch.num_rows)]
            items: list[set[str]] = [set() for _ in range(batch.num_rows)]
            if number:
                hits = [set(h) for h in batch.column("hit_words").to_pylist()]
                items = [set(i) for i in batch.column("items").to_pylist()]
            for t, start, i in index.matches(words):
                window, ids = index.windows[i]
                first = int(words.first[t])
                hits[t].update(range(start - first, start - first + len(window)))
                items[t].update(ids)
            return [pa.array(np.diff(words.first)), pa.array([sorted(h) for h in hits], pa.list_(pa.int32())),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string()))]

        return mark

    return make


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of all documents against the whole benchmark."""
    marked = mark_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[k:k + 9], ' ') AS win, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM words, (SELECT DISTINCT size FROM windows))),
found AS (SELECT p.doc_id, p.k, p.size, i.item_id FROM places p JOIN windows i ON p.win = i.win AND p.size = i.size),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit
         FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
