"""Near-duplicate groups by circulant MinHash, banding and exact verification.

Two permutations make a whole signature: the first (a mixing hash) gives each shingle a slot,
the second is a fixed table of slot values. Coordinate k of a shingle is the table's value k
slots further on, the table closing to a ring, so that one stretch of the table holds all
coordinates of a shingle and a signature is the minimum of such stretches.

Texts with equal shingle sets form a class, and only classes are compared. Bands of the
signature put classes into buckets. Pairs are not listed within a bucket: its members are
first verified against the smallest member, best candidate first; only members that are then
still in different components meet each other, behind bounds on set sizes and on a 2-bit
sketch of the signature, and only their links leave that join. Every link is confirmed on
the full sets of shingles.

With 50 bands of five rows a pair at a similarity of 0.75 shares no band with a chance of
1.3e-6. The sketch bound is six standard deviations below its mean at that similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import components
from millrace.llm.frames import saved, slices, table, texts_of
from millrace.llm.words import mix, shingles_of, words_of

SHINGLE = 5
#: Two texts are linked if 100 * shared >= SIMILAR * united.
SIMILAR = 75
BANDS, ROWS = 50, 5
COORDINATES = 256
SLOTS = 1 << 20
#: Most sketch coordinates in which a similar pair differs: 256 * (1 - 0.8125) + 6 * 6.2.
SKETCH_APART = 85
#: Candidate ids broadcast to the scan that builds their sets; more of them are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_RING = np.random.default_rng(20240229).permutation(SLOTS).astype(np.uint32)
_STRETCHES = np.lib.stride_tricks.sliding_window_view(np.concatenate([_RING, _RING[:COORDINATES - 1]]), COORDINATES)
_BAND_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    words = words_of(texts)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        out.append(np.unique(shingles_of(words.hashes[a:b], min(SHINGLE, b - a))) if b > a else np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a set that is not empty."""
    slots = (mix(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(44)).astype(np.int64)
    low = np.full(COORDINATES, SLOTS, np.uint32)
    for start in range(0, len(slots), 1024):
        np.minimum(low, _STRETCHES[slots[start:start + 1024]].min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    keys = _BAND_SEEDS.copy()
    for i in range(ROWS):
        keys = mix(keys ^ rows[:, i])
    return keys.view(np.int64)


def sketch(low: np.ndarray) -> np.ndarray:
    """Two bits of each coordinate: four words of first bits, then four of second bits."""
    bits = mix(low.astype(np.uint64))
    return np.concatenate([np.packbits((bits >> np.uint64(k) & np.uint64(1)).astype(bool)).view(np.int64) for k in (7, 19)])


SIGNED = "doc_id long, n_shingles long, set_id binary, bands array<long>, sketch array<long>"


def signed(documents: DataFrame) -> DataFrame:
    """Size, digest, band keys and sketch of each document's set; null for the empty set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, ids, bands, sketches = [], [], [], []
                for shingles in shingle_sets(texts_of(part)):
                    sizes.append(len(shingles))
                    if len(shingles):
                        low = signature(shingles)
                        ids.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                        bands.append(band_keys(low))
                        sketches.append(sketch(low))
                    else:
                        for values in (ids, bands, sketches):
                            values.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_id", "bands", "sketch"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, SIGNED)


def sets_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) for the documents among ``nodes``; the set as distinct hashes."""
    few = nodes.count() <= BROADCAST_IDS
    chosen = documents.select(F.col("doc_id").cast("long").alias("node"), "text").join(
        F.broadcast(nodes) if few else nodes, "node", "left_semi")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array([s.view(np.int64) for s in shingle_sets(texts_of(part))], pa.list_(pa.int64()))],
                    ["node", "shingles"])

    return chosen.mapInArrow(pack, "node long, shingles array<long>").distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("left"), batch.column("right"), strict=True)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= SIMILAR * (len(x) + len(y) - shared):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").mapInArrow(compare, "a long, b long").distinct()


def _alike(sides: tuple[str, str]):
    """Whether set sizes and sketches allow the similarity."""
    a, b = sides
    apart = sum(F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])
                            .bitwiseOR(F.col(f"{a}.sketch")[i + 4].bitwiseXOR(F.col(f"{b}.sketch")[i + 4]))) for i in range(4))
    low, high = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (100 * low >= SIMILAR * high) & (apart <= SKETCH_APART)


def _similar(sides: tuple[str, str]):
    """Whether the full sets are similar."""
    a, b = sides
    shared = F.size(F.array_intersect(F.col(f"{a}.shingles"), F.col(f"{b}.shingles")))
    return 100 * shared >= SIMILAR * (F.col(f"{a}.n") + F.col(f"{b}.n") - shared)


def rooted(best: DataFrame) -> DataFrame:
    """(node, component) from links (a, b) that give each b one smaller a: the root of each tree."""
    parents = saved(best.select(F.col("b").alias("node"), F.col("a").alias("parent")), "parents")
    while True:
        up = parents.select(F.col("node").alias("above"), F.col("parent").alias("higher"))
        parents = saved(parents.join(up, F.col("parent") == F.col("above"), "left")
                        .select("node", F.coalesce("higher", "parent").alias("parent"), (F.col("higher").isNotNull()).alias("moved")), "parents")
        if parents.where("moved").isEmpty():
            break
        parents = parents.drop("moved")
    return parents.select("node", F.col("parent").alias("component"))


def merged(places: DataFrame, pairs: DataFrame) -> DataFrame:
    """``places`` (node, component) with the components of linked nodes (a, b) made one."""
    pairs = saved(pairs, "merging")
    if pairs.isEmpty():
        return places
    first, second = (places.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component")) for end in ("a", "b"))
    ends = pairs.join(first, "a").join(second, "b").select(F.col("a_component").alias("a"), F.col("b_component").alias("b"))
    # Only components are contracted here, not their members.
    new = components(ends).select(F.col("node").alias("component"), F.col("component").alias("merged"))
    return saved(places.join(new, "component", "left").select("node", F.coalesce("merged", "component").alias("component")), "places")


def class_components(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """(node, component) of the classes (node, n, bands, sketch) that share a bucket with another."""
    buckets = classes.select("node", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("key", "hub")
    live = saved(buckets.join(shared, "key"), "buckets")
    nodes = saved(live.select("node").distinct(), "nodes")
    sets = saved(sets_of(documents, nodes), "sets")
    light = saved(classes.select("node", "n", "sketch").join(nodes, "node"), "sketches")
    stars = saved(live.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("bands")), "stars")

    # First the hub with which a node shares most bands, then the other hubs, then the rest.
    best = stars.groupBy("node").agg(F.max_by("hub", F.struct("bands", -F.col("hub"))).alias("hub"))
    roots = rooted(verified(best.select(F.col("hub").alias("a"), F.col("node").alias("b")), sets))
    places = saved(nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "places")

    here = places.join(light, "node")
    hubs, members = here.alias("x"), here.alias("y")
    more = stars.join(best, ["node", "hub"], "left_anti").alias("s")
    more = (more.join(members, F.col("s.node") == F.col("y.node")).join(hubs, F.col("s.hub") == F.col("x.node"))
            .where(F.col("x.component") != F.col("y.component")).where(_alike(("x", "y")))
            .select(F.col("s.hub").alias("a"), F.col("s.node").alias("b")))
    places = merged(places, verified(more, sets))

    in_place = live.join(places, "node")
    open_ = in_place.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    rest = saved(in_place.join(open_, "key").where("node <> hub").join(light, "node"), "open-buckets")
    # The full sets are compared inside the join, so that it gives links only, not the pairs of a bucket.
    whole = rest.drop("n").join(sets, "node").withColumn("n", F.size("shingles"))
    x, y = whole.alias("x"), whole.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & _alike(("x", "y"))
                   & _similar(("x", "y")))
    return merged(places, pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``documents``.

    Needs ``doc_id`` and ``text``. A null text, or one without words, has the empty set and
    no links. A row with a null id has no links; its component is null and it is kept. Rows
    that repeat an id are one node: its links are those of all its texts, and all of them
    carry the same component. Equal texts are linked; an empty table gives no rows.
    """
    rows = saved(signed(documents), "signatures")
    held = rows.where("doc_id IS NOT NULL AND set_id IS NOT NULL")
    classes = saved(held.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
                                               F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    member = saved(held.select("doc_id", "set_id").join(classes.select("set_id", "node"), "set_id").select("doc_id", "node").distinct(), "members")
    ids = member.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    several = member.join(ids.where("node < last").select("doc_id", F.col("node").alias("a")), "doc_id").select("a", F.col("node").alias("b")).where("a < b")
    shared = class_components(classes, documents)
    places = saved(member.select("node").distinct().join(shared, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "places")
    place = ids.join(merged(places, several), "node").select("doc_id", F.col("component").alias("component_id"))
    return (rows.select("doc_id", "n_shingles").join(place, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
two_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT r.a, l.b FROM reach r JOIN two_way l ON r.b = l.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, low AS component_id, w.doc_id = low AS kept
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) c ON c.a = w.doc_id
"""
