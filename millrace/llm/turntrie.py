"""Prefix trie of conversations by a splitter skeleton.

Each conversation is a path: 16 bytes of hash for every turn. Paths are dealt to shards by
splitters, which are paths (with ids, so that equal paths can be cut too) of a few sampled
conversations. The prefixes of all splitters form the skeleton, a small trie that every task
gets: a node that more than one shard holds lies on a splitter's path. Each shard is sorted
and read once with a stack of open nodes. A node off the skeleton ends inside its shard and
is finished there; for a skeleton node every shard gives a partial aggregate, and these are
reduced by node.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import saved, table

#: Bytes of a turn in a path.
STEP = 16
#: A rebuilt conversation takes less than so many turns from the first of its family.
HEADS = 9
FAMILY = 5
#: Conversations sampled for each shard to choose the splitters.
SAMPLED = 8
#: Fewest conversations of a shard, about.
SHARD_ROWS = 64
#: Bytes of ids sent at once for a skeleton node.
ENDS_BYTES = 1 << 20

SCANNED = ("skeleton int, shard int, part int, conv_id long, depth long, parent_conv_id long, parent_skeleton int, "
           "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends binary")


def turn_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): the hashes and text bytes of each conversation's turns in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * STEP)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("size")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "conv_id", F.unhex(F.array_join("turns.key", "")).alias("path"), F.col("turns.size").alias("sizes"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Paths with the first h turns of the family's first conversation in place of the own first h."""
    own = paths.withColumns({"h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int"),
                             "family": F.col("conv_id") - F.col("conv_id") % FAMILY})
    heads = paths.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.substring("path", 1, STEP * HEADS).alias("head"), F.slice("sizes", 1, HEADS).alias("head_sizes"))
    both = own.join(heads, "family", "left")
    return both.select("conv_id", F.expr(f"concat(substring(coalesce(head, x''), 1, {STEP} * h), substring(path, {STEP} * h + 1))").alias("path"),
                       F.expr("concat(slice(coalesce(head_sizes, array()), 1, h), slice(sizes, h + 1, size(sizes)))").alias("sizes"))


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int, list[int]]]):
        self.cuts = [(path, conv) for path, conv, _ in splitters]
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth, self.size = [-1], [0], [0]
        for path, _, sizes in splitters:
            at = 0
            for d, size in enumerate(sizes):
                step = at, path[d * STEP:(d + 1) * STEP]
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(d + 1)
                    self.size.append(size)
                at = self.child[step]

    def facts(self) -> list[tuple[int, int | None, int, int, int]]:
        """(skeleton, parent, depth, children on the skeleton, text bytes of all its skeleton nodes)."""
        children, below = [0] * len(self.parent), self.size[:]
        for i in range(len(self.parent) - 1, 0, -1):  # children come after their parents
            children[self.parent[i]] += 1
            below[self.parent[i]] += below[i]
        return [(i, p if i else None, d, children[i], below[i]) for i, (p, d) in enumerate(zip(self.parent, self.depth, strict=True))]

    def tips(self) -> list[tuple[int, int]]:
        """(tip, node) for each node without skeleton children and each node above it, itself included."""
        inner, out = set(self.parent), []
        for tip in range(len(self.parent)):
            at = tip
            while tip not in inner and at >= 0:
                out.append((tip, at))
                at = self.parent[at]
        return out


class _Node:
    """An open node of a shard; ``mark`` is its skeleton id or -1."""

    __slots__ = ("children", "ends", "first", "held", "leaves", "mark", "n", "parts", "rows", "saved", "size")

    def __init__(self, mark: int, size: int):
        self.mark, self.size = mark, size
        self.n = self.children = self.leaves = self.saved = self.parts = self.held = 0
        self.first: int | None = None
        self.ends = [] if mark >= 0 else hashlib.sha256()
        self.rows: list[tuple] = []


class _Scan:
    """Reads a shard's conversations in order of path and id, and lists finished rows in ``out``."""

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard, self.out = skeleton, shard, []
        self.open, self.path = [_Node(0, 0)], b""

    def add(self, path: bytes, conv: int, sizes: list[int]) -> None:
        same, most = 0, min(len(path), len(self.path)) // STEP
        if path == self.path:
            same = most
        else:
            while same < most and path[same * STEP:(same + 1) * STEP] == self.path[same * STEP:(same + 1) * STEP]:
                same += 1
        while len(self.open) > same + 1:
            self.close()
        for d in range(same, len(path) // STEP):
            above = self.open[-1].mark
            mark = self.skeleton.child.get((above, path[d * STEP:(d + 1) * STEP]), -1) if above >= 0 else -1
            self.open.append(_Node(mark, sizes[d]))
        self.path, node = path, self.open[-1]
        node.first = conv if node.first is None else min(node.first, conv)
        node.n += 1
        decimal = str(conv).encode()
        if node.mark < 0:
            node.ends.update(b"," + decimal if node.n > 1 else decimal)  # before its subtree, so n counts ends
            return
        node.ends.append(decimal)
        node.held += len(decimal) + 1
        if node.held > ENDS_BYTES:
            self.send_ends(node)

    def send_ends(self, node: _Node) -> None:
        self.out.append((node.mark, self.shard, node.parts, None, None, None, None, 0, 0, 0, 0, None, b",".join(node.ends)))
        node.ends, node.held, node.parts = [], 0, node.parts + 1

    def close(self) -> None:
        node, depth = self.open.pop(), len(self.open)
        above = self.open[-1] if self.open else None
        if node.mark < 0:
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.size
            self.out += [(*row[:5], node.first, *row[6:]) for row in node.rows]
            row = (None, self.shard, None, node.first, depth, None, above.mark if above.mark >= 0 else None, node.n, node.children,
                   node.leaves, node.saved, node.ends.hexdigest(), None)
            (self.out if above.mark >= 0 else above.rows).append(row)
            above.children += 1
        else:
            if node.ends:
                self.send_ends(node)
            # The bytes of the node itself are taken off once, after the reduction.
            node.saved += node.n * node.size
            self.out.append((node.mark, self.shard, None, node.first, depth, None, None, node.n, node.children, node.leaves, node.saved, None, None))
        if above:
            above.n += node.n
            above.first = node.first if above.first is None else min(above.first, node.first)
            above.leaves += node.leaves
            above.saved += node.saved

    def end(self) -> None:
        while self.open:
            self.close()


def choose_skeleton(paths: DataFrame) -> tuple[Skeleton, int]:
    """The skeleton and the number of shards; only a sample of bounded size comes to the driver:
    about ``SAMPLED`` conversations for each shuffle partition."""
    n = paths.count()
    shards = max(1, min(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // SHARD_ROWS))
    every = max(1, n // (SAMPLED * shards))
    sample = sorted((bytes(r["path"]), r["conv_id"], r["sizes"]) for r in paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0).collect())
    return Skeleton([sample[len(sample) * k // shards] for k in range(1, shards) if len(sample) * k // shards > len(sample) * (k - 1) // shards]), shards


def scanned(paths: DataFrame, skeleton: Skeleton, shards: int) -> DataFrame:
    """The finished nodes of all shards, and the partial aggregates of skeleton nodes."""
    given = paths.sparkSession.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = given.value.cuts
        for batch in batches:
            shard = [bisect.bisect_right(cuts, row) for row in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])

    names = [f.strip().split(" ")[0] for f in SCANNED.split(",")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split(" ")[-1]] for f in SCANNED.split(",")]

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = None
        for batch in batches:
            for path, conv, sizes, shard in zip(*(batch.column(c).to_pylist() for c in ("path", "conv_id", "sizes", "shard")), strict=True):
                if scan is None or scan.shard != shard:
                    if scan:
                        scan.end()
                        yield sent(scan.out)
                    scan = _Scan(given.value, shard)
                scan.add(path, conv, sizes)
                if len(scan.out) >= 4096:
                    yield sent(scan.out)
                    scan.out = []
        if scan:
            scan.end()
            yield sent(scan.out)

    dealt = paths.mapInArrow(deal, T.StructType([*paths.schema.fields, T.StructField("shard", T.IntegerType())]))
    return dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(read, SCANNED)


def joined_ends(parts: DataFrame) -> DataFrame:
    """(skeleton, ends_sha256): the digest over the parts of each node's ids, read in order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([state.hexdigest()])], ["skeleton", "ends_sha256"])

        for batch in batches:
            for mark, ends in zip(batch.column("skeleton").to_pylist(), batch.column("ends"), strict=True):
                if mark != node:
                    if state:
                        yield row()
                    node, state = mark, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ends.as_buffer())
        if state:
            yield row()

    ordered = parts.select("skeleton", "shard", "part", "ends").repartition("skeleton").sortWithinPartitions("skeleton", "shard", "part")
    return ordered.select("skeleton", "ends").mapInArrow(digest, "skeleton int, ends_sha256 string")


def reduced(scan: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton nodes: partial aggregates of the shards summed, skeleton children and leaves added."""
    spark = scan.sparkSession
    facts = spark.createDataFrame(skeleton.facts(), "skeleton int, above int, depth long, inner long, below long")
    tips = spark.createDataFrame(skeleton.tips(), "tip int, skeleton int")
    partial = scan.where("skeleton IS NOT NULL")
    sums = partial.groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    nodes = facts.join(sums, "skeleton").withColumn("n_children", F.col("n_children") + F.col("inner"))
    leaves = (tips.join(nodes.where("n_children = 0").select(F.col("skeleton").alias("tip")), "tip")
              .groupBy("skeleton").agg(F.count("*").alias("ending")))
    ends = joined_ends(partial.where("ends IS NOT NULL"))
    above = nodes.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(leaves, "skeleton", "left").join(ends, "skeleton", "left").join(above, "above", "left").select(
        "skeleton", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + F.coalesce("ending", F.lit(0))).alias("n_leaves"),
        (F.col("saved_tokens") - F.col("below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def conversation_trie(paths: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``paths`` (conv_id, path, sizes), as ``rebuilt`` gives them.

    ``conv_id`` is the smallest member, ``depth`` the number of turns, ``parent_conv_id`` the
    parent's smallest member (null for the root); ``n_convs`` members, ``n_children`` child
    nodes, ``n_leaves`` childless nodes of the subtree, ``saved_tokens`` the subtree's sum of
    (members - 1) times the bytes of a node's last text, ``ends_sha256`` the digest of the ids
    that end there. A conversation without turns belongs to the root alone. A conversation is
    one row of 24 bytes a turn, whatever its texts are; any number of equal conversations is
    spread over shards. An empty table has no nodes.
    """
    paths = saved(paths, "paths")
    skeleton, shards = choose_skeleton(paths)
    scan = saved(scanned(paths, skeleton, shards), "trie")
    top = saved(reduced(scan, skeleton), "skeleton")
    # The skeleton has at most one node for each turn of each splitter, so its ids can be broadcast.
    parents = F.broadcast(top.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("on_skeleton")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = scan.where("skeleton IS NULL").join(parents, "parent_skeleton", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "on_skeleton"))
    return inner.select(*columns).unionAll(top.select(*columns))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations.

    Null roles and texts are empty; turns come in order of ``turn``, null first, and turns of
    one number in order of a hash of role and text, repeated rows included. Rows with a null
    conv_id are no conversation. Other columns are not looked at.
    """
    return conversation_trie(rebuilt(turn_paths(table(spark, sf_dir, "conversations"))))


OP13_SQL = r"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS family,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc),
keyed AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
    left(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS key
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS k FROM keyed),
built AS (
  SELECT i.conv_id, 0 AS own, t.k, t.key, t.size FROM ids i JOIN turns t ON t.conv_id = i.family AND t.k <= i.h
  UNION ALL SELECT i.conv_id, 1, t.k, t.key, t.size FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.k > i.h),
members AS (
  SELECT conv_id, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY own, k) AS prefix, size FROM built
  UNION ALL SELECT conv_id, '', 0 FROM ids),
lasts AS (SELECT conv_id, arg_max(prefix, length(prefix)) AS prefix FROM members GROUP BY conv_id),
ends AS (SELECT prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM lasts GROUP BY prefix),
nodes AS (
  SELECT prefix, length(prefix) // 32 AS depth, CASE WHEN prefix <> '' THEN left(prefix, length(prefix) - 32) END AS parent,
         min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved FROM members GROUP BY prefix),
children AS (SELECT parent AS prefix, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
lines AS (SELECT n.prefix AS node, n.saved, c.n_children IS NULL AS leaf, left(n.prefix, 32 * d) AS prefix
          FROM nodes n LEFT JOIN children c USING (prefix), unnest(range(0, n.depth + 1)) u(d)),
sums AS (SELECT prefix, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved) AS saved_tokens FROM lines GROUP BY prefix)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s USING (prefix) LEFT JOIN children c USING (prefix) LEFT JOIN ends e USING (prefix) LEFT JOIN nodes p ON p.prefix = n.parent
"""
