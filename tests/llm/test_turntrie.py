import hashlib
import random
import zlib

from millrace.llm import turntrie
from millrace.llm.turntrie import OP13_SQL, conversation_trie, op13_conversation_trie, rebuilt, turn_paths
from oracle import connect, difference

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    """The trie by dictionaries of whole paths; no conversation of ``rows`` has a turn number twice."""
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    members = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        family = conv - (abs(conv) % 5 if conv >= 0 else -(abs(conv) % 5))
        path = tuple(own.get(family, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((conv, d == len(path)))
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def below(path):
        yield path
        for child in children.get(path, []):
            yield from below(child)

    out = []
    for path, convs in members.items():
        tree = list(below(path))
        ends = ",".join(str(c) for c, last in sorted(convs) if last)
        out.append((min(convs)[0], len(path), min(members[path[:-1]])[0] if path else None, len(convs), len(children.get(path, [])),
                    sum(p not in children for p in tree), sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in tree if p),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def trie(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, path int, skeleton string")
    return conversation_trie(rebuilt(turn_paths(frame)))


def talks(seed, convs):
    pick = random.Random(seed)
    rows = []
    for conv in convs:
        order = pick.sample(range(-3, 40), pick.choice((1, 2, 3, 9, 12)))
        for k, turn in enumerate(sorted(order)):
            rows.append((conv, turn, pick.choice(("user", "bot", None)), pick.choice((f"hello {k}", "é" * (k + 1), None, ""))))
    pick.shuffle(rows)
    return rows


def test_equals_brute_force_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(turntrie, "SHARD_ROWS", 4)
    monkeypatch.setattr(turntrie, "ENDS_BYTES", 12)
    rows = talks(3, [c for c in range(-20, 130) if c % 7])
    rows += [(500 + i, t, "user", f"common {t}") for i in range(60) for t in range(12)]  # copies, a third of all
    rows += [(None, 1, "user", "nobody"), (1000, None, "user", "first"), (1000, 0, "bot", "second"), (1005, 7, None, "z" * 300_000)]
    # 1016 to 1024 have few turns, and conversation 1020 none: some are rebuilt without any turn.
    rows += [(c, 0, "user", "only") for c in range(1021, 1040) if c % 5]
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = rows_of(trie(spark, rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = brute(rows)
    assert got == want
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)


def test_one_shard(spark):
    rows = talks(4, range(40))
    assert rows_of(trie(spark, rows)) == brute(rows)


def test_repeated_rows_and_equal_turn_numbers(spark):
    rows = [(5, 1, "user", "a"), (5, 1, "user", "b"), (5, 1, "user", "a"), (5, None, None, None), (5, None, None, None)]
    got, again = trie(spark, rows).collect(), trie(spark, rows[::-1]).collect()
    assert sorted(got) == sorted(again)
    assert max(r["depth"] for r in got) == 5


def test_empty_table(spark):
    assert trie(spark, [(None, 1, "user", "x")]).count() == 0


def test_query_on_a_larger_table(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(connect(folder), op13_conversation_trie(spark, folder), OP13_SQL) is None
