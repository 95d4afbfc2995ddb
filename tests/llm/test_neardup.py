import random

import numpy as np

from millrace.llm.components import components
from millrace.llm.neardup import near_duplicates, signature


def shingles(text):
    w = "".join(c.lower() if c < "\x80" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(1, len(w))))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is not None and b is not None and sets[i] and sets[j]:
                m = len(sets[i] & sets[j])
                if 100 * m >= 75 * (len(sets[i]) + len(sets[j]) - m):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return sorted(((d, len(s), None if d is None else root(d), d is None or root(d) == d) for (d, _), s in zip(rows, sets)), key=str)


def test_equals_brute_force(spark):
    pick = random.Random(11)
    vocabulary = [f"w{i}é" for i in range(300)]
    rows, base = [], [pick.choices(vocabulary, k=pick.randrange(30, 140)) for _ in range(12)]
    passage = pick.choices(vocabulary, k=40)
    for i in range(160):
        words = list(base[pick.randrange(12)])
        for _ in range(pick.choice([0, 0, 1, 2, 3, 6])):
            words[pick.randrange(len(words))] = pick.choice(vocabulary)
        if pick.random() < 0.2:
            words = passage + pick.choices(vocabulary, k=30)
        rows.append((i, " ".join(words).upper() if i % 3 else "\n".join(words)))
    rows += [(200, None), (201, ""), (202, " \t\x0b"), (203, "one two"), (204, "One  two"), (205, "one two three"), (None, rows[0][1]),
             (3, rows[3][1]), (4, rows[90][1]), (206, "é " * 30_000), (207, "é " * 30_001), (201, "one two")]
    frame = spark.createDataFrame([(d, t, i, "x") for i, (d, t) in enumerate(rows)], "doc_id long, text string, node int, component_id string")
    got = near_duplicates(frame).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signature_estimates_the_similarity():
    pick = np.random.default_rng(2)
    for similar in (0.5, 0.75, 0.9):
        whole = pick.integers(0, 1 << 64, 2000, np.uint64)
        cut = int(1000 * (1 - similar) / (1 + similar) * 2)
        a, b = np.unique(whole[:2000 - cut]), np.unique(whole[cut:])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((signature(a) == signature(b)).mean() - true) < 0.12


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
