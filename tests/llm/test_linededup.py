import random

import numpy as np
import pandas as pd
import pytest

from millrace.llm import linededup
from millrace.llm.linededup import PerfectHash, drop_repeated_lines

SPACE = " \t\n\r\x0b\x0c"


def brute(rows):
    def key(line):
        k = "".join(c.lower() if c < "\x80" else c for c in line.strip(SPACE))
        return k if len(k) >= 10 else None
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and key(line):
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if doc is None or not key(x) or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc]
        out.append((doc, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [4096, 10**9])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(linededup, "SHARD_LINES", 8)
    pick = random.Random(5)
    lines = [f"Line number {i} é" for i in range(25)] + ["short", "ÉÉÉÉÉÉÉÉÉ", "ÉÉÉÉÉÉÉÉÉÉ", "  LINE number 3 é\t", "", "  "]
    rows = [(i, "\n".join(pick.choices(lines, k=pick.randrange(8)) + [f"own line of {i}"])) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n"), (73, "z" * 50_000), (74, "z" * 50_000), (5, rows[5][1]), (None, lines[2]), (6, "Line number 1 é")]
    rows += [(100 + i, "a very common line\nand more") for i in range(1500)]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, hash int, n_lines string")
    got = drop_repeated_lines(frame)
    assert got.columns == ["doc_id", "text", "hash", "n_lines", "n_dropped"]
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=str) == brute(rows)


def test_helper_names_may_be_taken(spark):
    frame = spark.createDataFrame([(1, "the very same line", 1, "a"), (2, "the very same line\nown line here", 2, "b")], "doc_id long, text string, __lost int, __doc string")
    got = {r["doc_id"]: tuple(r) for r in drop_repeated_lines(frame).collect()}
    assert got == {1: (1, "the very same line", 1, "a", 1, 0), 2: (2, "own line here", 2, "b", 2, 1)}


def test_empty_table(spark):
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_places_are_minimal_and_perfect():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 5000, np.uint64))
    perfect = PerfectHash.of(values)
    assert sorted(perfect.places(values).tolist()) == list(range(len(values)))


def test_lines_with_one_hash_are_told_apart():
    rows = pd.DataFrame({"shard": 0, "hash": [5, 5, 9], "fingerprint": [1, 2, 3], "first": [10, 20, 30], "last": [11, 20, 31], "n": [2, 1, 2]})
    probes = pd.DataFrame({"hash": [5, 5, 5, 9, 9, 9], "fingerprint": [1, 1, 2, 3, 3, 4], "doc_id": [10, 11, 20, 30, 31, 31]})
    lost = linededup._probe_shard(probes, linededup._build_shard(rows))
    assert list(zip(lost["doc_id"], lost["hash"], strict=True)) == [(11, 5), (31, 9)]
