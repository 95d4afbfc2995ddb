import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from millrace.llm import languagemodel as lm
from millrace.llm.languagemodel import op6_language_model, score_texts


def tokens(text):
    low = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", low), None]


def brute(rows):
    learned = Counter(t for _, text, held in rows if not held for t in tokens(text))
    n, v = sum(learned.values()), len(learned)
    out = []
    for doc, text, held in rows:
        own = tokens(text)
        base = sum(math.log10((learned[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((doc, bool(held), len(own), sum(learned[t] > 0 for t in own), n, round(base, 6)))
    return sorted(out, key=str)


def rows_of(pick):
    words = ["der", "DIE", "haus", "maison", "la", "le", "été", "ÉTÉ", "x", "!!"]
    rows = [(i, " ".join(pick.choices(words, k=pick.randrange(1, 30))), i % 5 == 1) for i in range(80)]
    return rows + [(100, None, False), (101, "", True), (102, " \t\n", None), (103, "neu " * 9000 + "wort", False), (None, "der haus", False),
                   (3, rows[3][1], False), (104, "unseen words only", True)]


def test_counts_and_base_equal_brute_force(spark, monkeypatch):
    rows = rows_of(random.Random(2))
    frame = spark.createDataFrame([(d, t, h, "x", 1) for d, t, h in rows], "doc_id long, text string, mine boolean, block string, score int")
    wanted = brute(rows)
    for size in (12 << 20, 3000):
        monkeypatch.setattr(lm, "PART_BYTES", size)
        got = score_texts(frame, F.col("mine")).collect()
        assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str) == wanted
        assert all(r["score"] < 0 for r in got)
    assert score_texts(frame.where("false"), F.col("mine")).count() == 0
    nothing = score_texts(frame, F.lit(True)).collect()
    assert len(nothing) == len(rows) and {(r["score"], r["base_score"], r["n_known"]) for r in nothing} == {(0.0, 0.0, 0)}


def test_probabilities_of_a_context_sum_to_one():
    block, pick = lm._Block(), random.Random(5)
    rows = rows_of(pick)
    block.add([d for d, *_ in rows], [bool(h) for *_, h in rows], [t or "" for _, t, _ in rows])
    made = pd.concat([b.to_pandas() for b in block.rows(1)])
    state = lm._merge(made[made["part"] == 0])
    first = np.array(state["sums"].iloc[0])
    words, n, *seen = first[512:]
    totals = {"words": words, "tokens": n, "d1": lm._discount(*seen[:2]), "d0": lm._discount(*seen[2:]), "customers": first[:256],
              "sums": np.array([[*first[256:512], first[256:512].sum(), words]])}
    part = lm._Part(state.iloc[0], totals)
    tables = part.sampled(3, [0, 0])
    state["tables"] = [lm._planes(tables.astype(np.uint32))]
    totals["sums"] = np.array(lm._sums_of(part, tables)).reshape(3, 258)
    every = np.append(part.words, np.uint64(12345))
    every.sort()
    for context in (255, int(part.contexts[0]), 254):
        asked = pd.DataFrame({"block": [b"b"], "part": [0], "words": [every.tobytes()], "firsts": [lm._planes(np.arange(len(every)))],
                              "contexts": [np.full(len(every), context, np.uint8).tobytes()]})
        answer = lm._answer(asked, state, totals)
        total = np.frombuffer(answer["probabilities"].iloc[0], np.float32).sum()
        assert abs(total - 1) < 1e-4


def test_seating_follows_the_posterior():
    discount, strength, n = 0.6, 0.7, 30_000
    pick, counts = np.random.default_rng(3), np.full(30_000, 3)
    tables, held = lm.seated(counts, np.full(n, strength), discount, pick)
    for _ in range(25):
        new, weight = lm.seated(counts, np.full(n, strength), discount, pick)
        take = np.log(pick.random(n)) < weight - held
        tables, held = np.where(take, new, tables), np.where(take, weight, held)
    exact = np.array([(1 - discount) * (2 - discount) * strength, 3 * (1 - discount) * strength**2, strength**3])
    assert np.allclose(np.bincount(tables.astype(int), minlength=4)[1:] / n, exact / exact.sum(), atol=0.015)


def test_many_customers_are_all_seated():
    tables, _ = lm.seated(np.array([1, 2, 10**7, 5000]), np.full(4, 0.3), 0.7, np.random.default_rng(1))
    assert tables[0] == 1 and 1 <= tables[1] <= 2 and 1 <= tables[3] < 60 and 1 <= tables[2] < 60


def test_better_than_the_base_on_held_out_texts(spark):
    rows = [r for r in op6_language_model(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    tokens_ = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / tokens_ > sum(r["base_score"] for r in rows) / tokens_ + 0.1


def test_previous_words_with_one_ending_are_contexts_apart(spark):
    learned = [(i, "xabc p" if i % 2 else "yabc q", False) for i in range(80)]
    asked = [(100, "xabc p", True), (101, "xabc q", True), (102, "yabc p", True), (103, "yabc q", True)]
    frame = spark.createDataFrame(learned + asked, "doc_id long, text string, held boolean")
    got = {r["doc_id"]: r["score"] for r in score_texts(frame, F.col("held")).collect()}
    assert got[100] - got[101] > 1 and got[103] - got[102] > 1


def test_packed_numbers_come_back():
    arrays = [np.array([], np.int64), np.array([0, 255], np.int64), np.array([1 << 40, 7], np.int64), np.array([(1 << 64) - 1, 0], np.uint64),
              np.array([0.5, np.nan, -1e300]), np.array([True, False])]
    got = lm._unpacked(lm._packed(*arrays))
    assert len(got) == len(arrays) and all(np.array_equal(a, b, equal_nan=a.dtype.kind == "f") for a, b in zip(arrays, got, strict=True))


def test_scores_are_exact_where_each_seating_is_certain(spark, monkeypatch):
    # Each learned word and pair occurs once, so each has one table in every seating.
    learned = " ".join(f"w{i}" for i in range(60))
    asked = ["w0 w1", "w1 w0", "new w4", "w5", "", "w59 new new", learned]
    pairs = lambda text: list(zip(["<", *text.split()], [*text.split(), ">"], strict=True))
    known, d = set(pairs(learned)), 0.95
    words, prevs = {w for _, w in known}, {p for p, _ in known}

    def chance(prev, word):
        p1 = ((word in words) * (1 - d) + (1 + d * 61) / 62) / (1 + 61)
        return (((prev, word) in known) * (1 - d) + (1 + d) * p1) / 2 if prev in prevs else p1

    monkeypatch.setattr(lm, "PART_BYTES", 50)
    rows = [(0, learned, False)] + [(1 + i, t, True) for i, t in enumerate(asked)]
    got = {r["doc_id"]: r["score"] for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string, held boolean"), F.col("held")).collect()}
    for i, text in enumerate(asked):
        assert math.isclose(got[1 + i], sum(math.log10(chance(p, w)) for p, w in pairs(text)), rel_tol=1e-9)


def test_disk_per_token(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.session.shared_folder", lambda spark: str(tmp_path))
    pick = random.Random(7)
    words = ["".join(pick.choices("abcdefghijklm", k=6)) for _ in range(4000)]
    rows = [(i, " ".join(words[int(4000 * pick.random() ** 3)] for _ in range(100)), i % 5 == 1) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    tokens_ = sum(r["n_tokens"] for r in score_texts(frame, F.col("held")).collect())
    files = list(tmp_path.rglob("*.parquet"))
    # Tables that a later one replaces are gone; the texts as numbers and the answers to them stay.
    assert tokens_ == 600 * 101
    assert sum(f.stat().st_size for f in files) < 8 * tokens_, sum(f.stat().st_size for f in files) / tokens_
    assert {f.parent.name.rpartition("-")[0] for f in files} == {"lm-texts", "lm-pair-answers", "lm-word-answers"}
