import math
import random
from collections import Counter

import regex
import xxhash

from pyspark.sql import functions as F

from millrace.llm import qualityrules
from millrace.llm.qualityrules import CELLS, apply_rules, base_counts, cell_weights

MASK = (1 << 64) - 1


def words(text):
    return regex.findall("[^\x20\x09-\x0d]+", text or "")


def brute_counts(text):
    text, w = text or "", words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def cells(text):
    t = regex.findall(r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N} \t\n\x0b\f\r]+", text or "")
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in t]
    out = h + [xxhash.xxh64_intdigest(y.encode(), x) for x, y in zip(h, t[1:])]
    return [(v - (v >> 63 << 64)) % CELLS for v in out]


TEXTS = [None, "", " \n\t", "a b c a b c a b c", "one\ntwo\n one\none\none \n\n", "É|É # 5% <x>", "x " * 3000, "y" * 50_000,
         "der die das " * 20 + "ende", "a b a b a", "q q q", "  nbsp wide"]


def frame_of(spark):
    pick = random.Random(4)
    texts = TEXTS + [" ".join(pick.choices(["le", "la", "###", "mot,", "THE!!", "(x)"], k=pick.randrange(90))) for _ in range(40)]
    rows = [(i, t, 3, "x") for i, t in enumerate(texts)] + [(None, texts[20], 1, "x"), (20, texts[20], None, None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, n_words int, cell string")


def test_base_counts_equal_brute_force(spark):
    rows, frame = frame_of(spark)
    got = base_counts(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_counts(r["text"])


def test_scores_equal_brute_force(spark):
    rows, frame = frame_of(spark)
    good = [3, 8, 21, 22, 23, 24, 25, 26]
    trusted = spark.createDataFrame([(i,) for i in good + good[:2] + [None, 999]], "doc_id long")
    raw, target = Counter(), Counter()
    for doc, text, *_ in rows:
        raw.update(cells(text))
        if doc in good:
            target.update(cells(text))
    a, b = sum(target.values()) + CELLS, sum(raw.values()) + CELLS
    for r in apply_rules(frame, trusted, threshold=-0.1).collect():
        c = cells(r["text"])
        score = sum(math.log((target[x] + 1) / a) - math.log((raw[x] + 1) / b) for x in c) / len(c) if c else 0.0
        n, *_, repeated = brute_counts(r["text"])
        assert abs(r["score"] - score) < 1e-9
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= -0.1)


def test_nothing_trusted_and_nothing_given(spark):
    _, frame = frame_of(spark)
    none = spark.createDataFrame([], "doc_id long")
    assert {r["score"] for r in apply_rules(frame, none).collect()} == {0.0}
    assert apply_rules(frame.where("false"), none).count() == 0


def test_every_trusted_text_counts(spark, monkeypatch):
    documents = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    # With all texts trusted the two multinomials are the same.
    assert cell_weights(documents, documents) == [0.0] * CELLS
    some = documents.where("doc_id % 3 = 0")
    near = cell_weights(documents, some)
    monkeypatch.setattr(qualityrules, "BROADCAST_IDS", 0)
    assert cell_weights(documents, some) == near


def test_helper_names_may_be_taken(spark):
    names = ["__words", "__lines", "__hashes", "__sorted", "__twice", "__windows", "__places", "__tokens", "__cells", "__id", "__trusted", "aside_0"]
    rows = [(i, f"some words {i} " * 30, *(f"{n} {i}" for n in names)) for i in range(3)]
    frame = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    trusted = spark.createDataFrame([(1,)], "doc_id long")
    plain = {r["doc_id"]: r for r in apply_rules(frame.select("doc_id", "text"), trusted).collect()}
    got = apply_rules(frame, trusted)
    assert got.columns[:2 + len(names)] == frame.columns
    for r in got.collect():
        assert [r[n] for n in names] == [f"{n} {r['doc_id']}" for n in names]
        assert all(r[c] == plain[r["doc_id"]][c] for c in ("n_words", "n_repeat_words", "score", "kept"))


def test_the_registered_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = qualityrules.op9_quality_rules(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = brute_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= qualityrules.THRESHOLD)
