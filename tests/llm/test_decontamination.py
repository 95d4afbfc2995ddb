import random
import re

import pytest

from millrace.llm.decontamination import mark_contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, passage in items:
        w = words(passage)
        for k in range(max(len(w) - 9, min(1, len(w)))):
            win = w[k:k + 10]
            for s in range(len(own) - len(win) + 1):
                if own[s:s + len(win)] == win:
                    hit.update(range(s, s + len(win)))
                    if item is not None:
                        found.add(str(item))
    return len(own), sorted(hit), sorted(found)


@pytest.mark.parametrize("block", [100_000, 7])
def test_equals_brute_force(spark, block):
    pick = random.Random(3)
    vocabulary = ["alpha", "béta", "Gamma", "d4", "the", "of", "ÉTÉ"]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.choice([1, 2, 3, 9, 10, 14])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "--- !!"), (None, items[5][1]), (3, "again the of alpha"), (60, items[4][1])]
    texts = [None, "", "...", "x" * 20_000, "the"]
    for _ in range(40):
        text = " ".join(pick.choices(vocabulary + ["other", "words"], k=pick.randrange(60)))
        if pick.random() < 0.6:
            text += ", " + items[pick.randrange(12)][1].upper().replace("É", "é") + "; more"
        texts.append(text)
    rows = [(i, t, 5, "clash") for i, t in enumerate(texts)] + [(7, texts[7], 5, None), (None, texts[9], None, "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_words int, items string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = mark_contamination(documents, benchmark, block_windows=block).collect()
    assert len(got) == len(rows)
    for row in got:
        assert (row["n_words"], row["hit_words"], row["items"]) == brute(row["text"], items)


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = documents.where("false")
    benchmark = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert mark_contamination(none, benchmark).count() == 0
    assert [r["hit_words"] for r in mark_contamination(documents, benchmark.where("false")).collect()] == [[], []]
