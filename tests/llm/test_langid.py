import random
import zlib

import numpy as np

from millrace.llm.langid import fit, gram_counts, identify, op2_language, weighted

SYLLABLES = {"xx": ["ka", "to", "mi", "ra"], "yy": ["schl", "ung", "ein", "ver"], "zz": ["щу", "ка", "при", "вет"]}


def text_of(pick, lang):
    return " ".join("".join(pick.choices(SYLLABLES[lang], k=pick.randrange(1, 4))) for _ in range(pick.randrange(5, 60)))


def labelled(spark, n=90):
    pick = random.Random(8)
    rows = [(i, text_of(pick, lang), lang) for i in range(n) for lang in [sorted(SYLLABLES)[i % 3]]]
    return spark.createDataFrame(rows + [(900, None, "xx"), (901, "ka to", None), (902, "", "yy"), (3, *rows[3][1:])], "doc_id long, text string, lang string")


def test_unseen_texts_and_odd_texts(spark):
    model = fit(labelled(spark))
    pick = random.Random(9)
    rows = [(i, text_of(pick, lang), lang) for i, lang in enumerate(sorted(SYLLABLES) * 8)]
    rows += [(100, None, "und"), (101, "", "und"), (102, " 12 -- !", "und"), (None, text_of(pick, "yy"), "yy"), (0, *rows[0][1:]), (103, "tomi " * 40_000, "xx")]
    frame = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = identify(frame, model).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row["lang_pred"] == row["lang"]
        assert 0 <= row["score"] <= 1
        # Plain nearest centroid of the whole text.
        if row["lang"] != "und":
            cosines = [float(c @ weighted(gram_counts(row["text"]), model.idf)) for c in model.centroids]
            assert model.langs[int(np.argmax(cosines))] == row["lang_pred"]
            assert abs(max(cosines) - row["score"]) < 1e-6
    assert not identify(spark.createDataFrame([("qqq www ppp jjj",)], "text string"), model).first()["accepted"]


def test_grams_of_all_characters_count():
    text = "ab, cd" * 500 + "zq"
    assert gram_counts(text).sum() == gram_counts(text[:-2]).sum() + 4


def test_nothing_learned_and_nothing_given(spark):
    frame = labelled(spark)
    model = fit(frame.where("false"))
    assert {(r["lang_pred"], r["score"]) for r in identify(frame, model).collect()} == {("und", 0.0)}
    assert identify(frame.where("false"), fit(frame)).count() == 0


def test_held_out_accuracy_on_the_given_table(spark):
    rows = op2_language(spark, "/root/testdata/sf0.001").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.93
