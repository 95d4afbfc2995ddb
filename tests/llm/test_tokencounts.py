import re
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm.tokencounts import Rollup, counted, deleted, inserted, op8_token_counts, revised


def totals(rollup):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in rollup.totals().collect()}


def frame(spark, rows, new=False):
    return spark.createDataFrame(rows, "source string, lang string, tokenizer string, n_tokens long" + ", new_tokens long" * new)


def test_batches_are_signed_and_idempotent(spark, tmp_path):
    rollup = Rollup(spark, f"{tmp_path}/totals")
    assert totals(rollup) == {}
    first = inserted(frame(spark, [("a", "en", "v1", 10), ("a", "en", "v1", 5), (None, "en", "v1", 7), ("b", None, "v2", None), ("b", None, "v2", 1)]))
    rollup.commit("0", first)
    assert totals(rollup) == {("a", "en", "v1"): (2, 15), (None, "en", "v1"): (1, 7), ("b", None, "v2"): (2, 1)}
    rollup.commit("1", revised(frame(spark, [("a", "en", "v1", 10, 4), (None, "en", "v1", 7, 9)], True)))
    rollup.commit("2", deleted(frame(spark, [("a", "en", "v1", 5), (None, "en", "v1", 9)])))
    want = {("a", "en", "v1"): (1, 4), ("b", None, "v2"): (2, 1)}
    assert totals(rollup) == want
    rollup.commit("0", first)
    rollup.commit("2", deleted(frame(spark, [("a", "en", "v1", 5), (None, "en", "v1", 9)])))
    assert totals(rollup) == want
    rollup.commit("3", inserted(frame(spark, [])))
    assert totals(rollup) == want == totals(rollup.compact(f"{tmp_path}/compact"))


TEXTS = [None, "", " ", "Hello, world!", "naïve ☃\n\n", "<|endoftext|>", "z" * 30_000, "a  b   c" * 500]


def test_counts_equal_the_other_library(spark):
    rows = [(i, t, 3) for i, t in enumerate(TEXTS)] + [(None, "x y", 1), (3, TEXTS[3], 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    args = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = counted(documents, *args).collect()
    assert len(got) == len(rows)
    assert all(r["n_tokens"] == len(other.encode(r["text"] or "", add_special_tokens=False).ids) for r in got)
    assert counted(documents.where("false"), *args).count() == 0


def test_query_equals_a_recount(spark):
    folder = "/root/testdata/sf0.001"
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 1").collect()}
    documents, tokens = Counter(), Counter()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        if r["doc_id"] not in toxic:
            key = (r["source"], r["lang"], "byte_bpe_50k/1")
            documents[key] += 1
            tokens[key] += len(other.encode(re.sub(" {2,}", " ", r["text"]), add_special_tokens=False).ids)
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in op8_token_counts(spark, folder).collect()}
    assert got == {k: (n, tokens[k]) for k, n in documents.items()}


def test_repeated_and_null_ids_are_revised_row_by_row(spark, tmp_path):
    rows = [(1, "a  b", "s"), (1, "c   d   e", "s"), (1, "f", "s"), (None, "g  h", "s"), (2, "x  y", "t"), (2, "z", "t"), (3, None, "t")]
    spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, 1), (2, 1), (None, 1), (1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    size = sum(len(other.encode(re.sub(" {2,}", " ", t), add_special_tokens=False).ids) for i, t, _ in rows if t and i != 2)
    got = {(r["source"], r["documents"], r["tokens"]) for r in op8_token_counts(spark, str(tmp_path)).collect()}
    assert got == {("s", 4, size), ("t", 1, 0)}
