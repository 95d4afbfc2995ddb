import public_tokenizers
import pytest
import sentencepiece

from millrace.llm.subwords import encode_documents

TEXTS = [None, "", " ", "  a", "Hello, world!  The end.\n\n New\tline \r", "▁mark", "naïve ☃ 𝔘", "<s> <0x0A> </s>",
         "日本語のテキスト", "nul \x00 char", "a" * 5000, "word " * 3000, "same", "same", "Größe çà éééé"]


def test_ids_and_texts_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, "null id", None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = encode_documents(frame, path).collect()
    assert len(got) == len(rows)
    for row in got:
        ids = library.encode(row["text"] or "")
        assert row["ids"] == ids
        assert row["decoded"] == library.decode(ids)


def test_the_registered_query_equals_the_library(spark):
    import hashlib

    from millrace.llm.subwords import op7_subwords
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op7_subwords(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "")
        want = (len(ids), ",".join(map(str, ids)), library.decode(ids))
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (want[0], *(hashlib.sha256(t.encode()).hexdigest() for t in want[1:]))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert encode_documents(frame, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_decode_of_any_ids(spark):
    import random

    import numpy as np

    from millrace.llm.subwords import Codec
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as file:
        codec = Codec(file.read())
    pick = random.Random(7)
    for _ in range(2000):
        ids = [pick.choice((pick.randrange(32000), pick.randrange(300))) for _ in range(pick.randrange(9))]
        assert codec.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_model_without_the_file_fails(spark):
    with pytest.raises(OSError):
        encode_documents(spark.createDataFrame([], "doc_id long, text string"), "/nowhere/model")
