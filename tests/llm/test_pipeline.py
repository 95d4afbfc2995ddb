"""Every stage of the pipeline on all that its predecessor kept, against brute force."""

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from millrace.llm.frames import saved
from millrace.llm.qualitynet import fit
from millrace.llm.langid import remainder
from test_decontamination import brute as contaminated
from test_linededup import brute as without_repeated_lines
from test_neardup import brute as components
from test_qualitynet import plain_score

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "lines", "near_duplicates", "decontamination", "subwords"]

    def ran(name, docs):
        out = saved(stages[name](spark, docs, FOLDER), name)
        if name != "subwords":
            assert out.columns == columns
        return out, {r["doc_id"]: r for r in out.collect()}

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where(remainder("doc_id", 4) != 2)
    net = fit(docs, labels)
    before = docs.collect()
    docs, rows = ran("quality", docs)
    assert set(rows) == {r["doc_id"] for r in before if plain_score(net, r["text"]) >= 0.7}
    assert 0 < len(rows) < len(before)

    before = list(rows.values())
    docs, rows = ran("lines", docs)
    assert {(d, t) for d, t, *_ in without_repeated_lines([(r["doc_id"], r["text"]) for r in before])} == {(r["doc_id"], r["text"]) for r in rows.values()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())

    before = list(rows.values())
    docs, rows = ran("near_duplicates", docs)
    assert set(rows) == {d for d, _, _, kept in components([(r["doc_id"], r["text"]) for r in before]) if kept}

    before = list(rows.values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    docs, rows = ran("decontamination", docs)
    assert set(rows) == {r["doc_id"] for r in before if not contaminated(r["text"], items)[1]}

    before = {r["doc_id"]: r["text"] for r in rows.values()}
    _, rows = ran("subwords", docs)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {d: r["ids"] for d, r in rows.items()} == {d: library.encode(t) for d, t in before.items()}
    assert all(r["decoded"] == library.decode(r["ids"]) for r in rows.values())


def test_run_is_all_stages(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(len(r["ids"]) == r["n_tokens"] for r in rows)


@pytest.mark.parametrize("rows", [0, 1])
def test_stages_take_odd_tables(spark, rows):
    text = "a line of some length here\n" + " ".join(f"word{i}" for i in range(80))
    docs = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "x" * 300_000), (None, None), (5, text + " more")] if rows else []
    frame = spark.createDataFrame([(d, t, None, None, len(t or ""), "x", 1) for d, t in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long, hash string, __lost int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, FOLDER)
        if name != "subwords":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        got = sorted(((r["doc_id"], r["n_chars"]) for r in out.collect()), key=str)
        if not rows:
            assert got == []
        elif name == "near_duplicates":
            assert [d for d, _ in got] == [1, 1, 2, 3, 4, None, None]
        elif name == "lines":
            assert (5, len(text) + 5 - 27) in got and (2, 0) in got and len(got) == len(docs)
        elif name in ("decontamination", "subwords"):
            assert len(got) == len(docs)
