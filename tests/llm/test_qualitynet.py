import zlib

import numpy as np

from millrace.llm.qualitynet import CHUNK, FILTERS, WIDTH, Net, fit, op4_quality, score_quality

TEXTS = ["", "a", "abc", "x" * CHUNK, "x" * (CHUNK + 1), "Größe " * 90, "one!! two!! " * 200, "z" * 5000 + "!!"]


def plain_score(net, text):
    """The same network by loops over one text."""
    data = text.encode()
    padded = data + bytes(WIDTH - 1 if data else WIDTH)
    places = max(1, len(data))
    answer = np.array([sum(net.vectors[padded[i + w]] @ net.filters[w] for w in range(WIDTH)) for i in range(places)])
    chunks = np.tanh(np.array([answer[i:i + CHUNK].max(axis=0) for i in range(0, places, CHUNK)]) + net.bias)
    features = np.concatenate([chunks.mean(axis=0), (chunks**2).mean(axis=0)])
    return 1 / (1 + np.exp(-(features @ net.out + net.offset[0])))


def test_scores_equal_plain_loops_in_any_company():
    net = Net.started()
    alone = [net.scores([t])[0] for t in TEXTS]
    assert np.allclose(net.scores(TEXTS), alone, atol=1e-6)
    assert np.allclose(alone, [plain_score(net, t) for t in TEXTS], atol=1e-5)


def test_gradients_equal_differences():
    net, texts, labels = Net.started(3), TEXTS[2:7], np.array([1, 0, 1, 0, 1.0])

    def loss():
        s = net.scores(texts)
        return -np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s))
    pick = np.random.default_rng(1)
    for part, grad in zip(net.parts()[1:], net.gradients(texts, labels)[1:], strict=True):
        for _ in range(4):
            at = tuple(pick.integers(0, n) for n in part.shape)
            part[at] += 1e-3
            up = loss()
            part[at] -= 2e-3
            down = loss()
            part[at] += 1e-3
            assert abs((up - down) / 2e-3 - grad[at]) < 2e-3


def test_odd_rows(spark):
    frame = spark.createDataFrame([(i, t, "x", 2.0) for i, t in enumerate([None, *TEXTS])] + [(None, "abc", None, None), (2, "a", "y", 1.0)],
                                  "doc_id long, text string, lang string, score double")
    net = Net.started()
    got = score_quality(frame, net).collect()
    assert len(got) == frame.count()
    for r in got:
        assert abs(r["score"] - plain_score(net, r["text"] or "")) < 1e-5
        assert r["predicted"] == int(r["score"] >= 0.7)
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert fit(frame, labels) is None
    assert {r["score"] for r in score_quality(frame, None).collect()} == {1.0}
    assert score_quality(frame.where("false"), net).count() == 0
    assert len(net.out) == 2 * FILTERS


def test_held_out_accuracy_on_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op4_quality(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == q for p, q in held]) > 0.9
    assert np.mean([p for p, q in held if q]) > 0.9
