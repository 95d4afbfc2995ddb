from itertools import permutations

import pytest

from millrace.llm.filteraudit import audit_filters
from oracle import connect, difference
from millrace.llm.filteraudit import OP11_SQL, op11_filter_audit

GAPS = " \t\n\x0b\x0c\r"


def words(text):
    for gap in GAPS[1:]:
        text = text.replace(gap, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, labels):
    """Every order applied document by document."""
    fails = []
    for doc, source, text in rows:
        text = text or ""
        w = words(text)
        failed = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
                  "D": any(c in "#$%&*|" for c in text),
                  "E": doc is not None and any(o is not None and o < doc and (t or "") == text for o, _, t in rows)}
        good = any(d == doc and q == 1 for d, q, _ in labels if d is not None)
        toxic = any(d == doc and x == 1 for d, _, x in labels if d is not None)
        fails.append((source or "", {k for k, v in failed.items() if v}, good, toxic))
    out = {}
    for part in {f[0] for f in fails}:
        docs = [f[1:] for f in fails if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                out[part, order, step] = [len(left), len(gone), sum(letter in d[0] for d in docs) - len(gone), sum(d[0] == {letter} for d in docs),
                                          sum(d[1] for d in gone), sum(d[2] for d in gone)]
                shapley[letter] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_equals_every_order_applied(spark):
    long = " ".join(f"w{i}" for i in range(60))
    texts = [long, long + " x", "short", "", None, "  ", "HELLO there", "# " + long, "the the the " * 30, long.upper(), long, "é" * 300_000,
             "HELLO there", "a\x0bb\x0cc", "a b c $", "x" * 95 + "ABCDE", "x" * 94 + "ABCDEF"]
    rows = [(i, f"s{i % 3}" if i % 4 else None, t) for i, t in enumerate(texts)]
    rows += [(3, "s0", ""), (0, "s1", long), (None, "s1", long), (None, None, None), (50, "", long), (50, "s2", long), (50, "s2", long)]
    labels = [(0, 1, 0), (0, 0, 1), (2, 1, None), (5, None, 1), (None, 1, 1), (50, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, text string, mask int, cells string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit_filters(docs, marks).collect()
    want = brute(rows, labels)
    assert len(got) == len(want)
    assert {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"])
            for r in got} == want


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)]])
def test_empty_tables(spark, labels):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_more_parts_than_the_default_row_limit_of_a_recursion(spark):
    docs = spark.range(3200).selectExpr("id AS doc_id", "cast(id AS string) AS source", "'a' AS text")
    audit = audit_filters(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert audit.count() == 3200 * 600


def test_query_on_a_larger_table(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(connect(folder), op11_filter_audit(spark, folder), OP11_SQL) is None
