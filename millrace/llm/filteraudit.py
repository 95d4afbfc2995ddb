"""Filter interaction audit: what each filter removes at each place of each order.

One scan turns every document into a mask with a bit for each filter it fails. Documents of a
part with the same mask are alike to every order, so a part becomes at most 32 mask cells
(counts of documents, good and toxic ones). A recursive CTE then extends filter prefixes with
the letters they lack: each level joins the cells of the part, carries the bits applied so
far, and emits that step's metrics. Its rows depend on the number of parts, not on documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.frames import saved, table

#: The filters, by the bit each has in a mask.
FILTERS = "ABCDE"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
_GAP = r"[\x20\x09-\x0D]+"


def _bit(fails: Column, letter: str) -> Column:
    return F.when(fails, F.lit(1 << FILTERS.index(letter))).otherwise(0)


def failures(documents: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest): the bits of filters A to D that each row's text fails."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                             F.coalesce("text", F.lit("")).alias("text"))
    split = texts.withColumn("words", F.array_remove(F.split("text", _GAP), ""))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    mask = (_bit(F.size("words") < LEAST_WORDS, "A")
            + _bit(100 * F.size(F.array_distinct("words")).cast("long") < DISTINCT_PERCENT * F.size("words").cast("long"), "B")
            + _bit(100 * capitals.cast("long") > CAPITAL_PERCENT * F.length("text").cast("long"), "C")
            + _bit(F.col("text").rlike(r"[#$%&*|]"), "D"))
    return split.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def mask_cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cells): for each part its cells (mask, n, good, toxic), at most one for each mask.

    A text fails E if a row with a smaller id has the same text. Copies are first counted by
    text, id, part and label, so a text with any number of copies reaches the comparison
    with the smallest id as a few rows for each part.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    rows = failures(documents).join(known, "doc_id", "left").withColumns(
        {"good": F.coalesce("good", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))})
    kind = ["digest", "mask", "part", "good", "toxic"]
    texts = (rows.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
             .groupBy(*kind).agg(F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
                                 F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null")))
    texts = texts.withColumn("least", F.min("first").over(Window.partitionBy("digest")))
    passing = F.col("n_null") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    halves = texts.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", passing.alias("n")),
        F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - passing).alias("n")))).alias("half"))
    cells = halves.where("half.n > 0").groupBy("part", F.col("half.mask").alias("mask")).agg(
        F.sum("half.n").alias("n"), F.sum(F.col("half.n") * F.col("good")).alias("good"), F.sum(F.col("half.n") * F.col("toxic")).alias("toxic"))
    return cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def _sum(value: str, condition: str) -> str:
    return f"aggregate(filter(p.cells, c -> {condition}), 0L, (total, c) -> total + c.{value})"


def _steps_sql() -> str:
    letters = ", ".join(f"struct('{x}' AS letter, {1 << k} AS bit)" for k, x in enumerate(FILTERS))
    here, before = "(c.mask & l.bit) <> 0", "(c.mask & t.applied)"
    metrics = {"kept": _sum("n", f"{before} = 0 AND (c.mask & l.bit) = 0"), "removed": _sum("n", f"{before} = 0 AND {here}"),
               "redundant": _sum("n", f"{before} <> 0 AND {here}"), "unique_fails": _sum("n", "c.mask = l.bit"),
               "good_lost": _sum("good", f"{before} = 0 AND {here}"), "toxic_lost": _sum("toxic", f"{before} = 0 AND {here}")}
    shape = "array<struct<step: int, letter: string, " + ", ".join(f"{m}: bigint" for m in metrics) + ">>"
    return f"""
    WITH RECURSIVE t(part, filter_order, applied, steps) AS (
      SELECT part, '', 0, CAST(array() AS {shape}) FROM {{cells}}
      UNION ALL
      SELECT t.part, concat(t.filter_order, l.letter), t.applied | l.bit,
             concat(t.steps, array(struct(size(t.steps) + 1 AS step, l.letter AS letter, {", ".join(f"{sql} AS {m}" for m, sql in metrics.items())})))
      FROM t JOIN {{cells}} p ON t.part = p.part
      LATERAL VIEW explode(filter(array({letters}), x -> (x.bit & t.applied) = 0)) letters AS l
      WHERE t.applied < {(1 << len(FILTERS)) - 1})
    SELECT part, filter_order, s.* FROM (SELECT * FROM t LIMIT ALL) LATERAL VIEW explode(steps) e AS s
    WHERE length(filter_order) = {len(FILTERS)}"""


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, with the counts of that step.

    Needs ``doc_id``, ``source`` and ``text`` of ``documents`` and ``doc_id``, ``quality``,
    ``toxic`` of ``labels``; other columns are not looked at. A null text is empty, a null
    source the part ''. A row with a null id is no copy of any other and has no labels. Rows
    that repeat an id are counted each; two rows of one id and text do not make each other
    copies. Several labels of one document count as one that has the mark if any has it. A
    text of any length is one row of the scan and leaves a mask and a digest. An empty table
    has no parts and gives no rows.
    """
    spark = documents.sparkSession
    cells = saved(mask_cells(documents, labels), "mask-cells")
    steps = spark.sql(_steps_sql(), cells=cells)
    # Each letter stands once in each order: these are the 120 rows of a part and letter.
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents by source."""
    audit = audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


OP11_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals FROM base),
copies AS (SELECT text, min(doc_id) AS first FROM base GROUP BY text),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels GROUP BY doc_id),
masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * capitals > 5 * length(words.text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(words.text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN words.doc_id > first THEN 16 ELSE 0 END AS mask
  FROM words LEFT JOIN copies USING (text) LEFT JOIN known ON known.doc_id = words.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
places AS (
  SELECT filter_order, step, bit, (SELECT coalesce(sum(bit), 0) FROM letters x WHERE contains(left(filter_order, step - 1), x.letter)) AS applied
  FROM orders, (SELECT unnest(range(1, 6)) AS step) s, letters WHERE letter = substr(filter_order, step, 1)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask),
steps AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (WHERE mask & (applied::INT | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE mask & applied::INT = 0 AND mask & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE mask & applied::INT <> 0 AND mask & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE mask & applied::INT = 0 AND mask & bit <> 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE mask & applied::INT = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM cells, places GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM steps
"""
