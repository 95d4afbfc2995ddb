"""Quality rules from built-in functions only: base counts and a hashed n-gram ratio.

Two multinomials over hashed n-grams are compared: one of trusted texts, one of the whole
corpus. A text's score is the mean, over its n-grams, of the log of their ratio; the mean
makes long and short texts comparable. Every text is held against one fixed threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.frames import table, unused

#: Cells of the hashed multinomials; a fixed number, so that their table can be sent along.
CELLS = 1 << 14
#: Added to every cell of both multinomials.
SMOOTHING = 1.0
#: Trusted ids broadcast to the count of all texts; more of them are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Texts below this mean log ratio are rejected.
THRESHOLD = -0.4
FEWEST_WORDS = 50
#: Percentage of words in repeated three-word windows above which a text fails.
MOST_REPEATED = 50
#: Distinct repeated windows of a text up to which they are looked up in a list.
LISTED = 32

_SPACE = "[\\x20\\x09-\\x0D]+"
#: Tokens of the n-grams: runs of letters and digits, and runs of other signs.
_TOKEN = "[\\p{L}\\p{M}\\p{N}]+|[^\\p{L}\\p{M}\\p{N}\\s]+"


def _cells(tokens: str) -> Column:
    """The cells of the one- and two-token n-grams of a token array."""
    token = F.col(tokens)
    ones = F.transform(token, lambda t: F.pmod(F.xxhash64(t), F.lit(CELLS)).cast("int"))
    twos = F.transform(F.slice(token, F.lit(2), F.greatest(F.size(token) - 1, F.lit(0))),
                       lambda t, i: F.pmod(F.xxhash64(token[i], t), F.lit(CELLS)).cast("int"))
    return F.concat(ones, twos)


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0))


def cell_weights(documents: DataFrame, trusted: DataFrame) -> list[float]:
    """For each cell the log of its share in trusted texts over that in all texts.

    ``trusted`` holds the ids (doc_id) of trusted texts. Both sides count every text.
    """
    trusted = trusted.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("__id")).distinct()
    few = trusted.count() <= BROADCAST_IDS
    trusted = trusted.withColumn("__trusted", F.lit(1))
    flagged = documents.select("doc_id", "text").join(F.broadcast(trusted) if few else trusted, F.col("doc_id") == F.col("__id"), "left")
    cells = (flagged.select(_tokens(F.col("text")).alias("t"), F.coalesce("__trusted", F.lit(0)).alias("__trusted"))
             .select("__trusted", F.explode(_cells("t")).alias("cell")))
    counts = cells.groupBy("cell").agg(F.count("*").alias("n"), F.sum("__trusted").alias("m")).collect()  # CELLS rows at most
    raw, good = [SMOOTHING] * CELLS, [SMOOTHING] * CELLS
    for row in counts:
        raw[row["cell"]] += row["n"]
        good[row["cell"]] += row["m"]
    # Without a trusted text the target says nothing, and no cell speaks for or against a text.
    if sum(good) == SMOOTHING * CELLS:
        return [0.0] * CELLS
    shift = math.log(sum(raw)) - math.log(sum(good))
    return [math.log(g) - math.log(r) + shift for g, r in zip(good, raw, strict=True)]


def base_counts(documents: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long)."""
    odd = [c for c in documents.columns if c.startswith("__")]  # may be names of helpers below
    aside = unused(documents, *(f"aside_{i}" for i in range(len(odd))))
    documents = documents.withColumnsRenamed(dict(zip(odd, aside, strict=True)))
    text = F.coalesce("text", F.lit(""))
    held = documents.select(
        "*", F.filter(F.split(text, _SPACE), lambda w: w != "").alias("__words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("__lines"))
    word = F.col("__words")
    held = held.withColumn("__hashes", F.transform(F.slice(word, F.lit(3), F.greatest(F.size(word) - 2, F.lit(0))),
                                                   lambda w, i: F.xxhash64(word[i], word[i + 1], w)))
    held = held.withColumn("__sorted", F.sort_array("__hashes"))
    hashes, sorted_ = F.col("__hashes"), F.col("__sorted")
    held = held.withColumn("__twice", F.array_distinct(F.filter(sorted_, lambda h, i: (i > 0) & (F.get(sorted_, i - 1) == h))))
    twice = F.col("__twice")
    # A few repeated windows are looked up in their list; for many the windows are sorted with their places.
    several = F.size(twice) > LISTED
    held = held.withColumn("__windows", F.when(several, F.array_sort(F.transform(
        hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    window = F.col("__windows")
    listed = F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull())
    found = F.filter(window, lambda x, i: ((i > 0) & (F.get(window, i - 1)["h"] == x["h"])) | (F.get(window, i + 1)["h"] == x["h"]))
    held = held.withColumn("__places", F.when(F.size(twice) == 0, F.array().cast("array<int>")).when(
        several, F.sort_array(F.transform(found, lambda x: x["i"]))).otherwise(listed))
    # Each window start adds the words it does not share with the one before.
    covered = F.aggregate("__places", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                          lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                          lambda a: a["n"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    values = (F.size(word), F.length(F.translate(text, " \t\n\x0b\f\r", "")),
              F.length(text) - F.length(F.translate(text, "#*$%&|<>", "")),
              F.size("__lines") - F.size(F.array_distinct("__lines")), covered)
    kept = [c for c in documents.columns if c.lower() not in names]
    counted = held.select(*kept, *(v.cast("long").alias(n) for n, v in zip(names, values, strict=True)))
    return counted.withColumnsRenamed(dict(zip(aside, odd, strict=True)))


def apply_rules(documents: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds the base counts, base_failed, score (mean log ratio) and kept to every row.

    Needs ``doc_id`` and ``text``, and ``doc_id`` of the trusted texts. A null or empty text
    has no words, fails the base rules and scores 0. Null ids are never trusted; repeated
    rows are judged alike; other columns stay and those with a result's name are replaced.
    An empty corpus gives no rows; without trusted texts every score is 0.
    """
    weights = cell_weights(documents, trusted)
    weight = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one constant
    named = ("base_failed", "score", "kept")
    base = base_counts(documents.select(*[c for c in documents.columns if c.lower() not in named]))
    tokens, held = unused(base, "__tokens", "__cells")
    cells = base.withColumn(tokens, _tokens(F.col("text"))).withColumn(held, _cells(tokens))
    total = F.aggregate(held, F.lit(0.0), lambda a, c: a + weight[c])
    return (cells.withColumn("score", F.when(F.size(held) > 0, total / F.size(held)).otherwise(0.0))
            .withColumn("base_failed", (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).drop(tokens, held))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdicts of all documents; documents labelled good are trusted."""
    judged = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"),
                         table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
