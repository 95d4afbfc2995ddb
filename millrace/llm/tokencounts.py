"""Token totals by source, language and tokenizer version, kept up by signed deltas.

A change of a document is a signed row: an insert adds its document and tokens, a delete
takes them away, a revised count adds the difference. A batch of changes is summed by group
and written as one folder named by the batch, which replaces whatever that batch wrote
before: committing a batch again, after a lost executor or driver, changes nothing. Totals
are the sums over all batches, so they never recount a document.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import saved, table, texts_of, with_columns
from millrace.session import fresh_folder

KEYS = ("source", "lang", "tokenizer")
_SUMS = "source string, lang string, tokenizer string, documents long, tokens long"


def _counter(ranks_path: str, pattern: str):
    """Makes, once a task, the function that counts a text's tokens."""
    with open(ranks_path, "rb") as file:
        lines = file.read()

    def make():
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}
        encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda text: len(encoding.encode_ordinary(text)) if text else 0

    return make


def counted(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds n_tokens: the tokens of the whole text under a byte-pair vocabulary of ranks.

    A null or empty text has none; special tokens are ordinary text. Every row is counted by
    itself, whether its id is null or repeated.
    """
    counter = _counter(ranks_path, pattern)

    def make():
        count = counter()
        return lambda batch: [pa.array([count(t) for t in texts_of(batch)], pa.int64())]

    return with_columns(documents, "text", [T.StructField("n_tokens", T.LongType(), False)], make)


def counted_twice(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds n_tokens of text and new_tokens of corrected, and drops both texts.

    Where corrected is null the count stands and new_tokens is null. Both counts are of one
    row, so null and repeated ids are revised like any other.
    """
    counter = _counter(ranks_path, pattern)

    def make():
        count = counter()
        return lambda batch: [pa.array([count(t) for t in texts_of(batch)], pa.int64()),
                              pa.array([None if t is None else count(t) for t in batch.column("corrected").to_pylist()], pa.int64())]

    added = [T.StructField("n_tokens", T.LongType(), False), T.StructField("new_tokens", T.LongType(), True)]
    return with_columns(documents, "text", added, make, drop=("text", "corrected"))


def inserted(counts: DataFrame) -> DataFrame:
    """Changes that insert rows of (source, lang, tokenizer, n_tokens)."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("documents"), F.col("n_tokens").alias("tokens"))


def deleted(counts: DataFrame) -> DataFrame:
    """Changes that delete rows counted before."""
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("documents"), (-F.col("n_tokens")).alias("tokens"))


def revised(counts: DataFrame) -> DataFrame:
    """Changes of rows (source, lang, tokenizer, n_tokens, new_tokens) whose count is corrected."""
    return counts.select(*KEYS, F.lit(0).cast("long").alias("documents"), (F.col("new_tokens") - F.col("n_tokens")).alias("tokens"))


class Rollup:
    """Totals below a folder that all executors reach; one writer for a batch at a time.

    Groups with null keys are groups of their own. A missing count adds nothing. Before the
    first batch the totals are empty; a group whose documents are all gone leaves them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Makes the changes (source, lang, tokenizer, documents, tokens) the content of a batch."""
        # Summed in every task before the shuffle, so a hot source sends one row a task.
        sums = changes.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, documents, tokens) over all batches."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], _SUMS)
        rows = self.spark.read.schema(_SUMS).parquet(f"{self.folder}/batch=*")
        return (rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
                .where("documents <> 0 OR tokens <> 0"))

    def compact(self, into: str) -> Rollup:
        """The same totals as one batch of another folder."""
        other = Rollup(self.spark, into)
        other.commit("base", self.totals())
        return other


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all documents after three batches: all are inserted; counts of texts that
    change when runs of spaces become one are revised; documents labelled toxic are deleted.
    The second batch is committed twice, as after a failure. Each row of a repeated id is a
    document of its own, and all of them are deleted if the id is toxic; a null id is inserted
    and revised, and never deleted."""
    import public_tokenizers

    name = "byte_bpe_50k.tiktoken"
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang").withColumn("tokenizer", F.lit("byte_bpe_50k/1"))
    documents = documents.withColumn("corrected", F.when(F.expr("text LIKE '%  %'"), F.regexp_replace("text", " {2,}", " ")))
    counts = saved(counted_twice(documents, public_tokenizers.path(name), public_tokenizers.PATTERN), "token-counts")
    changes = revised(counts.where("new_tokens IS NOT NULL"))
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    gone = counts.withColumn("n_tokens", F.coalesce("new_tokens", "n_tokens")).join(toxic, "doc_id", "left_semi")

    rollup = Rollup(spark, fresh_folder(spark, "token-totals"))
    rollup.commit("0", inserted(counts))
    rollup.commit("1", changes)
    rollup.commit("2", deleted(gone))
    rollup.commit("1", changes)
    return rollup.totals()
