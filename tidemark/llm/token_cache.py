"""Token counts through a cache of digests.

Documents are joined with stored counts on the digests of their text and of the tokenizer. Only distinct texts that have no
count yet are encoded; their counts are appended to the cache, and the next run finds them there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_path, stored, without
from .tokens import encoder, tokenizer_version

CACHE = "digest binary, version string, n_tokens bigint"


def _counts(version: str, path: str | None):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            done: dict[bytes, int] = {}
            for i, digest in enumerate(batch.column(0).to_pylist()):
                if digest not in done:
                    done[digest] = len(encode(batch.column(1)[i].as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(done), pa.binary()), pa.array([version] * len(done)), pa.array(list(done.values()), pa.int64())],
                ["digest", "version", "n_tokens"],
            )

    return task


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """What the cache holds; a cache that isn't there yet is empty."""
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, cache: str | None = None, tokenizer: str | None = None, limit: int = 1024) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``).

    A null text counts as empty and has no tokens. Equal texts are encoded once; rows that repeat a doc_id keep a row each,
    null ids too. An empty table gives an empty result and leaves the cache as it was; other columns aren't read.
    ``cache``: folder of the counts, shared by all runs; by default a new one in the shared folder.
    ``tokenizer``: a file of the ``tokenizers`` library; the counts of another file or version are never used.

    Which texts stay out of the encoding (copies of an earlier document, texts with a stored count) is decided on digests
    alone. Texts leave their place only if that list is too long for a broadcast, and then only those that may be on it.
    """
    spark = docs.sparkSession
    cache, version = cache or new_path(spark, "token-cache"), tokenizer_version(tokenizer)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keyed = stored(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "digests")
    known = read_cache(spark, cache).where(F.col("version") == version).select("digest").distinct()
    first = keyed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("times"))
    first = first.join(known.withColumn("known", F.lit(True)), "digest", "left")
    skipped = keyed.join(first.where("times > 1 or known"), "digest").where("known or not (doc_id <=> first)")
    missing = without(docs, stored(skipped.select("doc_id", "digest").distinct(), "skipped"), "doc_id", "digest")
    counted = missing.select("digest", "text").mapInArrow(_counts(version, tokenizer), CACHE)
    counted.distinct().write.mode("append").parquet(cache)  # rows repeated with doc_id and text may be in several tasks
    counts = read_cache(spark, cache).where(F.col("version") == version)
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
