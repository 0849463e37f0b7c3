"""Token counts through a digest cache.

Texts are known by the SHA-256 of their normalised content (null is empty; nothing else may change, as tokenizers see every
character) and tokenizers by the SHA-256 of their vocabulary file and settings. Stored counts are joined on both digests;
only distinct texts without a stored count are encoded, once each, and their counts are appended to the cache.

Vocabulary files: ``.json`` goes to ``tokenizers``, ``.model`` to ``sentencepiece`` and ``.tiktoken`` to ``tiktoken`` with the
ids of its special strings given. Special strings inside texts are tokens, as the libraries' defaults have it; no begin, end
or other added tokens, truncation or padding. The cache is a plain Parquet table; a run that fails appends nothing, and a
count that two runs append twice is the same count and is read once.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.runtime import path_exists, remove_at_exit, stored, work_folder

#: The split pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts that are handed to a library at once.
TEXTS_AT_ONCE = 64

_CACHE = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str, special: dict[str, int]) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + repr(sorted(special.items())).encode()).hexdigest()


@functools.lru_cache(maxsize=4)
def counter(path: str, special: tuple[tuple[str, int], ...]):
    """A function from a list of texts to their token counts; made once in a worker process."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.no_truncation()
        whole.no_padding()
        # One text at a time: an encoding takes over 100 bytes a token until it is let go.
        return lambda texts: [len(whole.encode_batch_fast([t], add_special_tokens=False)[0]) for t in texts]
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(e) for e in pieces.encode(texts, num_threads=1)]
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    byte_pairs = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))
    return lambda texts: [len(byte_pairs.encode(t, allowed_special="all")) for t in texts]


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python at most ``rows`` rows at once, so that long texts do not add up in a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _counted(texts: DataFrame, path: str, special: dict[str, int]) -> DataFrame:
    """``digest`` and ``n_tokens`` of rows ``(digest, text)``."""

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = None
        for batch in batches:
            count = count or counter(path, tuple(special.items()))
            column = batch.column(1)
            counts: list[int] = []
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                counts += count(column.slice(first, TEXTS_AT_ONCE).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return texts.mapInArrow(run, "digest binary, n_tokens long")


def token_counts(
    docs: DataFrame, path: str, cache: str, special: dict[str, int] | None = None, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: id, n_bytes, n_tokens. ``cache`` is a folder that all executors share.

    The text is read once for its digest and once more for the misses; copies are combined before the shuffle, so a text
    that a third of all rows share travels once per task. ``path`` must be readable at the same place on every executor.
    """
    spark, special = docs.sparkSession, special or {}
    version = tokenizer_digest(path, special)
    content = F.coalesce(F.col(text), F.lit(""))
    known = spark.read.schema(_CACHE).parquet(cache) if path_exists(spark, cache) else spark.createDataFrame([], _CACHE)
    known = known.where(F.col("tokenizer") == version)
    texts = docs.select(F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("text"))
    misses = texts.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest", "left_anti")
    found = _counted(misses, path, special).withColumn("tokenizer", F.lit(version))
    with arrow_rows(spark, TEXTS_AT_ONCE * 4):
        found.select("digest", "tokenizer", "n_tokens").write.mode("append").parquet(cache)
    counts = spark.read.schema(_CACHE).parquet(cache).where(F.col("tokenizer") == version)
    # Written out, so that the join has both sides straight from a shuffle and AQE can cut a text that very many rows share.
    counts = stored(counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    rows = docs.select(F.col(id).alias(id), F.unhex(F.sha2(content, 256)).alias("digest"), F.octet_length(content).cast("long").alias("n_bytes"))
    return rows.join(counts, "digest").select(id, "n_bytes", "n_tokens")


#: Tokens above which a text does not fit a training window.
LIMIT = 1024


def query(documents: DataFrame) -> DataFrame:
    """Counts by ``byte_bpe_50k.json`` and its own library, with a cache of its own."""
    import public_tokenizers

    cache = work_folder(documents.sparkSession, "token cache")
    counts = token_counts(documents, public_tokenizers.path("byte_bpe_50k.json"), cache)
    remove_at_exit(documents.sparkSession, cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
