"""Token counts through a digest cache.

A count belongs to (digest of the content, digest of the tokenizer's version). The content is normalised only
as far as the tokenizer cannot tell the difference: null becomes empty. Digests are joined with the counts stored in the
cache table; only texts of what is missing are shuffled, folded before by content, so that each is encoded once however
many rows have it, and their counts are appended to the cache. Whole texts are encoded, without begin, end or added
special tokens.

The cache is a parquet table ``content, tokenizer, n_tokens``, only ever appended to. Two jobs that append the
same digest at once store equal counts; reading folds them.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows share one count and all appear;
a null ``doc_id`` stays null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import cut, work_folder

LIMIT = 4096
CACHE = "content binary, tokenizer string, n_tokens long"
TEXTS_AT_ONCE = 64
BROADCAST_ROWS = 200_000      # digests of misses (32 bytes each), after counting them; more are joined by a shuffle


@lru_cache(maxsize=4)
def counter(name: str):
    """texts -> token counts, by the library the vocabulary file is for."""
    import public_tokenizers
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    return lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]


def tokenizer_digest(name: str) -> str:
    """Changes with the vocabulary file and with the library's version: old counts are then not used."""
    from importlib.metadata import version

    import public_tokenizers
    library = "sentencepiece" if name.endswith(".model") else "tokenizers"
    with open(public_tokenizers.path(name), "rb") as f:
        return hashlib.sha256(f.read() + f"|{library} {version(library)}".encode()).hexdigest()


def _counts(name: str):
    def run(batches):
        count = counter(name)
        for batch in batches:
            texts, counts = batch.column(1), []
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                counts += count(texts.slice(at, TEXTS_AT_ONCE).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", cache: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``; ``cache`` is the folder of stored counts."""
    spark = docs.sparkSession
    root = work_folder(spark, "token-counts")
    cache = cache or f"{root}/cache"
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)     # a first run finds an empty table
    version = tokenizer_digest(tokenizer)
    docs = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("content", F.unhex(F.sha2("text", 256))))

    def stored() -> DataFrame:
        # read anew each time: files may have been appended
        return (spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
                .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))

    # digests alone meet the cache; equal contents are folded where they are read
    signed = cut(docs.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")), root, "signed")
    misses = cut(signed.select("content").distinct().join(stored(), "content", "left_anti"), root, "misses")
    n = misses.count()
    if n:
        once = F.first("text").alias("text")
        if n <= BROADCAST_ROWS:
            texts = docs.join(F.broadcast(misses), "content", "left_semi").groupBy("content").agg(once)
        else:
            texts = docs.groupBy("content").agg(once).join(misses, "content", "left_semi")
        (texts.mapInArrow(_counts(tokenizer), "content binary, n_tokens long")
         .select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache))
    return (signed.join(cut(stored(), root, "counts"), "content")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
