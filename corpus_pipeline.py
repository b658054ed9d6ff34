"""From documents to packed training sequences: five stages, each by one operator of ``strandline.llm``.

Every stage gets what its predecessor kept, written as Parquet; all but the last return the columns of documents.
No ORACLE_SQL: SQL can express neither trained models nor the packing; the stages are tested against
brute force in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import mixing, order_minhash, packing, ppm, repeats
from strandline.llm.common import discard, small_batches, stash, table
from strandline.llm.queries import byte_bpe

#: Repeats of this many bytes are cut: about 33 words. Of the runs of 51 words at sf0.01, 111 of 335,834 (in 4 documents) are shorter.
PASSAGE_BYTES = 200
#: A text that costs more bits a byte than plain bytes do is in none of the learned languages.
MAX_BITS = 8.0
#: Both less than op4's: the workers that pack have run the other stages, beside a JVM whose heap these have filled, and go on to run them for the next input.
MEMO_SIZE, PART_CHARS = 60_000, 1 << 19
#: Bytes of an Arrow batch, for the same reason: both sides hold some, outside the heap.
BATCH_BYTES = 1 << 20
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or that the best language's code makes longer than plain bytes. Without labelled texts only letters count."""
    small_batches(spark, BATCH_BYTES)
    judged = ppm.identify(docs.select("doc_id", "text", "lang", F.struct("*").alias("_row")))
    kept = F.when(F.col("bits").isNotNull(), F.col("bits") <= MAX_BITS).otherwise(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return judged.filter(kept).select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    small_batches(spark, BATCH_BYTES)
    return order_minhash.keep_first(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat are cut out, but for their first occurrence."""
    small_batches(spark, BATCH_BYTES)
    return repeats.drop_repeats(docs, PASSAGE_BYTES)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated towards their weights: one to two passes each, so no document is lost."""
    return mixing.mixed_documents(docs, min_epochs=1)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2048 tokens."""
    small_batches(spark, BATCH_BYTES)
    return packing.pack(docs, byte_bpe(), memo_size=MEMO_SIZE, part_chars=PART_CHARS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returned is written in the shared folder, and deleted once the next one is written.

    The last stage's input stays, as its result may still be read from it.
    """
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stash(docs, f"pipeline-{i}-{name}")
            discard(before)
    return docs
