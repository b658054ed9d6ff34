"""What a worker of the pipeline holds beside the executor's heap."""

import random
import tracemalloc

import pandas as pd

import corpus_pipeline
from strandline.llm import packing, repeats


def peak_mb(work) -> float:
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def words(n: int, size: int) -> list[str]:
    rng = random.Random(3)
    return [" ".join(f"{rng.getrandbits(32):x}" for _ in range(size)) for _ in range(n)]


def test_parts_of_passages_are_small():
    texts = words(200, 700)
    batch = pd.DataFrame({"text": texts, "n": [len(x) for x in texts]})

    def anchors():
        for rows in repeats._by_size(batch):
            repeats.anchors([x.encode() for x in rows["text"]], 200)

    assert peak_mb(anchors) < 20  # 39 with 512 KB at once


def test_packing_of_the_pipeline_keeps_few_chunks():
    batch, encoder = pd.DataFrame({"text": words(200, 2500)}), packing.Encoder(corpus_pipeline.byte_bpe(), corpus_pipeline.MEMO_SIZE)
    most = 0
    for part in packing.by_size(batch, getattr(corpus_pipeline, "PART_CHARS", 4 << 20)):
        encoder.encode(part["text"].tolist())
        most = max(most, len(encoder.memo))
    assert most < 130_000  # 60,000 and a part's; it was 150,000 and the 460,000 of 4 MB


def test_batches_of_the_pipeline_are_small(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, 64 << 20)
        docs = spark.createDataFrame([(1, "a few words")], "doc_id long, text string")
        corpus_pipeline.near_dedup(spark, docs, "")
        assert int(spark.conf.get(key).rstrip("b")) <= 1 << 20
    finally:
        spark.conf.set(key, before)
