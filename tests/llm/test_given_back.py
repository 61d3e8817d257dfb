"""Shuffle files of finished steps go before the next large step, executors' arrays stay small."""

from __future__ import annotations

import gc
import time
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cohortex.llm import katz, substring_dedup


def shuffle_bytes(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_"))


def least_shuffle_bytes(spark, seconds: float, collect: bool = False) -> int:
    """The least there is within some time; ``collect``: after collections, as a start."""
    found = shuffle_bytes(spark)
    for _ in range(int(seconds / 0.25)):
        if collect:
            gc.collect()
            spark.sparkContext._jvm.System.gc()
        time.sleep(0.25)
        found = min(found, shuffle_bytes(spark))
    return found


def random_words(spark, rows: int, words: int):
    """(doc_id, text): texts without a repeated word."""
    return spark.sql(f"SELECT id AS doc_id, array_join(transform(sequence(1, {words}), i -> substr(md5(concat(id, ' ', i)), 1, 8)), ' ') AS text FROM range({rows})")


def test_super_kmers_are_gone_before_the_texts_are_shuffled(spark):
    before = least_shuffle_bytes(spark, 2, collect=True)
    found = substring_dedup.repeated_spans(random_words(spark, 400, 300))
    left = least_shuffle_bytes(spark, 5)
    assert found.isEmpty()
    assert left - before < 100_000  # the packed rows are over a megabyte


def test_katz_questions_are_gone_before_the_answers_are_shuffled(spark):
    before = least_shuffle_bytes(spark, 2, collect=True)
    words = "array_join(transform(sequence(1, 300), i -> cast(xxhash64(id, i) % 5000 AS string)), ' ')"
    katz.score(spark.sql(f"SELECT id AS doc_id, {words} AS text, true AS train FROM range(800)"))
    assert least_shuffle_bytes(spark, 5) - before < 100_000  # the questions are over a megabyte


def test_a_katz_block_of_distinct_bigrams_is_small():
    rng = np.random.default_rng(3)
    vocabulary = np.unique(rng.integers(0, 2**63, 300_000, dtype=np.uint64))
    sizes = np.full(katz.BLOCK_TOKENS // 500, 500)
    words = rng.integers(0, len(vocabulary), int(sizes.sum())).astype(np.int32)
    block = katz.Block(pa.array(range(len(sizes))), np.ones(len(sizes), bool), sizes, words, vocabulary)
    counts = np.bincount(words, minlength=len(vocabulary))
    tracemalloc.start()
    try:
        pairs, which, seen = block.bigrams()
        katz.ask(block, pairs, counts, np.zeros(len(vocabulary), bool), len(words), 50)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100e6
