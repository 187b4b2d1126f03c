"""Words, shingle hashes and bounded batches shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Words remembered per task; more words are hashed anew each time, with the same result.
REMEMBERED_WORDS = 100_000
#: Odd multipliers that make the sum of five word hashes depend on their order.
ORDER_KEYS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
    dtype=np.uint64,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space and \\x09-\\x0D), A-Z lower-cased, in UTF-8."""
    return (text or "").encode().lower().split()


def kept_in_worker(key: object, make: Callable[[], Any]) -> Any:
    """What ``make`` gave first in this Python worker; later tasks of the same worker use it again."""
    store = sys.modules.setdefault("_riskloom_worker", types.ModuleType("_riskloom_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes() -> WordHashes:
    return kept_in_worker("word hashes", WordHashes)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``size``-word shingles; a shorter sequence is one shingle, no words none."""
    count = len(hashes)
    if count == 0:
        return hashes
    width = min(size, count)
    total = np.zeros(count - width + 1, np.uint64)
    for place in range(width):
        total += hashes[place : count - width + 1 + place] * ORDER_KEYS[place]
    return np.unique(mix(total + np.uint64(width)))


def text_batches(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``size`` rows, so that a task holds few decoded texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)
