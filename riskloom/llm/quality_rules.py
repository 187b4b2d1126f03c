"""Quality rules: base counts of every text and a hashed n-gram log-likelihood ratio against a trusted target.

Words and word pairs are hashed into buckets. Two multinomials over the buckets, one of the trusted documents
and one of the whole raw corpus, give each document sum(log(p_target / p_raw)) over its n-grams, divided by the
number of n-grams. Documents below a fixed threshold go; the same text always gets the same verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import mix, text_batches, word_hashes

#: Buckets of the multinomials: the size of what is summed up, sent to the driver and back to the tasks.
BUCKETS = 1 << 16
#: Trusted documents at most; which ones is decided by a hash of their ids.
TRUSTED_ROWS = 20_000
#: Mean log-likelihood ratio under which a document goes.
THRESHOLD = -0.1
#: Counts by which a bucket's ratio is drawn towards 0: buckets seen seldom say little, in a small corpus as in a large.
PRIOR_COUNT = 20.0
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double"
)


def document_words(text: str) -> tuple[np.ndarray, list[bytes]]:
    """Every word as the number of its first occurrence among the distinct words, and those words."""
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(word, len(numbers)) for word in text.encode().split()]
    return np.array(ids, np.int64), list(numbers)


def gram_buckets(ids: np.ndarray, distinct: list[bytes]) -> np.ndarray:
    """Buckets of all words and all pairs of neighbouring words."""
    if not len(ids):
        return ids
    hashed = word_hashes().of(distinct)[ids]
    pairs = mix(hashed[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashed[1:])
    return (np.concatenate([mix(hashed), pairs]) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that the text has at least twice."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct > 1 << 20:  # keeps the three numbers of a window within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + ids[2:]
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of documents labelled good and never bad; at most ``rows`` of them, chosen by hash."""
    good = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = good.agg(F.min("quality").alias("lowest")).where("lowest = 1").select("doc_id")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Rows bucket, raw, target: n-gram counts of all documents and of the trusted ones."""
    flagged = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marks = trusted.select("doc_id", F.lit(True).alias("trusted"))  # bounded by TRUSTED_ROWS
    flagged = flagged.join(F.broadcast(marks), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in text_batches(batches):
            for text, good in zip(batch["text"].to_pylist(), batch["trusted"].to_pylist(), strict=True):
                found = np.bincount(gram_buckets(*document_words(text or "")), minlength=BUCKETS)
                counts[0] += found
                if good:
                    counts[1] += found
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])], ["bucket", "raw", "target"])

    partial = flagged.mapInArrow(run, "bucket long, raw long, target long")
    return partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log(p_target / p_raw) of every bucket; zeros when nothing is trusted. BUCKETS rows at most come to the driver.

    With PRIOR_COUNT added to the target's count and to the count expected of it if it were like the raw corpus.
    """
    both = np.zeros((2, BUCKETS))
    for bucket, raw, target in counts.collect():
        both[:, bucket] = raw, target
    if not both[1].any():
        return np.zeros(BUCKETS)
    expected = both[0] * (both[1].sum() / both[0].sum())
    return np.log(both[1] + PRIOR_COUNT) - np.log(expected + PRIOR_COUNT)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: base counts, ``llr`` (0 without words), base_failed and the verdict ``kept``.

    Null text counts as empty (no words, so it fails the base rule); a null doc_id is kept as null and is never
    trusted. Without any trusted document every ratio is 0 and the base rule alone decides. Other columns of the
    input are ignored.
    """
    ratios = log_ratios(bucket_counts(docs, trusted_ids(labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            rows = []
            for text in batch["text"].to_pylist():
                text = text or ""
                ids, distinct = document_words(text)
                grams = gram_buckets(ids, distinct)
                rows.append((
                    len(ids),
                    len(text) - sum(map(text.count, SPACES)),
                    sum(map(text.count, SYMBOLS)),
                    duplicate_lines(text),
                    repeated_words(ids, len(distinct)),
                    float(ratios[grams].mean()) if len(grams) else 0.0,
                ))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.float64()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], [p.split()[0] for p in SCHEMA.split(", ")])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = found.withColumn("base_failed", failed)
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
