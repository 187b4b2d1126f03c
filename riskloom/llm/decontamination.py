"""Benchmark decontamination: containment search with size-partitioned minimum hashes, verified exactly.

Documents fall into partitions by the power of two above their number of shingles; a partition of size u hashes into
u bins per permutation and keeps the minimum of each bin, so its sketch grows with its documents and a short test
item keeps most of its shingles as minima even in a very long text. A shingle that item and document share is a
minimum of its bin in both with a chance of at least one half (documents fill at most one shingle a bin on average;
items, which are shorter than the documents that contain them, fill fewer). An item asks with as many permutations
as its number of shared shingles needs for a chance of 1e-9 to be missed: one from 30 shared shingles on, more for
shorter items. Candidates are then verified on full shingle sets.

Test items are asked in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import mix, shingle_set, text_batches, word_hashes

#: Share of an item's shingles that a document must have, in percent.
CONTAINMENT = 80
#: Characters of test items held in a task at a time.
BLOCK_CHARS = 4_000_000
MISS = 1e-9
SCHEMA = "doc_id long, item_id long, n_shared long, n_item long"


def lower_words(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII white space; unlike the duplicate search, letters of all scripts are lowered."""
    return (text or "").lower().encode().split()


def permutations_needed(shared: int) -> int:
    """Permutations that let ``shared`` common shingles all be missed with a chance below MISS."""
    return max(1, ceil(log(MISS) / (shared * log(0.5))))


def bin_minima(shingles: np.ndarray, bits: int, permutation: int) -> np.ndarray:
    """The smallest permuted hash of every non-empty bin; the top ``bits`` bits of a hash are its bin."""
    hashed = np.sort(mix(shingles ^ np.uint64(0x9E3779B97F4A7C15 * (permutation + 1) % 2**64)))
    if not bits or not len(hashed):
        return hashed[:1]
    bins = hashed >> np.uint64(64 - bits)
    return hashed[np.concatenate([[True], bins[1:] != bins[:-1]])]


class ItemIndex:
    """Test items of one block and, for each size partition met so far, their bin minima by permutation."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        self.needed = [permutations_needed(max(1, ceil(CONTAINMENT * len(s) / 100))) for _, s in items]
        self.partitions: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def partition(self, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
        known = self.partitions.get(bits)
        if known is None:
            known = []
            for permutation in range(max(self.needed, default=0)):
                asked = [i for i, n in enumerate(self.needed) if n > permutation]
                minima = [bin_minima(self.items[i][1], bits, permutation) for i in asked]
                values = np.concatenate(minima)
                owner = np.repeat(asked, [len(m) for m in minima])
                order = np.argsort(values, kind="stable")
                known.append((values[order], owner[order]))
            self.partitions[bits] = known
        return known

    def contained_in(self, shingles: np.ndarray) -> list[tuple[int, int, int]]:
        """(item_id, shared, size) of the items that the document contains."""
        if not len(shingles):
            return []
        bits = int(len(shingles) - 1).bit_length()
        candidates: set[int] = set()
        for permutation, (values, owner) in enumerate(self.partition(bits)):
            minima = bin_minima(shingles, bits, permutation)
            start = np.searchsorted(values, minima, "left")
            stop = np.searchsorted(values, minima, "right")
            for at in np.flatnonzero(stop > start):
                candidates.update(owner[start[at] : stop[at]].tolist())
        found = []
        for i in candidates:
            item_id, own = self.items[i]
            place = np.searchsorted(shingles, own)
            shared = int((shingles[np.minimum(place, len(shingles) - 1)] == own).sum())
            if 100 * shared >= CONTAINMENT * len(own):
                found.append((item_id, shared, len(own)))
        return found


def _ask(docs: DataFrame, texts: list[tuple[int, str]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        sets = [(item_id, shingle_set(hashes.of(lower_words(text)))) for item_id, text in texts]
        index = ItemIndex([(item_id, s) for item_id, s in sets if len(s)])
        for batch in text_batches(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                rows += [(doc_id, *found) for found in index.contained_in(shingle_set(hashes.of(lower_words(text))))]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [p.split()[0] for p in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def item_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The distinct test items in blocks of about ``chars`` characters, decided by a hash of the item."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = ceil(total / chars)
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted((tuple(r) for r in chosen.collect()), key=lambda r: (r[0] is None, r))
        if rows:
            yield rows


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a test item whose five-word shingles it contains by at least 80 %.

    Returns doc_id, item_id, n_shared, n_item and containment. Null and empty texts on either side match nothing;
    null ids are carried as they are; repeated document rows give their pairs once. An item id with several texts
    reports the text that is contained best. No items or documents: an empty result.
    """
    parts = [_ask(docs, rows) for rows in item_blocks(benchmark)]
    if not parts:
        parts = [docs.limit(0).select(*[F.lit(None).cast("long").alias(p.split()[0]) for p in SCHEMA.split(", ")])]
    found = reduce(DataFrame.unionByName, parts).withColumn("containment", F.col("n_shared") / F.col("n_item"))
    best = F.max(F.struct("containment", "n_shared", "n_item")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_shared", "best.n_item", "best.containment")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with all columns; rows without doc_id stay only if clean.

    The verdict is taken row by row in the same task, so nothing is joined back.
    """
    blocks = list(item_blocks(benchmark))
    schema = docs.schema

    for rows in blocks:

        def run(batches: Iterator[pa.RecordBatch], rows: list = rows) -> Iterator[pa.RecordBatch]:
            hashes = word_hashes()
            sets = [(item_id, shingle_set(hashes.of(lower_words(text)))) for item_id, text in rows]
            index = ItemIndex([(item_id, s) for item_id, s in sets if len(s)])
            for batch in text_batches(batches):
                place = batch.schema.get_field_index("text")
                clean = [not index.contained_in(shingle_set(hashes.of(lower_words(t)))) for t in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs


CONTAINED_SQL = r"""
WITH said AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), split AS (
  SELECT side, id, list_filter(string_split_regex(lower(text), '[\x09-\x0D ]+'), lambda x: x <> '') AS w FROM said WHERE text IS NOT NULL
), placed AS (
  SELECT side, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT side, id, array_to_string(w[i : i + 4], ' ') AS s FROM placed
), items AS (
  SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE side = 'i'
)
SELECT d.id AS doc_id, items.id AS item_id, count(*) AS n_shared, max(n) AS n_item, count(*) / max(n) AS containment
FROM shingles d JOIN items USING (s) WHERE d.side = 'd'
GROUP BY d.id, items.id HAVING 100 * count(*) >= 80 * max(n)
"""
