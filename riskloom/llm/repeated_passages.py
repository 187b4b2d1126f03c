"""Removal of passages that come twice, by seeds and extension: winnowed anchors, joined, extended to maximal repeats.

Of every 18 consecutive 18-word shingles the smallest is an anchor; so any 35 words (18 + 18 - 1) hold one, and equal
passages of 35 words hold the same one at the same place. An anchor answers for the windows of 35 words that chose it:
up to 18 that start one after another. Documents are joined on anchors, and a match is extended to both sides:

1. at once as far as the anchor's windows reach. Where all places of an anchor agree that far, all their windows are
   repeated; of places that differ, those whose whole reach comes twice are done as well.
2. The other places, with one of each group of equal ones, are extended to every single window of 35 words that holds
   the anchor, and these extended seeds are joined again.

Places are grouped by their seeds and never compared in pairs, so a passage in a third of all documents costs as many
rows as it has places. Windows that follow each other are merged, so that spans are the union of all maximal repeats.
Seeds are 64-bit, extended ones 128-bit hashes of whole word sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import mix, text_batches, word_hashes
from riskloom.session import discard, stored

#: Words of a window, and of a shingle: a window has as many shingles as a shingle has words.
WINDOW, SHINGLE = 35, 18
#: Odd bases, 5 modulo 8, of the two sequence hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D)
#: Places compared at a time.
BLOCK = 1 << 16
#: A spot is the first window (32 bits), the number of windows less one (5 bits) and bits of the text's hash.
TAG_BITS = 27
SEEDS = "anchor long, reach long, rid long, spot long"
EXTENDED = "left long, right long, rid long, spot long"
SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
RESULT = "doc_id long, n_words long, spans array<struct<start: long, stop: long>>, kept string"


def words_in(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def sequence_hash(hashes: np.ndarray, base: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that hashes the words from ``start`` to before ``stop`` for arrays of both."""
    powers = np.full(len(hashes) + 1, base, np.uint64)
    inverse = np.full(len(hashes) + 1, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1])])
    return lambda start, stop: mix((total[stop] - total[start]) * inverse[start])


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every anchor its shingle's hash, the hash of all that its windows reach, its first window, and their number.

    The leftmost of equal shingles is chosen, so that the choice rests on the window's words alone.
    """
    windows = len(hashes) - WINDOW + 1
    if windows < 1:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    near, far = (sequence_hash(hashes, base) for base in BASES)
    at = np.arange(len(hashes) - SHINGLE + 1)
    shingles = near(at, at + SHINGLE)
    chosen = np.empty(windows, np.int64)
    for begin in range(0, windows, BLOCK):
        end = min(begin + BLOCK, windows)
        view = np.lib.stride_tricks.sliding_window_view(shingles[begin : end + SHINGLE - 1], SHINGLE)
        chosen[begin:end] = np.arange(begin, end) + view.argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:], [windows]]) - 1
    place = chosen[first]
    shape = ((place - first) * 32 + (last - first)).astype(np.uint64)
    reach = mix(far(first, last + WINDOW) + shape)
    return shingles[place], reach, first, last - first + 1


def spots(first: np.ndarray, number: np.ndarray, tag: int) -> np.ndarray:
    return first << 32 | (number - 1) << TAG_BITS | tag


def windows_at(spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return spots >> 32, (spots >> TAG_BITS & 31) + 1


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = word_hashes()
    for batch in text_batches(batches):
        parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
        for rid, tag, text in zip(*(batch[c].to_pylist() for c in ("rid", "tag", "text")), strict=True):
            anchor, reach, first, number = anchors(known.of(words_in(text)))
            own = (anchor.view(np.int64), reach.view(np.int64), np.full(len(first), rid, np.int64), spots(first, number, tag))
            for part, values in zip(parts, own, strict=True):
                part.append(values)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], [c.split()[0] for c in SEEDS.split(", ")])


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = word_hashes()
    for batch in text_batches(batches):
        parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
        for rid, tag, text, asked in zip(*(batch[c].to_pylist() for c in ("rid", "tag", "text", "spots")), strict=True):
            asked = np.array([s for s in asked if s & ((1 << TAG_BITS) - 1) == tag], np.int64)
            if len(asked):
                first, number = windows_at(asked)
                start = np.repeat(first, number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
                hashes = known.of(words_in(text))
                sides = [sequence_hash(hashes, base)(start, start + WINDOW).view(np.int64) for base in BASES]
                own = (*sides, np.full(len(start), rid, np.int64), spots(start, np.ones_like(start), tag))
                for part, values in zip(parts, own, strict=True):
                    part.append(values)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], [c.split()[0] for c in EXTENDED.split(", ")])


def covered(spots: np.ndarray, n_words: int) -> list[tuple[int, int]]:
    """The union of the windows at the spots, as (start, stop)."""
    change = np.zeros(n_words + 1, np.int64)
    first, number = windows_at(spots)
    np.add.at(change, first, 1)
    np.add.at(change, first + number - 1 + WINDOW, -1)
    inside = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches):
        counts, found, texts = [], [], []
        for tag, text, own in zip(*(batch[c].to_pylist() for c in ("tag", "text", "spots")), strict=True):
            words = words_in(text)
            own = np.array([s for s in own or [] if s & ((1 << TAG_BITS) - 1) == tag], np.int64)
            spans = covered(own, len(words)) if len(own) else []
            counts.append(len(words))
            for start, stop in reversed(spans):
                del words[start:stop]
            found.append(spans)
            texts.append(b" ".join(words))
        flat = np.array([s for spans in found for s in spans], np.int64).reshape(-1, 2)
        structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(2)], fields=list(SPAN))
        lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)]).astype(np.int32), structs)
        columns = [batch["doc_id"], pa.array(counts, pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")[:3]] + ["kept"])


def _gathered(spot_rows: DataFrame) -> DataFrame:
    """The spots of each document: at most as many as it has words; equal rows of a document fall together."""
    return spot_rows.groupBy("rid").agg(F.collect_set("spot").alias("spots"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with an id by their doc_id and text; what 64 bits cannot tell apart is told by ``tag``."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    tag: Column = F.xxhash64(F.lit(TAG_BITS), text).bitwiseAND(F.lit((1 << TAG_BITS) - 1))
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("rid"), tag.alias("tag"))


def repeated_spots(keyed: DataFrame) -> DataFrame:
    """Columns rid and spot: the windows of each document whose words also start anywhere else."""
    spark = keyed.sparkSession
    seeds, seeds_path = stored(keyed.select("rid", "tag", "text").mapInArrow(_seeds, SEEDS), "seeds")
    per_anchor = seeds.groupBy("anchor").agg(F.count("*").alias("n"), F.min("reach").alias("low"), F.max("reach").alias("high"))
    # Stored before the join, as below: both sides are then plain exchanges, and a hot anchor's seeds can be split.
    shared, _ = stored(per_anchor.where("n > 1").selectExpr("anchor", "low = high AS alike"), "shared-anchors")
    joined, _ = stored(seeds.join(shared, "anchor"), "joined-seeds")
    discard(spark, seeds_path)
    apart = joined.where("NOT alike")
    groups = apart.groupBy("anchor", "reach").agg(F.count("*").alias("n"), F.min(F.struct("rid", "spot")).alias("one"))
    groups, _ = stored(groups, "reaches")
    whole = apart.join(groups.where("n > 1").select("anchor", "reach"), ["anchor", "reach"]).select("rid", "spot")
    asked = _gathered(groups.select("one.rid", "one.spot"))
    windows, _ = stored(keyed.join(asked, "rid").select("rid", "tag", "text", "spots").mapInArrow(_extended, EXTENDED), "extended-seeds")
    twice = windows.groupBy("left", "right").agg(F.count("*").alias("n")).where("n > 1").select("left", "right")
    twice, _ = stored(twice, "shared-windows")
    single = windows.join(twice, ["left", "right"]).select("rid", "spot")
    return joined.where("alike").select("rid", "spot").unionByName(whole).unionByName(single)


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_words, spans (word numbers, end exclusive) that repeat, and the kept text.

    Every window of 35 words whose sequence also starts anywhere else, in the same document or another, is in a span;
    windows are judged on the input, so all copies of a passage go. Words are what stands between ASCII white space,
    unchanged; kept words are joined by single spaces. Null, empty and blank texts have no words, texts under 35 words
    no spans. Repeated rows are copies of each other and lose all their windows; null ids are kept, other columns
    ignored; no rows give no rows.
    """
    keyed = _keyed(docs)
    spots_of = _gathered(repeated_spots(keyed))
    return keyed.join(spots_of, "rid", "left").select("doc_id", "tag", "text", "spots").mapInArrow(_cut, RESULT)


def passage_digests(cut: DataFrame) -> DataFrame:
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    return cut.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


PASSAGES_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D ]+'), lambda x: x <> '') AS w FROM documents
), placed AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM split
), starts AS (
  SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM split WHERE len(w) >= 35
), windows AS (
  SELECT r, i, array_to_string(w[i : i + 34], ' ') AS s FROM starts
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM windows) WHERE n > 1
), judged AS (
  SELECT p.r, p.i, p.word, count(q.i) OVER (PARTITION BY p.r ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM placed p LEFT JOIN repeated q ON p.r = q.r AND p.i = q.i
), kept AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS t FROM judged GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (r)
"""
