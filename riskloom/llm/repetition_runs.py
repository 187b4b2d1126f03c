"""Periodic runs of words by an enhanced suffix array: order, ranks and common prefixes of suffixes, without a tree.

Two equal neighbours ``w w`` whose next words differ (a branching square) are two suffixes, |w| apart, that part
exactly at depth |w|: they lie on different sides of one boundary of the array whose common prefix has that length.
So for every boundary the suffixes i of its smaller side are tested: does ISA[i + depth] or ISA[i - depth] fall on the
other side? Every suffix is on a smaller side at most log2(n) times. Every run ends in exactly one branching square of
its period; the square is rotated to the left as long as the words agree, which gives the run, and squares whose
period is a multiple of that of a run with the same end are merged into it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import mix, text_batches

#: A run has at least so many words and so many periods.
MIN_LENGTH, MIN_PERIODS = 24, 3
#: A run of 24 words and three periods starts with 16 words that come again one period later.
REPEAT_BITS = 4
#: Suffixes tested at a time, so that a long text needs memory in proportion to its words only.
TESTED = 1 << 18
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

#: Words i >= first become word first + (i - first) % period.
Rewrite = Callable[[int | None, int], tuple[int, int] | None]


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def may_have_runs(ids: np.ndarray) -> bool:
    """False only if no 16 consecutive words come twice; equal windows always have equal hashes."""
    if len(ids) < MIN_LENGTH:
        return False
    hashed = mix(ids.astype(np.uint64) + np.uint64(1))
    for bit in range(REPEAT_BITS):
        hashed = mix(hashed[: -(1 << bit)] * np.uint64(0x9E3779B97F4A7C15) + hashed[1 << bit :])
    hashed.sort()
    return bool((hashed[1:] == hashed[:-1]).any())


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, the place of each suffix, and the common prefix of each suffix in order with the next one.

    Places are refined by doubling the compared width, and only among suffixes that still share theirs. The places of
    every width are kept: a common prefix is read off them from the largest width down.
    """
    n = len(ids)
    count = np.bincount(ids)
    place = (np.cumsum(count) - count)[ids]
    unsettled, width, levels = np.flatnonzero(count[ids] > 1), 1, [place.astype(np.int32)]
    while len(unsettled):
        after = np.where(unsettled + width < n, place[np.minimum(unsettled + width, n - 1)] + 1, 0)
        key = place[unsettled] * (n + 1) + after
        order = np.argsort(key, kind="stable")
        unsettled, key = unsettled[order], key[order]
        old, at = place[unsettled], np.arange(len(key))
        new_old, new_key = (np.concatenate([[True], x[1:] != x[:-1]]) for x in (old, key))
        first_old, first_key = (np.maximum.accumulate(np.where(x, at, 0)) for x in (new_old, new_key))
        place[unsettled] = old + first_key - first_old
        unsettled = unsettled[~(new_key & np.concatenate([new_key[1:], [True]]))]
        width *= 2
        levels.append(place.astype(np.int32))
    order = np.empty(n, np.int64)
    order[place] = np.arange(n)
    left, right, common = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for bit in range(len(levels) - 2, -1, -1):
        a, b = left + common, right + common
        inside = np.maximum(a, b) < n
        same = inside & (levels[bit][np.minimum(a, n - 1)] == levels[bit][np.minimum(b, n - 1)])
        common[same] += 1 << bit
    return order, place, common


def reach(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every boundary the first and last place of the suffixes around it that share at least its prefix, up to an
    earlier boundary of the same depth: so every pair of suffixes is parted by one boundary only."""
    values, low, high, waiting = common.tolist(), [0] * len(common), [0] * len(common), []
    for at, depth in enumerate(values):
        while waiting and values[waiting[-1]] > depth:
            high[waiting.pop()] = at
        low[at] = waiting[-1] + 1 if waiting else 0
        waiting.append(at)
    for at in waiting:
        high[at] = len(values)
    return np.array(low, np.int64), np.array(high, np.int64)


def branching_cubes(order: np.ndarray, place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Rows (start, period) of branching squares that have the same words once more before them."""
    n = len(order)
    low, high = reach(common)
    at = np.flatnonzero((common > 0) & (high - low >= MIN_PERIODS - 1))
    left, right = at - low[at] + 1, high[at] - at
    found = [np.zeros((0, 2), np.int64)]
    smaller = np.minimum(left, right)
    begin = 0
    ends = np.cumsum(smaller)
    while begin < len(at):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + TESTED, "right")))
        chosen, size = slice(begin, stop), smaller[begin:stop]
        begin = stop
        here, is_left = at[chosen], (left <= right)[chosen]
        first = np.where(is_left, low[here], here + 1)
        other_low, other_high = np.where(is_left, here + 1, low[here]), np.where(is_left, high[here], here)
        node = np.repeat(np.arange(len(here)), size)
        suffix = order[first[node] + np.arange(len(node)) - np.repeat(np.cumsum(size) - size, size)]
        depth = common[here][node]
        for start, partner in ((suffix, suffix + depth), (suffix - depth, suffix - depth)):
            before = start - depth
            inside = (before >= 0) & (partner < n) & (partner >= 0)
            k, s, p = node[inside], start[inside], partner[inside]
            fits = (place[p] >= other_low[k]) & (place[p] <= other_high[k])
            k, s = k[fits], s[fits]
            b = place[s - common[here][k]]
            fits = (b >= low[here][k]) & (b <= high[here][k])
            found.append(np.stack([s[fits], common[here][k[fits]]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def rotated_left(ids: np.ndarray, start: int, period: int) -> int:
    """How far the square at ``start`` can be rotated to the left: the start of its run."""
    step = 64
    while start > 0:
        low = max(0, start - step)
        differs = np.flatnonzero(ids[low:start] != ids[low + period : start + period])
        if len(differs):
            return low + int(differs[-1]) + 1
        start, step = low, step * 2
    return 0


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of numbered words, by start and period."""
    if not may_have_runs(ids):
        return []
    squares = branching_cubes(*suffix_array(ids))
    known: dict[int, list[tuple[int, int]]] = {}
    for start, period in squares[np.argsort(squares[:, 1], kind="stable")].tolist():
        end = start + 2 * period
        own = known.setdefault(end, [])
        if not any(period % q == 0 and s <= end - MIN_PERIODS * period for s, q in own):
            own.append((rotated_left(ids, start, period), period))
    runs = ((s, end - s, q) for end, own in known.items() for s, q in own)
    return sorted(r for r in runs if r[1] >= max(MIN_LENGTH, MIN_PERIODS * r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()])


def seeded_rewrite(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The part of every tenth document, by a checksum of its id, that is made periodic; nothing without id or words."""
    seed = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    rest = seed // 10
    if seed % 10 or not n:
        return None
    first = rest % n
    return first, 1 + (n - first) // (3 + rest % 8)


def word_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """One row per document row: doc_id, n_words, runs (start, length, period; by start and period) and collapsed text.

    Words are what stands between ASCII white space. A run is a stretch of at least 24 words and three smallest periods
    that neither neighbour extends. ``collapsed`` keeps the first period of every run, joined by single spaces.
    ``rewrite`` may make a document periodic before it is searched. Null, empty and blank texts have no words, no
    runs and an empty text; texts under 24 words have no runs. Null ids and repeated rows are kept as they are, other
    columns are ignored; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            counts, found, texts = [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = (text or "").encode().split()
                change = rewrite(doc_id, len(words)) if rewrite else None
                if change:
                    first, period = change
                    unit, rest = words[first : first + period], len(words) - first
                    words = words[:first] + (unit * (rest // period + 1))[:rest]
                runs = runs_of(numbered(words)) if len(words) >= MIN_LENGTH else []
                counts.append(len(words))
                found.append(runs)
                texts.append(collapsed(words, runs))
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, structs), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def run_digests(runs: DataFrame) -> DataFrame:
    """Number, strongest run (greatest length by period; ties: smallest start, then period) and digests of the runs."""
    stronger = "CASE WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r ELSE best END"
    kind = "struct<start: long, length: long, period: long>"
    best = F.expr(f"aggregate(runs, CAST(NULL AS {kind}), (best, r) -> {stronger})")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    strongest = runs.withColumn("best", best)
    return strongest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
