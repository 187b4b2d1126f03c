"""Prefix trie of conversations; subtree totals by time-forward processing.

A node is a distinct sequence of first turns, named by a 128-bit hash chained over its turns. One pass over the sorted
turns of each conversation gives a row for each of its prefixes; grouping those by node gives the nodes with all that
does not need a subtree.

Totals go from the leaves to the root in reverse level order: Spark sorts a shard's nodes by falling depth (spilling
to disk as it must); a task reads them once, and each node sends its totals forward to its parent through a priority
queue that holds at most a bounded number of messages in memory and spills sorted runs. A shard is a subtree of at
most SHARD_ROWS prefix rows whose parent is larger. The few nodes above the shards, each standing for more than
SHARD_ROWS prefix rows, are then processed in the same way, with the summed totals of the shards' roots.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import stored

#: Prefix rows below the root of a shard, at most.
SHARD_ROWS = 100_000
#: Messages a priority queue keeps in memory, and messages read back at a time from a spilled run.
QUEUE_ROWS, READ_ROWS = 200_000, 2_000
#: Conversation ids hashed together.
ID_BLOCK = 20_000
ROOT = bytes(16)
TURNS = "conv_id long, pos long, turn binary, bytes long"
PREFIXES = "conv_id long, depth long, node binary, parent binary, bytes long, below long"
NODE = "node binary, parent binary, depth long, conv long, n_convs long, n_children long, head boolean, n_leaves long, saved_tokens long"

Message = tuple[tuple[int, bytes], int, int]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), a hash of role and text, and the UTF-8 bytes of the text.

    Turns are in order of turn (null first), then role and text; null role or text is empty; repeated rows are turns
    of their own; rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL")
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    pos = (F.row_number().over(order) - 1).cast("long")
    named = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return rows.select("conv_id", pos.alias("pos"), named.alias("turn"), F.octet_length("text").cast("long").alias("bytes"))


def branched(turns: DataFrame) -> DataFrame:
    """Every conversation c after the first h turns of conversation c - c mod 5, h being the checksum of c modulo 9.

    ``turns`` are numbered turns; it is read three times and should be stored. A row with pos -1 and no turn stands
    for each conversation, so that those left without turns are members of the root.
    """
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    own = turns.where(F.col("pos") >= kept)
    there = turns.where("pos = 0").select("conv_id")
    first = turns.where((F.pmod("conv_id", F.lit(5)) == 0) & (F.col("pos") < 8))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long")))
    first = first.withColumn("of", each).withColumn("conv_id", F.try_add("conv_id", "of")).drop("of")
    first = first.where("conv_id IS NOT NULL").where(F.col("pos") < kept).join(there, "conv_id", "left_semi")
    mark = there.selectExpr("conv_id", "-1L AS pos", "CAST(NULL AS binary) AS turn", "0L AS bytes")
    return own.unionByName(first).unionByName(mark)


def prefixes(turns: DataFrame) -> DataFrame:
    """A row for each conversation and depth: node, parent, bytes of the last text, and the rows from here to its end.

    ``turns`` has a row with pos -1 for each conversation and its turns in order of pos, which may have gaps.
    """
    whole = Window.partitionBy("conv_id")
    sized = turns.repartition("conv_id").withColumn("left", F.count("*").over(whole)).sortWithinPartitions("conv_id", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, node, depth = None, ROOT, 0
        for batch in batches:
            rows = []
            for conv_id, pos, turn, size, left in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv_id != conv:
                    conv, node, depth = conv_id, ROOT, 0
                if pos < 0:
                    rows.append((conv, 0, ROOT, None, 0, left))
                else:
                    parent, depth = node, depth + 1
                    node = xxhash.xxh3_128_digest(parent + turn)
                    rows.append((conv, depth, node, parent, size, left - depth))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in PREFIXES.split(", ")])

    return sized.select("conv_id", "pos", "turn", "bytes", "left").mapInArrow(run, PREFIXES)


class SpillingQueue:
    """Messages in order of their key; beyond ``limit`` those in memory go to a sorted run on disk.

    Runs are unnamed files in the folder where Spark lets this task spill; they are gone with the task.
    """

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, message: Message) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) >= self.limit:
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
            file = tempfile.TemporaryFile(dir=folder)  # noqa: SIM115  (closed when its run ends)
            self.heap.sort()
            for start in range(0, len(self.heap), READ_ROWS):
                pickle.dump(self.heap[start : start + READ_ROWS], file)
            file.seek(0)
            run = self._read(file)
            self.heap = []
            self.spilled += 1
            heapq.heappush(self.runs, (next(run), self.spilled, run))

    @staticmethod
    def _read(file) -> Iterator[Message]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def take(self, key: tuple[int, bytes]) -> tuple[int, int]:
        """Sums of the messages to ``key``; keys are asked for in order."""
        leaves = saved = 0
        while self.heap and self.heap[0][0] == key:
            _, more, bytes_more = heapq.heappop(self.heap)
            leaves, saved = leaves + more, saved + bytes_more
        while self.runs and self.runs[0][0][0] == key:
            (_, more, bytes_more), place, run = self.runs[0]
            leaves, saved = leaves + more, saved + bytes_more
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, place, run))
        return leaves, saved


def time_forward(nodes: DataFrame, limit: int = QUEUE_ROWS) -> DataFrame:
    """Subtree sums of n_leaves and saved_tokens, where each partition holds whole subtrees; ``head`` marks their roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for batch in batches:
            columns = {name: batch[name].to_pylist() for name in ("node", "parent", "depth", "head", "n_leaves", "saved_tokens")}
            leaves, saved = [], []
            for node, parent, depth, head, own_leaves, own_saved in zip(*columns.values(), strict=True):
                more, bytes_more = queue.take((-depth, node))
                leaves.append(own_leaves + more)
                saved.append(own_saved + bytes_more)
                if not head:
                    queue.push(((1 - depth, parent), leaves[-1], saved[-1]))
            arrays = [pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *arrays], batch.schema.names)

    ordered = nodes.sortWithinPartitions(F.col("depth").desc(), "node")
    return ordered.select(*[c.split()[0] for c in NODE.split(", ")]).mapInArrow(run, NODE)


def with_subtree_totals(nodes: DataFrame, rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes with n_leaves and saved_tokens of their whole subtrees.

    ``rows`` are the prefixes that the nodes come from. A node's shard is the first prefix, of any conversation that
    goes through it, with at most ``shard_rows`` rows below; its smallest conversation tells it.
    """
    own = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    crown = own.where(F.col("below") > shard_rows)
    small = own.where(F.col("below") <= shard_rows)
    under = crown.select(F.col("node").alias("parent"))
    heads = small.where("depth = 0").select("node").unionByName(small.join(under, "parent", "left_semi").select("node"))
    heads, _ = stored(heads, "shard-roots")
    shard = rows.join(heads, "node").select("conv_id", F.col("node").alias("shard"))
    placed = small.join(shard.withColumnRenamed("conv_id", "conv"), "conv").withColumn("head", F.col("node") == F.col("shard"))
    done, _ = stored(time_forward(placed.repartition("shard")), "shard-totals")
    sums = done.where("head AND depth > 0").groupBy(F.col("parent").alias("node"))
    sums = sums.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    above = crown.join(sums, "node", "left").withColumns({
        "head": F.col("depth") == 0,
        "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0)),
    })
    return done.unionByName(time_forward(above.repartition(1)))


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids, comma-joined, of the conversations that end at each node.

    Ids are dealt out by ranges of (node, id) and joined in blocks there; one node's blocks are then hashed one after
    the other, as such a digest has to be, without being held together.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, last = [], None
            for node, conv_id in zip(batch["node"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if node != last or len(rows[-1][2]) >= ID_BLOCK:
                    rows.append((node, conv_id, []))
                    last = node
                rows[-1][2].append(str(conv_id))
            arrays = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([",".join(r[2]) for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch["node"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if node == last:
                    digest.update(b",")
                else:
                    if last is not None:
                        done.append((last, digest.hexdigest()))
                    last, digest = node, hashlib.sha256()
                digest.update(ids.encode())
            yield _digest_batch(done)
        if last is not None:
            yield _digest_batch([(last, digest.hexdigest())])

    ranged = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").select("node", "conv_id")
    joined = ranged.mapInArrow(blocks, "node binary, first long, ids string")
    return joined.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node binary, ends_sha256 string")


def _digest_batch(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["node", "ends_sha256"])


def prefix_trie(turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie of ``turns`` (as from ``branched``), from the textless root on.

    Returns node and parent (hashes), conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs
    (members), n_children, n_leaves (childless nodes of the subtree), saved_tokens (bytes of last texts that the
    subtree's members share, counted for every member but one) and ends_sha256. Conversations without turns are
    members of the root; no conversations give no rows. Very long texts count by their bytes only; equal
    conversations share all their nodes.
    """
    rows, _ = stored(prefixes(turns), "prefixes")
    nodes = rows.groupBy("node", "parent", "depth", "bytes")
    nodes = nodes.agg(F.min("conv_id").alias("conv"), F.count("*").alias("n_convs"), F.sum("below").alias("below"))
    nodes, _ = stored(nodes, "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes, _ = stored(nodes, "nodes")
    totals = with_subtree_totals(nodes, rows, shard_rows)
    digests = end_digests(rows.where("below = 1").select("node", "conv_id"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    whole = totals.join(digests, "node", "left").join(above, "parent", "left")
    ends = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        ends.alias("ends_sha256"), "node", "parent",
    )


def branched_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of the rebuilt conversations, without the nodes' hashes."""
    turns, _ = stored(numbered_turns(conversations), "turns")
    return prefix_trie(branched(turns), shard_rows).drop("node", "parent")


TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, ((list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
         lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))) AS crc
  FROM (SELECT DISTINCT conv_id FROM t)
), kept AS (
  SELECT conv_id, xor(crc, 4294967295) % 9 AS h FROM convs
), rebuilt AS (
  SELECT k.conv_id, t.pos, t.role, t.text FROM kept k JOIN t ON t.conv_id = k.conv_id - k.conv_id % 5 AND t.pos < k.h
  UNION ALL SELECT k.conv_id, t.pos, t.role, t.text FROM kept k JOIN t ON t.conv_id = k.conv_id AND t.pos >= k.h
), chained AS (
  SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(len(role) || ':' || len(text) || ':' || role || text, '') OVER w) AS node,
         strlen(text) AS bytes FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
), prefix AS MATERIALIZED (
  SELECT conv_id, depth, node, lag(node, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent, bytes,
         depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM chained
  UNION ALL SELECT conv_id, 0, '', NULL, 0, conv_id NOT IN (SELECT conv_id FROM chained) FROM kept
), nodes AS MATERIALIZED (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM prefix GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), within AS (
  SELECT DISTINCT a.node, b.node AS below FROM prefix a JOIN prefix b ON a.conv_id = b.conv_id AND a.depth <= b.depth
), totals AS (
  SELECT w.node, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved_tokens
  FROM within w JOIN nodes n ON n.node = w.below LEFT JOIN children c ON c.node = w.below GROUP BY w.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, t.n_leaves,
       CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t USING (node) LEFT JOIN children c USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""
