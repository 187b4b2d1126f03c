"""Near duplicates by min-max hashing of word shingles, with links confirmed on full shingle sets.

Each permutation keeps its minimum and its maximum over a document's shingles, so 64 permutations give 128
unbiased, nearly independent agreement bits; 25 bands of five values (a pair at similarity 0.85 meets in no band
with a chance below 5e-7). Documents with equal sets are one class from the start, and a class takes part as one row.

Inside a bucket the members are compared with one of them, the one that shares most buckets with others, never all
with all. Buckets that are not one component after that are searched further: classes that meet in such buckets,
directly or through others, form a group; the members outside the group's main component are compared with all
members, in blocks of bounded size. A block tells at most one confirmed link for each member and other component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import mix, shingle_set, text_batches, word_hashes, words_of
from riskloom.llm.components import components
from riskloom.session import materialize

PERMUTATIONS, BAND_ROWS = 64, 5
BANDS = 2 * PERMUTATIONS // BAND_ROWS
#: Shingles hashed at a time, so that a long text needs no more memory than a short one.
SHINGLE_BLOCK = 4096
#: Sketch bytes that must agree before full sets are compared: a pair at similarity 0.85 misses it with a chance of 7e-8.
SKETCH_AGREEMENT = 86
#: Rows a block of the second search has on either side.
QUERY_BLOCK, TARGET_BLOCK = 128, 256
#: Link threshold in percent.
SIMILARITY = 85
SIGNATURES = "doc_id long, n_shingles long, set_id string, bands array<long>, sketch binary"


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    draws = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64))
    return draws[:PERMUTATIONS, None] | np.uint64(1), draws[PERMUTATIONS:, None]


def extremes(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum of every permutation, as one array of 2 * PERMUTATIONS values."""
    scale, shift = multipliers()
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(shingles), SHINGLE_BLOCK):
        hashed = shingles[None, start : start + SHINGLE_BLOCK] * scale + shift
        low, high = np.minimum(low, hashed.min(axis=1)), np.maximum(high, hashed.max(axis=1))
    return np.stack([low, high], axis=1).ravel()


def signature(text: str | None) -> tuple[int, str | None, list[int] | None, bytes | None]:
    shingles = shingle_set(word_hashes().of(words_of(text)))
    if not len(shingles):
        return 0, None, None, None
    values = extremes(shingles)
    keys = np.zeros(BANDS, np.uint64)
    for row in range(BAND_ROWS):
        keys = mix(keys + values[row : BANDS * BAND_ROWS : BAND_ROWS])
    keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
    sketch = (mix(values) & np.uint64(255)).astype(np.uint8)
    set_id = xxhash.xxh3_128_hexdigest(shingles.tobytes())
    return len(shingles), set_id, keys.astype(np.int64).tolist(), sketch.tobytes()


def signatures(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
        for batch in text_batches(batches):
            columns = list(zip(*map(signature, batch["text"].to_pylist()), strict=True)) or [()] * 4
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], ["doc_id", "n_shingles", "set_id", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SIGNATURES)


def word_set(text: str) -> np.ndarray:
    return shingle_set(word_hashes().of(words_of(text)))


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    if min(len(left), len(right)) * 100 < max(len(left), len(right)) * SIMILARITY:
        return False
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * shared >= SIMILARITY * (len(left) + len(right) - shared)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough; ``texts`` has rep and text."""
    both = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] = ("", np.zeros(0, np.uint64))  # pairs of one a follow each other
        for batch in text_batches(batches):
            keep = []
            for text_a, text_b in zip(batch["text_a"].to_pylist(), batch["text_b"].to_pylist(), strict=True):
                if text_a != last[0]:
                    last = (text_a, word_set(text_a))
                keep.append(similar(last[1], word_set(text_b)))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def leaders(shared: DataFrame) -> DataFrame:
    """The member of each bucket whose buckets are the largest in sum; ties go to the smaller one."""
    weight = materialize(shared.groupBy("rep").agg(F.sum("size").alias("weight")), "weights")
    ranked = F.struct(-F.col("weight"), "rep", "n_shingles")
    return shared.join(weight, "rep").groupBy("key").agg(F.min(ranked).alias("leader"), F.first("size").alias("size")).select("key", "size", "leader.rep", "leader.n_shingles")


def leader_pairs(shared: DataFrame, heads: DataFrame) -> DataFrame:
    """Every member of a bucket with the bucket's leader, unless their sizes alone exclude a link."""
    heads = heads.select("key", F.col("rep").alias("head"), F.col("n_shingles").alias("head_size"))
    pairs = shared.join(heads, "key").where("rep <> head")
    pairs = pairs.where(F.least("n_shingles", "head_size") * 100 >= F.greatest("n_shingles", "head_size") * SIMILARITY)
    return pairs.select(F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b")).distinct()


def block_links(shared: DataFrame, heads: DataFrame, joined: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Confirmed links between members of one bucket that the leaders have left in different components."""
    placed = shared.where("size > 2").select("key", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    placed = materialize(placed.withColumn("component", F.coalesce("component", "rep")), "placed")
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    split = split.select("key").join(heads.select("key", F.col("rep").alias("head")), "key")
    meeting = materialize(placed.join(materialize(split, "open-buckets"), "key").select("rep", "component", "head"), "meeting")
    groups = components(meeting.select("rep", "head").where("rep <> head").distinct())
    member = meeting.select("rep", "component").distinct().join(groups.withColumnRenamed("node", "rep").withColumnRenamed("component", "group"), "rep", "left")
    member = materialize(member.withColumn("group", F.coalesce("group", "rep")), "group-members")
    largest = F.max(F.struct("count", "component")).alias("largest")
    shape = member.groupBy("group", "component").count().groupBy("group").agg(largest, F.sum("count").alias("size"))
    shape = shape.select("group", "size", F.col("largest.component").alias("main"), (F.col("size") - F.col("largest.count")).alias("outside"))
    rows = member.join(materialize(shape, "groups"), "group").join(texts, "rep").join(classes.select("rep", "n_shingles", "sketch"), "rep")
    rows = rows.withColumns({"queries": F.ceil(F.col("outside") / QUERY_BLOCK), "targets": F.ceil(F.col("size") / TARGET_BLOCK)})
    own = F.xxhash64("rep")
    columns = ["group", "rep", "component", "n_shingles", "sketch", "text"]
    asking = rows.where("component <> main").select(
        *columns, F.pmod(own, "queries").alias("q"), F.explode(F.sequence(F.lit(0), F.col("targets") - 1)).alias("t"), F.lit(True).alias("asks")
    )
    asked = rows.select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("queries") - 1)).alias("q"), F.pmod(own, "targets").alias("t"), F.lit(False).alias("asks")
    )

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        ask, tell = rows[rows.asks], rows[~rows.asks]
        found = []
        if len(ask) and len(tell):
            there = np.frombuffer(b"".join(tell.sketch), np.uint8).reshape(len(tell), -1)
            component, size = tell.component.to_numpy(), tell.n_shingles.to_numpy()
            sets: dict[int, np.ndarray] = {}
            for row in ask.itertuples():
                other = component != row.component
                other &= np.minimum(size, row.n_shingles) * 100 >= np.maximum(size, row.n_shingles) * SIMILARITY
                alike = (there == np.frombuffer(row.sketch, np.uint8)).sum(axis=1)
                own, reached = None, set()
                for i in np.argsort(-alike, kind="stable"):
                    if alike[i] < SKETCH_AGREEMENT:
                        break
                    if other[i] and component[i] not in reached:
                        own = word_set(row.text) if own is None else own
                        if i not in sets:
                            sets[i] = word_set(tell.text.iloc[i])
                        if similar(own, sets[i]):
                            reached.add(component[i])
                            found.append((row.rep, tell.rep.iloc[i]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return asking.unionByName(asked).groupBy("group", "q", "t").applyInPandas(block, "a long, b long").distinct()


def repeated_ids(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of a doc_id that comes with several texts."""
    several = named.groupBy("doc_id").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low <> high")
    apart = named.select("doc_id", "set_id").join(several.select("doc_id"), "doc_id")
    return apart.join(classes.select("set_id", "rep"), "set_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per distinct doc_id: doc_id, n_shingles, component_id and kept.

    Null or empty texts and texts without words have no shingles and are linked with nothing. Rows that repeat a
    doc_id count as one document (its texts, if they differ, all link it); rows without doc_id are one result row
    with a null component that is kept. Ties do not matter: the smallest doc_id names the component. Empty table:
    empty result. Other columns are ignored.
    """
    signed = materialize(signatures(docs), "signatures")
    named = signed.where("doc_id IS NOT NULL AND set_id IS NOT NULL")
    classes = named.groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    classes = materialize(classes, "classes")
    members = classes.select(F.explode("bands").alias("key"), "rep", "n_shingles")
    buckets = materialize(members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    shared = materialize(members.join(buckets, "key"), "shared-buckets")
    heads = materialize(leaders(shared), "leaders")
    nodes = materialize(shared.select("rep").distinct(), "candidates")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string")).join(nodes, "rep", "left_semi")
    texts = materialize(texts, "candidate-texts")
    first_links = materialize(confirmed(materialize(leader_pairs(shared, heads), "pairs"), texts), "links")
    more = materialize(block_links(shared, heads, components(first_links), classes, texts), "links")
    links = first_links.unionByName(more).unionByName(repeated_ids(named, classes))
    joined = components(links).withColumnRenamed("node", "rep")
    placed = classes.select("set_id", "rep").join(joined, "rep", "left")
    placed = materialize(placed.select("set_id", F.coalesce("component", "rep").alias("component")), "class-components")
    found = signed.select("doc_id", "n_shingles", "set_id").join(placed, "set_id", "left")
    result = found.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component").alias("component"))
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one per component, with all columns.

    Of rows that repeat a doc_id one stays, by a hash of the text; all rows without doc_id stay.
    """
    stay = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__stays"))
    stay = docs.join(materialize(stay, "kept"), F.col("doc_id").cast("long") == F.col("__stays"))
    place = Window.partitionBy("__stays").orderBy(F.xxhash64("text"), "text")
    stay = stay.withColumn("__place", F.row_number().over(place)).where("__place = 1")
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where("doc_id IS NULL"))


NEAR_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x09-\x0D ]+'), lambda x: x <> '') AS w FROM documents
), placed AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM placed
), sizes AS MATERIALIZED (
  SELECT doc_id, count(s) AS n FROM split LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM split UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT doc_id, n AS n_shingles, min(b) AS component_id, min(b) = doc_id AS kept FROM sizes JOIN reached ON a = doc_id GROUP BY doc_id, n
"""
