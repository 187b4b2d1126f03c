"""Masked pseudo-likelihood of documents under a bidirectional window network, trained in numpy.

Every word is predicted from the words on both sides of it: the embeddings of the window, without the word itself,
go through one hidden layer to a softmax in two steps, over classes of words and over the words of the class. The
document's score is the sum of the log-probabilities of all its words.

The vocabulary counts all words of all documents; words beyond it share buckets by hash. Inside its bucket such a word
has the share of its count in the bucket's, over all documents: the counts of all these words are a table, and the
logs of the shares are joined to the words of each document and added to its sum. Training passes over all
documents in ROUNDS rounds: each task trains a copy of the network on its documents (every ROUNDS-th word, at an
offset that changes with document and round, is a target, so that each word is one once), and the copies are averaged,
weighted by their targets. Steps grow with what a task has trained on, so that a small corpus has enough of them. The
sum over tasks is an ordinary aggregation by parameter number, so that only one network comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_batches
from riskloom.session import materialize

#: Words with an own number, and buckets that all other words share; together CLASSES * PER_CLASS.
CLASSES, PER_CLASS = 64, 64
OTHER_BUCKETS = 256
OWN_WORDS = CLASSES * PER_CLASS - OTHER_BUCKETS
EDGE = CLASSES * PER_CLASS  # stands for what is before and after a text
SIDE, EMBEDDING, HIDDEN = 2, 16, 32
ROUNDS = 2
#: Targets of a task's first steps and of its last ones.
FIRST_STEP, LAST_STEP = 1024, 4096
RATE = 0.5
#: Bound of what goes into an exponential of 32 bits.
LOGITS = 40
#: Classes of word counts, eight for each doubling, that tell where the vocabulary ends.
COUNT_CLASSES = 8
#: Distinct words a task counts before it passes the counts on.
COUNTED_WORDS = 300_000


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ``words`` of all the texts one after the other, as one column, and how many each text has."""
    lowered = pa.array([(text or "").lower() for text in texts.to_pylist()], pa.string())
    pieces = pc.ascii_split_whitespace(lowered)
    every = pieces.flatten()
    full = pc.greater(pc.binary_length(every), 0)  # there are empty pieces before and after a text
    text_of = np.repeat(np.arange(len(texts)), pc.list_value_length(pieces).to_numpy())
    return every.filter(full), np.bincount(text_of[full.to_numpy(zero_copy_only=False)], minlength=len(texts))


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n: how often each word occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for batch in text_batches(batches):
            counts = pc.value_counts(split_words(batch["text"])[0])
            parts.append(pa.table([counts.field(0).cast(pa.binary()), counts.field(1)], ["word", "n"]))
            if sum(part.num_rows for part in parts) >= 2 * COUNTED_WORDS:
                parts = [_added(parts)]
                if parts[0].num_rows >= COUNTED_WORDS:
                    yield from parts.pop().to_batches()
        if parts:
            yield from _added(parts).to_batches()

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long")
    return materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def vocabulary(docs: DataFrame) -> dict[bytes, int]:
    """Numbers of the most frequent words of all documents; ties go to the smaller word."""
    return most_frequent(word_counts(docs))


def most_frequent(total: DataFrame) -> dict[bytes, int]:
    # a few hundred rows tell the class of counts in which the vocabulary ends; only words from there on are ordered
    kind = F.floor(F.log2("n") * COUNT_CLASSES)
    sizes = total.groupBy(kind.alias("kind")).agg(F.count("*").alias("words")).collect()
    lowest, held = 0, 0
    for row in sorted(sizes, key=lambda r: -r.kind):
        if held >= OWN_WORDS:
            break
        lowest, held = row.kind, held + row.words
    top = materialize(total.where(kind >= lowest).orderBy(F.desc("n"), "word").limit(OWN_WORDS), "vocabulary")
    ordered = sorted(top.collect(), key=lambda r: (-r.n, bytes(r.word)))
    return {bytes(r.word): number for number, r in enumerate(ordered)}


def rare_counts(total: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """hash and n of the words outside the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(list(numbers), pa.binary())
        for batch in batches:
            rare = batch.filter(pc.invert(pc.is_in(batch["word"], value_set=known)))
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(rare["word"]).view(np.int64)), rare["n"]], ["hash", "n"])

    return total.mapInArrow(run, "hash long, n long")


def _hashes(found: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found.to_numpy(zero_copy_only=False)), np.uint64, len(found))


def _added(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"]).combine_chunks()


def numbered(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id and its words as 16-bit numbers, two bytes each; read by every later pass in place of the texts.

    ``rest`` has the 64-bit hashes of the distinct words outside the vocabulary, ``times`` how often each occurs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number_of = pa.array(list(numbers), pa.binary()).cast(pa.string()), np.array([*numbers.values(), 0], np.uint16)
        for batch in text_batches(batches):
            found, sizes = split_words(batch["text"])
            place = pc.index_in(found, value_set=known)
            outside = place.is_null().to_numpy(zero_copy_only=False)
            ids = number_of[place.fill_null(-1).to_numpy()]
            others = found.filter(pa.array(outside)).dictionary_encode()
            hashes = _hashes(others.dictionary.cast(pa.binary()))
            other = others.indices.to_numpy().astype(np.int64)
            ids[outside] = OWN_WORDS + hashes[other] % OTHER_BUCKETS
            row_of = np.repeat(np.arange(len(sizes)), sizes)[outside]
            # a row and one of its other words as one number
            pairs, times = np.unique(row_of * max(len(hashes), 1) + other, return_counts=True)
            row_of, other = np.divmod(pairs, max(len(hashes), 1))
            ends = pa.array(_ends(np.bincount(row_of, minlength=len(sizes))))
            packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(_ends(2 * sizes)), pa.py_buffer(ids)])
            rest, times = (pa.ListArray.from_arrays(ends, pa.array(values)) for values in (hashes[other].view(np.int64), times.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], packed, rest, times], ["doc_id", "words", "rest", "times"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, words binary, rest array<long>, times array<int>")


def _ends(sizes: np.ndarray) -> np.ndarray:
    """Where neighbouring values of such sizes begin, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def within_buckets(sequences: DataFrame, rare: DataFrame | None = None) -> DataFrame:
    """row and ``within``: the sum of log(count of the word / count of its bucket) over its words outside the vocabulary.

    ``rare``: hash and n, counts of these words over all documents; else they are counted here.
    Terms are summed as whole billionths, so that equal rows have equal sums in any order.
    """
    each = sequences.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w")).select("row", F.col("w.rest").alias("hash"), F.col("w.times").alias("n"))
    counts = (each if rare is None else rare).groupBy("hash").agg(F.sum("n").alias("total"))
    # OTHER_BUCKETS rows, whatever the size of the corpus; a power of two, so that the sign of the hash does not matter
    bucket = F.col("hash").bitwiseAND(F.lit(OTHER_BUCKETS - 1))
    counts = materialize(counts.withColumn("bucket", bucket), "rare-words")
    buckets = counts.groupBy("bucket").agg(F.sum("total").alias("whole"))
    shares = counts.join(F.broadcast(buckets), "bucket").select("hash", F.log(F.col("total") / F.col("whole")).alias("share"))
    term = F.round(F.col("n") * F.col("share") * 1e9).cast("long")
    # a partition's rare words fit in memory, so neither side has to be sorted
    return each.join(shares.hint("shuffle_hash"), "hash").groupBy("row").agg((F.sum(term) / 1e9).alias("within"))


def unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint16)


def word_groups(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a few documents, all their words one after the other, and how many each has."""
    packed = column.to_pylist()
    sizes = np.array([len(p) for p in packed], np.int64) // 2
    for rows in _bounded(sizes):
        yield rows, unpacked(b"".join(packed[rows[0] : rows[-1] + 1])), sizes[rows]


class WindowNetwork:
    """Parameters as one flat array, and the passes over batches of targets."""

    SHAPES = (
        (EDGE + 1, EMBEDDING),
        (2 * SIDE * EMBEDDING, HIDDEN),
        (1, HIDDEN),
        (HIDDEN, CLASSES),
        (1, CLASSES),
        (CLASSES, HIDDEN, PER_CLASS),
        (CLASSES, PER_CLASS),
    )

    def __init__(self, flat: np.ndarray | None = None):
        sizes = [int(np.prod(s)) for s in self.SHAPES]
        if flat is None:
            flat = np.random.default_rng(11).normal(0, 0.1, sum(sizes))
        self.flat = flat.astype(np.float32)
        self._kept: dict[str, np.ndarray] = {}
        cuts = np.cumsum(sizes)[:-1]
        self.embedding, self.inner, self.inner_bias, self.to_class, self.class_bias, self.to_word, self.word_bias = (
            part.reshape(shape) for part, shape in zip(np.split(self.flat, cuts), self.SHAPES, strict=True)
        )

    @staticmethod
    def windows(ids: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
        """For every word the numbers of the words on both sides of it; ``sizes``: of texts that follow one another."""
        sizes = np.array([len(ids)]) if sizes is None else sizes
        place = np.arange(len(ids)) + np.repeat(np.arange(1, len(sizes) + 1) * SIDE, sizes)
        padded = np.full(len(ids) + (len(sizes) + 1) * SIDE, EDGE, np.uint16)
        padded[place] = ids
        return np.stack([padded[place + k] for k in range(-SIDE, SIDE + 1) if k], axis=1)

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array that later steps use again: new large arrays cost more than most of the arithmetic on them."""
        size = int(np.prod(shape))
        if size > len(self._kept.get(name, ())):
            self._kept[name] = np.empty(size, np.float32)
        return self._kept[name][:size].reshape(shape)

    def _forward(self, context: np.ndarray):
        count = len(context)
        seen = self._room("seen", count, 2 * SIDE, EMBEDDING)
        self.embedding.take(context, axis=0, out=seen, mode="clip")
        seen = seen.reshape(count, -1)
        hidden = np.matmul(seen, self.inner, out=self._room("hidden", count, HIDDEN))
        hidden += self.inner_bias
        np.tanh(hidden, out=hidden)
        by_class = np.matmul(hidden, self.to_class, out=self._room("class", count, CLASSES))
        by_class += self.class_bias
        return seen, hidden, by_class

    def _sorted(self, context: np.ndarray, target: np.ndarray):
        """Targets in order of their class, so that a class is a slice: order, classes, slices of classes, places in them."""
        kind = (target // PER_CLASS).astype(np.uint8)
        order = np.argsort(kind, kind="stable")  # few distinct small numbers: a radix sort
        ends = np.cumsum(np.bincount(kind, minlength=CLASSES)).tolist()
        slices = [(one, a, b) for one, (a, b) in enumerate(zip([0, *ends], ends, strict=False)) if b > a]
        return order, context.take(order, axis=0).astype(np.intp), kind.take(order), slices, (target % PER_CLASS).take(order)

    def _by_word(self, hidden: np.ndarray, slices: list[tuple[int, int, int]]) -> np.ndarray:
        own = self._room("own", len(hidden), PER_CLASS)
        for one, a, b in slices:
            part = own[a:b]
            np.matmul(hidden[a:b], self.to_word[one], out=part)
            part += self.word_bias[one]
        return own

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        if not len(target):
            return np.zeros(0)
        order, context, kind, slices, place = self._sorted(context, target)
        _, hidden, by_class = self._forward(context)
        found, whole = _chosen(by_class, kind)
        of_word, whole_word = _chosen(self._by_word(hidden, slices), place)
        found += of_word
        found -= np.log(whole * whole_word)
        out = np.empty(len(target))
        out[order] = found
        return out

    def train(self, context: np.ndarray, target: np.ndarray) -> None:
        """One step of gradient descent on the mean log loss, embeddings at a rate per occurrence."""
        _, context, kind, slices, place = self._sorted(context, target)
        seen, hidden, by_class = self._forward(context)
        count = len(target)
        rows = np.arange(count)
        error = _shares(by_class)
        error.ravel()[rows * CLASSES + kind] -= 1
        own = _shares(self._by_word(hidden, slices))
        own.ravel()[rows * PER_CLASS + place] -= 1
        back = np.matmul(error, self.to_class.T, out=self._room("back", count, HIDDEN))
        rate = np.float32(RATE / count)
        of_word = np.float32(rate * CLASSES / 8)
        once = np.ones(count, np.float32)
        change, through = np.empty((HIDDEN, PER_CLASS), np.float32), self._room("through", count, HIDDEN)
        for one, a, b in slices:
            wrong = own[a:b]
            np.matmul(wrong, self.to_word[one].T, out=through[a:b])
            np.matmul(hidden[a:b].T, wrong, out=change)
            change *= of_word
            self.to_word[one] -= change
            self.word_bias[one] -= of_word * (once[a:b] @ wrong)
        back += through
        self.to_class -= rate * (hidden.T @ error)
        self.class_bias -= rate * (once @ error)
        hidden *= hidden
        back -= np.multiply(back, hidden, out=hidden)  # the slope of tanh is 1 - tanh ** 2
        # one row for each number of an embedding, with all places of the window one after the other
        by_number = self.inner.reshape(2 * SIDE, EMBEDDING, HIDDEN).transpose(1, 0, 2).reshape(-1, HIDDEN)
        to_seen = np.matmul(by_number, back.T, out=self._room("to_seen", len(by_number), count)).reshape(EMBEDDING, -1)
        self.inner -= rate * (seen.T @ back)
        self.inner_bias -= rate * (once @ back)
        ids = context.T.ravel()
        sums = np.stack([np.bincount(ids, one, EDGE + 1) for one in to_seen])
        # a word's rate per occurrence is that of a first step, however many occurrences this step has
        of_embedding = RATE * np.sqrt(min(1.0, FIRST_STEP / count))
        sums *= of_embedding / np.sqrt(np.maximum(np.bincount(ids, minlength=EDGE + 1), 1))
        self.embedding -= sums.T


def _bound(values: np.ndarray) -> None:
    """Keeps values within LOGITS, so that nothing overflows."""
    if not (values.max() <= LOGITS and values.min() >= -LOGITS):
        np.clip(values, -LOGITS, LOGITS, out=values)


def _shares(values: np.ndarray) -> np.ndarray:
    """Softmax of each row, in place."""
    _bound(values)
    np.exp(values, out=values)
    values *= (1 / (values @ np.ones(values.shape[1], np.float32)))[:, None]
    return values


def _chosen(values: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of one column in each row, and the row's sum of exponentials; overwrites ``values``."""
    _bound(values)
    picked = values.ravel().take(np.arange(0, values.size, values.shape[1]) + chosen)
    np.exp(values, out=values)
    return picked.astype(np.float64), (values @ np.ones(values.shape[1], np.float32)).astype(np.float64)


def targets_of(count: int, turn: int) -> np.ndarray:
    """Places of the words of a text that a round predicts; each place belongs to one round."""
    return np.arange(first_target(count, turn), count, ROUNDS)


def first_target(count: int, turn: int) -> int:
    return (count + turn) % ROUNDS


def round_of(sizes: np.ndarray, turn: int) -> np.ndarray:
    """Which words of texts that follow one another are targets of a round; as ``targets_of`` for each text."""
    before = np.repeat(np.cumsum(sizes) - sizes + first_target(sizes, turn), sizes)
    return (np.arange(len(before)) - before) % ROUNDS == 0


def train_round(sequences: DataFrame, network: WindowNetwork, turn: int) -> WindowNetwork:
    """One pass of all tasks over all documents, and the average of their networks."""
    start = network.flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WindowNetwork(start.copy())
        contexts, targets, waiting, trained = [], [], 0, 0
        for batch in text_batches(batches):
            for _, ids, sizes in word_groups(batch["words"]):
                chosen = np.flatnonzero(round_of(sizes, turn))
                contexts.append(WindowNetwork.windows(ids, sizes)[chosen])
                targets.append(ids[chosen])
                waiting += len(chosen)
                if waiting >= 2 * LAST_STEP:
                    trained = _steps(own, contexts, targets, trained)
                    contexts, targets, waiting = [], [], 0
        if waiting:
            trained = _steps(own, contexts, targets, trained)
        if trained:
            change = (own.flat.astype(np.float64) - start) * trained
            numbers_ = np.arange(len(change))
            yield pa.RecordBatch.from_arrays([pa.array(numbers_), pa.array(change), pa.array(np.full(len(change), trained))], ["number", "change", "weight"])

    parts = sequences.select("words").mapInArrow(run, "number long, change double, weight long")
    total = parts.groupBy("number").agg(F.sum("change").alias("change"), F.sum("weight").alias("weight"))
    mean = total.select("number", F.col("change") / F.col("weight")).collect()  # as many rows as the network has parameters
    flat = start.astype(np.float64)
    for number, change in mean:
        flat[number] += change
    return WindowNetwork(flat)


def _steps(network: WindowNetwork, contexts: list[np.ndarray], targets: list[np.ndarray], trained: int) -> int:
    """Steps over all the targets; returns how many the task has trained on by then."""
    context, target = np.concatenate(contexts), np.concatenate(targets)
    at = 0
    while at < len(target):
        size = min(max(FIRST_STEP, trained // 8), LAST_STEP, len(target) - at)
        network.train(context[at : at + size], target[at : at + size])
        at, trained = at + size, trained + size
    return trained


def trained_model(sequences: DataFrame) -> WindowNetwork:
    network = WindowNetwork()
    for turn in range(ROUNDS):
        network = train_round(sequences, network, turn)
    return network


def score_sequences(sequences: DataFrame, network: WindowNetwork, rare: DataFrame | None = None) -> DataFrame:
    """One row per row: doc_id, n_words, log_likelihood (the sum over all words) and mean_log_likelihood.

    Words outside the vocabulary count as their buckets, unless ``sequences`` has the numbers ``row`` of its rows.
    """
    flat = network.flat
    by_row = "row" in sequences.columns
    sent = ["doc_id", "words", *(["row"] if by_row else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WindowNetwork(flat)
        for batch in text_batches(batches):
            counts, sums = np.zeros((2, batch.num_rows))
            for rows, target, sizes in word_groups(batch["words"]):
                context = WindowNetwork.windows(target, sizes)
                found = np.concatenate([own.log_probability(context[a : a + LAST_STEP], target[a : a + LAST_STEP]) for a in range(0, len(target), LAST_STEP)] or [np.zeros(0)])
                sums[rows] = np.bincount(np.repeat(np.arange(len(rows)), sizes), found, len(rows))
                counts[rows] = sizes
            own_rows = [batch["row"]] if by_row else []
            arrays = [batch["doc_id"], pa.array(counts.astype(np.int64)), pa.array(sums), *own_rows]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "log_likelihood", "row"][: len(arrays)])

    schema = "doc_id long, n_words long, log_likelihood double" + (", row long" if by_row else "")
    scored = sequences.select(*sent).mapInArrow(run, schema)
    if by_row:
        whole = F.col("log_likelihood") + F.coalesce("within", F.lit(0.0))
        scored = scored.join(within_buckets(sequences, rare), "row", "left").select("doc_id", "n_words", whole.alias("log_likelihood"))
    return scored.withColumn("mean_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def _bounded(sizes: np.ndarray, words_at_once: int = 65_536) -> Iterator[np.ndarray]:
    """Neighbouring rows together up to about so many words."""
    group = np.cumsum(sizes) // words_at_once
    for number in np.unique(group):
        yield np.flatnonzero(group == number)


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Trains on all documents and scores all of them: one row per document row.

    Null and empty texts have no words, a sum of 0 and a null mean. Null ids are kept, repeated rows give equal
    scores, other columns are ignored. An empty table gives an empty result.
    """
    total = word_counts(docs)
    numbers = most_frequent(total)
    rows = numbered(docs, numbers).withColumn("row", F.monotonically_increasing_id())
    sequences = materialize(rows, "word-numbers")
    return score_sequences(sequences, trained_model(sequences), rare_counts(total, numbers))
