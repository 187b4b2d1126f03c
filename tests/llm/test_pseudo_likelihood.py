import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from riskloom.llm.pseudo_likelihood import (
    EDGE, OTHER_BUCKETS, OWN_WORDS, ROUNDS, WindowNetwork, most_frequent, numbered, pseudo_likelihood, rare_counts, round_of, score_sequences, split_words, targets_of, trained_model, unpacked, vocabulary, within_buckets, word_counts, words,
)
from riskloom.session import materialize
from tests.llm.helpers import SF, empty_docs, odd_docs


def test_vocabulary_counts_all_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = Counter(w for r in docs.collect() for w in words(r.text))
    expected = sorted(counts, key=lambda w: (-counts[w], w))[:OWN_WORDS]
    assert vocabulary(docs) == {w: i for i, w in enumerate(expected)}


def test_windows_leave_the_word_out():
    assert WindowNetwork.windows(np.array([1, 2, 3])).tolist() == [[EDGE, EDGE, 2, 3], [EDGE, 1, 3, EDGE], [1, 2, EDGE, EDGE]]


def test_probabilities_sum_to_one():
    network, context = WindowNetwork(), np.array([[1, 2, 3, EDGE]])
    every = np.arange(EDGE)
    total = np.exp(network.log_probability(np.repeat(context, EDGE, axis=0), every)).sum()
    assert abs(total - 1) < 1e-4


def test_training_steps_follow_the_gradient():
    draw, network = np.random.default_rng(0), WindowNetwork()
    target = draw.integers(0, 50, 4000)
    context = np.stack([target + 1, target + 2, target + 3, target + 4], axis=1)
    first = network.log_probability(context, target).mean()
    for _ in range(60):
        network.train(context, target)
    assert network.log_probability(context, target).mean() > first + 2


def test_trained_network_prefers_real_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    numbers = vocabulary(docs)
    sequences = numbered(docs, numbers).cache()
    network = trained_model(sequences)
    total = lambda found: np.sum([r.log_likelihood for r in found]) / np.sum([r.n_words for r in found])
    scored = score_sequences(sequences, network).collect()
    real, blank = total(scored), total(score_sequences(sequences, WindowNetwork()).collect())
    # each row's sum is that of its words one by one
    row = sequences.where("doc_id = 1").first()
    ids = unpacked(row.words)
    alone = network.log_probability(WindowNetwork.windows(ids), ids).sum()
    assert abs(alone - next(r.log_likelihood for r in scored if r.doc_id == 1)) < 1e-3 * abs(alone)
    mixed = [(r.doc_id, " ".join(random.Random(1).sample(r.text.split(), len(r.text.split())))) for r in docs.collect()]
    shuffled = total(score_sequences(numbered(spark.createDataFrame(mixed, "doc_id long, text string"), numbers), network).collect())
    sequences.unpersist()
    assert real > shuffled and real > blank + 0.5


def test_odd_rows(spark):
    got = pseudo_likelihood(odd_docs(spark)).collect()
    assert len(got) == 12
    for r in got:
        assert (r.n_words == 0) == (r.mean_log_likelihood is None) and r.log_likelihood <= 0
    assert len({r.log_likelihood for r in got if r.doc_id == 8}) == 1
    assert pseudo_likelihood(empty_docs(spark)).count() == 0


def test_every_word_is_a_target_once(spark, frame):
    for count in (0, 1, 2, 7, 15, 40):
        assert sorted(np.concatenate([targets_of(count, turn) for turn in range(ROUNDS)]).tolist()) == list(range(count))
    # texts of two words train as well
    sequences = numbered(docs := frame([(i, "left right") for i in range(3000)], "doc_id long, text string"), vocabulary(docs))
    first = sequences.limit(1)
    blank, fitted = (score_sequences(first, n).first().log_likelihood for n in (WindowNetwork(), trained_model(sequences)))
    assert fitted > blank + 0.5


def test_rare_words_have_shares_of_their_buckets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = vocabulary(docs)
    rare = [(r.doc_id, [w for w in words(r.text) if w not in known]) for r in docs.collect()]
    count = Counter(w for _, own in rare for w in own)
    bucket_of = lambda w: xxhash.xxh3_64_intdigest(w) % OTHER_BUCKETS
    whole = Counter()
    for w, n in count.items():
        whole[bucket_of(w)] += n
    expected = {i: sum(math.log(count[w] / whole[bucket_of(w)]) for w in own) for i, own in rare if own}
    got = {r.row: r.within for r in within_buckets(numbered(docs, known).withColumn("row", F.col("doc_id"))).collect()}
    assert expected.keys() == got.keys() and all(abs(got[i] - v) < 1e-5 for i, v in expected.items())
    scored = pseudo_likelihood(docs)
    assert scored.columns == ["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"] and scored.count() == docs.count()


def test_whole_result_of_fifty_documents_equals_a_plain_sum(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 50")
    numbers = vocabulary(docs)
    sequences = materialize(numbered(docs, numbers).withColumn("row", F.monotonically_increasing_id()), "test-words")
    network = trained_model(sequences)
    texts = {r.doc_id: words(r.text) for r in docs.collect()}
    number = lambda w: numbers.get(w, OWN_WORDS + xxhash.xxh3_64_intdigest(w) % OTHER_BUCKETS)
    rare = Counter(w for own in texts.values() for w in own if w not in numbers)
    bucket = Counter()
    for w, n in rare.items():
        bucket[number(w)] += n
    got = {r.doc_id: r for r in score_sequences(sequences, network).collect()}
    assert len(got) == 50 and sum(rare.values()) > 100
    for doc_id, own in texts.items():
        ids, total = [number(w) for w in own], 0.0
        for k, w in enumerate(own):
            around = [ids[k + d] if 0 <= k + d < len(ids) else EDGE for d in (-2, -1, 1, 2)]
            hidden = np.tanh(np.concatenate([network.embedding[i] for i in around]) @ network.inner + network.inner_bias[0])
            by_class = hidden @ network.to_class + network.class_bias[0]
            kind, place = divmod(ids[k], network.to_word.shape[2])
            by_word = hidden @ network.to_word[kind] + network.word_bias[kind]
            total += by_class[kind] - np.log(np.exp(by_class).sum()) + by_word[place] - np.log(np.exp(by_word).sum())
            if w in rare:
                total += np.log(rare[w] / bucket[ids[k]])
        assert got[doc_id].n_words == len(own)
        assert abs(got[doc_id].log_likelihood - total) < 1e-3 * max(1.0, abs(total))


def test_a_step_reuses_its_arrays():
    draw, network = np.random.default_rng(3), WindowNetwork()
    context, target = draw.integers(0, EDGE, (4096, 4)).astype(np.uint16), draw.integers(0, EDGE, 4096).astype(np.uint16)
    for step in (network.train, network.log_probability):
        step(context, target)
        tracemalloc.start()
        step(context, target)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # one array of 4,096 rows and 64 columns has 1 MB; a step used to make several
        assert peak < 2e6


def test_texts_together_have_the_windows_of_each():
    sizes = np.array([3, 0, 1, 8, 2])
    ids = np.arange(sizes.sum(), dtype=np.uint16)
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    assert WindowNetwork.windows(ids, sizes).tolist() == [w for p in parts for w in WindowNetwork.windows(p).tolist()]
    for turn in range(ROUNDS):
        expected = [p[targets_of(len(p), turn)] for p in parts]
        assert ids[round_of(sizes, turn)].tolist() == np.concatenate(expected).tolist()


def test_words_of_a_column_are_those_of_each_text():
    texts = ["", None, " a  B ", "".join(chr(c) + "x" for c in range(128)), "İI ΑΣ ΑΣ. x\x1cy\x85z é", "\n\n", "tail\x0b"]
    found, sizes = split_words(pa.array(texts, pa.string()))
    assert [w.encode() for w in found.to_pylist()] == [w for t in texts for w in words(t)]
    assert sizes.tolist() == [len(words(t)) for t in texts]


def test_rare_words_are_counted_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    total = word_counts(docs)
    known = most_frequent(total)
    sequences = materialize(numbered(docs, known).withColumn("row", F.col("doc_id")), "rare-test")
    again = within_buckets(sequences).collect()
    assert again and sorted(within_buckets(sequences, rare_counts(total, known)).collect()) == sorted(again)
