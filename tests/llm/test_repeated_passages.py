import hashlib
import random
from collections import Counter

import numpy as np

from riskloom.llm.common import word_hashes
from riskloom.llm.queries import op13_repeated_passages
from riskloom.llm.repeated_passages import anchors, without_repeats
from tests.llm.helpers import SF, WORD, empty_docs, odd_docs


def plain(rows):
    """Sorted (doc_id, spans, kept text) by counting every window."""
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = {k for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for k in range(i, i + 35)}
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def found(docs):
    return sorted(((r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), r.kept) for r in without_repeats(docs).collect()), key=repr)


def test_whole_table_equals_counting_every_window(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op13_repeated_passages(spark, SF).collect()), key=repr)
    want = [(i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in plain(rows)]
    assert got == want and sum(r[2] > 0 for r in got) > 10


def test_passages_at_every_offset_and_length(frame):
    draw = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(300):
        start = draw.randrange(60)
        part = passage[start : start + draw.randrange(30, 60)]
        before, after = ([f"u{draw.randrange(10**6)}" for _ in range(draw.randrange(40))] for _ in range(2))
        rows.append((i, " ".join(before + part + after)))
    rows += [(300 + i, " ".join(passage[:k])) for i, k in enumerate((33, 34, 35, 36))]
    assert found(frame(rows, "doc_id long, text string")) == plain(rows)


def test_low_variety_and_repeats_within_a_text(frame):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice("ab") for _ in range(n))) for i, n in enumerate((34, 35, 36, 80, 200))]
    rows += [(10, " ".join(["x", "y"] * 40)), (11, " ".join(["z"] * 35)), (12, " ".join(["v"] * 36))]
    own = [f"q{i}" for i in range(50)]
    rows += [(13, " ".join([*own, "mid", *own])), (14, "a\tb\n" + " ".join(own[:40]))]
    got = found(frame(rows, "doc_id long, text string"))
    assert got == plain(rows)
    assert {r[0]: r[2] for r in got}[11] == 0 and {r[0]: r[2] for r in got}[12] == 36


def test_every_window_has_one_anchor():
    draw = np.random.default_rng(1)
    for n in (34, 35, 36, 500, 70_000):
        hashes = draw.integers(0, 1 << 63, n, dtype=np.uint64)
        anchor, _, first, number = anchors(hashes)
        assert number.sum() == max(0, n - 34) and len(anchor) == len(first)
        assert not len(number) or number.max() <= 18
        assert (first[1:] == first[:-1] + number[:-1]).all()
    assert len(word_hashes().of([])) == 0


def test_odd_rows(spark, frame):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == plain(rows)
    assert without_repeats(empty_docs(spark)).count() == 0
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, long), (2, None), (None, long), (3, "x " + long), (3, "other")]
    assert found(frame(rows, "doc_id long, text string")) == plain(rows)
    alone = [(5, long), (None, None)]
    assert found(frame(alone, "doc_id long, text string")) == plain(alone)
