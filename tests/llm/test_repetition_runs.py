import hashlib
import random
import zlib

import numpy as np

from riskloom.llm.queries import op11_word_runs
from riskloom.llm.repetition_runs import collapsed, numbered, runs_of, suffix_array, word_runs
from tests.llm.helpers import SF, WORD, empty_docs, odd_docs


def plain_runs(words):
    """All runs by trying every period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(24, 3 * q):
                found.setdefault((start, end + q - start), q)
            start = end + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        a, g = (h // 10) % len(words), h // 10
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_suffix_array_equals_sorting():
    draw = random.Random(1)
    for size in (1, 2, 7, 40, 150):
        ids = np.array([draw.randrange(3) for _ in range(size)])
        order, place, common = suffix_array(ids)
        plain = sorted(range(size), key=lambda i: ids[i:].tolist())
        assert order.tolist() == plain and place[order].tolist() == list(range(size))
        for k in range(size - 1):
            a, b = ids[plain[k] :], ids[plain[k + 1] :]
            m = min(len(a), len(b))
            same = np.append(a[:m] == b[:m], False)
            assert common[k] == int(np.argmin(same))


def test_runs_of_random_and_built_sequences():
    draw = random.Random(2)
    for _ in range(300):
        words = []
        while len(words) < draw.choice([30, 90, 200]):
            unit = [draw.choice("abc") for _ in range(draw.randrange(1, 9))]
            words += unit * draw.choice([1, 1, 2, 3, 4, 8, 20])
            words += [draw.choice("abcde") for _ in range(draw.randrange(3))]
        assert runs_of(numbered(words)) == plain_runs(words)
    nested = (["a"] * 30 + ["b"]) * 4
    assert runs_of(numbered(nested)) == plain_runs(nested) and len(plain_runs(nested)) == 5
    assert runs_of(numbered(["w"] * 23)) == [] and runs_of(numbered(["w"] * 24)) == [(0, 24, 1)]


def test_long_texts_stay_fast():
    ids = np.zeros(200_000, np.int64)
    assert runs_of(ids) == [(0, 200_000, 1)]
    unit = np.random.default_rng(1).integers(0, 50, 30_000)
    assert runs_of(np.tile(unit, 4)) == [(0, 120_000, 30_000)]


def test_query_on_the_whole_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = {i: t for i, t in rows if len(WORD.findall(t or "")) <= 3000}
    got = {r.doc_id: tuple(r)[:8] for r in op11_word_runs(spark, SF).collect()}
    assert set(got) == {i for i, _ in rows} and len(short) > 150
    assert sum(r[1] > 0 for r in got.values()) > 5
    assert all(got[i] == expected(i, t) for i, t in short.items())


def test_odd_rows(spark):
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in word_runs(odd_docs(spark)).collect()), key=repr)
    assert len(got) == 12 and (7, 20_000, [(0, 20_000, 1)], "word") in got
    assert (1, 0, [], "") in got and (3, 0, [], "") in got and got.count((8, 2, [], "é漢🙂 ß")) == 2
    assert (None, 3, [], "a b c") in got and (None, 0, [], "") in got
    assert word_runs(empty_docs(spark)).count() == 0


def test_overlapping_runs_drop_a_word_once():
    words = "a a a b".split()
    assert collapsed([w.encode() for w in words], [(0, 3, 1), (1, 2, 1)]) == b"a b"
