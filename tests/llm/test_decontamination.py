import random

from riskloom.llm import decontamination
from riskloom.llm.decontamination import contaminated, drop_contaminated, item_blocks
from tests.llm.helpers import SF, empty_docs, leaks, odd_docs


def found(docs, items):
    return {(r.doc_id, r.item_id): r.containment for r in contaminated(docs, items).collect()}


def test_whole_table_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = leaks([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert expected and found(docs, items) == expected
    dirty = {doc for doc, _ in expected}
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - dirty


def test_short_items_in_long_documents_and_scattered_shingles(frame, monkeypatch):
    draw = random.Random(2)
    pool = [f"w{i}" for i in range(5000)]
    items = [(k, " ".join(draw.choices(pool, k=draw.choice([1, 3, 5, 6, 9, 20, 60])))) for k in range(60)]
    rows = []
    for d in range(60):
        words = draw.choices(pool, k=draw.choice([30, 300, 6000]))
        for _ in range(3):
            passage = draw.choice(items)[1].split()
            if len(passage) > 12 and draw.random() < 0.5:  # a passage in two halves, or with a changed word
                passage = passage[:8] + ["other"] + passage[9:]
            at = draw.randrange(len(words))
            words[at:at] = passage
        rows.append((d, " ".join(words)))
    docs, tests = frame(rows, "doc_id long, text string"), frame(items, "item_id long, text string")
    expected = leaks(rows, items)
    assert found(docs, tests) == expected
    # the same in several blocks of items
    blocks = list(item_blocks(tests, chars=900))
    assert len(blocks) > 1 and sorted(i for b in blocks for i in b) == sorted(items)
    monkeypatch.setattr(decontamination, "item_blocks", lambda b: iter(blocks))
    assert found(docs, tests) == expected


def test_odd_rows(spark, frame):
    items = frame([(1, "one two"), (2, None), (3, ""), (None, "a b c"), (5, "one two"), (5, "other text")], "item_id long, text string")
    got = found(odd_docs(spark), items)
    assert got == {(4, 1): 1.0, (5, 1): 1.0, (9, 1): 1.0, (4, 5): 1.0, (5, 5): 1.0, (9, 5): 1.0, (None, None): 1.0}
    none = frame([], "item_id long, text string")
    assert contaminated(odd_docs(spark), none).count() == 0 and drop_contaminated(odd_docs(spark), none).count() == 12
    assert contaminated(empty_docs(spark), items).count() == 0 and drop_contaminated(empty_docs(spark), items).count() == 0
