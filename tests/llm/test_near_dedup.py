import random

from riskloom.llm.components import components
from riskloom.llm.near_dedup import drop_near_duplicates, near_duplicates
from tests.llm.helpers import SF, empty_docs, near_groups, odd_docs


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = near_duplicates(docs)
    assert as_dict(found) == near_groups(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def test_large_group_of_near_copies_at_the_border(spark, frame):
    draw = random.Random(3)
    words, rows = [f"w{i}" for i in range(100)], []
    for i in range(400):
        own = list(words)
        for _ in range(draw.choice([0, 1, 1, 2, 2, 3, 3, 4])):
            own[draw.randrange(100)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    draw.shuffle(rows)
    assert as_dict(near_duplicates(frame(rows, "doc_id long, text string"))) == near_groups(rows)


def test_chain_is_one_component(spark, frame):
    # each text shares all but a few shingles with the next, the ends share nothing
    rows = [(i, " ".join(f"w{k}" for k in range(4 * i, 4 * i + 104))) for i in range(40)]
    expected = near_groups(rows)
    assert {c for _, c in expected.values()} == {0}
    assert as_dict(near_duplicates(frame(rows, "doc_id long, text string"))) == expected


def test_odd_rows(spark):
    got = {r.doc_id: r for r in near_duplicates(odd_docs(spark)).collect()}
    assert set(got) == {None, 1, 2, 3, 4, 5, 6, 7, 8, 9}
    assert got[None].component_id is None and got[None].kept
    assert [(got[i].n_shingles, got[i].component_id) for i in (1, 2, 3)] == [(0, 1), (0, 2), (0, 3)]
    assert [got[i].component_id for i in (4, 5, 9)] == [4, 4, 4] and not got[5].kept
    assert got[7].n_shingles == 1


def test_one_id_with_two_texts_links_both(frame):
    rows = [(1, "a b c d e f"), (2, "u v w x y z"), (2, "a b c d e f"), (3, "u v w x y z")]
    got = as_dict(near_duplicates(frame(rows, "doc_id long, text string")))
    assert [got[i][1] for i in (1, 2, 3)] == [1, 1, 1]


def test_rows_that_stay(spark):
    docs = odd_docs(spark)
    stay = drop_near_duplicates(docs)
    assert stay.columns == docs.columns
    ids = sorted((r.doc_id for r in stay.collect()), key=str)
    assert ids == sorted([None, None, 1, 2, 3, 4, 6, 7, 8], key=str)
    assert drop_near_duplicates(empty_docs(spark)).count() == 0 and near_duplicates(empty_docs(spark)).count() == 0


def test_components_of_paths_and_stars(frame):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (300, 200), (300, 200)]
    got = {r.node: r.component for r in components(frame(links, "x long, y long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 0), **dict.fromkeys(range(101, 160), 100), 300: 200}
