import re
from collections import Counter

from riskloom.llm.quality_rules import quality_rules
from tests.llm.helpers import SF, WORD, empty_docs, odd_docs


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def check_base(docs, labels):
    got = quality_rules(docs, labels).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = Counter((r.doc_id, *(r[c] for c in columns)) for r in got)
    assert found == Counter((r[0], *base(r[1])) for r in docs.select("doc_id", "text").collect())
    assert all(not (r.kept and r.base_failed) for r in got)
    return got


def test_base_counts_of_whole_texts(spark):
    check_base(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_odd_rows_and_lines(spark, frame):
    labels = frame([(1, None), (None, 1), (7, 1), (7, 0)], "doc_id long, quality int")
    check_base(odd_docs(spark), labels)
    lines = "a b\n\na b\n \nc\na b\r\n" + "k l m n k l m " * 20
    check_base(frame([(1, lines), (2, "a a a a a"), (3, "a b c a b c")], "doc_id long, text string"), labels)


def test_verdict_follows_the_likelihood_ratio(spark, frame):
    good = " ".join(f"good{i}" for i in range(60))
    good2 = " ".join(f"good{(i * 7) % 60}" for i in range(60))
    junk = " ".join(f"junk{(i * 11) % 60}" for i in range(60))
    rows = [(i, good) for i in range(20)] + [(20, good2)] + [(i, junk) for i in range(21, 30)]
    labels = frame([(i, 1) for i in range(20)] + [(21, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_rules(frame(rows, "doc_id long, text string"), labels).collect()}
    assert all(got[i].kept and got[i].llr > 0 for i in range(21))
    assert all(not got[i].kept and got[i].llr < 0 for i in range(21, 30))


def test_held_out_labels_agree(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fifth = labels.where("doc_id % 5 = 0").collect()
    got = {r.doc_id: r for r in quality_rules(docs, labels.where("doc_id % 5 <> 0")).collect()}
    agree = [got[r.doc_id].kept == (r.quality == 1) for r in fifth if not got[r.doc_id].base_failed]
    assert sum(agree) >= 0.93 * len(agree)
    assert all(got[r.doc_id].kept or got[r.doc_id].base_failed for r in fifth if r.quality == 1)


def test_no_labels_and_no_rows(spark, frame):
    labels = frame([], "doc_id long, quality int")
    row = quality_rules(frame([(1, "w " * 60 + " ".join(map(str, range(99))))], "doc_id long, text string"), labels).first()
    assert row.llr == 0.0 and row.kept == (not row.base_failed)
    assert quality_rules(empty_docs(spark), labels).count() == 0
