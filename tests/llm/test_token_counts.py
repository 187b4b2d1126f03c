import random

import pytest

from riskloom.llm.token_counts import Vocabulary, longest_within, prefix_tables, read_table, token_counts
from tests.llm.helpers import empty_docs, odd_docs

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
PARTS = [
    "a", "the", "ing", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "é", "漢", "9", "12", "!", "###", "<|endoftext|>", "<|end",
    "|>", " ", "　", "🙂", "x" * 30, " Ther", "\r\n", "'v",
]


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)


def exact(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_the_count_of_the_library(library):
    vocabulary, draw = Vocabulary(open(PATH, encoding="utf-8").read()), random.Random(4)
    for _ in range(200):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 12)))
        assert vocabulary.prefix_counts(text).tolist() == [exact(library, text[:i]) for i in range(len(text) + 1)], text


def test_counts_of_documents_with_odd_rows(spark, library):
    docs = odd_docs(spark)
    got = token_counts(docs, PATH, limit=5).collect()
    expected = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        n = exact(library, text or "")
        cut = max(i for i in range(len(text or "") + 1) if exact(library, text[:i]) <= 5) if text and len(text) < 100 else None
        expected.append((doc_id, len((text or "").encode()), n, n > 5, cut))
    by_key = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got)
    assert by_key == sorted((str(w[0]), *w[1:4]) for w in expected)
    cuts = {(r.doc_id, r.n_bytes): r.kept_chars for r in got}
    for doc_id, n_bytes, _, _, cut in expected:
        assert cut is None or cuts[doc_id, n_bytes] == cut or doc_id is None


def test_stored_tables_answer_budgets(spark, library):
    docs = spark.createDataFrame([(1, "The cat sat on the mat, didn't it?")], "doc_id long, text string")
    row = prefix_tables(docs, PATH).first()
    counts = read_table(row.steps)
    text = "The cat sat on the mat, didn't it?"
    assert counts.tolist() == [exact(library, text[:i]) for i in range(len(text) + 1)]
    assert exact(library, text[: longest_within(counts, 4)]) <= 4 < counts[-1]


def test_empty_table(spark):
    assert token_counts(empty_docs(spark), PATH).count() == 0
