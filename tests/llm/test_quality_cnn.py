import numpy as np

from riskloom.llm.quality_cnn import CHUNK, Network, chunks_of, drop_low_quality, quality_scores
from tests.llm.helpers import empty_docs, odd_docs


def tables(spark, size="0.01"):
    return [spark.read.parquet(f"/root/testdata/sf{size}/{t}.parquet") for t in ("documents", "labels")]


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    rows = quality_scores(docs, labels).join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    right = [r.predicted == r.quality for r in rows]
    assert len(right) > 50 and np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_chunks_cover_the_whole_text():
    for size in (0, 1, 63, 64, 65, CHUNK, CHUNK + 1, 5000, 20_001):
        data = bytes(i % 251 for i in range(size))
        chunks, lengths = chunks_of(data)
        step = CHUNK - 64
        covered = np.zeros(size, bool)
        for k, (row, n) in enumerate(zip(chunks, lengths, strict=True)):
            assert bytes(row[:n].astype(np.uint8)) == data[k * step : k * step + n] and (row[n:] == 256).all()
            covered[k * step : k * step + n] = True
        assert covered.all()


def test_gradients_match_differences():
    draw = np.random.default_rng(1)
    network = Network(3)
    chunks, lengths = chunks_of(draw.integers(97, 110, 1500).astype(np.uint8).tobytes())
    doc, label, weight = np.zeros(len(chunks), int), np.array([1.0]), np.array([1.0])

    def loss():
        logit = (network.logits(chunks, lengths) * lengths).sum() / lengths.sum()
        return np.log1p(np.exp(-logit))

    found = network.gradients(chunks, lengths, doc, label, weight)
    for k, parameter in enumerate(network.parameters()):
        place = np.unravel_index(np.abs(found[k]).argmax(), found[k].shape)
        old = parameter[place].copy()
        parameter[place] = old + 2e-3
        up = loss()
        parameter[place] = old - 2e-3
        down = loss()
        parameter[place] = old
        assert abs((up - down) / 4e-3 - found[k][place]) < 0.15 * abs(found[k][place]) + 1e-3


def test_late_junk_counts_and_batches_do_not_matter(spark):
    docs, labels = tables(spark)
    from riskloom.llm.quality_cnn import fitted

    network = fitted(docs, labels)
    clean = docs.where("doc_id = 1").first().text
    score = network.score([clean, clean * 5 + "### $$$ &&& | | " * 800, ""])
    assert score[0] > 0.9 > score[1]
    assert np.allclose(network.score([clean, "", clean * 500])[0], score[0], atol=1e-5)


def test_odd_rows_and_no_labels(spark, frame):
    labels = frame([(7, 1), (7, 0), (None, 1), (6, None), (4, 1)], "doc_id long, quality int")
    got = quality_scores(odd_docs(spark), labels).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got) and all(r.held_out for r in got if r.doc_id is None)
    none = frame([], "doc_id long, quality int")
    assert {r.score for r in quality_scores(odd_docs(spark), none).collect()} == {0.5}
    assert quality_scores(empty_docs(spark), none).count() == 0
    kept = drop_low_quality(odd_docs(spark), none)
    assert kept.columns == odd_docs(spark).columns and kept.count() == 12
