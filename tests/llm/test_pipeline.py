import corpus_pipeline
from riskloom.llm.quality_cnn import quality_scores
from tests.llm.helpers import SF, empty_docs, leaks, near_groups, odd_docs
from tests.llm.test_pii import base_spans


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    good = {r.doc_id for r in quality_scores(docs, labels).where("predicted = 1").collect()}
    first = stages["quality_classifier"](spark, docs, SF).cache()
    assert set(rows(first)) == good and 0 < len(good) < docs.count()
    groups = near_groups([(r.doc_id, r.text) for r in first.collect()])
    second = stages["near_dedup"](spark, first, SF).cache()
    assert set(rows(second)) == {i for i, (_, c) in groups.items() if i == c}
    dirty = {d for d, _ in leaks([(r.doc_id, r.text) for r in second.collect()], [tuple(r) for r in items.collect()])}
    third = stages["decontamination"](spark, second, SF).cache()
    assert dirty and set(rows(third)) == set(rows(second)) - dirty
    fourth = stages["personal_data"](spark, third, SF).cache()
    before, after = rows(third), rows(fourth)
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.n_chars == len(r.text) and (r.text == before[i].text or "[" in r.text)
        assert not base_spans(r.text) or not base_spans(before[i].text)
    assert all(stage.columns == columns for stage in (first, second, third, fourth))
    last = stages["mixing"](spark, fourth, SF)
    assert set(rows(last)) == set(after) and last.columns == [*columns, "mix_rate", "mix_copies"]
    assert rows(corpus_pipeline.run(spark, SF)).keys() == after.keys()
    for stage in (first, second, third, fourth):
        stage.unpersist()


def test_stages_stand_odd_and_no_rows(spark):
    for make in (odd_docs, empty_docs):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, docs, SF)
            assert kept.columns[: len(docs.columns)] == docs.columns, name
            assert kept.count() <= docs.count()
