import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from headway.llm import queries

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries_run_on_the_smallest_tables(spark, name):
    assert entry_points.queries()[name](spark, SF).count() > 0


def test_stages_one_after_the_other(spark, tmp_path):
    docs = whole = spark.read.parquet(f"{SF}/documents.parquet")
    counts = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == whole.columns
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        counts.append(docs.select("doc_id").distinct().count())
    assert whole.count() > counts[0] > counts[1] == counts[2] == counts[3] == counts[4] > 0
    once = {tuple(r) for r in docs.drop("sequence_id", "offset", "ids").collect()}
    again = corpus_pipeline.run(spark, SF)
    assert {tuple(r) for r in again.drop("sequence_id", "offset", "ids").collect()} == once


def test_stages_on_an_empty_table(spark, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_rows_go_to_python_in_small_batches(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from headway.llm.stage import staged

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    # All 40 MB of a task were one batch.
    rows = staged(texts.mapInArrow(sizes, "n long, size long"), "sizes").collect()
    assert sum(r.n for r in rows) == 4000
    assert max(r.size for r in rows) < (8 << 20) + 100_000
    assert spark.conf.get(setting) == before
    # A size that the session sets stays.
    spark.conf.set(setting, "2m")
    try:
        rows = staged(texts.mapInArrow(sizes, "n long, size long"), "sizes").collect()
        assert max(r.size for r in rows) < (2 << 20) + 100_000
        assert spark.conf.get(setting) == "2m"
    finally:
        spark.conf.unset(setting)
