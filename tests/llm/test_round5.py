"""Round 5: fewer Python workers, smaller Arrow batches."""

import pyarrow as pa

from headway.llm import common, packing


def test_packing_runs_one_python_pass_before_writing(spark, monkeypatch):
    plans, stage = [], packing.stage

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(packing, "stage", watched)
    docs = spark.createDataFrame([(1, "a text", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert packing.pack(docs).count() > 0
    assert len(plans) == 1 and plans[0].count("MapInArrow") == 1


def test_arrow_batches_are_bounded_by_bytes(spark):
    common.ready(spark)
    df = spark.range(4000, numPartitions=1).selectExpr("repeat('x', 5000) AS t")

    def sizes(frames):
        for frame in frames:
            yield pa.RecordBatch.from_arrays([pa.array([frame.nbytes])], ["n"])

    assert max(r.n for r in df.mapInArrow(sizes, "n long").collect()) < 2 * common.ARROW_BYTES
