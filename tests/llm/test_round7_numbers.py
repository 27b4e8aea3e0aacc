"""Round 7: rows of Parquet files are numbered where they lie and picked without a shuffle."""

import os

from pyspark.sql import functions as F

from headway.llm import common


def _written(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return [d for d in (os.listdir(f"{root}/headway") if os.path.isdir(f"{root}/headway") else []) if "numbered" in d]


def test_files_are_numbered_without_a_copy(spark, tmp_path, capsys):
    path = str(tmp_path / "docs")
    frame = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("_part"))
    frame.repartition(5).write.option("parquet.block.size", 1024).parquet(path)
    before = len(_written(spark))
    docs, row = common.numbered(spark.read.parquet(path))
    first = {r.doc_id: r[row] for r in docs.collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert {r.doc_id: r[row] for r in docs.select("doc_id", row).collect()} == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(set(first.values())) == 1000 and len(_written(spark)) == before
    some = docs.filter("doc_id % 7 = 0").select(row)
    for without in (False, True):
        got = common.picked(docs, some, row, without)
        assert got.columns == ["doc_id", "_part"]
        assert sorted(r.doc_id for r in got.collect()) == [i for i in range(1000) if (i % 7 == 0) != without]
        got.explain()
        assert "SortMergeJoin" not in capsys.readouterr().out


def test_rows_that_are_not_each_a_row_of_a_file_are_written(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(10).withColumnRenamed("id", "doc_id").write.parquet(path)
    twice = spark.read.parquet(path).select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    for docs in (twice, spark.range(20).withColumnRenamed("id", "doc_id"), spark.read.parquet(path).limit(0)):
        n = docs.count()
        numbers, row = common.numbered(docs)
        assert numbers.select(row).distinct().count() == numbers.count() == n
