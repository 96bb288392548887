"""What the mix moves and writes."""

from lapidar.llm import mixing
from lapidar.llm.common import written


def test_mixed_texts_are_joined_in_one_way_whatever_their_number(spark, tmp_path):
    """Few texts are not broadcast, so small and large tables move the same share; what is written is zstd."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, f"w{i} " * (i % 5 + 1), "s") for i in range(40)], "doc_id long, text string, source string").write.parquet(path)
    plan = mixing.mixture(spark, spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert all(f.endswith(".zstd.parquet") for f in written(spark.range(3).toDF("n"), "kept").inputFiles())
