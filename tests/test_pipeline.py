"""The stages as one run, parts of it, and a verdict table."""

import pytest
from pyspark.sql import functions as F

from galley.plans import pipeline

SF = "/root/testdata/sf0.001"


def test_run_from_and_to(spark, tmp_path):
    out = str(tmp_path / "run")
    assert pipeline.run(spark, SF, out, dry_run=True) == dict.fromkeys(["collect", "preprocess", "group", "rank", "packets"], "planned")
    assert set(pipeline.run(spark, SF, out).values()) == {"ok"}
    n = pipeline.inspect(spark, out, "preprocess").count()
    assert 0 < n <= pipeline.inspect(spark, out, "collect").count()
    ranks = [r["rank"] for r in pipeline.inspect(spark, out, "rank").select("rank").collect()]
    assert sorted(ranks) == list(range(1, len(ranks) + 1))
    assert pipeline.inspect(spark, out, "packets").groupBy("rank").agg(F.sum("granted").alias("g"), F.count(F.lit(1)).alias("n")).where("g > 12000 and g > 300 * n").count() == 0
    cut = spark.createDataFrame([(r.id, False) for r in pipeline.inspect(spark, out, "preprocess").select("id").limit(3).collect()], "id bigint, keep boolean")
    assert pipeline.run(spark, SF, out, first="preprocess", last="preprocess", verdicts=cut) == {"preprocess": "ok"}
    assert pipeline.inspect(spark, out, "preprocess").count() == n - 3


def test_unknown_stages(spark):
    with pytest.raises(ValueError, match="no stage"):
        pipeline.plan("nonsense")
