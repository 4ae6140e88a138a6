from pyspark.sql import functions as F

from deltaloom.llm import op1_quality


def test_sample_of_labels_needs_no_task_for_a_label(spark):
    known = spark.range(0, 9000, 1, 6).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("quality"))
    few = op1_quality.drawn(known, 2000)
    ranked = known.select("quality", F.xxhash64("doc_id").alias("h"), "doc_id").collect()
    want = [tuple(r)[::2] for q in (0, 1) for r in sorted(r for r in ranked if r["quality"] == q)[:2000]]
    assert sorted((r["quality"], r["doc_id"]) for r in few.collect()) == sorted(want)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 2 and "Window" not in plan
