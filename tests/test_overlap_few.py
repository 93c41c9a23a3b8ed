from pyspark.sql import functions as F

from strata.operators.intervals import overlap_join


def _executed(plan):
    """The nodes that ran, of a plan with query stages."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return _executed(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return _executed(plan.plan())
    below = [_executed(plan.children().apply(i)) for i in range(plan.children().size())]
    return [plan] + [n for nodes in below for n in nodes]


def test_keys_with_few_rows_are_not_cut(spark):
    day = F.to_date(F.lit("2020-01-01"))
    left = spark.range(3000).select((F.col("id") % 300).alias("k"), F.col("id").alias("l"), F.date_add(day, (F.col("id") % 997).cast("int")).alias("ls"))
    left = left.withColumn("le", F.date_add("ls", 60))
    right = left.where("l < 1500 OR k = 7").select("k", F.col("l").alias("r"), F.col("ls").alias("rs"), F.col("le").alias("re"))
    out = overlap_join(left, right, ["k"], "ls", "le", "rs", "re")
    rows = out.collect()
    assert len(rows) == left.join(right, "k").where("rs <= le AND re >= ls").count()
    sent = [n.metrics().apply("numOutputRows").value() for n in _executed(out._jdf.queryExecution().executedPlan()) if n.nodeName() == "Generate"]
    assert sorted(sent) == [1505, 3000]  # one row each; with three nodes above every start it was four times that


def test_keys_of_other_types_meet(spark):
    left = spark.sql("SELECT CAST(id % 5 AS DOUBLE) * -1 AS k, id AS l, DATE'2020-01-01' AS ls, DATE'2020-01-09' AS le FROM range(100)")
    right = spark.sql("SELECT CAST(id % 5 AS INT) * -1 AS k, id AS r, DATE'2020-01-03' AS rs, DATE'2020-01-04' AS re FROM range(700)")
    assert overlap_join(left, right, ["k"], "ls", "le", "rs", "re").count() == 100 * 140
