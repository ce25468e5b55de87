"""Plans that must hold at any size: nothing that grows with the documents goes through the driver."""

from grove.llm import simhash


def test_block_tables_are_not_broadcast(spark):
    marks = spark.range(2000).selectExpr("xxhash64(id) AS fingerprint")
    found = simhash.find_within(marks.limit(20), marks)
    assert found.count() == 20  # runs the adaptive plan: small tables that Spark would broadcast
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
