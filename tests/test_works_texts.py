"""The texts that works_convert reports come from one parse of a line."""

from ingot.plans import standins


def test_works_texts_come_from_one_parse(spark):
    plan = standins.q_works_convert(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "getjsonobject" not in plan.lower().replace("_", "")
