"""Golden counts measured for the flagship on the adapter view."""

from pyspark.sql import functions as F


def test_flagship_counts_sf001(spark):
    import __spark_entry__ as E
    df = E.queries()["late_invoice_risk"](spark, "/root/testdata/sf0.01")
    counts = {r.Risk: r.n for r in df.groupBy("Risk").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"Low": 801, "Medium": 8528, "High": 10717}
    assert sum(counts.values()) == 20046
