"""Plan shape: the flagship is one narrow stage over a pruned scan."""

from conftest import SMOKE


def _plan(df):
    """The text ``df.explain("formatted")`` prints."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_flagship_has_no_exchange_and_prunes_columns(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    plan = _plan(df)
    assert "Exchange" not in plan
    assert "[codegen id : 1]" in plan
    read_schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    for unused in ("l_partkey", "l_suppkey", "l_discount", "l_tax"):
        assert unused not in read_schema
    # Pay_Type = 'Late' over the adapter folds into a return-flag test at the scan.
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")][0]
    assert "EqualNullSafe(l_returnflag,R)" in pushed


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Invoice_ID", "Invoice_Amount", "Invoice_Due_Date", "Pay_Type", "Pay_Delay",
                          "Risk", "Model_Name"]


def test_every_query_has_doc_and_most_have_oracle():
    import __spark_entry__ as E
    from payguard.plans.catalog import REGISTRY
    assert set(E.oracle_sql()) <= set(E.queries())
    assert all(q.doc for q in REGISTRY.values())


def test_decoded_filters_typed_table_pushdown(spark, tmp_path):
    """On a typed invoice table, the flagship's filters reach the parquet scan."""
    from payguard.plans.risk_job import late_invoice_risk
    from payguard.sources.adapter import invoice_adapter
    path = str(tmp_path / "inv")
    invoice_adapter(spark, SMOKE).write.parquet(path)
    plan = _plan(late_invoice_risk(spark.read.parquet(path)))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")][0]
    assert "GreaterThan(Invoice_Amount,0.0)" in pushed and "EqualTo(Pay_Type,Late)" in pushed
