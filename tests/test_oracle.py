"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

from conftest import SMOKE


def test_all_queries_match_oracle(spark):
    from tools.oracle_check import compare
    res = compare(spark, SMOKE, verbose=False)
    bad = {k: v for k, v in res.items() if v.get("ok") is False}
    assert not bad, bad
    assert sum(1 for v in res.values() if v.get("ok")) >= 30
