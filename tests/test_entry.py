from __future__ import annotations

import __spark_entry__ as entry


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_contract():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 45
