from __future__ import annotations

import __spark_entry__ as contract


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "disease_type", "gene_id", "gene_name", "fold_change", "chromosome", "info",
    ]
    ratios = [r.fold_change for r in df.collect()]
    assert ratios
    assert ratios == sorted(ratios, reverse=True)


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(contract.queries()) - set(contract.EXTRA_QUERIES) <= set(contract.oracle_sql())
