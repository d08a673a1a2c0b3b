"""Every catalog query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

from shelfspark.plans import business, catalog, checks, extraction, scalars
from tests.conftest import SF, oracle_rows, rows_of

#: One query for each operator of the graph part; the rest run the same operators.
GRAPH = ["canonical_parent", "cycle_break", "all_addresses", "curate_tags", "tag_cap", "address_union", "audit_addresses"]
CASES = [(m, k) for m in (scalars, business, extraction, checks) for k in m.QUERIES] + [(catalog, k) for k in GRAPH]


@pytest.mark.parametrize(("module", "name"), CASES, ids=[k for _, k in CASES])
def test_query(spark, duck, module, name):
    names, rows = rows_of(module.QUERIES[name](spark, SF))
    assert rows or name in ("missing_runs", "unanchored")
    if name in module.ORACLES:
        assert (names, rows) == oracle_rows(duck, module.ORACLES[name])


def test_entry_registers_all():
    import __spark_entry__ as e

    modules = (scalars, business, catalog, extraction, checks)
    assert sum(len(m.QUERIES) for m in modules) == len({k for m in modules for k in m.QUERIES})
    assert set(scalars.QUERIES) | set(business.QUERIES) | set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
