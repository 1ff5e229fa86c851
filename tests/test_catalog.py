import pytest

from workload import catalog

QUERIES = (catalog.gate_end_to_end, catalog.gate_end_to_end_rejects, catalog.gate_end_to_end_audit)


@pytest.mark.parametrize("query", QUERIES)
def test_each_call_runs_the_job_on_the_table_as_it_is(spark, monkeypatch, query):
    orders = catalog.dirty_orders
    runs, job = [], catalog.run_gate
    monkeypatch.setattr(catalog, "run_gate", lambda *args: runs.append(args) or job(*args))
    query(spark, "/root/testdata/sf0.001").collect()
    monkeypatch.setattr(catalog, "dirty_orders", lambda *args: orders(*args).limit(0))
    got = query(spark, "/root/testdata/sf0.001").collect()
    assert len(runs) == 2
    assert sum(int(r.sourcecount) for r in got if "sourcecount" in r) == 0
    assert len(got) == (query is QUERIES[2])
