"""Many tables are taken in jobs of bounded plans."""

import pytest

import pactframe as pf
from pactframe.plans import constraints, run as runs
from pactframe.plans.constraints import packed, plan_table, scans_of, stored_bytes


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """Two hundred contracts over a few stored tables; every third has a foreign key, every fifth a duplicate."""
    root = tmp_path_factory.mktemp("many")
    for name, rows in {"even": [(1, 1), (2, 2), (3, 9)], "odd": [(1, 1), (1, 2), (4, None)]}.items():
        spark.createDataFrame(rows, "k int, p int").coalesce(1).write.parquet(f"{root}/{name}")
    tables = {name: spark.read.parquet(f"{root}/{name}") for name in ("even", "odd")}
    columns = (pf.Column("k", "INTEGER", nullable=False), pf.Column("p", "INTEGER"))
    contracts, kinds = [], {}
    for n in range(200):
        rules = [pf.Rule("primary_key", ("k",), "pk"), pf.Rule("check", name="ck", expression="p < 5")]
        if n % 3 == 0:
            rules.append(pf.Rule("foreign_key", ("p",), "fk", "T0", ("k",)))
        contract = pf.TableContract(f"T{n}", columns, tuple(rules))
        contracts.append(contract)
        kinds[contract.target_name] = "odd" if n % 5 == 1 else "even"
    return contracts, lambda name: tables.get(kinds.get(name))


def expected(contracts, kind_of):
    out = {}
    for n, contract in enumerate(contracts):
        odd = n % 5 == 1
        out[contract.target_name, "primary_key_duplicate"] = int(odd)
        out[contract.target_name, "check"] = 0 if odd else 1
        if n % 3 == 0:
            out[contract.target_name, "foreign_key"] = 0 if odd else 1  # parent T0 has 1, 2 and 3
    return out


def test_two_hundred_tables_in_bounded_jobs(many, monkeypatch):
    contracts, find = many
    jobs, original = [], constraints.report_of

    def spy(plans, *args, **kwargs):
        jobs.append(list(plans))
        return original(plans, *args, **kwargs)

    monkeypatch.setattr(constraints, "report_of", spy)
    report = pf.validate_tables(contracts, find).collect()
    assert sum(map(len, jobs)) == 200 and 1 < len(jobs) < 20
    assert all(sum(map(scans_of, job)) <= constraints.SCANS_PER_JOB for job in jobs)
    got = {(r["target_table"], r["kind"]): r["violations"] for r in report}
    assert {k: got[k] for k in got if k[1] in ("primary_key_duplicate", "check", "foreign_key")} == expected(contracts, find)


def test_jobs_are_packed_by_scans_bytes_and_tables(many):
    contracts, find = many
    by_name = {c.target_name: c for c in contracts}
    plans = [plan_table(c, find, by_name) for c in contracts[:12]]
    assert [scans_of(p) for p in plans[:3]] == [4, 2, 2]
    assert [len(j) for j in packed(plans, 10_000, 1 << 60)] == [12]
    for job in packed(plans, 6, 1 << 60):
        assert sum(map(scans_of, job)) <= 6
    assert all(len(job) == 1 for job in packed(plans, 1, 1 << 60))  # none is left out
    assert all(len(job) == 1 for job in packed(plans, 10_000, stored_bytes(plans[0].data)))
    assert max(len(job) for job in packed(plans, 10_000, 1 << 60, 5)) == 5
    for some in (packed(plans, 6, 1 << 60), packed(plans, 1, 1)):
        assert sorted(id(p) for job in some for p in job) == sorted(map(id, plans))
    assert packed([], 5, 5) == []


def test_a_run_packs_its_jobs_too(many, monkeypatch, spark, tmp_path):
    seen, original = [], runs.report_of

    def spy(plans, *args, **kwargs):
        seen.append(sum(map(scans_of, plans)))
        return original(plans, *args, **kwargs)

    monkeypatch.setattr(runs, "report_of", spy)
    contracts = many[0][1:40]
    store = pf.TableStore(str(tmp_path), "parquet", "packed")
    for contract in contracts:
        many[1](contract.target_name).write.parquet(store.path(contract.target_name))
    result = pf.run(spark, "validate", contracts, store, pf.RunOptions(scans_per_job=10))
    assert max(seen) <= 10 and len(seen) > 5
    assert result.outcomes.count() == len(contracts)
