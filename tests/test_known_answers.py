"""Violation counts of the test tables at every scale factor."""

import pytest

from pactframe import Column, TableContract, cast_rejects, duplicate_key_groups, validate_tables
from fixture_contracts import CONTRACTS, fixture_lookup

SCALES = ("0.001", "0.01", "0.1")
# (table, kind, rule): violations at the three scale factors; every other rule has none.
EXPECTED = {
    ("lineitem", "primary_key_duplicate", "lineitem_pk"): (1161, 11785, 118144),
    ("lineitem", "check", "lineitem_discount_ck"): (2729, 26857, 269487),
    ("part", "unique_duplicate", "part_name_ix"): (50, 64, 64),
    ("documents", "unique_duplicate", "documents_text_uk"): (10, 62, 583),
    ("documents", "foreign_key", "documents_labels_fk"): (113, 601, 6020),
    ("customer", "check", "customer_solvent_ck"): (11, 122, 1332),
    ("customer", "foreign_key", "customer_has_order_fk"): (0, 0, 1),
    ("event_refs", "not_null", "value"): (201, 2014, 19810),
    ("event_refs", "check", "event_refs_value_ck"): (73, 755, 7519),
    ("event_refs", "foreign_key", "event_refs_customer_fk"): (128, 1286, 12857),
    ("line_keys", "primary_key_null", "line_keys_pk"): (82, 956, 10165),
    ("line_keys", "primary_key_duplicate", "line_keys_pk"): (1144, 11504, 115188),
    ("line_keys", "unique_duplicate", "line_keys_uk"): (1144, 11504, 115188),
    ("line_chain", "foreign_key", "chain_fk"): (3805, 37568, 376326),
}


@pytest.mark.parametrize("place,scale", list(enumerate(SCALES)))
def test_constraint_counts(spark, place, scale):
    report = validate_tables(CONTRACTS, fixture_lookup(spark, f"/root/testdata/sf{scale}"))
    found = {
        (r.target_table, r.kind, r.rule_name): r.violations
        for r in report.where("violations > 0").collect()
    }
    assert found == {rule: counts[place] for rule, counts in EXPECTED.items() if counts[place]}


@pytest.mark.parametrize("place,scale", list(enumerate(SCALES)))
def test_cast_rejects_and_long_text(spark, place, scale):
    find = fixture_lookup(spark, f"/root/testdata/sf{scale}")
    narrow = TableContract("orders", (Column("o_totalprice", "NUMBER(7,2)"),))
    assert cast_rejects(find("orders"), narrow).count() == (1190, 12043, 120096)[place]
    groups = duplicate_key_groups(find("documents"), ["text"], "unique", hash_first=True)
    assert groups.first()[0] == (10, 62, 583)[place]
