"""The registered split_inventory query against the unit-by-unit model (sf0.001)."""

import os
from collections import Counter

import pytest

from tests.test_splits import units_out

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_split_inventory_query_matches_units(spark):
    import __spark_entry__ as E
    from tillwork.plans.driver_queries import split_inventory_input

    rows = [dict(fam=r["family"], ts=str(r["ts"]), o=r["event_id"], item=r["item"], qty=r["qty"], log_type=r["log_type"],
                 tid=r["split_to"]) for r in split_inventory_input(spark, SF).collect()]
    got = Counter()
    for r in E.queries()["split_inventory"](spark, SF).collect():
        got[r["event_id"], r["invoice_id"] if r["invoice_id"].startswith("C") else None] += int(r["qty"])
    assert got == units_out(rows)
