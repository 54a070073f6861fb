"""Every registered query of the library against its SQL on the smallest tables."""

import pytest

from anchorline.plans import registry
from oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


#: Queries with a nested loop over one row, or with one task for rows of which there is one for each type, task or file.
ONE_ROW = {"named_stims": "the manifest's greatest index", "versioned_updates": "the version"}
FEW_ROWS = {"unit_type_shares": "a row for each type", "new_unit_ids": "a row for each task", "manifest_names": "a row for each task"}


def faults(df):
    """Nested loops, and exchanges to a single partition of more than partial aggregates or limits."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    loops = [x for x in lines if "NestedLoop" in x or "CartesianProduct" in x]
    single = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next((x for x in lines[i + 1 :] if "Exchange" not in x), "")
            if not any(w in below for w in ("partial_", "LocalLimit", "TakeOrdered")):
                single.append(line)
    return loops, single


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    loops, single = faults(df)
    assert (not loops or name in ONE_ROW) and (not single or name in FEW_ROWS)
    if name in registry.oracle_sql():
        assert difference(df, con, registry.oracle_sql()[name]) is None
    else:
        df.collect()
