"""Every query of the library against its DuckDB oracle (the driver's gate), on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_compare import compare, duck  # noqa: E402
from test_plans import check_plan_shape  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

import __spark_entry__ as E  # noqa: E402

from tankflow.plans import catalog  # noqa: E402

Q, O = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(Q))
def test_query(spark, con, name):
    df = Q[name](spark, SF)
    check_plan_shape(name, df)
    r = compare(spark, con, name, lambda *_: df, O.get(name), SF)
    assert r["status"] in ("MATCH", "rows-only"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


def test_rows_that_act():
    """On sf0.01 each filter, window and rejection changes something."""
    con = duck(SF.replace("sf0.001", "sf0.01"))
    n = {k: con.execute(f"SELECT count(*) FROM ({O[k]})").fetchone()[0] for k in (
        "filter_between_dates", "calendar_fields", "receipts_right_join_shift", "receipts_left_join_items", "last_n_per_cell",
        "split_history", "parse_date_lenient", "event_window_expand", "series_bounds", "first_last_row", "fuel_code_rejects")}
    assert 0 < n["filter_between_dates"] < n["calendar_fields"]                  # F3
    assert 0 < n["receipts_right_join_shift"] < n["calendar_fields"]             # J1: receipts without a shift
    assert 0 < n["last_n_per_cell"] < n["split_history"]                         # W5, A6
    assert n["parse_date_lenient"] > 0 and n["event_window_expand"] > 0          # X6, M3, S7
    assert n["first_last_row"] < n["series_bounds"]                              # F1: a series that no configuration names
    assert n["fuel_code_rejects"] > 0                                            # J11
    capped = con.execute(f"SELECT count(*) FROM ({O['dead_stock_crossing']}) WHERE capped").fetchone()[0]
    assert capped > 0


def test_every_query_of_the_readme_is_registered():
    import re
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md"), encoding="utf-8") as f:
        rows = [x.split("|") for x in f if re.match(r"\| [A-Z][0-9]", x)]
    names = {m for x in rows for m in re.findall(r"`([a-z][a-z0-9_]+)`", x[4])}
    assert len(names) > 40 and names <= set(Q), names - set(Q)
