"""Every registered query against its DuckDB oracle (driver-style comparison)."""

import pytest

import __spark_entry__ as E
from mailsift.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], SQL[name], SF_SMALL)
    assert info["ok"], info


@pytest.mark.parametrize("name", ["prompt_text", "item_list_text", "items_panel", "summaries",
                                  "report_html"])
def test_reports_in_several_parts_match_the_sql(spark, con, name, monkeypatch):
    """The same law beyond the size of one part: bytes of the report before an item."""
    from mailsift.plans import queries
    from mailsift.plans.oracle import _sql

    monkeypatch.setattr(queries, "PART_BYTES", 5000)
    info = compare(spark, con, name, QUERIES[name], _sql(5000)[name], SF_SMALL)
    assert info["ok"] and info["rows"] > 12, info


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["report_date", "ordinal", "uid", "pos", "title", "link", "abstract"]
    assert df.count() >= 0
