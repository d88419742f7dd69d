"""Every registered query against DuckDB."""

import sys
from pathlib import Path

import pytest
from compare import compare, connect

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.SQL)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, duck, name):
    difference = compare(contract.queries()[name](spark, FOLDER), duck, contract.oracle_sql()[name])
    assert difference is None, difference


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["anio", "mes", "mes_nombre", "cantidad_ventas", "monto_total"]
    assert not df.isEmpty()
