"""Every registered query with an oracle, whole result against whole result."""

import pytest

import __spark_entry__ as entry
from oracle.registry import ORACLE
from tests.conftest import SMALL
from tests.oracle_check import connect, difference
from wardlens.catalog import CATALOG

WITHOUT_ORACLE = {"m1_m4_kmeans", "m3_elbow", "d26_gld_fatores_hospital"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_only_iterative_queries_lack_an_oracle():
    assert set(CATALOG) - set(ORACLE) == WITHOUT_ORACLE
    assert set(ORACLE) <= set(CATALOG)
    assert CATALOG.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    assert difference(CATALOG[key](spark, SMALL), duck, ORACLE[key]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "ranking_no_mes",
        "nome_estabelecimento",
        "taxa_ocupacao",
        "var_vs_mes_anterior",
        "media_movel_3m",
    ]
