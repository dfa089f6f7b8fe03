"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
# Queries that SQL can't express; their own tests compare them with brute force.
NOT_SQL = {"pipeline", "op1_language", "op3_bpe", "op5_token_files", "op6_quality", "op8_near_dup", "op9_secrets"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    ok, rows, why = compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok is True or name in NOT_SQL, why or "no SQL"
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 3
