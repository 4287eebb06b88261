"""The registered queries against their SQL, and the shape of the others."""

import pytest
from oracle import compare, connect

from __spark_entry__ import oracle_sql, queries
from evalspark.llm.sql import SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = connect(SF)
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) is None


def test_all_are_registered():
    found = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in found) == list(range(1, 14))
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", ["op2_suffix_dedup", "op6_mixing", "op8_quality", "op10_simhash"])
def test_one_row_per_document(spark, documents, name):
    found = queries()[name](spark, SF)
    assert found.count() == documents.count()
    assert found.select("doc_id").distinct().count() == documents.select("doc_id").distinct().count()
