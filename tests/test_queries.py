"""Registered queries against their SQL on the smallest tables, and under other partitionings."""

import pytest

import __spark_entry__ as entry
from compare import check

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert check(spark, SF, QUERIES[name], ORACLES[name]) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["id", "code"]
    assert df.count() > 0


@pytest.mark.parametrize("partitions", ["1", "32"])
@pytest.mark.parametrize("name", ["codelist_vectors", "concept_terms", "codemap", "ontology_edges"])
def test_same_for_other_partition_counts(spark, name, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert check(spark, SF, QUERIES[name], ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
