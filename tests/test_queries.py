import pytest

from broadsheet.plans import catalogue
from tests.compare import duck, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, con, name):
    found = catalogue.queries()[name](spark, SF).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert len(found) > 0
        return
    expected = con.execute(sql).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)


def test_entry_and_register():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.queries()) <= set(entry.queries())


def test_row_order_and_partitions_do_not_matter(spark):
    from broadsheet.operators import articles as A

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = A.merge_same_titles(A.from_documents(docs)).toPandas()
    b = A.merge_same_titles(A.from_documents(docs.repartition(7).sortWithinPartitions("n_chars"))).toPandas()
    assert rows(a) == rows(b)


def test_cleaning_twice_is_cleaning_once(spark):
    from broadsheet.operators import articles as A

    once = A.clean(A.from_documents(spark.read.parquet(f"{SF}/documents.parquet")))
    assert rows(A.clean(once).toPandas()) == rows(once.toPandas())
