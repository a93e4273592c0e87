import pytest

from weftline.llm.queries import ORACLE, QUERIES

from ..oracle import duck, same

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    same(spark, duck(SF), QUERIES[name], ORACLE[name], SF)


def test_one_query_for_each_operator():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
