import pytest

from glyphmill.plans.oracles import ORACLES
from glyphmill.plans.registry import QUERIES
from tests.compare import compare

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, name):
    result = compare(spark, name, FOLDER)
    assert result["ok"], result
