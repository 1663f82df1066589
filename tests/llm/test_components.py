import pytest

from bescheid.llm.common import components


def test_a_bound_that_is_too_low_is_an_error(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    with pytest.raises(RuntimeError, match="after 1 rounds"):
        components(e, most_rounds=1)
    assert {r.root for r in components(e).collect()} == {0}
    assert components(e.limit(0), most_rounds=0).count() == 0
