import pytest

from corpuscope.config import EngineConfig
from corpuscope.operators import terms


def _vocabulary(spark):
    # One term each of the frequencies 50, 40 and 3, then 100 of 2 and 1,000 of 1.
    listed = [("aa", 50), ("bb", 40), ("cc", 3)]
    listed += [(f"two{i:03d}", 2) for i in range(100)] + [(f"one{i:04d}", 1) for i in range(1000)]
    return terms.vocabulary_of(spark.createDataFrame(listed, "term string, df long"), 60)


@pytest.mark.parametrize(
    ("most", "size", "cut"),
    [
        (2000, 1 << 20, 0), (1102, 1 << 20, 2), (103, 1 << 20, 2), (102, 1 << 20, 3),
        (2, 1 << 20, 40), (0, 1 << 20, 51), (2000, 7000, 2), (2000, 6, 3), (2000, 1, 51),
    ],
)
def test_as_many_terms_as_may_be_are_broadcast(spark, most, size, cut):
    config = EngineConfig(broadcast_terms=most, broadcast_bytes=size)
    assert terms._frequent_cut(_vocabulary(spark), config) == cut


def test_no_terms(spark):
    empty = terms.vocabulary_of(spark.createDataFrame([], "term string, df long"), 0)
    assert terms._frequent_cut(empty, EngineConfig()) == 0
