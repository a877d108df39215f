import random

import pytest

from tarnspark.llm import difference_cover as D


@pytest.mark.parametrize(("n", "kinds", "small"), [(31, 2, 10), (32, 3, 10), (100, 1, 30), (400, 4, 60)])
def test_ranks_against_sorted_suffixes(spark, n, kinds, small):
    """Every remainder modulo 3, one repeated symbol, several levels of recursion."""
    r = random.Random(n)
    text = [r.randrange(1, kinds + 1) for _ in range(n)]
    got = {x.pos: x["rank"] for x in D.ranks(spark.createDataFrame(list(enumerate(text)), "pos long, sym long"), small).collect()}
    order = sorted(range(n), key=lambda i: text[i:])
    assert got == {p: i + 1 for i, p in enumerate(order)}


def test_small_and_empty_texts(spark):
    empty = spark.createDataFrame([], "pos long, sym long")
    assert D.ranks(empty).count() == 0
    assert [(x.pos, x["rank"]) for x in D.ranks(spark.createDataFrame([(0, 5)], "pos long, sym long")).collect()] == [(0, 1)]
