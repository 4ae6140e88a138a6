import math
import random

import pytest

from deltaloom.llm import op9_exact

SCHEMA = "vec_id long, embedding array<double>"


def by_hand(rows, query, k=10):
    v = [math.floor(1024 * x) for x in dict(rows)[query]]
    score = {i: sum(a * math.floor(1024 * x) for a, x in zip(v, e)) for i, e in rows if i != query}
    return sorted(((i, s) for i, s in score.items()), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("large", [262144.0, 3.0e6, -5.0e9, 2.0e12])
def test_outliers_take_part(spark, large):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(1, 40)]
    rows += [(100, [1.0, 0.5, -0.25, 0.0, 0.0, 1.0]), (41, [large, 1.0, 0.0, 0.0, 0.0, 0.0]), (200, [0.25, large, 0.0, 0.0, 0.0, 0.0])]
    out = op9_exact.exact_top_k(spark.createDataFrame(rows, SCHEMA)).orderBy("query_id", "rank").collect()
    for q in (100, 200):
        assert [(r["vec_id"], r["score"]) for r in out if r["query_id"] == q] == by_hand(rows, q)


def test_cancelling_products_are_exact(spark):
    big = 2.0**40
    rows = [(100, [big, big, 1.0]), (1, [big, -big, 3.0]), (2, [0.0, 0.0, 4.0]), (3, [big, -big, 5.0])]
    out = op9_exact.exact_top_k(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in out] == [(3, 5 << 20), (2, 4 << 20), (1, 3 << 20)]


@pytest.mark.parametrize("sign", [1, -1])
def test_scores_beyond_64_bits_are_refused(spark, sign):
    v = spark.createDataFrame([(100, [1e9]), (1, [sign * 1e9])], SCHEMA)
    with pytest.raises(Exception, match="fit 64 bits"):
        op9_exact.exact_top_k(v).collect()


def test_too_low_scores_give_way(spark):
    """A score far below 64 bits is no answer where enough others are higher."""
    v = spark.createDataFrame([(100, [1e9]), (1, [-1e9])] + [(i, [i / 1024]) for i in range(2, 30)], SCHEMA)
    out = op9_exact.exact_top_k(v.coalesce(1)).orderBy("rank").collect()
    assert [r["vec_id"] for r in out] == list(range(29, 19, -1))
