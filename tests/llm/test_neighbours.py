import numpy as np
import pyarrow as pa
import pytest

from deltaloom.llm import op6_neighbours


def unit(n, width, seed=5):
    x = np.random.default_rng(seed).normal(size=(n, width))
    return x / np.linalg.norm(x, axis=1)[:, None]


def frame(spark, x):
    return spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float64()))}))


def answers(df):
    return {(r["query_id"], r["vec_id"]) for r in df.collect()}


def recall(x, got, every, k=20):
    """Share of the true neighbours, by brute force, among the pairs found."""
    met = asked = 0
    for q in range(0, len(x), every):
        s = x @ x[q]
        s[q] = -np.inf
        met += sum((q, i) in got for i in np.argpartition(s, -k)[-k:].tolist())
        asked += k
    return met / asked


@pytest.fixture
def plans(monkeypatch):
    """The plans that are made."""
    seen, planned = [], op6_neighbours.planned
    monkeypatch.setattr(op6_neighbours, "planned", lambda *a: seen.append(planned(*a)) or seen[-1])
    return seen


@pytest.mark.parametrize("n", [2_000, 10_000, 100_000])
def test_recall_at_sizes(spark, plans, n):
    """Random directions, of which no query has near ones: all tables but those of one block go through orderings."""
    x = unit(n, 64)
    found = recall(x, answers(op6_neighbours.nearest(frame(spark, x), every=n // 100)), n // 100)
    assert found >= 0.91 if n > 2_000 else found == 1
    assert [len(p.orderings) > 1 and p.blocks > 4 for p in plans] == [True] * (n > 2_000)


def test_less_is_scored_of_more_rows(plans):
    """The same kind of vectors, more of them: the share of pairs that are scored falls."""
    share = []
    for n in (10_000, 50_000, 200_000):
        x = unit(n, 32)
        ids = np.arange(n)
        asked = [(x[q], q, x[near], near) for q in range(0, n, n // 100) for near in [np.argsort(-(x @ x[q]))[1:21]]]
        op6_neighbours.planned(n, n // 20, x[:: n // 8000], ids[:: n // 8000], 1.0, asked, 3)
        share.append(plans[-1].scored)
        assert plans[-1].recall >= op6_neighbours.TARGET and plans[-1].orderings
    assert share[0] > share[1] > share[2] and share[2] <= 0.5, share


def test_orderings_reach_the_target_and_ignore_partitions(spark, plans):
    """Whatever the number of partitions, the answers are the same."""
    x, found = unit(20_000, 12), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (2, 9):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(answers(op6_neighbours.nearest(frame(spark, x), every=200)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and recall(x, found[0], 200) >= 0.91
    assert all(p.orderings and p.scored < 0.4 for p in plans)


def test_equal_vectors_over_a_block(spark, plans):
    """Thousands of copies and a few lone rows: windows are uneven, and the answers those of brute force."""
    x = np.concatenate([np.repeat(unit(3, 16), 3_000, axis=0), unit(300, 16, 8)])
    got = answers(op6_neighbours.nearest(frame(spark, x), every=100))
    assert len(got) == 20 * 93
    for q in range(0, len(x), 100):
        s = x @ x[q]
        s[q] = -np.inf
        least = np.sort(s)[-20]
        assert np.mean([s[i] >= least - 1e-9 for k, i in got if k == q]) >= 0.9


def lengths(kind, n):
    if kind == "one long row":
        return np.where(np.arange(n) == 7, 30.0, 1.0)
    return np.random.default_rng(6).lognormal(0, 0.6, n)


@pytest.mark.parametrize("kind", ["one long row", "lognormal"])
def test_keys_of_differing_lengths(kind):
    x = unit(20_000, 64) * lengths(kind, 20_000)[:, None]
    made = op6_neighbours.Ordering(x[::4], np.arange(0, 20_000, 4), float(np.linalg.norm(x, axis=1).max()), 0, 3)
    cells = made.keys(x, np.arange(20_000), False) >> op6_neighbours.TIE_BITS
    assert len(np.unique(cells)) > 15_000
    q = x[:100]
    assert (made.keys(q, np.arange(100), True) == made.keys(5 * q, np.arange(100), True)).all()


@pytest.mark.parametrize("kind", ["one long row", "lognormal"])
def test_recall_with_differing_lengths(spark, kind):
    x = unit(20_000, 12) * lengths(kind, 20_000)[:, None]
    assert recall(x, answers(op6_neighbours.nearest(frame(spark, x), every=200)), 200) >= 0.9
