
import numpy as np
import pytest

from deltaloom.llm import op1_quality, op2_jaccard, op3_mixing, op4_substrings, op5_packing, op6_neighbours, op7_pii, op8_backoff, op9_exact, op10_licenses
from deltaloom.llm.suffix_arrays import suffix_array

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, node long"
WORDS = "one two three four five six seven eight nine ten eleven twelve".split()


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, 0.5, 7) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(WORDS[i * i % 12] + str(i % 97) for i in range(4000))
    return docs(spark, [(1, None, "a"), (2, "", None), (3, "x", "b"), (4, long, "a"), (5, long, "a"), (5, long, "a"), (None, long + " tail", "b"), (None, None, None), (6, " ".join(WORDS), "c")])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id long, quality int, toxic int"
EVERY = {
    "quality": lambda s, d: op1_quality.quality_scores(d, s.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 0), (5, None, 0)], LABELS)),
    "jaccard": lambda s, d: op2_jaccard.jaccard_components(d),
    "mixing": lambda s, d: op3_mixing.mixed_words(d),
    "substrings": lambda s, d: op4_substrings.without_repeats(d),
    "pii": lambda s, d: op7_pii.personal_data(d),
    "backoff": lambda s, d: op8_backoff.backoff_scores(d),
    "licenses": lambda s, d: op10_licenses.license_notices(d),
}


@pytest.mark.parametrize("name", EVERY)
def test_odd_rows_each_give_a_row(spark, odd, none, name):
    assert EVERY[name](spark, odd).count() == 9
    assert EVERY[name](spark, none).count() == 0


def test_jaccard_links(spark):
    base = [f"w{i}" for i in range(60)]
    near = base[:58] + ["x", "y"]
    out = op2_jaccard.jaccard_components(docs(spark, [(9, " ".join(base), "a"), (4, " ".join(near).upper(), "a"), (7, "lone words", "a"), (3, "LONE words", "b"), (5, "other", "b")]))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == {9: (56, 4), 4: (56, 4), 7: (1, 3), 3: (1, 3), 5: (1, 5)}


def test_removed_bytes(spark):
    common = "".join(chr(97 + (i * 7 + i // 5) % 26) for i in range(260))
    out = op4_substrings.without_repeats(docs(spark, [(1, "left " + common, "a"), (2, common + " right", "a"), (3, common[:199], "a")]))
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in out.collect()}
    assert got == {1: (260, "left "), 2: (260, " right"), 3: (0, common[:199])}


def test_suffix_arrays_match_sorting():
    rng = np.random.default_rng(3)
    for _ in range(100):
        t = np.append(rng.integers(1, 4, int(rng.integers(0, 50))), 0).astype(np.uint16)
        assert suffix_array(t, 258).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_mixing_meets_targets(spark):
    out = op3_mixing.mixed_words(docs(spark, [(i, "w " * (i % 30), "abc"[i % 3]) for i in range(300)])).collect()
    total = sum(r["size"] for r in out)
    by = {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        t = by.setdefault(r["source_size"], [r["target"], 0])
        t[1] += r["taken"]
    assert sum(t for t, _ in by.values()) == pytest.approx(1.5 * total)
    assert all(abs(k - t) <= 2 for t, k in by.values())


def shared_by_weight(sizes):
    """Targets by resharing the excess, round by round."""
    weights = [op3_mixing.WEIGHTS[k % len(op3_mixing.WEIGHTS)] for k in range(len(sizes))]
    full = set()
    while True:
        left = op3_mixing.SHARE * sum(sizes) - sum(op3_mixing.MOST * sizes[k] for k in full)
        each = left / sum(w for k, w in enumerate(weights) if k not in full) if len(full) < len(sizes) else 0
        over = {k for k, w in enumerate(weights) if k not in full and each * w > op3_mixing.MOST * sizes[k]}
        if not over:
            return [op3_mixing.MOST * n if k in full else each * weights[k] for k, n in enumerate(sizes)]
        full |= over


def test_mixing_of_a_source_for_each_document(spark):
    """Sources are not gathered anywhere: some thousand of them, in several range partitions, null last."""
    rng = np.random.default_rng(11)
    sizes = rng.geometric(0.02, 3000)
    sizes[-1], sizes[5] = 4000, 30_000
    names = sorted((f"s{k * 7919 % 100_003}" for k in range(len(sizes) - 1)), key=lambda s: s.encode()) + [None]
    rows = [(k, "w " * int(n), names[k]) for k, n in enumerate(sizes)]
    spread = docs(spark, rows).repartition(7)
    got = {r["doc_id"]: r for r in op3_mixing.mixed_words(spread).collect()}
    want = shared_by_weight(sizes.tolist())
    assert len(got) == len(rows)
    for k, n in enumerate(sizes):
        assert (got[k]["size"], got[k]["source_size"]) == (n, n) and got[k]["target"] == pytest.approx(want[k])
        assert got[k]["taken"] <= 2 * n and abs(got[k]["taken"] - want[k]) < 2 * op3_mixing.BLOCK


def test_draws_follow_the_wanted_slots(spark):
    wanted = [40_000, 0, 1, 25_000, 500, 0, 34_499]
    blocks = spark.createDataFrame(list(enumerate(wanted)), "source_id long, wanted long")
    total = sum(wanted)
    drawn = op3_mixing.draws(blocks, total, 3).collect()
    by_shard, by_source = {}, {}
    for r in drawn:
        by_shard[r["shard"]] = by_shard.get(r["shard"], 0) + r["slots"]
        by_source[r["source_id"]] = by_source.get(r["source_id"], 0) + r["slots"]
    assert by_shard == {s: min(op3_mixing.SHARD, total - s * op3_mixing.SHARD) for s in range(-(-total // op3_mixing.SHARD))}
    for k, n in enumerate(wanted):
        p = n / total
        assert abs(by_source.get(k, 0) - n) <= 6 * (total * p * (1 - p)) ** 0.5 + (0 if n != 1 else 6)
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, op3_mixing.draws(blocks.repartition(3), total, 3).collect()))


def test_repeated_rows_of_the_mix_keep_their_own_columns(spark):
    rows = [(1, "a b c d", "en", "x", 7, 0.5, 1), (1, "a b c d", "en", "x", 7, 0.5, 2), (1, "a b c d", "de", "x", 7, 0.5, 3), (2, "e f", "en", "x", 3, 0.1, 4)]
    mixed = op3_mixing.mixed_documents(spark.createDataFrame(rows, DOCS)).collect()
    passes = {k: sum(r["node"] == k for r in mixed) for k in (1, 2, 3, 4)}
    assert all(1 <= n <= 2 for n in passes.values()) and {(r["node"], r["lang"]) for r in mixed} <= {(1, "en"), (2, "en"), (3, "de"), (4, "en")}


def test_permutation_is_one_to_one():
    for n in (1, 2, 7, 100, 1025):
        assert sorted(op3_mixing.permuted(np.arange(n), n, 99).tolist()) == list(range(n))


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    texts = ["Hello  there", " lead", "a\n b", None, "word " * 5000, "x"]
    out = op5_packing.packed_pieces(docs(spark, list(zip(range(6), texts, "aaaaaa", strict=True)))).toPandas()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    import zlib

    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = out[out["doc_id"] == i].sort_values("start")
        assert own["doc_tokens"].unique().tolist() == [len(ids)] and own["length"].sum() == len(ids)
        for r in own.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= 2048
    assert all(n & (n - 1) == 0 for n in out["sequence_length"])


def test_searches_leave_bad_vectors_out(spark):
    rows = [(i, [float(i), 1.0]) for i in range(0, 120)] + [(200, None), (300, [float("nan"), 1.0]), (None, [1.0, 1.0]), (400, [None, 1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = op9_exact.exact_top_k(v).where("query_id = 100").orderBy("rank").collect()
    assert [r["vec_id"] for r in exact] == [i for i in range(119, 108, -1) if i != 100][:10]
    near = op6_neighbours.nearest(v).where("query_id = 20").orderBy("rank").collect()
    assert [r["vec_id"] for r in near] == list(range(119, 99, -1))
    empty = v.where("vec_id < 0")
    assert op9_exact.exact_top_k(empty).count() == 0 and op6_neighbours.nearest(empty).count() == 0


def test_base_spans():
    text = "a@b.co 1.2.3.4 999.1.1.1 x 4532015112830366 +1 (988) 555-2485"
    assert op7_pii.joined(op7_pii.base_spans(text)) == "email:0:6,ip:7:14,card:27:43,phone:44:61"


def test_licences():
    assert op10_licenses.expression_labels("MIT or (GPL-2.0-only with X-exception and BSD-3-Clause)") == (["mit", "gpl", "bsd"], 1.0)
    assert op10_licenses.expression_labels("or MIT") is None


def test_packed_keys_round_trip():
    rng = np.random.default_rng(5)
    for bits in (20, 48, 56, 64):
        for n in (0, 1, 7, 50_000):
            keys = np.unique(rng.integers(0, 2**bits - 1, n, dtype=np.uint64, endpoint=True))
            assert (op8_backoff.unpacked(op8_backoff.packed(keys)) == keys).all()
