from deltaloom.llm import op2_jaccard


def test_a_partial_count_has_its_own_name(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words, f"end{i}"])) for i in range(6)] + [(9, " ".join([*words, "end0"]))]
    out = op2_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "n_verified"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert {r["component_id"] for r in got.values()} == {0} and got[9]["n_verified"] == 0
    assert 5 <= sum(r["n_verified"] for r in got.values()) // 2 <= 15
