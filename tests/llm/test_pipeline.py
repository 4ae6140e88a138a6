"""The corpus pipeline: each stage against what it was given."""

import re

import numpy as np
import pytest

import corpus_pipeline
from deltaloom.llm import op1_quality, op2_jaccard, op7_pii
from deltaloom.llm.common import written

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = written(stage(spark, docs, SF), name)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_names_and_columns(stages):
    assert list(stages) == ["documents", "quality", "near_duplicates", "personal_data", "mixing", "packing"]
    assert all(stages[n].columns == COLUMNS and stages[n].schema == stages["documents"].schema for n in list(stages)[1:-1])


def test_quality_keeps_what_it_accepts(spark, stages):
    scores = op1_quality.quality_scores(stages["documents"], spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(stages["quality"]) == ids(scores.where("predicted = 1"))
    bad = ids(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0"))
    assert len(ids(stages["quality"]) & bad) <= 0.1 * len(bad)


def test_one_document_of_each_class_stays(stages):
    classes = op2_jaccard.jaccard_components(stages["quality"]).collect()
    kept = ids(stages["near_duplicates"])
    assert kept == {r["component_id"] for r in classes} and len(kept) < len(classes)


def test_no_personal_data_is_left(stages):
    before = {r["doc_id"]: r["text"] for r in stages["near_duplicates"].collect()}
    after = {r["doc_id"]: r for r in stages["personal_data"].collect()}
    assert before.keys() == after.keys()
    changed = 0
    for i, text in before.items():
        assert not op7_pii.base_spans(after[i]["text"] or "") and 'token = "0' not in (after[i]["text"] or "")
        assert after[i]["n_chars"] == len(after[i]["text"])
        changed += after[i]["text"] != text
        if after[i]["text"] == text:
            assert not op7_pii.base_spans(text or "")
    assert changed


def test_mix_holds_words_of_its_documents(stages):
    before = {r["doc_id"]: r for r in stages["personal_data"].collect()}
    total, passes = 0, {}
    for r in stages["mixing"].collect():
        own, taken = WORD.findall(before[r["doc_id"]]["text"]), WORD.findall(r["text"])
        assert len(taken) <= len(own) and r["n_chars"] == len(r["text"]) and r["source"] == before[r["doc_id"]]["source"]
        it = iter(own)
        assert all(w in it for w in taken)
        passes[r["doc_id"]] = passes.get(r["doc_id"], 0) + 1
        total += len(taken)
    assert max(passes.values()) <= 2
    assert total == pytest.approx(1.5 * sum(len(WORD.findall(r["text"] or "")) for r in before.values()), rel=0.01)


def test_every_row_of_the_mix_is_packed(stages):
    rows = stages["packing"].collect()
    assert sum(r["start"] == 0 for r in rows) == stages["mixing"].count()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


def test_run_is_its_stages(spark, stages):
    told = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert len(told(corpus_pipeline.run(spark, SF))) > 0
    assert sum(r[2] for r in told(corpus_pipeline.run(spark, SF))) == sum(r[2] for r in told(stages["packing"]))


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double"


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows_and_empty_tables(spark, name, stage):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, None, "a", None, 0.5), (2, "", "en", None, 0, None), (3, words, "en", "a", 1, 1.0), (4, words, None, "b", None, 2.0), (4, words, None, "b", None, 2.0), (None, words, "en", "a", 7, 3.0), (5, "mail a.b@example.org " * 9000, "en", "b", 9, 0.0)]
    docs = spark.createDataFrame(rows, ODD)
    got = stage(spark, docs, SF)
    found = [r["doc_id"] for r in got.select("doc_id").collect()]
    least = {"near_duplicates": {1, 2, 3, 5, None}, "personal_data": {1, 2, 3, 4, 5, None}, "mixing": {3, 5}, "packing": {1, 2, 3, 4, 5, None}}
    assert least.get(name, set()) <= set(found) <= {1, 2, 3, 4, 5, None}
    assert stage(spark, docs.where("doc_id < 0"), SF).count() == 0
    if name != "packing":
        assert got.columns == docs.columns
    if name == "near_duplicates":
        assert 4 not in found
    if name == "personal_data":
        assert not any("@" in (r["text"] or "") for r in got.collect())


def test_texts_that_share_an_id(spark):
    """Different texts of one id are documents of their own, near ones of other ids or of the same one go."""
    long = [f"w{i}" for i in range(80)]
    near, other = " ".join(long), " ".join(["x", *long[1:]])
    rows = [(1, "a b c d e f g", "p"), (1, "totally other words in here now", "q"), (1, "totally other words in here now", "q"), (1, "", "r"), (1, None, "s"), (2, near, "t"), (3, other, "u"), (3, "alone with this id and text", "v"), (4, near, "w"), (4, other, "x"), (None, near, "y"), (5, "the same words here twice over", "b"), (5, "the same words here twice over", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = set()
    for many in (docs, docs.repartition(7)):
        got = sorted(map(tuple, op2_jaccard.keep_one_of_each(many).collect()), key=str)
        fives = [r for r in got if r[0] == 5]
        assert len(fives) == 1 and sorted({*got} - {*fives}, key=str) == sorted({r for r in rows if r[2] in "pqrstvy"}, key=str)
        assert len(got) == 8
        kept |= set(fives)
    assert len(kept) == 1
