"""Whole tables of the smallest scale against plain Python."""

import re
from itertools import combinations

import pytest

from deltaloom.llm import queries

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: (r["text"] or "").translate(LOWER) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_jaccard_components(spark, texts):
    sets, least = {}, {i: i for i in texts}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            least[y] = x
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op2_jaccard_join(spark, SF).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in texts}


def test_license_base(spark, texts):
    phrases = ["cc by".split(), "general public license".split(), "all rights reserved".split()]
    want = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        at = [k for k in range(len(w)) for p in phrases if w[k : k + len(p)] == p]
        want[i] = (len(w), len(at), min(at, default=None), max(at, default=None))
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) for r in queries.op10_license_notices(spark, SF).collect()}
    assert got == want
