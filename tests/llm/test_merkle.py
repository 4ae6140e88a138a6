"""The Merkle manifest against plain Python and SQL, whatever the blocks."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from deltaloom.llm import op11_merkle, queries

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(told, (doc_id, source, lang, n_chars, text))))


def levels(nodes):
    """A tree's levels, from the leaves to the one node that is left."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def way(tree, k):
    """(place, run) on each level from a node to the root."""
    for level in tree[:-1]:
        low = k // 3 * 3
        yield k - low, level[low : low + 3]
        k //= 3


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r, leaf(*r)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = levels([x for _, x in by[s]])
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for k, (r, own) in enumerate(by[s]):
            steps = [*way(trees[s], k), *way(top, at)]
            shown = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None:
                shown = leaf(r[0], r[1].replace("\n", ""), *r[2:])
            for place, run in steps:
                shown = sha("".join([*run[:place], shown, *run[place + 1 :]]))
            proof = sha("".join(d for place, run in steps for j, d in enumerate(run) if j != place))
            root = top[-1][0]
            out.append((r[0], own, trees[s][-1][0], root, proof, shown, shown == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_whole_table_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = expected(rows)
    assert found(queries.op11_merkle_manifest(spark, sf)) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.sql(queries.ORACLE_SQL["op11_merkle_manifest"]).fetchall(), key=str) == want
    assert 0 < sum(r[-1] for r in want) < len(want)


@pytest.mark.parametrize("depth", [1, 2])
def test_any_blocks(spark, depth):
    rng = random.Random(depth)
    rows = [(k, rng.choice(["a\nb", "", "x" * rng.randrange(9), None, "\n"]), rng.choice(["de", None]), rng.choice(["s", "s", "é", None, ""]), rng.choice([1, None])) for k in range(120)]
    rows += [(500 + k, "one", "en", f"t{k}", 3) for k in range(13)]  # single leaves, and more sources than a block holds
    rows += [(7, "again\n", None, "s", 1)] * 3 + [(None, "no\nid", None, "s", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    assert found(op11_merkle.verified_rows(df, depth)) == expected(rows)


def test_one_leaf_and_none(spark):
    one = [(4, "a\ntext", "en", "s", 6)]
    assert found(op11_merkle.verified_rows(spark.createDataFrame(one, SHAPE))) == expected(one)
    assert found(op11_merkle.verified_rows(spark.createDataFrame([], SHAPE))) == []


def test_long_texts_and_clashing_names(spark):
    names = "tree, digest, idx, n, block, witness, path, root, subroot, tampered, name, top, _at, _part".split(", ")
    rows = [(k, ("long text\n" * 300_000)[: 3_000_000 - k], "en", "s", k) for k in range(5)]
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], SHAPE + ", " + ", ".join(f"{c} long" for c in names))
    assert found(op11_merkle.verified_rows(df)) == expected(rows)


def test_witnesses_fold_to_the_root(spark):
    rows = [(k, str(k), None, "ab"[k % 2], 1) for k in range(50)]
    for r in op11_merkle.manifest(spark.createDataFrame(rows, SHAPE)).collect():
        assert op11_merkle.folded(bytes(r["leaf"]), bytes(r["witness"]), bytes(r["path"])) == bytes(r["root"])
        assert op11_merkle.folded(b"x" * 32, bytes(r["witness"]), bytes(r["path"])) != bytes(r["root"])
