"""Whole tables of the smallest scale against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from deltaloom.llm import queries

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def by_doc(df):
    rows = df.collect()
    out = {r["doc_id"]: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_quality_of_held_out_rows(spark, docs):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = by_doc(queries.op1_quality_scores(spark, sf))
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["score"], labels[i], r["predicted"]) for i, r in got.items() if r["held_out"] and labels.get(i) is not None]
    good, bad = ([s for s, y, _ in held if y == k] for k in (1, 0))
    assert np.mean([p == y for _, y, p in held]) >= 0.93
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) >= 0.95


def test_mixed_words(spark, docs):
    size = {i: len(WORD.findall(r["text"] or "")) for i, r in docs.items()}
    sources = sorted({r["source"] for r in docs.values()}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, r in docs.items() if r["source"] == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    target, open_, rest = {}, set(sources), 1.5 * sum(total.values())
    while open_:
        each = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if each * weight[s] > 2 * total[s]}
        if not full:
            target |= {s: each * weight[s] for s in open_}
            break
        target |= {s: 2.0 * total[s] for s in full}
        rest, open_ = rest - sum(2.0 * total[s] for s in full), open_ - full
    got, again = (by_doc(queries.op3_mixing_words(spark, SF)) for _ in range(2))
    assert {i: r["taken"] for i, r in got.items()} == {i: r["taken"] for i, r in again.items()}
    taken = Counter()
    for i, r in docs.items():
        g = got[i]
        assert (g["size"], g["source_size"]) == (size[i], total[r["source"]]) and g["target"] == pytest.approx(target[r["source"]])
        assert 0 <= g["taken"] <= 2 * size[i]
        taken[r["source"]] += g["taken"]
    assert all(abs(taken[s] - target[s]) <= 64 + 0.001 * target[s] for s in sources)


def removed(texts, window=200):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    raw = [(t or "").encode() for t in texts]
    many = Counter(b[k : k + window] for b in raw for k in range(len(b) - window + 1))
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - window + 1):
            if many[b[k : k + window]] > 1:
                gone[k : k + window] = True
        gone = gone[:-1]
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes() if len(b) else b""
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
        yield len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def test_removed_substrings(spark, docs):
    want = dict(zip(docs, removed([r["text"] for r in docs.values()]), strict=True))
    got = by_doc(queries.op4_suffix_array_dedup(spark, SF))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want
    assert sum(n for _, n, _, _ in want.values())


def test_packed_ids(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4") for i, r in docs.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op5_packing_pieces(spark, SF).collect():
        own = ids[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) and r["doc_tokens"] == len(own)
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()

    def gapless(parts):
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        return at

    assert all(gapless(p) == len(ids[i]) for i, p in pieces.items())
    full = [gapless(p) for p in sequences.values()]
    padded = sum(0 if n & (n - 1) == 0 else 2048 - n for n in full)
    assert max(full) <= 2048 and padded <= 0.02 * sum(full)


def test_nearest_found(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    x, ids = np.array([r["embedding"] for r in rows], np.float64), np.array([r["vec_id"] for r in rows])
    got = defaultdict(list)
    for r in queries.op6_nearest_neighbours(spark, "/root/testdata/sf0.01").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    place, met, asked = {int(i): k for k, i in enumerate(ids)}, 0, 0
    for q in ids[ids % 20 == 0].tolist():
        s = x @ x[place[q]]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, len(order) + 1))
        assert all(abs(s[place[i]] - score) < 1e-9 for _, i, score in found)
        met, asked = met + len({i for _, i, _ in found} & set(ids[order].tolist())), asked + len(order)
    assert met >= 0.95 * asked


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found)


def test_personal_data_of_the_base(spark, docs):
    got = by_doc(queries.op7_personal_data(spark, SF))
    assert got.keys() == docs.keys()
    for i, r in docs.items():
        found = base(r["text"] or "")
        text = [f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in found]
        assert [got[i][c] for c in ("n_email", "n_ip", "n_card", "n_phone")] == [sum(k == n for _, k, _ in found) for n in range(4)]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert set(text) <= set(got[i]["spans"].split(","))


def test_backoff_scores(spark, docs):
    words = {i: WORD.findall((r["text"] or "").translate(LOWER)) for i, r in docs.items()}
    grams = lambda w, n: Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    own = {i: [grams(w, n) for n in (1, 2, 3)] for i, w in words.items()}
    every = [sum((o[n] for o in own.values()), Counter()) for n in range(3)]
    total = sum(map(len, words.values()))
    got = by_doc(queries.op8_backoff_scores(spark, SF))
    for i, w in words.items():
        rest = lambda g: every[len(g) - 1][g] - own[i][len(g) - 1][g]  # noqa: B023, E731
        log, others, whole = 0.0, total - len(w), 0
        for k in range(len(w)):
            value, factor = None, 1.0
            for n in range(min(3, k + 1), 1, -1):
                if rest(tuple(w[k - n + 1 : k + 1])):
                    value = factor * rest(tuple(w[k - n + 1 : k + 1])) / rest(tuple(w[k - n + 1 : k]))
                    break
                factor *= 0.4
            if value is None:
                c = rest((w[k],))
                value = factor * (c / max(others, 1) if c else 1 / (others + 1))
            log += math.log(value)
            whole += rest(tuple(w[max(0, k - 2) : k + 1])) > 0
        assert got[i]["seen_share"] == pytest.approx(whole / max(len(w), 1))
        assert got[i]["n_words"] == len(w) and got[i]["log_score"] == pytest.approx(log, rel=1e-9, abs=1e-9)


def test_licence_labels_and_scores(spark, docs):
    """Labels and scores by looking for every phrase at every word."""
    from deltaloom.llm import op10_licenses as op10

    phrases = {p: tuple(p.split()) for p in {*op10.BASE, *op10.PHRASES}}
    tag = re.compile(r"(?i)spdx-license-identifier:[ \t]*([A-Za-z0-9.+:() \t-]*)")
    got, told = by_doc(queries.op10_license_notices(spark, SF)), 0
    for i, r in docs.items():
        text = r["text"] or ""
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
        base, own = set(), set()
        for k in range(len(words)):
            here = [p for p, w in phrases.items() if w[0] == words[k] and tuple(words[k : k + len(w)]) == w]
            base |= {op10.BASE[p] for p in here if p in op10.BASE}
            if here:
                longest = max(here, key=len)
                own.add(op10.PHRASES.get(longest) or op10.BASE[longest])
        scores = [op10.OPENNESS[x] for x in own if x in op10.OPENNESS]
        for m in tag.finditer(text) if "spdx" in own else ():
            if value := op10.expression_labels(m[1]):
                own |= set(value[0])
                scores.append(value[1])
        assert got[i]["base_labels"] == ",".join(sorted(base)) and got[i]["labels"] == ",".join(sorted(base | own))
        assert got[i]["score"] == (min(scores) if scores else 0.5)
        told += bool(own)
    assert told


def test_exact_top_k_is_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.sql(queries.ORACLE_SQL["op9_exact_top_k"]).fetchall())
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in queries.op9_exact_top_k(spark, SF).collect()) == want
