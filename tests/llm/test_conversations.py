"""Conversation repair against trying all edits, on hard rows, and over whole tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from deltaloom.llm import op12_conversations as op12
from deltaloom.llm import queries

SPACE = " \t\n\x0b\x0c\r"
SHAPE = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        told = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        role, text = told(role), told(text)
        own = out[conv]
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        own += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines): for each state of the grammar, turn by turn, all edits with insertions between them."""
    GO = {("start", "s"): "s", ("start", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(found):
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                for c, role in (("u", "user"), ("a", "assistant")):
                    if to := GO.get((state, c)):
                        found[to] = min(found.get(to, (10**9, "", ())), (cost + 3, audit + "I", (*lines, role + ":")))
        return found

    now = inserted({"start": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        new = {}
        for state, (cost, audit, lines) in now.items():
            steps = [(state, cost + 4, audit + "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if to := GO.get((state, role[:1])):
                    steps.append((to, cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if to := GO.get((state, c)):
                        steps.append((to, cost + 3 + extra, audit + "R", (*lines, f"{name}:{text}")))
            for to, *x in steps:
                new[to] = min(new.get(to, (10**9, "", ())), tuple(x))
        now = inserted(new)
    return min(now[s] for s in ("start", "a") if s in now)


def every_edit(rows):
    """The same by trying all sequences of edits, for very few rows."""
    kinds, best = faults(rows), (10**9, "")

    def go(i, made, cost, audit):
        nonlocal best
        if cost > best[0] or len(made) > len(rows) + 3 or not re.fullmatch("s?(ua)*u?", made):
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", made):
                best = min(best, (cost, audit))
        else:
            extra = 3 * (kinds[i] == "truncated")
            go(i + 1, made, cost + 4, audit + "D")
            if kinds[i] not in ("blank", "duplicate"):
                go(i + 1, made + (rows[i][1][:1] or "?"), cost + extra, audit + "K")
                for c in "ua":
                    go(i + 1, made + c, cost + 3 + extra, audit + "R")
        for c in "ua":
            go(i, made + c, cost + 3, audit + "I")

    go(0, "", 0, "")
    return best


def expected(rows):
    after, out = damage(rows), []
    for conv in {r[0] for r in rows}:
        own = after.get(conv, [])
        kinds = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, lines = cheapest(own)
        out.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def turns_of(rows):
    return [op12.Turn(role, text, f in ("blank", "duplicate"), 3 * (f == "truncated")) for (_, role, text), f in zip(rows, faults(rows), strict=True)]


def drawn(rng, n):
    return [(k, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b!", "c", "d?", "", f"{k}.", f"{k}."])) for k in range(n)]


def repaired(rows, segment):
    c = op12.Conversation(segment)
    for (turn, role, text), f in zip(rows, faults(rows), strict=True):
        c.add(turn, role, text, f == "blank", f == "duplicate", f == "truncated")
    return c.row()


def test_model_tries_all_edits():
    rng = random.Random(1)
    for _ in range(150):
        rows = drawn(rng, rng.randrange(5))
        assert cheapest(rows)[:2] == every_edit(rows), rows


@pytest.mark.parametrize("segment", [1, 2, 5, 1000])
def test_alignment(segment):
    rng = random.Random(segment)
    for k in range(400):
        rows = drawn(rng, rng.randrange(12 if k % 4 else 40))
        cost, audit, lines = cheapest(rows)
        assert repaired(rows, segment)[-3:] == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), rows


@pytest.mark.parametrize("roles", [["system"], ["user"], ["assistant"], ["tool"], ["user", "assistant"], ["assistant", "user", "user"]])
def test_long_runs(roles):
    rows = [(k, roles[k % len(roles)], f"{k}.") for k in range(700)]
    cost, audit, lines = cheapest(rows)
    for segment in (100, 1024):
        assert repaired(rows, segment)[-3:] == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(rows)
    assert found(queries.op12_conversation_repair(spark, f"/root/testdata/{sf}")) == want
    assert all(any(r[k] for r in want) for k in range(1, 7))


def test_hard_rows(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3, -4]), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "Übung", "", None]), rng.choice(["a.", "b", "", None, " \t", "ä?\r\n"])) for _ in range(150)]
    rows += [(100 + k, k, "user", "Only one.") for k in range(60)]  # some lose their only row
    rows += [(9, k, "user" if k % 2 == 0 else "assistant", "long text. " * 60_000 + str(k) + ".") for k in range(9)]
    want = expected(rows)
    assert any(r[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in want)
    names = "gone, copy, fault, blank, duplicate, truncated, h, g, ended, cost, audit, gaps".split(", ")
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], SHAPE + ", " + ", ".join(f"{c} long" for c in names)).repartition(3)
    assert found(op12.repaired_after_damage(df)) == want
    assert found(op12.repaired_after_damage(df, segment=3)) == want


def test_empty_table(spark):
    assert found(op12.repaired_after_damage(spark.createDataFrame([], SHAPE))) == []
