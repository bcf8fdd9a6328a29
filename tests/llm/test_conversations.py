"""Conversation repair against plain searches through all edits."""

import functools
import hashlib
import itertools
import random
import re
import sys
import zlib

import pytest

from wordloom.llm import conversations as c
from wordloom.llm.queries import QUERIES

sys.setrecursionlimit(20_000)
BLANK = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Fault of each (role, text), in order."""
    seen, found = set(), []
    for role, text in rows:
        bare = text.strip(BLANK)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def search(rows):
    """(cost, audit) by recursion over rows and the roles so far, without vectors."""
    found = faults(rows)

    @functools.cache
    def best(i, last, inserted):  # last: the initial of the last role that is there
        options = [(0, "")] if i == len(rows) and last in ("", "a") else []
        may_follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]

        def go(price, letter, *state):
            cost, rest = best(*state)
            options.append((cost + price, letter + rest))

        if i < len(rows):
            go(2, "D", i + 1, last, 0)
            if found[i] not in ("blank", "duplicate"):
                more = 5 if found[i] else 0
                for role, price, letter in ((rows[i][0][:1], 0, "K"), ("u", 1, "R"), ("a", 1, "R")):
                    if role and role in may_follow:
                        go(price + more, letter, i + 1, role, 0)
        if inserted < 2:  # more in one place are never of use
            for role in may_follow.replace("s", ""):
                go(5, "I", i, role, inserted + 1)
        return min(options, default=(10**9, ""))

    return best(0, "", 0)


def applied(rows, audit):
    """The repaired rows that the letters stand for."""
    out, rest = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rest)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((role, text))
    assert next(rest, None) is None
    assert LEGAL.fullmatch("".join(role[0] for role, _ in out))
    return out


def codes(rows):
    kind = {"s": c.SYSTEM, "u": c.USER, "a": c.ASSISTANT}
    number = {None: c.FINE, "truncated": c.TRUNCATED, "blank": c.BLANK, "duplicate": c.DUPLICATE}
    return bytes(kind.get(r[:1], c.OTHER) + 4 * number[f]
                 for (r, _), f in zip(rows, faults(rows)))


def some_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "User"]
    texts = ["Fine.", "Cut off", " ", "", "Again!", "What?", "x.\n", "y. z"]
    return [(rng.choice(roles), rng.choice(texts) + rng.choice(["", str(rng.random()) + "."]))
            for _ in range(n)]


def test_every_short_conversation():
    roles, texts = ["system", "user", "assistant", "tool"], ["a.", "b", " "]
    for n in range(4):
        for rows in itertools.product(itertools.product(roles, texts), repeat=n):
            rows = [(role, text.replace("a", f"a{k}")) for k, (role, text) in enumerate(rows)]
            assert c.cheapest_edits(codes(rows)) == search(rows), rows


def test_all_strings_of_letters():
    """The search itself, against trying every string of letters."""
    rng = random.Random(3)
    for _ in range(40):
        rows = some_rows(rng, rng.randrange(4))
        price, best = faults(rows), (10**9, "")
        for n in range(len(rows), len(rows) + 4):
            for audit in map("".join, itertools.product("DIKR", repeat=n)):
                if len(audit.replace("I", "")) != len(rows):
                    continue
                cost, at, last, ok = 0, 0, "", True
                for letter in audit:
                    if letter != "I":
                        fault = price[at]
                        at += 1
                        if letter == "D":
                            cost += 2
                            continue
                        ok &= fault not in ("blank", "duplicate")
                        cost += 5 if fault == "truncated" else 0
                    want = "a" if last == "u" else "u"
                    if letter == "K":
                        role = rows[at - 1][0][:1]
                        ok &= role == want or (role == "s" and last == "")
                        last = role or "?"
                    else:
                        cost += 5 if letter == "I" else 1
                        last = want
                if ok and last in ("", "a"):
                    best = min(best, (cost, audit))
        assert search(rows) == best, rows


def test_long_conversations_and_checkpoints():
    rng = random.Random(4)
    for n in (1, 2, 3, 4, 5, 8, 9, 10, 15, 16, 17, 60, 150):
        rows = some_rows(rng, n)
        assert c.cheapest_edits(codes(rows)) == search(rows)
    cost, audit = c.cheapest_edits(bytes([c.USER, c.ASSISTANT]) * 200_000)
    assert (cost, audit) == (0, "K" * 400_000)


def expected(conv_id, rows):
    """The row of AUDITS of one conversation; rows are (turn, role, text)."""
    turns = {t for t, *_ in rows if t is not None}
    said = [(role, text) for _, role, text in rows]
    found = faults(said)
    cost, audit = search(said)
    initials = [role[:1] for role, _ in said]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    text = "\n".join(f"{role}:{text}" for role, text in applied(said, audit))
    return (conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *map(found.count, ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def in_order(rows):
    digest = lambda role, text: hashlib.sha256(
        f"{len(role.encode())}:{role}{text}".encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[1], r[2])))


def damage(rows):
    """(conv_id, turn, role, text) rows to conversation -> its rows in order."""
    out = {}
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out.setdefault(conv_id, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    return {k: in_order(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def awkward_rows():
    rng = random.Random(6)
    rows = [(i // 6, None if rng.random() < 0.1 else i % 6 * (1 + (i % 7 == 0)), *r)
            for i, r in enumerate(some_rows(rng, 600))]
    rows += [(None, 0, "user", "No id."), (None, None, "assistant", None), (500, 1, None, None)]
    rows += [(501, k, "user", "The same.") for k in range(300)] + [(501, 3, "user", "The same.")] * 4
    rows += [(502, None, "user", "Same again."), (502, None, "user", "Same again.")]
    rows += [(503, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.") for k in range(2000)]
    return rows


def test_query_on_awkward_rows(spark, awkward_rows, tmp_path):
    df = spark.createDataFrame(awkward_rows, "conv_id long, turn long, role string, text string")
    df.selectExpr("*", "'x' as digest", "1 as copies", "turn as first", "role as codes").write.parquet(
        f"{tmp_path}/conversations.parquet")
    found = QUERIES["op12_checkpointed_repair"](spark, str(tmp_path)).collect()
    wanted = {k: expected(k, v) for k, v in damage(awkward_rows).items()}
    assert {r.conv_id: tuple(r) for r in found} == wanted and len(found) == len(wanted)


def test_query(spark, real_sf):
    rows = spark.read.parquet(f"{real_sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()
    found = QUERIES["op12_checkpointed_repair"](spark, real_sf).collect()
    wanted = {k: expected(k, v) for k, v in damage(map(tuple, rows)).items()}
    assert {r.conv_id: tuple(r) for r in found} == wanted and len(found) == len(wanted)


def test_repaired_rows(spark, awkward_rows):
    df = spark.createDataFrame(awkward_rows, "cid long, t long, who string, said string")
    names = {"conv_id": "cid", "turn": "t", "role": "who", "text": "said"}
    by_id = {}
    for conv_id, turn, role, text in awkward_rows:
        by_id.setdefault(conv_id, []).append(
            (turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for r in c.repaired(df, columns=names).orderBy("conv_id", "position").collect():
        out.setdefault(r.conv_id, []).append((r.role, r.text))
        assert r.position == len(out[r.conv_id]) - 1
    audits = {r.conv_id: r.audit for r in c.audited(df, columns=names).collect()}
    for conv_id, rows in by_id.items():
        said = [(role, text) for _, role, text in in_order(rows)]
        assert out.get(conv_id, []) == applied(said, audits[conv_id])


def test_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.audited(df).collect() == [] and c.repaired(df).collect() == []
    gone = spark.createDataFrame([(7, 1, "user", "x.", 0)],
                                 "conv_id long, turn long, role string, text string, copies int")
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in c.audited(gone, copies="copies").collect()] == [
        (7, 0, 0, 0, 0, 0, 0, "", empty)]


def test_long_conversation_comes_from_several_tasks(spark):
    """One conversation holds nearly all rows: its codes are made by many tasks."""
    rows = spark.range(20_000).selectExpr(
        "1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
        "concat('Turn ', id, '.') as text")
    whole = c._rows(rows, {}, None)
    cut = c.segments(whole.select("conv_id", "turn", "role", "digest", c._code(), "copies"))
    sizes = [len(r.codes) for r in cut.collect()]
    assert len(sizes) > 4 and sum(sizes) == 20_000 and max(sizes) < 10_000
    (audit,) = c.audited(rows).collect()
    assert (audit.cost, audit.audit) == (0, "K" * 20_000)
