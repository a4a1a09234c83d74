import hashlib
import itertools
import random
import zlib

import pytest

from lexispark.llm import conversations as cv

BLANKS = " \t\n\x0b\f\r"


def outcome(turns, edits, inserts):
    """Cost and audit of some edits, None if they are not allowed; ``inserts`` counts those before each turn and at the end."""
    state, cost, audit = 0, 0, ""
    for i, n in enumerate(inserts):
        for _ in range(n):
            state, cost, audit = cv.TO[state], cost + 5, audit + "I"
        if i == len(turns):
            return (cost, audit) if state in (0, 3) else None
        kind, fault, e = turns[i] & 3, turns[i] & 12, edits[i]
        audit += e
        if e == "D":
            cost += 2
            continue
        state = cv.KEEPS[kind].get(state) if e == "K" else cv.TO[state]
        if state is None or fault == cv.GONE:
            return None
        cost += (e == "R") + 5 * (fault == cv.TRUNCATED)


def cheapest(turns):
    """All edit sequences of a short conversation, by plain enumeration."""
    ways = itertools.product(itertools.product("DKR", repeat=len(turns)), itertools.product(range(3), repeat=len(turns) + 1))
    return min(x for edits, inserts in ways if sum(inserts) <= 3 and (x := outcome(turns, edits, inserts)))


def by_states(turns):
    """The least (cost, audit) of each state after each turn, kept as strings."""
    table = {0: (0, "")}
    inserted = lambda t: {s: min((t[p][0] + 5 * k, t[p][1] + "I" * k) for p in t for k in range(3) if walk(p, k) == s) for s in {walk(p, k) for p in t for k in range(3)}}
    walk = lambda s, k: s if k == 0 else walk(cv.TO[s], k - 1)
    for x in turns:
        after = {}
        for s, (c, a) in inserted(table).items():
            for e, more, to in cv.choices(x, s):
                after[to] = min(after.get(to, (c + more, a + e)), (c + more, a + e))
        table = after
    return min(v for s, v in inserted(table).items() if s in (0, 3))


def test_search_equals_enumeration():
    random.seed(2)
    for n in range(5):
        for _ in range(12 if n == 4 else 40):
            turns = bytes(random.choice(range(12)) for _ in range(n))
            assert cv.search(turns) == cheapest(turns) == by_states(turns), list(turns)


def test_search_equals_the_least_way_through_the_states():
    random.seed(3)
    for _ in range(1500):
        turns = bytes(random.choice([0, 1, 2, 1, 2, 1, 2, 3, 4, 5, 9, 10]) for _ in range(random.randint(0, 40)))
        assert cv.search(turns) == by_states(turns), list(turns)


def test_a_very_long_conversation():
    random.seed(4)
    turns = bytes(random.choice([0, 1, 2, 1, 2, 1, 2, 3, 5, 10]) for _ in range(60_000))
    cost, audit = cv.search(turns)
    assert cost == cv.suffix_bounds(turns)[0][0] and len(audit.replace("I", "")) == len(turns)
    assert cv.search(turns[:3000]) == by_states(turns[:3000])


def test_ties_take_the_least_audit():
    assert cv.search(b"") == (0, "")
    assert cv.search(bytes([1])) == (2, "D")
    assert cv.search(bytes([1, 2])) == (0, "KK")
    assert cv.search(bytes([1, 1])) == (1, "KR")
    assert cv.search(bytes([3, 3])) == (2, "RR")
    assert cv.search(bytes([4, 4])) == (4, "DD")


def plain(rows):
    """Brute-force version of the whole query on ``(conv, turn, role, text)`` rows."""
    hurt = {}
    for c, t, r, x in rows:
        out = hurt.setdefault(c, [])
        said = " " if c is None else c, " " if t is None else t
        code, r, x = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20, " " if r is None else r, " " if x is None else x
        if code == 0:
            continue
        x = "" if code == 1 else x.translate({ord(p): None for p in ".!?"}) if code == 2 else x
        out += [(t, "user" if code == 4 else r, x)] * (2 if code == 3 else 1)
    result = []
    for c, turns in hurt.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, code, n = set(), [], {"b": 0, "d": 0, "t": 0}
        for _, r, x in turns:
            body = x.strip(BLANKS)
            fault = "b" if not body else "d" if (r, x) in seen else "t" if body[-1] not in ".!?" else ""
            seen.add((r, x))
            if fault:
                n[fault] += 1
            code.append({"s": 0, "u": 1, "a": 2}.get(r[:1], 3) + {"b": 4, "d": 4, "t": 8, "": 0}[fault])
        cost, audit = by_states(bytes(code))
        left, out, state = iter(turns), [], 0
        for e in audit:
            _, r, x = (None, "", "") if e == "I" else next(left)
            if e == "D":
                continue
            if e != "K":
                r = "user" if state != 2 else "assistant"
            state = {"s": 1, "u": 2, "a": 3}[r[0]]
            out.append(f"{r}:{x}")
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = zip(turns, turns[1:], strict=False)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
        result.append((c, gaps, n["b"], n["d"], n["t"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()))
    return sorted(result, key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string, _c string, _turn string, audit string, position string, COST string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA)


def ours(df):
    return sorted((tuple(r) for r in cv.repaired_digests(cv.damaged(df), df).collect()), key=str)


def test_whole_query_equals_brute_force(spark):
    random.seed(5)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No", "Why?", " ", "", None, "Well!\n", "a\n\t", "Go on. \x0b", "…", "." * 3, "long " * 5000 + "."]
    rows = []
    for c in [*range(150), None]:
        for _ in range(random.randint(1, 9)):
            rows.append((c, random.choice([None, *range(9)]), random.choice(roles), random.choice(texts)))
    # one conversation holds a third of all rows; another one only repeats itself
    rows += [(1000, i, ("user", "assistant", "system")[i % 7 % 3], f"turn {i % 50}." if i % 11 else "cut off") for i in range(400)]
    rows += [(1001, 1, "user", "Same.")] * 30
    assert ours(frame(spark, rows)) == plain(rows)


def test_odd_tables(spark):
    assert ours(frame(spark, [])) == []
    # a dropped conversation stays in the result
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert ours(frame(spark, [(gone, 0, "user", "Yes.")])) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    df = frame(spark, [(1, None, None, None), (None, None, "user", "a."), (None, None, "assistant", "b.")])
    found = {r.conv_id: r for r in cv.repairs(df).collect()}
    assert (found[1].blank, found[1].audit, found[1].gaps) == (1, "D", 0) and found[None].audit == "IKKI" or found[None].cost <= 2


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Why?"), (1, 2, "user", "So?"), (1, 3, "user", ""), (2, 5, "assistant", "Hm."), (2, 7, "assistant", "Yes.")]
    got = cv.repaired_turns(frame(spark, rows)).orderBy("conv_id", "position").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "K", "system", "Be brief."), (1, 1, "K", "user", "Why?"), (1, 2, "R", "assistant", "So?"),
        (2, 0, "R", "user", "Hm."), (2, 1, "K", "assistant", "Yes."),
    ]
    names = spark.createDataFrame([("x", 1, "user", "a."), ("x", 2, "assistant", "b.")], "c string, n int, who string, said string")
    assert [r.audit for r in cv.repairs(names, None, "c", "n", "who", "said").collect()] == ["KK"]


@pytest.mark.parametrize("column", ["conv_id", "turn", "role", "text"])
def test_nulls_in_any_column(spark, column):
    rows = [[i // 3, i % 3, ("user", "assistant")[i % 2], f"Text {i}."] for i in range(12)]
    for r in rows[::2]:
        r[["conv_id", "turn", "role", "text"].index(column)] = None
    rows = [tuple(r) for r in rows]
    assert ours(frame(spark, rows)) == plain(rows)
