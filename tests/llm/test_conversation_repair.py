from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm.conversation_repair import Repair, damaged, repair_conversations, search

LEGAL = re.compile(r"(s?(ua)+)?")
BARE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BARE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def dynamic(rows):
    """The cheapest (cost, audit) by plain recursion over (row, role before), and the repaired rows."""
    kinds = faults(rows)

    @lru_cache(None)
    def rest(at, given, inserts):
        # ``given``: what the initials so far can be told apart by
        out = [(0, "", ())] if at == len(rows) and given in ("", "a") else []
        want = "a" if given == "u" else "u"
        name = {"u": "user", "a": "assistant"}[want]

        def then(cost, edit, made, follow):
            if follow is not None:
                out.append((cost + follow[0], edit + follow[1], made + follow[2]))

        if inserts < 2:
            then(5, "I", ((name, ""),), rest(at, want, inserts + 1))
        if at < len(rows):
            _, role, text = rows[at]
            then(2, "D", (), rest(at + 1, given, 0))
            if kinds[at] not in ("blank", "duplicate"):
                more = 5 if kinds[at] == "truncated" else 0
                then(1 + more, "R", ((name, text),), rest(at + 1, want, 0))
                if role[:1] == want or (role[:1] == "s" and given == ""):
                    then(more, "K", ((role, text),), rest(at + 1, role[:1], 0))
        return min(out, default=None)

    cost, audit, made = rest(0, "", 0)
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()


def expected(rows):
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = [t for t, _, _ in rows if t is not None]
    kinds = faults(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, *dynamic(rows))


def repaired(rows, segment):
    state = Repair(segment)
    for row in rows:
        state.add(*row, None)
    return state.result()


row = st.tuples(
    st.sampled_from(["user", "assistant", "system", " ", "tool", ""]), st.sampled_from(["Yes.", "No", " ", "", "What? ", "One.", "Two!", "x"])
)


@settings(max_examples=300, deadline=None)
@given(rows=st.lists(row, max_size=14), segment=st.sampled_from([1, 2, 3, 32]))
def test_same_as_recursion(rows, segment):
    rows = [(i * 2 if i else None, *r) for i, r in enumerate(rows)]
    assert repaired(rows, segment) == expected(rows)


@pytest.mark.parametrize("n", range(4))
def test_same_as_all_edits(n):
    """Every sequence of edits with up to two insertions in a row, by their definition."""
    for roles in product("suo", repeat=n):
        best = None
        for edits in product(*(["K", "R", "D"] for _ in roles)):
            for inserts in product(range(3), repeat=n + 1):
                options = [("", "")]
                for i in range(n + 1):
                    options = [(a + "I" * inserts[i], b + w) for a, b in options for w in map("".join, product("ua", repeat=inserts[i]))]
                    if i < n:
                        to = {"K": [roles[i]], "R": ["u", "a"], "D": [""]}[edits[i]]
                        options = [(a + edits[i], b + w) for a, b in options for w in to]
                cost = 5 * sum(inserts) + edits.count("R") + 2 * edits.count("D")
                for audit, initials in options:
                    if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
        assert search("".join(roles), 0, True)[3] == best


def damage(conv, rows):
    blank = lambda v: " " if v is None else str(v)
    out = []
    for turn, role, text in rows:
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def check(spark, table, **options):
    got = {r.conv_id: tuple(r)[1:] for r in repair_conversations(damaged(spark.createDataFrame(table, SCHEMA)), **options).collect()}
    groups = {}
    for conv, turn, role, text, *_ in table:
        groups.setdefault(conv, []).append((turn, role, text))
    assert got == {conv: expected(damage(conv, rows)) for conv, rows in groups.items()}


SCHEMA = "conv_id long, turn long, role string, text string, `times` int, COST string"
AWKWARD = [
    *((None, t, "user", "Hello there.", 7, "x") for t in (None, None, 1, 1, 2, 9)),
    *((c, t, ["user", "assistant", "system", None][(c + t) % 4], ["Fine.", None, "", "Where", "é ☃!"][(c * t) % 5], 3, None) for c in range(60) for t in range(c % 9)),
    *((70, t, ["user", "assistant"][t % 2], f"Long {t % 41} {'word ' * (t % 3)}.", 1, "") for t in range(120)),
    (71, 0, "user", "w " * 300_000 + ".", 1, ""),
]


def test_awkward_rows(spark):
    check(spark, AWKWARD)


def test_long_conversations_without_a_set(spark):
    check(spark, AWKWARD, long=3)


def test_whole_table(spark, small):
    from forecourt.llm.queries import QUERIES

    table = spark.read.parquet(f"{small}/conversations.parquet")
    rows = {}
    for r in table.collect():
        rows.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, small).collect()}
    assert got == {conv: expected(damage(conv, own)) for conv, own in rows.items()}


def test_no_rows(spark):
    assert repair_conversations(damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_a_very_long_conversation_is_cheap():
    state = Repair()
    for i in range(20_000):
        state.add(i, ["user", "assistant", "user"][i % 3], f"{i}." if i % 7 else "cut", False)
    assert len(state.result()[6]) >= 20_000
