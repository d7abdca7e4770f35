from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from hypothesis import given, settings, strategies as st

from newsmart.llm import queries, turns
from newsmart.llm.turns import Search

FORM = re.compile(r"(s?(ua)+)?")
TURNS = "conv_id long, turn long, role string, text string, key int, kind string, place double, gone_by int"


def exhaustive(rows):
    """Least cost, then least list of edits, over every list with at most two turns put in at each place."""
    best = None
    puts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    choices = []
    for role, _, fault in rows:
        own = [("D", None, 2)]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            own += [("K", role, more), ("R", "user", more + 1), ("R", "assistant", more + 1)]
        choices.append(own)
    for kept in product(*choices):
        for put in product(puts, repeat=len(rows) + 1):
            roles, letters, cost = [], "", 0
            for place, edit in zip(put, [*kept, None]):
                roles += place
                letters += "I" * len(place)
                cost += 5 * len(place)
                if edit:
                    letters += edit[0]
                    cost += edit[2]
                    roles += [edit[1]] if edit[1] else []
            if FORM.fullmatch("".join(r[:1] for r in roles)) and (best is None or (cost, letters) < best):
                best = cost, letters
    return best


def plain(rows):
    """The same by a Viterbi search that carries whole lists of edits; also the repaired turns."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def put(states):
        for _ in range(3):
            for state, (cost, letters, made) in list(states.items()):
                for role in ("user", "assistant"):
                    if (to := after.get((state, role[0]))) is not None:
                        new = (cost + 5, letters + "I", (*made, (role, "")))
                        states[to] = min(states.get(to, new), new, key=lambda x: x[:2])
        return states

    states = put({"": (0, "", ())})
    for role, text, fault in rows:
        new = {}
        for state, (cost, letters, made) in states.items():
            ways = [(state, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                ways += [(after.get((state, role[:1])), more, "K", ((role, text),))]
                ways += [(after.get((state, r[0])), more + 1, "R", ((r, text),)) for r in ("user", "assistant")]
            for to, c, letter, own in ways:
                if to is not None:
                    x = (cost + c, letters + letter, made + own)
                    new[to] = min(new.get(to, x), x, key=lambda x: x[:2])
        states = put(new)
    return min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])


def found(rows, held=2000):
    search = Search(held)
    edits = [e for i, (role, text, fault) in enumerate(rows) for e in search.step(i, role, text, fault)]
    edits += search.end()
    made = tuple((role, text) for edit, _, role, text, _ in edits if edit != "D")
    return search.total, "".join(e[0] for e in edits), made


row = st.tuples(
    st.sampled_from(["user", "assistant", "system", "tool", " "]), st.sampled_from("xyz"),
    st.sampled_from(["", "", "", "blank", "duplicate", "truncated"]),
)


@settings(max_examples=60, deadline=None)
@given(st.lists(row, max_size=3))
def test_small_repairs_are_those_of_trying_everything(rows):
    assert found(rows)[:2] == exhaustive(rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(row, max_size=40), st.integers(1, 3))
def test_repairs_are_those_of_whole_lists(rows, held):
    assert found(rows, held) == plain(rows)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["user", "assistant"]), min_size=50, max_size=300))
def test_long_ties_are_decided_by_whole_suffixes(roles):
    rows = [(r, str(i), "") for i, r in enumerate(roles)]
    assert found(rows, 3) == plain(rows)


def test_memory_is_bounded_where_survivors_meet_and_turns_leave_it_where_they_do_not():
    search, most = Search(), 0
    for i in range(50_000):
        fault = ("", "", "", "truncated", "", "blank", "")[i % 7]
        for _ in search.step(i, ("user", "assistant")[i % 2], "t", fault):
            pass
        most = max(most, len(search.tree))
    assert most < 60
    search = Search(10)  # users alone: two survivors never meet
    edits = [e for i in range(3000) for e in search.step(i, "user", "t", "")]
    assert not edits and len(search.queue.front) + len(search.queue.back) <= 20
    edits = list(search.end())
    assert [e[1] for e in edits if e[0] != "I"] == list(range(3000))


def brute(rows, damage=True):
    """All columns of the query by plain Python: rows (conv, turn, role, text)."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        numbers = {r[0] for r in own} - {None}
        seen, judged = set(), []
        for _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, letters, made = plain(judged)
        faults = [f for *_, f in judged]
        initials = [r[:1] for r, _, _ in judged]
        out.append((
            conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, letters, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


@pytest.fixture
def conversations(spark):
    from newsmart.llm.common import ready

    ready(spark)
    return lambda rows: spark.createDataFrame([(*r, 1, "x", 2.5, 3) for r in rows], TURNS)


HARD = [
    (None, 0, "user", "Hello."), (None, 1, "assistant", "Hi!"), (None, None, "user", "When?"), (None, None, None, None),
    (1, None, None, None), (2, 0, "user", ""), (2, 1, "user", " \t"), (3, 5, "assistant", "Same."), (3, 5, "assistant", "Same."),
    (3, 5, "user", "Other."), (3, 9, "assistant", "Same."), (3, 9, "user", "Same."), (4, -3, "", "No role."), (4, 1, "tool", "x."),
    (5, 0, "system", "Rules."), (6, 0, "user", "long. " * 200_000), (6, 1, "assistant", "ok"), (7, 2**60, "user", "Far."),
    *((8, i // 3, ("user", "assistant")[i % 5 % 2], f"{i % 11}.") for i in range(700)),
]


@pytest.mark.parametrize("damage", [True, False])
def test_nulls_ties_repeats_and_long_conversations(conversations, damage):
    frame = conversations(HARD * 2)
    made = turns.audit(turns.damaged(frame) if damage else frame)
    assert sorted(map(tuple, made.collect()), key=str) == brute(HARD * 2, damage)


def test_a_conversation_without_rows_left_is_reported(conversations):
    conv = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    made = turns.audit(turns.damaged(conversations([(conv, 0, "user", "Gone.")]))).collect()
    assert list(map(tuple, made)) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty_table(conversations):
    empty = conversations(HARD[:1]).where("turn > 5")
    assert turns.audit(turns.damaged(empty)).count() == turns.repair(empty).count() == 0


def test_repaired_conversations(conversations):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Hi."), (1, 3, "assistant", "Yes.")]
    made = [tuple(r) for r in turns.repair(conversations(rows)).collect()]
    assert made == [
        (1, 0, "K", 0, "system", "Be kind.", ""), (1, 1, "R", 1, "user", "Hi.", ""),
        (1, None, "D", 2, "assistant", "Hi.", "duplicate"), (1, 2, "K", 3, "assistant", "Yes.", ""),
    ]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_over_a_whole_table(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    made = queries.op11_survivor_viterbi_repair(spark, path).collect()
    assert sorted(map(tuple, made), key=str) == brute(rows)
