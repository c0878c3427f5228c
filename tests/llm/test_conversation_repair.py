import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from dwellmart.llm import conversation_repair as repairs
from dwellmart.llm.conversation_repair import BLANK, COPY, FINE, TRUNCATED, Joined, repair, repaired_turns, solve
from dwellmart.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, kind string, `row` string, print string, cost string"
RIGHT = re.compile("(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def kinds_of(turns):
    seen, kinds = set(), []
    for role, text in turns:
        bare = text.strip(WHITE)
        kind = BLANK if not bare else COPY if (role, text) in seen else FINE if bare[-1] in ".!?" else TRUNCATED
        seen.add((role, text))
        kinds.append(kind)
    return kinds


def all_edits(initials, kinds, spare):
    """Every (cost, audit) that gives right roles with at most ``spare`` turns put in, one by one."""
    found = []

    def go(i, roles, cost, audit, spare):
        if i == len(initials):
            if RIGHT.fullmatch(roles):
                found.append((cost, audit))
        else:
            go(i + 1, roles, cost + 2, audit + "D", spare)
            if kinds[i] not in (BLANK, COPY):
                left = cost + 5 * (kinds[i] == TRUNCATED)
                go(i + 1, roles + (initials[i] or "?"), left, audit + "K", spare)
                for role in "ua":
                    go(i + 1, roles + role, left + 1, audit + "R", spare)
        if spare:
            for role in "ua":
                go(i, roles + role, cost + 5, audit + "I", spare - 1)

    go(0, "", 0, "", spare)
    return found


def cheapest(initials, kinds):
    """The best (cost, audit) by going through the turns once with every possible last role."""
    held = {"": (0, "")}

    def put_in(states):
        for _ in range(3):
            for last, (cost, audit) in list(states.items()):
                role = "a" if last == "u" else "u"
                states[role] = min(states.get(role, (1 << 60, "")), (cost + 5, audit + "I"))
        return states

    for initial, kind in zip(initials, kinds, strict=True):
        after = {}
        for last, (cost, audit) in put_in(held).items():
            ways = [(last, cost + 2, "D")]
            if kind not in (BLANK, COPY):
                left, due = cost + 5 * (kind == TRUNCATED), "a" if last == "u" else "u"
                ways.append((due, left + 1, "R"))
                if initial == due or (initial == "s" and last == ""):
                    ways.append((initial, left, "K"))
            for role, total, edit in ways:
                after[role] = min(after.get(role, (1 << 60, "")), (total, audit + edit))
        held = after
    held = put_in(held)
    return min(held[last] for last in ("", "a") if last in held)


def expected(rows, ids):
    """Every column by definition from (conv_id, turn, role, text) rows."""
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups[conv_id].append((turn, role, text, hashlib.sha256(text.encode()).digest()))
    out = {}
    for conv_id in {*ids, *groups}:
        turns = sorted(groups[conv_id], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[3]))
        pairs = [(t[1], t[2]) for t in turns]
        kinds, initials = kinds_of(pairs), [role[:1] for role, _ in pairs]
        cost, audit = cheapest(initials, kinds)
        numbers = {t[0] for t in turns} - {None}
        lines, left, last = [], iter(pairs), ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)
            if edit != "D":
                last = role[:1] if edit == "K" else ("a" if last == "u" else "u")
                lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[last]}:{text}")
        out[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(kinds.count(kind) for kind in (BLANK, COPY, TRUNCATED)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def same(got, rows, ids=()):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    found = {r.conv_id: tuple(r[n] for n in names) for r in got.collect()}
    assert found == expected(rows, ids)


def random_turns(rng, n, roles=("user", "assistant", "system", "tool", "", "u")):
    texts = ["Fine.", "What?", "cut of", "", " \n", "Fine. ", "ok!\t", "other.", "x.y"]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def whole(initials, kinds, piece):
    codes = "".join(map(repairs._code, initials, kinds))
    joined = Joined()
    for at in range(0, len(codes), piece):
        joined.add([solve(codes[at : at + piece], start) for start in range(4)])
    return joined.result()


@pytest.mark.parametrize("piece", [1, 2, 3, 48])
def test_search_finds_the_best_of_all_edits(piece):
    rng = random.Random(piece)
    for _ in range(60):
        turns = random_turns(rng, rng.randrange(5))
        initials, kinds = [role[:1] for role, _ in turns], kinds_of(turns)
        best = min(all_edits(initials, kinds, 2))
        assert whole(initials, kinds, piece) == best == cheapest(initials, kinds)


@pytest.mark.parametrize("piece", [1, 7, 48])
def test_long_conversations_in_pieces(piece):
    rng = random.Random(piece)
    for n in (50, 200, 400):
        for roles in (("user", "assistant"), ("user",), ("user", "assistant", "system", "tool")):
            initials = [rng.choice(roles)[:1] for _ in range(n)]
            kinds = rng.choices((FINE, TRUNCATED, BLANK, COPY), (6, 2, 1, 1), k=n)
            assert whole(initials, kinds, piece) == cheapest(initials, kinds)


def test_the_search_stays_small(monkeypatch):
    rng = random.Random(1)
    codes = ["".join(rng.choice("suaoxUA") for _ in range(48)) for _ in range(20)] + [c * 48 for c in "uUox"]
    tried = 0

    class Counted(dict):
        def get(self, *args):
            nonlocal tried
            tried += 1
            return super().get(*args)

    for c in codes:
        for end in range(4):
            bounds, before = repairs._bounds(c, end), tried
            monkeypatch.setattr(repairs, "_INITIAL", Counted(repairs._INITIAL))
            repairs._search(c, 0, end, bounds)
            # Far from the edits there are: every node at most a few times.
            assert tried - before <= 48 * 4 * 4


ROWS = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi!"), (2, 0, "system", "Be good."), (2, 1, "user", "cut of"),
    (2, 3, "assistant", "No."), (2, 3, "assistant", "No."), (3, None, "user", "Early?"), (3, None, None, None),
    (3, 5, "assistant", "x " * 200_000 + "."), (None, 0, "user", "No id."), (None, 1, "", "No role."),
    (4, 0, "tool", ""), (4, 9, "assistant", "Late.\n"), (5, -3, "user", "ünï…"), (5, 7, "assistant", "日本。"),
    (6, 0, "assistant", "First."), (6, 1, "assistant", "Second."), (6, 1, "assistant", "Second."),
]


@pytest.mark.parametrize("piece", [1, 2, 48])
def test_odd_rows(on_workers, piece):
    same(repair(conversations(on_workers, ROWS), piece=piece), ROWS)


def test_nothing_and_ids_without_turns(on_workers):
    nothing = conversations(on_workers, [])
    assert repair(nothing).count() == 0
    ids = on_workers.createDataFrame([(8,), (None,)], "conv_id long")
    same(repair(nothing, ids), [], [8, None])


def test_one_conversation_of_many_turns(on_workers):
    rng = random.Random(7)
    rows = [(1, i, *turn) for i, turn in enumerate(random_turns(rng, 3000))]
    rows = [(c, t, r, x + str(t) + "." if rng.random() < 0.8 else x) for c, t, r, x in rows]
    rows += [(i, 0, "user", "Alone.") for i in range(2, 40)]
    same(repair(conversations(on_workers, rows)), rows)


def test_repaired_turns_are_right(on_workers):
    got = defaultdict(list)
    for r in repaired_turns(conversations(on_workers, ROWS)).orderBy("conv_id", "position").collect():
        got[r.conv_id].append((r.role, r.text))
        assert r.position == len(got[r.conv_id]) - 1
    digests = {r.conv_id: r.repaired_sha256 for r in repair(conversations(on_workers, ROWS)).collect()}
    for conv_id, digest in digests.items():
        turns = got[conv_id]
        assert RIGHT.fullmatch("".join(role[:1] for role, _ in turns))
        assert hashlib.sha256("\n".join(f"{role}:{text}" for role, text in turns).encode()).hexdigest() == digest


def plainly_damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv_id, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def test_damage(on_workers):
    rows = [*ROWS, *((i, t, "assistant", "A. B! C? d.") for i in range(60) for t in (0, 1, None))]
    got = [tuple(r) for r in repairs.damaged(conversations(on_workers, rows)).collect()]
    assert sorted(got, key=repr) == sorted(plainly_damaged(rows), key=repr)


def test_query(spark, sf_dir):
    rows = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()]
    same(QUERIES["op12_conversation_repair"](spark, sf_dir), plainly_damaged(rows), {r[0] for r in rows})
