"""Repair of the order of roles in conversations, at least cost and with a proof that none is cheaper.

A conversation is right if its roles are those of ``(system? (user assistant)+)?``. Turns may be kept, given
another role or deleted, and turns without text may be put in. ``solve`` searches the edits of a piece of a
conversation depth first by branch and bound: an explicit stack, lower bounds on the cost of the turns that
are left, the best finished (cost, audit) as incumbent, and a table with the best prefix of each node (turns
done, last role) that cuts off every worse one. It ends when the stack is empty, so what it returns is
optimal, also in its audit, which the bounds know nothing of.

Conversations may be as long as a third of all rows, so no task holds the turns of one:

* Turns are sorted over the whole table by conversation and turn. A task goes through its range and solves
  it in pieces of ``PIECE`` turns, for every role that may come before the piece and every one it may end
  with. Repeated turns are found before, by an aggregation that combines before its shuffle.
* The solved pieces of a conversation are put together in order. Since the cost of pieces adds up and audits
  are put one after another, the cheapest edits of the whole are cheapest pieces put together.
* The texts then stream past the audit, which gives the repaired turns and their digest. SHA-256 takes one turn after
  another, so this pass over a conversation is one task's, which holds the audit (one letter a turn) and
  one batch of rows.
"""

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache, partial
from itertools import repeat
from math import inf
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.stored import NOT_WHITE, stored

#: Turns that are solved at a time.
PIECE = 48
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5

#: What has come last: nothing, the system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = ("su", "ua", "au")

#: Kinds of a turn: fine, truncated, blank, a copy of an earlier one. The last two must be deleted.
FINE, TRUNCATED, BLANK, COPY = "fine", "truncated", "blank", "duplicate"
_MUST_GO = "x"

Found = tuple[int, str]


def _code(initial: str, kind: str) -> str:
    """A turn as one letter: its role, in upper case if it is truncated, or that it must go."""
    if kind in (BLANK, COPY):
        return _MUST_GO
    letter = initial if initial in _INITIAL else "o"
    return letter.upper() if kind == TRUNCATED else letter


def _after(edit: str, initial: str, last: int) -> int:
    """What has come last after an edit that leaves or makes a turn."""
    return SYSTEM if edit == "K" and initial == "s" else _NEXT[last]


@lru_cache
def _edits(code: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, what has come last then) of every edit that takes in a turn after ``state``."""
    edits = [("D", DELETE_COST, state)]
    if code != _MUST_GO:
        left = TRUNCATED_COST if code.isupper() else 0
        role = _INITIAL.get(code.lower())
        if role == _NEXT[state] or (role == SYSTEM and state == START):
            edits.append(("K", left, role))
        edits.append(("R", left + REROLE_COST, _NEXT[state]))
    return edits


@lru_cache(1 << 16)
def _bounds(codes: str, end: int) -> list[list[float]]:
    """For each suffix and each last role before it, what the suffix costs at least if ``end`` is to come last."""
    after = [0 if state == end else inf for state in range(4)]
    bounds = []
    for code in (None, *reversed(codes)):
        if code is not None:
            after = [min(cost + after[last] for _, cost, last in _edits(code, state)) for state in range(4)]
        # Two turns put in: a third would only come back to where one of them was.
        for _ in range(2):
            after = [min(after[state], INSERT_COST + after[_NEXT[state]]) for state in range(4)]
        bounds.append(after)
    return bounds[::-1]


@lru_cache(1 << 16)
def solve(codes: str, last: int) -> tuple[Found | None, ...]:
    """The cheapest edits of some turns that follow ``last``: (cost, audit) for each of the four things they may end with.

    ``None`` stands for an end that no edits reach. Of equal costs the audit that comes first in ASCII order
    is returned.
    """
    return tuple(_search(codes, last, end, _bounds(codes, end)) for end in range(4))


def _search(codes: str, last: int, end: int, bounds: list[list[float]]) -> Found | None:
    incumbent: Found | None = None
    best: dict[tuple[int, int], Found] = {}
    stack = [(0, last, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if cost + bounds[i][state] > (inf if incumbent is None else incumbent[0]) or bounds[i][state] == inf:
            continue
        held = best.get((i, state))
        if held is not None and held <= (cost, audit):
            continue
        best[i, state] = (cost, audit)
        if i == len(codes) and state == end and (incumbent is None or (cost, audit) < incumbent):
            incumbent = (cost, audit)
        ways = [(INSERT_COST + bounds[i][_NEXT[state]], "I", i, INSERT_COST, _NEXT[state])]
        if i < len(codes):
            after = bounds[i + 1]
            ways += [(more + after[then], edit, i + 1, more, then) for edit, more, then in _edits(codes[i], state)]
        # The last one pushed is tried first: the least bound, then the first letter.
        for _, edit, j, more, then in sorted(ways, reverse=True):
            stack.append((j, then, cost + more, audit + edit))
    return incumbent


class Joined:
    """Solved pieces put together in order, from the start of a conversation on.

    The audits of the four ends soon share all but their last letters; what they share is kept once.
    """

    def __init__(self):
        self.shared: list[str] = []
        self.tails: list[Found | None] = [(0, ""), None, None, None]

    def add(self, piece: list[list[Found | None]]) -> None:
        tails: list[Found | None] = [None] * 4
        for held, ends in zip(self.tails, piece, strict=True):
            if held is None:
                continue
            for end, found in enumerate(ends):
                if found is not None:
                    whole = (held[0] + found[0], held[1] + found[1])
                    if tails[end] is None or whole < tails[end]:
                        tails[end] = whole
        shared = commonprefix([tail[1] for tail in tails if tail is not None])
        self.shared.append(shared)
        self.tails = [tail and (tail[0], tail[1][len(shared) :]) for tail in tails]

    def result(self) -> Found:
        cost, tail = min(self.tails[end] for end in ENDS if self.tails[end] is not None)
        return cost, "".join(self.shared) + tail


def repaired(audit: Iterator[str], turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every turn that is there after the edits."""
    last = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(turns)
        if edit == "D":
            continue
        last = _after(edit, role[:1], last)
        yield edit, role if edit == "K" else _ROLE[last], text


# --- Spark -----------------------------------------------------------------------------------------

#: The order of turns; those that are equal in all but the last are the same turn.
_ORDER = ["conv_id", "turn", "role", "print", "row"]


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with faults, the same in every run.

    The crc32 of ``conv_id:turn`` modulo 20 tells the fault: 0 drops the turn, 1 empties its text, 2 takes its
    sentence ends away, 3 repeats it, 4 makes it the user's. NULLs count as one space where they are text.
    """
    fault = F.crc32(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn"))).cast("binary")) % 20
    text = _text(F.col("text"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(_text(F.col("role"))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def _numbered(turns: DataFrame) -> DataFrame:
    text = _text(F.col("text"))
    return stored(
        turns.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            _text(F.col("role")).alias("role"),
            text.alias("text"),
            F.unhex(F.sha2(text, 256)).alias("print"),
        ),
        "turns",
    )


def _kinds(rows: DataFrame) -> DataFrame:
    """The order columns of each turn with its role's initial and its kind."""
    blank = ~F.col("text").rlike(NOT_WHITE)
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    firsts = rows.where(~blank).groupBy("conv_id", "role", "print").agg(F.min(F.struct("turn", "row")).alias("first"))
    firsts = firsts.select(F.col("first.row").alias("row"), F.lit(True).alias("is_first"))
    looks = rows.select(
        *_ORDER,
        F.substring("role", 1, 1).alias("initial"),
        F.when(blank, BLANK).when(truncated, TRUNCATED).otherwise(FINE).alias("look"),
    )
    kind = F.when((F.col("look") != BLANK) & F.col("is_first").isNull(), COPY).otherwise(F.col("look"))
    return looks.join(firsts, "row", "left").select(*_ORDER, "initial", kind.alias("kind"))


_PIECES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("print", pa.binary()),
        ("row", pa.int64()),
        *((name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "turns")),
        *((name, pa.int64()) for name in ("first_turn", "last_turn")),
        *((name, pa.string()) for name in ("first_initial", "last_initial")),
        ("costs", pa.list_(pa.int64())),
        ("audits", pa.list_(pa.string())),
    ]
)
_PIECES_SQL = (
    "conv_id long, turn long, role string, print binary, `row` long, blank long, duplicate long, truncated long, "
    "illegal long, turns long, first_turn long, last_turn long, first_initial string, last_initial string, "
    "costs array<long>, audits array<string>"
)


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def _piece(rows: list[tuple], starts: Sequence[int]) -> dict:
    """What one piece of a conversation has: faults, and its cheapest edits for each start and end."""
    initials, kinds = [r[5] for r in rows], [r[6] for r in rows]
    turns = sorted({r[1] for r in rows if r[1] is not None})
    codes = "".join(map(_code, initials, kinds))
    solved = [solve(codes, start) if start in starts else (None,) * 4 for start in range(4)]
    flat = [found for ends in solved for found in ends]
    return dict(zip(_ORDER, rows[0][:5], strict=True)) | {
        "blank": kinds.count(BLANK),
        "duplicate": kinds.count(COPY),
        "truncated": kinds.count(TRUNCATED),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "turns": len(turns),
        "first_turn": turns[0] if turns else None,
        "last_turn": turns[-1] if turns else None,
        "first_initial": initials[0],
        "last_initial": initials[-1],
        "costs": [found and found[0] for found in flat],
        "audits": [found and found[1] for found in flat],
    }


def _solve_pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the conversations of a sorted range of turns."""
    held: list[tuple] = []
    made: list[dict] = []
    # What the range begins with may go on with a conversation of the range before.
    starts: Sequence[int] = range(4)
    for row in _rows(batches, [*_ORDER, "initial", "kind"]):
        if held and (len(held) == size or row[0] != held[0][0]):
            made.append(_piece(held, starts))
            starts = range(4) if row[0] == held[0][0] else (START,)
            held = []
            if len(made) == 4096:
                yield pa.RecordBatch.from_pylist(made, schema=_PIECES)
                made = []
        held.append(row)
    if held:
        made.append(_piece(held, starts))
    if made:
        yield pa.RecordBatch.from_pylist(made, schema=_PIECES)


class _Conversation:
    """Findings and audit of one conversation, from its pieces in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.joined = Joined()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.first, self.last = 0, None, None
        self.initial: str | None = None

    def add(self, piece: dict) -> None:
        for name in self.counts:
            self.counts[name] += piece[name]
        if self.initial is not None:
            self.counts["illegal"] += self.initial + piece["first_initial"] not in _LEGAL
        self.initial = piece["last_initial"]
        if piece["turns"]:
            # One turn may end a piece and begin the next.
            self.turns += piece["turns"] - (self.last == piece["first_turn"])
            self.first = piece["first_turn"] if self.first is None else self.first
            self.last = piece["last_turn"]
        found = [c if c is None else (c, a) for c, a in zip(piece["costs"], piece["audits"], strict=True)]
        self.joined.add([found[4 * start : 4 * start + 4] for start in range(4)])

    def row(self) -> dict:
        cost, audit = self.joined.result()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": min(gaps, 2**63 - 1), **self.counts, "cost": cost, "audit": audit}


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = pa.schema(
    [("conv_id", pa.int64()), *((name, pa.int64()) for name in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_TURNS = pa.schema(
    [("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """(findings, turns) of each conversation of a partition in which its pieces come before its turns."""
    events = _rows(batches, [*_PIECES.names, "kind", "text"])
    event = next(events, None)
    while event is not None:
        found = _Conversation(event[0])
        while event is not None and event[0] == found.conv_id and event[-2] < 2:
            if event[-2] == 1:
                found.add(dict(zip(_PIECES.names, event, strict=False)))
            event = next(events, None)

        def turns(conv_id=found.conv_id):
            nonlocal event
            while event is not None and event[0] == conv_id and event[-2] == 2:
                yield event[2], event[-1]
                event = next(events, None)

        yield found.row(), (own := turns())
        for _ in own:
            pass


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: list[dict] = []
    for row, turns in _conversations(batches):
        digest, gap = hashlib.sha256(), b""
        for _, role, text in repaired(iter(row["audit"]), turns):
            digest.update(gap + f"{role}:{text}".encode())
            gap = b"\n"
        made.append(row | {"repaired_sha256": digest.hexdigest()})
        if len(made) == 4096:
            yield pa.RecordBatch.from_pylist(made, schema=_RESULT)
            made = []
    yield pa.RecordBatch.from_pylist(made, schema=_RESULT)


def _repaired_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: list[dict] = []
    for row, turns in _conversations(batches):
        edits = repaired(iter(row["audit"]), turns)
        for position, conv_id, turn in zip(range(1 << 62), repeat(row["conv_id"]), edits):  # noqa: B905
            made.append(dict(zip(_TURNS.names, (conv_id, position, *turn), strict=True)))
            if len(made) == 1024:
                yield pa.RecordBatch.from_pylist(made, schema=_TURNS)
                made = []
    yield pa.RecordBatch.from_pylist(made, schema=_TURNS)


def _with_pieces(turns: DataFrame, all_ids: DataFrame, piece: int) -> DataFrame:
    """Per conversation in one partition: its id, its solved pieces in order, its turns in order."""
    rows = _numbered(turns)
    in_order = _kinds(rows).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    pieces = in_order.mapInArrow(partial(_solve_pieces, size=piece), _PIECES_SQL)
    ids = all_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("kind", F.lit(0))
    parts = [ids, pieces.withColumn("kind", F.lit(1)), rows.withColumn("kind", F.lit(2))]
    both = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
    both = both.select(*_PIECES.names, "kind", "text")
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER[1:])


def repair(turns: DataFrame, all_ids: DataFrame | None = None, piece: int = PIECE) -> DataFrame:
    """Turns (conv_id, turn, role, text) -> one row per conversation: its faults, cheapest edits and repaired digest.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A turn is
    blank, else duplicate (same role and text earlier), else truncated (its last visible character ends no
    sentence). ``illegal`` counts neighbours other than system-user, user-assistant, assistant-user. The audit has one letter for each edit in
    order, K(eep), R(erole), D(elete), I(nsert); the digest is that of the repaired ``role:text`` lines.

    Turns come in the order of ``turn``, NULLs first, and where that is equal by role and digest of the text. NULL roles
    and texts are one space, so blank. A NULL conv_id is a conversation of its own. Conversations of ``all_ids`` without turns get zeros, an
    empty audit and the digest of nothing. An empty table gives no rows. Extra columns are not read.
    """
    schema = f"conv_id long, {', '.join(f'{name} long' for name in _COUNTS)}, audit string, repaired_sha256 string"
    return _with_pieces(turns, turns if all_ids is None else all_ids, piece).mapInArrow(_digests, schema)


def repaired_turns(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """The repaired conversations: conv_id, position from 0, edit (K, R or I), role, text."""
    schema = "conv_id long, position long, edit string, role string, text string"
    return _with_pieces(turns, turns, piece).mapInArrow(_repaired_turns, schema)
