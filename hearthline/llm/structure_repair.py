"""Conversation structure repair: the cheapest edits that give a well-formed conversation.

A conversation is a row of turns. Each turn is kept (free), given another role (2) or
deleted (3, the only choice for blank and repeated turns); an empty turn may be put in
anywhere (2); a truncated turn that stays costs 1 more. What is left must read as an
optional system turn and then pairs of user and assistant, or be nothing. Of equally cheap
repairs the one whose audit, the edits' initials in order, comes first counts.

The search is depth-first branch-and-bound: an explicit stack; a lower bound for what
the rest of the turns must cost at least; the best complete repair (cost, audit) so far;
and for every place in the search a table of the best way there, so that worse prefixes
end at once. The search is over when the stack is empty: then the best is proved.

Rows are dealt by range of (conversation, turn), so a conversation of any length lies over
as many tasks as it needs. A task cuts what it holds of a conversation into segments and
searches each for every way in and out; the tables of segments and of tasks are chained.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import bounded_batches, sized, stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
#: Turns of one search; longer conversations are chained from such segments.
SEGMENT = 128
#: Repairs of short conversations that a task remembers.
SOLVED = 50_000

#: Where a repair stands: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
DONE = (START, ASSISTANT)
#: The state a turn of a new role leads to, and that a kept turn may lead to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
ROLES = {USER: "user", ASSISTANT: "assistant"}
_BLANK = " \t\n\x0b\x0c\r"

#: A turn for the search: "x" must go; else the role's initial, in capitals if truncated.
GONE = "x"


def _moves(code: str | None, state: int) -> list[tuple[str, int, int]]:
    """What can be done at a turn (None: past the last): edit, cost, next state."""
    out = [(INSERT, COST[INSERT], NEXT[state])]
    if code is None:
        return out
    out.append((DELETE, COST[DELETE], state))
    if code != GONE:
        more = TRUNCATED if code.isupper() else 0
        out.append((REROLE, COST[REROLE] + more, NEXT[state]))
        if (state, code.lower()) in KEPT:
            out.append((KEEP, COST[KEEP] + more, KEPT[state, code.lower()]))
    return out


def lower_bounds(codes: str) -> list[tuple[int, ...]]:
    """For every turn and state, what the turns from there on cost at least.

    Lets the repair end in any state: so it is a bound, not the cost.
    """
    after = (0,) * len(STATES)
    out = [after]
    for code in reversed(codes):
        here = {}
        for state in (USER, START, SYSTEM, ASSISTANT):
            here[state] = min(cost + after[to] for edit, cost, to in _moves(code, state) if edit != INSERT)
        # an insertion may come first: user to assistant, any other to user
        inserted = tuple(min(here[s], COST[INSERT] + here[NEXT[s]]) for s in STATES)
        after = inserted
        out.append(after)
    return out[::-1]


def cheapest(codes: str, entry: int = START, exits: tuple[int, ...] = DONE) -> tuple[int, str]:
    """The cost and audit of the best repair from one state to one of others; -1 where there is none."""
    least = lower_bounds(codes)
    best: tuple[int, str] | None = None
    ways: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        known = ways.get((at, state))
        if known is not None and known < (cost, audit):
            continue  # a better way here was found since
        if best is not None:
            bound = cost + least[at][state]
            if bound > best[0] or bound == best[0] and audit > best[1]:
                continue
        if at == len(codes) and state in exits and (best is None or (cost, audit) < best):
            best = (cost, audit)
        code = codes[at] if at < len(codes) else None
        onward = []
        for edit, price, to in _moves(code, state):
            place = (at if edit == INSERT else at + 1, to)
            way = (cost + price, audit + edit)
            if place not in ways or way < ways[place]:
                ways[place] = way
                onward.append((way[0] + least[place[0]][to], edit, place, way))
        for _, _, place, way in sorted(onward, reverse=True):  # the most promising is popped first
            stack.append((*place, *way))
    return best if best is not None else (-1, "")


Table = dict[tuple[int, int], tuple[int, str]]


def segment_table(codes: str, entries: tuple[int, ...] = STATES) -> Table:
    """The best repair of a segment for every way in and out that there is."""
    found = {(a, b): cheapest(codes, a, (b,)) for a in entries for b in STATES}
    return {way: best for way, best in found.items() if best[0] >= 0}


def chained(first: Table, second: Table) -> Table:
    """The table of two segments one after the other."""
    out: Table = {}
    for (a, b), (cost, audit) in first.items():
        for c in STATES:
            if (b, c) in second:
                way = (cost + second[b, c][0], audit + second[b, c][1])
                out[a, c] = min(out.get((a, c), way), way)
    return out


def ended(table: Table) -> tuple[int, str]:
    """The best whole repair of a chained table."""
    return min(table[START, state] for state in DONE if (START, state) in table)


class Hasher:
    """SHA-256 over the repaired turns, ``role:text`` joined by line feeds."""

    def __init__(self) -> None:
        self.state, self.digest, self.any = START, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.digest.update(f"\n{role}:{text}".encode() if self.any else f"{role}:{text}".encode())
        self.any = True

    def edit(self, edit: str, role: str, text: str) -> None:
        if edit in (INSERT, REROLE):
            self.state = NEXT[self.state]
            self._put(ROLES[self.state], "" if edit == INSERT else text)
        elif edit == KEEP:
            self.state = KEPT[self.state, role[:1]]
            self._put(role, text)


def repaired_hash(audit: str, turns: Iterator[tuple[str, str]]) -> str:
    """The hash for an audit over its turns (role, text) in order."""
    hasher = Hasher()
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(turns)
        hasher.edit(edit, role, text)
    return hasher.digest.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` after the damage that a checksum of id and turn decides.

    Dropped rows stay with no copies, so that their conversation is known. A null counts
    as one space.
    """
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return (
        conversations.withColumn("_how", F.crc32(F.concat_ws(":", *told)) % 20)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_how") == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(F.col("_how") <= 1, F.lit(""))
            .when(F.col("_how") == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            F.when(F.col("_how") == 0, 0).when(F.col("_how") == 3, 2).otherwise(1).cast("long").alias("copies"),
        )
    )


def _noted(turns: DataFrame) -> DataFrame:
    """Turns with ``first``: whether no earlier turn of the conversation says the same.

    Only turns that are not alone with their role and text are looked at again; equal ones
    of a turn become one row with their copies, so a turn repeated without end is a single row.
    """
    h = F.struct(F.xxhash64("role", "text").alias("h"), F.xxhash64(F.lit(1), "text", "role").alias("g"))
    here = turns.withColumn("_h", h)
    live = here.filter("copies > 0")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    same = stored(
        live.groupBy("conv_id", "_h").agg(F.count("*").alias("n"), F.min(place).alias("_least")).filter("n > 1")
    )
    renamed = sized(same.select(F.col("conv_id").alias("_c"), F.col("_h").alias("_g"), "_least"))
    matched = here.join(
        renamed, (F.col("copies") > 0) & F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_h") == F.col("_g")), "left"
    ).withColumn("first", F.coalesce(place == F.col("_least"), F.lit(True)))
    columns = ["conv_id", "turn", "role", "text", "copies", "first"]
    alone = matched.filter("_least IS NULL").select(*columns)
    several = (
        matched.filter("_least IS NOT NULL")
        .groupBy("conv_id", "turn", "role", "text", "first")
        .agg(F.sum("copies").alias("copies"))
        .select(*columns)
    )
    return alone.unionByName(several)


def code_of(role: str, text: str) -> str:
    """The search's code of a turn that is not a repetition."""
    body = text.rstrip(_BLANK)
    if not body:
        return GONE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial if body[-1] in ".!?" else initial.upper()


class _Part:
    """What a task knows of one conversation."""

    def __init__(self, solved: dict[str, tuple[int, str]]) -> None:
        self.solved = solved  # many short conversations look alike
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.most = self.head = None
        self.turns = 0
        self.last = None
        self.codes: list[str] = []
        self.waiting = 0
        self.table: Table | None = None
        self.rows: list[tuple[str, str]] | None = []

    def add(self, turn: int | None, role: str, text: str, copies: int, first: bool) -> None:
        if not copies:
            return
        code = code_of(role, text)
        fresh = int(first and code != GONE)
        self.blank += copies if code == GONE else 0
        self.duplicate += copies - fresh if code != GONE else 0
        self.truncated += fresh and code.isupper()
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.turns += 1
        initial = role[:1]
        if self.n:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.head = initial
        self.illegal += (copies - 1) * (initial + initial not in ("su", "ua", "au"))
        self.last = initial
        self.n += copies
        done = 0
        while done < copies:  # bit by bit, however many copies
            take = min(copies - done, SEGMENT)
            self.codes.append(GONE * take if done or not fresh else code + GONE * (take - 1))
            self.waiting += take
            done += take
            if self.waiting >= SEGMENT:
                self._chain()
        if self.rows is not None:
            self.rows += [(role, text)] * copies if copies <= SEGMENT else []
            if len(self.rows) > SEGMENT or copies > SEGMENT:
                self.rows = None  # too long to hold: hashed in a second pass

    def _chain(self) -> None:
        codes = "".join(self.codes)
        self.codes, self.waiting = [], 0
        for k in range(0, len(codes), SEGMENT):
            table = segment_table(codes[k : k + SEGMENT])
            self.table = table if self.table is None else chained(self.table, table)

    def whole(self) -> tuple[int, str, str] | None:
        """Cost, audit and hash, if the task holds all of a short conversation."""
        if self.table is not None or self.rows is None:
            return None
        codes = "".join(self.codes)
        if codes not in self.solved:
            if len(self.solved) >= SOLVED:
                self.solved.clear()
            self.solved[codes] = cheapest(codes)
        cost, audit = self.solved[codes]
        return cost, audit, repaired_hash(audit, iter(self.rows))

    def ways(self) -> list[dict]:
        if self.codes:
            self._chain()
        table = self.table if self.table is not None else {(s, s): (0, "") for s in STATES}
        return [{"a": a, "b": b, "cost": c, "audit": t} for (a, b), (c, t) in table.items()]




def _search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each conversation that a task has turns of, or two for one cut off at its ends.

    The first and last conversation of a task may go on in another; for these the whole
    table of ways is told, for the others the answer.
    """
    name, part, at, solved = None, None, 0, {}

    def told(edge: bool) -> tuple:
        whole = part.whole()
        cost, audit, digest = whole if whole is not None else (None, None, None)
        ways = part.ways() if edge or whole is None else None
        p = part
        counts = (p.n, p.blank, p.duplicate, p.truncated, int(p.illegal), p.least, p.most, p.turns, p.head, p.last)
        return (name, edge, *counts, cost, audit, digest, ways)

    columns = (
        "conv edge n blank duplicate truncated illegal least most turns head last cost audit repaired_sha256 ways".split()
    )

    def framed(rows: list[tuple], start: int) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns, dtype=object)
        out.insert(1, "at", range(start, start + len(rows)))
        return out

    seen = False
    for frame in frames:
        rows = []
        for conv, turn, role, text, copies, first in zip(
            *(frame[c].tolist() for c in ("conv", "turn", "role", "text", "copies", "first"))
        ):
            if part is None or conv != name:
                if part is not None:
                    rows.append(told(not seen))
                    seen = True
                name, part = conv, _Part(solved)
            part.add(None if turn is None else int(turn), role, text, int(copies), bool(first))
        yield framed(rows, at)
        at += len(rows)
    if part is not None:
        yield framed([told(True)], at)


_SEARCHED = """conv string, at long, edge boolean, n long, blank long, duplicate long, truncated long, illegal long,
    least long, most long, turns long, head string, last string, cost long, audit string, repaired_sha256 string,
    ways array<struct<a: int, b: int, cost: long, audit: string>>"""


def _join_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The parts of each conversation, in order, as one answer without its hash."""
    name, whole, table = None, None, None

    def told() -> tuple:
        cost, audit = ended(table)
        return (name, whole["n"], whole["blank"], whole["duplicate"], whole["truncated"], whole["illegal"],
                whole["least"], whole["most"], whole["turns"], cost, audit)

    columns = "conv n blank duplicate truncated illegal least most turns cost audit".split()
    for frame in frames:
        out = []
        for row in frame.to_dict("records"):
            ways = {(w["a"], w["b"]): (w["cost"], w["audit"]) for w in row["ways"]}
            row = {k: None if v is None or v != v else v for k, v in row.items() if k != "ways"}
            if row["conv"] != name or whole is None:
                if whole is not None:
                    out.append(told())
                name, whole, table = row["conv"], row, ways
                continue
            table = chained(table, ways)
            if whole["n"] and row["n"]:
                whole["illegal"] += whole["last"] + row["head"] not in ("su", "ua", "au")
            for c in ("n", "blank", "duplicate", "truncated", "illegal", "turns"):
                whole[c] += row[c]
            if whole["most"] is not None and whole["most"] == row["least"]:
                whole["turns"] -= 1  # a turn that lies in both parts
            whole["least"] = row["least"] if whole["least"] is None else whole["least"]
            whole["most"] = whole["most"] if row["most"] is None else row["most"]
            whole["last"] = row["last"] if row["n"] else whole["last"]
        yield pd.DataFrame(out, columns=columns, dtype=object)
    if whole is not None:
        yield pd.DataFrame([told()], columns=columns, dtype=object)


def _hash_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each conversation, its turns in order; the first row brings the audit."""
    name, hasher, audit, at = None, None, "", 0

    def finish() -> tuple[str | None, str]:
        for edit in audit[at:]:
            hasher.edit(edit, "", "")
        return name, hasher.digest.hexdigest()

    for frame in frames:
        out = []
        for conv, role, text, copies, told in zip(
            *(frame[c].tolist() for c in ("conv", "role", "text", "copies", "audit"))
        ):
            if hasher is None or conv != name:
                if hasher is not None:
                    out.append(finish())
                name, hasher, audit, at = conv, Hasher(), "", 0
            if told is not None:
                audit = told
            for _ in range(int(copies)):
                while audit[at] == INSERT:
                    hasher.edit(INSERT, "", "")
                    at += 1
                hasher.edit(audit[at], role, text)
                at += 1
        yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
    if hasher is not None:
        yield pd.DataFrame([finish()], columns=["conv", "repaired_sha256"])


def repaired(turns: DataFrame) -> DataFrame:
    """The best repair of every conversation of ``turns(conv_id, turn, role, text, copies)``.

    ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``.
    Turns count by number, nulls first, equal numbers by role and text; ``copies`` says how
    often a row stands there (0: not, but its conversation is known). A conversation without
    turns has zeros, no audit and the hash of nothing. Turns without a conversation are one.
    Roles other than system, user and assistant, an empty one too, must be changed or deleted.
    """
    bounded_batches(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType
    named = (
        _noted(turns)
        .withColumn("known", F.col("conv_id").isNotNull())
        .withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    )
    order = ["known", "conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = named.repartitionByRange("known", "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    laid = dealt.sortWithinPartitions(*order).select(
        "conv", F.col("turn").cast("long").cast("string").alias("turn"), "role", "text", "copies", "first"
    )
    searched = stored(
        laid.mapInPandas(_search, _SEARCHED).withColumn("part", F.spark_partition_id())
    )
    # conversations with several parts, or too long to be answered where they lie
    edges = searched.filter("edge OR cost IS NULL")
    open_ = edges.groupBy("conv").agg(F.count("*").alias("parts"), F.count("cost").alias("solved")).filter(
        "parts > 1 OR solved < parts"
    )
    open_ = stored(open_.select("conv"))
    numbers = "n blank duplicate truncated illegal least most turns".split()
    settled = searched.join(sized(open_), "conv", "left_anti").select(
        "conv", *numbers, "cost", "audit", "repaired_sha256"
    )
    joined = stored(
        edges.join(sized(open_), "conv", "left_semi")
        .select("part", "at", "conv", *numbers, "head", "last", "ways")
        .repartition("conv")
        .sortWithinPartitions("conv", "part", "at")
        .mapInPandas(
            _join_parts,
            "conv string, " + ", ".join(f"{c} long" for c in numbers) + ", cost long, audit string",
        )
    )
    texts = named.join(sized(open_), "conv", "left_semi").filter("copies > 0")
    columns = ["conv", "head", "known_turn", "turn", "role", "text", "copies", "audit"]
    heads = joined.select(
        "conv",
        F.lit(0).alias("head"),
        F.lit(False).alias("known_turn"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit("").alias("text"),
        F.lit(0).cast("long").alias("copies"),
        "audit",
    )
    bodies = texts.select(
        "conv",
        F.lit(1).alias("head"),
        F.col("turn").isNotNull().alias("known_turn"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        "copies",
        F.lit(None).cast("string").alias("audit"),
    ).select(*columns)
    hashes = (
        heads.unionByName(bodies)
        .repartition("conv")
        .sortWithinPartitions("conv", "head", "known_turn", "turn", "role", "text")
        .select("conv", "role", "text", "copies", "audit")
        .mapInPandas(_hash_parts, "conv string, repaired_sha256 string")
    )
    every = settled.unionByName(joined.join(hashes, "conv"))
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
    id_ = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind)
    return every.select(
        id_.alias("conv_id"), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256",
    )


def structure_repair(conversations: DataFrame) -> DataFrame:
    """:func:`repaired` for every conversation of ``conversations(conv_id, turn, role, text)``, damaged first.

    Other columns are not read; an empty table gives no rows.
    """
    return repaired(damaged(conversations))
