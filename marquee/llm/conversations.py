"""Conversation repair: cheapest edits by dynamic programming, the least audit by prefix-doubling path ranking.

A conversation is legal when the initials of its roles match ``(s?(ua)+)?``. Nodes of the edit graph are (rows
done, state of that automaton); its arcs keep, rerole or delete the next row or insert a missing one, each
with a cost and an initial. A dynamic programme gives every node its cost to the end; the arcs that lie on cheapest
ways are the optimal arcs. Of the cheapest ways the one with the ASCII-least string of initials, the audit,
counts: every node is ranked by the first letter of its least way, then, by pairs of ranks, by its first
2, 4, 8, ... letters, while the pointer to the node so many letters on is doubled with it. The optimal arcs of a node
have different letters, so its least first letter names one arc; the pointers are followed by the binary
digits of a place to read off all letters of all audits at once.

On Spark: rows are range-partitioned by conversation and turn and sorted. A conversation that lies inside one
partition and is not too long is finished there. The others, two for each partition and all giants, go on in
segments of bounded size: costs of crossing a segment between any two states are combined (min, +), so each
segment learns the costs to the end behind it and finds its own part of the audit. Only the hash of a
repaired conversation, which no one can compute in parts, is made in one stream of its rows, a row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import columns_of, stored
from marquee.session import shuffle_partitions

# The costs of the edits, the sentence ends, the blanks, the legal pairs of initials.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ENDS = ".!?"
BLANKS = " \t\n\x0b\x0c\r"
LEGAL_PAIRS = ("su", "ua", "au")
LETTERS = "DIKR"  # delete, insert, keep, rerole, in ASCII order

# States: nothing yet, after s, after u, after a. A way may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # where a user or an assistant, whichever fits, leads
AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
ROLE_INTO = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 50
END = (0, FAR, FAR, 0)

GOOD, BLANK, REPEATED, CUT = range(4)


@dataclass(frozen=True)
class Settings:
    whole_rows: int = 5_000  # a conversation up to here is finished in the task that holds all of it
    whole_bytes: int = 32 << 20
    segment_bits: int = 14  # rows of a segment, as a power of two
    batch: int = 512  # conversations whose paths are ranked together
    batch_rows: int = 20_000


def fault_of(text: str) -> int:
    """Blank, cut off or good; whether it was seen before is not known here."""
    bare = text.rstrip(BLANKS)
    return BLANK if not bare else GOOD if bare[-1] in ENDS else CUT


def digest_of(conv, role: str, text: str) -> bytes:
    """128 bits that stand for a row's conversation, role and text."""
    h = hashlib.blake2b(digest_size=16)
    for part in ("" if conv is None else f"={conv}", role, text):
        data = part.encode("utf-8", "surrogatepass")
        h.update(len(data).to_bytes(8, "little") + data)
    return h.digest()


# --- costs ---


def _row_arcs(initial: str, fault: int, state: int) -> Iterator[tuple[int, int, int]]:
    """(letter, cost, next state) of the edits of one row."""
    yield 0, DELETE, state
    if fault in (BLANK, REPEATED):
        return
    extra = TRUNCATED if fault == CUT else 0
    kept = AFTER.get(initial, (None,) * 4)[state]
    if kept is not None:
        yield 2, KEEP + extra, kept
    yield 3, REROLE + extra, NEXT[state]


# Fixed by the above: the arcs for each initial, fault and state.
ARCS = {
    (initial, fault): tuple(tuple(_row_arcs(initial, fault, state)) for state in range(4))
    for initial in ("s", "u", "a", "") for fault in range(4)
}


def with_inserts(d: list[int]) -> list[int]:
    """Costs to the end at one place, inserts included."""
    user = min(d[USER], INSERT + d[ASSISTANT])
    assistant = min(d[ASSISTANT], INSERT + user)
    return [min(d[START], INSERT + user), min(d[SYSTEM], INSERT + user), user, assistant]


def costs_to_end(rows: list[tuple[str, int]], behind: list[int], last: bool) -> list[list[int]]:
    """For each place from the first row to behind the last one: the cost to the end from each state.

    ``behind`` are the costs behind the rows; inserts there belong to what follows, unless nothing does.
    """
    now = with_inserts(list(behind)) if last else list(behind)
    places = [now]
    for initial, fault in reversed(rows):
        now = with_inserts([min(c + now[to] for _, c, to in arcs) for arcs in ARCS[initial, fault]])
        places.append(now)
    places.reverse()
    return places


# --- least paths ---


def least_audits(problems: list[tuple[list[tuple[str, int]], list[list[int]], bool, tuple[int, ...]]]) -> list[list[tuple[str, int]]]:
    """For each (rows, costs to the end, last, start states): the least audit from each start and the state it ends in.

    All problems are ranked together, as one graph.
    """
    letter: list[int] = []
    follow: list[int] = []
    starts, ends = [], []
    for rows, places, last, entries in problems:
        base = len(letter)
        for i, d in enumerate(places):
            at = base + 4 * i
            inserting = i < len(rows) or last
            arcs = ARCS[rows[i]] if i < len(rows) else ((), (), (), ())
            for state in range(4):
                best, to = 0, at + state
                if d[state] < FAR:
                    # Letters in ASCII order: D before I before K before R.
                    for code, cost, target in arcs[state]:
                        if cost + places[i + 1][target] == d[state] and (not best or code + 1 < best):
                            best, to = code + 1, at + 4 + target
                    if inserting and d[state] == INSERT + d[NEXT[state]] and (not best or best > 2):
                        best, to = 2, at + NEXT[state]
                letter.append(best)
                follow.append(to)
        starts += [base + state for state in entries]
        ends += [base + 4 * len(rows)] * len(entries)
    first = np.array(letter, np.int64)
    pointers, rank, count = [np.array(follow, np.int64)], first.copy(), (first > 0).astype(np.int64)
    begin = np.array(starts, np.int64)
    while (first[pointers[-1][begin]] > 0).any():
        jump = pointers[-1]
        pair = rank * (int(rank.max()) + 1) + rank[jump]  # the first 2^(k+1) letters as two halves
        rank = np.unique(pair, return_inverse=True)[1]
        count = count + count[jump]
        pointers.append(jump[jump])
    length = count[begin]
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    node = np.repeat(begin, length)
    for k, jump in enumerate(pointers):
        on = (place >> k) & 1 == 1
        node[on] = jump[node[on]]
    text = np.frombuffer(b" DIKR", np.uint8)[first[node]].tobytes().decode()
    stop = pointers[-1][begin] - np.array(ends, np.int64)
    found, at = [], 0
    answers = iter(zip(length.tolist(), stop.tolist(), strict=True))
    for *_, entries in problems:
        own = []
        for _ in entries:
            size, state = next(answers)
            own.append((text[at : at + size], state))
            at += size
        found.append(own)
    return found


# --- one conversation, row by row ---


@dataclass
class Report:
    """What is told about a conversation, built while its rows and its audit go by in order."""

    conv: object
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0
    turns: int = 0
    least: int | None = None
    most: int | None = None
    before: str | None = None
    state: int = START
    audit: list[str] = field(default_factory=list)
    digest: object = field(default_factory=hashlib.sha256)
    written: int = 0
    lines: list[dict] | None = None  # repaired rows, where they are wanted instead of the report

    def _write(self, role: str, text: str) -> None:
        if self.lines is not None:
            self.lines.append({"conv_id": self.conv, "id": self.written, "role": role, "text": text})
        else:
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            self.digest.update(b"\n" + line if self.written else line)
        self.written += 1

    def inserts(self, letters: Iterator[str]) -> str | None:
        """Go through the inserts that come next; the letter behind them, None at the end."""
        for letter in letters:
            if letter != "I":
                return letter
            self.state = NEXT[self.state]
            self.cost += INSERT
            self._write(ROLE_INTO[self.state], "")
        return None

    def row(self, turn: int | None, role: str, text: str, fault: int, letter: str) -> None:
        self.blank += fault == BLANK
        self.duplicate += fault == REPEATED
        self.truncated += fault == CUT
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL_PAIRS
        self.before = role[:1]
        if turn is not None and turn != self.most:  # turns come in rising order
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        if letter == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED * (fault == CUT)
        if letter == "K":
            self.state = AFTER[role[:1]][self.state]
            self._write(role, text)
        else:
            self.cost += REROLE
            self.state = NEXT[self.state]
            self._write(ROLE_INTO[self.state], text)

    def told(self) -> list[dict]:
        """The report, or the repaired rows that were not taken yet."""
        if self.lines is not None:
            taken, self.lines = self.lines, []
            return taken
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return [{
            "conv_id": self.conv, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit),
            "repaired_sha256": self.digest.hexdigest(),
        }]


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _solved(conversations: list[tuple[object, list[tuple]]], lines: bool) -> list[dict]:
    """Reports, or repaired rows, of conversations whose rows (turn, role, text) are all here."""
    problems, faults = [], []
    for conv, rows in conversations:
        seen: set[bytes] = set()
        own = []
        for _, role, text in rows:
            fault = fault_of(text)
            if fault != BLANK:
                digest = digest_of(conv, role, text)
                fault = REPEATED if digest in seen else fault
                seen.add(digest)
            own.append(fault)
        codes = [(_initial(role), f) for (_, role, _), f in zip(rows, own, strict=True)]
        problems.append((codes, costs_to_end(codes, list(END), True), True, (START,)))
        faults.append(own)
    out = []
    for (conv, rows), own, [(audit, _)] in zip(conversations, faults, least_audits(problems) if problems else [], strict=True):
        report, letters = Report(conv, audit=[audit], lines=[] if lines else None), iter(audit)
        for (turn, role, text), fault in zip(rows, own, strict=True):
            report.row(turn, role, text, fault, report.inserts(letters))
        report.inserts(letters)
        out += report.told()
    return out


def _initial(role: str) -> str:
    return role[:1] if role[:1] in AFTER else ""


# --- on Spark ---


def repair_conversations(
    conversations: DataFrame, settings: Settings = Settings(), conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", present: Column | None = None,
) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (hash of the repaired ``role:text`` lines, newline-joined).

    Rows are taken by turn, nulls first; rows of one turn by role, then text. Null roles and texts are one
    space; a null id is a conversation of its own. A row's first fault counts: blank, duplicate (role and text seen
    earlier in the conversation), truncated. A role with any other initial than s, u, a (an empty one too) can
    only be reroled or deleted. Where ``present`` is false a row only makes its conversation known: one without any
    present row gets zeros, an empty audit and the hash of nothing. An empty table gives an empty result; extra
    columns are not looked at. Texts may be of any length, and a conversation of any number of rows.
    """
    return _repaired(conversations, settings, (conv_col, turn_col, role_col, text_col), present, lines=False)


def repaired_rows(
    conversations: DataFrame, settings: Settings = Settings(), conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", present: Column | None = None,
) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (from 0), role, text. Else as ``repair_conversations``."""
    return _repaired(conversations, settings, (conv_col, turn_col, role_col, text_col), present, lines=True)


def _repaired(conversations: DataFrame, s: Settings, names: tuple[str, ...], present: Column | None, lines: bool) -> DataFrame:
    conv_col, turn_col, role_col, text_col = names
    spark = conversations.sparkSession
    kind = conversations.schema[conv_col].dataType.simpleString()
    given = conversations.withColumn("_present", F.lit(True) if present is None else present)
    rows = columns_of(given, conv=conv_col, turn=turn_col, role=role_col, text=text_col, present="_present").select(
        "conv", F.col("turn").cast("bigint").alias("turn"), "present",
        *[F.when(F.col("present"), F.coalesce(F.col(c).cast("string"), F.lit(" "))).alias(c) for c in ("role", "text")],
    )
    order = ["conv", "turn", "role", "text"]
    # The tie lets a bound cut between equal rows.
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    sorted_rows = (
        tied.repartitionByRange(shuffle_partitions(spark), *order, "tie").sortWithinPartitions(*order)
        .withColumn("id", F.monotonically_increasing_id()).drop("tie")
    )
    told = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"
    wanted = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    if lines:
        told, wanted = f"conv_id {kind}, id bigint, role string, text string", ["conv_id", F.col("id").alias("place"), "role", "text"]
    raw = "id bigint, turn bigint, role string, text string, present boolean, fault int, digest binary"
    mixed = f"done boolean, conv_id {kind}, {raw}" if lines else f"done boolean, {told}, {raw}"
    first = stored(sorted_rows.mapInArrow(_finish_inner(s, mixed, lines), mixed), "conversations")
    rest = first.where(~F.col("done")).select(F.col("conv_id").alias("conv"), "id", "turn", "role", "text", "present", "fault", "digest")
    return first.where("done").select(wanted).union(_across(rest, s, told, lines).select(wanted))


def _columns(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _finish_inner(s: Settings, mixed: str, lines: bool):
    """Task: reports of the conversations that lie inside the partition, all others' rows as they are."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(mixed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[tuple[object, list[tuple]]] = []  # finished conversations, to be ranked together
        held: list[tuple] = []  # rows of the conversation that goes on
        passed: list[dict] = []
        current, begun, inner, size, waiting = None, False, False, 0, 0

        def passing(row: tuple) -> None:
            conv, turn, present, role, text, id = row
            passed.append({
                "done": False, "conv_id": conv, "id": id, "turn": turn, "role": role, "text": text, "present": present,
                "fault": fault_of(text) if present else None, "digest": digest_of(conv, role, text) if present else None,
            })

        for batch in batches:
            bytes_out = 0
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or row[0] != current:
                    if inner:
                        whole.append((current, [(t, r, x) for _, t, p, r, x, _ in held if p]))
                        waiting += len(held)
                    # The partition's first conversation may have begun in an earlier one.
                    held, size, inner, current, begun = [], 0, begun, row[0], True
                if inner:
                    held.append(row)
                    size += len(row[4] or "")
                    if len(held) > s.whole_rows or size > s.whole_bytes:
                        for early in held:
                            passing(early)
                        held, inner = [], False
                else:
                    passing(row)
                    bytes_out += len(row[4] or "")
                if len(passed) >= s.batch or bytes_out > s.whole_bytes:
                    yield _columns(passed, schema)
                    passed, bytes_out = [], 0
                if len(whole) >= s.batch or waiting >= s.batch_rows:
                    yield _columns([{"done": True, **told} for told in _solved(whole, lines)], schema)
                    whole, waiting = [], 0
        for row in held:  # the last conversation may go on in a later partition
            passing(row)
        yield _columns(passed + [{"done": True, **told} for told in _solved(whole, lines)], schema)

    return run


def _across(rows: DataFrame, s: Settings, told: str, lines: bool) -> DataFrame:
    """Reports of conversations that span partitions or are too long for a task, by segments."""
    spark = rows.sparkSession
    kind = rows.schema["conv"].dataType.simpleString()
    seg = F.shiftright("id", s.segment_bits)
    # Repeats: a digest's first row, then every row that is not it. Digests hold the conversation.
    firsts = rows.where(F.col("present") & (F.col("fault") != BLANK)).groupBy("digest").agg(F.min("id").alias("first"))
    judged = rows.withColumn("seg", seg).join(firsts.withColumnRenamed("digest", "_d"), F.col("digest") == F.col("_d"), "left")
    again = (F.col("fault") != BLANK) & (F.col("id") != F.col("first"))
    flagged = stored(judged.withColumn("fault", F.when(again, REPEATED).otherwise(F.col("fault"))).drop("_d", "first", "digest"), "segments")
    codes = flagged.where("present").select("conv", "seg", "id", F.substring("role", 1, 1).alias("initial"), "fault")
    keys = ["conv", "seg"]

    def listed(table: pa.Table) -> list[tuple[str, int]]:
        ordered = table.sort_by("id")
        return [(_initial(r), f) for r, f in zip(ordered["initial"].to_pylist(), ordered["fault"].to_pylist(), strict=True)]

    def cross(table: pa.Table) -> pa.Table:
        """Costs from each state at the segment's first row to each state behind its last one."""
        own = listed(table)
        ways = [costs_to_end(own, [0 if end == state else FAR for state in range(4)], False)[0] for end in range(4)]
        flat = [ways[end][state] for state in range(4) for end in range(4)]
        return pa.table({"conv": table["conv"].slice(0, 1), "seg": table["seg"].slice(0, 1), "cross": pa.array([flat], pa.list_(pa.int64()))})

    def behind(table: pa.Table) -> pa.Table:
        """For each segment of a conversation: the costs to the end from behind it."""
        ordered = table.sort_by("seg")
        costs, out = list(END), []
        for number, flat in enumerate(reversed(ordered["cross"].to_pylist())):
            out.append(costs)
            closed = with_inserts(costs) if not number else costs
            costs = [min(flat[4 * state + end] + closed[end] for end in range(4)) for state in range(4)]
        out.reverse()
        last = [False] * (len(out) - 1) + [True]
        return pa.table({"conv": ordered["conv"], "seg": ordered["seg"], "behind": pa.array(out, pa.list_(pa.int64())), "last": pa.array(last)})

    def paths(own: pa.Table, known: pa.Table) -> pa.Table:
        """The segment's part of the audit for each state it may be entered in."""
        codes_here, last = listed(own), known["last"][0].as_py()
        places = costs_to_end(codes_here, known["behind"][0].as_py(), last)
        [found] = least_audits([(codes_here, places, last, (0, 1, 2, 3))])
        return pa.table({
            "conv": pa.chunked_array([known["conv"].combine_chunks().take(pa.array([0] * 4))]), "seg": pa.array([known["seg"][0].as_py()] * 4, pa.int64()),
            "entry": pa.array(range(4), pa.int32()), "leave": pa.array([state for _, state in found], pa.int32()),
            "part": pa.array([audit for audit, _ in found], pa.string()),
        })

    def chosen(table: pa.Table) -> pa.Table:
        """The state in which each segment is entered, from the first one on."""
        ordered = table.sort_by([("seg", "ascending"), ("entry", "ascending")])
        leave, take, state = ordered["leave"].to_pylist(), [], START
        for at in range(0, len(leave), 4):
            take.append(at + state)
            state = leave[at + state]
        return ordered.select(["conv", "seg", "entry"]).take(pa.array(take, pa.int64()))

    on = f"conv {kind}, seg bigint"
    crossed = stored(codes.groupBy(*keys).applyInArrow(cross, f"{on}, cross array<bigint>"), "crossings")
    known = crossed.groupBy("conv").applyInArrow(behind, f"{on}, behind array<bigint>, last boolean")
    parts = stored(
        codes.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInArrow(paths, f"{on}, entry int, leave int, part string"), "paths"
    )
    entered = parts.select("conv", "seg", "entry", "leave").groupBy("conv").applyInArrow(chosen, f"{on}, entry int")
    pick = entered.select(F.col("conv").alias("_c"), F.col("seg").alias("_s"), F.col("entry").alias("_e"))
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("seg") == F.col("_s")) & (F.col("entry") == F.col("_e"))
    audits = parts.join(pick, same, "left_semi").select("conv", "seg", F.lit(-1).cast("bigint").alias("id"), "part")
    stream = (
        flagged.unionByName(audits, allowMissingColumns=True)
        .repartition(shuffle_partitions(spark), "conv").sortWithinPartitions("conv", "seg", "id")
        .select("conv", "id", "turn", "role", "text", "present", "fault", "part")
    )
    return stream.mapInArrow(_read_off(told, lines), told)


def _read_off(told: str, lines: bool):
    """Task: the report, or the repaired rows, of each conversation from its sorted rows, each segment's audit in front of them."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(told))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, letters = None, iter("")
        for batch in batches:
            out = []
            for conv, id, turn, role, text, present, fault, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if report is None or report.conv != conv:
                    if report is not None:
                        report.inserts(letters)
                        out += report.told()
                    report, letters = Report(conv, lines=[] if lines else None), iter("")
                if id < 0:
                    report.audit.append(part)
                    report.inserts(letters)
                    letters = iter(part)
                elif present:
                    report.row(turn, role, text, fault, report.inserts(letters))
            if lines and report is not None:
                out += report.told()
            if out:
                yield _columns(out, schema)
        if report is not None:
            report.inserts(letters)
            yield _columns(report.told(), schema)

    return run


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, drawn by a checksum of ``conv_id:turn``: 0 drops a row (``present`` is false), 1 empties its
    text, 2 takes its sentence ends away, 3 repeats it, 4 makes its role user. Nulls count as one space."""
    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    one, two = (F.array(*[F.lit(0)] * n) for n in (1, 2))
    return (
        conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), draw.alias("draw"))
        .select(
            "conv_id", "turn",
            F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
            (F.col("draw") != 0).alias("present"),
            F.explode(F.when(F.col("draw") == 3, two).otherwise(one)).alias("_copy"),
        )
        .drop("_copy")
    )
