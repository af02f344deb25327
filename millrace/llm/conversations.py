"""Repair of conversation structure: the cheapest edits by a search from both ends of the edit lattice."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns, tasks_for
from millrace.session import pin

BLANKS = " \t\n\v\f\r"
ENDINGS = ".!?"

# Costs of the edits.
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3

# Rows and bytes up to which a conversation is repaired in one piece; others go part by part.
WHOLE_ROWS = 2_000
WHOLE_BYTES = 64 << 20
# Rows of a part, a power of two, and parts that are joined at a time, as a power of two.
PART_ROWS = 256
FAN_BITS = 15
BYTES_PER_TASK = 64 << 20

# A state is what the repaired rows so far end with: nothing, a system, user or assistant row.
STATES = "0sua"
# The role that may be put next, by a new row or a new role.
NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}
KEEP = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}
# Rows put at the very end, by state.
CLOSING = {"0": "", "s": "ua", "u": "a", "a": ""}

REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
ARROW = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
TURNS = "conv_id long, part long, place long, edit string, role string, text string"


def damaged(conversations: DataFrame) -> DataFrame:
    """Damage rows by the checksum of ``conv_id:turn``; rows that are taken away have ``absent`` set.

    Of 20 remainders 0 takes a row, 1 empties the text, 2 takes its full stops, question and
    exclamation marks, 3 repeats the row and 4 makes it a user's. NULLs count as one blank, in the key too.
    """
    rows = columns(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return rows.withColumn("kind", kind).select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ENDINGS, "")).otherwise(text).alias("text"),
        (F.col("kind") == 0).alias("absent"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


# The edit lattice. A node is (rows used, state). A signature has one letter per row: the initial of its
# role (x for none that fits), in capitals if the text is truncated, or d if the row has to go.


def _ahead(signature: str, tail: bool, i: int, state: str) -> Iterator[tuple[str, int, tuple[int, str]]]:
    """Edges that leave a node: letter, cost, next node."""
    if i < len(signature) or tail:
        yield "I", INSERT, (i, NEXT[state])
    if i < len(signature):
        row = signature[i]
        yield "D", DELETE, (i + 1, state)
        if row != "d":
            more = TRUNCATED if row.isupper() else 0
            yield "R", REROLE + more, (i + 1, NEXT[state])
            kept = KEEP.get((state, row.lower()))
            if kept:
                yield "K", more, (i + 1, kept)


def _behind(signature: str, tail: bool, i: int, state: str) -> Iterator[tuple[str, int, tuple[int, str]]]:
    """Edges that reach a node: letter, cost, node before."""
    for before in STATES:
        if i < len(signature) or tail:
            if NEXT[before] == state:
                yield "I", INSERT, (i, before)
        if i:
            row = signature[i - 1]
            if before == state:
                yield "D", DELETE, (i - 1, before)
            if row != "d":
                more = TRUNCATED if row.isupper() else 0
                if NEXT[before] == state:
                    yield "R", REROLE + more, (i - 1, before)
                if KEEP.get((before, row.lower())) == state:
                    yield "K", more, (i - 1, before)


def cheapest_edits(signature: str, start: str = "0", ends: str = "0a", tail: bool = True) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from ``start`` to one of ``ends``, the least audit of all.

    Dijkstra's search runs from both ends, the cheaper heap first, until no pair of nodes still
    waiting can be as cheap as the best meeting; so all meetings of that cost are there, and
    the least concatenation of an audit to the meeting and one from it is taken. Labels are
    (cost, audit): audits to one node at one cost never begin with each other, as the longer one
    would only insert and cost more, so the least of a concatenation has least parts. Edges without
    cost use up a row; ties wait in order of rows, which makes a settled label final.
    ``tail`` allows insertions behind the last row.
    """
    n, none = len(signature), (float("inf"), "")
    first = {(0, start)}
    last = {(n, end) for end in ends}
    labels = ({node: (0, "") for node in first}, {node: (0, "") for node in last})
    heaps = ([(0, i, q) for i, q in first], [(0, -i, q) for i, q in last])
    settled: tuple[set, set] = (set(), set())
    best = float("inf")
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = int(heaps[1][0][0] < heaps[0][0][0])
        cost, i, state = heapq.heappop(heaps[side])
        node = (abs(i), state)
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = labels[side][node][1]
        best = min(best, cost + labels[1 - side].get(node, none)[0])
        for letter, more, other in (_behind if side else _ahead)(signature, tail, *node):
            label = (cost + more, letter + audit if side else audit + letter)
            if label < labels[side].get(other, none):
                labels[side][other] = label
                heapq.heappush(heaps[side], (label[0], -other[0] if side else other[0], other[1]))
                best = min(best, label[0] + labels[1 - side].get(other, none)[0])
    if best == float("inf"):
        return None
    fore, back = settled[0] | first, settled[1] | last
    met = [labels[0][v][1] + labels[1][v][1] for v in fore & back if labels[0][v][0] + labels[1][v][0] == best]
    for v in fore:
        cost, audit = labels[0][v]
        for letter, more, w in _ahead(signature, tail, *v):
            if w in back and cost + more + labels[1][w][0] == best:
                met.append(audit + letter + labels[1][w][1])
    return int(best), min(met)


class Edits(dict):
    """Cheapest edits per (signature, start, ends, tail); a task remembers those of short signatures."""

    def __missing__(self, key: tuple) -> tuple[int, str] | None:
        found = cheapest_edits(*key)
        if len(key[0]) <= 32 and len(self) < 50_000:
            self[key] = found
        return found


def apply_edits(audit: str, rows: list[tuple[str, str]], state: str = "0") -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of every repaired row; the state before it decides new roles."""
    left = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit == "K":
            state = KEEP[state, role[0]]
        else:
            state = NEXT[state]
            role = NAMES[state]
        yield edit, role, text


# What is known of a stretch of rows, and how stretches are joined.


class Stretch:
    """Faults, order of roles and turns, and signature of consecutive rows of a conversation."""

    def __init__(self, rows: list[tuple], seen: set | None):
        """Rows are (turn, role, text, again); ``seen`` finds repeated rows itself, else ``again`` says so."""
        self.rows = [(role, text) for _, role, text, _ in rows]
        letters, initials, self.blank, self.duplicate, self.truncated = [], [], 0, 0, 0
        for _, role, text, again in rows:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            initials.append(initial)
            if seen is not None:
                again = (role, text) in seen
                seen.add((role, text))
            text = text.rstrip(BLANKS)
            if not text:
                self.blank += 1
                initial = "d"
            elif again:
                self.duplicate += 1
                initial = "d"
            elif text[-1] not in ENDINGS:
                self.truncated += 1
                initial = initial.upper()
            letters.append(initial)
        self.signature = "".join(letters)
        self.initials = "".join(initials)
        self.illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {turn for turn, *_ in rows if turn is not None}
        self.low, self.high, self.turns = min(turns, default=None), max(turns, default=None), len(turns)

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _hashed(parts: Iterator[str]) -> str:
    digest, first = hashlib.sha256(), True
    for part in parts:
        digest.update(part.encode() if first else b"\n" + part.encode())
        first = False
    return digest.hexdigest()


def _whole(conv_id: int | None, rows: list[tuple], turns: bool, edits: Edits) -> list[tuple]:
    """Report, or repaired rows, of a conversation given in one piece."""
    held = Stretch(rows, set())
    cost, audit = edits[held.signature, "0", "0a", True]
    repaired = apply_edits(audit, held.rows)
    if turns:
        return [(conv_id, 0, i, *row) for i, row in enumerate(repaired)]
    hashed = _hashed(f"{role}:{text}" for _, role, text in repaired)
    return [(conv_id, held.gaps(), held.blank, held.duplicate, held.truncated, held.illegal, cost, audit, hashed)]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Consecutive rows with equal first ``keys`` columns, across batches."""
    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns]))
    return groupby(rows, key=lambda row: row[:keys])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _streamed(df: DataFrame, keys: list[str], order: list[Column], work, schema: str, tasks: int) -> DataFrame:
    """Groups of equal keys, each in order in one task, that ``work(key, rows, edits)`` turns into rows as they pass by."""
    arrow, n = pa.schema([(name, ARROW[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))]), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits = Edits()
        yield from _batches((row for key, rows in _groups(batches, n) for row in work(key, rows, edits)), arrow)

    return df.repartition(tasks, *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _repair_whole(rows: DataFrame, turns: bool, tasks: int) -> DataFrame:
    def work(key: tuple, group: Iterator[tuple], edits: Edits) -> list[tuple]:
        return _whole(key[0], [(t, r, x, None) for _, t, r, x, absent in group if not absent], turns, edits)

    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return _streamed(rows.select("conv_id", "turn", "role", "text", "absent"), ["conv_id"], order, work, TURNS if turns else REPORT, tasks)


# Conversations too large for one piece. Rows get their place by a range sort that splits a conversation over tasks.
# A part of PART_ROWS rows is summed up by the cheapest cost, and the rank of the least audit, for each state
# before it and each state behind its last row. Sums of neighbouring parts join into one of the same kind, so a tree of them
# gives the states between all parts, and each part then finds its own edits.

SUMMARY = (
    "conv_id long, part long, cost array<long>, rank array<long>, first string, last string, illegal long, "
    "blank long, duplicate long, truncated long, low long, high long, turns long"
)
LINK = "conv_id long, part long, entry string, exit string"
PIECE = "conv_id long, part long, audit string, body string"


def _summed(conv_id: int | None, part: int, rows: list[tuple], edits: Edits) -> tuple:
    held = Stretch(rows, None)
    cost, rank = [], []
    for entry in STATES:
        found = [edits[held.signature, entry, end, False] for end in STATES]
        order = sorted(f[1] for f in found if f)
        cost += [f[0] if f else None for f in found]
        rank += [order.index(f[1]) if f else None for f in found]
    return (
        conv_id, part, cost, rank, held.initials[0], held.initials[-1], held.illegal, held.blank, held.duplicate,
        held.truncated, held.low, held.high, held.turns,
    )


def _joined_costs(one: tuple[list, list], two: tuple[list, list]) -> tuple[list, list, list]:
    """Cost and rank of two neighbouring stretches as one, and the state between them.

    Audits of stretches end with a letter that uses a row, so none begins with another one of the
    same entry and the earlier stretch decides their order.
    """
    cost, rank, middle = [], [], []
    for entry in range(4):
        found = []
        for end in range(4):
            ways = [
                (one[0][4 * entry + m] + two[0][4 * m + end], one[1][4 * entry + m], two[1][4 * m + end], m)
                for m in range(4) if one[0][4 * entry + m] is not None and two[0][4 * m + end] is not None
            ]
            found.append(min(ways, default=None))
        order = sorted(f[1:3] for f in found if f)
        cost += [f[0] if f else None for f in found]
        rank += [order.index(f[1:3]) if f else None for f in found]
        middle += [f[3] if f else None for f in found]
    return cost, rank, middle


def _join_parts(key: tuple, rows: Iterator[tuple], _: Edits) -> list[tuple]:
    """One summary for the consecutive summaries of a group; key is (conv_id, group)."""
    out: list | None = None
    for _, _, _, cost, rank, first, last, illegal, blank, duplicate, truncated, low, high, turns in rows:
        if out is None:
            out = [cost, rank, first, last, illegal, blank, duplicate, truncated, low, high, turns]
            continue
        cost, rank, _ = _joined_costs((out[0], out[1]), (cost, rank))
        apart = illegal + (out[3] + first not in ("su", "ua", "au"))
        shared = int(out[9] is not None and out[9] == low)
        out = [
            cost, rank, out[2], last, out[4] + apart, out[5] + blank, out[6] + duplicate, out[7] + truncated,
            low if out[8] is None else out[8], out[9] if high is None else high, out[10] + turns - shared,
        ]
    return [(key[0], key[1], *out)]


def _split_states(key: tuple, rows: Iterator[tuple], _: Edits) -> list[tuple]:
    """States around every part of a group, from those around the group; rows end with entry and exit of it."""
    parts, costs, middles, joined = [], [], [], None
    entry = end = ""
    for row in rows:
        part, cost, rank, entry, end = row[2:]
        parts.append(part)
        if joined is None:
            joined = (cost, rank)
        else:
            *joined, middle = _joined_costs(joined, (cost, rank))
            middles.append(middle)
    first, now = STATES.index(entry), STATES.index(end)
    ends = [now]
    for middle in reversed(middles):
        now = middle[4 * first + now]
        ends.append(now)
    ends.reverse()
    starts = [first, *ends[:-1]]
    return [(key[0], part, STATES[a], STATES[b]) for part, a, b in zip(parts, starts, ends)]


def _repair_split(rows: DataFrame, turns: bool, tasks: int) -> DataFrame:
    # Equal rows may stand in any order, so a random last key splits crowds of them.
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("__salt")]
    placed = pin(
        rows.where("NOT absent").select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("__salt"))
        .repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()).drop("__salt")
    )
    same = F.sha2(F.to_json(F.struct("role", "text")).cast("binary"), 256).alias("same")
    firsts = placed.groupBy("conv_id", same).agg(F.min("place").alias("place")).select("place", F.lit(False).alias("again"))
    parts = pin(
        placed.join(firsts, "place", "left").select(
            "conv_id", F.expr(f"place div {PART_ROWS}").alias("part"), "place", "turn", "role", "text",
            F.coalesce("again", F.lit(True)).alias("again"),
        )
    )

    def summed(key: tuple, group: Iterator[tuple], edits: Edits) -> list[tuple]:
        return [_summed(*key, [row[3:] for row in group], edits)]

    levels = [pin(_streamed(parts, ["conv_id", "part"], [F.col("place")], summed, SUMMARY, tasks))]
    while levels[-1].groupBy("conv_id").count().where("count > 1").take(1):
        rest = [c for c in levels[-1].columns if c != "conv_id"]
        grouped = levels[-1].select("conv_id", F.shiftright("part", FAN_BITS).alias("group"), *rest)
        levels.append(pin(_streamed(grouped, ["conv_id", "group"], [F.col("part")], _join_parts, SUMMARY, tasks)))

    closing = F.create_map(*[x for q, roles in CLOSING.items() for x in (F.lit(q), F.lit(len(roles) * INSERT))])
    ways = F.array(*[
        F.when(F.col("cost")[k].isNotNull(), F.struct((F.col("cost")[k] + closing[q]).alias("cost"), F.col("rank")[k].alias("rank"), F.lit(q).alias("exit")))
        for k, q in enumerate(STATES)
    ])
    top = levels[-1].withColumn("best", F.array_min(F.filter(ways, lambda w: w.isNotNull())))
    links = top.select("conv_id", "part", F.lit("0").alias("entry"), F.col("best.exit").alias("exit"))
    for level in reversed(levels[:-1]):
        above = links.select(F.col("conv_id").alias("c"), F.col("part").alias("group"), "entry", "exit")
        below = level.withColumn("group", F.shiftright("part", FAN_BITS))
        tied = below.join(above, below["conv_id"].eqNullSafe(above["c"]) & (below["group"] == above["group"])).select(
            "conv_id", below["group"], "part", "cost", "rank", "entry", "exit"
        )
        links = pin(_streamed(tied, ["conv_id", "group"], [F.col("part")], _split_states, LINK, tasks))

    links = links.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "entry", "exit")
    edited = parts.join(links, parts["conv_id"].eqNullSafe(links["c"]) & (parts["part"] == links["p"])).select(
        "conv_id", "part", "place", "turn", "role", "text", "again", "entry", "exit"
    )
    def repaired(group: Iterator[tuple], edits: Edits) -> tuple[str, list[tuple[str, str, str]]]:
        held = list(group)
        stretch = Stretch([row[3:7] for row in held], None)
        entry, end = held[0][7:]
        audit = edits[stretch.signature, entry, end, False][1]
        return audit, list(apply_edits(audit, stretch.rows, entry))

    put = F.array([F.lit(NAMES[q]) for q in "ua"])
    added = F.when(F.col("best.exit") == "s", put).when(F.col("best.exit") == "u", F.slice(put, 2, 1)).otherwise(F.slice(put, 1, 0))
    behind = F.lit(1 << 62).alias("part")
    if turns:
        def rows_of(key: tuple, group: Iterator[tuple], edits: Edits) -> list[tuple]:
            return [(*key, i, *row) for i, row in enumerate(repaired(group, edits)[1])]

        ends = top.select("conv_id", behind, F.posexplode(added)).select(
            "conv_id", "part", F.col("pos").cast("long").alias("place"), F.lit("I").alias("edit"), F.col("col").alias("role"),
            F.lit("").alias("text"),
        )
        return _streamed(edited, ["conv_id", "part"], [F.col("place")], rows_of, TURNS, tasks).unionByName(ends)

    def piece(key: tuple, group: Iterator[tuple], edits: Edits) -> list[tuple]:
        audit, made = repaired(group, edits)
        return [(*key, audit, "\n".join(f"{role}:{text}" for _, role, text in made))]

    pieces = _streamed(edited, ["conv_id", "part"], [F.col("place")], piece, PIECE, tasks)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    counts = F.array(gaps, *[F.col(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.col("best.cost"))
    ends = top.select(
        "conv_id", behind, F.repeat(F.lit("I"), F.size(added)).alias("audit"),
        F.array_join(F.transform(added, lambda r: F.concat(r, F.lit(":"))), "\n").alias("body"), counts.alias("counts"),
    )

    def report(key: tuple, group: Iterator[tuple], _: Edits) -> list[tuple]:
        """The parts of a conversation pass by in order; only their audits are held."""
        digest, audits, found, apart = hashlib.sha256(), [], [], b""
        for _, _, audit, body, counts in group:
            audits.append(audit)
            found = counts or found
            if body:
                digest.update(apart + body.encode())
                apart = b"\n"
        return [(*key, *found, "".join(audits), digest.hexdigest())]

    told = pieces.withColumn("counts", F.lit(None).cast("array<long>")).unionByName(ends)
    return _streamed(told, ["conv_id"], [F.col("part")], report, REPORT, tasks)


def _repair(rows: DataFrame, turns: bool, whole_rows: int, whole_bytes: int) -> DataFrame:
    sizes = pin(rows.groupBy("conv_id").agg(
        F.sum(F.when(F.col("absent"), 0).otherwise(1)).alias("n"),
        F.sum(F.when(F.col("absent"), 0).otherwise(F.octet_length("text") + F.octet_length("role"))).alias("bytes"),
    ))
    large = pin(sizes.where((F.col("n") > whole_rows) | (F.col("bytes") > whole_bytes)).select(F.col("conv_id").alias("large_id")))
    tasks = tasks_for(rows, sizes.agg(F.sum("bytes")).first()[0] or 0, BYTES_PER_TASK)
    if not large.take(1):
        return _repair_whole(rows, turns, tasks)
    same = rows["conv_id"].eqNullSafe(large["large_id"])
    small = _repair_whole(rows.join(large, same, "left_anti"), turns, tasks)
    return small.unionByName(_repair_split(rows.join(large, same, "left_semi"), turns, tasks))


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, absent_col: str | None) -> DataFrame:
    absent = F.coalesce(F.col(f"`{absent_col}`"), F.lit(False)) if absent_col else F.lit(False)
    return conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"),
        absent.alias("absent"),
    )


def repair_conversations(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", absent_col: str | None = None, whole_rows: int = WHOLE_ROWS, whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """Faults of every conversation and the cheapest edits that give its roles the order ``(system? (user assistant)+)?``.

    Rows are taken by turn, NULLs first, then role and text. A row's first fault counts: blank
    (nothing but ASCII blanks), duplicate (same role and text as an earlier row), truncated (does not end
    with a full stop, question or exclamation mark). Keep costs 0, a new role (user or assistant) 3, Delete 4
    (required for blank and duplicate rows), Insert of an empty user or assistant row 3, and a truncated row that stays 3
    more. Of equally cheap edits the audit, their initials in order, is the least. ``gaps`` counts
    turns missing between smallest and largest, ``illegal`` neighbours whose role initials are not su, ua or au.

    NULL role and text count as one blank; rows of NULL conversation are one conversation. Rows
    where ``absent_col`` holds are not there, but their conversation is reported: without rows it has
    zeros, an empty audit and the hash of nothing. Repeated rows are duplicates; an empty table gives
    no rows; further columns are ignored. A conversation beyond ``whole_rows`` or ``whole_bytes``
    is repaired part by part over many tasks, with the same result; only its hash, which
    is one chain by definition, passes through one task as a stream. Returns REPORT.
    """
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col, absent_col)
    return _repair(rows, False, whole_rows, whole_bytes)


def repaired_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", absent_col: str | None = None, whole_rows: int = WHOLE_ROWS, whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """The repaired rows themselves, in order of (part, place) within a conversation; cases as in ``repair_conversations``."""
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col, absent_col)
    return _repair(rows, True, whole_rows, whole_bytes)
