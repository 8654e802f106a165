"""Cheapest repair of conversations whose turns are missing, doubled, cut off or out of order.

A conversation's rows are taken by turn (nulls first; rows of one turn by role, then text). Each row's first fault
counts: *blank* (only bytes 9-13 and 32), *duplicate* (role and text seen earlier), *truncated* (the last
other character is none of ``.!?``). Edits: Keep (0), Rerole to user or assistant (3), Delete (4, required for blank
and duplicate rows) and Insert an empty user or assistant turn (3); a truncated row that stays adds 3. The
cheapest edits are found whose role initials are ``(s?(ua)+)?``; of equally cheap ones those whose initials,
in order, are least in ASCII.

*Method.* A path of edits is one integer: its cost in the high digits, below it a slot of three letters for each
row (the row's letter after the inserts before it, D=1, I=2, K=3, R=4) and one slot for inserts at the end,
slots and letters being padded with zeros at their ends. Weights of edges add up, so the plain integer minimum
over the graph (row, state of the role pattern) decides cost and ties at once. Every slot but the last ends with
its row's letter, so none begins another one, and the order of slots is the order of the letters.

*Distribution.* Equal rows are first merged into one with a count (map-side combined). Rows are then
range-partitioned by conversation and place, so a conversation may span many partitions. A task solves those
that lie within it; of those at its edges, or longer than ``chunk`` rows, it makes segments, each with the least
weight between any two states. One fold over these small tables (sorted, streamed from the end) chooses the
states between segments; the segments' edits are then applied in parallel. Only a conversation's own audit is
ever held whole, since it is one value of the result.

Why two inserts a slot are enough: two adjacent inserts are a pair that can be left out, unless it is the
only pair behind a system turn.

Defined results: null role or text is one space; a role without an initial of s, u or a cannot be kept; null
conversation ids are one conversation; null turns come first and do not count as turns; rows with count 0 only
name their conversation, which then has zeros, an empty audit and no turns; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
CODES = {"D": 1, "I": 2, "K": 3, "R": 4}
NAMES = {code: letter for letter, code in CODES.items()}
SLOT = 9  # bits: three letters of three bits
BLANK = " \t\n\x0b\x0c\r"
#: The role pattern: states 0 nothing yet, 1 after the system turn, 2 after a user, 3 after an assistant.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The only role a state lets an Insert or a Rerole make.
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLES = {"u": "user", "a": "assistant"}
ENDS = (0, 3)


def slot(letters: str) -> int:
    """Up to three letters, zero-padded at the end."""
    return sum(CODES[x] << (6 - 3 * k) for k, x in enumerate(letters))


@functools.cache
def edges(kind: str) -> tuple[tuple[int, int, int, int], ...]:
    """(state, next state, cost, slot) of the best edit of a row, inserts before it included. ``kind``: the role's
    initial (x: another), upper case if truncated, or D for a row that must go."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for first in range(4):
        state, cost, before = first, 0, ""
        for _ in range(1 if kind == "D" else 3):  # an insert before a deletion is never better than one after it
            ways = [(state, DELETE, "D")]
            if kind != "D":
                extra = CUT_OFF if kind.isupper() else 0
                if (state, kind.lower()) in STEP:
                    ways.append((STEP[state, kind.lower()], KEEP + extra, "K"))
                ways.append((STEP[state, NEXT[state]], REROLE + extra, "R"))
            for to, price, letter in ways:
                way = (cost + price, slot(before + letter))
                best[first, to] = min(best.get((first, to), way), way)
            state, cost, before = STEP[state, NEXT[state]], cost + INSERT, before + "I"
    return tuple((a, b, *way) for (a, b), way in best.items())


@functools.cache
def closing() -> dict[int, tuple[int, int]]:
    """(cost, slot) of the inserts that end the pattern, by state."""
    found = {}
    for first in range(4):
        state, letters = first, ""
        while state not in ENDS:
            state, letters = STEP[state, NEXT[state]], letters + "I"
        found[first] = (INSERT * len(letters), slot(letters))
    return found


def transfer(kinds: str, starts: tuple[int, ...] = (0, 1, 2, 3)) -> dict[int, dict[int, int]]:
    """Least weight from each of ``starts`` to each state over rows of these kinds: cost above one
    slot a row."""
    n = len(kinds)
    high = SLOT * n
    table = {}
    for start in starts:
        now = {start: 0}
        for i, kind in enumerate(kinds):
            place = SLOT * (n - 1 - i)
            following: dict[int, int] = {}
            for a, b, cost, letters in edges(kind):
                if a in now:
                    weight = now[a] + (cost << high) + (letters << place)
                    if b not in following or weight < following[b]:
                        following[b] = weight
            now = following
        table[start] = now
    return table


def join_weights(left: int, right: int, right_slots: int, left_slots: int) -> int:
    """Weight of a path over ``left_slots`` rows followed by one over ``right_slots``."""
    low = SLOT * right_slots
    cost, digits = right >> low, right & ((1 << low) - 1)
    return (left << low) + (cost << (low + SLOT * left_slots)) + digits


def finished(state: int) -> int:
    """Weight of ending the pattern: one slot."""
    cost, letters = closing()[state]
    return (cost << SLOT) + letters


def letters_of(weight: int, slots: int) -> tuple[int, str]:
    """Cost and audit of a weight."""
    size = SLOT * slots
    digits = weight & ((1 << size) - 1)
    raw = oct(digits)[2:].rjust(3 * slots, "0") if slots else ""  # a letter is one octal digit
    return weight >> size, "".join(NAMES[int(x)] for x in raw if x != "0")


@functools.lru_cache(maxsize=1 << 14)
def solve(kinds: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    ends = [join_weights(w, finished(q), 1, len(kinds)) for q, w in transfer(kinds, (0,))[0].items()]
    return letters_of(min(ends), len(kinds) + 1)


def kind_of(role: str, text: str, first: bool) -> tuple[str, str]:
    """(kind for ``edges``, fault) of a row."""
    body = text.strip(BLANK)
    if not body:
        return "D", "blank"
    if not first:
        return "D", "duplicate"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return (initial, "") if body[-1] in ".!?" else (initial.upper(), "truncated")


def apply_edits(rows: list[dict], audit: str, state: int) -> tuple[list[dict], int]:
    """The turns that the edits make of ``rows`` (role, text, n copies of which the last n - 1 are deleted), and
    the state after them."""
    made = []
    letters = iter(audit)

    def put(role: str, text: str, initial: str) -> None:
        nonlocal state
        made.append({"role": role, "text": text})
        state = STEP[state, initial]

    for row in rows:
        left = row["n"]
        while left:
            letter = next(letters)
            if letter == "I":
                put(ROLES[NEXT[state]], "", NEXT[state])
                continue
            left -= 1
            if letter == "K":
                put(row["role"], row["text"], row["role"][0])
            elif letter == "R":
                put(ROLES[NEXT[state]], row["text"], NEXT[state])
    for _ in letters:
        put(ROLES[NEXT[state]], "", NEXT[state])
    return made, state


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
PIECE = ("id {kind}, part int, seq int, open boolean, slots int, blank bigint, duplicate bigint, "
         "truncated bigint, illegal bigint, turns bigint, low bigint, high bigint, first_turn bigint, "
         "last_turn bigint, first_role string, last_role string")
TURNS = "array<struct<role:string,text:string>>"
ROWS = "array<struct<role:string,text:string,n:bigint>>"


class Segment:
    """Rows of one conversation in order, and what is counted of them."""

    def __init__(self, conv, part: int, seq: int):
        self.conv, self.part, self.seq = conv, part, seq
        self.rows: list[dict] = []
        self.kinds: list[str] = []
        self.count = dict.fromkeys(COUNTS, 0)
        self.first_turn = self.last_turn = self.low = self.high = None
        self.first_role = self.last_role = None
        self.size = self.chars = 0

    def add(self, row: dict) -> None:
        n = row["n"]
        if not n:
            return
        turn, initial = row["turn"], row["role"][:1]
        kind, fault = kind_of(row["role"], row["text"], row["first"])
        if fault:
            self.count[fault] += n if fault != "truncated" else 1
        if fault in ("", "truncated"):
            self.count["duplicate"] += n - 1
        self.count["illegal"] += (n - 1) * illegal(initial, initial)
        if self.kinds:
            self.count["illegal"] += illegal(self.last_role, initial)
            self.count["turns"] += turn is not None and turn != self.last_turn
        else:
            self.first_role, self.first_turn = initial, turn
            self.count["turns"] += turn is not None
        self.last_role, self.last_turn = initial, turn
        if turn is not None:
            self.low, self.high = (turn if self.low is None else self.low), turn
        self.rows.append({"role": row["role"], "text": row["text"], "n": n})
        self.kinds.append(kind + "D" * (n - 1))
        self.size += n
        self.chars += len(row["text"])

    def record(self, is_open: bool) -> dict:
        kinds = "".join(self.kinds)
        out = {"id": self.conv, "part": self.part, "seq": self.seq, "open": is_open, "slots": len(kinds),
               "low": self.low, "high": self.high, "first_turn": self.first_turn,
               "last_turn": self.last_turn, "first_role": self.first_role, "last_role": self.last_role,
               **self.count}
        if is_open:
            weights = transfer(kinds)
            width = lambda w: w.to_bytes(w.bit_length() // 8 + 1, "big")
            matrix = [width(weights[a][b]) if b in weights[a] else None for a in range(4) for b in range(4)]
            return {**out, "cost": None, "audit": None, "repaired": None, "rows": self.rows, "matrix": matrix}
        cost, audit = solve(kinds)
        return {**out, "cost": cost, "audit": audit, "repaired": apply_edits(self.rows, audit, 0)[0],
                "rows": None, "matrix": None}


def shared_out(row: dict, most: int):
    """The copies of a row, ``most`` at a time; all but the very first are duplicates (or blank)."""
    yield {**row, "n": min(row["n"], most)}
    for left in range(row["n"] - most, 0, -most):
        yield {**row, "n": min(left, most), "first": False}


def illegal(a: str, b: str) -> int:
    return int(a + b not in ("su", "ua", "au"))


def batches_of(rows: list[dict], schema: pa.Schema, most: int = 256):
    for k in range(0, len(rows), most):
        yield pa.RecordBatch.from_pylist(rows[k:k + most], schema=schema)


def arrow_schema(spark_schema: str, id_type: pa.DataType) -> pa.Schema:
    """The Arrow schema of the columns named in a DDL text whose first column is the id."""
    turns = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(),
             "array<binary>": pa.list_(pa.binary()), TURNS: turns,
             ROWS: pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("n", pa.int64())]))}
    fields = [x.split(" ", 1) for x in spark_schema.split(", ")]
    return pa.schema([(name, id_type if name == "id" else kinds[kind]) for name, kind in fields])


def merged_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, count: Column) -> DataFrame:
    """(id, turn, role, text, n, first, head, r1, r2): equal rows as one with their number; ``first`` marks the earliest
    of a conversation's rows with this role and text. 128-bit hashes name rows, so no text takes part in the joins."""
    either = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select(F.col(conv).alias("id"), F.col(turn).cast("bigint").alias("turn"),
                        either(role).alias("role"), either(text).alias("text"), count.cast("bigint").alias("n"))
    one = plain.groupBy("id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    same = [F.col("id").isNull(), "id", "role", "text"]
    named = stored(one.withColumns({
        "r1": F.xxhash64(F.col("turn").isNull(), "turn", *same),
        "r2": F.xxhash64(F.lit(7), *same, F.col("turn").isNull(), "turn"),
        "g1": F.xxhash64(*same), "g2": F.xxhash64(F.lit(7), *same),
        "head": F.substring("text", 1, 64)}), "rows")
    firsts = named.filter("n > 0").groupBy("g1", "g2").agg(
        F.min(F.struct("turn", "r1", "r2")).alias("m")).select("m.r1", "m.r2", F.lit(True).alias("first"))
    return named.join(firsts, ["r1", "r2"], "left").withColumn(
        "first", F.coalesce("first", F.lit(False))).drop("g1", "g2")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           count: Column | None = None, chunk: int = 1024, chunk_chars: int = 1 << 22) -> DataFrame:
    """Pieces of the repaired conversations: id, (part, seq) in their order, the piece's counts, cost and audit, and
    its turns (array of role and text). Nearly all conversations are one piece; ``open`` marks pieces that
    may have neighbours. ``count`` says how often a row stands (1 where left out)."""
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    order = ["id", "turn", "role", "head", "r1", "r2"]
    placed = merged_rows(rows, conv, turn, role, text, F.lit(1) if count is None else count) \
        .repartitionByRange(partitions, *order).sortWithinPartitions(*order) \
        .select("id", "turn", "role", "text", "n", "first", F.spark_partition_id().alias("part"))
    kind = placed.schema["id"].dataType.simpleString()
    head = PIECE.format(kind=kind)
    made = f"{head}, cost bigint, audit string, repaired {TURNS}, rows {ROWS}, matrix array<binary>"

    def segments(batches):
        now, partial, schema, out = None, True, None, []  # partial: it began before this segment
        for batch in batches:
            schema = schema or arrow_schema(made, batch.schema.field("id").type)
            for row in batch.to_pylist():
                if now is None or now.conv != row["id"]:
                    if now is not None:
                        out.append(now.record(partial))
                        partial = False
                    now = Segment(row["id"], row["part"], now.seq + 1 if now else 0)
                for some in shared_out(row, chunk):
                    if now.size >= chunk or now.chars >= chunk_chars:
                        out.append(now.record(True))
                        partial = True
                        now = Segment(row["id"], row["part"], now.seq + 1)
                    now.add(some)
            yield from batches_of(out, schema)
            out = []
        if now is not None:
            yield from batches_of([now.record(True)], schema)  # the next partition may go on with it

    pieces = stored(placed.mapInArrow(segments, made), "pieces")
    choices = chosen(pieces.filter("open").select("id", "part", "seq", "slots", "matrix"))

    def applied(batches):
        for batch in batches:
            schema = arrow_schema(f"{head}, cost bigint, audit string, repaired {TURNS}",
                                  batch.schema.field("id").type)
            out = []
            for row in batch.to_pylist():
                row["repaired"] = apply_edits(row.pop("rows"), row["audit"], row.pop("state"))[0]
                out.append(row)
            yield from batches_of(out, schema, 16)

    names = [x.split(" ", 1)[0] for x in head.split(", ")]
    solved = pieces.filter("open").drop("cost", "audit", "repaired", "matrix") \
        .join(choices, ["part", "seq"]).select(*names, "cost", "audit", "rows", "state") \
        .mapInArrow(applied, f"{head}, cost bigint, audit string, repaired {TURNS}")
    return pieces.filter("not open").select(*names, "cost", "audit", "repaired").unionByName(solved)


def chosen(matrices: DataFrame) -> DataFrame:
    """(part, seq, state, cost, audit): the state each open segment starts in and its edits.

    The segments of a conversation stream through one task from its end, four suffix weights being held."""
    result = "part int, seq int, state int, cost bigint, audit string"
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()),
                        ("audit", pa.string())])

    def finish(steps: list) -> list[dict]:
        out, state = [], 0
        for k, (part, seq, slots, table) in enumerate(reversed(steps)):
            to, weight = table[state]
            if k == len(steps) - 1:
                weight, slots = join_weights(weight, finished(to), 1, slots), slots + 1
            cost, audit = letters_of(weight, slots)
            out.append({"part": part, "seq": seq, "state": state, "cost": cost, "audit": audit})
            state = to
        return out

    def fold(batches):
        conv, steps, after, length = None, [], {}, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not steps or row["id"] != conv:
                    out += finish(steps)
                    conv, steps, length = row["id"], [], 1
                    after = {q: finished(q) for q in range(4)}
                table, suffix = {}, {}
                for a in range(4):
                    own = {b: int.from_bytes(raw, "big") for b, raw in enumerate(row["matrix"][4 * a:4 * a + 4])
                           if raw is not None}
                    ways = [(join_weights(w, after[b], length, row["slots"]), b, w) for b, w in own.items()]
                    suffix[a], to, weight = min(ways)
                    table[a] = (to, weight)
                steps.append((row["part"], row["seq"], row["slots"], table))
                after, length = suffix, length + row["slots"]
            yield from batches_of(out, schema)
        yield from batches_of(finish(steps), schema)

    return matrices.repartition("id").sortWithinPartitions("id", F.desc("part"), F.desc("seq")) \
        .mapInArrow(fold, result)


REPORT = ("id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")


def report(pieces: DataFrame) -> DataFrame:
    """One row a conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit and the SHA-256 of its repaired
    ``role:text`` lines. Conversations of one piece need no shuffle; the pieces of others stream
    through one task in order, their texts going into the digest and nothing else."""
    kind = pieces.schema["id"].dataType.simpleString()
    text = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    whole = pieces.filter("not open").select(
        "id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), "blank",
        "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(text, 256).alias("repaired_sha256"))
    result = REPORT.format(kind=kind)

    def fold(batches):
        now, schema = None, None
        for batch in batches:
            schema = schema or arrow_schema(result, batch.schema.field("id").type)
            out = []
            for row in batch.to_pylist():
                if now is None or now["id"] != row["id"]:
                    if now is not None:
                        out.append(ended(now))
                    now = {"id": row["id"], "cost": 0, "audit": [], "digest": hashlib.sha256(), "turn": None,
                           "role": None, "low": None, "high": None, "any": False, **dict.fromkeys(COUNTS, 0)}
                for c in COUNTS:
                    now[c] += row[c]
                if row["first_role"] is not None:
                    if now["role"] is not None:
                        now["illegal"] += illegal(now["role"], row["first_role"])
                    if now["turn"] is not None and now["turn"] == row["first_turn"]:
                        now["turns"] -= 1
                    now["role"], now["turn"] = row["last_role"], row["last_turn"]
                if row["low"] is not None:
                    now["low"] = row["low"] if now["low"] is None else now["low"]
                    now["high"] = row["high"]
                now["cost"] += row["cost"]
                now["audit"].append(row["audit"])
                for x in row["repaired"]:
                    now["digest"].update(("\n" * now["any"] + f"{x['role']}:{x['text']}").encode())
                    now["any"] = True
            yield from batches_of(out, schema)
        if now is not None:
            yield from batches_of([ended(now)], schema)

    def ended(now: dict) -> dict:
        gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
        return {"id": now["id"], "gaps": gaps, "audit": "".join(now["audit"]),
                "repaired_sha256": now["digest"].hexdigest(),
                **{k: now[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")}}

    return whole.unionByName(pieces.filter("open").repartition("id").sortWithinPartitions("id", "part", "seq")
                             .mapInArrow(fold, result))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Test damage by crc32(``conv:turn``) modulo 20 (nulls: one space): 0 drops the row (n = 0), 1 empties its text,
    2 removes its ``[.!?]``, 3 doubles it (n = 2), 4 makes its role user. All others stay (n = 1)."""
    either = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(either(conv), F.lit(":"), either(turn)).cast("binary")) % 20
    return rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(hit == 4, "user").otherwise(either(role)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(either(text), "[.!?]", ""))
        .otherwise(either(text)).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("n"))
