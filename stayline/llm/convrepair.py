"""Repair of conversation structure: the cheapest edits that let roles alternate, by iterative-deepening A*."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import BLANK, drop_path, frugal, save

#: Costs of edits, and what a truncated row adds that is not deleted.
COSTS = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED = 3
#: Rows that one search takes; longer conversations are searched block by block, with exact costs of what follows.
BLOCK = 64
#: Rows of a conversation that one row of codes describes.
SEGMENT = 1 << 16

#: States by the last role kept: none, system, user, assistant.  What a user or assistant row, made or kept, leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
TURN = (USER, USER, ASSISTANT, USER)
#: Inserts that end a conversation well from each state.
FINISH = (0, 2, 1, 0)
FAULTS = ("none", "blank", "duplicate", "truncated")
NONE, EMPTY, DUPLICATE, CUT = range(4)
INITIALS = "?sua"
INFINITE = 1 << 60


def after(state: int, kind: int) -> int | None:
    """The state after keeping a row whose initial is ``INITIALS[kind]``, or None if it cannot stand there."""
    if kind == SYSTEM:
        return SYSTEM if state == START else None
    return kind if kind == TURN[state] else None


def moves(code: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, cost, rows taken, next state) for a row, in ASCII order; code: 4 * kind + fault."""
    kind, fault = divmod(code, 4)
    yield "D", COSTS["D"], 1, state
    yield "I", COSTS["I"], 0, TURN[state]
    if fault in (NONE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        if (kept := after(state, kind)) is not None:
            yield "K", COSTS["K"] + extra, 1, kept
        yield "R", COSTS["R"] + extra, 1, TURN[state]


def least(code: int) -> int:
    """No edits of this row cost less."""
    fault = code % 4
    return COSTS["D"] if fault in (EMPTY, DUPLICATE) else min(COSTS["D"], TRUNCATED) if fault == CUT else 0


def search(codes: bytes, state: int, ends: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least of the cheapest edit letters for the rows, and the state they lead to.

    ``ends`` is the cost of what follows, by that state.  Depth-first search in ASCII order under a bound on
    cost so far plus a lower bound of the rest; the bound rises to the least sum that exceeded it.  A table
    holds, for row and state, the largest allowance that has failed, so that no failed state is searched again.
    Inserts stand before a row, so that no sequence of letters begins another.
    """
    n = len(codes)
    rest = [min(ends)] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + least(codes[i])
    path: list[str] = []

    def visit(i: int, state: int, allowance: int) -> int:
        """-1 - the last state if the rest can be done within the allowance, else the least allowance that may do."""
        if i == n:
            return -1 - state if ends[state] <= allowance else ends[state]
        if rest[i] > allowance:
            return rest[i]
        if failed.get((i, state), (-1, 0))[0] >= allowance:
            return failed[i, state][1]
        # While this state is open, coming back to it costs more and gains nothing.
        failed[i, state] = (allowance, INFINITE)
        needed = INFINITE
        for letter, cost, taken, then in moves(codes[i], state):
            path.append(letter)
            found = visit(i + taken, then, allowance - cost)
            if found < 0:
                return found
            path.pop()
            needed = min(needed, found + cost)
        failed[i, state] = (allowance, needed)
        return needed

    bound = rest[0]
    while True:
        failed: dict[tuple[int, int], tuple[int, int]] = {}
        found = visit(0, state, bound)
        if found < 0:
            return "".join(path), -1 - found
        bound = found


def costs_before(codes: bytes, ends: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs of the rows and what follows them, by the state before the rows."""
    for code in reversed(codes):
        own = {s: min(c + ends[t] for letter, c, taken, t in moves(code, s) if taken) for s in range(4)}
        # Two inserts in a row lead back; from the start or a system row they lead to the assistant.
        once = [min(own[s], COSTS["I"] + own[TURN[s]]) for s in range(4)]
        ends = tuple(min(own[s], COSTS["I"] + once[TURN[s]]) for s in range(4))
    return ends


def repair(codes: bytes) -> tuple[str, int]:
    """(edit letters, cost) of a conversation."""
    ends = [tuple(COSTS["I"] * n for n in FINISH)]
    starts = list(range(0, len(codes), BLOCK))
    for at in reversed(starts[1:]):
        ends.append(costs_before(codes[at : at + BLOCK], ends[-1]))
    state, letters = START, []
    for at in starts:
        found, state = search(codes[at : at + BLOCK], state, ends.pop())
        letters.append(found)
    audit = "".join(letters) + "I" * FINISH[state]
    kept = cost_of(codes, audit)
    return audit, kept


def cost_of(codes: bytes, audit: str) -> int:
    total, i = 0, 0
    for letter in audit:
        total += COSTS[letter]
        if letter != "I":
            total += TRUNCATED if letter != "D" and codes[i] % 4 == CUT else 0
            i += 1
    return total


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies) of the rows after damage by a checksum of conversation and turn.

    The remainder by 20 of crc32(``conv:turn``) decides: 0 drops the row, 1 empties its text, 2 takes ``.!?``
    out of it, 3 repeats it, 4 makes it a user's.  A null is one blank, in the checksum as well as in role and text;
    conversation and turn stay null beside that.
    """
    blank = F.lit(" ")
    conv_, turn_ = F.col(conv).cast("string"), F.col(turn).cast("long")
    key = F.concat(F.coalesce(conv_, blank), F.lit(":"), F.coalesce(turn_.cast("string"), blank))
    part = F.crc32(F.encode(key, "UTF-8")) % 20
    body = F.coalesce(F.col(text).cast("string"), blank)
    return rows.where(part != 0).select(
        F.col(conv).alias("conv"),
        turn_.alias("turn"),
        F.when(part == 4, "user").otherwise(F.coalesce(F.col(role).cast("string"), blank)).alias("role"),
        F.when(part == 1, "").when(part == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body).alias("text"),
        F.when(part == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _tagged(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number, the code of the first and of its further copies, and a digest for order."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("digest", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = rows.groupBy("conv", "digest").agg(F.min(at).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    again = again.select(F.col("conv").alias("conv_"), F.col("digest").alias("digest_"), "first")
    rows = rows.join(again, F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("digest") == F.col("digest_")), "left")
    last = F.regexp_extract("text", f"([^{BLANK}])[{BLANK}]*\\z", 1)
    later = F.col("first").isNotNull() & (F.col("first") < at)
    fault = F.when(last == "", EMPTY).when(later, DUPLICATE).when(~last.isin(".", "!", "?"), CUT).otherwise(NONE)
    kind = F.greatest(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1, F.lit(0))
    kind = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), kind).otherwise(0)
    return rows.select(
        "conv", "turn", "role", "text", "copies", "digest",
        (4 * kind + fault).cast("int").alias("code"),
        (4 * kind + F.when(last == "", EMPTY).otherwise(DUPLICATE)).cast("int").alias("code_again"),
    )


ORDER = ["conv", "turn", "role", "digest"]
_SEGMENTS = "part long, number long, codes binary, low long, high long, turns long"


def _codes(tagged: DataFrame) -> DataFrame:
    """(conv, part, number, codes, low, high, turns): rows of a conversation as bytes, in order, up to ``SEGMENT`` each.

    ``turns`` counts the distinct turns of the segment; a turn that goes on from the one before counts there again.
    """
    rows = tagged.select(*ORDER, "copies", "code", "code_again").repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    schema = f"conv {dict(tagged.dtypes)['conv']}, {_SEGMENTS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, done = TaskContext.get().partitionId(), 0, []
        conv, codes, low, high, turns, open_ = None, bytearray(), None, None, 0, False
        kind = None

        def flush():
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([d[0] for d in done], kind),
                    pa.array([part] * len(done), pa.int64()),
                    pa.array([d[1] for d in done], pa.int64()),
                    pa.array([d[2] for d in done], pa.binary()),
                    *(pa.array([d[k] for d in done], pa.int64()) for k in (3, 4, 5)),
                ],
                ["conv", "part", "number", "codes", "low", "high", "turns"],
            )
            done.clear()
            return out

        held = 0
        for batch in batches:
            kind = batch.schema.field("conv").type
            columns = [batch.column(i).to_pylist() for i in (0, 1, 4, 5, 6)]
            for c, turn, copies, code, again in zip(*columns):
                if open_ and c != conv:
                    done.append((conv, number, bytes(codes), low, high, turns))
                    held, number, open_ = held + len(codes), number + 1, False
                if not open_:
                    conv, codes, low, high, turns, open_ = c, bytearray(), None, None, 0, True
                if turn is not None and turn != high:
                    low, high, turns = turn if low is None else low, turn, turns + 1
                codes.append(code)
                copies -= 1
                while copies or len(codes) >= SEGMENT:
                    more = min(copies, SEGMENT - len(codes))
                    codes += bytes([again]) * more
                    copies -= more
                    if len(codes) >= SEGMENT:
                        done.append((conv, number, bytes(codes), low, high, turns))
                        held, number, codes, turns = held + len(codes), number + 1, bytearray(), 0
                        low = high if high is not None else None
                        if held > 1 << 24:
                            yield flush()
                            held = 0
                        turns = 0 if high is None else 1
            if len(done) > 4096:
                yield flush()
                held = 0
        if open_ and codes:
            done.append((conv, number, bytes(codes), low, high, turns))
        if done:
            yield flush()

    return rows.mapInArrow(frugal(run), schema)


def _illegal(codes: bytes) -> int:
    legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
    kinds = [c // 4 for c in codes]
    return sum(pair not in legal for pair in zip(kinds, kinds[1:]))


RESULTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(segments: DataFrame) -> DataFrame:
    """One row per conversation that has rows: its counts and the cheapest edits.

    A conversation's segments come together in order; they hold one byte a row, as long as the audit itself, and no texts.
    """
    schema = f"conv {dict(segments.dtypes)['conv']}, {RESULTS}"
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    rows = segments.repartition("conv").sortWithinPartitions("conv", "part", "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result():
            codes = b"".join(parts)
            faults = [sum(c % 4 == f for c in codes) for f in (EMPTY, DUPLICATE, CUT)]
            audit, cost = repair(codes)
            gaps = high - low + 1 - turns if turns else 0
            return conv, gaps, *faults, _illegal(codes), cost, audit

        conv, parts, low, high, turns, done, kind = None, [], None, None, 0, [], None

        def flush():
            kinds = [kind, *[pa.int64()] * 6, pa.string()]
            columns = [pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            kind = batch.schema.field("conv").type
            for c, codes, first, last, count in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5, 6))):
                if parts and c != conv:
                    done.append(result())
                    parts, low, high, turns = [], None, None, 0
                conv = c
                parts.append(codes)
                if count:
                    turns += count - (high is not None and first == high)
                    low, high = first if low is None else low, last
            if done:
                yield flush()
        if parts:
            done.append(result())
            yield flush()

    return rows.mapInArrow(frugal(run), schema)


def _digests(tagged: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): a conversation's rows stream by once, after its edits; no text is held."""
    rows = tagged.select(*ORDER, F.lit(1).alias("side"), "text", "copies", F.lit(None).cast("string").alias("audit"))
    edits = audits.select(
        "conv",
        *(F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("digest", "string"))),
        F.lit(0).alias("side"), F.lit(None).cast("string").alias("text"), F.lit(1).cast("long").alias("copies"), "audit",
    )
    both = edits.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "side", *ORDER[1:])
    schema = f"conv {dict(tagged.dtypes)['conv']}, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done, kind = None, [], None

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], ["conv", "repaired_sha256"]
            )
            done.clear()
            return out

        for batch in batches:
            kind = batch.schema.field("conv").type
            conv, _, role, _, side, text, copies, audit = (batch.column(k) for k in range(8))
            for c, r, s, t, n, a in zip(conv, role, side, text, copies, audit):
                if s.as_py() == 0:
                    if writer:
                        done.append(writer.end())
                    writer = Rewriter(c.as_py(), a.as_py())
                    continue
                r, t = r.as_py(), t.as_py()
                for _ in range(n.as_py()):
                    writer.row(r, t)
            if done:
                yield flush()
        if writer:
            done.append(writer.end())
            yield flush()

    return both.mapInArrow(frugal(run), schema)


class Rewriter:
    """Applies edits to the rows of a conversation, one after the other; ``put`` gets the pieces of the repaired text."""

    ROLES = {USER: "user", ASSISTANT: "assistant"}

    def __init__(self, conv, audit: str, put=None):
        self.conv, self.audit, self.at, self.state, self.empty = conv, audit, 0, START, True
        self.hash = hashlib.sha256()
        self.put = put or (lambda piece: self.hash.update(piece.encode("utf-8", "surrogatepass")))

    def line(self, role: str, text: str) -> None:
        self.put(("" if self.empty else "\n") + role + ":" + text)
        self.empty = False

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state, self.at = TURN[self.state], self.at + 1
            self.line(self.ROLES[self.state], "")

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "R":
            self.state = TURN[self.state]
            self.line(self.ROLES[self.state], text)
        elif letter == "K":
            self.state = INITIALS.index(role[0])
            self.line(role, text)

    def end(self) -> tuple:
        self.inserts()
        return self.conv, self.hash.hexdigest()


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``rows`` come through ``damage`` first; every original conversation is in the result, null as one of its own.
    Rows stand by turn (nulls first), rows of one turn by role and a digest of role and text, so that copies
    are neighbours.  The edits are the cheapest that give role initials ``(s?(ua)+)?``, of equal ones the ASCII-least.
    A role without an initial, or with another than s, u or a, cannot be kept.  Empty table: empty result.
    Repeated rows count as often as they stand; very long texts are hashed as they stream by; columns besides the four are not
    read, so their names do not matter.

    Scale: rows are sorted by range, so a large conversation is divided among tasks, and leave
    as one byte each; those bytes and the audit, which is a single value of the result, are the only things held
    whole for a conversation.  Its digest is sequential by nature: one task streams its texts.
    """
    ids = rows.select(F.col(conv).alias("conv")).groupBy("conv").count().select("conv")
    tagged, path = save(_tagged(damage(rows, conv, turn, role, text)), "turns")
    audits, path_of_audits = save(_audits(_codes(tagged)), "audits")
    digests = _digests(tagged, audits)
    found = audits.join(digests.withColumnRenamed("conv", "conv_"), F.col("conv").eqNullSafe(F.col("conv_"))).drop("conv_")
    found = ids.join(found.withColumnRenamed("conv", "conv_"), F.col("conv").eqNullSafe(F.col("conv_")), "left")
    zero = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    result, _ = save(
        found.select(
            F.col("conv").alias(conv), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
        ),
        "repaired",
    )
    drop_path(rows.sparkSession, path)
    drop_path(rows.sparkSession, path_of_audits)
    return result
