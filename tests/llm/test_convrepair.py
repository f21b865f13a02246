import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from stayline.llm import convrepair
from stayline.llm.convrepair import repair, repair_conversations, search

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("role", "text", "code", "digest", "conv", "audit", "Copies")]
)
SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired lines) over all edits, by the pattern of the result; rows: (role, text, fault)."""
    fills = [f for n in range(3) for f in itertools.product("ua", repeat=n)]
    names = {"u": "user", "a": "assistant"}
    best = None
    choices = []
    for role, _, fault in rows:
        own = [("D", "", 4)]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault == "truncated" else 0
            own += [("K", role[:1], extra), ("R", "u", 3 + extra), ("R", "a", 3 + extra)]
        choices.append(own)
    for picked in itertools.product(*choices):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            cost = sum(p[2] for p in picked) + 3 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            made = "".join("".join(g) + p[1] for g, p in zip(gaps, picked)) + "".join(gaps[-1])
            if not re.fullmatch("(s?(ua)+)?", made):
                continue
            audit = "".join("I" * len(g) + p[0] for g, p in zip(gaps, picked)) + "I" * len(gaps[-1])
            lines = []
            for g, p, r in zip(gaps, picked, rows):
                lines += [names[x] + ":" for x in g]
                lines += [f"{r[0]}:{r[1]}"] if p[0] == "K" else [f"{names[p[1]]}:{r[1]}"] if p[0] == "R" else []
            lines += [names[x] + ":" for x in gaps[-1]]
            best = min(best or (10**9,), (cost, audit, lines))
    return best


def dynamic(rows):
    """The same by dynamic programming over all prefixes of the result, for longer conversations."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    table = {"": (0, "", []), "a": (0, "", []), "u": (3, "I", ["assistant:"]), "s": (6, "II", ["user:", "assistant:"])}
    for role, text, fault in reversed(rows):
        new = {}
        for last in table:
            found = []
            for n in range(3):
                at, front, lines = last, "I" * n, []
                for _ in range(n):
                    at = step[at][-1]
                    lines = [*lines, names[at] + ":"]
                def add(cost, letter, then, own):
                    c, a, rest = table[then]
                    found.append((3 * n + cost + c, front + letter + a, lines + own + rest))
                add(4, "D", at, [])
                if fault not in ("blank", "duplicate"):
                    extra = 3 if fault == "truncated" else 0
                    if role[:1] and role[:1] in step[at]:
                        add(extra, "K", role[:1], [f"{role}:{text}"])
                    turn = step[at][-1]
                    add(3 + extra, "R", turn, [f"{names[turn]}:{text}"])
            new[last] = min(found)
        table = new
    return table[""]


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        fault = "none"
        if not text.strip(SPACE):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.strip(SPACE)[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(table, solve):
    conversations = {}
    for conv, turn, role, text in table:
        rows = conversations.setdefault(conv, [])
        own = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{own(conv)}:{own(turn)}".encode()) % 20
        role, text = own(role), own(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    result = {}
    for conv, rows in conversations.items():
        order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest())
        rows.sort(key=order)
        marked = faults([r[1:] for r in rows])
        turns = {r[0] for r in rows if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[:1] + b[:1] for (a, _, _), (b, _, _) in zip(marked, marked[1:])]
        count = lambda f: sum(m[2] == f for m in marked)
        cost, audit, lines = solve(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"),
                        sum(len(p) < 2 or p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return result


def found(spark, table):
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in table], SCHEMA)
    rows = repair_conversations(df).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def random_conversations(seed, n, longest, roles=("system", "user", "assistant", "assistant", "user", "tool", "User", None)):
    r = random.Random(seed)
    texts = ["Yes.", "Yes.", "no", "What?", "", " \t", None, "Go on!", "x. ", "a.\n\x0b", "é", "é.", " "]
    table = []
    for conv in range(n):
        for turn in range(r.randint(1, longest)):
            table.append((conv, r.choice([turn, turn, turn, 2 * turn, None]), r.choice(roles), r.choice(texts)))
    return table


@pytest.mark.parametrize("rows", [*itertools.product("?sua", repeat=2), *itertools.product("sua", repeat=3)])
def test_search_against_all_edits(rows):
    r = random.Random("".join(rows))
    for _ in range(2):
        marked = [(x, "t", r.choice(["none", "none", "blank", "duplicate", "truncated"])) for x in rows]
        codes = bytes(4 * convrepair.INITIALS.index(m[0]) + convrepair.FAULTS.index(m[2]) for m in marked)
        cost, audit, _ = cheapest(marked)
        assert repair(codes) == (audit, cost)
        assert dynamic(marked)[:2] == (cost, audit)


def test_blocks_do_not_matter(monkeypatch):
    r = random.Random(3)
    for n in (0, 1, 63, 64, 65, 700):
        marked = [(r.choice("?suauaua"), "t", r.choice(["none"] * 5 + ["blank", "duplicate", "truncated"])) for _ in range(n)]
        codes = bytes(4 * convrepair.INITIALS.index(m[0]) + convrepair.FAULTS.index(m[2]) for m in marked)
        cost, audit, _ = dynamic(marked)
        for block in (1, 3, 64):
            monkeypatch.setattr(convrepair, "BLOCK", block)
            assert repair(codes) == (audit, cost)
    assert search(b"", 0, (0, 6, 3, 0)) == ("", 0)


def test_conversations_against_all_edits(spark):
    table = random_conversations(1, 60, 3)
    assert found(spark, table) == expected(table, cheapest)


def test_conversations(spark):
    table = random_conversations(2, 150, 9) + [(None, None, None, None), (None, 3, "user", "Hi."), (None, 3, "user", "Hi.")]
    table += [(900, 2**62, "user", "Far."), (900, -5, "assistant", "Near.")]
    assert found(spark, table) == expected(table, dynamic)


def test_long_conversation_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(convrepair, "SEGMENT", 50)
    r = random.Random(5)
    table = [(1, t, r.choice(["user", "assistant"]), r.choice(["Yes.", f"n{t}.", "no"])) for t in range(3000)]
    table += [(2, 7, "user", "The same.")] * 400 + [(2, 8, "assistant", "long " * 50_000 + ".")]
    table += [(3, t, "user", f"u{t}.") for t in range(120)]
    assert found(spark, table) == expected(table, dynamic)


def test_empty_table(spark):
    assert found(spark, []) == {}
