import random

from stayline.llm.line_dedup import dedup_lines

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    docs = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs.setdefault(key(line), set()).add(i)
    low = -(10**9)
    shared = {k: max(d, key=lambda i: low if i is None else i) for k, d in docs.items() if len(d) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in shared or shared[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=str)


def test_against_brute_force(make):
    r = random.Random(1)
    pool = [("Line %d " % i) * r.randrange(3, 12) for i in range(40)] + ["é" * 39, "É" * 40, "  A" * 20, ""]
    rows = [(i, "\n".join(r.choice(pool) + r.choice(["", " ", "\t", "\r"]) for _ in range(r.randrange(1, 9)))) for i in range(150)]
    assert found(dedup_lines(make(rows))) == brute(rows)


def test_edges(make):
    long = "x" * 45
    rows = [(None, long), (None, long + "\n" + long), (1, None), (1, ""), (2, long), (2, long), (3, long.upper()), (4, " " + long),
            (5, long + "\n" + long), (6, "\n"), (7, ("word " * 30 + "\n") * 3000)]
    assert found(dedup_lines(make(rows))) == brute(rows)
    assert dedup_lines(make([])).count() == 0
    assert dedup_lines(make(rows)).columns == make(rows).columns + ["n_lines", "n_dropped"]


def test_hot_line(make):
    rows = [(i, "The same long line that stands in every document.\nown %d" % i) for i in range(4000)]
    assert [r for r in found(dedup_lines(make(rows))) if r[2] == 0] == [(3999, 2, 0, rows[-1][1])]
