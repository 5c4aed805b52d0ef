"""Quotation linking against plain Python and against DuckDB on conversations with quotes."""

import random
import re

import duckdb
import pandas as pd

from opsgrain.llm import quotes
from opsgrain.llm.queries import ORACLE

KIND = "conv_id bigint, turn bigint, role string, text string, mid string, position string"
SAYS = re.compile("(?i)^[ \t]*(?:on|le|am|el) .{1,200}(?:wrote|écrit|schrieb|escribió)[^:]{0,80}:[ \t]*$")


def norm(text):
    return re.sub("[ \t-\r]+", " ", "".join(c.lower() if c.isascii() else c for c in text)).strip(" ")


def runs_of(text):
    lines = re.split("\r\n|\r|\n", text or "")
    marks = [re.match("(?:[ \t]*>)*", x)[0].count(">") for x in lines]
    bodies = [re.sub("^(?:[ \t]*>)+ ?", "", x) for x in lines]
    for i in range(len(lines) - 1):
        if marks[i] == 0 and marks[i + 1] > 0 and SAYS.match(lines[i]):
            marks[i] = -1
    out = []
    for m, b in zip(marks, bodies):
        if not out or out[-1][0] != m:
            out.append((m, []))
        out[-1][1].append(b)
    return out, marks, bodies


def units_of(lines):
    whole = "\n".join(lines)
    levels = [[whole], re.split("\n[ \t]*\n", whole), lines]
    return {(k, norm(t)) for k, level in enumerate(levels) for t in level if norm(t)}


def brute(rows):
    """row -> (text, n_quotes, max_depth, n_linked, reply_to, thread, position) of messages with different turns."""
    out, reply = {}, {}
    for i, (conv, turn, _, text) in enumerate(rows):
        runs, marks, bodies = runs_of(text)
        quoted = [(d, x) for d, x in runs if d > 0]
        links = []
        for depth, lines in quoted:
            scores = {}
            for level, t in units_of(lines):
                hits = [
                    (rows[j][1], j) for j in range(len(rows))
                    if conv is not None and turn is not None and rows[j][0] == conv and rows[j][1] is not None and rows[j][1] < turn
                    and any(t == u for d, x in runs_of(rows[j][3])[0] if d == 0 for _, u in units_of(x))
                ]
                if hits:
                    scores[(level, max(hits))] = scores.get((level, max(hits)), 0) + len(t)
            if scores:
                level, source = max(scores, key=lambda k: (-k[0], scores[k], k[1]))
                links.append((-depth, scores[(level, source)], source))
        reply[i] = max(links)[2] if links else None
        clean = re.sub("^[ \t-\r]+|[ \t-\r]+$", "", "\n".join(b for m, b in zip(marks, bodies) if m == 0)) if any(marks) else text
        out[i] = [clean, len(quoted), max([0, *marks]), len(links), reply[i][0] if reply[i] else None]
    first = {}
    for i in out:
        at = i
        while reply[at]:
            at = reply[at][1]
        first[i] = at
    whole = [i for i in out if rows[i][0] is not None and rows[i][1] is not None]
    for i in out:
        key = lambda j: (rows[first[j]][1], first[j], rows[j][1], j)
        placed = i in whole
        out[i] += [rows[first[i]][1] if placed else None, 1 + sum(rows[j][0] == rows[i][0] and key(j) < key(i) for j in whole) if placed else None]
    return out


def conversations(seed):
    rng = random.Random(seed)
    said = ["Yes.", "The train is late", "Why  not?\nI see", "Eins\n\nZwei drei", "Über Ärger\tund so", "ok", "A\n\n\nB\nC"]
    rows = []
    for conv in range(8):
        texts = []
        for turn in range(rng.randint(1, 12)):
            parts = [rng.choice(said) + rng.choice(["", f"\nnumber {rng.randint(0, 3)}"])]
            for _ in range(rng.choice([0, 0, 1, 2])):
                if texts:
                    old = rng.choice(texts)
                    lines = old.split("\n")
                    if rng.random() < 0.4:
                        lines = lines[rng.randrange(len(lines)) :]
                    if rng.random() < 0.3:
                        lines = [" ".join(lines).upper()]
                    mark = rng.choice([">", "> ", " > ", ">> "])
                    intro = [rng.choice(["On Monday Al wrote:", "Am 1.1. schrieb B:", "nobody said:"])] if rng.random() < 0.5 else []
                    parts.insert(rng.randint(0, 1), "\n".join([*intro, *(mark + x for x in lines)]))
            texts.append(rng.choice(["\n", "\r\n", "\r"]).join(parts))
            rows.append((conv, turn * 5000, rng.choice(["user", "assistant"]), texts[-1]))
    return rows


ODD = [(50, 0, "user", None), (50, 1, "user", ""), (50, 2, None, ">"), (50, 3, "user", "> \n>> \n"), (None, 1, "user", "hello there"), (None, 2, "user", "> hello there"),
       (51, None, "user", "hello there"), (51, 1, "user", "> hello there"), (52, 0, "user", "x " * 40_000), (52, 1, "user", "> " + "x " * 40_000), (53, 0, "user", ">" * 20_000 + "a")]


def test_links_match_plain_python_and_duckdb(spark):
    rows = [*conversations(1), *conversations(2)[:30], *ODD]
    rows = list({r[:2]: r for r in rows}.values())
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], KIND).repartition(3)
    got = quotes.link_quotes(frame).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn, r.role): r for r in got}
    for i, r in enumerate(rows):
        g = by[r[:3]]
        assert [g.text, g.n_quotes, g.max_depth, g.n_linked, g.reply_to, g.thread, g.position] == want[i], r
    assert sum(w[3] > 0 for w in want.values()) > 20 and any(w[5] != rows[i][1] for i, w in want.items() if w[5] is not None)
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    cur = con.execute(ORACLE["op1_quote_links"])
    names = [d[0] for d in cur.description]
    theirs = {(x["conv_id"], x["turn"], x["role"]): x for x in (dict(zip(names, row)) for row in cur.fetchall())}
    for key, g in by.items():
        assert {n: theirs[key][n] for n in names} == {n: g[n] for n in names}, key


def test_repeated_turns_and_empty_table(spark):
    rows = [(1, 0, "user", "first words", "", "")] * 3 + [(1, 1, "user", "> first words\nyes", "", "")]
    frame = spark.createDataFrame(rows, KIND)
    got = sorted((r.position, r.turn, r.reply_to, r.text) for r in quotes.link_quotes(frame).collect())
    assert [g[0] for g in got] == [1, 2, 3, 4] and (1, 0, "yes") in [g[1:] for g in got]
    assert quotes.link_quotes(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a", "", "")], KIND)
    for df in (quotes.passages(frame), quotes.link_quotes(frame)):
        assert "Python" not in df._jdf.queryExecution().toString()
