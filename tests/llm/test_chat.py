"""Snapshot collapse against brute force."""

from __future__ import annotations

import random

from tidewater.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string"


def brute(rows):
    turns = {}
    for c, n, role, text, _ in rows:
        if c is not None:
            turns.setdefault(c, set()).add((-(2**70) if n is None else n, role or "", text or ""))
    said = {c: [(r, t) for _, r, t in sorted(v)] for c, v in turns.items()}
    kept = {}
    for c in sorted(said):
        if not any(len(o) > len(said[c]) and o[: len(said[c])] == said[c] for o in said.values()):
            kept.setdefault(tuple(said[c]), []).append(c)
    return sorted((min(cs), len(content), len(cs), "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in content)) for content, cs in kept.items())


def found(frame):
    whole = {}
    for r in sorted(frame.collect(), key=lambda r: (r["conv_id"], -(2**70) if r["part"] is None else r["part"])):
        whole.setdefault((r["conv_id"], r["n_turns"], r["n_copies"]), []).append(r["chat"])
    return sorted((*k, "".join(v)) for k, v in whole.items())


def test_snapshots_collapse(spark):
    draw = random.Random(6)
    rows, conv = [], 0
    for _ in range(40):
        full = [(draw.choice(["user", "assistant", None]), draw.choice(["hi", "yes", "no", "é", "", None])) for _ in range(draw.randint(1, 9))]
        for _ in range(draw.randint(1, 4)):
            conv += 1
            rows += [(conv, 2 * n, r, t, "x") for n, (r, t) in enumerate(full[: draw.randint(1, len(full))])]
    rows += rows[:20] + [(None, 0, "user", "lost", "x"), (900, None, "system", "first", "x"), (900, -4, "user", "second", "x"), (900, 3, "user", "third", "x")]
    draw.shuffle(rows)
    assert found(chat.format_chats(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_long_conversations_run_over_blocks(spark):
    long = [("user" if n % 2 else "assistant", f"turn {n}") for n in range(2600)]
    rows = [(1, n, r, t, "") for n, (r, t) in enumerate(long)]
    rows += [(2, n, r, t, "") for n, (r, t) in enumerate(long[:2000])]
    rows += [(3, n, r, t, "") for n, (r, t) in enumerate([*long[:1999], ("user", "other")])]
    rows += [(4, n, r, t, "") for n, (r, t) in enumerate(long)]
    got = found(chat.format_chats(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and [g[0] for g in got] == [1, 3]


def test_empty_table_and_a_plan_without_python(spark):
    empty = chat.format_chats(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    plan = empty._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
