"""Repair of conversations against a plain search over all edits."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from verify_oracle import compare, connect

from ridgepole.llm import queries, sql, turns

BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")


def brute(rows):
    """Least (cost, audit, lines) of ordered (role, text) rows: every state keeps its best string."""
    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    made, names = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}

    def inserted(best):
        todo = list(best.items())
        while todo:
            state, (cost, audit, lines) = todo.pop()
            new = (cost + 3, audit + "I", (*lines, names[made[state]] + ":"))
            if new[0] < 60 + min(b[0] for b in best.values()) and new < best.get(made[state], (1 << 60,)):
                best[made[state]] = new
                todo.append((made[state], new))
        return best

    best, seen = {0: (0, "", ())}, set()
    for role, text in rows:
        blank, again = bool(BLANK.match(text)), (role, text) in seen
        seen.add((role, text))
        cut = not blank and text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?"
        after = {}
        for state, (cost, audit, lines) in inserted(dict(best)).items():
            ways = [(state, (cost + 4, audit + "D", lines))]
            if not blank and not again:
                if (state, role[:1]) in kept:
                    ways.append((kept[state, role[:1]], (cost + 3 * cut, audit + "K", (*lines, f"{role}:{text}"))))
                ways.append((made[state], (cost + 3 + 3 * cut, audit + "R", (*lines, f"{names[made[state]]}:{text}"))))
            for to, way in ways:
                after[to] = min(after.get(to, way), way)
        best = after
    ended = inserted(dict(best))
    return min(ended[s] for s in (0, 3) if s in ended)


def expected(rows):
    """Report of {conversation: [(turn, role, text)]}."""
    out = {}
    for c, own in rows.items():
        own = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in own]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        cost, audit, lines = brute([r[1:] for r in own])
        faults, seen = defaultdict(int), set()
        for _, role, text in own:
            if BLANK.match(text):
                faults["blank"] += 1
            elif (role, text) in seen:
                faults["duplicate"] += 1
            elif text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
                faults["truncated"] += 1
            seen.add((role, text))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[c] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made_up(seed, sizes):
    draw, rows = random.Random(seed), {}
    for c, n in enumerate(sizes):
        rows[c if c else None] = [
            (
                draw.choice([None, *range(max(1, 2 * n))]),
                draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ultra"]),
                draw.choice(["Yes.", "No!", "cut off", "", " \t\n", "Why? ", None, "é ends.", f"text {draw.randint(0, 9)}.", f"open {draw.randint(0, 99)}"]),
            )
            for _ in range(n)
        ]
    return rows


def frame(spark, rows):
    flat = [(c, t, r, x, "k", 1) for c, own in rows.items() for t, r, x in own]
    return spark.createDataFrame(flat, "conv_id bigint, turn bigint, role string, text string, _c string, cost int")


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_against_every_edit(spark, seed):
    rows = made_up(seed, [random.Random(seed).randint(1, 9) for _ in range(150)])
    assert found(turns.report(frame(spark, rows))) == expected(rows)


def test_a_long_conversation_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(turns, "PIECE", 20)
    rows = made_up(7, [250, 3, 120])
    rows[5] = [(i, "user", f"Say {i}.") for i in range(90)]  # one run over several pieces
    talk = turns.Conversations(frame(spark, rows))
    assert found(turns.report(frame(spark, rows))) == expected(rows)
    edits, _ = talk.edits()
    assert edits.select("_c", "_part").distinct().groupBy("_c").count().where("count > 1").count() >= 2


def test_runs_and_powers():
    for initial, kind in [("u", 0), ("a", 1), ("s", 0), ("o", 2), ("", 0)]:
        total, slow = turns._Total(), turns._SAME
        total.run(initial, kind, 37)
        for _ in range(37):
            slow = turns.bounded(turns.times(slow, turns.symbol(initial, kind)))
        assert total.matrix() == slow
    assert list(turns.runs([("u", 0, 1), ("u", 0, 3), ("a", 2, 2), ("u", 2, 1), ("u", 1, 1)])) == [("u", 0, 2), ("", 2, 5), ("u", 1, 1)]


def test_copies_stay_one_row(spark):
    rows = {1: [(0, "user", "Hi.")] * 5000 + [(1, "assistant", "Yes.")] * 3}
    talk = turns.Conversations(frame(spark, rows))
    assert talk.told.count() == 2
    got = found(turns.report(frame(spark, rows)))[1]
    assert got[:6] == (0, 0, 5001, 0, 5001, 4 * 5001) and got[6] == "K" + "D" * 4999 + "K" + "DD"


def test_empty_and_very_long_texts(spark):
    nothing = frame(spark, {1: []})
    assert turns.report(nothing).count() == 0
    rows = {1: [(0, "user", "word " * 200_000 + "end."), (1, "assistant", "x" * 1_000_000), (None, None, None)]}
    assert found(turns.report(frame(spark, rows))) == expected(rows)


def test_query_against_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), queries.QUERIES["op11_turn_repair"], sql.ORACLE["op11_turn_repair"], sf_dir) == ""
