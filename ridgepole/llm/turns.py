"""Repair of conversations whose roles or messages are damaged, at the least cost of edits.

A conversation's rows, in turn order, carry a role and a fault: blank, else duplicate (role
and text seen earlier in the conversation), else truncated, else none.  The repaired roles
must read: nothing, or an optional system message and then user and assistant in turn.
Keep costs 0, Rerole and Insert 3, Delete 4; blank and duplicate rows must go, a truncated
row that stays costs 3 more.  Of equally cheap repairs the one whose edits' initials come
first in ASCII order is taken.

**Method: run-length DP.**  A row's symbol is its role's initial and whether it is truncated
or must go.  A symbol is a min-plus matrix over the four states of the pattern (nothing yet,
after system, after user, after assistant), inserts before the row included.  Rows of equal
symbols that follow each other are one run, and a run of n rows advances by the binary
powers of its matrix, which are kept.  The choices are then unrolled row by row: from the
cost of what follows, the first letter that stays on a cheapest way is taken.

**No conversation is held whole.**  Equal rows (conversation, turn, role, text) are counted
first and stay one row with a count.  Rows, without their texts, are dealt by ranges of
(conversation, turn), so that a long conversation is cut into pieces of bounded size
(``PIECE`` rows on average) in as many tasks; a piece is one matrix, a conversation's pieces
are put together from their matrices, and pieces after a first one are unrolled from the
state in which the one before ends.  Only edits that keep a row meet its text again, in a
join.  ``digests`` streams a conversation's edits in order through one task, as SHA-256
demands; it keeps the audit, not the texts.

Defined results: null roles and texts count as one space; null conversations are one of
their own; null turns come first; rows of equal turn are ordered by role, then by their
text's MD5 (also the name of a text in "seen earlier").  An empty table gives no edits.
Texts of any length; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.llm.common import stored

#: Rows of a piece of a conversation, on average.
PIECE = 1 << 18

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
DELETE_COST, CHANGE_COST, TRUNCATED_COST = 4, 3, 3
FINE, TRUNCATED, GOES = 0, 1, 2

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
START = 0
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Where an inserted or a reroled message leads, and its role.
MADE = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: Cost of the inserts that finish the pattern from each state.
END = (0, 6, 3, 0)
LEGAL = {"su", "ua", "au"}
INF = 1 << 60

Matrix = tuple[int, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product of two matrices of four rows."""
    return tuple(min(a[4 * i + k] + b[4 * k + j] for k in range(4)) for i in range(4) for j in range(4))


def bounded(a: Matrix) -> Matrix:
    return tuple(min(x, INF) for x in a)


def before(a: Matrix, vector: Sequence[int]) -> tuple[int, ...]:
    """Costs before a run, from the costs after it."""
    return tuple(min(INF, *(a[4 * i + k] + vector[k] for k in range(4))) for i in range(4))


_SAME: Matrix = tuple(0 if i == j else INF for i in range(4) for j in range(4))


def _inserts() -> Matrix:
    one = [INF] * 16
    for state in range(4):
        one[5 * state] = 0
        one[4 * state + MADE[state]] = min(CHANGE_COST, one[4 * state + MADE[state]])
    twice = bounded(times(tuple(one), tuple(one)))
    return bounded(times(twice, twice))


_INSERTS = _inserts()


@lru_cache(maxsize=None)
def symbol(initial: str, kind: int) -> Matrix:
    """What a row may become, with inserts before it.  ``initial``: s, u, a or another."""
    row = [INF] * 16
    for state in range(4):
        row[5 * state] = DELETE_COST
        if kind == GOES:
            continue
        more = TRUNCATED_COST if kind == TRUNCATED else 0
        ways = [(MADE[state], CHANGE_COST + more)]
        if (state, initial) in KEPT:
            ways.append((KEPT[state, initial], more))
        for to, cost in ways:
            row[4 * state + to] = min(row[4 * state + to], cost)
    return bounded(times(_INSERTS, tuple(row)))


@lru_cache(maxsize=4096)
def power(initial: str, kind: int, bits: int) -> Matrix:
    """The symbol's matrix to the power 2**bits."""
    if bits == 0:
        return symbol(initial, kind)
    half = power(initial, kind, bits - 1)
    return bounded(times(half, half))


class _Total:
    """A product of matrices, scaled so that its least entry is 0: few distinct ones occur, products are kept."""

    def __init__(self) -> None:
        self.shape, self.least = _SAME, 0

    def run(self, initial: str, kind: int, count: int) -> None:
        for bits in range(count.bit_length()):
            if count >> bits & 1:
                self.shape, more = _product(self.shape, power(initial, kind, bits))
                self.least += more

    def matrix(self) -> Matrix:
        return tuple(INF if x >= INF else x + self.least for x in self.shape)


@lru_cache(maxsize=1 << 16)
def _product(a: Matrix, b: Matrix) -> tuple[Matrix, int]:
    made = times(a, b)
    least = min(made)
    return tuple(INF if x >= INF else x - least for x in made), least


def runs(rows: Sequence[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Rows (initial, kind, copies) as runs of equal symbols; all copies but the first must go."""

    def symbols():
        for initial, kind, copies in rows:
            if kind != GOES:
                yield (initial, kind), 1
                copies -= 1
            if copies:
                yield ("", GOES), copies  # which role it had does not matter

    for (initial, kind), same in groupby(symbols(), key=lambda x: x[0]):
        yield initial, kind, sum(n for _, n in same)


def unroll(rows: Sequence[tuple[str, int, int]], after: Sequence[int], state: int) -> Iterator[tuple[int, str, int, int]]:
    """(row, edit, times, state after) of the rows of a piece, entered in ``state``; an insert comes before its row.

    ``after``: cost of what follows the piece, from each state.
    """
    costs = [tuple(after)]
    for initial, kind, copies in reversed(rows):
        # copies that must go cost the same from every state and leave the state as it is
        extra = copies if kind == GOES else copies - 1
        below = tuple(min(INF, x + DELETE_COST * extra) for x in costs[-1])
        costs.append(below if kind == GOES else before(symbol(initial, kind), below))
    costs.reverse()
    for i, (initial, kind, copies) in enumerate(rows):
        now, extra = costs[i], copies if kind == GOES else copies - 1
        if kind != GOES:
            later = tuple(min(INF, x + DELETE_COST * extra) for x in costs[i + 1])
            more = TRUNCATED_COST if kind == TRUNCATED else 0
            while True:
                kept = KEPT.get((state, initial))
                if now[state] == DELETE_COST + later[state]:
                    yield i, DELETE, 1, state
                elif now[state] == CHANGE_COST + now[MADE[state]]:
                    state = MADE[state]
                    yield i, INSERT, 1, state
                    continue
                elif kept is not None and now[state] == more + later[kept]:
                    state = kept
                    yield i, KEEP, 1, state
                else:
                    state = MADE[state]
                    yield i, REROLE, 1, state
                break
        if extra:
            yield i, DELETE, extra, state


def finish(state: int) -> Iterator[int]:
    """States after the inserts that finish the pattern."""
    while END[state]:
        state = MADE[state]
        yield state


def tag(value: Column) -> Column:
    """A value as text that tells null from everything else."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def _light(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``_c, _turn, _role, _key`` and what a text says of its fault."""
    said = F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    end = F.rtrim(said, F.lit(" \t\n\x0b\f\r"))
    return rows.select(
        tag(F.col(f"`{conversation}`")).alias("_c"),
        F.col(f"`{turn}`").cast("bigint").alias("_turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("_role"),
        F.md5(said.cast("binary")).alias("_key"),
        (end == "").alias("_blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("_open"),
        said.alias("_text"),
    )


def _sorted_by() -> list:
    return ["_c", F.asc_nulls_first("_turn"), "_role", "_key"]


class Conversations:
    """One table of messages, its faults, and its edits."""

    def __init__(self, rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        self.conversation, self.kind = conversation, rows.schema[conversation].dataType
        self._rows = _light(rows, conversation, turn, role, text)
        names = ["_c", "_turn", "_role", "_key", "_blank", "_open"]
        counted = self._rows.groupBy(*names).agg(F.count("*").alias("_n"))
        seen = counted.groupBy("_c", "_role", "_key").agg(F.min(F.struct(F.col("_turn").isNotNull().alias("_t"), "_turn")).alias("_first"))
        seen = seen.select(F.col("_c").alias("_c2"), F.col("_role").alias("_role2"), F.col("_key").alias("_key2"), F.col("_first._turn").alias("_since"))
        same = (F.col("_c") == F.col("_c2")) & (F.col("_role") == F.col("_role2")) & (F.col("_key") == F.col("_key2"))
        first = F.col("_turn").eqNullSafe(F.col("_since"))
        kind = F.when(F.col("_blank") | ~first, GOES).when(F.col("_open"), TRUNCATED).otherwise(FINE)
        told = counted.join(seen, same).select("_c", "_turn", "_role", "_key", "_blank", "_n", first.alias("_is_first"), kind.alias("_kind"))
        #: Every distinct row once, with its copies and what must become of it.
        self.told = stored(told, "turns-told")

    def named(self, df: DataFrame) -> DataFrame:
        """The conversation's own value in the place of its tag."""
        own = F.when(F.col("_c") != "-", F.substr("_c", F.lit(2))).cast(self.kind).alias(self.conversation)
        return df.select(own, *[c for c in df.columns if c != "_c"])

    def faults(self) -> DataFrame:
        """Gaps in turns and faults of each conversation."""
        found = self.told
        copies, fine = F.col("_n"), ~F.col("_blank")
        one = F.col("_is_first").cast("bigint")
        return found.groupBy("_c").agg(
            F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.countDistinct("_turn"), F.lit(0)).alias("gaps"),
            F.sum(F.when(~fine, copies).otherwise(0)).alias("blank"),
            F.sum(F.when(fine, copies - one).otherwise(0)).alias("duplicate"),
            F.sum((F.col("_kind") == TRUNCATED).cast("bigint")).alias("truncated"),
        )

    def _pieces(self) -> tuple[DataFrame, int]:
        """Rows dealt by ranges: ``_part`` names the task, a conversation's rows in it are one piece."""
        spark = self.told.sparkSession
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-self.told.count() // PIECE))
        dealt = self.told.repartitionByRange(parts, *_sorted_by()).withColumn("_part", F.spark_partition_id())
        return stored(dealt, "turns-pieces"), parts

    def edits(self) -> tuple[DataFrame, DataFrame]:
        """The edits in order, and each conversation's cost and illegal neighbours.

        Edits: ``_c, _part, _seq`` (order), ``edit``, ``times``, ``role`` (after it, null if
        deleted), ``text`` (null if deleted, empty if inserted).
        """
        pieces, parts = self._pieces()

        def in_order(df: DataFrame) -> DataFrame:
            return df.repartition(parts, "_part").sortWithinPartitions("_part", "_c", F.col("_exit").isNull(), *_sorted_by()[1:])

        nothing = {"_exit": "array<bigint>", "_enter": "int", "_ends": "boolean"}
        rows = pieces.select("_part", "_c", "_turn", "_role", "_key", "_n", "_kind", *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()])

        def with_marks(marks: DataFrame) -> DataFrame:
            given = {c: F.col(c) for c in marks.columns}
            return in_order(rows.union(marks.select(*[given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in rows.schema])))

        summed = stored(in_order(rows).mapInArrow(_summaries, SUMMARY), "turns-summaries")
        by_piece = lambda df: df.repartition("_c").sortWithinPartitions("_c", "_part")
        scanned = stored(by_piece(summed).mapInArrow(_scan, SCANNED), "turns-scanned")
        # conversations of several pieces: where each piece leads from each state, then from the first on
        several = scanned.where("_pieces > 1")
        if several.isEmpty():
            entered = scanned
        else:
            wanted = several.select("_part", "_c", "_exit", "_ends")
            leads = with_marks(wanted).mapInArrow(_leads, LEADS)
            with_leads = by_piece(several.join(leads, ["_c", "_part"]))
            names = [f.name for f in scanned.schema]
            entered = scanned.where("_pieces = 1").union(with_leads.select(*names, "_leads").mapInArrow(_enter, SCANNED).select(*names))
        marks = entered.select("_part", "_c", "_exit", "_enter", "_ends")
        made = stored(with_marks(marks).mapInArrow(_edits, EDITS), "turns-edits")
        texts = self._rows.groupBy("_c", tag(F.col("_turn")).alias("_t"), "_role", "_key").agg(F.max("_text").alias("text"))
        stays = made.where("_key is not null").withColumn("_t", tag(F.col("_turn"))).join(texts, ["_c", "_t", "_role", "_key"])
        out = ["_c", "_part", "_seq", "edit", "times", "role", "text"]
        other = made.where("_key is null").withColumn("text", F.when(F.col("edit") == INSERT, ""))
        return stays.select(*out).union(other.select(*out)), scanned.where("_cost is not null").select("_c", F.col("_cost").alias("cost"), F.col("_illegal").alias("illegal"))


SUMMARY = "_c string, _part int, _matrix array<bigint>, _illegal bigint, _first string, _last string"
SCANNED = "_c string, _part int, _pieces int, _exit array<bigint>, _enter int, _ends boolean, _cost bigint, _illegal bigint"
LEADS = "_c string, _part int, _leads array<int>"
EDITS = "_c string, _part int, _seq bigint, edit string, times bigint, role string, _turn bigint, _role string, _key string"


def _groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of sorted batches by equal keys."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=lambda row: tuple(row[k] for k in keys))


def _batches(rows: Iterator[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a schema."""
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [(n, kinds[t]) for n, t in (part.split() for part in ddl.split(", "))]
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields)], names=[n for n, _ in fields])
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields)], names=[n for n, _ in fields])


def _initial(role: str) -> str:
    return role[:1]


def _row(row: dict) -> tuple[str, int, int]:
    return _initial(row["_role"]), row["_kind"], row["_n"]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece as one matrix; its rows are read once and not kept."""

    def made():
        for (part, c), rows in _groups(batches, ["_part", "_c"]):
            total, edge = _Total(), [None, None, 0]

            def read():
                for row in rows:
                    initial = _initial(row["_role"])
                    if edge[0] is None:
                        edge[0] = initial
                    else:
                        edge[2] += edge[1] + initial not in LEGAL
                    edge[1] = initial
                    edge[2] += row["_n"] - 1  # a copy is a neighbour of its own role
                    yield _row(row)

            for run in runs(read()):
                total.run(*run)
            yield c, part, list(total.matrix()), edge[2], edge[0], edge[1]

    return _batches(made(), SUMMARY)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's pieces (at most one a task) put together, the last first."""

    def made():
        for (c,), rows in _groups(batches, ["_c"]):
            pieces = list(rows)
            illegal = sum(p["_illegal"] for p in pieces) + sum(a["_last"] + b["_first"] not in LEGAL for a, b in zip(pieces, pieces[1:]))
            after: tuple[int, ...] = END
            out = []
            for i in reversed(range(len(pieces))):
                now = before(pieces[i]["_matrix"], after)
                mine = (now[START], illegal) if i == 0 else (None, None)
                out.append((c, pieces[i]["_part"], len(pieces), list(after), START if i == 0 else None, i + 1 == len(pieces), *mine))
                after = now
            yield from reversed(out)

    return _batches(made(), SCANNED)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, dict, list[dict]]]:
    """Pieces that a mark stands before: its values and its rows."""
    for (part, c), rows in _groups(batches, ["_part", "_c"]):
        mark = next(rows)
        if mark["_exit"] is not None:
            yield c, part, mark, list(rows)


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each piece ends in, from each state it may be entered in."""

    def made():
        for c, part, mark, rows in _marked(batches):
            symbols, to = [_row(r) for r in rows], []
            for state in range(4):
                end = state
                for _, _, _, end in unroll(symbols, mark["_exit"], state):
                    pass
                to.append(end)
            yield c, part, to

    return _batches(made(), LEADS)


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        for _, rows in _groups(batches, ["_c"]):
            state = START
            for r in rows:
                yield r["_c"], r["_part"], r["_pieces"], r["_exit"], state, r["_ends"], r["_cost"], r["_illegal"]
                state = r["_leads"][state]

    return _batches(made(), SCANNED)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        for c, part, mark, rows in _marked(batches):
            seq, state = 0, mark["_enter"]
            for i, edit, count, state in unroll([_row(r) for r in rows], mark["_exit"], state):
                if edit in (KEEP, REROLE):
                    row = rows[i]
                    yield c, part, seq, edit, count, row["_role"] if edit == KEEP else ROLE[state], row["_turn"], row["_role"], row["_key"]
                else:
                    yield c, part, seq, edit, count, ROLE[state] if edit == INSERT else None, None, None, None
                seq += 1
            if mark["_ends"]:
                for state in finish(state):
                    yield c, part, seq, INSERT, 1, ROLE[state], None, None, None
                    seq += 1

    return _batches(made(), EDITS)


def repaired(edits: DataFrame) -> DataFrame:
    """The rows that remain, in order: ``_c, _part, _seq, role, text``."""
    return edits.where(F.col("edit") != DELETE).select("_c", "_part", "_seq", "role", "text")


def digests(edits: DataFrame) -> DataFrame:
    """``_c, audit, repaired_sha256``: the edits' initials, and a hash of ``role:text`` by line."""
    rows = edits.repartition("_c").sortWithinPartitions("_c", "_part", "_seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for (c,), own in _groups(batches, ["_c"]):
                audit, digest, any_yet = [], hashlib.sha256(), False
                for row in own:
                    audit.append(row["edit"] * row["times"])
                    if row["edit"] != DELETE:
                        digest.update(f"{chr(10) if any_yet else ''}{row['role']}:{row['text']}".encode())
                        any_yet = True
                yield c, "".join(audit), digest.hexdigest()

        return _batches(made(), "_c string, audit string, repaired_sha256 string")

    return rows.mapInArrow(run, "_c string, audit string, repaired_sha256 string")


def report(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults, cost, audit and the repaired conversation's hash, one row for each conversation."""
    talk = Conversations(rows, conversation, turn, role, text)
    edits, costs = talk.edits()
    found = talk.faults().join(costs, "_c").join(digests(edits), "_c")
    return talk.named(found.select("_c", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
