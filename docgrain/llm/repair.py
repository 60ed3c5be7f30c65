r"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is right if the initials of its roles are nothing, or ``s?(ua)+``: four states (nothing yet, after the system,
after a user, after an assistant). Rows are kept, reroled or deleted, turns are inserted, each at a cost; wanted is the
cheapest list of edits and of those the one whose initials come first as a string.

Edits are cut behind each row, so insertions stand before the row that follows. Then of two lists up to one row none begins
the other, and lists that end in different states differ: the order of four states' least lists up to a row, carried along
with their costs, decides every tie later on. Forward and backward vectors of four states meet in the middle of a stretch,
the cheapest crossing, in ties that of the least list so far, is fixed, and both halves are solved likewise: linear space.

A stretch of rows acts on such vectors as a 4 x 4 matrix of costs with an order in each line, and stretches combine. So rows
sorted by conversation and turn are cut into chunks of one Arrow batch at most; each gives its matrix; those of a
conversation meet (32 numbers for up to a batch of rows, less than the edits returned for them) and get their crossings;
then each chunk is solved by itself. The digest of a conversation is that of all its text in order, which one task must
read, as a stream: a chunk at a time is in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgrain.llm.common import materialize, read_table

INSERT, REROLE, DELETE, CUT_OFF = 2, 2, 3, 1
NEVER = 1 << 60
#: States: 0 nothing yet, 1 after the system, 2 after a user, 3 after an assistant. What a role leads to, and what is inserted.
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
#: Insertions that end a conversation in each state.
END = ("", "II", "I", "")
LETTERS, FAULTS = "sua?", ("", "lost", "cut")

Vector = tuple[tuple[int, ...], tuple[int, ...]]  # costs and order of four states
Matrix = tuple[Vector, ...]  # a vector for each state to start from


def _inserted(state: int) -> int:
    return AFTER[state, NEXT_ROLE[state][0]]


def _edits(letter: str, fault: str) -> list[list[tuple[int, str] | None]]:
    """The cheapest, then least, edits of one row from each state to each."""
    out: list[list] = [[None] * 4 for _ in range(4)]
    more = CUT_OFF if fault == "cut" else 0
    for start in range(4):
        at = start
        for k in range(3):
            found = [(at, DELETE, "D")]
            if fault != "lost":
                found.append((_inserted(at), REROLE + more, "R"))
                if (at, letter) in AFTER:
                    found.append((AFTER[at, letter], more, "K"))
            for end, cost, name in found:
                new = (k * INSERT + cost, "I" * k + name)
                out[start][end] = min(out[start][end] or new, new)
            at = _inserted(at)
    return out


def _matrix(edits: list[list[tuple[int, str] | None]]) -> Matrix:
    lines = []
    for line in edits:
        order = sorted(x[1] for x in line if x)
        lines.append((tuple(x[0] if x else NEVER for x in line), tuple(order.index(x[1]) if x else -1 for x in line)))
    return tuple(lines)


EDITS = [_edits(letter, fault) for letter in LETTERS for fault in FAULTS]
ROWS = [_matrix(e) for e in EDITS]


def kind_of(initial: str, fault: str) -> int:
    return LETTERS.index(initial if initial in ("s", "u", "a") else "?") * len(FAULTS) + FAULTS.index(fault)


def start(state: int) -> Vector:
    return tuple(0 if t == state else NEVER for t in range(4)), tuple(0 if t == state else -1 for t in range(4))


def advance(vector: Vector, matrix: Matrix) -> tuple[int, Vector]:
    """The vector behind a row or stretch, as its least cost and what is above it."""
    costs, ranks = vector
    best = []
    for t in range(4):
        ways = [(costs[q] + matrix[q][0][t], ranks[q], matrix[q][1][t]) for q in range(4) if costs[q] < NEVER and matrix[q][0][t] < NEVER]
        best.append(min(ways) if ways else None)
    base = min(b[0] for b in best if b)
    order = sorted(b[1:] for b in best if b)
    return base, (tuple(b[0] - base if b else NEVER for b in best), tuple(order.index(b[1:]) if b else -1 for b in best))


@lru_cache(maxsize=1 << 14)
def _row_advance(vector: Vector, kind: int) -> tuple[int, Vector]:
    return advance(vector, ROWS[kind])


@lru_cache(maxsize=1 << 14)
def _row_back(costs: tuple[int, ...], kind: int) -> tuple[int, ...]:
    return _back(costs, ROWS[kind])


def _back(costs: tuple[int, ...], matrix: Matrix) -> tuple[int, ...]:
    ways = [min(matrix[q][0][t] + costs[t] for t in range(4)) for q in range(4)]
    base = min(ways)
    return tuple(w - base if w < NEVER else NEVER for w in ways)


def crossings(items: list, begin: int, end: int) -> list[int]:
    """States behind each of ``items`` (kinds of rows, or matrices) on the least of the cheapest ways from state to state."""
    if len(items) == 1:
        return [end]
    half = len(items) // 2
    ahead = start(begin)
    for x in items[:half]:
        ahead = (_row_advance(ahead, x) if isinstance(x, int) else advance(ahead, x))[1]
    behind = start(end)[0]
    for x in reversed(items[half:]):
        behind = _row_back(behind, x) if isinstance(x, int) else _back(behind, x)
    _, _, q = min((ahead[0][q] + behind[q], ahead[1][q], q) for q in range(4) if ahead[0][q] < NEVER)
    return crossings(items[:half], begin, q) + crossings(items[half:], q, end)


def stretch_matrix(kinds: list[int], extra: int = 0) -> Matrix:
    """What a stretch of rows does, and ``extra`` costs that every way has."""
    lines = []
    for state in range(4):
        total, vector = extra, start(state)
        for kind in kinds:
            more, vector = _row_advance(vector, kind)
            total += more
        lines.append((tuple(c + total if c < NEVER else NEVER for c in vector[0]), vector[1]))
    return tuple(lines)


def best_end(items: list[Matrix]) -> tuple[int, int]:
    """The cost of the cheapest way through all stretches and to a right end, and the state that it has before the end."""
    total, vector = 0, start(0)
    for x in items:
        more, vector = advance(vector, x)
        total += more
    cost, _, state = min((c + INSERT * len(END[q]), vector[1][q], q) for q, c in enumerate(vector[0]) if c < NEVER)
    return total + cost, state


# --- tables ---------------------------------------------------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by the CRC-32 of ``conv_id:turn``, nulls as one space.

    Of 20 remainders 0 drops the row (no copies), 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(k == 1, "").when(k == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return conversations.select("conv_id", "turn", F.when(k == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("copies"))


def _events(rows: DataFrame) -> DataFrame:
    """The different rows of conversations with their number, initial, and fault of the first copy."""
    gone = F.col("copies") == 0
    none = F.lit(None)
    slim = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.when(~gone, F.col("turn").cast("long")).alias("turn"), F.when(~gone, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(~gone, F.coalesce("text", F.lit(" "))).alias("text"), F.col("copies").cast("long").alias("copies"),
    )
    counted = slim.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    name = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    events = materialize(counted.withColumn("name", name), "repair-events")
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = events.where("copies > 0").groupBy(F.col("conv_id").alias("_c"), F.col("name").alias("_n")).agg(F.min(at).alias("_first"))
    joined = events.join(firsts, events["conv_id"].eqNullSafe(F.col("_c")) & (events["name"] == F.col("_n")), "left")
    fault = (
        F.when(F.col("copies") == 0, none.cast("string")).when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(at > F.col("_first"), "duplicate")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("")
    )
    return joined.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def _kinds(batch: pa.RecordBatch) -> list[int]:
    """The kind of each row of a batch with role and fault, -1 for one that only names its conversation."""
    names = {"": "", "truncated": "cut", "blank": "lost", "duplicate": "lost"}
    return [-1 if f is None else kind_of(r[:1], names[f]) for r, f in zip(batch.column("role").to_pylist(), batch.column("fault").to_pylist())]


def _chunks(rows: DataFrame) -> DataFrame:
    """``rows`` in order of conversation and turn, with part, chunk, pos, and the matrix of each chunk in its last row."""
    keys = ["conv_id", "turn", "role"]
    dealt = rows.repartitionByRange(*keys, F.substring("text", 1, 64)).sortWithinPartitions(*keys, "text").withColumn("part", F.spark_partition_id())

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            ids, kinds, copies = batch.column("conv_id").to_pylist(), _kinds(batch), batch.column("copies").to_pylist()
            chunk, pos, costs, ranks = [], [], [None] * len(ids), [None] * len(ids)
            first = 0
            while first < len(ids):
                last = first + 1
                while last < len(ids) and ids[last] == ids[first]:
                    last += 1
                extra = DELETE * sum(max(0, n - 1) for n in copies[first:last])
                matrix = stretch_matrix([k for k in kinds[first:last] if k >= 0], extra)
                costs[last - 1], ranks[last - 1] = [c for line in matrix for c in line[0]], [r for line in matrix for r in line[1]]
                chunk += [number] * (last - first)
                pos += range(last - first)
                number, first = number + 1, last
            more = [pa.array(chunk, pa.int64()), pa.array(pos, pa.int32()), pa.array(costs, pa.list_(pa.int64())), pa.array(ranks, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "chunk", "pos", "costs", "ranks"])

    schema = "conv_id long, turn long, role string, text string, copies long, fault string, part int, chunk long, pos int, costs array<long>, ranks array<int>"
    return materialize(dealt.mapInArrow(of, schema), "repair-chunks")


def _states(chunks: DataFrame) -> DataFrame:
    """conv_id, part, chunk, begin, end, cost: the states that the least of the cheapest ways has around each chunk."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solved() -> pa.RecordBatch:
            items = [tuple((tuple(c[4 * q : 4 * q + 4]), tuple(r[4 * q : 4 * q + 4])) for q in range(4)) for *_, c, r in held]
            cost, end = best_end(items)
            ends = crossings(items, 0, end)
            columns = [pa.array([x[k] for x in held], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64()))]
            columns += [pa.array([0, *ends[:-1]], pa.int32()), pa.array(ends, pa.int32()), pa.array([cost] * len(held), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "chunk", "begin", "end", "cost"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield solved()
                    held = []
                held.append(row)
        if held:
            yield solved()

    summed = chunks.where("costs IS NOT NULL").select("conv_id", "part", "chunk", "costs", "ranks")
    return summed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk").mapInArrow(of, "conv_id long, part int, chunk long, begin int, end int, cost long")


class _Repaired:
    """What is known of one conversation while its chunks pass by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.cost = conv_id, 0, 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before, self.turns, self.least, self.turn = 0, None, 0, None, None
        self.audit: list[str] = []
        self.digest, self.some = hashlib.sha256(), False

    def line(self, role: str, text: str) -> None:
        if self.some:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode("utf-8", "replace"))
        self.some = True

    def apply(self, edits: str, role: str = "", text: str = "") -> None:
        for edit in edits:
            if edit == "D":
                continue
            new = role if edit == "K" else NEXT_ROLE[self.state]
            self.line(new, "" if edit == "I" else text)
            self.state = AFTER[self.state, new[:1]]
        self.audit.append(edits)

    def chunk(self, rows: list[tuple], end: int) -> None:
        """Rows (turn, role, text, copies, fault, kind) of one chunk, which ends in state ``end``."""
        if rows:
            states = [self.state, *crossings([r[-1] for r in rows], self.state, end)]
            for (turn, role, text, copies, fault, kind), a, b in zip(rows, states, states[1:]):
                self.apply(EDITS[kind][a][b][1], role, text)
                self.audit.append("D" * (copies - 1))
                if fault:
                    self.counts[fault] += 1
                self.counts["blank" if fault == "blank" else "duplicate"] += copies - 1
                self.illegal += copies - 1 + (self.before is not None and self.before + role[:1] not in ("su", "ua", "au"))
                self.before = role[:1]
                if turn is not None and (self.turn is None or turn > self.turn):
                    self.least, self.turn, self.turns = turn if self.least is None else self.least, turn, self.turns + 1

    def row(self) -> tuple:
        self.apply(END[self.state])
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


OUT = [("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())]


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation of ``rows``.

    ``rows`` has conv_id, turn, role, text and copies, the number of equal rows that it stands for; none only names the
    conversation, which is then empty: zeros, no edits, the digest of nothing. Null roles and texts are one space; a null id
    is a conversation; rows go by turn, nulls first, ties by role and text; repeated rows are duplicates; an empty table
    gives an empty result; other columns are ignored.
    """
    chunks = _chunks(_events(rows))
    states = _states(chunks)
    none = F.lit(None)
    told = ["turn", "role", "text", "copies", "fault"]
    lead = states.select("conv_id", "part", "chunk", F.lit(-1).alias("pos"), *[none.cast(chunks.schema[c].dataType).alias(c) for c in told], "begin", "end", "cost")
    body = chunks.select("conv_id", "part", "chunk", "pos", *told, *[none.cast(t).alias(c) for c, t in (("begin", "int"), ("end", "int"), ("cost", "long"))])
    stream = lead.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk", "pos")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, rows, end = [], None, [], 0
        for batch in batches:
            names = batch.schema.names
            kinds = _kinds(batch)
            for x, kind in zip(zip(*(batch.column(names.index(c)).to_pylist() for c in ("conv_id", "pos", *told, "end", "cost"))), kinds):
                conv_id, pos, *row, goes_to, cost = x
                if pos < 0:
                    if now is not None:
                        now.chunk(rows, end)
                        if now.conv_id != conv_id:
                            done.append(now.row())
                            now = None
                    if now is None:
                        now = _Repaired(conv_id)
                    rows, end, now.cost = [], goes_to, cost
                elif kind >= 0:
                    rows.append((*row, kind))
            if len(done) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*done), OUT)], [n for n, _ in OUT])
                done = []
        if now is not None:
            now.chunk(rows, end)
            done.append(now.row())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*done), OUT)], [n for n, _ in OUT])

    return stream.mapInArrow(of, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(read_table(spark, sf_dir, "conversations")))


OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS t FROM range(256) r(i)),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
  FROM conversations, crc),
rows AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM rows),
numbered AS (
  SELECT *, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
inserted(st, added, mid, lines) AS (VALUES
  (0, '', 0, []), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']), (1, '', 1, []), (1, 'I', 2, ['user:']), (1, 'II', 3, ['user:', 'assistant:']),
  (2, '', 2, []), (2, 'I', 3, ['assistant:']), (2, 'II', 2, ['assistant:', 'user:']), (3, '', 3, []), (3, 'I', 2, ['user:']), (3, 'II', 3, ['user:', 'assistant:'])),
edits AS (
  SELECT st, added, mid, lines, edit, initial, new FROM inserted, (VALUES
    ('D', 0, NULL, 0), ('D', 1, NULL, 1), ('D', 2, NULL, 2), ('D', 3, NULL, 3), ('R', 0, NULL, 2), ('R', 1, NULL, 2), ('R', 2, NULL, 3), ('R', 3, NULL, 2),
    ('K', 0, 's', 1), ('K', 0, 'u', 2), ('K', 1, 'u', 2), ('K', 2, 'a', 3), ('K', 3, 'u', 2)) e(edit, place, initial, new) WHERE place = mid),
ways AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS st, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS way FROM conversations
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.new, min({
    'cost': w.way.cost + 2 * length(e.added) + CASE e.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN e.edit <> 'D' AND n.fault = 'truncated' THEN 1 ELSE 0 END,
    'audit': w.way.audit || e.added || e.edit,
    'lines': list_concat(list_concat(w.way.lines, e.lines), CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [n.role || ':' || n.text] ELSE [CASE WHEN e.mid = 2 THEN 'assistant:' ELSE 'user:' END || n.text] END)})
  FROM ways w JOIN numbered n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.i = w.i + 1 JOIN edits e ON e.st = w.st
    AND (e.edit = 'D' OR n.fault NOT IN ('blank', 'duplicate')) AND (e.initial IS NULL OR e.initial = n.role[1])
  GROUP BY w.conv_id, w.i, e.new),
told AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
  FROM numbered GROUP BY conv_id),
ended AS (
  SELECT w.conv_id, min({'cost': w.way.cost + 2 * length(e.added), 'audit': w.way.audit || e.added, 'lines': list_concat(w.way.lines, e.lines)}) AS way
  FROM ways w LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id
  JOIN (VALUES (0, '', []), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', [])) e(st, added, lines) ON e.st = w.st
  WHERE w.i = coalesce(t.n, 0) GROUP BY w.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  e.way.cost AS cost, e.way.audit AS audit, sha256(coalesce(array_to_string(e.way.lines, chr(10)), '')) AS repaired_sha256
FROM ended e LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""
