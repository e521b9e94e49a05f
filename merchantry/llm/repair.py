"""Cheapest repair of the structure of conversations: a Viterbi search in chunks whose cost vectors converge."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.functions.numbering import id_by_order
from merchantry.llm.rows import kept, pick
from merchantry.llm.streams import mark

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# rows of a chunk: 2^10
CHUNK_BITS = 10
INITIALS = "sua"
ROLES = {"u": "user", "a": "assistant"}
# before any row, behind a system row, behind a user row, behind an assistant row; where an accepted sequence may end
START, SYSTEM, USER, ASSISTANT = range(4)
END = (0, 2 * INSERT, INSERT, 0)
NEUTRAL = (0, 0, 0, 0)
KEY = ["known", "conv"]
WORDS = re.compile(r"[^\x20\x09-\x0D]")

Vector = tuple[int, int, int, int]


def _after(state: int, role: str) -> int | None:
    """The state behind a row of this initial; None if ``(s?(ua)+)?`` has no such row here."""
    if role == "s":
        return SYSTEM if state == START else None
    if role == "u":
        return USER if state != USER else None
    return ASSISTANT if role == "a" and state == USER else None


def _next_role(state: int) -> str:
    """What a new or renamed row has to be."""
    return "a" if state == USER else "u"


def _options(code: int, after: Vector, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost to the end, state behind it) of the edits that take the row ``code``, the initial's place and whether it is truncated."""
    role, extra = (INITIALS + "?")[code >> 1], TRUNCATED * (code & 1)
    found = [("D", DELETE + after[state], state)]
    kept_at, renamed = _after(state, role), _after(state, _next_role(state))
    if kept_at is not None:
        found.append(("K", KEEP + extra + after[kept_at], kept_at))
    return [*found, ("R", REROLE + extra + after[renamed], renamed)]


def _inserted(taken: list[int]) -> Vector:
    """Costs if rows may be inserted first, from those without."""
    user, assistant = min(taken[USER], INSERT + taken[ASSISTANT]), min(taken[ASSISTANT], INSERT + taken[USER])
    return min(taken[START], INSERT + user), min(taken[SYSTEM], INSERT + user), user, assistant


def _level(vector: Vector) -> Vector:
    """The vector less its least value: vectors that differ by a constant are equal then."""
    least = min(vector)
    return tuple(v - least for v in vector)


@lru_cache(maxsize=1 << 16)
def _before(code: int, after: Vector) -> Vector:
    """One step back over a row: what the rest costs from each state before it, on the scale of ``after``."""
    return _inserted([min(cost for _, cost, _ in _options(code, after, state)) for state in range(4)])


@lru_cache(maxsize=1 << 16)
def _edits(code: int, after: Vector, state: int) -> tuple[str, int]:
    """The least of the cheapest edits, in ASCII, until the row is taken, and the state behind it."""
    whole, edits = _before(code, after), ""
    while True:
        ways = [*_options(code, after, state), ("I", INSERT + whole[new := _after(state, _next_role(state))], new)]
        edit, _, behind = min(w for w in ways if w[1] == whole[state])
        edits, state = edits + edit, behind
        if edit != "I":
            return edits, state


def backward(codes: list[int], end: Vector) -> Vector:
    """The levelled cost vector before the rows, from the one behind them."""
    for code in reversed(codes):
        end = _level(_before(code, end))
    return end


def rerun(codes: list[int], old_end: Vector, old_start: Vector, end: Vector) -> Vector:
    """As ``backward`` from ``end``, only as far as the vectors differ by more than a constant from those from ``old_end``."""
    for code in reversed(codes):
        if end == old_end:
            return old_start
        old_end, end = _level(_before(code, old_end)), _level(_before(code, end))
    return end


def marked(rows: DataFrame) -> DataFrame:
    """The rows with a key for their conversation (also without an id), 256 bits of role and text, and ``code``: -1 for blank texts."""
    named = pick(rows, "conv_id", "turn", "role", "text").select(
        F.isnotnull("conv_id").alias("known"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    code = F.when(~F.col("text").rlike(WORDS.pattern), -1).otherwise(initial * 2 + (~whole).cast("int")).cast("byte")
    return named.select("*", F.expr(mark("role", "text")).alias("mark"), code.alias("code"))


def chunks(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """(known, conv, chunk, codes, marks, turn, last): the first row of each role and text that is not blank, in chunks of 2^bits places.

    Only these rows leave a choice; others must be deleted whatever the state. They are numbered over all conversations at once, so
    that a conversation of any length is spread over tasks. No text is moved.
    """
    free = rows.filter("code >= 0").groupBy(*KEY, "mark", "code").agg(F.max(F.isnull("turn")).alias("unnumbered"), F.min("turn").alias("turn"))
    free = free.select(*KEY, F.expr("if(unnumbered, null, turn)").alias("turn"), "mark", "code")
    placed = id_by_order(kept(free, "repair-rows"), [*KEY, "turn", "mark"], "at", 0)
    each = F.sort_array(F.collect_list(F.struct("at", "code", "mark", "turn"))).alias("t")
    listed = placed.groupBy(*KEY, F.shiftright("at", bits).alias("chunk")).agg(each)
    listed = kept(listed.select(*KEY, "chunk", F.col("t.code").alias("codes"), F.col("t.mark").alias("marks"), F.col("t")[0]["turn"].alias("turn")), "repair-chunks")
    ends = listed.groupBy(*KEY).agg(F.max("chunk").alias("final"))
    return listed.join(ends, KEY).withColumn("last", F.col("chunk") == F.col("final")).drop("final")


VECTORS = "known boolean, conv long, chunk long, codes array<tinyint>, end array<int>, start array<int>"


def _vectors(batch: pa.RecordBatch, ends: list, starts: list) -> pa.RecordBatch:
    kind = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*KEY, "chunk", "codes")], pa.array(ends, kind), pa.array(starts, kind)],
                                      [*KEY, "chunk", "codes", "end", "start"])


def _speculated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = [END if last else NEUTRAL for last in batch.column("last").to_pylist()]
        yield _vectors(batch, ends, [backward(codes, end) for codes, end in zip(batch.column("codes").to_pylist(), ends)])


def _fixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a span, the last first: each one gets the vector of the next, which the span's last chunk has in ``after``."""
    span, carried = None, None
    for batch in batches:
        ends, starts = [], []
        for *own, codes, end, start, after in zip(*[batch.column(c).to_pylist() for c in (*KEY, "span", "codes", "end", "start", "after")]):
            if own != span:
                span, carried = own, tuple(after if after is not None else end)
            end, start = tuple(end), tuple(start)
            ends.append(carried)
            carried = rerun(codes, end, start, carried)
            starts.append(carried)
        yield _vectors(batch, ends, starts)


def converged(parts: DataFrame) -> tuple[DataFrame, int]:
    """(known, conv, chunk, codes, end, start) with the exact, levelled cost vectors behind and before each chunk, and the passes taken.

    All chunks start at once from a neutral vector, the last of a conversation from the exact one. A fix-up pass runs
    those again whose end is not the start of the next chunk, until the vectors differ by a constant. In pass p the chunks of
    a span of 2^p are fixed one behind the other, so that even vectors that never converge need no more passes
    than the longest conversation's number of chunks has bits.
    """
    state, passes = kept(parts.mapInArrow(_speculated, VECTORS), "repair-vectors"), 0
    while True:
        nexts = state.select(*KEY, (F.col("chunk") - 1).alias("chunk"), F.col("start").alias("after"))
        joined = state.join(nexts, [*KEY, "chunk"], "left").withColumn("span", F.shiftright("chunk", passes))
        wrong = kept(joined.filter("after != end").select(*KEY, "span").distinct(), "repair-spans")
        if wrong.isEmpty():
            return state, passes
        names = [*KEY, "chunk", "codes", "end", "start"]
        again = joined.join(wrong, [*KEY, "span"], "left_semi").repartition(*KEY, "span").sortWithinPartitions(*KEY, "span", F.desc("chunk"))
        again = again.select(*names, "span", "after").mapInArrow(_fixed, VECTORS)
        state = kept(joined.join(wrong, [*KEY, "span"], "left_anti").select(*names).unionByName(again), "repair-vectors")
        passes += 1


class _Conversation:
    """One conversation while its rows pass, in order: counts, edits, and what is to be written."""

    def __init__(self, known: bool, conv: int):
        self.id = conv if known else None
        self.waiting: deque = deque()
        self.codes, self.marks, self.costs, self.at = [], [], [], 0
        self.state, self.cost, self.audit = START, 0, []
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def chunk(self, codes: list[int], marks: list[bytes], end: list[int]) -> None:
        self.waiting.append((codes, marks, tuple(end)))

    def _expected(self) -> bytes | None:
        if self.at == len(self.codes) and self.waiting:
            self.codes, self.marks, end = self.waiting.popleft()
            self.at, self.costs = 0, [end]
            for code in reversed(self.codes[1:]):
                end = _level(_before(code, end))
                self.costs.append(end)
            self.costs.reverse()
        return self.marks[self.at] if self.at < len(self.marks) else None

    def _new(self) -> tuple[str, str, str]:
        role = _next_role(self.state)
        self.state, self.cost = _after(self.state, role), self.cost + INSERT
        return "I", ROLES[role], ""

    def row(self, turn: int | None, role: str, text: str, own: bytes) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) for the row and what is inserted in front of it."""
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = (turn if self.low is None else self.low), turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        if not WORDS.search(text) or self._expected() != own:
            self.blank, self.duplicate = (self.blank + 1, self.duplicate) if not WORDS.search(text) else (self.blank, self.duplicate + 1)
            self.cost += DELETE
            yield "D", role, text
            return
        code, after = self.codes[self.at], self.costs[self.at]
        self.at += 1
        self.truncated += code & 1
        *inserts, edit = _edits(code, after, self.state)[0]
        for _ in inserts:
            yield self._new()
        if edit == "D":
            self.cost += DELETE
        else:
            self.cost += TRUNCATED * (code & 1) + (REROLE if edit == "R" else KEEP)
            initial = _next_role(self.state) if edit == "R" else role[:1]
            self.state, role = _after(self.state, initial), ROLES[initial] if edit == "R" else role
        yield edit, role, text

    def rest(self) -> Iterator[tuple[str, str, str]]:
        while self.state in (SYSTEM, USER):
            yield self._new()

    def report(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost


EDITS = "conv_id long, place long, edit string, role string, text string"
REPORTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _traced(rows: DataFrame, bits: int) -> DataFrame:
    """Chunks and rows of each conversation in order: a chunk stands in front of its first row."""
    rows = marked(rows)
    parts = chunks(rows, bits)
    exact, _ = converged(parts)
    ends = parts.drop("codes").join(exact.select(*KEY, "chunk", "codes", "end"), [*KEY, "chunk"])
    heads = ends.select(*KEY, "turn", F.col("marks")[0].alias("mark"), "codes", "marks", "end")
    both = heads.unionByName(rows.select(*KEY, "turn", "mark", "role", "text"), allowMissingColumns=True)
    # nulls come first: of a chunk and a row with the same mark the chunk has no role
    return both.repartition(*KEY).sortWithinPartitions(*KEY, "turn", "mark", "role").select(*KEY, "turn", "mark", "role", "text", "codes", "marks", "end")


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, Iterator | None]]:
    """(conversation, edits) for every row, and (conversation, None) behind the last."""
    key, now = None, None
    for batch in batches:
        for known, conv, turn, own, role, text, codes, marks, end in zip(*[c.to_pylist() for c in batch.columns]):
            if (known, conv) != key:
                if now:
                    yield now, None
                key, now = (known, conv), _Conversation(known, conv)
            if codes is not None:
                now.chunk(codes, marks, end)
            else:
                yield now, now.row(turn, role, text, own)
    if now:
        yield now, None


def _batches(rows: Iterator[tuple], ddl: str, most: int) -> Iterator[pa.RecordBatch]:
    fields = [f.split() for f in ddl.split(", ")]
    schema = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in fields])
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """(conv_id, place, edit, role, text): every row with what was done to it (K, R, D) and the inserted ones (I), numbered from 0.

    Without the rows of edit D these are the repaired conversations. Conversations are ordered by turn, null first, then by a
    hash of role and text. Null roles and texts are one space, and rows without a conv_id are one conversation.
    An empty table gives no rows. Rows pass through a task one by one: a conversation may be of any length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edits() -> Iterator[tuple]:
            place = 0
            for now, some in _passing(batches):
                for edit, role, text in now.rest() if some is None else some:
                    yield now.id, place, edit, role, text
                    place += 1
                place = 0 if some is None else place
        return _batches(edits(), EDITS, 1024)

    return _traced(rows, bits).mapInArrow(run, EDITS)


def reports(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """Per conversation its faults, the cost and the edits' initials of the cheapest repair, and the hash of what it gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            digest, empty, audit = hashlib.sha256(), True, []
            for now, some in _passing(batches):
                for edit, role, text in now.rest() if some is None else some:
                    audit.append(edit)
                    if edit != "D":
                        digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                        empty = False
                if some is None:
                    yield *now.report(), "".join(audit), digest.hexdigest()
                    digest, empty, audit = hashlib.sha256(), True, []
        return _batches(lines(), REPORTS, 256)

    return _traced(rows, bits).mapInArrow(run, REPORTS)


def damaged(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults by a hash of conversation and turn: rows dropped, emptied, cut, repeated, of a wrong role."""
    rows = pick(df, "conv_id", "turn", "role", "text")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.expr("explode(array_repeat(0, if(fault = 0, 0, if(fault = 3, 2, 1))))")
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def repaired_conversations(df: DataFrame) -> DataFrame:
    """One row per conversation of ``df`` (rows without an id are one): faults of the damaged rows, and their cheapest repair.

    Every conv_id stays, also one whose rows are all dropped: zeros, an empty audit, the hash of nothing. An empty table gives none.
    Nulls, ties and long conversations: see ``repaired``.
    """
    found = reports(damaged(df)).withColumnRenamed("conv_id", "id")
    every = pick(df, "conv_id").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


# from the last row on, what the rest costs from the four states: struct of cost, audit and rows given
REPAIR_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(ch)::BIGINT for ch in string_split(
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))),
      4294967295) % 20 AS fault
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed
), placed AS (
  SELECT conv_id, turn, role, text, role[1] AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(strlen(role) || ':' || role || strlen(text) || ':' || text)) AS i FROM hurt
), judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed
), steps AS (
  SELECT conv_id, i, chr(10) || role || ':' || text AS own, ':' || text AS said, blank OR again AS gone,
    CASE WHEN NOT blank AND NOT again THEN initial END AS initial, CASE WHEN cut THEN 3 ELSE 0 END AS extra FROM judged
), ways AS (
  SELECT conv_id, max(i) AS i, {'c': 0, 'a': '', 'o': ''} AS v0, {'c': 6, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'} AS vs,
    {'c': 3, 'a': 'I', 'o': chr(10) || 'assistant:'} AS vu, {'c': 0, 'a': '', 'o': ''} AS va
  FROM steps GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i - 1, least(e0, {'c': 3 + fu.c, 'a': 'I' || fu.a, 'o': chr(10) || 'user:' || fu.o}),
    least(es, {'c': 3 + fu.c, 'a': 'I' || fu.a, 'o': chr(10) || 'user:' || fu.o}), fu, fa
  FROM (
    SELECT conv_id, i, e0, es, least(eu, {'c': 3 + ea.c, 'a': 'I' || ea.a, 'o': chr(10) || 'assistant:' || ea.o}) AS fu,
      least(ea, {'c': 3 + eu.c, 'a': 'I' || eu.a, 'o': chr(10) || 'user:' || eu.o}) AS fa
    FROM (
      SELECT conv_id, i,
        least({'c': 4 + v0.c, 'a': 'D' || v0.a, 'o': v0.o}, CASE WHEN initial = 's' THEN {'c': extra + vs.c, 'a': 'K' || vs.a, 'o': own || vs.o} END, keep_u, name_u) AS e0,
        least({'c': 4 + vs.c, 'a': 'D' || vs.a, 'o': vs.o}, keep_u, name_u) AS es,
        least({'c': 4 + vu.c, 'a': 'D' || vu.a, 'o': vu.o}, CASE WHEN initial = 'a' THEN {'c': extra + va.c, 'a': 'K' || va.a, 'o': own || va.o} END,
          CASE WHEN NOT gone THEN {'c': 3 + extra + va.c, 'a': 'R' || va.a, 'o': chr(10) || 'assistant' || said || va.o} END) AS eu,
        least({'c': 4 + va.c, 'a': 'D' || va.a, 'o': va.o}, keep_u, name_u) AS ea
      FROM (
        SELECT ways.*, own, said, gone, initial, extra, CASE WHEN initial = 'u' THEN {'c': extra + vu.c, 'a': 'K' || vu.a, 'o': own || vu.o} END AS keep_u,
          CASE WHEN NOT gone THEN {'c': 3 + extra + vu.c, 'a': 'R' || vu.a, 'o': chr(10) || 'user' || said || vu.o} END AS name_u
        FROM ways JOIN steps ON steps.conv_id IS NOT DISTINCT FROM ways.conv_id AND steps.i = ways.i
      )
    )
  )
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(v0.c, 0) AS BIGINT) AS cost, coalesce(v0.a, '') AS audit, sha256(substr(coalesce(v0.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN ways ON ways.conv_id IS NOT DISTINCT FROM ids.conv_id AND ways.i = 0
"""
