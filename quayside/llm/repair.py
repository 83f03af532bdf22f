"""Repair of conversation structure by weighted CYK interval parsing.

The repair grammar is in Chomsky normal form. Its nonterminals ``X(p, q)`` stand for a span of rows whose edits
lead from state p to state q of ``(s?(ua)+)?``: nothing yet, after s, after u, after a. Rules:

- ``X(p, q) -> X(p, r) X(r, q)``, costs added, audits joined;
- ``X(p, q) -> row``: keep 0 (the row's own initial), rerole 1 (to user or assistant), delete 2; a truncated
  row that stays costs 5 more; blank and repeated rows can only be deleted;
- insertion closure: up to two inserted rows, 5 each, before every row and at the end (three or more never pay).

A cell holds the least (cost, audit) of its nonterminal, cells of a span are combined bottom-up by span
length. The grammar is right for every way to split a span (the rules are associative), so each span is split
once, in the middle. Of two audits of one cell and cost neither begins the other (the same rows are
consumed, so one more letter is one more insertion), so least audits of halves make the least audit.

How it runs:

1. Damage, faults and 128-bit hashes by DataFrame functions; rows without their texts go on.
2. Repeated rows: runs of (conversation, role, text) hashes (``runs.mark_runs``).
3. Rows, a letter each, are dealt by ranges of (conversation, turn) and sorted; a conversation of very many
   rows spreads over ranges. A task parses the conversations that lie within its range, and leaves
   the cells of its first and last conversation open. Open spans of one conversation (at most two a range) are
   combined pairwise by rounds of grouping.
4. Texts are shuffled once, to their conversation's audit, sorted, and streamed: a row is held at a time.
   The digest of a conversation is sequential by its definition, so it is made in one task.

Nulls: a null role or text is one space, also in the damage rule. Rows of one turn come by role, then
by the md5 of the text; null turns come first. Null ids are one conversation. Every ``conv_id`` is returned, also
one without rows after damage: zeros and an empty audit. Gaps above the range of a long stay at its end.
Other columns of the input are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import written
from quayside.llm.runs import changes, mark_runs, shuffle_partitions

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. A conversation may end in the first and the last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NONE, ASSISTANT)
NEXT = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
INITIALS = "sua?"
#: Letters of rows: initial x fault (none, truncated, repeated, blank), from this code on.
FIRST_LETTER = 65
SHORT = 16
LEAF = 512

Cell = tuple  # of 16 (cost, audit) or None, by 4 p + q


# ---------------------------------------------------------------- the grammar


def join(left: Cell, right: Cell) -> Cell:
    """The cells of two neighbouring spans as one."""
    out = [None] * 16
    for p in range(4):
        for r in range(4):
            a = left[4 * p + r]
            if a is None:
                continue
            for q in range(4):
                b = right[4 * r + q]
                if b is not None:
                    both = (a[0] + b[0], a[1] + b[1])
                    if out[4 * p + q] is None or both < out[4 * p + q]:
                        out[4 * p + q] = both
    return tuple(out)


def _cell(options: list[tuple[int, int, int, str]]) -> Cell:
    out = [None] * 16
    for p, q, cost, audit in options:
        if out[4 * p + q] is None or (cost, audit) < out[4 * p + q]:
            out[4 * p + q] = (cost, audit)
    return tuple(out)


_TALK = [(p, q) for moves in (NEXT["u"], NEXT["a"]) for p, q in moves.items()]
_SAME = _cell([(p, p, 0, "") for p in range(4)])
_ONE = _cell([(p, q, INSERT, "I") for p, q in _TALK])
#: Up to two inserted rows.
CLOSURE = _cell([(i // 4, i % 4, *c) for part in (_SAME, _ONE, join(_ONE, _ONE)) for i, c in enumerate(part) if c])


@functools.cache
def row_cell(letter: int) -> Cell:
    """The cell of one row, insertions before it included."""
    initial, fault = INITIALS[(letter - FIRST_LETTER) // 4], (letter - FIRST_LETTER) % 4
    options = [(p, p, DELETE, "D") for p in range(4)]
    if fault < 2:
        more = TRUNCATED if fault else 0
        options += [(p, q, KEEP + more, "K") for p, q in NEXT.get(initial, {}).items()]
        options += [(p, q, REROLE + more, "R") for p, q in _TALK]
    return join(CLOSURE, _cell(options))


def _up(cells: list[Cell]) -> Cell:
    while len(cells) > 1:
        cells = [join(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else _SAME


@functools.lru_cache(1 << 15)
def _short(letters: bytes) -> Cell:
    return _up([row_cell(x) for x in letters])


def span_cell(letters: bytes) -> Cell:
    """The cell of a span of rows, bottom-up by span length."""
    return _up([_short(letters[i : i + SHORT]) for i in range(0, len(letters), SHORT)])


def best(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    done = join(cell, CLOSURE)
    return min(done[q] for q in ENDS if done[q] is not None)


# ---------------------------------------------------------------- spans of a conversation


class Span:
    """What is known of neighbouring rows: counts, ends and the parse cell; spans add up."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "first", "last", "least", "most", "turns")

    def __init__(self, values: dict, cell: Cell):
        self.v, self.cell = values, cell

    @classmethod
    def of_rows(cls, letters: bytes, turns: np.ndarray) -> Span:
        """``turns``: those that are not null, in order."""
        x = np.frombuffer(letters, np.uint8) - FIRST_LETTER
        faults, initials = np.bincount(x % 4, minlength=4), x // 4
        pairs = INITIALS_LEGAL[initials[:-1], initials[1:]]
        v = {"blank": int(faults[3]), "duplicate": int(faults[2]), "truncated": int(faults[1]), "illegal": int((~pairs).sum()), "first": int(initials[0]), "last": int(initials[-1])}
        v |= {"least": int(turns[0]) if len(turns) else None, "most": int(turns[-1]) if len(turns) else None, "turns": int((np.diff(turns) != 0).sum()) + 1 if len(turns) else 0}
        return cls(v, span_cell(letters))

    def __add__(self, other: Span) -> Span:
        a, b = self.v, other.v
        v = {c: a[c] + b[c] for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
        v["illegal"] += not INITIALS_LEGAL[a["last"], b["first"]]
        v["turns"] -= a["most"] is not None and a["most"] == b["least"]
        v |= {"first": a["first"], "last": b["last"], "least": b["least"] if a["least"] is None else a["least"], "most": a["most"] if b["most"] is None else b["most"]}
        return Span(v, join(self.cell, other.cell))

    def result(self) -> dict:
        v = self.v
        gaps = v["most"] - v["least"] + 1 - v["turns"] if v["turns"] else 0
        cost, audit = best(self.cell)
        return {"gaps": min(gaps, (1 << 63) - 1), "blank": v["blank"], "duplicate": v["duplicate"], "truncated": v["truncated"], "illegal": v["illegal"], "cost": cost, "audit": audit}


INITIALS_LEGAL = np.array([[a + b in LEGAL for b in INITIALS] for a in INITIALS])
RESULT = [*(T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), T.StructField("audit", T.StringType())]
OPEN = [*(T.StructField(c, T.LongType()) for c in Span.FIELDS), T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType()))]


class Spans:
    """Spans added in order, equal lengths first (a binary counter), so that joins go by span length."""

    def __init__(self):
        self.stack: list[tuple[int, Span]] = []

    def push(self, span: Span) -> None:
        size = 1
        while self.stack and self.stack[-1][0] <= size:
            left = self.stack.pop()
            span, size = left[1] + span, left[0] + size
        self.stack.append((size, span))

    def total(self) -> Span:
        out = self.stack[-1][1]
        for _, left in reversed(self.stack[:-1]):
            out = left + out
        return out


def _open_row(span: Span) -> dict:
    return {c: span.v[c] for c in Span.FIELDS} | {"costs": [c[0] if c else None for c in span.cell], "audits": [c[1] if c else None for c in span.cell]}


def _span_of(row: dict) -> Span:
    cell = tuple(None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True))
    return Span({c: row[c] for c in Span.FIELDS}, cell)


# ---------------------------------------------------------------- rows


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that the crc32 of ``conv_id:turn`` decides."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", F.col("turn").try_cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"), (F.crc32(key) % 20).alias("_kind"))
    kind = F.col("_kind")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_again")).drop("_again")


def _lettered(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, m, letter``: the rows without their texts."""
    kept = F.rtrim("text", F.lit(SPACES))
    blank, cut = kept == "", ~F.substring(kept, -1, 1).isin(*STOPS)
    slim = rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("m"), F.when(blank, 3).when(cut, 1).otherwise(0).alias("fault"))
    slim = slim.withColumns({"k1": F.xxhash64(F.lit(1), "conv_id", "role", "m"), "k2": F.xxhash64(F.lit(2), "conv_id", "role", "m")})
    runs = mark_runs(written(rows.sparkSession, slim, "turns"), "turn", F.asc_nulls_first("turn"), name="turn-runs")
    fault = F.when(~F.col("_first") & (F.col("fault") < 3), 2).otherwise(F.col("fault"))
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS[:3]))
    initial = F.when((initial > 0) & (F.col("role") != ""), initial - 1).otherwise(3)
    return runs.select("conv_id", "turn", "role", "m", (FIRST_LETTER + 4 * initial + fault).cast("byte").alias("letter"), (~F.col("_first")).alias("later"))


def _order() -> list[Column]:
    return [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("m")]


def parse(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``RESULT`` of every conversation with rows after damage."""
    return _parsed(_lettered(damaged(conversations)))


def _parsed(rows: DataFrame) -> DataFrame:
    spark, id_field = rows.sparkSession, rows.schema["conv_id"]
    schema = T.StructType([id_field, T.StructField("_range", T.IntegerType()), *OPEN, *[f for f in RESULT if f.name not in Span.FIELDS]])
    names = schema.names

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, conv, acc, first = TaskContext.get().partitionId(), None, None, True
        out: list[dict] = []
        arrow = None

        def close(whole: bool) -> None:
            span = acc.total()
            out.append({"conv_id": conv, "_range": at} | (span.result() if whole else _open_row(span)))

        def batch() -> pa.RecordBatch:
            cols = [pa.array([r.get(c) for r in out], arrow if c == "conv_id" else _ARROW.get(c, pa.int64())) for c in names]
            out.clear()
            return pa.record_batch(cols, names)

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            ids, turns = b.column("conv_id"), b.column("turn")
            arrow = ids.type
            known = turns.is_valid().to_numpy(zero_copy_only=False).astype(bool)
            at_turn = turns.fill_null(0).to_numpy()
            letters = np.asarray(b.column("letter")).astype(np.uint8).tobytes()
            cuts = [0, *(np.flatnonzero(changes(ids)) + 1).tolist(), n]
            for i, j in zip(cuts, cuts[1:], strict=False):
                own = ids[i].as_py()
                if acc is None or own != conv:
                    if acc is not None:
                        close(not first)
                        first = False
                    conv, acc = own, Spans()
                for a in range(i, j, LEAF):
                    e = min(a + LEAF, j)
                    acc.push(Span.of_rows(letters[a:e], at_turn[a:e][known[a:e]]))
                if len(out) >= 2_000:
                    yield batch()
        if acc is not None:
            close(False)
        if out:
            yield batch()

    dealt = rows.repartitionByRange(shuffle_partitions(rows), *_order()).sortWithinPartitions(*_order(), "later")
    found = written(spark, dealt.mapInArrow(spans, schema), "conversation-spans")
    result = [f.name for f in RESULT]
    inner = found.filter(F.col("costs").isNull()).select("conv_id", *result)
    # open spans: at most two a range; halves of halves are combined first
    order = Window.partitionBy("conv_id").orderBy("_range")
    fields = [f.name for f in OPEN]
    rest = written(spark, found.filter(F.col("costs").isNotNull()).select("conv_id", (F.row_number().over(order) - 1).alias("place"), *fields), "conversation-open")
    most = rest.agg(F.max("place")).first()[0] or 0
    kind = T.StructType([id_field, T.StructField("place", T.IntegerType()), *OPEN])
    for _ in range(math.ceil(math.log2(most + 1))):
        pairs = rest.groupBy("conv_id", F.floor(F.col("place") / 2).cast("int").alias("pair")).agg(F.sort_array(F.collect_list(F.struct("place", *fields))).alias("parts"))
        rest = pairs.mapInArrow(_rows_of(lambda r: {"conv_id": r["conv_id"], "place": r["pair"]} | _open_row(functools.reduce(Span.__add__, map(_span_of, r["parts"])))), kind)
    whole = rest.mapInArrow(_rows_of(lambda r: {"conv_id": r["conv_id"]} | _span_of(r).result()), T.StructType([id_field, *RESULT]))
    return inner.unionByName(whole.select("conv_id", *result))


_ARROW = {"_range": pa.int32(), "place": pa.int32(), "costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string()), "audit": pa.string(), "repaired_sha256": pa.string(), "role": pa.string(), "text": pa.string(), "edit": pa.string()}


def _rows_of(fn: Callable[[dict], dict]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [fn(r) for r in b.to_pylist()]
            if rows:
                yield pa.record_batch([pa.array([r[c] for r in rows], b.column("conv_id").type if c == "conv_id" else _ARROW.get(c, pa.int64())) for c in rows[0]], list(rows[0]))

    return run


# ---------------------------------------------------------------- repaired conversations


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, object]]:
    """Events of sorted rows: ("open", result row), ("row", (edit, turn, role, text)) of every row that
    stands after the repair, ("close", result row)."""
    head, audit, state = None, iter(""), NONE

    def inserts(edit: str | None) -> Iterator[tuple[str, object]]:
        nonlocal state
        while edit == "I":
            state = NEXT["a"].get(state) or NEXT["u"][state]
            yield "row", ("I", None, NAMES[state], "")
            edit = next(audit, None)
        return edit

    for b in batches:
        for r in b.to_pylist():
            if r["audit"] is not None:
                if head is not None:
                    yield from inserts(next(audit, None))
                    yield "close", head
                head, audit, state = r, iter(r["audit"]), NONE
                yield "open", head
                continue
            edit = yield from inserts(next(audit, None))
            if edit == "K":
                state = NEXT[r["role"][0]][state]
                yield "row", ("K", r["turn"], r["role"], r["text"])
            elif edit == "R":
                state = NEXT["a"].get(state) or NEXT["u"][state]
                yield "row", ("R", r["turn"], NAMES[state], r["text"])
    if head is not None:
        yield from inserts(next(audit, None))
        yield "close", head


def _heads_and_rows(conversations: DataFrame) -> DataFrame:
    """Each conversation's result row followed by its damaged rows, in order, in one task."""
    rows = damaged(conversations)
    parsed = _parsed(_lettered(rows)).withColumnRenamed("conv_id", "_conv")
    ids = conversations.select("conv_id").distinct()
    result = [f.name for f in RESULT]
    heads = ids.join(parsed, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    heads = heads.select("conv_id", *(F.coalesce(c, F.lit("" if c == "audit" else 0)).alias(c) for c in result))
    rows = rows.withColumn("m", F.unhex(F.md5("text")))
    both = heads.unionByName(rows, allowMissingColumns=True).repartition(shuffle_partitions(rows), "conv_id")
    return both.sortWithinPartitions("conv_id", F.asc_nulls_last("audit"), F.asc_nulls_first("turn"), "role", "m")


def repair(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, edit, turn, role, text``: the rows of every repaired conversation, in order of ``place``
    (edit K, R or I)."""
    both = _heads_and_rows(conversations)
    schema = T.StructType([both.schema["conv_id"], T.StructField("place", T.IntegerType()), T.StructField("edit", T.StringType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, out, size = None, 0, [], 0
        kind = None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.column("conv_id").type
                yield b

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            return pa.record_batch([pa.array(c, kind if n == "conv_id" else _ARROW.get(n, pa.int64())) for c, n in zip(cols, schema.names, strict=True)], schema.names)

        for event, r in _repairs(seen()):
            if event == "open":
                conv, place = r["conv_id"], 0
            elif event == "row":
                out.append((conv, place, *r))
                place, size = place + 1, size + len(r[3])
                if size > 1 << 22 or len(out) >= 10_000:
                    yield batch()
                    out, size = [], 0
        if out:
            yield batch()

    return both.mapInArrow(run, schema)


def repair_report(conversations: DataFrame) -> DataFrame:
    """A row per ``conv_id``: gaps, faults, cost, audit and the digest of the repaired rows."""
    both = _heads_and_rows(conversations)
    schema = T.StructType([both.schema["conv_id"], *RESULT, T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, digest, any_row = None, [], hashlib.sha256(), False

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.column("conv_id").type
                yield b

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[c] for r in out], kind if c == "conv_id" else _ARROW.get(c, pa.int64())) for c in schema.names], schema.names)

        for event, r in _repairs(seen()):
            if event == "open":
                digest, any_row = hashlib.sha256(), False
            elif event == "row":
                digest.update((("\n" if any_row else "") + f"{r[2]}:{r[3]}").encode())
                any_row = True
            else:
                out.append(r | {"repaired_sha256": digest.hexdigest()})
                if len(out) >= 2_000:
                    yield batch()
                    out = []
        if out:
            yield batch()

    return both.mapInArrow(run, schema)


_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: The same by states from left to right, a row a step (integers only as ids and turns; crc32 by its table).
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), 'none') AS conv, turn, role, text,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: CAST(unicode(key[i]) AS BIGINT))),
             lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS kind
  FROM keyed, crc),
d AS (
  SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS again
  FROM kinds WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), again) AS k,
         rtrim(text, {_WS}) AS kept FROM d),
r AS (
  SELECT conv, turn, role, text, k, left(role, 1) AS initial,
         CASE WHEN trim(kept, {_WS}) = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 THEN 'duplicate'
              WHEN right(kept, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY k) || left(role, 1) AS pair
  FROM o),
stats AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS n FROM r GROUP BY conv),
moves(p, initial, q) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
inserts(p, q, cost, audit, lines) AS (
  SELECT p, p, 0, '', '' FROM (VALUES ('0'), ('s'), ('u'), ('a')) AS t(p)
  UNION ALL SELECT p, q, {INSERT}, 'I', chr(10) || CASE q WHEN 'u' THEN 'user:' ELSE 'assistant:' END FROM moves WHERE initial <> 's'
  UNION ALL SELECT p, 'a', {2 * INSERT}, 'II', chr(10) || 'user:' || chr(10) || 'assistant:' FROM (VALUES ('0'), ('s')) AS t(p)),
edits AS (
  SELECT conv, k, p, p AS q, {DELETE} AS cost, 'D' AS audit, '' AS lines FROM r, (VALUES ('0'), ('s'), ('u'), ('a')) AS t(p)
  UNION ALL
  SELECT conv, k, p, q, CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END, 'K', chr(10) || role || ':' || text
  FROM r JOIN moves ON moves.initial = r.initial WHERE fault IN ('', 'truncated')
  UNION ALL
  SELECT conv, k, p, q, {REROLE} + CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END, 'R',
         chr(10) || CASE q WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
  FROM r JOIN moves ON moves.initial <> 's' WHERE fault IN ('', 'truncated')),
dp AS (
  SELECT conv, CAST(0 AS BIGINT) AS k, '0' AS q, {{'cost': 0, 'audit': '', 'lines': ''}} AS v FROM stats
  UNION ALL
  SELECT dp.conv, dp.k + 1, e.q, min({{'cost': v.cost + i.cost + e.cost, 'audit': v.audit || i.audit || e.audit, 'lines': v.lines || i.lines || e.lines}})
  FROM dp JOIN inserts i ON i.p = dp.q JOIN edits e ON e.conv = dp.conv AND e.k = dp.k + 1 AND e.p = i.q GROUP BY 1, 2, 3),
done AS (
  SELECT conv, min({{'cost': v.cost + i.cost, 'audit': v.audit || i.audit, 'lines': v.lines || i.lines}}) AS v
  FROM dp JOIN stats USING (conv) JOIN inserts i ON i.p = dp.q WHERE dp.k = n AND i.q IN ('0', 'a') GROUP BY conv)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.cost, 0)::BIGINT AS cost,
       coalesce(v.audit, '') AS audit, sha256(substr(coalesce(v.lines, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), 'none') AS conv FROM conversations) c
LEFT JOIN stats USING (conv) LEFT JOIN done USING (conv)
"""
