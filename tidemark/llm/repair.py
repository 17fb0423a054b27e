"""Conversation structure repair by weighted CYK interval parsing.

The pattern of role initials ``(s?(ua)+)?`` has four states: START, after s,
after u, after a.  The nonterminal X[p, q] derives a stretch of rows whose
repaired initials lead from p to q, and the grammar in Chomsky normal form is

    X[p, q] -> X[p, r] X[r, q]                a span split in two
    X[p, q] -> row                            Keep, Rerole, Delete as terminal rules

with empty-text turns inserted before and after every row (the insertion
closure of the terminal rules).  A cell of a span holds, for every X[p, q], the
least (cost, audit); spans are combined bottom-up by their length.  Audits of
one span and one cost are never prefixes of each other (an Insert costs more
than nothing), so the least audit of a whole is made of least audits of its
parts and the cells lose nothing.

A row is one of nine symbols to the grammar, so a span's cells depend on its
symbols alone and are kept by them.  Rows are brought into order by a range
sort without their texts: a long conversation lies over many tasks, each parses
its stretch, and the cells of stretches are joined in a tree.  Texts move once,
for the hash of the repaired conversation, which is taken as they stream by.

Defined cases: null roles and texts are one space; a null conv_id is a
conversation of its own; rows of one turn are ordered by role, then by the MD5
of the text; a role without a letter can't be kept; equal rows are counted
before they move (all but the first are duplicates); a conversation whose rows
are all dropped has zeros, an empty audit and the hash of the empty string; an
empty table gives no rows.  The audit has one letter a row at least and is the
one thing here that grows with a conversation in a single cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import pin, pins, shuffle_partitions

START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_A, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
SPACE = "\\x20\\x09-\\x0D"
#: Rows parsed over all their spans at once; longer stretches are joined from such blocks.
BLOCK = 16
#: Cells kept by their symbols before the store is emptied.
KEPT_CELLS = 50_000
#: Stretches of one conversation joined in one group.
FAN_IN = 8

Cells = dict[tuple[int, int], tuple[int, str]]


def _better(cells: Cells, at: tuple[int, int], cost: int, audit: str) -> None:
    if at not in cells or (cost, audit) < cells[at]:
        cells[at] = (cost, audit)


def join_spans(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts: X[p, q] -> X[p, r] X[r, q]."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                _better(out, (p, q), cost + more, audit + rest)
    return out


def _insertions() -> Cells:
    """Cells of the empty span: the cheapest insertions from state to state."""
    cells: Cells = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for (p, r), (cost, audit) in list(cells.items()):
            for role in "ua":
                if (r, role) in STEP:
                    _better(cells, (p, STEP[r, role]), cost + INSERT, audit + "I")
    return cells


EMPTY = _insertions()


def row_cells(symbol: str) -> Cells:
    """Cells of one row: ``d`` must go, else s, u, a or x (another initial), in capitals when truncated."""
    cells: Cells = {(p, p): (DELETE, "D") for p in STATES}
    if symbol != "d":
        extra = TRUNCATED * symbol.isupper()
        for (p, role), q in STEP.items():
            if role == symbol.lower():
                _better(cells, (p, q), KEEP + extra, "K")
            if role in ROLES:
                _better(cells, (p, q), REROLE + extra, "R")
    return join_spans(join_spans(EMPTY, cells), EMPTY)


class Parser:
    """CYK cells of symbol strings; cells of short spans are kept by their symbols."""

    def __init__(self):
        self.kept: dict[str, Cells] = {}

    def block(self, symbols: str) -> Cells:
        """All spans, bottom-up by length, each over all its splits."""
        if symbols in self.kept:
            return self.kept[symbols]
        if len(self.kept) > KEPT_CELLS:
            self.kept.clear()
        for length in range(1, len(symbols) + 1):
            for i in range(len(symbols) - length + 1):
                span = symbols[i:i + length]
                if span in self.kept:
                    continue
                if length == 1:
                    self.kept[span] = row_cells(span)
                    continue
                cells: Cells = {}
                for k in range(1, length):
                    for at, (cost, audit) in join_spans(self.kept[span[:k]], self.kept[span[k:]]).items():
                        _better(cells, at, cost, audit)
                self.kept[span] = cells
        return self.kept[symbols]

    def cells(self, symbols: str) -> Cells:
        """Cells of a whole stretch, its blocks joined pairwise."""
        return join_all([self.block(symbols[i:i + BLOCK]) for i in range(0, len(symbols), BLOCK)])


def join_all(spans: list[Cells]) -> Cells:
    """Neighbouring spans joined two by two until one is left."""
    while len(spans) > 1:
        spans = [join_spans(*spans[i:i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0] if spans else EMPTY


def best(cells: Cells) -> tuple[int, str]:
    """The cheapest repair of a whole conversation."""
    return min(cells[START, q] for q in (START, AFTER_A) if (START, q) in cells)


def illegal_pair(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies`` (0 where the row is dropped) after the damage by crc32(conv_id:turn)."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


ROW_KEY = ["conv_id", "turn", "role", "h"]


def _faults(damaged: DataFrame) -> DataFrame:
    """One row per distinct damaged row, without its text: how many copies, its fault and whether it came earlier."""
    facts = damaged.select("conv_id", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("h"), "copies",
                           (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"), (~F.col("text").rlike(f"[.!?][{SPACE}]*\\z")).alias("cut"))
    rows = facts.groupBy(*ROW_KEY, "blank", "cut").agg(F.sum("copies").alias("n"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (rows.filter("not blank and n > 0").groupBy("conv_id", "role", "h").agg(F.min(order).alias("first"))
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("d"), "first"))
    seen = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("d")), "left")
    return seen.select(*ROW_KEY, "n", "blank", "cut", (~F.col("blank") & (F.col("first") < order)).alias("seen"))


def _counts(faults: DataFrame) -> DataFrame:
    """gaps and the rows with each fault, per conversation."""
    def total(condition: Column, n: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, n).otherwise(0)).cast("long")

    turn = F.when(F.col("n") > 0, F.col("turn"))
    blank, seen, once = F.col("blank"), F.col("seen"), F.col("n") > 0
    return faults.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"),
        total(blank).alias("blank"), (total(~blank & seen) + total(~blank & ~seen & once, F.col("n") - 1)).alias("duplicate"),
        total(~blank & ~seen & F.col("cut") & once, F.lit(1)).alias("truncated"))


def _parse(faults: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit of every conversation with rows."""
    spark = faults.sparkSession
    kind = dict(faults.dtypes)["conv_id"]
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    rows = faults.filter("n > 0").select(
        *ROW_KEY, "n", initial.alias("initial"),
        F.when(F.col("blank") | F.col("seen"), "d").when(F.col("cut"), F.upper(letter)).otherwise(letter).alias("symbol"))
    parts = shuffle_partitions(spark)
    ordered = rows.repartitionByRange(parts, *ROW_KEY).sortWithinPartitions(*ROW_KEY).drop("turn", "role", "h")
    schema = f"conv_id {kind}, slot long, `order` long, edge boolean, first string, last string, illegal long, cost long, audit string, at array<int>, costs array<long>, audits array<string>"
    spans = pin(ordered.mapInArrow(_stretches, schema))

    done = spans.filter("not edge").select("conv_id", "illegal", "cost", "audit")
    edges = spans.filter("edge")
    while True:
        parts = -(-parts // FAN_IN)
        edges = edges.withColumn("slot", F.floor(F.col("slot") / FAN_IN)).groupBy("conv_id", "slot").applyInArrow(_join_stretches, schema)
        if parts <= 1:
            break
    return done.unionByName(edges.select("conv_id", "illegal", "cost", "audit"))


def _stretch(conv, slot: int, order: int, edge: bool, first: str, last: str, illegal: int, cells: Cells) -> dict:
    """A conversation's rows in one task (``edge``: it may go on in the next one, so its cells stay)."""
    cost, audit = best(cells)
    at = sorted(cells) if edge else []
    return {"conv_id": conv, "slot": slot, "order": order, "edge": edge, "first": first, "last": last, "illegal": illegal, "cost": cost, "audit": audit,
            "at": [4 * p + q for p, q in at], "costs": [cells[k][0] for k in at], "audits": [cells[k][1] for k in at]}


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's ordered rows to one row per conversation in it."""
    from pyspark import TaskContext
    slot, parser = TaskContext.get().partitionId(), Parser()
    conv = first = last = schema = None
    symbols, illegal, begun, at_start, out = [], 0, False, True, []

    def close(at_end: bool) -> dict:
        return _stretch(conv, slot, slot, at_start or at_end, first, last, illegal, parser.cells("".join(symbols)))

    for batch in batches:
        schema = schema or pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type), *SPAN_FIELDS])
        for c, n, initial, symbol in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "n", "initial", "symbol"))):
            if begun and c != conv:
                out.append(close(False))
                at_start, symbols, illegal, last = False, [], 0, None
            if last is None:
                conv, first, begun = c, initial, True
            else:
                illegal += illegal_pair(last, initial)
            symbols.append(symbol + "d" * (n - 1))
            illegal += n - 1                                     # copies side by side are never legal
            last = initial
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if begun:
        yield pa.RecordBatch.from_pylist([*out, close(True)], schema)


SPAN_FIELDS = [pa.field("slot", pa.int64()), pa.field("order", pa.int64()), pa.field("edge", pa.bool_()), pa.field("first", pa.string()), pa.field("last", pa.string()),
               pa.field("illegal", pa.int64()), pa.field("cost", pa.int64()), pa.field("audit", pa.string()),
               pa.field("at", pa.list_(pa.int32())), pa.field("costs", pa.list_(pa.int64())), pa.field("audits", pa.list_(pa.string()))]


def _join_stretches(table: pa.Table) -> pa.Table:
    """One conversation's stretches in neighbouring slots to one."""
    rows = table.to_pylist()
    if len(rows) > 1:
        rows.sort(key=lambda r: r["order"])
        spans = [{divmod(a, 4): (c, t) for a, c, t in zip(r["at"], r["costs"], r["audits"])} for r in rows]
        seams = sum(illegal_pair(a["last"], b["first"]) for a, b in zip(rows, rows[1:]))
        rows = [_stretch(rows[0]["conv_id"], rows[0]["slot"], rows[0]["order"], True, rows[0]["first"], rows[-1]["last"], sum(r["illegal"] for r in rows) + seams, join_all(spans))]
    return pa.Table.from_pylist(rows, table.schema)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations as their audit followed by their rows, to one row with the repaired rows' hash."""
    names = ["conv_id", *RESULT]
    repaired = None

    def close() -> dict:
        repaired.insertions()
        return repaired.result | {"repaired_sha256": repaired.sha.hexdigest()}

    for batch in batches:
        schema = pa.schema([*(batch.schema.field(x) for x in names), pa.field("repaired_sha256", pa.string())])
        out = []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if repaired:
                    out.append(close())
                repaired = _Repaired({x: row[x] for x in names})
            else:
                repaired.row(row["role"], row["text"])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if repaired:
        yield pa.RecordBatch.from_pylist([close()], schema)


class _Repaired:
    """A conversation rebuilt edit by edit; only the hash of it is held."""

    def __init__(self, result: dict):
        self.result, self.audit, self.at, self.state, self.sha = result, result["audit"], 0, START, hashlib.sha256()
        self.empty = True

    def add(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty, self.state = False, STEP[self.state, role[:1]]

    def wanted(self) -> str:
        return "assistant" if self.state == AFTER_U else "user"

    def insertions(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.add(self.wanted(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.insertions()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            self.add(role if edit == "K" else self.wanted(), text)


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation after the damage."""
    damaged = damage(conversations)
    with pins() as own:
        faults = pin(_faults(damaged))
        parsed = _parse(faults).select(F.col("conv_id").alias("c"), "illegal", "cost", "audit")
        found = own.keep(pin(_counts(faults).join(parsed, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
            "conv_id", *RESULT[:4], *(F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"))))
    void = [F.lit(None).cast(t).alias(c) for c, t in found.dtypes if c in RESULT]
    rows = damaged.filter("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("h"),
        F.explode(F.array_repeat("text", F.col("copies").cast("int"))).alias("text"), *void)
    head = found.select("conv_id", F.lit(0).alias("kind"), *(F.lit(None).cast(t).alias(c) for c, t in rows.dtypes[2:6]), *RESULT)
    order = ["conv_id", "kind", "turn", "role", "h"]
    kind = dict(found.dtypes)["conv_id"]
    schema = f"conv_id {kind}, " + ", ".join(f"{c} {t}" for c, t in found.dtypes if c in RESULT) + ", repaired_sha256 string"
    return head.unionByName(rows).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_replay, schema)


def crc32_sql(text: str) -> str:
    """DuckDB expression for crc32 of the ASCII ``text``, with the table ``crc(t)`` in scope."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint)"


CRC_TABLE = """crc as (select list_transform(range(256), lambda n: list_reduce(
    [n::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) t)"""


def oracle() -> str:
    """DuckDB SQL: the same repair as a shortest path over rows and pattern states."""
    def add(state: str, cost: str, edit: str) -> str:
        # a state is cost in nine digits, then the audit, then the repaired text
        return f"struct_pack(k := lpad((substr({state}.k, 1, 9)::int + {cost})::varchar, 9, '0') || substr({state}.k, 10) || '{edit}', r := {state}.r)"

    def put(state: str, cost: str, edit: str, role: str, text: str) -> str:
        line = f"{role} || ':' || {text}"
        return (f"case when {state} is not null then struct_pack(k := lpad((substr({state}.k, 1, 9)::int + {cost})::varchar, 9, '0') || substr({state}.k, 10) || '{edit}', "
                f"r := case when {state}.r is null then {line} else {state}.r || chr(10) || {line} end) end")

    def least(*options: str) -> str:
        return f"list_min(list_filter([{', '.join(options)}], lambda x: x is not null))"

    def drop(state: str) -> str:
        return f"case when {state} is not null then {add(state, '3', 'D')} end"

    def user(state: str) -> str:
        return put(state, "2", "I", "'user'", "''")

    def keep(state: str, initial: str) -> str:
        return f"case when not gone and initial = '{initial}' then {put(state, 'cut', 'K', 'role', 'text')} end"

    def rerole(state: str, role: str) -> str:
        return f"case when not gone then {put(state, '2 + cut', 'R', repr(role), 'text')} end"

    inserted = (f"select conv_id, k, s0 b0, s1 b1, {least('s2', user('s0'), user('s1'), user('s3'))} b2, "
                f"s0, s1, s2, s3 from path")
    space = "[^\\x20\\x09-\\x0D]"
    return f"""
with recursive {CRC_TABLE},
hit as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') as text,
    {crc32_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 d
  from conversations, crc),
damaged as (
  select conv_id, turn, case when d = 4 then 'user' else role end as role,
    case when d = 1 then '' when d = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from hit, (select unnest([1, 2]) i) where d <> 0 and (i = 1 or d = 3)),
ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) k from damaged),
placed as (
  select *, row_number() over (partition by conv_id, role, text order by k) copy, substr(role, 1, 1) initial,
    lag(substr(role, 1, 1)) over (partition by conv_id order by k) before, not regexp_matches(text, '{space}') is_blank
  from ordered),
judged as (
  select *, not is_blank and copy > 1 is_copy, is_blank or copy > 1 gone,
    case when not is_blank and copy = 1 and not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 1 else 0 end cut
  from placed),
path as (
  select distinct conv_id, 0::bigint k, struct_pack(k := '000000000', r := null::varchar) s0,
    null::struct(k varchar, r varchar) s1, null::struct(k varchar, r varchar) s2, null::struct(k varchar, r varchar) s3 from judged
  union all
  select j.conv_id, j.k, {drop('b0')}, {least(drop('b1'), keep('b0', 's'))},
    {least(drop('b2'), *(keep(b, 'u') for b in ('b0', 'b1', 'b3')), *(rerole(b, 'user') for b in ('b0', 'b1', 'b3')))},
    {least(drop('b3'), keep('b2', 'a'), rerole('b2', 'assistant'))}
  from (select *, {least('s3', put('b2', '2', 'I', "'assistant'", "''"))} b3 from ({inserted})) p
  join judged j on j.conv_id is not distinct from p.conv_id and j.k = p.k + 1),
last as (
  select conv_id, {least('s0', 's3', put('b2', '2', 'I', "'assistant'", "''"))} e
  from ({inserted}) p where k = (select max(k) from judged j where j.conv_id is not distinct from p.conv_id)),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint gaps, count(*) filter (is_blank)::bigint blank,
    count(*) filter (is_copy)::bigint duplicate, sum(cut)::bigint truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au'))::bigint illegal
  from judged group by conv_id)
select o.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
  coalesce(illegal, 0) illegal, coalesce(substr(e.k, 1, 9)::bigint, 0) as cost, coalesce(substr(e.k, 10), '') audit, sha256(coalesce(e.r, '')) repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id left join last l on l.conv_id is not distinct from o.conv_id
"""
