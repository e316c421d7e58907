"""Repair of conversations by error-correcting Earley parsing of their roles.

A conversation's roles should read as an optional system row and then user and assistant in turn. Its rows are the tokens; the grammar has rules that delete a row, read it as another role
or insert an empty one, each at a cost. Chart items keep the least (cost, audit), and the completed chart's audit is the repair.

The grammar recurs to the left, so an item of the chart begins at the start or at the last row, and a position is forgotten once the next is done. Rows of a conversation are shuffled
to one task, sorted, and pass it as a stream: what is held is the open part of the audit and its rows, however long the conversation is. A digest of a whole conversation is one
stream in any case, which no salt can split.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, partitions, prepare
from .earley import Chart, Grammar, Rule

#: What edits cost: another role, a deletion, an insertion, and a row that stays although it ends in the middle.
REROLE, DELETE, INSERT, TRUNCATED_STAYS = 3, 4, 3, 3
#: Rows of a conversation up to which its repair is looked up by roles and faults, and repairs that a task remembers; rows between which a longer one hands out what is settled.
SHORT, REMEMBERED, SETTLE = 64, 1 << 15, 32
#: From any state of the grammar another does as well for at most 7 more (to go on after an insertion costs 3, to delete a system row 4, to insert a turn 6). What
#: begins with the first row is counted without an insertion before it, hence 3 more.
SLACK = 10

GRAMMAR = Grammar(
    "Start",
    (
        Rule("Start", ("Pre",)), Rule("Start", ("Turns",)),
        Rule("Pre", ()), Rule("Pre", ("Pre", "delete")),
        Rule("Lead", ("Pre",)), Rule("Lead", ("Led",)),
        Rule("Led", ("Pre", "system")), Rule("Led", ("Led", "delete")),
        Rule("Half", ("Lead", "User")), Rule("Half", ("Turns", "User")), Rule("Half", ("Half", "delete")),
        Rule("Turns", ("Half", "Assistant")), Rule("Turns", ("Turns", "delete")),
        Rule("User", ("user",)), Rule("User", ("as user",)), Rule("User", (), INSERT, "I"),
        Rule("Assistant", ("assistant",)), Rule("Assistant", ("as assistant",)), Rule("Assistant", (), INSERT, "I"),
    ),
)

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)


def match(terminal: str, token: tuple[str, int]) -> tuple[int, str, str] | None:
    """What taking a row (its role's initial, its fault) as a terminal costs, with the edit and the role that it gives."""
    initial, fault = token
    if terminal == "delete":
        return DELETE, "D", ""
    if fault in (BLANK, DUPLICATE):
        return None
    stays = TRUNCATED_STAYS if fault == TRUNCATED else 0
    if terminal.startswith("as "):
        return REROLE + stays, "R", terminal[3:]
    return (stays, "K", "") if initial == terminal[0] else None


@lru_cache(REMEMBERED)
def cheapest(rows: tuple[tuple[str, int], ...]) -> tuple[int, tuple[tuple[str, str], ...]]:
    """Cost and edits (letter and role) that repair rows of (initial, fault)."""
    chart = Chart(GRAMMAR, match, SLACK)
    for row in rows:
        chart.push(row)
    cost, audit = chart.finish()
    return cost, tuple((a.letter, a.tag.lower()) for a in audit)


class _Conversation:
    """A conversation's rows as they pass. out: whether repaired rows are wanted."""

    def __init__(self, conv_id: str | None, out: bool) -> None:
        self.conv_id, self.out, self.n, self.faults, self.illegal, self.initial = conv_id, out, 0, [0] * 4, 0, None
        self.turns, self.low, self.high, self.chart = 0, None, None, None
        self.tokens, self.waiting, self.sha, self.audit, self.lines, self.repaired = [], deque(), hashlib.sha256(), [], 0, []

    def take(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.n += 1
        self.faults[fault] += 1
        if self.n > 1 and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.high:
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        self.waiting.append((turn, role, text))
        if self.chart is None:
            self.tokens.append((initial, fault))
            if self.n <= SHORT:
                return
            self.chart = Chart(GRAMMAR, match, SLACK)
            for token in self.tokens:
                self.chart.push(token)
        else:
            self.chart.push((initial, fault))
            if self.n % SETTLE == 0:
                self._edit((a.letter, a.tag.lower()) for a in self.chart.settled())

    def _edit(self, edits: Iterator[tuple[str, str]]) -> None:
        for letter, role in edits:
            self.audit.append(letter)
            turn, was, text = self.waiting.popleft() if letter != "I" else (None, "", "")
            if letter != "D":
                now = role or was
                self.sha.update(f"{chr(10) if self.lines else ''}{now}:{text}".encode())
                self.lines += 1
                if self.out:
                    self.repaired.append((self.conv_id, self.lines, turn, now, text, letter))

    def rows(self) -> list[tuple]:
        """Repaired rows that were not handed out."""
        some, self.repaired = self.repaired, []
        return some

    def done(self) -> tuple:
        if self.chart is None:
            cost, edits = cheapest(tuple(self.tokens))
        else:
            cost, rest = self.chart.finish()
            edits = [(a.letter, a.tag.lower()) for a in rest]
        self._edit(iter(edits))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *self.faults[1:], self.illegal, cost, "".join(self.audit), self.sha.hexdigest()


_REPORT = pa.schema([("conv_id", pa.string()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
_ROWS = pa.schema([("conv_id", pa.string()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def _parsed(out: bool):  # noqa: ANN202
    """Rows conv_id, turn, role, text, fault, gone, sorted by conversation and turn, to a report each, or to repaired rows."""
    schema = _ROWS if out else _REPORT

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found = None, []

        def finished() -> Iterator[tuple]:
            if current:
                report = current.done()
                yield from current.rows() if out else [report]

        for rows in batches:
            for conv_id, turn, role, text, fault, gone in zip(*(rows.column(i).to_pylist() for i in range(6)), strict=True):
                if current is None or conv_id != current.conv_id:
                    found.extend(finished())
                    current = _Conversation(conv_id, out)
                if not gone:
                    current.take(turn, role, text, fault)
            if out and current:
                found.extend(current.rows())
            for some in itertools.batched(found, 5000):
                yield batch(list(some))
            found = []
        found.extend(finished())
        for some in itertools.batched(found, 5000):
            yield batch(list(some))

    return run


_BLANKS = r"\x20\x09-\x0D"


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text, copy and gone with their first fault, each conversation in one partition and in order: one shuffle."""
    spark = prepare(rows.sparkSession)
    dealt = rows.withColumn("digest", F.sha2("text", 256)).repartition(partitions(spark), "conv_id")
    dealt = dealt.withColumn("nth", F.expr("row_number() over (partition by conv_id, gone, role, digest order by turn, copy)"))
    fault = F.when(~F.col("text").rlike(f"[^{_BLANKS}]"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(~F.col("text").rlike(rf"[.!?][{_BLANKS}]*\z"), TRUNCATED).otherwise(FINE)
    # equal rows of a turn come in the order that they are counted in, so the first is never the duplicate
    marked = dealt.withColumn("fault", fault).sortWithinPartitions("conv_id", "turn", "role", "text", "nth")
    return marked.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "role", "text", "fault", "gone")


def _plain(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text, F.lit(0).alias("copy"), F.lit(False).alias("gone"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults, dealt by the CRC-32 of conv_id:turn modulo 20: 0 is marked gone, 1 loses its text, 2 its .!?, 3 comes twice, 4 becomes the user's. Nulls are one space."""
    rows = _plain(conversations)
    space = F.lit(" ")
    code = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(code == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (code == 0).alias("gone"), copies.alias("copy"))


def _report(rows: DataFrame) -> DataFrame:
    schema = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _ordered(rows).mapInArrow(frugal(_parsed(False)), schema).withColumn("conv_id", F.col("conv_id").cast("long"))


def report(conversations: DataFrame) -> DataFrame:
    """A row for each conv_id: gaps between its turns, rows by first fault, adjacent roles that do not fit, the cost and the letters of its cheapest repair, and its repaired rows' digest.

    conversations: conv_id, turn, role, text; other columns, whatever their names, are allowed and not kept. Rows are taken by turn, nulls first, those of one turn by
    role and text. Null roles and texts are one space; a null conv_id is a conversation of its own. A role counts by its first letter. A row that repeats an earlier one in role and
    text is a duplicate, also if that one is deleted. Conversations and texts of any length pass as they are; an empty table gives no rows.
    """
    return _report(_plain(conversations))


def damaged_report(conversations: DataFrame) -> DataFrame:
    """report() of the rows that damage() leaves. A conversation that it leaves no row has zeros, no audit and the digest of nothing."""
    return _report(damage(conversations))


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (from 1), turn, role, text, and edit: K for a row that stayed, R for one of another role, I for one that was put in. Otherwise as report()."""
    rows = _ordered(_plain(conversations)).mapInArrow(frugal(_parsed(True)), "conv_id string, place long, turn long, role string, text string, edit string")
    return rows.withColumn("conv_id", F.col("conv_id").cast("long"))


ORACLE_SQL = r"""
with recursive crc as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as crcs),
plain as (
  select row_number() over () as rid, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
coded as (
  select *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(k) + 1), lambda i: ord(k[i])::bigint)),
    lambda c, x: xor(c // 256, crcs[xor(c % 256, x) + 1])), 4294967295) % 20 as code from plain, crc),
damaged as (
  select rid, conv_id, turn, case when code = 4 then 'user' else role end as role,
    case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case code when 0 then [] when 3 then [0, 1] else [0] end) as copy
  from coded),
convs as (select conv_id, dense_rank() over (order by conv_id nulls last) as conv from (select distinct conv_id from conversations)),
placed as (
  select conv, turn, role, text, row_number() over (partition by conv order by turn nulls first, role, text, copy) as pos,
    row_number() over (partition by conv, role, text order by turn nulls first, copy) as seen
  from damaged d join convs c on d.conv_id is not distinct from c.conv_id),
tokens as (
  select *, left(role, 1) as initial, lead(left(role, 1)) over (partition by conv order by pos) as next_initial,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1 when seen > 1 then 2 when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 3 else 0 end as fault
  from placed),
sums as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate,
    count(*) filter (fault = 3) as truncated, count(*) filter (next_initial is not null and initial || next_initial not in ('su', 'ua', 'au')) as illegal, max(pos) as rows
  from tokens group by conv),
inserts(st, letters, to_st) as (
  values ('p', '', 'p'), ('s', '', 's'), ('h', '', 'h'), ('t', '', 't'), ('p', 'I', 'h'), ('s', 'I', 'h'), ('t', 'I', 'h'), ('h', 'I', 't'), ('p', 'II', 't'), ('s', 'II', 't')),
moves(st, letter, initial, to_st, price) as (
  values ('p', 'K', 's', 's', 0), ('p', 'K', 'u', 'h', 0), ('s', 'K', 'u', 'h', 0), ('t', 'K', 'u', 'h', 0), ('h', 'K', 'a', 't', 0), ('p', 'R', null, 'h', 3), ('s', 'R', null, 'h', 3), ('t', 'R', null, 'h', 3),
    ('h', 'R', null, 't', 3), ('p', 'D', null, 'p', 4), ('s', 'D', null, 's', 4), ('h', 'D', null, 'h', 4), ('t', 'D', null, 't', 4)),
steps as (
  select conv, 0::bigint as pos, to_st as st, {'cost': 3 * length(letters), 'audit': letters} as best from convs, inserts where st = 'p'
  union all
  select d.conv, t.pos, i.to_st, min({'cost': d.best.cost + m.price + case when t.fault = 3 and m.letter <> 'D' then 3 else 0 end + 3 * length(i.letters), 'audit': d.best.audit || m.letter || i.letters})
  from steps d join tokens t on t.conv = d.conv and t.pos = d.pos + 1
    join moves m on m.st = d.st and (m.initial is null or m.initial = t.initial) and (m.letter = 'D' or t.fault not in (1, 2))
    join inserts i on i.st = m.to_st
  group by d.conv, t.pos, i.to_st),
repairs as (
  select c.conv, min(best) as best from convs c left join sums u using (conv) join steps d on d.conv = c.conv and d.pos = coalesce(u.rows, 0) and d.st in ('p', 't') group by c.conv),
edits as (
  select conv, i, best.audit[i] as letter, length(replace(best.audit[1:i], 'I', '')) as pos, length(replace(best.audit[1:i], 'D', '')) as place
  from (select conv, best, unnest(range(1, length(best.audit) + 1)) as i from repairs)),
kept as (
  select e.*, t.role, t.text, max(case when e.place = 1 and e.letter = 'K' and t.initial = 's' then 1 else 0 end) over (partition by e.conv) as led
  from edits e left join tokens t on t.conv = e.conv and t.pos = e.pos and e.letter <> 'I' where e.letter <> 'D'),
lines as (
  select conv, string_agg(case when letter = 'K' then role when (place - led) % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''), chr(10) order by place) as body
  from kept group by conv)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, best.cost::bigint as cost, best.audit as audit, sha256(coalesce(body, '')) as repaired_sha256
from convs c left join sums using (conv) left join repairs using (conv) left join lines using (conv)
"""
