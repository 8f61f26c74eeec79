"""Conversation structure repair by iterative-deepening A*.

A conversation's rows, in the order of their turns, are edited until the
initials of the roles read ``(s?(ua)+)?``: Keep (0), Rerole to user or
assistant (1), Delete (2; required for blank and repeated rows), Insert an
empty row of the user or assistant (5); a truncated row that stays adds 5.
The state is the place and the last role kept, so the next role decides what a
reroled or inserted row becomes.  A depth-first search tries the edits in
ASCII order (D, I, K, R) under a cost bound that grows to the least cost that
exceeded it.  The bound counts what the rows ahead must cost at least (2 for
each faulty row); a table of failed states keeps the largest budget each one
has failed with, over all rounds.  The first accepting path is therefore the
cheapest, and among the cheapest the one whose initials are ASCII-least.

Rows reach the search as one letter each (role initial and fault), in pieces
of at most ``PIECE`` rows dealt by range, so that a conversation with a third
of all rows is split: its pieces are searched from every state to every state,
and their costs and audits are chained (two cheapest audits between the same
states are never prefixes of one another, so the least of the whole is made of
least pieces).  Only the audit letters of a conversation and the running hash
of its repaired text meet in one task, the text as a sorted stream.

Defined results: a null id, turn, role or text counts as one space in the
damage's key, and a null role or text is one space; rows of a null id are one
conversation; rows with the same turn are ordered by role, then by the hash of
role and text, copies side by side; a role's initial is its first character,
whatever follows, and an empty role has none; very long texts are read by
their owner's task only; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import SEPARATORS, batch, prepare, without_separators, written

#: Rows of one searched piece.
PIECE = 128
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Last role kept: none, system, user, assistant.
STATES = "-sua"
#: The role that may follow each state by rerole or insertion, as a state.
NEXT = (2, 2, 3, 2)
ACCEPTED = (0, 3)


def symbol(initial: str, fault: str) -> str:
    """One letter of a row: s, u, a or x (any other initial), capital where truncated, 1 to 4 where it must go."""
    letter = initial if initial in ("s", "u", "a") else "x"
    return letter.upper() if fault == "truncated" else str("suax".index(letter) + 1) if fault else letter


def search(row: str, entry: int, exits: tuple[int, ...], failed: dict[tuple[int, int], int] | None = None) -> tuple[int, str]:
    """The cheapest edits that lead from state ``entry`` through the rows to one of ``exits``, and their cost.

    ``failed`` may be shared by searches over the same rows to the same exits.
    """
    n, ahead = len(row), [0]
    for c in reversed(row):
        ahead.append(ahead[-1] + (0 if c in "suax" else DELETE))
    ahead.reverse()
    failed = {} if failed is None else failed
    bound = ahead[0]
    while True:
        above = None
        # a frame: place, state, cost so far, and the edits not tried yet (in reverse)
        stack, path = [], []

        def enter(at: int, state: int, cost: int) -> bool:
            nonlocal above
            least = cost + ahead[at]
            if least > bound:
                above = least if above is None else min(above, least)
                return False
            budget = bound - cost
            known = failed.get((at, state), -1)
            if known >= budget:
                above = cost + known + 1 if above is None else min(above, cost + known + 1)
                return False
            moves = [("I", at, NEXT[state], INSERT)]
            if at < n:
                c = row[at]
                moves.insert(0, ("D", at + 1, state, DELETE))
                if c.isalpha():
                    extra = TRUNCATED if c.isupper() else 0
                    role = "sua".find(c.lower()) + 1
                    if role == NEXT[state] or (role == 1 and state == 0):
                        moves.append(("K", at + 1, role, KEEP + extra))
                    moves.append(("R", at + 1, NEXT[state], REROLE + extra))
            moves.reverse()
            stack.append((at, state, cost, moves))
            return True

        enter(0, entry, 0)
        while stack:
            at, state, cost, moves = stack[-1]
            if at == n and state in exits:
                return cost, "".join(path)
            if moves:
                edit, to, then, price = moves.pop()
                path.append(edit)
                if not enter(to, then, cost + price):
                    path.pop()
            else:
                failed[at, state] = max(failed.get((at, state), -1), bound - cost)
                stack.pop()
                if path:
                    path.pop()
        bound = bound + 1 if above is None else max(above, bound + 1)


# ---- damage -----------------------------------------------------------------------------


def damage(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by crc32(id:turn) mod 20: 0 drops the row, 1 empties its
    text, 2 removes its end marks, 3 repeats it, 4 gives it to the user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    kind = F.crc32(F.concat(space(id_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    unmarked = F.translate(space(text_col), ".!?", "")
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(space(role_col)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, unmarked).otherwise(space(text_col)).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
    rows = rows.filter("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.drop("copies")


# ---- repair -----------------------------------------------------------------------------

_PIECE = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("row", pa.string())])
_FOUND = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("row", pa.string()), ("alone", pa.bool_()), ("entry", pa.int32()),
                    ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_AUDIT = pa.schema([("conv", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
_REPAIRED = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_HASH = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])


def _pieces(piece: int):
    """Rows (conv, symbol) in order -> pieces of at most ``piece`` rows of one conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, conv, held = TaskContext.get().partitionId() << 32, None, []
        for b in batches:
            out = []
            for c, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if held and (c != conv or len(held) == piece):
                    out.append((conv, place, "".join(held)))
                    place, held = place + 1, []
                conv = c
                held.append(s)
            if out:
                yield batch(_PIECE, [list(x) for x in zip(*out, strict=True)])
        if held:
            yield batch(_PIECE, [[conv], [place], ["".join(held)]])
    return run


def _search_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, place, row, alone): the whole way of a conversation in one piece, else every way through the piece."""
    for b in batches:
        out = []
        for conv, place, row, alone in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if alone:
                out.append((conv, place, row, True, 0, 0, *search(row, 0, ACCEPTED)))
                continue
            for leave in range(len(STATES)):
                failed: dict = {}
                # no way leads back to the start, and only Keep leads to the system's state
                for entry in range(len(STATES)):
                    if leave > 1 or entry == leave or (entry == 0 and leave == 1 and any(c in "sS" for c in row)):
                        out.append((conv, place, row, False, entry, leave, *search(row, entry, (leave,), failed)))
        if out:
            yield batch(_FOUND, [list(x) for x in zip(*out, strict=True)])


def _join_ways(ways: dict[int, tuple[int, str]], found: dict[tuple[int, int], tuple[int, str]]) -> dict[int, tuple[int, str]]:
    new: dict[int, tuple[int, str]] = {}
    for (entry, leave), (cost, audit) in found.items():
        if entry in ways:
            way = (ways[entry][0] + cost, ways[entry][1] + audit)
            new[leave] = min(new.get(leave, way), way)
    return new


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Searched pieces in order of (conv, place) -> one audit per conversation."""
    conv = place = None
    ways, found, alone, last, illegal = {}, {}, False, "", 0
    legal = {"su", "ua", "au"}

    def close() -> tuple:
        final = _join_ways(ways, found)
        if alone:
            return (conv, illegal, *found[0, 0])
        ends = dict(final)
        for leave, (cost, audit) in final.items():  # rows may be inserted after the last piece
            state = leave
            for more in (1, 2):
                state = NEXT[state]
                way = (cost + more * INSERT, audit + "I" * more)
                ends[state] = min(ends.get(state, way), way)
        return (conv, illegal, *min(ends[e] for e in ACCEPTED if e in ends))

    for b in batches:
        out = []
        for c, p, row, single, entry, leave, cost, audit in zip(*(x.to_pylist() for x in b.columns), strict=True):
            if c != conv or p != place:
                if conv is not None and c != conv:
                    out.append(close())
                if c != conv:
                    ways, last, illegal = {0: (0, "")}, "", 0
                else:
                    ways = _join_ways(ways, found)
                initials = last + "".join("suax"[int(x) - 1] if x.isdigit() else x.lower() for x in row)
                illegal += sum(initials[i:i + 2] not in legal for i in range(len(initials) - 1))
                conv, place, found, alone, last = c, p, {}, single, initials[-1]
            found[entry, leave] = (cost, audit)
        if out:
            yield batch(_AUDIT, [list(x) for x in zip(*out, strict=True)])
    if conv is not None:
        yield batch(_AUDIT, [[x] for x in close()])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple | None]:
    """(conv, head, audit, role, text) in order, the audit of a conversation before its rows -> the repaired
    (conv, role, text); (conv, None, None) opens a conversation, None ends a batch."""
    conv, edits, state, at = None, "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal state, at
        while at < len(edits) and edits[at] == "I":
            state, at = NEXT[state], at + 1
            yield conv, ("user", "assistant")[state - 2], ""

    for b in batches:
        for c, head, audit, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
            yield from inserted()
            if not head:
                conv, edits, state, at = c, audit, 0, 0
                yield conv, None, None
                continue
            edit, at = edits[at], at + 1
            if edit == "K":
                state = STATES.index(role[0])
                yield conv, role, text
            elif edit == "R":
                state = NEXT[state]
                yield conv, ("user", "assistant")[state - 2], text
        yield None
    yield from inserted()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, place = [], 0
    for row in _edited(batches):
        if row is None:
            if out:
                yield batch(_REPAIRED, [list(x) for x in zip(*out, strict=True)])
            out = []
        elif row[1] is None:
            place = 0
        else:
            out.append((row[0], place, *row[1:]))
            place += 1
    if out:
        yield batch(_REPAIRED, [list(x) for x in zip(*out, strict=True)])


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, running, first, out = None, None, True, []
    for row in _edited(batches):
        if row is None:
            if out:
                yield batch(_HASH, [list(x) for x in zip(*out, strict=True)])
            out = []
        elif row[1] is None:
            if running:
                out.append((conv, running.hexdigest()))
            conv, running, first = row[0], hashlib.sha256(), True
        else:
            running.update((("" if first else "\n") + f"{row[1]}:{row[2]}").encode())
            first = False
    if running:
        out.append((conv, running.hexdigest()))
        yield batch(_HASH, [list(x) for x in zip(*out, strict=True)])


def _key(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def _analysed(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, piece: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with text, marked rows without text, and one (illegal, cost, audit) per conversation."""
    prepare(rows.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    base = rows.select(_key(F.col(id_col)).alias("conv"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"),
                       space(text_col).alias("text"), F.monotonically_increasing_id().alias("copy"))
    bare = without_separators(F.col("text"))
    fault = F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    same = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    base = written(base.withColumn("same", F.unhex(F.sha2(same, 256))).withColumn("fault", fault), "repair-rows")
    # the first row of every (role, text) of a conversation; the others repeat it
    first = base.groupBy("conv", "same").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "copy"))["copy"].alias("first"))
    marked = base.select("conv", "turn", F.left("role", F.lit(1)).alias("initial"), "role", "same", "copy", "fault").join(first, ["conv", "same"])
    fault = F.when(F.col("fault") == "blank", "blank").when(F.col("copy") != F.col("first"), "duplicate").otherwise(F.col("fault"))
    marked = written(marked.select("conv", "turn", "role", "same", "copy", "initial", fault.alias("fault")), "repair-marked")

    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    letter = (F.when(F.col("fault") == "truncated", F.upper(letter))
              .when(F.col("fault").isNotNull(), F.translate(letter, "suax", "1234")).otherwise(letter))
    dealt = marked.select("conv", "turn", "role", "same", "copy", letter.alias("symbol"))
    dealt = dealt.repartitionByRange(*_order()).sortWithinPartitions(*_order()).select("conv", "symbol")
    pieces = written(dealt.mapInArrow(_pieces(piece), "conv string, place long, row string"), "repair-pieces")
    count = pieces.groupBy("conv").agg((F.count("*") == 1).alias("alone"))
    flagged = written(pieces.join(count, "conv").select("conv", "place", "row", "alone"), "repair-flagged")
    found = flagged.mapInArrow(
        _search_pieces, "conv string, place long, row string, alone boolean, entry int, exit int, cost long, audit string")
    found = found.repartition("conv").sortWithinPartitions("conv", "place")
    audits = found.mapInArrow(_chain, "conv string, illegal long, cost long, audit string")
    return base, marked, written(audits, "repair-audits")


def _order() -> list:
    return ["conv", F.col("turn").asc_nulls_first(), "role", "same", "copy"]


def _stream(base: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, side by side in one task."""
    heads = audits.select("conv", F.lit(0).alias("head"), "audit", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit("").alias("text"), F.lit(None).cast("binary").alias("same"), F.lit(0).cast("long").alias("copy"))
    texts = base.select("conv", F.lit(1).alias("head"), F.lit("").alias("audit"), "turn", "role", "text", "same", "copy")
    stream = heads.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "head", *_order()[1:])
    return stream.select("conv", "head", "audit", "role", "text")


def _ids(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(F.col(id_col).alias("conv_id")).distinct().withColumn("conv", _key(F.col("conv_id")))


def repaired(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             piece: int = PIECE) -> DataFrame:
    """The repaired conversations as rows: ``conv_id, place (from 0), role, text``."""
    base, _, audits = _analysed(rows, id_col, turn_col, role_col, text_col, piece)
    out = _stream(base, audits).mapInArrow(_rows, "conv string, place long, role string, text string")
    return _ids(rows, id_col).join(out, "conv").select("conv_id", "place", "role", "text")


def repair(rows: DataFrame, all_ids: DataFrame | None = None, id_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``all_ids``: rows whose ids must all be returned, with zeros where ``rows`` has none of them (default: ``rows``).
    """
    base, marked, audits = _analysed(rows, id_col, turn_col, role_col, text_col, piece)
    hashes = _stream(base, audits).mapInArrow(_hash, "conv string, repaired_sha256 string")
    # turns first, so that a long conversation is counted in parts
    turns = marked.groupBy("conv", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    counts = turns.groupBy("conv").agg(
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    out = _ids(rows if all_ids is None else all_ids, id_col)
    out = out.join(counts, "conv", "left").join(audits, "conv", "left").join(hashes, "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)  # noqa: E731
    return out.select("conv_id", zero("gaps"), zero("blank"), zero("duplicate"), zero("truncated"), zero("illegal"), zero("cost"),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: Damage and repair by dynamic programming over (rows read, last role), the repaired rows carried along.
ORACLE_SQL = r"""
with recursive
poly(n, k, v) as (
  select range, 0, range from range(256)
  union all
  select n, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from poly where k < 8),
crc as (select list(v order by n) as t from poly where k = 8),
raw as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k
  from conversations),
kind as (
  select conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: cast(ascii(x) as bigint))),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as d
  from raw, crc),
rows0 as (
  select conv_id, turn, case when d = 4 then 'user' else role end as role,
         case when d = 1 then '' when d = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, copy
  from kind, range(2) as copies(copy) where d <> 0 and (copy = 0 or d = 3)),
numbered as (
  select *, row_number() over w as i, left(role, 1) as f,
         not regexp_matches(text, '[^ 	-]') as blank,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
         regexp_extract(text, '([^ 	-])[ 	-]*$', 1) not in ('.', '!', '?') as cut,
         lag(left(role, 1)) over w as before
  from rows0 window w as (partition by conv_id order by turn nulls first, role, text, copy)),
r as (select *, blank or again as must, case when cut and not blank and not again then 5 else 0 end as extra from numbered),
ins(st, st2, cost, edits, body) as (values
  ('-', '-', 0, '', []::varchar[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
  ('-', 'u', 5, 'I', ['user:']), ('s', 'u', 5, 'I', ['user:']), ('u', 'a', 5, 'I', ['assistant:']), ('a', 'u', 5, 'I', ['user:']),
  ('-', 'a', 10, 'II', ['user:', 'assistant:']), ('s', 'a', 10, 'II', ['user:', 'assistant:']),
  ('u', 'u', 10, 'II', ['assistant:', 'user:']), ('a', 'a', 10, 'II', ['user:', 'assistant:'])),
edit(e) as (values ('D'), ('K'), ('R')),
ways(conv_id, i, st, w) as (
  select distinct conv_id, cast(0 as bigint), '-', {'c': 0, 'e': '', 'b': []::varchar[]} from conversations
  union all
  select conv_id, i, st, min(w) from (
    select r.conv_id, r.i, case e when 'D' then ins.st2 when 'K' then r.f else case when ins.st2 = 'u' then 'a' else 'u' end end as st,
           {'c': ways.w.c + ins.cost + case e when 'D' then 2 when 'K' then r.extra else 1 + r.extra end,
            'e': ways.w.e || ins.edits || e,
            'b': list_concat(ways.w.b, ins.body, case e when 'D' then [] when 'K' then [r.role || ':' || r.text]
                 else [case when ins.st2 = 'u' then 'assistant:' else 'user:' end || r.text] end)} as w
    from ways join r on r.conv_id is not distinct from ways.conv_id and r.i = ways.i + 1 join ins on ins.st = ways.st, edit
    where e = 'D' or (not r.must and (e = 'R' or r.f = case when ins.st2 = 'u' then 'a' else 'u' end or (r.f = 's' and ins.st2 = '-')))
  ) group by conv_id, i, st),
ends as (
  select ways.conv_id, min({'c': w.c + ins.cost, 'e': w.e || ins.edits, 'b': list_concat(w.b, ins.body)}) as w
  from ways join ins on ins.st = ways.st and ins.st2 in ('-', 'a')
  where ways.i = coalesce((select max(i) from r where r.conv_id is not distinct from ways.conv_id), 0)
  group by ways.conv_id),
counts as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (where blank) as blank,
         count(*) filter (where again and not blank) as duplicate, count(*) filter (where extra > 0) as truncated,
         count(*) filter (where before is not null and before || f not in ('su', 'ua', 'au')) as illegal
  from r group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(w.c as bigint) as cost, w.e as audit,
       sha256(array_to_string(w.b, chr(10))) as repaired_sha256
from ends e left join counts c on c.conv_id is not distinct from e.conv_id
"""
