"""Repair of a conversation's structure at the least cost, by an auction for shortest paths.

A conversation's roles should read ``(s?(ua)+)?``.  Its rows, in order, and the four states of
that expression span a lattice: node (i, q) stands for i rows read and state q reached.  Arcs
are edits with integer costs: Keep 0, Rerole 3, Delete 4, Insert 3; a truncated row that stays
costs 3 more, a blank or duplicate row must go.

The auction keeps a price per node, never above the cost of any arc plus the price at its end.
From an origin a path grows: while the price of the path's last node equals the best offer (arc
cost plus price) of its arcs, the path is extended along that arc; otherwise the price rises to
the offer and the path contracts by a node.  It ends at a node whose price is final; then all
prices on the path are final.  Origins are taken from the last row to the first, so that a path
meets final prices after a few arcs, and only one row's prices are held.  Final prices are dual:
an arc is tight if its cost is the difference of its ends' prices.  The cheapest repairs are the
paths of tight arcs, and the least letter of a tight arc at each node traces the one whose edits
are least in ASCII order.

1. Rows are flagged in the JVM; blank, duplicate (window over role and digest) and truncated rows
   and the role's initial become one byte.  One shuffle by conversation, of rows without their
   texts, sorted; the auction streams over it and holds a byte for each row and state of one
   conversation.
2. A second shuffle by conversation brings the texts in the same order, with the audit in
   front; the repaired text is hashed as it streams by.  No task gathers a conversation's texts.

A conversation is in one task in both steps, since its lattice and its hash are sequences; what
the task holds for a row of the longest conversation is about ten bytes.

Results for odd input: null roles and texts count as one space (in the query); a null
conversation id is a conversation of its own; rows of the same turn are ordered by role and
digest of the text; repeated rows are duplicates; null turns come first; roles with another
initial are legal nowhere and are deleted or reroled; a conversation without rows gives zeros, an
empty audit and the hash of the empty string; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import query, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a.  The role that each one awaits, and where it leads.
AWAITS = b"uuau"
REACHES = (2, 2, 3, 2)
ENDS = (0, 3)
LEGAL = (b"su", b"ua", b"au")
SOUND, BLANK, DUPLICATE, CUT, ABSENT, END = range(6)
ROLES = {ord("u"): "user", ord("a"): "assistant"}


def _arcs(initial: int, fault: int, state: int) -> list[tuple[int, int, int, int]]:
    """(letter, cost, rows read, state reached) of the arcs of a row's node, least letter first."""
    found = [(68, DELETE, 1, state), (73, INSERT, 0, REACHES[state])]
    if fault in (BLANK, DUPLICATE):
        return found
    stays = TRUNCATED if fault == CUT else 0
    if initial == AWAITS[state]:
        found.append((75, KEEP + stays, 1, REACHES[state]))
    elif initial == 115 and state == 0:
        found.append((75, KEEP + stays, 1, 1))
    found.append((82, REROLE + stays, 1, REACHES[state]))
    return found


def _auction(arcs: list, below: tuple[int, ...]) -> list[int]:
    """Final prices of a row's four nodes, given the final prices ``below`` of the next row's.

    ``arcs[q]`` leads from node q to another node of the row (0 rows read) or to one of the next row.
    Every path goes on to the next row, so its least price is a lawful first price for all nodes.
    """
    price, final = [min(below)] * 4, [False] * 4
    for origin in range(4):
        path = [origin]
        while not final[path[-1]]:
            node = path[-1]
            offer, step, state = min((cost + (below[to] if read else price[to]), read, to) for _, cost, read, to in arcs[node])
            if price[node] < offer:
                price[node] = offer
                if node != origin:
                    path.pop()
            elif step:  # the next row's prices are final
                break
            else:
                path.append(state)
        for node in path:
            final[node] = True
    return price


@lru_cache(1 << 14)
def _row(initial: int, fault: int, below: tuple[int, ...]) -> tuple[tuple[int, ...], bytes]:
    """Prices of a row's nodes and the least letter of a tight arc of each; ``fault`` ``END`` is the end.

    What a row adds depends on the differences of ``below`` alone, so few rows differ.
    """
    arcs = [([(0, 0, 1, q)] if q in ENDS else []) + [(73, INSERT, 0, REACHES[q])] if fault == END else _arcs(initial, fault, q) for q in range(4)]
    price = _auction(arcs, below)
    tight = (next(x for x, cost, read, to in arcs[q] if cost + (below[to] if read else price[to]) == price[q]) for q in range(4))
    return tuple(price), bytes(tight)


def cheapest_edits(initials: bytes, faults: bytes) -> tuple[int, bytes]:
    """(cost, letters of the edits) of the cheapest repair; of equally cheap ones the least letters."""
    price, letters = _row(0, END, (0, 0, 0, 0))
    chosen, paid = bytearray(letters), 0
    for initial, fault in zip(reversed(initials), reversed(faults)):
        least = min(price)
        paid += least
        price, letters = _row(initial, fault, tuple(p - least for p in price))
        chosen += letters
    edits, state, row = bytearray(), 0, len(initials)
    while letter := chosen[4 * row + state]:
        edits.append(letter)
        if letter == 75 and initials[-row] == 115:
            state = 1
        elif letter != 68:
            state = REACHES[state]
        row -= letter != 73
    return paid + price[0], bytes(edits)


def flagged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, copy, absent) with ``digest`` and the fault of the text alone."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(F.col("absent"), ABSENT).when(blank, BLANK).when(~whole, CUT).otherwise(SOUND)
    return rows.withColumns({"digest": F.unhex(F.sha2("text", 256)), "fault": fault.cast("tinyint")})


def _sequence() -> list[Column]:
    """The order of rows: by conversation and turn; rows of a turn by role, digest and copy."""
    return [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("copy")]


MEASURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv``, ``MEASURES`` and ``audit``, from ``flagged`` rows."""
    same = Window.partitionBy("conv", "role", "digest", "absent").orderBy(*_sequence())
    coded = rows.select("conv", "turn", "role", "digest", "copy", "absent", "fault").repartition("conv")
    seen = F.row_number().over(same) > 1
    coded = coded.withColumn("fault", F.when(F.col("fault").isin(SOUND, CUT) & seen, DUPLICATE).otherwise(F.col("fault")).cast("tinyint"))
    coded = coded.sortWithinPartitions(*_sequence()).select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "fault")

    def measured(conv, turns, initials, faults):
        low, high, distinct, _ = turns
        cost, letters = cheapest_edits(initials, faults)
        pairs = sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))
        counts = [faults.count(k) for k in (BLANK, DUPLICATE, CUT)]
        return [conv, high - low + 1 - distinct if distinct else 0, *counts, pairs, cost, letters.decode()]

    names = ["conv", *MEASURES, "audit"]

    def run(batches):
        none = object()
        conv, turns, initials, faults = none, [0, 0, 0, none], bytearray(), bytearray()
        kind = None
        for batch in batches:
            done, kind = [], batch.schema.field(0).type
            for key, turn, initial, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if conv is none or key != conv:
                    if conv is not none:
                        done.append(measured(conv, turns, bytes(initials), bytes(faults)))
                    conv, turns, initials, faults = key, [0, 0, 0, none], bytearray(), bytearray()
                if fault == ABSENT:
                    continue
                if turn is not None and turn != turns[3]:
                    turns = [turn if turns[3] is none else turns[0], turn, turns[2] + 1, turn]
                initials.append(ord(initial) if initial in ("s", "u", "a") else 0)
                faults.append(fault)
            yield _batch(done, names, kind)
        if conv is not none:
            yield _batch([measured(conv, turns, bytes(initials), bytes(faults))], names, kind)

    kind = rows.schema["conv"].dataType.simpleString()
    return coded.mapInArrow(run, f"conv {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", audit string")


def _batch(done: list, names: list[str], kind) -> pa.RecordBatch:
    columns = list(zip(*done)) or [[]] * len(names)
    types = [kind] + [pa.int64()] * len(MEASURES) + [pa.string()] * (len(names) - 1 - len(MEASURES))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


class _Repair:
    """The repaired rows of one conversation, hashed while its rows stream by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.first, self.hash = audit, 0, 0, True, hashlib.sha256()

    def _emit(self, role: str, text: str) -> None:
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False

    def insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._emit(ROLES[AWAITS[self.state]], "")
            self.state, self.at = REACHES[self.state], self.at + 1

    def take(self, role: str, text: str) -> None:
        self.insert()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self._emit(role, text)
            self.state = 1 if role[:1] == "s" else REACHES[self.state]
        elif letter == "R":
            self._emit(ROLES[AWAITS[self.state]], text)
            self.state = REACHES[self.state]

    def digest(self) -> str:
        self.insert()
        return self.hash.hexdigest()


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (``audits``) with ``repaired_sha256`` of the repaired ``role:text`` rows."""
    names = ["conv", *MEASURES, "audit", "repaired_sha256"]
    whole = rows.where("NOT absent").select("conv", "turn", "role", "text", "digest", "copy", F.lit(True).alias("row"))
    heads = found.withColumn("row", F.lit(False))
    both = heads.unionByName(whole, allowMissingColumns=True).repartition("conv")
    both = both.sortWithinPartitions(F.col("conv"), F.col("row"), *_sequence()[1:])
    both = both.select("conv", *MEASURES, "audit", "row", "role", "text")

    def run(batches):
        head, repair, kind = None, None, None
        for batch in batches:
            done, kind = [], batch.schema.field(0).type
            values = [c.to_pylist() for c in batch.columns[:-2]]
            for i, row in enumerate(values[-1]):
                if row:
                    repair.take(batch.column(9)[i].as_py(), batch.column(10)[i].as_py())
                    continue
                if repair is not None:
                    done.append([*head, repair.digest()])
                head = [v[i] for v in values[:-1]]
                repair = _Repair(head[-1])
            yield _batch(done, names, kind)
        if repair is not None:
            yield _batch([[*head, repair.digest()]], names, kind)

    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", audit string, repaired_sha256 string"
    return both.mapInArrow(run, schema)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per ``conv`` of ``rows`` (conv, turn, role, text, copy, absent): measures, audit, digest.

    ``copy`` tells rows of the same turn, role and text apart; an ``absent`` row only names its conversation.
    """
    marked = flagged(rows)
    return repaired_digests(marked, audits(marked))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after damage by ``crc32('conv_id:turn') % 20``, as ``repair_conversations`` takes them."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key) % 20).alias("damage"),
    )
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("damage") == 3, 1).otherwise(0)))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"), (F.col("damage") == 0).alias("absent"))


_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT) AS bytes
  FROM conversations
), summed AS (
  SELECT keyed.*, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS damage
  FROM keyed, tab
), damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN damage = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM summed WHERE damage <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         left(role, 1) AS x
  FROM damaged
), rows_ AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
         lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM placed
), measured AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (previous || x NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows_
  FROM rows_ GROUP BY conv_id
), best(conv_id, i, c) AS (  -- per state: cost (9 digits), edits, and after a bar the repaired rows
  SELECT conv_id, 0::BIGINT, ['000000000|', NULL, '000000003I|' || chr(10) || 'user:', '000000006II|' || chr(10) || 'user:' || chr(10) || 'assistant:'] FROM measured
  UNION ALL
  SELECT conv_id, i, [a0, a1, least(a2, :i0, :i1, :i3), least(a3, :i2, :j0, :j1)]
  FROM (
    SELECT best.conv_id, r.i, c, :d1 AS a0,
           least(:d2, CASE WHEN f AND x = 's' THEN :k1 END) AS a1,
           least(:d3, CASE WHEN f AND x = 'u' THEN least(:k1, :k2, :k4) END, CASE WHEN f THEN least(:u1, :u2, :u4) END) AS a2,
           least(:d4, CASE WHEN f AND x = 'a' THEN :k3 END, CASE WHEN f THEN :a3 END) AS a3
    FROM best JOIN (SELECT *, fault IN ('', 't') AS f, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS t, chr(10) || role || ':' || text AS line,
                           chr(10) || 'user:' || text AS uline, chr(10) || 'assistant:' || text AS aline FROM rows_) r
      ON r.conv_id IS NOT DISTINCT FROM best.conv_id AND r.i = best.i + 1
  )
), ended AS (
  SELECT best.conv_id, least(c[1], c[4]) AS c FROM best JOIN measured ON measured.conv_id IS NOT DISTINCT FROM best.conv_id AND best.i = rows_
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(c, 9)::BIGINT, 0) AS cost,
       coalesce(substr(split_part(c, '|', 1), 10), '') AS audit,
       sha256(coalesce(substr(c, strpos(c, '|') + 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN measured ON measured.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _edited(state: str, cost: str, letter: str, rows: str) -> str:
    """SQL of a state's string after one more edit that emits ``rows``."""
    return (
        f"(lpad((left({state}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr(split_part({state}, '|', 1), 10) || '{letter}|'"
        f" || substr({state}, strpos({state}, '|') + 1) || {rows})"
    )


def _oracle() -> str:
    """``_SQL`` with the edits written out: D, K, R of the row at each state, I after it."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    edits = {"i2": _edited("a2", "3", "I", assistant)}
    for q in "013":
        edits[f"i{q}"] = _edited(f"a{q}", "3", "I", user)
    for q in "01":
        edits[f"j{q}"] = _edited(edits[f"i{q}"], "3", "I", assistant)
    for q in "1234":
        edits[f"d{q}"] = _edited(f"c[{q}]", "4", "D", "''")
        edits[f"k{q}"] = _edited(f"c[{q}]", "t", "K", "line")
        edits[f"u{q}"] = _edited(f"c[{q}]", "t + 3", "R", "uline")
        edits[f"a{q}"] = _edited(f"c[{q}]", "t + 3", "R", "aline")
    sql = _SQL
    for name, text in edits.items():
        sql = sql.replace(f":{name}", text)
    return sql


@query("op13_conversation_repair", _oracle())
def op13_conversation_repair(spark, sf_dir):
    found = repair_conversations(damaged(table(spark, sf_dir, "conversations")))
    return found.withColumnRenamed("conv", "conv_id")
