"""Generalised LR repair of conversations: the cheapest edits that give the role grammar ``(s?(ua)+)?``.

The grammar over role initials is ``Talk -> empty | Body``, ``Body -> u a | s u a | Body u a``. Its LR automaton is a
table of shifts and reductions below. A graph-structured stack holds all parses at once: after each row there is at most
one node for each stack top, with an edge to the node of the row before from which it was reached. For every row a parse
may delete it, keep it or give it another role, after inserting up to two empty turns; parses that meet in an equal
stack top merge, and the least (cost, audit) stays. All audits after the same row hold the same number of row edits and
end in one, so none begins another, and their order is settled by the older node's rank, then by the newest edits: no
audit is ever compared or copied as a whole. What a row does to the stack depends only on the row's kind and the tops'
relative costs and ranks, so each such step is computed once and then looked up.

Large conversations are split. Rows are range-partitioned by conversation, turn and a digest (a conversation with a third of all
rows is many partitions). Every task parses the pieces it holds; the first conversation of a task may have begun in an
earlier one, so that piece is parsed from each possible stack top. Pieces are small (counts, costs, compressed audits) and chain
up in order, as parses from equal tops do. At last the texts stream by, in order, through one incremental hash for each
conversation: SHA-256 of a repaired conversation is sequential by definition, so this last pass alone is one task for
each conversation, which holds the hash's state, the audit and one batch.

Faults of a row (the first counts): blank, duplicate (role and text seen earlier in the conversation; found by an
aggregate of the least place for each digest, so repeated texts meet map-side), truncated. Keep costs 0, a new role 3,
delete 4 (required for blank and duplicate rows), insert 3; a truncated row that stays adds 3.

Defined results: a null role or text is one space; a null turn comes first; rows of one turn are ordered by role and the
text's SHA-256, so repeated rows are adjacent; rows with a null conversation id are one conversation; a conversation
without rows (named by ``all_ids``) gives zeros, an empty audit and the hash of nothing; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved
from .places import ordered

RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Faults of a row.
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: White space that makes no text.
_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}

# --- the LR automaton ------------------------------------------------------------------------

#: What a symbol does to a stack top: shift to a state, or (negative) complete a production of so many symbols.
ACTIONS: dict[int, dict[str, int]] = {
    0: {"s": 1, "u": 2},   # nothing read
    1: {"u": 3},           # s
    2: {"a": -2},          # u
    3: {"a": -3},          # s u
    4: {"u": 5},           # Body
    5: {"a": -3},          # Body u
}
#: The node below each top, and where a completed Body goes.
BELOW = {1: 0, 2: 0, 3: 1, 4: 0, 5: 4}
GOTO = {0: 4}
ACCEPT = {0, 4}


def push(top: int, symbol: str) -> int | None:
    """The stack top after ``symbol``, reductions done; None where the grammar has no such symbol there."""
    action = ACTIONS[top].get(symbol)
    if action is None or action > 0:
        return action
    for _ in range(-action - 1):
        top = BELOW[top]
    return GOTO[top]


def wanted(top: int) -> str:
    """The one role, u or a, that can be inserted on this top."""
    return "u" if "u" in ACTIONS[top] else "a"


def inserted(top: int) -> list[tuple[int, str, int]]:
    """(top, edits, cost) after none, one or two inserted turns."""
    out = [(top, "", 0)]
    for _ in range(2):
        at, edits, cost = out[-1]
        out.append((push(at, wanted(at)), edits + "I", cost + INSERT))
    return out


#: The parses after a row in order of their audits: (top, cost above the cheapest).
Tops = tuple[tuple[int, int], ...]
_STEPS: dict[tuple[Tops, str, int], tuple[Tops, int, tuple[tuple[int, str], ...]]] = {}


def step(tops: Tops, initial: str, fault: int) -> tuple[Tops, int, tuple[tuple[int, str], ...]]:
    """The next parses, what the cheapest of them costs more, and for each the older parse's index and the edits."""
    key = tops, initial, fault
    if key in _STEPS:
        return _STEPS[key]
    best: dict[int, tuple[int, int, str]] = {}

    def offer(top: int | None, cost: int, rank: int, edits: str) -> None:
        if top is not None and (top not in best or (cost, rank, edits) < best[top]):
            best[top] = cost, rank, edits

    for rank, (old, so_far) in enumerate(tops):
        for top, edits, price in inserted(old):
            offer(top, so_far + price + DELETE, rank, edits + "D")
            if fault not in (BLANK, DUPLICATE):
                cost = so_far + price + (TRUNCATED if fault == CUT else 0)
                offer(push(top, initial), cost, rank, edits + "K")
                offer(push(top, wanted(top)), cost + RENAME, rank, edits + "R")
    least = min(cost for cost, _, _ in best.values())
    order = sorted(best.items(), key=lambda e: e[1][1:])
    _STEPS[key] = (tuple((top, cost - least) for top, (cost, _, _) in order), least,
                   tuple((rank, edits) for _, (_, rank, edits) in order))
    return _STEPS[key]


def parse(initials: list[str], faults: list[int], start: int) -> list[tuple[int, int, str]]:
    """(top, cost, audit) of the best parse to each top from ``start``, in order of their audits."""
    tops: Tops = ((start, 0),)
    cost, edges = 0, []
    for initial, fault in zip(initials, faults):
        tops, more, back = step(tops, initial if initial in "sua" else "", fault)
        cost += more
        edges.append(back)
    out = []
    for k, (top, above) in enumerate(tops):
        edits = []
        for back in reversed(edges):
            k, done = back[k]
            edits.append(done)
        out.append((top, cost + above, "".join(reversed(edits))))
    return out


def chain(pieces: list[list[dict]]) -> tuple[int, list[dict], str]:
    """The cheapest parse through all pieces of a conversation: its cost, the way taken in each, and final inserts."""
    tops: list[tuple[int, int]] = [(0, 0)]
    links: list[list[tuple[int, dict]]] = []
    for ways in pieces:
        best: dict[int, tuple[int, int, int, dict]] = {}
        for rank, (top, cost) in enumerate(tops):
            for place, way in enumerate(w for w in ways if w["start"] == top):
                offer = cost + way["cost"], rank, place
                if way["stop"] not in best or offer < best[way["stop"]][:3]:
                    best[way["stop"]] = *offer, way
        order = sorted(best.items(), key=lambda e: e[1][1:3])
        tops = [(top, e[0]) for top, e in order]
        links.append([(e[1], e[3]) for _, e in order])
    ends = []
    for rank, (top, cost) in enumerate(tops):
        at, edits, price = next(x for x in inserted(top) if x[0] in ACCEPT)
        ends.append((cost + price, rank, edits))
    cost, k, last = min(ends)
    taken = []
    for link in reversed(links):
        k, way = link[k]
        taken.append(way)
    return cost, taken[::-1], last


# --- streams ---------------------------------------------------------------------------------

_PIECE = ("rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
          "low long, high long, turns long, ways array<struct<start int, stop int, cost long, audit binary>>")
_PLACE = ("turn", "role", "tie", "uid")


def _records(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from batch.slice(at, rows).to_pylist()


def _piece(rows: list[tuple], whole: bool) -> dict:
    """What a run of consecutive rows (turn, initial, fault) of one conversation does to the stack."""
    turns, initials, faults = map(list, zip(*rows))
    known = [t for t in turns if t is not None]
    ways = [{"start": s, "stop": top, "cost": cost, "audit": zlib.compress(audit.encode(), 1)}
            for s in ((0,) if whole else ACTIONS) for top, cost, audit in parse(initials, faults, s)]
    return {"rows": len(rows), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(CUT), "first": initials[0], "last": initials[-1],
            "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
            "low": known[0] if known else None, "high": known[-1] if known else None, "turns": len(set(known)),
            "ways": ways}


def _pieces(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        head, rows, first = None, [], True
        for r in _records(batches):
            if head is not None and r["conv_id"] != head["conv_id"]:
                out.append({**{k: head[k] for k in ("conv_id", *_PLACE)}, "piece": _piece(rows, not first)})
                head, rows, first = None, [], False
                if len(out) == 1024:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            head = head or r
            rows.append((r["turn"], r["initial"], r["fault"]))
        if head is not None:
            out.append({**{k: head[k] for k in ("conv_id", *_PLACE)}, "piece": _piece(rows, not first)})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


class _Repaired:
    """One conversation: its pieces, then its texts, pass by."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.pieces = conv_id, []
        self.cost = self.at = self.top = 0
        self.audit: str | None = None
        self.hash, self.lines = hashlib.sha256(), 0

    def solve(self) -> None:
        self.cost, taken, last = chain([p["ways"] for p in self.pieces])
        self.audit = "".join(zlib.decompress(w["audit"]).decode() for w in taken) + last
        for p in self.pieces:
            p["ways"] = None

    def line(self, symbol: str, role: str, text: str) -> None:
        self.top = push(self.top, symbol)
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            symbol = wanted(self.top)
            self.line(symbol, {"u": "user", "a": "assistant"}[symbol], "")
            self.at += 1

    def text(self, role: str, text: str) -> None:
        if self.audit is None:
            self.solve()
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.line(role[0], role, text)
        elif edit == "R":
            symbol = wanted(self.top)
            self.line(symbol, {"u": "user", "a": "assistant"}[symbol], text)

    def result(self) -> dict:
        if self.audit is None:
            self.solve()
        self.inserts()
        total = {k: sum(p[k] for p in self.pieces) for k in ("blank", "duplicate", "truncated", "illegal")}
        known = [p for p in self.pieces if p["low"] is not None]
        distinct = sum(p["turns"] for p in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
        total["illegal"] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(self.pieces, self.pieces[1:]))
        gaps = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
        return {"conv_id": self.conv_id, "gaps": gaps, **total, "cost": self.cost, "audit": self.audit,
                "repaired_sha256": self.hash.hexdigest()}


def _finish(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        now: _Repaired | None = None
        for r in _records(batches, 256):
            if now is None or r["conv_id"] != now.conv_id:
                if now is not None:
                    out.append(now.result())
                now = _Repaired(r["conv_id"])
                if len(out) == 1024:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if r["piece"] is not None:
                now.pieces.append(r["piece"])
            elif r["text"] is not None:
                now.text(r["role"], r["text"])
        if now is not None:
            out.append(now.result())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


# --- Spark -----------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 sets its role to user.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    hit = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(plain("role")).alias("role"),
                      text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return hit.select("conv_id", "turn", "role", "text",
                      F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
                      .alias("copy")).drop("copy")


def _fault(first: Column) -> Column:
    return (F.when(F.col("solid") == "", BLANK).when(first.isNull(), DUPLICATE)
            .when(~F.substring("solid", -1, 1).isin(".", "!", "?"), CUT).otherwise(SOUND))


def repair(rows: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every conversation.

    ``all_ids`` (conv_id) names conversations that may have no rows left.
    """
    key = rows.schema["conv_id"].dataType
    text = F.coalesce(F.col("text"), F.lit(" "))
    turns = saved(rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.sha2(text.cast("binary"), 256).alias("tie"), F.monotonically_increasing_id().alias("uid"), text.alias("text")),
        "repair-turns")
    marks = turns.select("conv_id", *_PLACE, F.substring("role", 1, 1).alias("initial"),
                         F.rtrim("text", F.lit(_SPACE)).alias("solid"))
    firsts = marks.groupBy("conv_id", "role", "tie").agg(F.min(F.struct("turn", "uid")).alias("least")).select(
        F.col("least.uid").alias("uid"), F.lit(1).alias("first"))
    marked = marks.withColumn("solid", F.substring("solid", -1, 1)).join(firsts, "uid", "left").select(
        "conv_id", *_PLACE, "initial", _fault(F.col("first")).alias("fault"))

    piece_type = T.StructType.fromDDL(_PIECE)
    found = T.StructType([*turns.select("conv_id", *_PLACE).schema.fields, T.StructField("piece", piece_type)])
    pieces = saved(ordered(marked, ["conv_id", *_PLACE]).mapInArrow(_pieces(_arrow(found)), found), "repair-pieces")

    blank = lambda name, kind: F.lit(None).cast(kind).alias(name)
    stream = turns.select("conv_id", *_PLACE, F.lit(1).alias("kind"), "text", blank("piece", piece_type)).unionByName(
        pieces.select("conv_id", *_PLACE, F.lit(0).alias("kind"), blank("text", "string"), "piece"))
    if all_ids is not None:
        stream = stream.unionByName(all_ids.select("conv_id").distinct().select(
            "conv_id", blank("turn", "long"), blank("role", "string"), blank("tie", "string"), blank("uid", "long"),
            F.lit(0).alias("kind"), blank("text", "string"), blank("piece", piece_type)))
    result = T.StructType([T.StructField("conv_id", key), *T.StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string").fields])
    return stream.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_PLACE).select(
        "conv_id", "role", "text", "piece").mapInArrow(_finish(_arrow(result)), result)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
