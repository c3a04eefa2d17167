"""Repair of conversations' role structure by a generalised LR parse with weighted edits.

1. Equal rows of a conversation are one row with a count, so copies travel
   once. Whether a row's role and text stand at an earlier turn comes from
   the least turn of each repeated (conversation, role, text).
2. The rows are dealt by range of (conversation, turn, role, start of the
   text) and sorted, so a conversation of any length lies in as many tasks as
   it fills. A task parses each conversation that lies wholly inside it. The
   first and the last one of a task, and those longer than ``SEGMENT`` rows,
   are cut into segments: each gives the table of cheapest edits from every
   parser stack before it to every stack after it (:mod:`role_glr`), and its
   rows, packed.
3. The segments' tables of a conversation compose, pair by pair, to its
   cheapest edits; each segment gets back its slice of them and writes its
   stretch of the repaired text. SHA-256 takes the stretches one after the
   other: that step streams packed stretches, not rows.

Order within a conversation: turn (nulls first), then role, then text; equal
rows lie side by side. A null conversation id is one conversation; a null role
or text counts as one space. Conversations named in ``all_ids`` without a row
come out with zeros, no edits and the digest of nothing. An empty table gives
an empty result. Further columns, of whatever names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from . import role_glr as G

#: Rows and characters of text of a segment, at most (a longer row is a segment of its own).
SEGMENT, SEGMENT_CHARS = 1024, 4 << 20
#: Characters of a text that help to deal rows of one turn and role.
DEAL_CHARS = 64

_SPACE = " \t\n\r\x0b\x0c"
_LEGAL = {"su", "ua", "au"}
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


class Repair(NamedTuple):
    """``summary``: one row per conversation. ``segments``: rows and edits in stretches, for :func:`repaired_rows`."""

    summary: DataFrame
    segments: DataFrame


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults put in by crc32 of ``conv_id:turn`` mod 20; a null is one space there, in role and in text.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes its role user.
    """
    text_or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_or_space("role").alias("role"), text_or_space("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("n"))


def _turn(col: str = "turn") -> Column:
    """Turns in their order, nulls first."""
    return F.struct(F.col(col).isNotNull().alias("known"), F.col(col).alias("turn"))


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, n) dealt by range and sorted, with ``again``: role and text stand at an earlier turn."""
    keyed = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("sha", F.unhex(F.sha2("text", 256)))
    # Staged, as the repeats, the range bounds and the rows themselves all read it.
    held = stage_table(keyed, "conversation-rows")
    repeats = held.groupBy("conv_id", "role", "sha").agg(F.min(_turn()).alias("least"), F.count(F.lit(1)).alias("times")).where("times > 1")
    repeats = repeats.select(F.col("conv_id").alias("r_conv"), F.col("role").alias("r_role"), F.col("sha").alias("r_sha"), "least")
    same = held["conv_id"].eqNullSafe(F.col("r_conv")) & (held["role"] == F.col("r_role")) & (held["sha"] == F.col("r_sha"))
    again = F.coalesce(F.col("least") < _turn(), F.lit(False))
    flagged = held.join(repeats, same, "left").select("conv_id", "turn", "role", "text", "n", again.alias("again"), F.substring("text", 1, DEAL_CHARS).alias("start"))
    return flagged.repartitionByRange("conv_id", "turn", "role", "start").sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id())


class Segment:
    """Consecutive rows of a conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.roles, self.texts, self.chars = conv, [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None  # initials
        self.least = self.most = self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn, role: str, text: str, again: bool) -> None:
        end = text.rstrip(_SPACE)[-1:]
        initial, state = role[:1], G.FINE
        if not end:
            self.blank, state = self.blank + 1, G.BAD
        elif again:
            self.duplicate, state = self.duplicate + 1, G.BAD
        elif end not in ".!?":
            self.truncated, state = self.truncated + 1, G.CUT
        if self.rows and self.last + initial not in _LEGAL:
            self.illegal += 1
        if turn is not None and (not self.turns or turn != self.last_turn):
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.first_turn = turn if not self.rows else self.first_turn
        self.first = initial if not self.rows else self.first
        self.last, self.last_turn = initial, turn
        self.rows.append((initial, state))
        if state != G.BAD:
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)

    @property
    def full(self) -> bool:
        return len(self.rows) >= SEGMENT or self.chars >= SEGMENT_CHARS


def _gaps(least, most, turns: int) -> int:
    return most - least + 1 - turns if turns else 0


class Edited(NamedTuple):
    """A row of the repaired conversation."""

    action: str
    role: str
    text: str


def edits(states: list[int], roles: list[str], texts: list[str], audit: str, before: int, with_system: bool) -> Iterator[Edited]:
    """What the edits make of a stretch of rows. ``before`` rows of the repaired conversation lie before it."""
    row = kept = 0
    for action in audit:
        if action != "I":
            row += 1
        if action == "D":
            kept += states[row - 1] != G.BAD
            continue
        role, text = "assistant" if (before - with_system) % 2 else "user", ""
        if action != "I":
            role, text = roles[kept] if action == "K" else role, texts[kept]
            kept += 1
        yield Edited(action, role, text)
        before += 1


_KINDS = "blank long, duplicate long, truncated long, illegal long"
_SEGMENT = f"""part int, seg int, {_KINDS}, first string, last string, least long, most long, first_turn long, last_turn long, turns long,
    n_rows long, table array<struct<before: int, after: int, cost: long, audit: string>>, states binary, roles array<string>, texts array<string>"""


def _segments(rows: DataFrame, keep_rows: bool) -> DataFrame:
    """Segments, in order, of the conversations that may lie in several tasks or are long; results of the others.

    ``cost``, ``audit`` and ``repaired_sha256`` are null for a segment. With
    ``keep_rows`` the others have their rows, too.
    """
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv_type}, {_SEGMENT}, gaps long, cost long, audit string, repaired_sha256 string"
    arrow = rows.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = G.RoleParser()
        out: list[dict] = []
        part = seg = chars = 0  # chars: of the text in out
        open_: Segment | None = None
        whole = False  # the open conversation began in this task, and no segment of it is out

        def common(s: Segment) -> dict:
            return {"conv_id": s.conv, "part": part, "seg": seg, "turns": s.turns} | {k: getattr(s, k) for k in (*_COUNTS, "first", "last", "least", "most", "first_turn", "last_turn")} | {"n_rows": len(s.rows)}

        def payload(s: Segment) -> dict:
            return {"states": bytes(state for _, state in s.rows), "roles": s.roles, "texts": s.texts}

        def emit(s: Segment, complete: bool) -> None:
            nonlocal seg, chars
            row = common(s)
            if complete:
                cost, audit = parser.solve(tuple(s.rows))
                size = len(audit) - audit.count("D")
                lines = "\n".join(f"{e.role}:{e.text}" for e in edits([state for _, state in s.rows], s.roles, s.texts, audit, 0, size % 2 == 1))
                row |= {"gaps": _gaps(s.least, s.most, s.turns), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest()}
                row |= payload(s) if keep_rows else {}
            else:
                table = parser.stretch(s.rows)
                row |= {"table": [{"before": a, "after": b, "cost": cost, "audit": audit} for (a, b), (cost, audit) in table.items()]} | payload(s)
            seg, chars = seg + 1, chars + s.chars + len(s.rows)
            out.append(row)

        def flushed(most: int = SEGMENT_CHARS) -> Iterator[pa.RecordBatch]:
            nonlocal chars
            if out and chars >= most:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()
                chars = 0

        for batch in batches:
            for conv, turn, role, text, n, again, part in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "again", "part")), strict=True):
                if open_ is None or conv != open_.conv:
                    if open_ is not None:
                        emit(open_, whole)
                        yield from flushed()
                    whole, open_ = open_ is not None, Segment(conv)
                for k in range(n):
                    if open_.full:
                        emit(open_, False)
                        yield from flushed()
                        whole, open_ = False, Segment(conv)
                    open_.add(turn, role, text, again or k > 0)
        if open_ is not None:
            emit(open_, False)  # it may go on in the next task
        yield from flushed(0)

    return rows.mapInArrow(run, schema)


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, dict, bool]]:
    """(conversation, row, whether it is the first one) of rows sorted by conversation."""
    now, begun = None, False
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            for row in batch.slice(start, 64).to_pylist():
                first = not begun or row["conv_id"] != now
                now, begun = row["conv_id"], True
                yield now, row, first


def _composed(segments: DataFrame) -> DataFrame:
    """The segments' slices of the cheapest edits; a conversation's first slice carries its results."""
    conv_type = segments.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv_type}, part int, seg int, slice string, before long, with_system boolean, first_of_all boolean, gaps long, {_KINDS}, cost long, audit string"
    arrow = segments.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = G.RoleParser()
        held: list[tuple[int, G.Table]] = []  # tables of 1, 2, 4 ... segments: no long table is composed again and again
        names: list[tuple[int, int, int]] = []
        total: dict = {}

        def close(conv) -> Iterator[pa.RecordBatch]:
            table = held[0][1]
            for _, right in held[1:]:
                table = parser.compose(table, right)
            cost, audit = parser.best(table)
            with_system, at, before, rows = (len(audit) - audit.count("D")) % 2 == 1, 0, 0, []
            for k, (part, seg, n) in enumerate(names):
                end = at
                while n:  # the letters of the segment's rows, and the inserts before each
                    n -= audit[end] != "I"
                    end += 1
                mine = audit[at:] if k == len(names) - 1 else audit[at:end]
                row = {"conv_id": conv, "part": part, "seg": seg, "slice": mine, "before": before, "with_system": with_system, "first_of_all": not k}
                at, before = at + len(mine), before + len(mine) - mine.count("D")
                if not k:
                    row |= {"gaps": _gaps(total["least"], total["most"], total["turns"]), "cost": cost, "audit": audit} | {c: total[c] for c in _COUNTS}
                rows.append(row)
            held.clear()
            names.clear()
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

        now = None
        for conv, row, first in _by_conversation(batches):
            if first:
                if names:
                    yield from close(now)
                now, total = conv, {k: row[k] for k in (*_COUNTS, "last", "last_turn", "least", "most", "turns")}
            else:
                for c in _COUNTS:
                    total[c] += row[c]
                total["illegal"] += total["last"] + row["first"] not in _LEGAL
                total["turns"] += row["turns"] - (row["first_turn"] is not None and row["first_turn"] == total["last_turn"])
                total["least"] = row["least"] if total["least"] is None else total["least"]
                total["most"] = total["most"] if row["most"] is None else row["most"]
                total["last"], total["last_turn"] = row["last"], row["last_turn"]
            names.append((row["part"], row["seg"], row["n_rows"]))
            size, table = 1, {(t["before"], t["after"]): (t["cost"], t["audit"]) for t in row["table"]}
            while held and held[-1][0] <= size:
                left = held.pop()
                size, table = size + left[0], parser.compose(left[1], table)
            held.append((size, table))
        if names:
            yield from close(now)

    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg").mapInArrow(run, schema)


def _stretches(pieces: DataFrame) -> DataFrame:
    """(conv_id, part, seg, lines): the repaired text of each segment, without a line break at its end; null if nothing is left of it."""
    conv_type = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for row in batch.select(["states", "roles", "texts", "slice", "before", "with_system"]).to_pylist():
                made = [f"{e.role}:{e.text}" for e in edits(list(row["states"]), row["roles"], row["texts"], row["slice"], row["before"], row["with_system"])]
                lines.append("\n".join(made).encode() if made else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "part", "seg")), pa.array(lines, pa.binary())], names=["conv_id", "part", "seg", "lines"])

    return pieces.mapInArrow(run, f"conv_id {conv_type}, part int, seg int, lines binary")


def _digests(stretches: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the stretches in their order, joined by line breaks."""
    conv_type = stretches.schema["conv_id"].dataType
    conv_arrow = stretches.select("conv_id").limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        digest, now, some = None, None, False
        for conv, row, first in _by_conversation(batches):
            if first:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                digest, now, some = hashlib.sha256(), conv, False
            if row["lines"] is not None:
                digest.update((b"\n" if some else b"") + row["lines"])
                some = True
        if digest is not None:
            done.append((now, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], conv_arrow), pa.array([d for _, d in done], pa.string())], names=["conv_id", "repaired_sha256"])

    return stretches.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg").mapInArrow(run, f"conv_id {conv_type.simpleString()}, repaired_sha256 string")


def repair(rows: DataFrame, all_ids: DataFrame | None = None, keep_rows: bool = True, count_col: str | None = None) -> Repair:
    """Repairs conversations, rows (conv_id, turn, role, text); ``count_col`` says how often a row stands there.

    The summary has conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit and repaired_sha256. ``all_ids`` (conv_id) names conversations that
    come out though they have no row.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    own = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"), (F.col(count_col) if count_col else F.lit(1)).cast("long").alias("n"))
    found = stage_table(_segments(_ordered(own), keep_rows), "conversation-segments")
    results = ["conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired_sha256"]
    cut = found.where("audit is null")
    slices = stage_table(_composed(cut.drop("states", "roles", "texts", "gaps", "cost", "audit", "repaired_sha256")), "conversation-slices")
    payload = cut.select(F.col("part").alias("p"), F.col("seg").alias("s"), "states", "roles", "texts")
    pieces = slices.join(payload, (F.col("part") == F.col("p")) & (F.col("seg") == F.col("s"))).select("conv_id", "part", "seg", "states", "roles", "texts", "slice", "before", "with_system")
    digests = _digests(_stretches(pieces)).select(F.col("conv_id").alias("d_conv"), "repaired_sha256")
    joined = slices.where("first_of_all").join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv")))
    summary = found.where("audit is not null").select(results).unionByName(joined.select(results))
    if all_ids is not None:
        names = all_ids.select(F.col("conv_id").alias("name")).distinct()
        nothing = {c: F.lit(0).cast("long") for c in ("gaps", *_COUNTS, "cost")} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
        summary = names.join(summary, F.col("name").eqNullSafe(F.col("conv_id")), "left").select(F.col("name").alias("conv_id"), *(F.coalesce(c, v).alias(c) for c, v in nothing.items()))
    size = F.char_length("audit") - F.char_length(F.translate("audit", "D", ""))
    whole = found.where("audit is not null").select("conv_id", "part", "seg", "states", "roles", "texts", F.col("audit").alias("slice"), F.lit(0).cast("long").alias("before"), ((F.char_length("audit") - size) % 2 == 1).alias("with_system"))
    return Repair(summary, whole.unionByName(pieces) if keep_rows else pieces)


def repaired_rows(segments: DataFrame) -> DataFrame:
    """(conv_id, place, action, role, text): the repaired conversations, row by row; place counts from 0."""
    conv_type = segments.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv_type}, place long, action string, role string, text string"
    arrow = segments.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made = edits(list(row["states"]), row["roles"], row["texts"], row["slice"], row["before"], row["with_system"])
                rows = [{"conv_id": row["conv_id"], "place": row["before"] + k} | e._asdict() for k, e in enumerate(made)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return segments.mapInArrow(run, schema)
