"""Repairing the turn structure of conversations, however long they are."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import Scratch
from . import turn_edits as te

#: Rows that are worked on as one piece (two to this power).
PIECE_BITS = 12
_SPACES = " \t\n\x0b\x0c\r"
_LONGEST = 2**63 - 1


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` with faults, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its
    text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it a user's. Nulls count as one space."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    some = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return some.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("__n")).drop("__n")


class Repair:
    """The cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text; other columns are ignored).

    Rows of a conversation are taken by turn, null turns first, equal turns by role and text; a null role or
    text counts as one space, and a null ``conv_id`` is a conversation like any other. Of several cheapest
    repairs it is that with the ASCII-least audit. An empty table gives empty tables.

    One range sort puts the rows in order; it spreads a conversation of any length over many tasks. Runs of
    at most 4096 rows are the pieces: a piece is summed up as one step between states, the steps of a
    conversation are chained, and then each piece is reconstructed on its own between its two states.
    """

    def __init__(self, rows: DataFrame, scratch: Scratch):
        self.scratch = scratch
        tidy = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
        key = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
        ordered = tidy.sort("conv_id", F.asc_nulls_first("turn"), "role", "text").withColumn("at", F.monotonically_increasing_id())
        self.rows = scratch.write(ordered.withColumn("digest", F.unhex(F.sha2(key, 256))), "turns")
        self.pieces = scratch.write(self._pieces(), "pieces")
        self.chained = scratch.write(self._chained(), "chained")
        self.edits = scratch.write(self._edits(), "edits")

    def _codes(self) -> DataFrame:
        """Fault and initial of every row. Rows are duplicates if role and text have equal SHA-256 digests."""
        first = self.rows.groupBy("conv_id", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
        body = F.rtrim(F.col("text"), F.lit(_SPACES))
        slim = self.rows.select(
            "at", "conv_id", F.substring("role", 1, 1).alias("initial"), (body == "").alias("blank"),
            (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"))
        fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("")
        return slim.join(first, "at", "left").select("at", "conv_id", "initial", fault.alias("fault"))

    def _pieces(self) -> DataFrame:
        """A row for each run of rows of one conversation and one piece: ``head``, its first place, counts, codes, step."""
        schema = StructType([self.rows.schema["conv_id"], *StructType.fromDDL(
            "head bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
            "codes binary, step array<bigint>")])

        def summed(conv, rows):
            faults, initials = [f for *_, f in rows], [i for _, i, _ in rows]
            codes = bytes(te.code(i, {"": te.CLEAN, "t": te.TRUNCATED}.get(f, te.MUST_GO)) for _, i, f in rows)
            step = [v for pairs in te.whole_step(codes) for pair in pairs for v in pair]
            return (conv, rows[0][0], *(faults.count(f) for f in "bdt"), _illegal(initials), initials[0], initials[-1], codes, step)

        def run(batches):
            key, held = None, []
            for batch in batches:
                out = []
                for at, conv, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                    if held and (conv, at >> PIECE_BITS) != key:
                        out.append(summed(key[0], held))
                        held = []
                    key = conv, at >> PIECE_BITS
                    held.append((at, initial, fault))
                yield _batch(out, schema)
            if held:
                yield _batch([summed(key[0], held)], schema)

        piece = F.shiftright("at", PIECE_BITS)
        return self._codes().repartition(piece).sortWithinPartitions("at").mapInArrow(run, schema)

    def _chained(self) -> DataFrame:
        """The states between the pieces. A task holds the steps of a conversation, one for 4096 rows."""
        schema = StructType([self.rows.schema["conv_id"], *StructType.fromDDL(
            "head bigint, start int, finish int, closing boolean, blank bigint, duplicate bigint, truncated bigint, "
            "illegal bigint, cost bigint")])

        def solved(conv, parts):
            steps = [_step(p[-1]) for p in parts]
            end, cost = te.best_end(te.forward(te.only(te.START), steps))
            after = te.states(steps, te.START, end)
            illegal = sum(p[4] for p in parts) + sum(_illegal([a[6], b[5]]) for a, b in zip(parts, parts[1:]))
            totals = [sum(p[c] for p in parts) for c in (1, 2, 3)] + [illegal, cost]
            for i, p in enumerate(parts):
                yield (conv, p[0], after[i - 1] if i else te.START, after[i], i == len(parts) - 1,
                       *(totals if i == 0 else [None] * 5))

        def run(batches):
            key, held = None, []
            for batch in batches:
                out = []
                for conv, *piece in zip(*(c.to_pylist() for c in batch.columns)):
                    if held and conv != key:
                        out += solved(key, held)
                        held = []
                    key = conv
                    held.append(piece)
                yield _batch(out, schema)
            if held:
                yield _batch(list(solved(key, held)), schema)

        steps = self.pieces.drop("codes").repartition("conv_id").sortWithinPartitions("conv_id", "head")
        return steps.mapInArrow(run, schema)

    def _edits(self) -> DataFrame:
        """Per piece its letters, and what differs from keeping a row: ``at``, ``kind`` (0 before and at the row,
        2 after the last row), the letters and the state before them."""
        both = self.pieces.select("head", "codes").join(self.chained.select("conv_id", "head", "start", "finish", "closing"), "head")
        schema = StructType([self.rows.schema["conv_id"], *StructType.fromDDL(
            "head bigint, audit string, changes array<struct<at: bigint, kind: int, letters: string, state: int>>")])

        def run(batches):
            for batch in batches:
                out = []
                for head, codes, conv, start, finish, closing in zip(*(c.to_pylist() for c in batch.columns)):
                    found, before = te.letters(codes, start, finish)
                    changes = [(head + i, 0, x, s) for i, (x, s) in enumerate(zip(found, before)) if x != "K"]
                    tail = te.TAIL[finish] if closing else ""
                    if tail:
                        changes.append((head + len(codes) - 1, 2, tail, finish))
                    names = ("at", "kind", "letters", "state")
                    out.append((conv, head, "".join(found) + tail, [dict(zip(names, c)) for c in changes]))
                yield _batch(out, schema)

        return both.mapInArrow(run, schema)

    def audits(self) -> DataFrame:
        """Per conversation: conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit.

        Gaps are the numbers missing between the smallest and the largest turn, 0 if all turns are null, and
        2^63 - 1 at most.
        """
        turns = self.rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv_id").agg(
            F.sum("n").alias("n_rows"), F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("turns"))
        wide = F.col("high").cast("decimal(38,0)") - F.col("low").cast("decimal(38,0)") + 1 - F.col("turns")
        some = F.least(wide, F.lit(_LONGEST).cast("decimal(38,0)")).cast("long")
        gaps = turns.select(F.col("conv_id").alias("c"), "n_rows", F.when(F.col("turns") > 0, some).otherwise(0).alias("gaps"))
        audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("head", "audit"))), lambda p: p["audit"]), "")
        audits = self.edits.groupBy("conv_id").agg(audit.alias("audit"))
        facts = self.chained.where("cost IS NOT NULL").select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")
        both = facts.join(gaps, facts["conv_id"].eqNullSafe(gaps["c"])).drop("c")
        audits = audits.withColumnRenamed("conv_id", "c")
        return both.join(audits, both["conv_id"].eqNullSafe(audits["c"])).select(
            "conv_id", "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def _in_order(self, by: str | None) -> DataFrame:
        """Rows and changes, sorted so that the changes of a row come before it and those at the end after it."""
        changes = self.edits.select("conv_id", F.inline("changes")).select(
            "conv_id", "at", "kind", "letters", "state", F.lit("").alias("role"), F.lit("").alias("text"))
        turns = self.rows.select("conv_id", "at", F.lit(1).alias("kind"), F.lit("").alias("letters"), F.lit(0).alias("state"), "role", "text")
        key = F.col(by) if by else F.shiftright("at", PIECE_BITS)
        return turns.unionByName(changes).repartition(key).sortWithinPartitions(*([by] if by else []), "at", "kind")

    def messages(self) -> DataFrame:
        """The repaired conversations: conv_id, place (increasing in a conversation; equal for turns that
        are inserted at one row, which ``part`` numbers), part, role, text."""
        schema = StructType([self.rows.schema["conv_id"], *StructType.fromDDL("place bigint, part int, role string, text string")])

        def run(batches):
            for some in _written(batches):
                yield _batch(some, schema)

        return self._in_order(None).mapInArrow(run, schema)

    def digests(self) -> DataFrame:
        """conv_id, repaired_sha256: SHA-256 of the lines ``role:text`` of the repaired conversation.

        The digest is made as the lines stream by, a conversation in one task, whose memory does not depend
        on its length. A conversation without any turn left has the digest of the empty string.
        """
        schema = StructType([self.rows.schema["conv_id"], *StructType.fromDDL("repaired_sha256 string")])

        def run(batches):
            key, state, lines = None, None, 0
            for some in _written(batches, all_rows=True):
                out = []
                for conv, _, _, role, text in some:
                    if state is None or conv != key:
                        out += [(key, state.hexdigest())] if state else []
                        key, state, lines = conv, sha256(), 0
                    if role is not None:
                        state.update((("\n" if lines else "") + f"{role}:{text}").encode())
                        lines += 1
                yield _batch(out, schema)
            if state:
                yield _batch([(key, state.hexdigest())], schema)

        return self._in_order("conv_id").mapInArrow(run, schema)


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _step(flat: list[int]) -> te.Step:
    pairs = list(zip(flat[::2], flat[1::2]))
    return tuple(tuple(pairs[4 * s:4 * s + 4]) for s in range(4))


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _written(batches: Iterator[pa.RecordBatch], all_rows: bool = False) -> Iterator[list[tuple]]:
    """(conv_id, place, part, role, text) of all turns that the changes leave or insert, batch by batch. With
    ``all_rows`` a deleted row gives one with a null role."""
    at_change = None
    for batch in batches:
        out = []
        for conv, at, kind, letters, state, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                at_change = at, letters, state
                continue
            if kind == 1:
                edit, before = at_change[1:] if at_change and at_change[0] == at else ("K", 0)
            else:
                edit, before = letters, state
            for part, (letter, new) in enumerate(te.turns(edit, before), 3 * (kind - 1)):
                out.append((conv, at, part, role if letter == "K" else new, "" if letter == "I" else text))
            if all_rows and kind == 1 and edit.endswith("D"):
                out.append((conv, at, 0, None, None))
        yield out
