"""Repair of conversation structure by a persistent audit DP.

A conversation's turns are put in order and given their first fault (blank, a
repeat of an earlier turn, truncated); the cheapest edits (keep, rerole,
delete, insert) that leave role initials of the form ``(s?(ua)+)?`` are found
by a DP over shared edit strings (``editlog``), ties going to the ASCII-least
audit.

At scale: rows are range-partitioned by (conversation, order), so a
conversation of any length may span tasks. A task reads its rows in order, a
run of at most ``RUN_ROWS`` turns or about ``RUN_CHARS`` characters at a time.
A conversation that begins and ends inside a task and fits one run is repaired
there. Of every other one, each run is solved for every state that it may be
entered in; a few numbers per run are chained over the conversation, and every
run then applies the edits of the states chosen for it. Only the digest of a
conversation over several runs is computed in one task, since SHA-256 reads a
text from its beginning to its end; it streams over the runs and holds one.

Order and ties: turns ascend, null first; equal turns by role, then the first
``HEAD`` characters of the text, then a hash of it; equal rows are
interchangeable and stand side by side.

Defined results: null roles and texts are one blank, so a null text is blank
and a null role is no role; null ``conv_id``s are one conversation; an empty
role has no initial; repeated rows are duplicates; extra columns are ignored;
an empty table gives an empty result. Texts of any length stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import spark_partition_id

from quire.llm.editlog import BLANK, CUT, DUPLICATE, ENDING, SOUND, STATES, applied, chained, ended, run_edits
from quire.llm.scratch import Scratch

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
HEAD = 256
RUN_ROWS = 4096
RUN_CHARS = 4 << 20
TURNS = "array<struct<role:string,text:string>>"
RUNS = ("conv_id long, number int, open boolean, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
        f"cost long, audit string, turns {TURNS}, costs array<long>, ranks array<long>, audits array<string>, faults binary")
CHOSEN = "conv_id long, part int, number int, first_run boolean, last_run boolean, enter int, leave int, cost long, illegal long"
PIECES = f"conv_id long, part int, number int, audit string, turns {TURNS}"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by CRC-32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes sentence ends, 3 repeats it, 4 makes
    its role ``user``. Nulls are one blank."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
                      F.when(kind == 4, "user").otherwise(filled("role")).alias("role"),
                      F.when(kind == 1, "").when(kind == 2, F.translate(filled("text"), ENDS, "")).otherwise(filled("text")).alias("text"))
    times = F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1).cast("int"))
    return out.where("kind <> 0").withColumn("time", F.explode(times)).select("conv_id", "turn", "role", "text")


def faults(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their first ``fault``, and the written table behind it."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    base = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), filled("role"), filled("text"))
    base = base.select("*", F.monotonically_increasing_id().alias("row"), F.xxhash64("role", "text").alias("h"), F.xxhash64(F.lit(1), "text", "role").alias("g"))
    base = scratch.keep(base, "turns")
    key = [F.col("conv_id").alias("_conv"), F.col("h").alias("_h"), F.col("g").alias("_g")]
    place = F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "row"))
    again = base.groupBy(*key).agg(place.alias("_first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("_conv", "_h", "_g", F.col("_first.row").alias("_row"))
    joined = base.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")), "left")
    body: Column = F.rtrim(F.col("text"), F.lit(BLANKS))
    end = F.right(body, F.lit(1))
    fault = F.when(body == "", BLANK).when(F.col("_row") != F.col("row"), DUPLICATE).when(~end.isin(*ENDS), CUT).otherwise(SOUND)
    return joined.select("conv_id", "turn", "role", "text", "row", "h", fault.alias("fault")), base


def runs(faulty: DataFrame) -> DataFrame:
    """Runs of turns in order: ``part, number`` order those of a conversation.
    Conversations known to be whole have their ``cost``, ``audit`` and repaired
    ``turns``; the ``open`` ones have the run's own turns and, for every state
    the run may be entered in, the costs, ranks and edits of ``run_edits``."""
    def record(conv, number, open_run, roles, texts, kinds):
        initials = [r[:1] for r in roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        head = [conv, number, open_run, len(roles), *(kinds.count(k) for k in (BLANK, DUPLICATE, CUT)), illegal, initials[0], initials[-1]]
        if open_run:
            solved = [run_edits(initials, kinds, s) for s in range(STATES)]
            return [*head, None, None, list(zip(roles, texts)), *[[x for one in solved for x in one[j]] for j in range(3)], bytes(kinds)]
        cost, rank, edits = run_edits(initials, kinds)
        total, end = ended(cost, rank)
        audit = edits[end] + ENDING[end]
        return [*head, total, audit, applied(audit, roles, texts), None, None, None, None]

    def batch(records) -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.bool_(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary()]
        columns = list(zip(*records))
        columns[12] = [[{"role": r, "text": t} for r, t in turns] for turns in columns[12]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in RUNS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a run is closed by the next conversation, by its size, or by the end of the task; only the first closes the conversation
        conv, number, begun, roles, texts, kinds, size = None, 0, False, [], [], [], 0
        out, held, at_start = [], 0, True
        for part in batches:
            for c, role, text, fault in zip(*[part.column(i).to_pylist() for i in range(4)]):
                if roles and c != conv:
                    out.append(record(conv, number, at_start or begun, roles, texts, kinds))
                    number, begun, at_start, roles, texts, kinds, size = number + 1, False, False, [], [], [], 0
                elif roles and (len(roles) >= RUN_ROWS or size >= RUN_CHARS):
                    out.append(record(conv, number, True, roles, texts, kinds))
                    number, begun, roles, texts, kinds, size = number + 1, True, [], [], [], 0
                conv = c
                roles.append(role)
                texts.append(text)
                kinds.append(fault)
                size += len(text)
                held += len(text) + 100
                if held >= RUN_CHARS and out:
                    yield batch(out)
                    out, held = [], size
        if roles:
            out.append(record(conv, number, True, roles, texts, kinds))
        if out:
            yield batch(out)

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "head", "h", "row"]
    dealt = faulty.withColumn("head", F.substring("text", 1, HEAD)).repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "role", "text", "fault").mapInArrow(run, RUNS).withColumn("part", spark_partition_id())


def choices(open_runs: DataFrame) -> DataFrame:
    """For every open run the states it is entered and left in, and on a
    conversation's first run the cost and the illegal neighbours across runs."""
    def solved(rows):
        total, states = chained([(r["costs"], r["ranks"]) for r in rows])
        across = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        return [(r["conv_id"], r["part"], r["number"], i == 0, i == len(rows) - 1, states[i], states[i + 1], total if i == 0 else 0, across if i == 0 else 0)
                for i, r in enumerate(rows)]

    def batch(rows) -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[f.split()[0] for f in CHOSEN.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part in batches:
            for r in part.to_pylist():
                if rows and r["conv_id"] != rows[-1]["conv_id"]:
                    yield batch(solved(rows))
                    rows = []
                rows.append(r)
        if rows:
            yield batch(solved(rows))

    order = ["conv_id", "part", "number"]
    return (open_runs.select(*order, "first", "last", "costs", "ranks").repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, CHOSEN))


def pieces(open_runs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Edits and repaired turns of every open run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for r in part.to_pylist():
                audit = r["audits"][STATES * r["enter"] + r["leave"]] + (ENDING[r["leave"]] if r["last_run"] else "")
                turns = applied(audit, [t["role"] for t in r["turns"]], [t["text"] for t in r["turns"]], r["enter"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["conv_id"]], pa.int64()), pa.array([r["part"]], pa.int32()), pa.array([r["number"]], pa.int32()), pa.array([audit], pa.string()),
                     pa.array([[{"role": a, "text": b} for a, b in turns]], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))],
                    names=["conv_id", "part", "number", "audit", "turns"])

    return (open_runs.select("conv_id", "part", "number", "turns", "audits").join(chosen.select("part", "number", "last_run", "enter", "leave"), ["part", "number"])
                     .select("conv_id", "part", "number", "turns", "audits", "last_run", "enter", "leave").mapInArrow(run, PIECES))


def _streamed(repaired: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256`` of conversations in pieces, read in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result():
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])],
                                              names=["conv_id", "audit", "repaired_sha256"])

        conv, audit, digest, some = None, [], None, False
        for part in batches:
            for c, edits, turns in zip(*[part.column(i).to_pylist() for i in range(3)]):
                if digest is not None and c != conv:
                    yield result()
                    audit, digest, some = [], None, False
                if digest is None:
                    conv, digest = c, hashlib.sha256()
                audit.append(edits)
                for turn in turns:
                    digest.update(f"{chr(10) if some else ''}{turn['role']}:{turn['text']}".encode())
                    some = True
        if digest is not None:
            yield result()

    order = ["conv_id", "part", "number"]
    return (repaired.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "turns")
                    .mapInArrow(run, "conv_id long, audit string, repaired_sha256 string"))


def repair(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written runs of all conversations of ``rows`` (``conv_id, turn, role,
    text``), the choices for the open ones, and ``conv_id, part, number, audit,
    turns``: all repaired conversations, the longest in several rows."""
    faulty, base = faults(rows, scratch)
    made = scratch.keep(runs(faulty), "runs")
    scratch.drop(base)
    open_runs = made.where("open")
    chosen = scratch.keep(choices(open_runs), "choices")
    repaired = scratch.keep(pieces(open_runs, chosen), "pieces")
    return made, chosen, repaired


def repaired_turns(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, part, number, audit, turns`` of all repaired conversations."""
    made, _, opened = repair(rows, scratch)
    return made.where("not open").select("conv_id", "part", "number", "audit", "turns").unionByName(opened)


def reports(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` of every conversation of ``rows``."""
    made, chosen, opened = repair(rows, scratch)
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = made.where("not open").select("conv_id", *counts, "audit", F.sha2(joined, 256).alias("repaired_sha256"))
    parts = (made.where("open").select("conv_id", "blank", "duplicate", "truncated", "illegal", F.lit(0).cast("long").alias("cost"))
                 .unionByName(chosen.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in counts[:3]], "illegal", "cost"))
                 .groupBy(F.col("conv_id").alias("_conv")).agg(*[F.sum(c).alias(c) for c in counts]))
    several = parts.join(_streamed(opened), F.col("_conv").eqNullSafe(F.col("conv_id"))).select("conv_id", *counts, "audit", "repaired_sha256")
    turns = rows.select(F.col("conv_id").cast("long").alias("_conv"), F.col("turn").cast("long").alias("turn")).groupBy("_conv", "turn").agg(F.count(F.lit(1)))
    span = turns.groupBy("_conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    return (whole.unionByName(several).join(span, F.col("conv_id").eqNullSafe(F.col("_conv")))
                 .select("conv_id", "gaps", *counts, "audit", "repaired_sha256"))
