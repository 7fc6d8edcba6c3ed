"""Repair of conversation structure by the auction shortest-path algorithm.

A conversation with n rows is a lattice of nodes (rows consumed, grammar state); keeping, reroling
or deleting a row leads to the next layer, inserting a turn stays in the layer.  The cheapest
repair is a shortest path, found by the auction algorithm: every node has an integer price, a path
grows from the origin along the arc of least cost plus price while that equals its end's price,
and otherwise the end's price rises to it and the path contracts by one node.  The lattice is
worked off in segments from its end, each bounded by a layer whose prices are already exact, so
the work is linear in the rows.  The converged prices make exactly the arcs of shortest paths
tight; the repair is traced along tight arcs, least letter first.

Spark orders the rows, finds faults and streams the repaired texts; a task holds one byte a row of
a conversation, like the audit that is returned, and never a conversation's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package

# Costs of the edits and their letters.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Role initials by class; class 0 is any other.
INITIALS = " sua"
#: state -> class -> next state: 0 nothing yet, 1 after s, 2 after u, 3 after a (0 and 3 accept).
NEXT = ({1: 1, 2: 2}, {2: 2}, {3: 3}, {2: 2})
#: state -> (role that an inserted or reroled turn takes, next state).
FORCED = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
ACCEPTS = (0, 3)
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
SEGMENT = 64
_FAR = 1 << 60


def _arcs(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, node offset) of the arcs out of a node, in order of their letters; a row's
    code is its initial's class plus 4 times its fault."""
    fault, initial = code >> 2, code & 3
    extra, forced = (TRUNCATED if fault == CUT_OFF else 0), FORCED[state][1]
    arcs = [("D", DELETE, 4), ("I", INSERT, forced - state)]
    if fault not in (BLANK, DUPLICATE):
        if initial in NEXT[state]:
            arcs.append(("K", extra, 4 + NEXT[state][initial] - state))
        arcs.append(("R", REROLE + extra, 4 + forced - state))
    return arcs


ARCS = [[_arcs(code, state) for state in range(4)] for code in range(16)]
#: The least that a row costs whatever is done with it.
LEAST = [min(a[1] for s in range(4) for a in ARCS[code][s] if a[0] != "I") for code in range(16)]


def prices_of(codes: bytes) -> list[int]:
    """Price of every node ``4 * layer + state``: at most its distance to the end, and exactly
    that on every shortest path from the first layer."""
    n = len(codes)
    price = [0] * (4 * n + 4)
    # the last layer: accepting states cost nothing, the others insert until one accepts
    for s in (2, 1):
        price[4 * n + s] = INSERT + price[4 * n + FORCED[s][1]]
    end = n
    while end:
        start = max(0, end - SEGMENT)
        low = min(price[4 * end:4 * end + 4])
        for k in range(end - 1, start - 1, -1):  # a feasible start: what no repair can avoid
            low += LEAST[codes[k]]
            price[4 * k:4 * k + 4] = [low] * 4
        for origin in range(4 * start, 4 * start + 4):
            path = [origin]
            while path[-1] < 4 * end:
                i = path[-1]
                best = _FAR
                for _, cost, offset in ARCS[codes[i >> 2]][i & 3]:
                    if cost + price[i + offset] < best:
                        best, to = cost + price[i + offset], i + offset
                if price[i] < best:
                    price[i] = best
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(to)
        end = start
    return price


def repair_of(codes: bytes) -> tuple[int, str, list[tuple[int | None, str | None]]]:
    """(cost, audit, kept or made turns as (row number or None, new role or None))."""
    n, price = len(codes), prices_of(codes)
    alive = bytearray(4 * n + 4)  # nodes from which tight arcs lead to the end
    for s in ACCEPTS:
        alive[4 * n + s] = 1
    for k in range(n, -1, -1):
        for _ in range(3):  # inserts lead from state to state of one layer
            for s in range(4):
                i = 4 * k + s
                arcs = ARCS[codes[k]][s] if k < n else _arcs(0, s)[1:2]
                alive[i] |= any(price[i] == c + price[i + o] and alive[i + o] for _, c, o in arcs)
    audit, turns, i = [], [], 0
    while not (i >> 2 == n and price[i] == 0 and (i & 3) in ACCEPTS):
        k, s = i >> 2, i & 3
        for letter, cost, offset in (ARCS[codes[k]][s] if k < n else _arcs(0, s)[1:2]):
            if price[i] == cost + price[i + offset] and alive[i + offset]:
                break
        audit.append(letter)
        if letter != "D":
            turns.append((None if letter == "I" else k, None if letter == "K" else FORCED[s][0]))
        i += offset
    return price[0], "".join(audit), turns


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, tuple] = {}  # conversations of one shape have one repair
    for batch in batches:
        out = []
        for codes in batch.column("codes").to_pylist():
            if codes not in known:
                if len(known) > 10_000 or len(codes) > 100:
                    known.clear()
                known[codes] = repair_of(codes)
            out.append(known[codes])
        turns = [[{"pos": k, "role": r} for k, r in t] for _, _, t in out]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array([c for c, _, _ in out], pa.int64()),
             pa.array([a for _, a, _ in out], pa.string()),
             pa.array(turns, pa.list_(pa.struct([("pos", pa.int64()), ("role", pa.string())])))],
            ["conv_id", "cost", "audit", "turns"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (conv_id, seq) -> (conv_id, hash of role:text lines), streamed."""
    current, sha, done = None, None, []

    def rows():
        out = pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()),
                                          pa.array([h for _, h in done], pa.string())], ["conv_id", "sha"])
        done.clear()
        return out

    for batch in batches:
        for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").cast(pa.binary()).to_pylist()):
            if sha is None or conv != current:
                if sha is not None:
                    done.append((current, sha.hexdigest()))
                current, sha = conv, hashlib.sha256(line)
            else:
                sha.update(b"\n" + line)
        if done:
            yield rows()
    if sha is not None:
        done.append((current, sha.hexdigest()))
        yield rows()


def numbered_turns(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``pos`` from 0 by turn (nulls first; ties by role and
    text), ``fault`` (the first of blank, duplicate and cut off), ``initial`` (class of the role's
    first character), ``illegal`` (initials that may not follow each other) and ``fresh`` (a
    turn number not seen before).  Both windows share one shuffle by conv_id."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    first = F.substring("role", 1, 1)
    pair = F.concat(F.lag(first).over(order), first)
    placed = rows.select(
        "conv_id", "turn", "role", "text", (F.row_number().over(order) - 1).cast("long").alias("pos"),
        F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(order))).alias("fresh"))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("pos")) > 1
    last = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", ""), -1, 1)
    fault = (F.when(last == "", BLANK).when(again, DUPLICATE)
             .when(~last.isin(".", "!", "?"), CUT_OFF).otherwise(SOUND))
    return placed.select("*", fault.alias("fault"),
                         F.coalesce(*[F.when(first == INITIALS[i], i) for i in (1, 2, 3)], F.lit(0)).alias("initial"))


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair conversations (rows conv_id, turn, role, text; other columns are ignored).

    Returns (report, turns).  Report, one row per conv_id: gaps in the turn numbers, counts of
    blank, duplicate and cut off rows (each row's first fault) and of illegal neighbours, cost
    and audit (letters of the cheapest edits, ties ASCII-least), repaired_sha256.  Turns, the
    repaired conversations: conv_id, seq, pos (row it came from, null if inserted), role, text.

    Null roles and texts count as one space; rows of equal turn are ordered by role and text,
    null turns first; repeated rows are duplicates; rows without a conv_id are in no
    conversation and left out; an empty table gives no rows."""
    spark = rows.sparkSession
    ship_package(spark)
    given = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    placed = cut_lineage(numbered_turns(given))
    code = (F.col("initial") + 4 * F.col("fault")).cast("int")
    report = placed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("fresh"), F.lit(0)).cast("long").alias("gaps"),
        *(F.count_if(F.col("fault") == i).alias(n) for i, n in
          ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT_OFF, "truncated"))),
        F.count_if("illegal").alias("illegal"),
        # one hexadecimal digit a row, in order
        F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", code.alias("code")))),
                                         lambda r: F.concat(F.lit("0"), F.hex(r["code"].cast("long")))), "")).alias("codes"))
    report = cut_lineage(report)
    solved = cut_lineage(report.select("conv_id", "codes").mapInArrow(
        _repaired, "conv_id long, cost long, audit string, turns array<struct<pos: long, role: string>>"))
    edits = solved.select("conv_id", F.posexplode("turns").alias("seq", "t")).select(
        "conv_id", "seq", F.col("t.pos").alias("pos"), F.col("t.role").alias("new_role"))
    source = placed.select("conv_id", "pos", "role", "text")
    turns = edits.join(source, ["conv_id", "pos"], "left").select(
        "conv_id", "seq", "pos", F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    sha = (turns.select("conv_id", "seq", F.concat("role", F.lit(":"), "text").alias("line"))
           .repartition("conv_id").sortWithinPartitions("conv_id", "seq")
           .mapInArrow(_digests, "conv_id long, sha string"))
    report = (report.drop("codes").join(solved.drop("turns"), "conv_id").join(sha, "conv_id", "left")
              .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))
    return report, turns


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``rows`` (nulls: one space) damaged by crc32(`conv_id:turn`) % 20: 0 drops a row, 1
    empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets its role to user."""
    def named(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.col("_what")
    return (rows.select("conv_id", "turn", named("role").alias("role"), named("text").alias("text"),
                        (F.crc32(F.encode(F.concat(named("conv_id"), F.lit(":"), named("turn")), "utf-8")) % 20).alias("_what"))
            .where(what != 0)
            .withColumn("text", F.when(what == 1, "").when(what == 2, F.regexp_replace("text", "[.!?]", ""))
                        .otherwise(F.col("text")))
            .withColumn("role", F.when(what == 4, "user").otherwise(F.col("role")))
            .withColumn("_copy", F.explode(F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text"))
