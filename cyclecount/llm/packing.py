"""Operator 9: best-fit packing by bin completion with branch and bound.

Texts become token pieces of at most ``room`` tokens. Full pieces are sequences of their own.
For the rest only the count of pieces by length matters, a table of at most ``room`` rows;
``solve`` packs these counts: it takes the largest length left, enumerates undominated
fillings of the space beside it by any number of pieces, least waste first, uses a filling as
often as the counts allow (then half as often, and once), prunes by the waste that still beats
the incumbent, and takes best-fit solutions of what is left as incumbents. The plan gives each length's pieces, by rank, their sequence and
place. Ranks come from the pieces' order within a written part and the parts' counts by
length, so no length's pieces ever meet in one task.

Defined cases: a null text is an empty text, one piece with the end id alone; repeated rows
are documents of their own; null keys are kept; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import partial
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclecount.llm import tokens
from cyclecount.llm.common import bounded_batches, materialize, table

ROOM, END_ID = 1024, 2
#: Search effort: nodes of the branch and bound, and fillings tried at each.
NODES, FILLINGS = 4000, 4

Pattern = tuple[int, ...]


# --- the plan over counts by length ---------------------------------------------------


def best_fit(counts: np.ndarray, room: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counts by length: (lengths in a sequence, times used)."""
    open_: dict[int, list[list]] = {}
    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        for space in range(length, room + 1):
            each = space // length
            for group in open_.get(space, []):
                while n and group[1]:
                    take = each if n >= each else n
                    bins = min(group[1], n // take)
                    group[1] -= bins
                    n -= bins * take
                    left = space - take * length
                    open_.setdefault(left, []).append([group[0] + (length,) * take, bins])
                if not n:
                    break
            open_[space] = [g for g in open_.get(space, []) if g[1]]
            if not n:
                break
        each = room // length
        for take, bins in ((each, n // each), (n % each, 1)):
            if take and bins:
                open_.setdefault(room - take * length, []).append([(length,) * take, bins])
    return [(p, n) for groups in open_.values() for p, n in groups if n]


def _fillings(counts: np.ndarray, space: int, top: int) -> list[tuple[int, Pattern]]:
    """Undominated fillings of ``space`` by lengths up to ``top``, least waste first, at most
    FILLINGS of them.

    A single piece that fills the space dominates all, and a filling that leaves room for one
    more piece is dominated. The sums that the lengths up to each one reach, as bits of a
    number, lead to every filling without a dead end; those with larger pieces come first."""
    if space <= 0:
        return [(0, ())]
    if space <= top and counts[space]:
        return [(0, (space,))]
    lengths = np.flatnonzero(counts[: min(space, top) + 1]).tolist()
    if not lengths:
        return [(space, ())]
    most = {x: min(int(counts[x]), space // x) for x in lengths}
    reach, limit = 1, (1 << space + 1) - 1
    stages = [reach]
    for x in lengths:
        n, step = most[x], 1
        while n:
            step = min(step, n)
            reach |= reach << step * x
            n -= step
            step *= 2
        reach &= limit
        stages.append(reach)

    def of_sum(total: int, i: int) -> Iterator[Pattern]:
        """Fillings by the ``i`` smallest lengths that sum to ``total``, which they reach."""
        if not total:
            yield ()
        while total and (i := min(i, bisect_right(lengths, total))):
            x, i = lengths[i - 1], i - 1
            for k in range(min(most[x], total // x), 0, -1):
                if stages[i] >> total - k * x & 1:
                    for rest in of_sum(total - k * x, i):
                        yield (x,) * k + rest
            if not stages[i] >> total & 1:
                return

    out: list[tuple[int, Pattern]] = []
    for total in range(reach.bit_length() - 1, -1, -1):
        if not reach >> total & 1:
            continue
        waste = space - total
        more = [x for x in lengths if x <= waste]
        for fill in islice(of_sum(total, len(lengths)), FILLINGS):
            if all(fill.count(x) == counts[x] for x in more):
                out.append((waste, fill))
        if len(out) >= FILLINGS or sum(x * int(counts[x]) for x in more) > total:
            break  # these pieces would all have to be in, so every smaller sum leaves room for one
    return out[:FILLINGS]


def solve(counts: np.ndarray, room: int = ROOM, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Pack counts by length into as few sequences as the search finds."""
    counts = counts.astype(np.int64).copy()
    lengths = np.arange(len(counts))
    total = int((counts * lengths).sum())
    best = best_fit(counts, room)
    bins = sum(n for _, n in best)
    least = max(-(-total // room), int(counts[room // 2 + 1 :].sum()))
    # What is left before a step, the steps so far (the last one first), and the step to take.
    stack: list[tuple] = [(counts, (), (), 0, 0, 0)]
    while stack and bins > least and nodes > 0:
        nodes -= 1
        left, plan, pattern, times, used, waste = stack.pop()
        if waste > (bins - 1) * room - total:
            continue
        if times:
            left, plan = left.copy(), (plan, (pattern, times))
            for x in pattern:
                left[x] -= times
        there = np.flatnonzero(left)
        if not len(there):
            if used < bins:
                best, bins = _steps(plan), used
            continue
        if nodes % 40 == 0:
            rest = best_fit(left, room)
            n = sum(k for _, k in rest)
            if used + n < bins:
                best, bins = _steps(plan) + rest, used + n
        top = int(there[-1])
        left[top] -= 1
        found = _fillings(left, room - top, top)
        left[top] += 1
        for lost, fill in reversed(found):
            pattern = (top, *fill)
            times = min(int(left[x]) // pattern.count(x) for x in set(pattern))
            # A filling by at most one piece that dominates all others needs no other number of times.
            for n in [times] if len(found) == 1 and len(fill) < 2 else sorted({1, max(1, times // 2), times}):
                stack.append((left, plan, pattern, n, used + n, waste + lost * n))
    return best


def _steps(plan: tuple) -> list[tuple[Pattern, int]]:
    out = []
    while plan:
        plan, step = plan
        out.append(step)
    return out[::-1]


def places(plan: list[tuple[Pattern, int]]) -> pd.DataFrame:
    """The plan by length: pieces of ``length`` with rank in [low, high) go, ``each`` to a
    sequence, to sequences from ``first`` on, from ``at`` on within it."""
    seen: dict[int, int] = {}
    rows, first = [], 0
    for pattern, times in plan:
        at = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            low = seen.get(length, 0)
            seen[length] = low + each * times
            rows.append((length, low, seen[length], each, first, at))
            at += each * length
        first += times
    return pd.DataFrame(rows, columns=["length", "low", "high", "each", "first", "at"], dtype="int64")


# --- the pieces -----------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch], encode: Callable, room: int, end_id: int, keep_ids: bool):
    part = TaskContext.get().partitionId()
    seen = np.zeros(room + 1, dtype=np.int64)
    row = 0
    end = np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        which, out = [], []
        for k, ids in enumerate(encode(texts)):
            data = memoryview(ids + end)
            n = len(data) // 4
            cuts = [0, *range(n % room or room, n, room), n]
            for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                ids_of = data[4 * a : 4 * b]
                which.append(k)
                out.append((piece, a, b - a, zlib.crc32(ids_of), part, row, int(seen[b - a]), bytes(ids_of) if keep_ids else None))
                seen[b - a] += 1
                row += 1
        if out:
            cols = list(zip(*out, strict=True))
            arrays = [keys.take(pa.array(which)), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:7]]]
            names = ["key", "piece", "start", "length", "ids_crc32", "part", "row", "rank"]
            if keep_ids:
                arrays.append(pa.array(cols[7], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)


def _by_library(texts: list[str], name: str) -> list[bytes]:
    return tokens.encoder(tokens.public(name)).encode(texts)


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    room: int = ROOM,
    end_id: int = END_ID,
    keep_ids: bool = False,
    encode: Callable[[list[str]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset, and the
    ids (little-endian unsigned 32-bit) if ``keep_ids``. ``encode`` may replace the
    tokenizer: texts to ids in that form."""
    spark = docs.sparkSession
    bounded_batches(spark, 500)
    encode = encode or partial(_by_library, name=tokenizer)
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    longs = ["start", "length", "ids_crc32", "part", "row", "rank"]
    schema = T.StructType([slim.schema["key"], T.StructField("piece", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in longs]])
    if keep_ids:
        schema.add("ids", T.BinaryType())
    cut = slim.mapInArrow(lambda b: _pieces(b, encode, room, end_id, keep_ids), schema)
    pieces = materialize(cut, "pieces")
    short = pieces.where(F.col("length") < room)
    counted = materialize(short.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(room, dtype=np.int64)
    for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # fewer than ``room`` rows
        counts[r["length"]] = r["n"]
    plan = spark.createDataFrame(
        places(solve(counts, room)), "length long, low long, high long, each long, first long, at long"
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    keep = ["key", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    ranked = short.join(offsets, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("earlier"))
    # The plan has a few rows for each of fewer than ``room`` lengths, so it may be broadcast.
    at = plan.withColumnRenamed("length", "of")
    met = ranked.join(
        F.broadcast(at), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    )
    turn = F.col("rank") - F.col("low")
    packed = met.select(
        *keep,
        (F.col("first") + F.floor(turn / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + turn % F.col("each") * F.col("length")).alias("offset"),
    )
    full = pieces.where(F.col("length") == room).select(
        *keep, (-1 - F.col("part") * F.lit(1 << 33) - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full).withColumnRenamed("key", key)


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document's pieces and their places in sequences."""
    return pack(table(spark, sf_dir, "documents"))
