"""Operator 2: document fingerprints as invertible Bloom lookup sketches.

A text's paragraphs (its lines; a line of more words than ``UNIT`` counts as several) are
digested, an occurrence number telling repeats apart. A sketch has cells of (count, sum of
digests, sum of check values); each digest goes into three cells. The difference of two
sketches is the sketch of the difference: peeling cells with a single digest recovers the
digests that only one version has. Where peeling gets stuck, both sketches are made again,
four times as large. The likeness of two versions is the share of digests they have in
common, after what was recovered. The fingerprint is the smallest sketch, so equal texts have
equal fingerprints.

Defined cases: a null text is an empty text, with one empty paragraph; repeated rows are
versions of their own; a null key comes last in the descending order, ties are ordered by
text; the only document is its own next; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclecount.llm.common import bounded_batches, materialize, table

UNIT = 16
#: Cells of the smallest sketch (three parts), growth on failure, cells handled at once.
CELLS, GROWTH, AT_ONCE = 15, 4, 1 << 21


def digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests of a text's paragraphs."""
    units = []
    for line in text.split("\n"):
        words = line.split(" ")
        if len(words) <= UNIT:
            units.append(line)
        else:
            units += [" ".join(words[i : i + UNIT]) for i in range(0, len(words), UNIT)]
    seen: dict[int, int] = {}
    out = []
    for u in units:
        data = u.encode("utf-8", "surrogatepass")
        d = xxhash.xxh64_intdigest(data)
        n = seen.get(d, 0)
        seen[d] = n + 1
        out.append(d if not n else xxhash.xxh64_intdigest(data, n))
    return np.array(out, dtype=np.uint64)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Sketches:
    """One sketch of ``cells`` cells for each of ``n`` versions (or differences)."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, dtype=np.int64)
        self.sums = np.zeros(n * cells, dtype=np.uint64)
        self.check = np.zeros(n * cells, dtype=np.uint64)

    def add(self, at: np.ndarray, keys: np.ndarray, signs: np.ndarray) -> None:
        """Add digest ``keys[i]`` to sketch ``at[i]``, ``signs[i]`` times (1 or -1)."""
        third = self.cells // 3
        weight = signs.astype(np.uint64)  # -1 wraps, as the sums do
        check = _mix(keys, 99)
        for j in range(3):
            cell = at * self.cells + j * third + (_mix(keys, self.cells * 3 + j) % np.uint64(third)).astype(np.int64)
            np.add.at(self.count, cell, signs)
            np.add.at(self.sums, cell, keys * weight)
            np.add.at(self.check, cell, check * weight)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Take digests out until no cell holds a single one: the sketches that came out
        empty, and the (sketch, digest, sign) of all that was taken out."""
        found = []
        while True:
            cell = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[cell]
            key = self.sums[cell] * sign.astype(np.uint64)
            pure = self.check[cell] * sign.astype(np.uint64) == _mix(key, 99)
            cell, sign, key = cell[pure], sign[pure], key[pure]
            if not len(cell):
                break
            at = cell // self.cells
            order = np.lexsort((key, at))
            at, key, sign = at[order], key[order], sign[order]
            first = np.ones(len(at), dtype=bool)
            first[1:] = (at[1:] != at[:-1]) | (key[1:] != key[:-1])
            at, key, sign = at[first], key[first], sign[first]
            self.add(at, key, -sign)
            found.append((at, key, sign))
        left = (self.count != 0) | (self.sums != 0) | (self.check != 0)
        done = ~left.reshape(self.n, self.cells).any(axis=1)
        at, key, sign = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 3
        return done, at, key, sign

    def packed(self, i: int) -> str:
        """Sketch ``i`` as text."""
        own = slice(i * self.cells, (i + 1) * self.cells)
        raw = self.count[own].astype("<u2").tobytes() + self.sums[own].astype("<u8").tobytes()
        return base64.b64encode(raw + self.check[own].astype("<u4").tobytes()).decode()


def sketch(versions: list[np.ndarray], cells: int = CELLS) -> Sketches:
    out = Sketches(len(versions), cells)
    if versions:
        at = np.repeat(np.arange(len(versions)), [len(v) for v in versions])
        out.add(at, np.concatenate(versions), np.ones(len(at), dtype=np.int64))
    return out


def differences(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """For each pair the numbers of digests that only the first and only the second has,
    recovered by peeling; pairs that fail are sketched again, larger."""
    out: list[tuple[int, int]] = [(0, 0)] * len(pairs)
    todo, cells = list(range(len(pairs))), CELLS
    while todo:
        failed = []
        step = max(1, AT_ONCE // cells)
        for start in range(0, len(todo), step):
            part = todo[start : start + step]
            table_ = Sketches(len(part), cells)
            for side, sign in ((0, 1), (1, -1)):
                own = [pairs[i][side] for i in part]
                at = np.repeat(np.arange(len(part)), [len(v) for v in own])
                table_.add(at, np.concatenate(own), np.full(len(at), sign, dtype=np.int64))
            done, at, _, sign = table_.peel()
            plus = np.bincount(at[sign > 0], minlength=len(part))
            minus = np.bincount(at[sign < 0], minlength=len(part))
            for k, i in enumerate(part):
                if done[k]:
                    out[i] = (int(plus[k]), int(minus[k]))
                else:
                    failed.append(i)
        todo, cells = failed, cells * GROWTH
    return out


def likeness(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[float]:
    """Shared digests over all digests of each pair."""
    out = []
    for (a, _), (plus, minus) in zip(pairs, differences(pairs), strict=True):
        both = len(a) - plus
        out.append(both / (both + plus + minus) if both + plus + minus else 1.0)
    return out


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first as many characters of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def compare(texts: list[str], following: list[str], own: list[np.ndarray], then: list[np.ndarray]) -> list[pa.Array]:
    """The result columns of texts (digests ``own``) and the texts that follow them."""
    new = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    changed = [digests(t) for t in new]
    prints, changed_prints = sketch(own), sketch(changed)
    near = likeness([*zip(own, changed, strict=True), *zip(own, then, strict=True)])
    n = len(texts)
    values = [
        [len(t) for t in texts],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new],
        [prints.packed(i) for i in range(n)],
        [changed_prints.packed(i) for i in range(n)],
        near[:n],
        near[n:],
    ]
    return [pa.array(v, t) for v, t in zip(values, TYPES, strict=True)]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ``COLUMNS`` of every document, compared with the next in descending key order.

    The texts are dealt once, by ranges of the key; a task walks its range in order. The last
    document of a range meets the first of the next by a join of one row a range.
    """
    bounded_batches(docs.sparkSession, 500)
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("key").desc_nulls_last(), F.xxhash64("text")]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    key_field = dealt.schema["key"]
    fields = [T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in COLUMNS[1:4]]]
    fields += [T.StructField(c, T.DoubleType()) for c in COLUMNS[4:]]
    edge = [T.StructField("part", T.LongType()), T.StructField("edge", T.StringType()), T.StructField("text", T.StringType())]

    def lone(keys: pa.Array, part: int, kind: str, body: str) -> pa.RecordBatch:
        empty = [pa.nulls(1, t) for t in TYPES]
        return pa.RecordBatch.from_arrays(
            [keys, *empty, pa.array([part], pa.int64()), pa.array([kind]), pa.array([body])],
            ["key", *COLUMNS, "part", "edge", "text"],
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: tuple[pa.Array, str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, keys = batch.column(1).to_pylist(), batch.column(0)
            own = [digests(t) for t in texts]
            if held is None:
                yield lone(keys.slice(0, 1), part, "first", texts[0])
            else:
                texts, own = [held[1], *texts], [held[2], *own]
                keys = pa.concat_arrays([held[0], keys])
            n = len(texts) - 1
            held = (keys.slice(n, 1), texts[n], own[n])
            if n:
                out = compare(texts[:n], texts[1:], own[:n], own[1:])
                rest = [pa.nulls(n, t) for t in (pa.int64(), pa.string(), pa.string())]
                yield pa.RecordBatch.from_arrays([keys.slice(0, n), *out, *rest], ["key", *COLUMNS, "part", "edge", "text"])
        if held is not None:
            yield lone(held[0], part, "last", held[1])

    walked = materialize(dealt.mapInArrow(walk, T.StructType([key_field, *fields, *edge])), "fingerprints")
    first = walked.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = walked.where("edge = 'last'").select("key", "part", "text")
    start = walked.where("edge = 'first'").agg(F.min("part")).first()[0]
    after = last.select("part").withColumn("next_part", F.lead("part").over(Window.orderBy("part")))  # one row a range
    after = after.withColumn("next_part", F.coalesce("next_part", F.lit(start).cast("long")))
    met = last.join(after, "part").join(first, "next_part").select("key", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, following = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            if texts:
                out = compare(texts, following, [digests(t) for t in texts], [digests(t) for t in following])
                yield pa.RecordBatch.from_arrays([batch.column(0), *out], ["key", *COLUMNS])

    ends = met.mapInArrow(finish, T.StructType([key_field, *fields]))
    inside = walked.where("edge is null").select("key", *COLUMNS)
    return inside.unionByName(ends).withColumnRenamed("key", key)


def op2_paragraph_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))
