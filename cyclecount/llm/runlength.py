"""Operator 8: removal of repeated passages with a run-length index.

Every ``LENGTH``-byte string of a text is a window. A window's anchor is the least hash of
the substrings of ``ANCHOR`` bytes in it, so equal windows have equal anchors, and
neighbouring windows share theirs: a run of them is one stretch of text. Copies of whole texts
come first: only the one with the smallest key goes on. Of it, only anchors that stand in two
texts matter; the stretches around these go to the bucket of the anchor, distinct ones of a
part of the corpus once, with the smallest key that has them. An anchor with one stretch, or a
stretch none of whose windows has a hash in common with another, needs no comparison.

A bucket builds the run-length Burrows-Wheeler transform of its other distinct stretches. Inside a
run, the match with the preceding suffix is the one of the position before, less one; so
matches are computed from the text at the sampled run ends alone and streamed over the rest.
Suffixes that match in ``LENGTH`` bytes are one passage, whose smallest key says which
stretches repeat an earlier document. The parts get this back as one bit a window, and mark,
cut and digest their own texts, which never leave their part: a part keeps beside them where its
stretches stand, so that its texts are hashed twice and cut into stretches once.

Defined cases: a null text is an empty text; texts shorter than a window keep all; equal keys
don't count as earlier, so repeated rows keep what only they share; null keys come last; an
empty table gives an empty result. Keys must be whole numbers. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclecount.llm.common import bounded_batches, materialize, table
from cyclecount.llm.parts import Part, chunks
from cyclecount.session import scratch_path

LENGTH, ANCHOR = 50, 16
#: Most windows of a stretch (bits of a mask); bytes of corpus text for each bucket.
WINDOWS, BUCKET = 48, 4 << 20
LAST = np.iinfo(np.int64).max
#: Symbols of 9 bits in a number.
PACKED = 7

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_START = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
#: Windows that are hashed at a time, so that the steps stay in the processor's cache.
SLICE = 1 << 14


# --- windows, anchors and stretches ---------------------------------------------------


def flat(bodies: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts side by side, and where each begins and the last one ends."""
    if not len(bodies):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, ends, data = bodies.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[bodies.offset : bodies.offset + len(bodies) + 1].astype(np.int64)
    return np.frombuffer(data or b"", dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _hashes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the ``length`` bytes (a power of two) that start at each place; and an array to use."""
    h, other = _START[data], np.empty(len(data), dtype=np.uint64)
    size = 1
    while size < length:
        x, y = h[:-size], other[: len(h) - size]
        np.multiply(h[size:], _B, out=y)
        np.multiply(x, _A, out=x)
        np.bitwise_xor(x, y, out=x)
        np.right_shift(x, np.uint64(29), out=y)
        np.bitwise_xor(x, y, out=x)
        h, size = x, size * 2
    return h, other


def _least(data: np.ndarray) -> np.ndarray:
    """The least hash of the ``ANCHOR``-byte substrings of each window, by the window's start."""
    h, other = _hashes(data, ANCHOR)
    np.multiply(h, _A, out=h)
    y = other[: len(h)]
    np.right_shift(h, np.uint64(32), out=y)
    np.bitwise_xor(h, y, out=h)
    span, size = LENGTH - ANCHOR + 1, 1
    while size < span:
        step = min(size, span - size)
        y = other[: len(h) - step]
        np.minimum(h[:-step], h[step:], out=y)
        h, other, size = y, h, size + step
    return h


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of neighbouring windows of a text with the same anchor (63 bits): their first windows,
    numbers of windows, anchors and texts. ``ends`` are the texts' bounds in ``data``."""
    n = len(data) - LENGTH + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    least = np.empty(n, dtype=np.uint64)
    for a in range(0, n, SLICE):
        b = min(a + SLICE, n)
        least[a:b] = _least(data[a : b + LENGTH - 1])
    head = np.empty(n, dtype=bool)
    head[0], head[1:] = True, least[1:] != least[:-1]
    stop = np.maximum(ends[:-1], ends[1:] - LENGTH + 1)  # here windows begin to reach into the next text
    for at in (ends[:-1], stop):
        head[at[at < n]] = True
    start = np.flatnonzero(head)
    size = np.diff(np.append(start, n))
    text = np.searchsorted(ends, start, side="right") - 1
    inside = start < stop[text]
    start, size, text = start[inside], size[inside], text[inside]
    anchor = least[start] * _B  # least hashes are small numbers; spread them again
    anchor ^= anchor >> np.uint64(32)
    return start, size, (anchor * _A) >> np.uint64(1), text


def pieces(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and window counts of the stretches that runs are cut into, no longer than ``WINDOWS``;
    and the run of each."""
    parts = -(-size // WINDOWS)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(start, parts) + nth * WINDOWS, np.minimum(np.repeat(size, parts) - nth * WINDOWS, WINDOWS), np.repeat(np.arange(len(start)), parts)


def bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(31)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


# --- the run-length index -------------------------------------------------------------


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of a few strings, each closed by its own end
    mark (end marks are ordered by place), with the suffix samples at the runs' ends."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        flat = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int64) + 1
        ends = self.starts + sizes
        flat[ends] = 0
        self.text = flat
        n = len(flat)
        left = np.repeat(ends, sizes + 1) - np.arange(n)  # bytes up to the end mark
        order, rank, self.packed = self._sort(flat, left, int(sizes.max(initial=0)) + 1)
        before = flat[order - 1]  # row 0's is the last end mark
        head = np.ones(n, dtype=bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        heads = np.flatnonzero(head)
        self.symbols, self.lengths = before[heads], np.diff(np.append(heads, n))
        self.first, self.last = order[heads], order[np.append(heads[1:], n) - 1]  # samples at the run ends
        self.order, self.rank, self.left = order, rank, left

    @staticmethod
    def _sort(flat: np.ndarray, left: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffix order by doubling, only suffixes that still tie being sorted again; suffixes
        equal up to their end marks stay in place order. Also each suffix's place, and its first
        ``PACKED`` symbols as a number."""
        n, step = len(flat), PACKED
        padded = np.concatenate([flat, np.zeros(step, dtype=np.int64)])
        packed = np.zeros(n, dtype=np.int64)
        for i in range(step):
            packed <<= 9
            packed |= padded[i : i + n]
        # no symbols from beyond the end mark
        near = np.flatnonzero(left < step - 1)
        beyond = 9 * (step - 1 - left[near])
        packed[near] = packed[near] >> beyond << beyond
        key = packed
        order = np.argsort(key)
        new = np.ones(n, dtype=bool)  # whether a place's suffix differs from the one before
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, dtype=np.int64)  # the first place of the suffix's ties
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        while True:
            place = np.flatnonzero(~new | ~np.append(new[1:], True))
            if not len(place):
                break
            tied = order[place]
            if step > longest:
                order[place] = tied[np.argsort(rank[tied] * n + tied)]
                break
            after = np.where(left[tied] >= step, rank[np.minimum(tied + step, n - 1)] + 1, 0)
            key = rank[tied] * (n + 1) + after
            by_key = np.argsort(key)
            tied, key = tied[by_key], key[by_key]
            order[place] = tied
            new[place[1:]] = key[1:] != key[:-1]
            rank[tied] = np.maximum.accumulate(np.where(new[place], place, 0))
            step *= 2
        rank[order] = np.arange(n)
        return order, rank, packed

    def matches(self) -> np.ndarray:
        """For each text position, the bytes its suffix shares with the preceding suffix.

        Computed from the text for pairs over a run's border, from the samples; within a run
        each is the value of the position before, less one."""
        i, j = self.first[1:], self.last[:-1]
        most = np.minimum(self.left[i], self.left[j])
        common = np.zeros(len(i), dtype=np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):  # ``PACKED`` symbols at a time; the first that differ tell how many are left
            at = common[live]
            apart = self.packed[i[live] + at] ^ self.packed[j[live] + at]
            bits = np.frexp((apart >> 9).astype(np.float64))[1]  # the last symbol on its own: a double has 53 bits
            same = np.where(apart >> 9, np.maximum(PACKED - 1 - -(-bits // 9), 0), np.where(apart, PACKED - 1, PACKED))
            common[live] = np.minimum(at + same, most[live])
            live = live[(same == PACKED) & (common[live] < most[live])]
        n = len(self.text)
        sampled = np.zeros(n, dtype=bool)
        value = np.zeros(n, dtype=np.int64)
        sampled[i], value[i] = True, common
        sampled[self.first[0]] = True
        sampled[0] = True
        last = np.maximum.accumulate(np.where(sampled, np.arange(n), 0))
        return value[last] - (np.arange(n) - last)

    def least(self, keys: np.ndarray, length: int) -> np.ndarray:
        """For each text position, the smallest of the strings' ``keys`` over all strings with
        the ``length`` bytes that start there."""
        shared = self.matches()[self.order]
        border = np.concatenate([[True], shared[1:] < length])
        start = np.flatnonzero(border)
        string = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(self.text))))
        smallest = np.minimum.reduceat(keys[string[self.order]], start)
        return smallest[np.cumsum(border) - 1][self.rank]


def repeated(strings: list[bytes]) -> np.ndarray:
    """Whether a string has a window whose hash another window of the strings has too: only such can
    be equal to another."""
    data, n = np.frombuffer(b"".join(strings), dtype=np.uint8), np.array([len(s) for s in strings])
    half = 1 << (LENGTH.bit_length() - 1)
    part = np.concatenate([_hashes(data[a : a + SLICE + half - 1], half)[0] for a in range(0, len(data) - half + 1, SLICE)])
    rest = LENGTH - half
    h = (part[: len(part) - rest] * _A) ^ (part[rest:] * _B)
    count = n - LENGTH + 1
    of = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(of)) + np.repeat(np.cumsum(n) - n - (np.cumsum(count) - count), count)
    h = h[at]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    out = np.zeros(len(n), dtype=bool)
    out[of[order[1:][same]]] = out[of[order[:-1][same]]] = True
    return out


def solve_bucket(
    strings: list[list[bytes]], keys: list[np.ndarray], marks: list[np.ndarray]
) -> list[np.ndarray]:
    """For each part's stretches (the smallest key it has for each, and its anchor) the mask
    of windows that a smaller key has anywhere."""
    number: dict[bytes, int] = {}
    which = [np.array([number.setdefault(s, len(number)) for s in part], dtype=np.int64) for part in strings]
    if not number:
        return [np.zeros(0, dtype=np.uint64) for _ in strings]
    distinct = list(number)
    smallest, anchor = np.full(len(distinct), LAST), np.zeros(len(distinct), dtype=np.uint64)
    for ids, own, mark in zip(which, keys, marks, strict=True):
        np.minimum.at(smallest, ids, own)
        anchor[ids] = mark
    _, at, n = np.unique(anchor, return_inverse=True, return_counts=True)
    compared = np.flatnonzero(n[at] > 1)
    if len(compared):
        compared = compared[repeated([distinct[i] for i in compared.tolist()])]
    windows = np.array([len(s) for s in distinct]) - LENGTH + 1
    # A window's smallest key: its stretch's, or a smaller one among those with its anchor.
    starts = np.zeros(len(distinct), dtype=np.int64)
    least = np.zeros(1, dtype=np.int64)
    if len(compared):
        index = RunLengthIndex([distinct[i] for i in compared.tolist()])
        least = index.least(smallest[compared], LENGTH)
        starts[compared] = index.starts
    alone, w = np.ones((len(distinct), 1), dtype=bool), np.arange(WINDOWS)
    alone[compared] = False
    has = windows[:, None] > w
    found = np.where(alone, smallest[:, None], least[starts[:, None] + np.where(has & ~alone, w, 0)])
    found[~has] = LAST
    out = []
    for ids, own in zip(which, keys, strict=True):
        bits = np.zeros((len(ids), 64), dtype=bool)
        bits[:, :WINDOWS] = found[ids] < own[:, None]
        out.append(np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel())
    return out


# --- the parts' texts -----------------------------------------------------------------


class Stretches:
    """The distinct stretches of a part's texts around the wanted anchors, numbered by first
    appearance, and where they stand: rows, starts, window counts and numbers."""

    def __init__(self, wanted: np.ndarray):
        self.wanted = wanted
        self.numbers: dict[bytes, int] = {}
        self.found: list[tuple[np.ndarray, ...]] = []

    def add(self, bodies: pa.BinaryArray, rows: np.ndarray, orders: np.ndarray) -> None:
        """Take in some texts of the part, with their rows and keys."""
        data, ends = flat(bodies)
        start, size, anchor, text = runs(data, ends)
        if not len(start) or not len(self.wanted):
            return
        there = np.minimum(np.searchsorted(self.wanted, anchor), len(self.wanted) - 1)
        keep = self.wanted[there] == anchor
        start, size, run = pieces(start[keep], size[keep])
        anchor, text = anchor[keep][run], text[keep][run]
        blob, numbers = data.tobytes(), self.numbers
        stop = (start + size + (LENGTH - 1)).tolist()
        which = [numbers.setdefault(blob[i:j], len(numbers)) for i, j in zip(start.tolist(), stop, strict=True)]
        self.found.append((rows[text], start - ends[text], size, np.array(which, dtype=np.int64), orders[text], anchor))

    def columns(self) -> tuple[np.ndarray, ...]:
        """Rows, starts, window counts and numbers of all; by number the smallest key and the anchor."""
        kinds = (np.int64, np.int64, np.int64, np.int64, np.int64, np.uint64)
        row, start, size, which, order, anchor = (
            np.concatenate([np.zeros(0, dtype=t), *c]) for t, c in zip(kinds, zip(*self.found) if self.found else [()] * 6, strict=True)
        )
        keys, marks = np.full(len(self.numbers), LAST), np.zeros(len(self.numbers), dtype=np.uint64)
        np.minimum.at(keys, which, order)
        marks[which] = anchor
        return row, start, size, which, keys, marks


def marked(n: int, start: np.ndarray, size: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Of ``n`` windows those whose bit is set in the masks of the stretches."""
    gone = np.zeros(n, dtype=bool)
    some = bits != 0
    start, size, bits = start[some], size[some], bits[some]
    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    gone[np.repeat(start, size) + nth] = (np.repeat(bits, size) >> nth.astype(np.uint64)) & np.uint64(1)
    return gone


def cut(data: bytes, gone: np.ndarray) -> tuple[bytes, int, int]:
    """Without the bytes of the windows that start where ``gone`` is true: what is left, the
    bytes removed and the spans removed."""
    if not gone.any():
        return data, 0, 0
    steps = np.zeros(len(data) + 1, dtype=np.int64)
    at = np.flatnonzero(gone)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + LENGTH, -1)
    covered = np.cumsum(steps[:-1]) > 0
    spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
    return np.frombuffer(data, dtype=np.uint8)[~covered].tobytes(), int(covered.sum()), spans


#: A text's digest, key and row in its part.
COPY = np.dtype([("h", "<u8", (2,)), ("key", "<i8"), ("row", "<u4")])


def _blob(values, kind: str) -> bytes:
    return np.array(values, dtype=kind).tobytes()


def _send(part: int, rows: np.ndarray, bucket: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A part's rows as one message a bucket; bucket 0 always, as it tells of the part."""
    order = np.argsort(bucket, kind="stable")
    rows, ends = rows[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
    sent = [b for b in range(buckets) if b == 0 or ends[b] < ends[b + 1]]
    blobs = [rows[ends[b] : ends[b + 1]].tobytes() for b in sent]
    columns = [pa.array(sent, pa.int64()), pa.array([part] * len(sent), pa.int64()), pa.array(blobs, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "part", "blob"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """Per document: key, n_bytes, n_removed, n_spans, kept_sha256, and what is left of the
    text (binary: a cut can fall inside a character) if ``keep_text``."""
    spark = docs.sparkSession
    bounded_batches(spark, 500)
    folder = scratch_path(spark, "repeat-parts")
    slim = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(key).cast("long"), F.lit(int(LAST))).alias("order"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"),
    )
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keep the part's texts; send each text's digest, key and row by bucket."""
        for part, kept in chunks(batches):
            Part(folder, part).write(kept)
            digest = b"".join([xxhash.xxh3_128_digest(b.as_buffer()) for k in kept for b in k.column(2)])
            rows = np.zeros(len(digest) // 16, dtype=COPY)
            rows["h"] = np.frombuffer(digest, dtype="<u8").reshape(-1, 2)
            rows["key"] = np.concatenate([k.column(1).to_numpy() for k in kept])
            rows["row"] = np.arange(len(rows))
            yield _send(part, rows, (rows["h"][:, 0] % np.uint64(buckets)).astype(np.int64), buckets)

    def copies(pdf: pd.DataFrame) -> pd.DataFrame:
        """The rows of each part whose whole text a smaller key has."""
        parts = [np.frombuffer(b, dtype=COPY) for b in pdf["blob"]]
        rows = np.concatenate(parts)
        order = np.lexsort((rows["key"], rows["h"][:, 0], rows["h"][:, 1]))
        h = rows["h"][order]
        first = np.ones(len(rows), dtype=bool)
        first[1:] = (h[1:] != h[:-1]).any(axis=1)
        least = np.empty(len(rows), dtype=np.int64)
        least[order] = rows["key"][order][np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))]
        again = least < rows["key"]
        ends = np.cumsum([0, *map(len, parts)])
        blobs = [p["row"][again[a:b]].tobytes() for p, a, b in zip(parts, ends[:-1], ends[1:], strict=True)]
        out = pd.DataFrame({"part": pdf["part"], "kind": -2, "blob": blobs})
        return out[(out["blob"].map(len) > 0) | (pdf["bucket"] == 0)]

    told = "part long, kind long, blob binary"
    kept = slim.mapInArrow(keep, "bucket long, part long, blob binary")
    again = materialize(kept.groupBy("bucket").applyInPandas(copies, told), "repeat-copies")

    def copied(pdf: pd.DataFrame) -> np.ndarray:
        rows = [np.frombuffer(b, dtype="<u4") for b in pdf.loc[pdf["kind"] == -2, "blob"]]
        return np.concatenate([np.zeros(0, dtype="<u4"), *rows])

    def texts(part: int, left_out: np.ndarray) -> Iterator[tuple[pa.BinaryArray, np.ndarray, np.ndarray]]:
        """The texts of a part that aren't copies, with their rows and keys."""
        row = 0
        for batch in Part(folder, part).read():
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            kept = np.flatnonzero(~np.isin(rows, left_out))
            yield batch.column(2).take(pa.array(kept)), rows[kept], batch.column(1).to_numpy()[kept]

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        """A part's distinct anchors, by bucket, the lowest bit telling whether several of
        its texts have them."""
        part = int(pdf["part"].iloc[0])
        found, rows = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for bodies, row, _ in texts(part, copied(pdf)):
            _, _, anchor, text = runs(*flat(bodies))
            found.append(anchor)
            rows.append(row[text])
        found, rows = np.concatenate(found), np.concatenate(rows)
        order = np.argsort(found)
        found, rows = found[order], rows[order]
        first = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, dtype=np.int64)
        hashes, several = found[first], np.zeros(len(first), dtype=bool)
        if len(first):
            several = np.minimum.reduceat(rows, first) < np.maximum.reduceat(rows, first)
        packed = (hashes << np.uint64(1)) | several.astype(np.uint64)
        return _send(part, packed.astype("<u8"), bucket_of(hashes, buckets), buckets).to_pandas()

    def shared(pdf: pd.DataFrame) -> pd.DataFrame:
        """The anchors of each part that several texts have."""
        parts = [np.frombuffer(b, dtype="<u8") for b in pdf["blob"]]
        packed = np.concatenate(parts)
        _, at, n = np.unique(packed >> np.uint64(1), return_inverse=True, return_counts=True)
        many = n > 1
        many[at[(packed & np.uint64(1)) == 1]] = True
        twice = many[at]
        ends = np.cumsum([0, *map(len, parts)])
        blobs = [(p[twice[a:b]] >> np.uint64(1)).tobytes() for p, a, b in zip(parts, ends[:-1], ends[1:], strict=True)]
        out = pd.DataFrame({"part": pdf["part"], "kind": -1, "blob": blobs})
        return out[out["blob"].map(len) > 0]

    n_parts = max(1, again.select("part").distinct().count())
    gathered = again.repartition(n_parts, "part").groupBy("part").applyInPandas(gather, "bucket long, part long, blob binary")
    dups = materialize(gathered.groupBy("bucket").applyInPandas(shared, told), "repeat-anchors")
    known = again.unionByName(dups)

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        """A part's distinct stretches, by bucket; where they stand stays with the part."""
        part = int(pdf["part"].iloc[0])
        wanted = [np.frombuffer(b, dtype="<u8") for b in pdf.loc[pdf["kind"] == -1, "blob"]]
        held = Stretches(np.sort(np.concatenate([np.zeros(0, dtype="<u8"), *wanted])))
        for some in texts(part, copied(pdf)):
            held.add(*some)
        row, start, size, which, keys, marks = held.columns()
        bucket = bucket_of(marks, buckets)
        places = [row.astype(np.uint32), start.astype(np.uint32), size.astype(np.uint8), which.astype(np.uint32)]
        Part(folder, part, "places").write([pa.RecordBatch.from_arrays(list(map(pa.array, places)), ["row", "start", "size", "which"])], 1 << 20)
        Part(folder, part, "keys").write([pa.RecordBatch.from_arrays([pa.array(keys), pa.array(bucket)], ["key", "bucket"])], 1 << 20)
        order = np.argsort(bucket, kind="stable")
        strings = list(held.numbers)
        first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        rows = []
        for ids in np.split(order, first[1:]) if len(order) else ():
            mine = [strings[i] for i in ids.tolist()]
            rows.append((int(bucket[ids[0]]), part, b"".join(mine), _blob([len(x) for x in mine], "<u2"), _blob(keys[ids], "<i8"), _blob(marks[ids], "<u8")))
        return pd.DataFrame(rows, columns=["bucket", "part", "strings", "sizes", "keys", "marks"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        strings = []
        for blob, sizes in zip(pdf["strings"], pdf["sizes"], strict=True):
            ends = np.cumsum(np.frombuffer(sizes, dtype="<u2").astype(np.int64)).tolist()
            strings.append([blob[a:b] for a, b in zip([0, *ends], ends, strict=False)])
        keys = [np.frombuffer(b, dtype="<i8") for b in pdf["keys"]]
        masks = solve_bucket(strings, keys, [np.frombuffer(b, dtype="<u8") for b in pdf["marks"]])
        return pd.DataFrame({"part": pdf["part"], "kind": pdf["bucket"], "blob": [_blob(m, "<u8") for m in masks]})

    sent = known.repartition(n_parts, "part").groupBy("part").applyInPandas(
        send, "bucket long, part long, strings binary, sizes binary, keys binary, marks binary"
    )
    # Given numbers of partitions: the work is in the tasks, not in the bytes they read.
    solved = sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(solve, told)
    both = known.unionByName(solved).repartition(n_parts, "part")

    key_field = slim.schema["key"]
    longs = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([key_field, *longs, T.StructField("kept_sha256", T.StringType())])
    if keep_text:
        schema.add("kept", T.BinaryType())

    def finish(table_: pa.Table) -> pa.Table:
        """Mark, cut and digest a part's texts."""
        pdf = table_.to_pandas()
        part = int(pdf["part"].iloc[0])
        left_out = copied(pdf)
        kept = Part(folder, part, "keys").whole()
        keys, masks = kept["key"].to_numpy(), np.zeros(len(kept), dtype="<u8")
        solved = pdf[pdf["kind"] >= 0].sort_values("kind")["blob"]
        masks[np.argsort(kept["bucket"].to_numpy(), kind="stable")] = np.frombuffer(b"".join(solved), dtype="<u8")
        places = Part(folder, part, "places").whole()
        rows, start, size, which = (places[c].to_numpy().astype(np.int64) for c in ("row", "start", "size", "which"))
        out, row = [], 0
        for batch in Part(folder, part).read():
            orders, bodies = batch.column(1).to_numpy(), batch.column(2)
            data, ends = flat(bodies)
            a, b = np.searchsorted(rows, [row, row + batch.num_rows])
            text = rows[a:b] - row
            # a smaller key of the part itself has the whole stretch
            bits = np.where(keys[which[a:b]] < orders[text], ~np.uint64(0), masks[which[a:b]])
            gone = marked(len(data), start[a:b] + ends[text], size[a:b], bits)
            copy = np.isin(np.arange(row, row + batch.num_rows), left_out).tolist()
            row += batch.num_rows
            told = []
            for i, j, whole in zip(ends[:-1].tolist(), ends[1:].tolist(), copy, strict=True):
                mine = gone[i : max(i, j - LENGTH + 1)]
                if whole:
                    mine[:] = True
                left, removed, spans = cut(data[i:j].tobytes(), mine)
                told.append((j - i, removed, spans, hashlib.sha256(left).hexdigest(), *([left] if keep_text else [])))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*told, strict=True), kinds, strict=False)]
            out.append(pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names))
        return pa.Table.from_batches(out)

    return both.groupBy("part").applyInArrow(finish, schema).withColumnRenamed("key", key)


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document without the passages of 50 bytes and more that a
    document with a smaller doc_id has."""
    return remove_repeats(table(spark, sf_dir, "documents"))
