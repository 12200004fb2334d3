"""Operator 6: SimHash near-duplicates by a binary-trie self-join.

A fingerprint has a bit set where over half the XXH64 values (seed 42) of the text's word
shingles have it. Distinct fingerprints stand in a binary trie, one bit a level, the most
balanced bits first (Hamming distance doesn't depend on the order). The join walks pairs of
nodes together, adds up the bits in which their paths differ, and drops a pair as soon as
the sum exceeds the budget. The top of the trie is cut, from counts by prefix, into leaves
of bounded size; each leaf meets the leaves within the budget, and the walk goes on inside
each such pair of leaves in one task, on sorted arrays. A task returns a spanning forest of
its links, not all pairs; connected components of the forests give the groups.

Defined cases: null and empty texts, and texts of white space, have fingerprint 0 and link
like any other; a text with fewer words than a shingle has one shingle, all its words;
repeated rows are documents with equal fingerprints; the component id is the smallest key in
the group (null if all keys are null). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclecount.llm.common import bounded_batches, components, materialize, min_labels, table

SHINGLE, MAX_BITS, SEED = 3, 2, 42
#: The most distinct fingerprints of a leaf, as far as TOP bits can part them.
LEAF, TOP = 150_000, 14


def fingerprint(data: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of UTF-8 text; words part at ASCII white space, A-Z is lowered."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, SEED) for p in parts], dtype="<u8")
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = (2 * bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def row_hash(docs: DataFrame) -> Column:
    """A hash of a row's every column (columns of map type aren't supported)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """key, row_hash and fp (the fingerprint's bits as a signed long) of every document."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([fingerprint(t, shingle) for t in part], dtype="uint64").astype("int64")

    return docs.select(F.col(key), row_hash(docs).alias("row_hash"), of(F.col(text).cast("binary")).alias("fp"))


# --- the trie -------------------------------------------------------------------------


def _leaves(counts: dict[int, int], limit: int) -> list[tuple[int, int]]:
    """Cut the trie of TOP-bit prefixes into leaves (depth, prefix) of at most ``limit``
    fingerprints, deeper where they are dense."""
    out, stack = [], [(0, 0)]
    values = np.array(sorted(counts), dtype=np.int64)
    sums = np.concatenate([[0], np.cumsum([counts[v] for v in values.tolist()])])
    while stack:
        depth, prefix = stack.pop()
        lo, hi = prefix << (TOP - depth), (prefix + 1) << (TOP - depth)
        n = sums[np.searchsorted(values, hi)] - sums[np.searchsorted(values, lo)]
        if n == 0:
            continue
        if n <= limit or depth == TOP:
            out.append((depth, prefix))
        else:
            stack += [(depth + 1, 2 * prefix + 1), (depth + 1, 2 * prefix)]
    return out


def _leaf_pairs(leaves: list[tuple[int, int]], budget: int) -> dict[int, list[int]]:
    """For each leaf's number the numbers of the leaves (itself included) whose paths differ
    in at most ``budget`` bits, by walking pairs of nodes of the top trie together."""
    number = {leaf: i for i, leaf in enumerate(leaves)}
    inner = {(k, p >> (d - k)) for d, p in leaves for k in range(d)}
    out: dict[int, list[int]] = {i: [] for i in range(len(leaves))}

    def below(node: tuple[int, int]) -> list[tuple[int, int]]:
        d, p = node
        both = ((d + 1, 2 * p), (d + 1, 2 * p + 1))
        return [c for c in both if c in number or c in inner]

    root = (0, 0)
    stack = [(root, root, 0)] if root in number or root in inner else []
    while stack:
        a, b, dist = stack.pop()
        if a in number and b in number:
            i, j = number[a], number[b]
            out[i].append(j)
            if i != j:
                out[j].append(i)
            continue
        lefts = [a] if a in number else below(a)
        rights = [b] if b in number else below(b)
        for x in lefts:
            for y in rights:
                if a == b and x > y:
                    continue
                depth = min(x[0], y[0])
                d = ((x[1] >> (x[0] - depth)) ^ (y[1] >> (y[0] - depth))).bit_count()
                if d <= budget:
                    stack.append((x, y, d))
    return out


def _walk(x: np.ndarray, y: np.ndarray, same: bool, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into sorted x and y) of fingerprints within ``budget`` bits.

    All node pairs of a level are walked at once: a node is a range of a sorted array, its
    children part where the level's bit turns to one. Pairs with few combinations left are
    compared outright.
    """

    def zeros(v: np.ndarray, bit: int) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(((v >> np.uint64(bit)) & np.uint64(1)) == 0)]).astype(np.int32)

    def compare(xl, xh, yl, yh):
        w = (xh - xl).astype(np.int64) * (yh - yl)
        for at in range(0, len(w), 20_000):
            n, lx, ly, hy = (v[at : at + 20_000] for v in (w, xl, yl, yh))
            own = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            width = (hy - ly)[own]
            i, j = lx[own] + k // width, ly[own] + k % width
            near = np.bitwise_count(x[i] ^ y[j]) <= budget
            if same:
                near &= i < j
            if near.any():
                yield i[near], j[near]

    pairs = [np.array([v], dtype=np.int32) for v in (0, len(x), 0, len(y))] + [np.zeros(1, dtype=np.int8)]
    for bit in range(63, -1, -1):
        if not len(pairs[0]):
            return
        xl, xh, yl, yh, d = pairs
        few = (xh - xl).astype(np.int64) * (yh - yl) <= 64
        if few.any():
            yield from compare(xl[few], xh[few], yl[few], yh[few])
            xl, xh, yl, yh, d = (v[~few] for v in pairs)
        zx, zy = zeros(x, bit), zeros(y, bit)
        xm, ym = xl + zx[xh] - zx[xl], yl + zy[yh] - zy[yl]
        kids = []
        for ax, bx, u in ((xl, xm, 0), (xm, xh, 1)):
            for ay, by, v in ((yl, ym, 0), (ym, yh, 1)):
                keep = (bx > ax) & (by > ay) & (d + (u != v) <= budget)
                if same:
                    keep &= ax < by  # the mirror image is walked elsewhere
                kids.append([w[keep] for w in (ax, bx, ay, by, (d + (u != v)).astype(np.int8))])
        pairs = [np.concatenate(c) for c in zip(*kids, strict=True)]
    if len(pairs[0]):
        yield from compare(*pairs[:4])


def _forest(budget: int):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        left = np.sort(pdf.loc[pdf["side"] == 0, "bits"].to_numpy().view(np.uint64))
        right = np.sort(pdf.loc[pdf["side"] == 1, "bits"].to_numpy().view(np.uint64))
        same = bool(pdf["alone"].iloc[0])
        all_ = left if same else np.concatenate([left, right])
        label = np.arange(len(all_))
        for i, j in _walk(left, left if same else right, same, budget):
            j = j if same else j + len(left)
            root = min_labels(len(all_), np.concatenate([np.arange(len(all_)), i]), np.concatenate([label, j]))
            label = root
        linked = np.flatnonzero(label != np.arange(len(all_)))
        return pd.DataFrame({"a": all_[linked].view(np.int64), "b": all_[label[linked]].view(np.int64)})

    return solve


def _permute(bits: Column, order: list[int]) -> Column:
    """The bits of a long in another order, the first of ``order`` highest."""
    out = F.lit(0).cast("long")
    for place, bit in enumerate(order):
        one = F.shiftrightunsigned(bits, bit).bitwiseAND(F.lit(1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(one, 63 - place))
    return out


def links(distinct: DataFrame, budget: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """Spanning-forest edges (a, b) of the links among distinct fingerprints ``fp``."""
    ones = distinct.agg(
        F.count("*").alias("n"),
        *[F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(F.lit(1).cast("long"))).alias(f"b{i}") for i in range(64)],
    ).first()
    order = sorted(range(64), key=lambda i: abs(2 * (ones[f"b{i}"] or 0) - ones["n"]))
    turned = materialize(distinct.select(_permute(F.col("fp"), order).alias("bits")), "trie")
    top = F.shiftrightunsigned("bits", 64 - TOP)
    counts = {r[0]: r[1] for r in turned.groupBy(top.alias("p")).count().collect()}  # at most 2^TOP rows
    leaves = _leaves(counts, leaf)
    partners = {i: np.array(met, dtype=np.int64) for i, met in _leaf_pairs(leaves, budget).items()}
    starts = np.array([p << (TOP - d) for d, p in leaves], dtype=np.int64)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bits = pdf["bits"].to_numpy()
            at = np.searchsorted(starts, (bits.view(np.uint64) >> np.uint64(64 - TOP)).astype(np.int64), side="right") - 1
            for i in np.unique(at).tolist():
                mine, met = bits[at == i], partners[i]
                yield pd.DataFrame(
                    {
                        "first": np.repeat(np.minimum(i, met), len(mine)),
                        "second": np.repeat(np.maximum(i, met), len(mine)),
                        "side": np.repeat((met < i).astype(np.int64), len(mine)),
                        "alone": np.repeat(met == i, len(mine)),
                        "bits": np.tile(mine, len(met)),
                    }
                )

    dealt = turned.mapInPandas(deal, "first long, second long, side long, alone boolean, bits long")
    edges = dealt.groupBy("first", "second").applyInPandas(_forest(budget), "a long, b long")
    back = [0] * 64
    for place, bit in enumerate(order):
        back[63 - bit] = 63 - place
    return edges.select(_permute(F.col("a"), back).alias("a"), _permute(F.col("b"), back).alias("b"))


def groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = MAX_BITS
) -> DataFrame:
    """key, fp and component_id of every document."""
    prints, named = _named(docs, key, text, shingle, budget)
    return prints.join(named, F.col("fp") == F.col("_fp")).select(key, "fp", F.col("least.key").alias("component_id"))


def _named(docs: DataFrame, key: str, text: str, shingle: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """The documents' fingerprints, and for each distinct one its group's first document:
    ``least`` (no key last, then the smallest key, then the row hash)."""
    prints = materialize(fingerprints(docs, key, text, shingle), "simhash")
    first = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "row_hash")
    distinct = materialize(prints.groupBy("fp").agg(F.min(first).alias("least")), "simhash-distinct")
    roots = components(links(distinct, budget))
    linked = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    linked = linked.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("least"))
    return prints, linked.drop("least").join(smallest, "root").select(F.col("fp").alias("_fp"), "root", "least")


def dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = MAX_BITS
) -> DataFrame:
    """One document of each group: the one with the smallest key (then row hash); of rows
    repeated in every column, one."""
    _, named = _named(docs, key, text, shingle, budget)
    kept = named.select(F.col("least.key").alias("_key"), F.col("least.row_hash").alias("_kept")).distinct()
    whole = docs.select(
        F.col(key).alias("_id"), row_hash(docs).alias("_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    )
    met = whole.join(kept, F.col("_id").eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_kept")), "left_semi")
    one = Window.partitionBy("_id", "_hash").orderBy(F.lit(0))
    return met.withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*")


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint and group of every document."""
    found = groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
