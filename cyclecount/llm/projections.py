"""Operator 13: approximate nearest neighbours by few stable projections and kd-trees.

Vectors are projected to ``dims`` dimensions by a Gaussian matrix. The distribution is stable: the
squared projected distance of two vectors, divided by their squared distance, is chi-square
with ``dims`` degrees of freedom whatever the vectors are. So neighbours are taken in the order of
their projected distance and verified on the original vectors, and the search stops when a
row that is nearer than the k-th best so far would, with probability ``sure``, have come by now:
when the next projected distance, squared, is at least the chi-square quantile times the
squared k-th distance.

The index is a kd-tree over the projections. Its upper splits, fitted to a bounded sample of
``SAMPLE`` vectors, part all vectors into cells; a cell's vectors are dealt by hash into blocks of
bounded size, and each block is cut further down to leaves of ``LEAF`` vectors and written, in
leaf order, to a file of the shared folder. Every row is in the index. A query first searches
the cell it lies in; its k-th distance there bounds what other cells can hold, and it is sent
to those whose box, in the projections, is nearer than the bound allows. Queries of a cell
come in batches that read the cell's blocks one by one, so the vectors are shuffled once,
for the index, and never dealt to queries.

Equal vectors are one entry with the few smallest ids that can matter, so a vector that a
third of the rows share is one point.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part;
shorter vectors count as padded with zeros; rows without an id are candidates, last among
ties; rows repeated with id and vector are rows of their own, and a query leaves out one row of
its own id and vector; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclecount.llm.common import bounded_batches, materialize, open_folder, table
from cyclecount.session import scratch_path

K = 10
#: Projected dimensions, and how sure the stopping test is.
DIMS, SURE = 16, 0.95
#: Vectors that the upper splits are fitted to; most cells; bytes of a block's vectors, which
#: with their width give its rows; vectors of a leaf; queries that a task should have of a cell.
SAMPLE, CELLS, BLOCK_BYTES, LEAF, QUERIES = 16_384, 1024, 4 << 20, 32, 256


def chi_square_cdf(x: float, n: int) -> float:
    """Probability that a chi-square variable with ``n`` degrees of freedom is at most ``x``."""
    if x <= 0:
        return 0.0
    a, h = n / 2, x / 2
    if h > a + 40 * math.sqrt(a) + 40:
        return 1.0
    term = total = 1 / a
    i = a
    while term > total * 1e-16:
        i += 1
        term *= h / i
        total += term
    return min(1.0, total * math.exp(a * math.log(h) - h - math.lgamma(a)))


def chi_square_quantile(p: float, n: int) -> float:
    low, high = 0.0, 2.0 * n
    while chi_square_cdf(high, n) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, n) < p else (low, mid)
    return high


def takes_part(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast("double"))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _arrow_matrix(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    if len(column) and (np.diff(at) == width).all():
        return flat[at[0] : at[-1]].astype(np.float64).reshape(len(column), width)
    for i in range(len(column)):
        out[i, : at[i + 1] - at[i]] = flat[at[i] : at[i + 1]]
    return out


class Splits:
    """A complete kd-tree of ``depth`` levels over a sample; its leaves are the cells."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.dim = np.zeros(1 << depth, dtype=np.int64)
        self.cut = np.zeros(1 << depth)
        nodes = {1: np.arange(len(sample))}
        for node in range(1, 1 << depth):
            index = nodes.pop(node)
            mine = sample[index]
            if len(mine):
                self.dim[node] = (mine.max(0) - mine.min(0)).argmax()
                self.cut[node] = np.median(mine[:, self.dim[node]])
            right = mine[:, self.dim[node]] > self.cut[node]
            nodes[2 * node], nodes[2 * node + 1] = index[~right], index[right]

    def cells(self, points: np.ndarray) -> np.ndarray:
        at = np.ones(len(points), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + (points[np.arange(len(points)), self.dim[at]] > self.cut[at])
        return at - (1 << self.depth)


def leaf_order(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """A kd-tree over ``points``: their order by leaf, and each leaf's first place."""
    order, starts, stack = np.arange(len(points)), [], [(0, len(points))]
    while stack:
        low, high = stack.pop()
        mine = points[order[low:high]]
        if high - low <= leaf:
            starts.append(low)
            continue
        d = int((mine.max(0) - mine.min(0)).argmax())
        half = (high - low) // 2
        order[low:high] = order[low:high][np.argpartition(mine[:, d], half)]
        stack += [(low, low + half), (low + half, high)]
    return order, np.array(sorted(starts), dtype=np.int64)


def box_distances(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of ``point`` from the boxes."""
    away = np.maximum(low - point, 0) + np.maximum(point - high, 0)
    return (away**2).sum(-1)


class Block:
    """A block of the index as it is read from its file."""

    def __init__(self, batch: pa.Table, matrix: np.ndarray):
        self.vectors = _arrow_matrix(batch["v"].combine_chunks(), len(matrix))
        self.points = self.vectors @ matrix
        starts = np.flatnonzero(np.diff(batch["leaf"].to_numpy(), prepend=-1))
        self.starts, self.ends = starts, np.append(starts[1:], len(self.points))
        self.low = np.minimum.reduceat(self.points, starts)
        self.high = np.maximum.reduceat(self.points, starts)
        ids = batch["ids"].combine_chunks()
        self.ids, self.weight = ids, pc.list_value_length(ids).to_numpy()
        first = pc.list_element(ids, 0)
        rank = np.empty(len(first), dtype=np.int64)
        rank[pc.sort_indices(first, null_placement="at_end").to_numpy()] = np.arange(len(first))
        self.rank = rank

    def search(self, query: np.ndarray, point: np.ndarray, want: int, reach: float, quantile: float) -> tuple[list, int]:
        """(distance, entry) of the entries that hold the ``want`` nearest rows, as far as the
        stopping test lets the search go; ``reach`` is a distance that as many rows elsewhere
        are within. Also how many vectors were verified."""
        box = box_distances(self.low, self.high, point)
        leaves = np.argsort(box, kind="stable")
        opened, step, verified = 0, 4, 0
        pool = np.zeros(0, dtype=np.int64)
        pool_far = np.zeros(0)
        best, best_far = np.zeros(0, dtype=np.int64), np.zeros(0)
        while True:
            # the next projected neighbours: those nearer than any leaf that isn't open
            limit = quantile * reach**2
            frontier = box[leaves[opened]] if opened < len(leaves) else np.inf
            due = pool_far <= min(frontier, limit)
            if due.any():
                taken = pool[due]
                keep = ~due & (pool_far < limit)
                pool, pool_far = pool[keep], pool_far[keep]
                far = np.sqrt(((self.vectors[taken] - query) ** 2).sum(1))
                verified += len(taken)
                near = far <= reach
                best, best_far = np.append(best, taken[near]), np.append(best_far, far[near])
                order = np.lexsort((self.rank[best], best_far))
                rows = np.cumsum(self.weight[best[order]])
                order = order[: int(np.searchsorted(rows, want)) + 1]
                best, best_far = best[order], best_far[order]
                if len(rows) and rows[-1] >= want:
                    reach = min(reach, float(best_far[-1]))
                    limit = quantile * reach**2
            if frontier >= limit or opened == len(leaves):
                break
            now = leaves[opened : opened + step]
            now = now[box[now] <= limit]
            opened, step = opened + len(now), min(2 * step, 32)
            index = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in now])
            far = ((self.points[index] - point) ** 2).sum(1)
            pool, pool_far = np.append(pool, index[far <= limit]), np.append(pool_far, far[far <= limit])
        return list(zip(best_far.tolist(), best.tolist(), strict=True)), verified


class Index:
    """The written index: matrix, upper splits, and for each cell its box and blocks."""

    def __init__(self, folder: str, matrix: np.ndarray, splits: Splits, low, high, blocks: np.ndarray):
        self.folder, self.matrix, self.splits = folder, matrix, splits
        self.low, self.high, self.blocks = low, high, blocks

    def block(self, cell: int, number: int) -> Block:
        fs, path = open_folder(self.folder)
        with fs.open_input_file(f"{path}/cell-{cell}-{number}.arrow") as source:
            return Block(pa.ipc.open_file(source).read_all(), self.matrix)


def build(data: DataFrame, key: str, vector: str, keep: int, dims: int = DIMS) -> Index | None:
    """Index every vector of ``data`` that takes part, with its ``keep`` smallest ids. Null where
    there is none."""
    spark = data.sparkSession
    bounded_batches(spark, 2000)
    rows = data.where(takes_part(F.col(vector))).select(F.col(key).alias("id"), F.col(vector).alias("v"))
    order = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    few = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep)
    few = few.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("_n", "id"))).alias("ids"))
    points = materialize(few.select("v", F.transform("ids", lambda s: s["id"]).alias("ids")), "ann-points")
    n, width = points.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return None
    matrix = np.random.default_rng(13).standard_normal((width, dims))
    sample = points.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE).toArrow()  # bounded
    projected = _arrow_matrix(sample["v"].combine_chunks(), width) @ matrix
    per_block = max(LEAF, BLOCK_BYTES // (8 * width))
    depth = min(max(0, math.ceil(math.log2(n / per_block))), int(math.log2(CELLS)))
    splits = Splits(projected, depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = splits.cells(_arrow_matrix(batch["v"], width) @ matrix)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "cell"])

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _arrow_matrix(batch["v"], width) @ matrix
            at = splits.cells(p)
            out = [(c, int((at == c).sum()), p[at == c].min(0), p[at == c].max(0)) for c in np.unique(at)]
            lists = [pa.array([x[i].tolist() for x in out], pa.list_(pa.float64())) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), *lists],
                ["cell", "n", "low", "high"],
            )

    summary = points.select("v").mapInArrow(boxes, "cell long, n long, low array<double>, high array<double>")
    summary = summary.groupBy("cell").agg(
        F.sum("n").alias("n"),
        F.array(*[F.min(F.col("low")[i]) for i in range(dims)]).alias("low"),
        F.array(*[F.max(F.col("high")[i]) for i in range(dims)]).alias("high"),
    )
    low, high = np.full((1 << depth, dims), np.inf), np.full((1 << depth, dims), -np.inf)
    blocks = np.zeros(1 << depth, dtype=np.int64)
    for r in summary.collect():  # one row a cell, at most CELLS
        low[r["cell"]], high[r["cell"]], blocks[r["cell"]] = r["low"], r["high"], -(-r["n"] // per_block)
    folder = scratch_path(spark, "ann-index")

    def write(batch: pa.Table) -> pa.Table:
        cell, number = batch["cell"][0].as_py(), batch["block"][0].as_py()
        order, starts = leaf_order(_arrow_matrix(batch["v"].combine_chunks(), width) @ matrix)
        leaf = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        kept = batch.select(["v", "ids"]).take(pa.array(order)).append_column("leaf", pa.array(leaf))
        fs, path = open_folder(folder)
        fs.create_dir(path, recursive=True)
        temp = f"{path}/_{uuid.uuid4().hex}"
        with fs.open_output_stream(temp) as sink, pa.ipc.new_file(sink, kept.schema) as writer:
            writer.write_table(kept)
        fs.move(temp, f"{path}/cell-{cell}-{number}.arrow")  # named when it is complete
        return pa.table({"cell": [cell], "block": [number], "n": [len(order)]})

    schema = f"v {points.schema['v'].dataType.simpleString()}, ids {points.schema['ids'].dataType.simpleString()}, cell long"
    counts = F.array(*[F.lit(int(b)) for b in blocks])
    dealt = points.mapInArrow(place, schema)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(13), "v"), F.get(counts, F.col("cell").cast("int"))))
    dealt = dealt.repartition(max(1, min(4096, int(blocks.sum()))), "cell", "block")
    written = dealt.groupBy("cell", "block").applyInArrow(write, "cell long, block long, n long")
    if materialize(written, "ann-blocks").agg(F.sum("n")).first()[0] != n:
        raise RuntimeError("the index doesn't hold every vector")
    return Index(folder, matrix, splits, low, high, blocks)


def _searched(
    data: DataFrame, queries: DataFrame, k: int, key: str, vector: str, dims: int, sure: float
) -> tuple[DataFrame, DataFrame] | None:
    """The queries that take part, numbered (qid), and what was found: for each query and cell
    searched the best ``k`` rows (qid, score, id), and one row with the vectors ``verified``."""
    id_type = data.schema[key].dataType.simpleString()
    index = build(data, key, vector, k + 1, dims)
    if index is None:
        return None
    width, quantile = len(index.matrix), chi_square_quantile(sure, dims)
    asked = queries.where(takes_part(F.col(vector))).select(F.col(key).alias("id"), F.col(vector).alias("v"))
    asked = materialize(asked.withColumn("qid", F.monotonically_increasing_id()), "ann-queries")
    n_asked, widest = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    if widest and widest > width:
        raise ValueError("a query is wider than every row")
    chunks = max(1, -(-n_asked // QUERIES))
    tasks = max(1, min(4096, chunks * len(index.blocks)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The queries to their own cells, or (with a reach) to all others that it meets."""
        for pdf in batches:
            points = _matrix(pdf["v"], width) @ index.matrix
            away = np.stack([box_distances(index.low, index.high, p) for p in points])
            away[:, index.blocks == 0] = np.inf
            home = away.argmin(1)
            if "reach" in pdf:
                hit = (away < quantile * pdf["reach"].to_numpy()[:, None] ** 2) & (index.blocks > 0)
                hit[np.arange(len(pdf)), home] = False
            else:
                hit = np.arange(len(index.blocks)) == home[:, None]
                pdf = pdf.assign(reach=np.inf)
            row, cell = np.nonzero(hit)
            yield pdf.iloc[row].assign(cell=cell)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for cell, mine in pdf.groupby("cell"):
                vectors = _matrix(mine["v"], width)
                points = vectors @ index.matrix
                own = [None if n else i for n, i in zip(mine["none"], mine["id"].tolist(), strict=True)]
                found: list[list] = [[] for _ in own]
                reach, seen = mine["reach"].to_numpy().copy(), np.zeros(len(own), dtype=np.int64)
                for number in range(index.blocks[cell]):
                    block = index.block(cell, number)
                    for i in range(len(own)):
                        hits, verified = block.search(vectors[i], points[i], k + 1, reach[i], quantile)
                        seen[i] += verified
                        for far, entry in hits:
                            ids = block.ids[entry].as_py()
                            if far == 0 and own[i] in ids:
                                ids.remove(own[i])
                            found[i] += [(far, x is None, x) for x in ids]
                        found[i].sort(key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))
                        found[i] = found[i][:k]
                        if len(found[i]) == k:
                            reach[i] = min(reach[i], found[i][-1][0])
                rows = [(q, x[0], x[2], None) for q, f in zip(mine["qid"].tolist(), found, strict=True) for x in f]
                rows += [(q, None, None, n) for q, n in zip(mine["qid"].tolist(), seen.tolist(), strict=True)]
                yield pd.DataFrame(rows, columns=["qid", "score", "id", "verified"], dtype=object)

    def searched(rows: DataFrame) -> DataFrame:
        # A null id is told by a flag: in pandas a column with nulls would lose digits.
        rows = rows.withColumns({"none": F.col("id").isNull(), "id": F.coalesce("id", F.lit(0).cast(id_type))})
        types = {f.name: f.dataType.simpleString() for f in rows.schema.fields} | {"reach": "double", "cell": "long"}
        dealt = rows.mapInPandas(deal, ", ".join(f"{c} {t}" for c, t in types.items()))
        dealt = dealt.repartition(tasks, "cell", F.pmod(F.xxhash64("qid"), F.lit(chunks)))
        out = f"qid long, score double, id {id_type}, verified long"
        return dealt.sortWithinPartitions("cell").mapInPandas(search, out)

    home = materialize(searched(asked), "ann-home")
    reach = home.where("verified IS NULL").groupBy("qid").agg(F.count("*").alias("_n"), F.max("score").alias("_far"))
    reach = reach.select(F.col("qid").alias("_q"), F.when(F.col("_n") >= k, F.col("_far")).alias("_reach"))
    bounded = asked.join(reach, F.col("qid") == F.col("_q"), "left").select(
        *asked.columns, F.coalesce("_reach", F.lit(float("inf"))).alias("reach")
    )
    return asked, home.unionByName(searched(bounded))


def nearest(
    data: DataFrame,
    queries: DataFrame,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    dims: int = DIMS,
    sure: float = SURE,
) -> DataFrame:
    """query_id, rank, key, score: the ``k`` nearest rows of ``data`` found for each row of
    ``queries``, by Euclidean distance, ties to the smaller key; a query's own row is left out."""
    both = _searched(data, queries, k, key, vector, dims, sure)
    if both is None:
        id_type = data.schema[key].dataType.simpleString()
        return data.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, {key} {id_type}, score double")
    asked, found = both
    best = Window.partitionBy("qid").orderBy("score", F.col("id").asc_nulls_last())
    ranked = found.where("verified IS NULL").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    own = asked.select(F.col("qid").alias("_q"), F.col("id").alias("query_id"))
    met = ranked.join(own, F.col("qid") == F.col("_q"))
    return met.select("query_id", "rank", F.col("id").alias(key), "score")


def verified(
    data: DataFrame,
    queries: DataFrame,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    dims: int = DIMS,
    sure: float = SURE,
) -> DataFrame:
    """query_id, cells, verified: how many cells a query searched, and vectors it verified."""
    both = _searched(data, queries, k, key, vector, dims, sure)
    if both is None:
        id_type = data.schema[key].dataType.simpleString()
        return data.sparkSession.createDataFrame([], f"query_id {id_type}, cells long, verified long")
    asked, found = both
    sums = found.where("verified IS NOT NULL").groupBy("qid")
    sums = sums.agg(F.count("*").alias("cells"), F.sum("verified").alias("verified"))
    return asked.join(sums, "qid").select(F.col("id").alias("query_id"), "cells", "verified")


def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the 10 nearest found for every row whose vec_id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))
