"""Operator 10: exact top-k inner products by a Voronoi join.

Vectors become integers, floor(scale * x). Equal data vectors are one, with the few smallest
ids that can matter; equal query vectors are one. Pivots, a bounded sample, part data and
queries into Voronoi cells. A data cell's summary is its size, its radius, its longest vector
and the k + 1 members nearest to the pivot; a query cell's summary is the least and the
greatest distance of its queries to every pivot, and its longest query. With a query q, a
data vector x and a pivot c,

    q.x <= q.c + |q||x - c|,
    q.x = c.x + (q - c).x <= c.x + |q - c||x|,
    2 q.x = |q|^2 + |x|^2 - |q - x|^2, and |q - x| >= ||q - c| - |x - c|| for every pivot c.

The products with the cells' listed members give each query a score that k other rows reach,
and each query cell the least of these. The bounds say, by the summaries alone, which pairs of
cells can still meet, and then, by its distances to all pivots, which row of such a data cell.
Query cells that need much the same data become one group as long as that saves more rows
replicated than it adds products. A group's cells are cut into blocks; its
queries go to all of them, and those rows of them that can reach it. A block is
scored by one matrix product; the blocks' best are merged by a window of k rows a query and block.

Defined cases: vectors that are null, or hold null or non-finite components, take no part;
shorter vectors count as padded with zeros; a row repeated with the same id and vector is one
row; a row's own id and vector is no candidate of it; rows without an id take no part; an empty
table gives an empty result. Products must fit in 64-bit integers. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclecount.llm.common import bounded_batches, materialize, table

K, SCALE = 10, 1024
#: Pivots (a bounded sample by hash); products that a row replicated costs; most queries of a
#: task; data vectors of a block.
PIVOTS, PER_GROUP, QUERIES, BLOCK = 256, 256, 2048, 8192


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long; null for vectors that take no part."""
    ok = vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast("double"))
    )
    return F.when(ok, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _unpack(vectors: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype="<i8").reshape(len(vectors), width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where these are exact, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _smallest_ids(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their ``k`` smallest ids. The ids of a vector are ranked with a
    limit before the shuffle, so a vector that a third of the rows share stays small."""
    order = Window.partitionBy("v").orderBy("id")
    few = rows.distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def prepared(
    data: DataFrame, queries: DataFrame, k: int, key: str, vector: str, scale: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The data's distinct vectors with ids; the queries; their distinct vectors with hashes."""

    def clean(rows: DataFrame) -> DataFrame:
        out = rows.select(F.col(key).alias("id"), integers(F.col(vector), scale).alias("v"))
        return out.where(F.col("v").isNotNull() & F.col("id").isNotNull())

    points = materialize(_smallest_ids(clean(data), k + 1), "knn-data")
    asked = materialize(clean(queries).distinct(), "knn-queries")
    wanted = materialize(asked.select("v").distinct().select("v", F.xxhash64("v").alias("hash")), "knn-query-vectors")
    return points, asked, wanted


def _distances(m: np.ndarray, to: np.ndarray) -> np.ndarray:
    square = (m**2).sum(1)[:, None] - 2 * m @ to.T + (to**2).sum(1)[None]
    return np.sqrt(np.maximum(square, 0))


def _slack(*matrices: np.ndarray) -> tuple[float, float]:
    """More than rounding can add to a distance, and to a product, of these vectors."""
    most = max(float(np.abs(m).max(initial=0)) for m in matrices)
    return 1e-3 + 1e-5 * most, 1.0 + 1e-6 * most**2


def grouped(need: np.ndarray, sizes: np.ndarray, asks: np.ndarray) -> list[list[int]]:
    """Groups of query cells, joined greedily while that makes the work less: a row replicated
    to a group counts ``PER_GROUP``, a product of a row and a query one. ``need``: which data
    cells each query cell needs; ``sizes``, ``asks``: rows and queries of the cells."""
    groups = [[i] for i in range(len(asks))]
    need, asks = need.astype(np.float64), asks.astype(np.float64)
    while len(groups) > 1:
        rows, both = need @ sizes, asks[:, None] + asks[None]
        cost = rows * (asks + PER_GROUP)
        either = rows[:, None] + rows[None] - (need * sizes) @ need.T
        gain = cost[:, None] + cost[None] - either * (both + PER_GROUP)
        gain[(both > QUERIES) | np.eye(len(groups), dtype=bool)] = -1
        a, b = sorted(divmod(int(gain.argmax()), len(groups)))
        if gain[a, b] < 0:
            break
        groups[a] += groups.pop(b)
        need[a], asks[a] = np.maximum(need[a], need[b]), asks[a] + asks[b]
        need, asks = np.delete(need, b, axis=0), np.delete(asks, b)
    return groups


def deal(points: DataFrame, wanted: DataFrame, k: int, n_pivots: int = PIVOTS) -> DataFrame:
    """Queries and the data that can reach them: (cell, chunk, block, asks, hash, v, ids), cell
    a number of a group of queries. ``points``: distinct vectors v with ids; ``wanted``: the
    queries' distinct vectors with their hash."""
    n_points, widest = points.agg(F.count("*"), F.max(F.size("v"))).first()
    n_wanted, width = wanted.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 0, widest or 0)
    id_type = points.schema["ids"].dataType.simpleString()
    schema = f"cell long, chunk long, block long, asks boolean, hash long, v binary, ids {id_type}"
    if not n_points or not n_wanted:
        return points.sparkSession.createDataFrame([], schema)
    sample = points.orderBy(F.xxhash64("v"), "v").limit(n_pivots).select("v").collect()  # the pivots
    pivots = _matrix([r["v"] for r in sample], width).astype(np.float64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            whole = _matrix(pdf["v"], width)
            m = whole.astype(np.float64)
            far = _distances(m, pivots)
            at = far.argmin(1)
            rest = {c: pdf[c] for c in pdf.columns if c != "v"}
            raw = [r.astype("<i8").tobytes() for r in whole]
            yield pd.DataFrame({"at": at, "far": far[np.arange(len(m)), at], "size": np.sqrt((m**2).sum(1)), "v": raw, **rest})

    placed = "at int, far double, size double, v binary, hash long"
    rows = points.select("v", "ids", F.xxhash64("v").alias("hash"), F.xxhash64(F.lit(1), "v").alias("spread"))
    rows = materialize(rows.mapInPandas(place, f"{placed}, spread long, ids {id_type}"), "knn-placed")
    asked = materialize(wanted.select("v", "hash").mapInPandas(place, placed), "knn-asked")

    # The data cells' summaries: at most a row, and k + 1 members, a pivot.
    cells = rows.groupBy("at").agg(F.count("*").alias("n"), F.max("far").alias("far"), F.max("size").alias("size")).collect()
    sizes, radius, longest = (np.zeros(len(pivots)) for _ in range(3))
    for r in cells:
        sizes[r["at"]], radius[r["at"]], longest[r["at"]] = r["n"], r["far"], r["size"]
    near = Window.partitionBy("at").orderBy("far", "hash")
    listed = rows.select("at", "far", "hash", "v").withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1)
    members = _unpack([r["v"] for r in listed.select("v").collect()], width).astype(np.float64)

    def summarize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A task's query cells: queries, longest, least floor, distances to every pivot."""
        held: dict[int, list] = {}
        for pdf in batches:
            m = _unpack(pdf["v"], width).astype(np.float64)
            away = _distances(m, pivots)
            floor = np.full(len(m), -np.inf)
            if len(members) > k:
                floor = np.partition(m @ members.T, -(k + 1), axis=1)[:, -(k + 1)]
            for c in np.unique(pdf["at"]).tolist():
                own = (pdf["at"] == c).to_numpy()
                new = [own.sum(), pdf["size"][own].max(), floor[own].min(), away[own].min(0), away[own].max(0)]
                held[c] = _merge(held[c], new) if c in held else new
        out = [(c, int(n), size, floor, lo.tobytes(), hi.tobytes()) for c, (n, size, floor, lo, hi) in held.items()]
        yield pd.DataFrame(out, columns=["at", "n", "size", "floor", "lo", "hi"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = (np.stack([np.frombuffer(b) for b in pdf[c]]) for c in ("lo", "hi"))
        least, most = lo.min(0).tobytes(), hi.max(0).tobytes()
        out = (pdf["at"].iloc[0], pdf["n"].sum(), pdf["size"].max(), pdf["floor"].min(), least, most)
        return pd.DataFrame([out], columns=["at", "n", "size", "floor", "lo", "hi"])

    summary = "at int, n long, size double, floor double, lo binary, hi binary"
    met = asked.select("at", "size", "v").mapInPandas(summarize, summary).groupBy("at").applyInPandas(meet, summary)
    met = met.collect()  # at most a row a pivot
    pivot, n, size, floor = (np.array([r[c] for r in met]) for c in ("at", "n", "size", "floor"))
    lo, hi = (np.stack([np.frombuffer(r[c]) for r in met]) for c in ("lo", "hi"))
    d_slack, p_slack = _slack(pivots, longest, size)
    lo, hi = lo - d_slack, hi + d_slack
    reach = hi[np.arange(len(met)), pivot]  # how far a query cell's queries are from its pivot

    # Which data cells a query cell needs, by the summaries alone.
    gap = np.maximum(lo - radius[None] - d_slack, 0)
    most = (size[:, None] ** 2 + longest[None] ** 2 - gap**2) / 2
    to_pivot = pivots[pivot] @ pivots.T + reach[:, None] * np.sqrt((pivots**2).sum(1))[None]
    most = np.minimum(most, to_pivot + size[:, None] * (radius[None] + d_slack))
    need = (most + p_slack >= floor[:, None]) & (sizes[None] > 0)

    groups = grouped(need, sizes, n)
    of_cell = np.zeros(len(pivots), dtype=np.int64)
    for g, own in enumerate(groups):
        of_cell[pivot[own]] = g
    chunks = np.array([-(-int(n[own].sum()) // QUERIES) for own in groups])
    # A group's data cells stand one after another, a row at a place in its cell by hash; blocks
    # are stretches of places.
    whole = sizes.astype(np.int64)
    upto = [np.cumsum(np.where(need[own].any(axis=0), whole, 0)) for own in groups]

    def deal_data(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            m, at, long = _unpack(pdf["v"], width).astype(np.float64), pdf["at"].to_numpy(), pdf["size"].to_numpy()
            away, slack = _distances(m, pivots), _slack(m, pivots, size)
            within = pdf["spread"].to_numpy() % whole[at]
            for g, own in enumerate(groups):
                reached = np.zeros(len(m), dtype=bool)
                for q in own:
                    some = np.flatnonzero(need[q][at] & ~reached)
                    up = m[some] @ pivots[pivot[q]] + reach[q] * (long[some] + slack[0])
                    some = some[up + slack[1] >= floor[q]]
                    gap = np.maximum(lo[q] - away[some], away[some] - hi[q]).max(axis=1, initial=0) - slack[0]
                    up = (size[q] ** 2 + long[some] ** 2 - np.maximum(gap, 0) ** 2) / 2
                    reached[some[up + slack[1] >= floor[q]]] = True
                block = (upto[g][at] - whole[at] + within) // BLOCK
                for chunk in range(chunks[g] if reached.any() else 0):
                    yield pd.DataFrame(
                        {
                            "cell": g, "chunk": chunk, "block": block[reached], "asks": False,
                            "hash": pdf["hash"][reached], "v": pdf["v"][reached], "ids": pdf["ids"][reached],
                        }
                    )

    def deal_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            group = of_cell[pdf["at"].to_numpy()]
            chunk = pdf["hash"].to_numpy() % chunks[group]
            for g in np.unique(group).tolist():
                own = group == g
                told = pd.DataFrame({"cell": g, "chunk": chunk[own], "asks": True, "hash": pdf["hash"][own], "v": pdf["v"][own], "ids": None})
                for block in range(-(-int(upto[g][-1]) // BLOCK)):
                    yield told.assign(block=block)

    dealt = rows.select("v", "at", "size", "spread", "hash", "ids").mapInPandas(deal_data, schema)
    return dealt.unionByName(asked.select("v", "at", "hash").mapInPandas(deal_queries, schema))


def _merge(a: list, b: list) -> list:
    return [a[0] + b[0], max(a[1], b[1]), min(a[2], b[2]), np.minimum(a[3], b[3]), np.maximum(a[4], b[4])]


def top_k(
    data: DataFrame,
    queries: DataFrame,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    n_pivots: int = PIVOTS,
) -> DataFrame:
    """query_id, rank, key, score: the ``k`` rows of ``data`` with the highest inner product
    for each row of ``queries``, ties to the smaller key; a query's own row is left out."""
    bounded_batches(data.sparkSession, 2000)
    points, asked, wanted = prepared(data, queries, k, key, vector, scale)
    dealt = deal(points, wanted, k, n_pivots)
    id_type = points.schema["ids"].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        out: dict[str, list] = {"q": [], "score": [], "same": [], "ids": []}
        if len(mine) and len(theirs):
            width = len(mine["v"].iloc[0]) // 8
            scores = _products(_unpack(mine["v"], width), _unpack(theirs["v"], width))
            ids, hashes = theirs["ids"].to_numpy(), theirs["hash"].to_numpy()
            first = np.argsort(np.argsort(pd.Index([x[0] for x in ids]), kind="stable"), kind="stable")
            for q, row in zip(mine["hash"].tolist(), scores, strict=True):
                high = np.arange(len(row))
                if len(row) > k + 1:
                    high = np.flatnonzero(row >= np.partition(row, -(k + 1))[-(k + 1)])
                best = high[np.lexsort((first[high], -row[high]))[: k + 1]]
                out["q"] += [q] * len(best)
                out["score"] += row[best].tolist()
                out["same"] += (hashes[best] == q).tolist()
                out["ids"] += [ids[b] for b in best]
        return pd.DataFrame(out, dtype=object)

    solved = dealt.groupBy("cell", "chunk", "block").applyInPandas(
        solve, f"q long, score long, same boolean, ids {id_type}"
    )
    few = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("ids")[0])
    found = solved.withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= k + 1)
    ranked = found.select("q", "score", "same", F.explode("ids").alias("id"))
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    ranked = ranked.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    lists = ranked.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("_n", "id", "score", "same"))).alias("best"))
    own = asked.select(F.col("id").alias("query_id"), F.xxhash64("v").alias("q"))
    others = F.slice(F.filter("best", lambda s: ~(s["same"] & (s["id"] == F.col("query_id")))), 1, k)
    met = own.join(lists, "q").select("query_id", F.posexplode(others).alias("rank", "hit"))
    return met.select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.id").alias(key), F.col("hit.score").alias("score")
    )


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the 10 best rows for every row whose vec_id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


OP10_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND (c.vec_id <> q.vec_id OR c.v <> q.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
