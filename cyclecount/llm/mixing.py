"""Operator 1: mixing sources to target weights with a time-varying curriculum.

Each source has a weight schedule over the run, a piecewise-linear curve given by knots
(t, w), t from 0 to 1. Its integral is the source's share. Shares are turned into word
targets that stop at ``cap`` times the source's size; the excess is reshared by weight until
no target is above its cap. Within a source the documents stand in a fixed pseudo-random
order and are read round after round until the target is reached; the copy of a document
that covers the demand fraction u is placed at the time at which the schedule's running
integral reaches u. Copies of all sources are then range-sorted by that time.

Defined cases: a null source is a source of its own, last in order; a null text has size 0;
documents without words are placed like others but add nothing; a source without words has
target 0 and takes nothing. Repeated rows are rows of their own. An empty table gives an
empty result. Other columns ride along in ``mix`` and are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclecount.llm.common import WORD, materialize, prefix_sums, table

#: Targets stop at this many times their source's size.
CAP = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def production_schedule(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating by the source's rank (from 0): odd ranks ramp up from half
    to one and a half times their weight, even ranks down. The integral is the weight."""
    w = (rank % 3 + 1).cast("double")
    up = rank % 2
    first = F.when(up == 1, w * 0.5).otherwise(w * 1.5)
    last = F.when(up == 1, w * 1.5).otherwise(w * 0.5)
    return F.array(
        F.struct(F.lit(0.0).alias("t"), first.alias("w")), F.struct(F.lit(1.0).alias("t"), last.alias("w"))
    )


def segments(knots: Column) -> Column:
    """Pieces of the schedule: start t0, length h, weights w0 to w1, area, and area before."""
    pieces = F.transform(
        F.sequence(F.lit(1), F.size(knots) - 1),
        lambda i: F.struct(
            F.element_at(knots, i)["t"].alias("t0"),
            (F.element_at(knots, i + 1)["t"] - F.element_at(knots, i)["t"]).alias("h"),
            F.element_at(knots, i)["w"].alias("w0"),
            F.element_at(knots, i + 1)["w"].alias("w1"),
            (
                (F.element_at(knots, i)["w"] + F.element_at(knots, i + 1)["w"])
                / 2
                * (F.element_at(knots, i + 1)["t"] - F.element_at(knots, i)["t"])
            ).alias("area"),
        ),
    )
    return F.transform(
        pieces,
        lambda p, i: F.struct(
            p["t0"].alias("t0"), p["h"].alias("h"), p["w0"].alias("w0"), p["w1"].alias("w1"), p["area"].alias("area"),
            F.aggregate(F.slice(pieces, 1, i), F.lit(0.0), lambda s, x: s + x["area"]).alias("before"),
        ),
    )


def invert(segs: Column, demand: Column) -> Column:
    """The time at which the schedule's running integral reaches ``demand``."""
    last = F.element_at(segs, -1)
    p = F.coalesce(F.get(F.filter(segs, lambda s: s["before"] + s["area"] >= demand), F.lit(0)), last)
    d = F.greatest(F.least(demand - p["before"], p["area"]), F.lit(0.0))
    slope = (p["w1"] - p["w0"]) / p["h"]
    root = F.sqrt(F.greatest(p["w0"] * p["w0"] + 2 * slope * d, F.lit(0.0)))
    step = F.when(d <= 0, F.lit(0.0)).otherwise(2 * d / (p["w0"] + root))
    return p["t0"] + F.least(step, p["h"])


def source_targets(
    sizes: DataFrame, source: str, size: str, schedule: Callable[[Column], Column], cap: int = CAP
) -> DataFrame:
    """One row per source: source, source_size, segs, share, target.

    With targets min(cap * size, level * weight), the sum is a piecewise-linear function of
    the level; a source is at its cap if that sum, at the level where the source reaches
    its cap, is not above the total. The level of the rest follows from what they must fill.
    """
    per = sizes.groupBy(F.col(source).alias("src")).agg(F.sum(size).alias("source_size"))
    per = per.withColumn("one", F.lit(1).cast("long"))
    per = prefix_sums(per, {"one": "rank"}, [], [F.col("src").asc_nulls_last()])
    per = per.withColumn("segs", segments(schedule(F.col("rank"))))
    per = per.withColumn("share", F.aggregate("segs", F.lit(0.0), lambda s, p: s + p["area"]))
    per = per.withColumn("room", F.col("source_size") * cap)
    per = per.withColumn("reach", F.when(F.col("share") > 0, F.col("room") / F.col("share")))
    order = [F.col("reach").asc_nulls_last(), F.col("src").asc_nulls_last()]
    per = materialize(prefix_sums(per, {"room": "room_before", "share": "share_before"}, [], order), "sources")
    total, shares = per.agg(F.sum("source_size"), F.sum("share")).first()
    if total is None:
        total, shares = 0, 0.0
    filled = F.col("room_before") + F.col("reach") * (F.lit(shares) - F.col("share_before"))
    per = per.withColumn("full", filled <= F.lit(total))
    fixed, left = per.agg(
        F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)), F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("share")))
    ).first()
    level = (total - (fixed or 0)) / left if left else 0.0
    room = F.col("room").cast("double")
    target = F.when(F.col("full"), room).otherwise(F.least(F.col("share") * F.lit(level), room))
    return per.select("src", "source_size", "segs", "share", F.coalesce(target, F.lit(0.0)).alias("target"))


def plan_mix(
    docs: DataFrame,
    schedule: Callable[[Column], Column] = production_schedule,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    cap: int = CAP,
) -> DataFrame:
    """One row per document: key, row_hash (of all its columns), size, source_size, target,
    taken, positions.

    ``positions`` holds the training position (0 to 1) of each copy the mix takes. A copy is
    taken if its middle word is within its source's target.
    """
    rows = docs.select(
        F.col(key).alias(key),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_hash"),
        words(F.col(text)).alias("size"),
        F.col(source).alias("_src"),
    )
    rows = rows.withColumn("mix_key", F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")))
    order = [F.col("mix_key"), F.col(key).asc_nulls_first(), F.col("size"), F.col("row_hash")]
    rows = materialize(prefix_sums(rows, {"size": "before"}, ["_src"], order), "placed")
    targets = source_targets(rows, "_src", "size", schedule, cap)
    rows = rows.join(targets, F.col("_src").eqNullSafe(F.col("src")))
    twice = F.col("target") * 2
    middles = F.transform(
        F.sequence(F.lit(0), F.lit(cap - 1)),
        lambda e: 2 * (e * F.col("source_size") + F.col("before")) + F.col("size"),
    )
    rows = rows.withColumn("_mid", F.filter(middles, lambda m: (m <= twice) & (F.col("target") > 0)))
    positions = F.transform("_mid", lambda m: invert(F.col("segs"), m / twice * F.col("share")))
    taken = (F.col("size") * F.size("_mid")).alias("taken")
    return rows.select(
        key, "row_hash", "mix_key", "size", "source_size", "target", taken, positions.alias("positions")
    )


def mix(
    docs: DataFrame, schedule: Callable[[Column], Column] = production_schedule, key: str = "doc_id", **names
) -> DataFrame:
    """The mixed documents themselves: one row per copy taken, with the input's columns, in
    training order (range-sorted by position). Documents that the mix leaves out go.

    Only slim rows are planned; the texts meet their positions in one join, by key and row
    hash. Rows equal in every column are interchangeable, so one of them carries the
    positions of all. Columns of map type aren't supported."""
    planned = plan_mix(docs, schedule, key=key, **names).where(F.size("positions") > 0)
    places = planned.groupBy(key, "row_hash", "mix_key").agg(F.flatten(F.collect_list("positions")).alias("positions"))
    places = places.select(F.col(key).alias("_key"), F.col("row_hash").alias("_hash"), "mix_key", "positions")
    whole = docs.select(
        F.col(key).alias("_id"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row_hash"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    again = Window.partitionBy("_id", "_row_hash").orderBy(F.lit(0))
    whole = whole.withColumn("_n", F.row_number().over(again)).where("_n = 1")
    met = whole.join(places, F.col("_id").eqNullSafe(F.col("_key")) & (F.col("_row_hash") == F.col("_hash")))
    copies = met.select(F.explode("positions").alias("_position"), "mix_key", "_row")
    return copies.orderBy("_position", "mix_key").select("_row.*")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the mix of all documents, one row each, in the order of their first
    training position (documents that are not taken come last)."""
    planned = plan_mix(table(spark, sf_dir, "documents"))
    first = F.round(F.get("positions", F.lit(0)), 6)
    out = planned.withColumn("position", first).orderBy(F.col("position").asc_nulls_last(), "mix_key")
    return out.select(
        "doc_id", "size", "source_size", "target", "taken", F.size("positions").alias("copies"), "position"
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS mix,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY mix, doc_id NULLS FIRST, size
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM s0),
s2 AS (SELECT *, (rnk % 3 + 1)::DOUBLE AS share, source_size * 3 AS room FROM s1),
s3 AS (SELECT *, room / share AS reach FROM s2),
s4 AS (
  SELECT *, coalesce(sum(room) OVER w, 0) AS room_before, coalesce(sum(share) OVER w, 0) AS share_before,
         sum(source_size) OVER () AS total, sum(share) OVER () AS shares
  FROM s3 WINDOW w AS (ORDER BY reach, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, room_before + reach * (shares - share_before) <= total AS is_full FROM s4),
s6 AS (SELECT *, sum(CASE WHEN is_full THEN room ELSE 0 END) OVER () AS fixed,
              sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE share END) OVER () AS open FROM s5),
s7 AS (SELECT source, source_size, share, rnk,
              coalesce(CASE WHEN is_full THEN room::DOUBLE
                       ELSE least(share * ((total::DOUBLE - fixed::DOUBLE) / open), room::DOUBLE) END, 0.0::DOUBLE) AS target
       FROM s6),
c AS (
  SELECT p.doc_id, p.size, s7.source_size, s7.target, s7.share, s7.rnk,
         CASE WHEN s7.target > 0 THEN (2 * p.before + p.size <= 2 * s7.target)::INT
              + (2 * (s7.source_size + p.before) + p.size <= 2 * s7.target)::INT
              + (2 * (2 * s7.source_size + p.before) + p.size <= 2 * s7.target)::INT ELSE 0 END AS copies,
         (2 * p.before + p.size) / (s7.target * 2) * s7.share AS dem,
         CASE WHEN s7.rnk % 2 = 1 THEN s7.share * 0.5::DOUBLE ELSE s7.share * 1.5::DOUBLE END AS w0,
         CASE WHEN s7.rnk % 2 = 1 THEN s7.share * 1.5::DOUBLE ELSE s7.share * 0.5::DOUBLE END AS w1
  FROM p JOIN s7 ON p.source IS NOT DISTINCT FROM s7.source)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies,
       CASE WHEN copies > 0 THEN round(CASE WHEN dem <= 0 THEN 0.0
            ELSE 2 * least(dem, share) / (w0 + sqrt(greatest(w0 * w0 + 2 * (w1 - w0) * least(dem, share), 0.0))) END, 6)
       END AS position
FROM c
"""
