"""Operator 11: interaction audit of a set of filters by path counting on the subset lattice.

A state is the set of filters already applied, an edge one more filter. A document is removed
on the edge (state, filter) if it fails that filter and none of the state's, so all orders that
reach a state and go on with the same filter remove the same documents. Orders are paths
through the lattice: a forward count says how many reach a state, a backward count how many
lead from it to the end, and forward(state) * backward(state + filter) how many orders use an
edge. These counts weigh an edge's removals for the Shapley sums, and each order's steps are
read from the edges it uses, so no order is ever run over the documents.

The documents are read once, into one number of failed filters each, and counted by part and
that number: at most 2^n rows a part whatever the corpus. Each is added to the states that it
survives, and an edge's figures are differences of its two states.

Pairs (first, then) can bind the orders: those that break a pair are no paths and are counted
nowhere.

Defined cases: a null text is an empty one; a null part is the empty string, and meets the
part of that name; a null key is smaller than none and has none smaller, and has no label;
rows repeated with key and text are rows of their own, none a copy of the other; labels may
repeat, and a key counts as good or toxic if any of its rows says so; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclecount.llm.common import WORD, materialize, table

LETTERS = "ABCDE"


def filter_failures(text: Column) -> dict[str, Column]:
    """The contract's four conditions on a text alone; a document that meets one fails it."""
    n_words = F.regexp_count(text, F.lit(WORD))
    distinct = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))))
    return {
        "A": n_words < 50,
        "B": distinct * 100 < n_words * 65,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def paths(names: Sequence[str], before: Sequence[tuple[str, str]] = ()) -> tuple[dict[int, int], dict[int, int]]:
    """How many allowed orders reach each state, and how many lead from it to the end. States
    are numbers with a bit a filter; both counts go over the 2^n states once."""
    n = len(names)
    needs = [sum(1 << names.index(a) for a, b in before if b == name) for name in names]
    forward, backward = {0: 1}, {(1 << n) - 1: 1}
    for state in range(1 << n):
        for f in range(n):
            if not state >> f & 1 and state & needs[f] == needs[f]:
                forward[state | 1 << f] = forward.get(state | 1 << f, 0) + forward.get(state, 0)
    for state in reversed(range((1 << n) - 1)):
        steps = [f for f in range(n) if not state >> f & 1 and state & needs[f] == needs[f]]
        backward[state] = sum(backward[state | 1 << f] for f in steps)
    return forward, backward


def lattice(
    spark: SparkSession, names: Sequence[str], before: Sequence[tuple[str, str]] = ()
) -> tuple[DataFrame, DataFrame]:
    """The edges that orders use (state, bit, filter, orders through it), and each order's
    steps as edges (filter_order, step, state, bit). Both grow with the filters alone."""
    forward, backward = paths(names, before)
    full = (1 << len(names)) - 1
    edges = [
        (state, 1 << f, name, forward.get(state, 0) * backward[state | 1 << f])
        for state in range(full)
        for f, name in enumerate(names)
        if not state >> f & 1 and all(state >> names.index(a) & 1 for a, b in before if b == name)
    ]
    edges = [e for e in edges if e[3]]
    onward: dict[int, list[tuple[int, str]]] = {}
    for state, bit, name, _ in edges:
        onward.setdefault(state, []).append((bit, name))
    steps, stack = [], [(0, "", ())]
    while stack:
        state, order, used = stack.pop()
        if state == full:
            steps += [(order, k + 1, s, b) for k, (s, b) in enumerate(used)]
        stack += [(state | b, order + name, (*used, (state, b))) for b, name in onward.get(state, [])]
    return (
        spark.createDataFrame(edges, "state int, bit int, filter string, orders long"),
        spark.createDataFrame(steps, "filter_order string, step int, state int, bit int"),
    )


def failures(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
    conditions: Callable[[Column], dict[str, Column]] = filter_failures,
) -> DataFrame:
    """One row a (part, failed filters): part, mask (bit i: filter i), n, good, toxic.

    One filter comes after ``conditions``. It is failed by a text that a smaller key has too. Texts go as digests: the
    least key of each is one aggregate, combined before the shuffle, and the documents that
    hold it are met by (digest, key), so that a text of a third of the rows is spread."""
    whole = F.coalesce(F.col(text), F.lit(""))
    failed = conditions(F.col("_t")).values()
    bits = [F.when(c, F.lit(1 << i)).otherwise(0) for i, c in enumerate(failed)]
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("_t")
    ).select("id", "part", F.unhex(F.sha2("_t", 256)).alias("digest"), functools.reduce(lambda a, b: a + b, bits).alias("mask"))
    rows = materialize(rows.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")), "failures")
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_l"))
    marks = marks.agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    keyed = rows.where(F.col("id").isNotNull())
    least = keyed.groupBy("digest").agg(F.min("id").alias("_first"))
    least = least.select(F.col("digest").alias("_digest"), "_first")
    keyed = keyed.join(least, (F.col("id") == F.col("_first")) & (F.col("digest") == F.col("_digest")), "left")
    keyed = keyed.join(marks, F.col("id") == F.col("_l"), "left")
    copy = F.when(F.col("_first").isNull(), F.lit(1 << len(failed))).otherwise(0)
    found = keyed.select("part", (F.col("mask") + copy).alias("mask"), "n", "good", "toxic")
    without = rows.where(F.col("id").isNull())
    none = F.lit(None).cast("int")
    found = found.unionByName(without.select("part", "mask", "n", none.alias("good"), none.alias("toxic")))
    return found.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.coalesce(F.col("n") * F.col("good"), F.lit(0))).alias("good"),
        F.sum(F.coalesce(F.col("n") * F.col("toxic"), F.lit(0))).alias("toxic"),
    )


def edge_counts(counts: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    """For each part and edge: kept, removed, redundant, unique_fails, good_lost, toxic_lost, and
    the filter's Shapley sum over all orders.

    ``counts`` has part, mask, n, good and toxic. A mask survives the states disjoint from it
    (3^n pairs of them in all a part); an edge removes what survives its first state and not
    its second."""
    every = (1 << n) - 1
    survived = F.filter(F.sequence(F.lit(0), F.lit(every)), lambda s: s.bitwiseAND(F.col("mask")) == 0)
    states = counts.select("part", F.explode(survived).alias("state"), "n", "good", "toxic").groupBy("part", "state")
    alive = states.agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    fails = counts.select(
        "part", F.explode(F.array(*[F.lit(1 << i) for i in range(n)])).alias("_bit"), "mask", "n"
    ).groupBy("part", "_bit")
    failed = fails.agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("_bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("mask") == F.col("_bit"), F.col("n")).otherwise(0)).alias("unique_fails"),
    ).withColumnRenamed("part", "_part")
    # The edges are a table of at most n * 2^(n - 1) rows.
    used = failed.join(F.broadcast(edges), F.col("_bit") == F.col("bit")).drop("_bit")
    here = alive.select(F.col("part"), F.col("state").alias("_s"), "n", "good", "toxic")
    then = alive.select(
        F.col("part").alias("_p2"), F.col("state").alias("_s2"), *[F.col(c).alias(f"{c}2") for c in ("n", "good", "toxic")]
    )
    met = used.join(here, (F.col("_part") == F.col("part")) & (F.col("state") == F.col("_s")), "left")
    met = met.join(then, (F.col("_part") == F.col("_p2")) & ((F.col("state") + F.col("bit")) == F.col("_s2")), "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n", "good", "toxic", "n2", "good2", "toxic2")}
    met = met.select(
        F.col("_part").alias("part"), "state", "bit", "filter", "orders", "unique_fails",
        zero["n2"].alias("kept"), (zero["n"] - zero["n2"]).alias("removed"),
        (F.col("failed") - zero["n"] + zero["n2"]).alias("redundant"),
        (zero["good"] - zero["good2"]).alias("good_lost"), (zero["toxic"] - zero["toxic2"]).alias("toxic_lost"),
    )
    sums = met.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    return met.join(sums, ["part", "bit"])


def audit(counts: DataFrame, names: Sequence[str], before: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """part, filter_order, step, filter and the figures of ``edge_counts``: one row for each part,
    allowed order of the filters and step of it."""
    edges, steps = lattice(counts.sparkSession, list(names), before)
    # The orders' steps grow with the filters (n * n! at most), not with the parts.
    found = edge_counts(counts, edges, len(names)).join(F.broadcast(steps), ["state", "bit"])
    return found.drop("state", "bit", "orders")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: filters A to E over all documents, by source."""
    counts = failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(counts, LETTERS)


OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS capitals,
             min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
             len(words) < 50 AS A, 100 * len(list_distinct(words)) < 65 * len(words) AS B,
             100 * capitals > 5 * length(text) AS C, regexp_matches(text, '[#$%&*|]') AS D,
             coalesce(w.doc_id > first_id, false) AS E
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, (CASE WHEN A THEN 'A' ELSE '' END || CASE WHEN B THEN 'B' ELSE '' END || CASE WHEN C THEN 'C' ELSE '' END
             || CASE WHEN D THEN 'D' ELSE '' END || CASE WHEN E THEN 'E' ELSE '' END) AS fails,
             count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step::INT AS step, filter_order[step] AS filter, left(filter_order, step::INT - 1) AS earlier
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, filter,
             sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN gone AND hit THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN fails = filter THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM (SELECT *, contains(fails, filter) AS hit, translate(fails, earlier, '') <> fails AS gone FROM m, s)
      GROUP BY part, filter_order, step, filter)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r
"""
