"""Operator 12: Merkle manifest of a dataset by a butterfly exchange.

Each row is a leaf: the digest of its columns, null as ``-`` and else the value's bytes with
their count before. In a group (a source) the leaves stand by key; while several nodes remain,
every ``fanout`` consecutive ones become the digest of their digests. What remains is the
group's subroot; the subroots, by group, make the root in the same way.

A group's leaves are cut into aligned partitions of fanout^local leaves, each of which hashes its
own subtree. Then partitions swap subtree roots round by round, as in a butterfly: in round r a
partition meets the partitions whose number differs in digit r alone, so it gets the roots of
the sibling subtrees, hashes their parent itself and keeps the siblings as the next step of its
proof. All partitions under a node thus hash it again, and after the last round each holds the
root and its whole upper proof; nothing is sent down. Where a sibling subtree has fewer
partitions than the widest of its run, each of them also serves the numbers that lie a multiple
of that count further on. The rounds over the groups' subroots go on in the same way. No meeting
has more than ``fanout`` members, and a round sends at most ``fanout`` messages a partition of
the widest subtree of each run; what is sent are digests, one row a partition.

A proof is a list of steps (left, right): the siblings' digests before and after, joined, from
the leaf's run up to the root's. ``folded`` hashes a leaf up a proof.

Defined cases: a null group is a group of its own, the first; null keys stand first in their
group; equal keys stand by their leaves' digests, and rows equal in all columns are leaves of
their own; a lone leaf is its group's subroot and has an empty proof there; an empty table gives
an empty result. Columns that aren't named are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclecount.llm.common import crc_of_id, materialize, prefix_sums, table

#: Nodes of a run; levels that a partition hashes on its own (4,096 leaves).
FANOUT, LOCAL = 16, 3
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = "struct<left:string,right:string>"


def encoded(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the proof's siblings give."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(joined(F.transform(proof, lambda s: F.concat(s["left"], s["right"]))), 256)


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("long")


def _parents(nodes: Column, more: Column, fanout: int) -> Column:
    """The level above ``nodes``; the same level where nothing is left to do."""
    runs = F.sequence(F.lit(0), _div(F.size(nodes) - 1, fanout).cast("int"))
    above = F.transform(runs, lambda g: F.sha2(joined(F.slice(nodes, g * fanout + 1, fanout)), 256))
    return F.when(more | (F.size(nodes) > 1), above).otherwise(nodes)


def _step(nodes: Column, at: Column, fanout: int) -> Column:
    """The siblings of node ``at`` (from 0) in its run."""
    place = at % fanout
    left, right = F.slice(nodes, at - place + 1, place), F.slice(nodes, at + 2, fanout - 1 - place)
    return F.struct(joined(left).alias("left"), joined(right).alias("right"))


def _placed(leaves: DataFrame, width: int, fanout: int) -> tuple[DataFrame, int, int]:
    """``leaves`` with ``pos`` in the group, ``parts`` (the group's partitions), ``s`` (the group's
    place) and ``reach`` (see ``_reach``); also the most partitions of a group, and the groups.

    Rows are dealt by ranges of the whole order, so a group with a third of the rows, or a row
    repeated that often, is split."""
    order = ["_group", "_key", "_leaf", "_tie"]
    dealt = materialize(leaves, "digests").withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    dealt = materialize(dealt.withColumn("_range", F.spark_partition_id()), "leaves")
    per = dealt.groupBy("_group", "_range").agg(F.count("*").alias("_n"))  # one row a group and range
    groups = per.groupBy("_group").agg(F.ceil(F.sum("_n") / width).cast("long").alias("parts"))
    groups = groups.withColumn("_one", F.lit(1).cast("long"))
    groups = prefix_sums(groups, {"_one": "s"}, [], [F.col("_group").asc_nulls_first()])
    groups = materialize(groups.drop("_one"), "groups")
    widest, n_groups = groups.agg(F.max("parts"), F.count("*")).first()
    groups = _reach(groups, n_groups, fanout).withColumnRenamed("_group", "_g")
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    offsets = offsets.join(groups, F.col("_group").eqNullSafe(F.col("_g"))).select(
        F.col("_group").alias("_g"), F.col("_range").alias("_r"), "_before", "s", "parts", "reach"
    )
    local = Window.partitionBy("_group", "_range").orderBy(*[F.col(c).asc_nulls_first() for c in order[1:]])
    dealt = dealt.withColumn("_at", F.row_number().over(local) - 1)
    met = dealt.join(offsets, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    met = met.withColumn("pos", F.col("_before") + F.col("_at"))
    return met.drop("_g", "_r", "_range", "_before", "_at", "_tie"), widest or 0, n_groups


def _reach(groups: DataFrame, n_groups: int, fanout: int) -> DataFrame:
    """Add ``reach``: for each round over the groups, the partitions of the widest node of the
    run that the group lies in."""
    reach, size = [], 1
    while size < n_groups:
        node, run = _div(F.col("s"), size), _div(F.col("s"), size * fanout)
        nodes = groups.groupBy(run.alias(f"_run{size}"), node.alias("_node")).agg(F.sum("parts").alias("_sum"))
        runs = nodes.groupBy(f"_run{size}").agg(F.max("_sum").alias(f"_reach{size}"))
        groups = groups.join(runs, run == F.col(f"_run{size}")).drop(f"_run{size}")
        reach.append(F.col(f"_reach{size}"))
        size *= fanout
    whole = F.array(*reach) if reach else F.array().cast("array<bigint>")
    return groups.select("_group", "s", "parts", whole.alias("reach"))


def _exchange(state: DataFrame, meets: list[Column], child: Column, number: Column, served: Column, active: Column) -> DataFrame:
    """One round. ``meets`` name the run, ``child`` the partition's subtree in it, ``number`` its
    own number there and ``served`` all the numbers that it sends to; ``members`` is the
    subtree's count of partitions."""
    kept = [c for c in state.columns if c not in ("number", "members", "node", "proof")]
    sent = state.select(
        *[m.alias(f"_m{i}") for i, m in enumerate(meets)],
        F.explode(served).alias("_x"),
        F.struct(
            child.alias("child"), number.alias("number"), F.col("members"), F.col("node"), active.alias("active"),
            F.struct(*kept, "proof").alias("own"),
        ).alias("_sent"),
    )
    mine = F.col("_sent.number") == F.col("_x")
    own = F.when(mine, F.col("_sent.own"))
    sent = sent.withColumn("_sent", F.col("_sent").withField("own", own))
    met = sent.groupBy(*[f"_m{i}" for i in range(len(meets))], "_x").agg(
        F.sort_array(F.collect_list("_sent")).alias("run")  # at most ``fanout``, by child
    )
    met = met.select("run", F.explode(F.filter("run", lambda e: e["own"].isNotNull())).alias("me"))
    before = F.filter("run", lambda e: e["child"] < F.col("me.child"))
    after = F.filter("run", lambda e: e["child"] > F.col("me.child"))
    nodes = lambda run: joined(F.transform(run, lambda e: e["node"]))
    count = lambda run: F.aggregate(run, F.lit(0).cast("long"), lambda n, e: n + e["members"])
    step = F.array(F.struct(nodes(before).alias("left"), nodes(after).alias("right")))
    return met.select(
        *[F.col(f"me.own.{c}").alias(c) for c in kept],
        (F.col("me.number") + count(before)).alias("number"),
        count(F.col("run")).alias("members"),
        F.when(F.col("me.active"), F.sha2(nodes(F.col("run")), 256)).otherwise(F.col("me.node")).alias("node"),
        F.when(F.col("me.active"), F.concat("me.own.proof", step)).otherwise(F.col("me.own.proof")).alias("proof"),
    )


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    key: str,
    group: str,
    fanout: int = FANOUT,
    local: int = LOCAL,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: key, group, position (in the group), leaf, subroot, root, proof,
    and the columns of ``carry`` (expressions over ``docs``)."""
    carry, width = carry or {}, fanout**local
    leaves = docs.select(
        F.col(group).alias("_group"),
        F.col(key).alias("_key"),
        leaf_digest([F.col(c) for c in columns]).alias("_leaf"),
        *[c.alias(f"_carry_{name}") for name, c in carry.items()],
    )
    placed, widest, n_groups = _placed(leaves, width, fanout)

    # A partition is one row: its leaves and the levels that it hashes on its own.
    rows = F.sort_array(F.collect_list(F.struct("pos", "_key", "_leaf", *[f"_carry_{c}" for c in carry])))
    blocks = placed.groupBy("s", "parts", _div(F.col("pos"), width).alias("p")).agg(
        rows.alias("rows"), F.first("reach").alias("reach"), F.first("_group").alias("_group")
    )
    blocks = materialize(blocks.withColumn("l0", F.transform("rows", lambda r: r["_leaf"])), "blocks")
    for i in range(local):
        blocks = blocks.withColumn(f"l{i + 1}", _parents(F.col(f"l{i}"), F.col("parts") > 1, fanout))
    blocks = materialize(blocks, "trees")

    state = blocks.select(
        "s", "p", "parts", "reach", F.col("p").alias("number"), F.lit(1).cast("long").alias("members"),
        F.element_at(f"l{local}", 1).alias("node"), F.array().cast(f"array<{STEP}>").alias("proof"),
    )
    size = 1
    while size < widest:
        run, node = _div(F.col("p"), size * fanout), _div(F.col("p"), size)
        number, members = F.col("p") % size, F.least(F.lit(size), F.col("parts") - node * size)
        # The first subtree of a run is whole unless it is alone.
        several = F.col("parts") > run * (size * fanout) + size
        served = F.when(several, F.sequence(number, F.lit(size - 1).cast("long"), members)).otherwise(F.array(number))
        state = state.withColumn("members", members.cast("long"))
        state = _exchange(state, [F.col("s"), run], node % fanout, number, served, F.col("parts") > size)
        size *= fanout
    state = state.withColumns({"subroot": F.col("node"), "number": F.col("p"), "members": F.col("parts")})
    size, r = 1, 0
    while size < n_groups:
        run, node = _div(F.col("s"), size * fanout), _div(F.col("s"), size)
        served = F.sequence(F.col("number"), F.col("reach")[r] - 1, F.col("members"))
        state = _exchange(state, [run], node % fanout, F.col("number"), served, F.lit(True))
        size, r = size * fanout, r + 1

    def local_proof(i: Column) -> Column:
        steps, at = [], i
        for k in range(local):
            nodes = F.col(f"l{k}")
            step = F.array(_step(nodes, at, fanout))
            steps.append(F.when((F.col("parts") > 1) | (F.size(nodes) > 1), step).otherwise(F.array().cast(f"array<{STEP}>")))
            at = F.floor(at / F.lit(fanout)).cast("int")
        return F.concat(*steps)

    upper = state.select(
        F.col("s").alias("_s"), F.col("p").alias("_p"), "subroot", F.col("node").alias("root"), F.col("proof").alias("upper")
    )
    met = blocks.drop("reach").join(upper, (F.col("_s") == F.col("s")) & (F.col("_p") == F.col("p")))
    found = F.transform("rows", lambda r, i: F.struct(r.alias("row"), local_proof(i).alias("proof")))
    met = met.select("_group", "subroot", "root", "upper", F.explode(found).alias("f"))
    return met.select(
        F.col("f.row._key").alias(key), F.col("_group").alias(group), F.col("f.row.pos").alias("position"),
        F.col("f.row._leaf").alias("leaf"), "subroot", "root", F.concat("f.proof", "upper").alias("proof"),
        *[F.col(f"f.row._carry_{c}").alias(c) for c in carry],
    )


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the manifest of all documents by source, and each row's proof folded from
    its leaf as it would be found, tampered with in every fifth document by checksum."""
    docs = table(spark, sf_dir, "documents")
    found = [F.col(c) if c != "text" else ascii_lower(F.col(c)) for c in COLUMNS]
    changed = F.when(crc_of_id() % 5 == 0, leaf_digest(found))
    rows = manifest(docs, COLUMNS, "doc_id", "source", carry={"changed": changed})
    rows = rows.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("proof")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _op12_sql(source_levels: int = 6, group_levels: int = 4) -> str:
    """The levels one by one, as far as 16^6 rows a source and 16^4 sources."""
    bytes_ = "[ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]"
    bit = "xor(z >> 1, 3988292384 * (z & 1))"
    once = functools.reduce(lambda s, _: f"list_reduce([{s}, 0], lambda z, o: {bit})", range(8), "xor(a, b)")
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda a, b: {once}), 4294967295)"
    code = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}) || ':' || {c} END"
    leaf = lambda t: "sha256(" + " || ".join(code(c) for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", t)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = f"""
WITH d AS (SELECT doc_id, source, {leaf("text")} AS leaf,
                  CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {leaf(lower)} END AS changed FROM documents),
f0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
              coalesce(changed, leaf) AS folded, '' AS proof FROM d),
n0 AS (SELECT source AS g, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS cnt FROM f0),"""

    def levels(n: int, k: int, at: str) -> str:
        text = ""
        for i in range(k, k + n):
            run = "(PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN "
            text += f"""
s{i} AS (SELECT g, pos, cnt, coalesce(string_agg(h, '') OVER {run}UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') OVER {run}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM n{i}),
f{i + 1} AS (SELECT f.* REPLACE (CASE WHEN cnt > 1 THEN sha256(l || folded || r) ELSE folded END AS folded,
                CASE WHEN cnt > 1 THEN proof || l || r ELSE proof END AS proof, f.pos // 16 AS pos)
             FROM f{i} f JOIN s{i} ON {at} IS NOT DISTINCT FROM s{i}.g AND f.pos = s{i}.pos),
n{i + 1} AS (SELECT g, pos, h, count(*) OVER (PARTITION BY g) AS cnt FROM (
             SELECT g, pos // 16 AS pos, CASE WHEN max(cnt) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
             FROM n{i} GROUP BY g, pos // 16)),"""
        return text

    k = source_levels
    out += levels(k, 0, "f.source")
    out += f"""
u AS (SELECT g AS source, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS place FROM n{k}),
n{k + 1} AS (SELECT 0 AS g, place AS pos, subroot AS h, count(*) OVER () AS cnt FROM u),
f{k + 1} AS (SELECT f.* REPLACE (u.place AS pos), u.subroot FROM f{k} f JOIN u ON f.source IS NOT DISTINCT FROM u.source),"""
    out += levels(group_levels, k + 1, "0")
    last = k + 1 + group_levels
    return (
        out
        + f"""
z AS (SELECT h AS root FROM n{last})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM f{last}, z
"""
    )


OP12_SQL = _op12_sql()
