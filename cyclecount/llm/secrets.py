"""Operator 7: secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Every whole text is searched for the base kinds and for two wider kinds (tokens with an
issuer's prefix; long opaque strings of letters and digits). A span's place comes from
``split`` by the kind's pattern: the lengths of the gaps and of the matches, summed up.
Candidate values are hashed and counted over the corpus by distinct owners and repositories:
a value that many hold is a widely copied example; one that a single owner holds is an
owner-specific, live-looking credential. Base spans always stay; a span of a wider kind is
added only if its value is owner-specific and it touches no span of a kind before it.

Defined cases: a null text is an empty text, without spans; a null owner or repository counts
as one of its own; repeated rows are scanned each, and count once for the frequencies; an
empty table gives an empty result. Other columns are not read by ``scan`` and kept by
``redact`` (columns of map type aren't supported there).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclecount.llm.common import materialize, table


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, the group that is the value, the value's least length,
    and its level (0: base; higher levels give way to lower ones)."""

    name: str
    pattern: str
    group: int
    least: int
    level: int = 0


# Fixed values of the contract: the base kinds in order. Runs shorter than the least length
# can't match a longer run's rest, so ``access`` and ``hex`` carry it in the pattern.
BASE = [
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Kind("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16),
]
WIDER = [
    Kind(
        "issuer",
        r"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk_live_|sk-|AIza|ya29\.|eyJ)[A-Za-z0-9_.-]{16,}",
        0,
        20,
        1,
    ),
    Kind(
        "opaque",
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}",
        0,
        20,
        2,
    ),
]
#: A value held by this many owners, or repositories, is a widely copied example.
COPIED_OWNERS, COPIED_REPOS = 2, 3
MARK = "[SECRET]"


def _hits(text: Column, kinds: list[Kind]) -> Column:
    """All matches of all kinds, in order within a kind: kind, at, gap, length, digest (null
    where the value is too short; such a match still counts for the places after it)."""
    def of(number: int, kind: Kind) -> Column:
        pattern = F.lit(kind.pattern)
        parts = F.arrays_zip(
            F.split(text, kind.pattern, -1).alias("gap"),
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
            F.regexp_extract_all(text, pattern, F.lit(kind.group)).alias("value"),
        )
        spans = F.transform(
            F.filter(parts, lambda p: p["hit"].isNotNull()),
            lambda p, i: F.struct(
                F.lit(number).alias("kind"),
                i.alias("at"),
                F.length(p["gap"]).cast("long").alias("gap"),
                F.length(p["hit"]).cast("long").alias("length"),
                F.when(F.length(p["value"]) >= kind.least, F.sha2(p["value"], 256)).alias("digest"),
            ),
        )
        return F.when(text.rlike(kind.pattern), spans)

    found = [of(number, kind) for number, kind in enumerate(kinds)]
    return F.flatten(F.filter(F.array(*found), lambda a: a.isNotNull()))


def find(
    docs: DataFrame,
    carry: list[Column],
    text: str = "text",
    owner: Column | None = None,
    repo: Column | None = None,
    kinds: list[Kind] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows (row_id and the carried columns) and their spans: row_id, kind, level, start,
    end, owners, repos, copied.

    The rows with their matches are written once, without texts, so row ids stay. Rows with
    matches alone move on: places by a window over a row's matches of a kind, frequencies by
    three aggregates in a row (each combines before its shuffle), met again by digest.
    """
    kinds = kinds or BASE + WIDER
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", F.coalesce(F.col("source"), F.lit("")), F.coalesce(F.col("lang"), F.lit(""))) if repo is None else repo
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        *carry,
        owner.alias("_owner"),
        repo.alias("_repo"),
        _hits(F.coalesce(F.col(text), F.lit("")), kinds).alias("_hits"),
    )
    rows = materialize(rows, "secret-rows")
    hits = rows.select("row_id", "_owner", "_repo", F.inline("_hits"))
    upto = Window.partitionBy("row_id", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(upto)
    levels = F.array(*[F.lit(k.level) for k in kinds])
    spans = hits.select(
        "row_id", "_owner", "_repo", "kind", F.get(levels, F.col("kind")).alias("level"),
        (end - F.col("length")).alias("start"), end.alias("end"), "digest",
    ).where(F.col("digest").isNotNull())
    spans = materialize(spans, "secret-spans")
    held = spans.groupBy("digest", "_owner", "_repo").agg(F.lit(1).alias("one"))
    held = held.groupBy("digest", "_owner").agg(F.count("*").alias("repos"))
    held = held.groupBy("digest").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    spans = spans.drop("_owner", "_repo").join(held, "digest")
    copied = (F.col("owners") >= COPIED_OWNERS) | (F.col("repos") >= COPIED_REPOS)
    spans = spans.withColumn("copied", copied).where((F.col("level") == 0) | ~F.col("copied"))
    return rows.drop("_owner", "_repo", "_hits"), _apart(spans)


def _apart(spans: DataFrame) -> DataFrame:
    """Without the wider spans that touch a span of a lower level in their row."""
    order = Window.partitionBy("row_id").orderBy("start", "level", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    touched = F.lit(False)
    for level in sorted({k.level for k in WIDER}):
        lower = F.col("level") < level
        hit = F.coalesce(F.max(F.when(lower, F.col("end"))).over(before) > F.col("start"), F.lit(False)) | F.coalesce(
            F.min(F.when(lower, F.col("start"))).over(after) < F.col("end"), F.lit(False)
        )
        touched = touched | ((F.col("level") == level) & hit)
    return spans.withColumn("_touched", touched).where(~F.col("_touched")).drop("_touched")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """One row per document: key, row_id, spans (sorted structs start, kind, end, copied) and
    the kinds' names by number in ``kind``."""
    rows, spans = find(docs, [F.col(key).alias("_key")], text, **names)
    each = F.struct("start", "kind", "end", "level", "copied")
    lists = spans.groupBy("row_id").agg(F.sort_array(F.collect_list(each)).alias("spans"))
    out = rows.join(lists, "row_id", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,level:int,copied:boolean>>")
    return out.select(F.col("_key").alias(key), "row_id", F.coalesce("spans", none).alias("spans"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = MARK, **names) -> DataFrame:
    """The documents with every span replaced by ``mark`` (touching spans by one mark).

    Spans are found per row and meet the texts again by key and row hash; only rows with
    spans are in that join's other side.
    """
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows, spans = find(docs, [F.col(key).alias("_key"), hashed.alias("_hash")], text, **names)
    before = Window.partitionBy("row_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_from", F.coalesce(F.max("end").over(before), F.lit(0)))
    gap = F.when(
        (F.col("start") > F.col("_from")) | (F.col("_from") == 0),
        F.struct(F.col("_from").alias("a"), F.col("start").alias("b")),
    )
    cuts = spans.groupBy("row_id").agg(
        F.sort_array(F.collect_list(gap)).alias("_gaps"), F.max("end").alias("_rest")
    )
    cuts = rows.join(cuts, "row_id").drop("row_id").dropDuplicates(["_key", "_hash"])
    body = F.col(f"_row.`{text}`")
    kept = F.transform(
        "_gaps", lambda g: F.concat(F.substring(body, (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")), F.lit(mark))
    )
    tail = F.substring(body, (F.col("_rest") + 1).cast("int"), F.length(body))
    clean = F.when(F.col("_rest").isNull(), body).otherwise(F.concat(F.array_join(kept, ""), tail))
    whole = docs.select(F.col(key).alias("_id"), hashed.alias("_row_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    met = whole.join(cuts, F.col("_id").eqNullSafe(F.col("_key")) & (F.col("_row_hash") == F.col("_hash")), "left")
    columns = [clean.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return met.select(*columns)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the secrets of every whole text of documents; an owner is a source, a
    repository a source's section in one language."""
    kinds = BASE + WIDER
    out = scan(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k.name) for k in kinds])

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
        )

    base = F.filter("spans", lambda s: s["level"] == 0)

    def count(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")

    counts = [count(i).alias(f"n_{k.name}") for i, k in enumerate(kinds)]
    return out.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"),
    )
