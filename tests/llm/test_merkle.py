import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cyclecount.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    key, text, lang, source, n, *_ = row
    values = [key, source, lang, n, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """The root, and each node's siblings by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // fanout * fanout : a // fanout * fanout + fanout]
            proofs[i].append(("".join(run[: a % fanout]), "".join(run[a % fanout + 1 :])))
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [a // fanout for a in at]
    return nodes[0], proofs


def brute(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in names}
    root, upper = tree([trees[g][0] for g in names], fanout)
    out = []
    for i, g in enumerate(names):
        subroot, proofs = trees[g]
        for pos, (x, proof) in enumerate(zip(sorted(groups[g], key=lambda x: x[:3]), proofs, strict=True)):
            out.append((x[3][0], g, pos, x[2], subroot, root, tuple(proof + upper[i])))
    return sorted(out, key=repr)


def corpus(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for g, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Ab Cd", "é" * rng.randrange(9), "Z" * 100_000])
            rows.append((rng.randrange(10**6), text, rng.choice(["en", None]), g, rng.choice([None, 3]), "clash", 1))
    return rows


def run(spark, rows, fanout, local):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = merkle.manifest(df, merkle.COLUMNS, "doc_id", "source", fanout=fanout, local=local)
    rows = got.select("doc_id", "source", "position", "leaf", "subroot", "root", "proof").collect()
    return sorted(((*r[:6], tuple((s["left"], s["right"]) for s in r["proof"])) for r in rows), key=repr)


@pytest.mark.parametrize(
    ("sizes", "fanout", "local"),
    [
        ({"a": 1}, 2, 1),
        ({"a": 2, "b": 1}, 2, 1),
        ({"a": 37, None: 5, "b": 1, "é": 2, "": 3}, 2, 1),
        ({"a": 70, "b": 11, "c": 29, None: 3}, 3, 1),
        ({f"s{i}": (i * 7) % 23 + 1 for i in range(20)}, 3, 1),
        ({"hot": 700, "a": 40, "b": 16, "c": 17}, 4, 2),
        ({"hot": 600, "b": 257, "c": 15}, 16, 1),
    ],
)
def test_equals_the_plain_tree(spark, sizes, fanout, local):
    rows = corpus(sizes)
    assert run(spark, rows, fanout, local) == brute(rows, fanout)


def test_null_keys_ties_and_repeated_rows(spark):
    rows = corpus({"a": 20, None: 4})
    rows += [(None, "x", None, "a", 1, None, None), (None, "y", None, "a", 1, None, None)] + [rows[3]] * 9
    rows += [(rows[5][0], "another text", "en", "a", 0, None, None), (None, None, None, None, None, None, None)]
    assert run(spark, rows, 2, 1) == brute(rows, 2)


def test_contract_query_and_tampering(spark, tmp_dir):
    rows = corpus({"a": 40, "b": 300, None: 2}, seed=5)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in merkle.op12_merkle_manifest(spark, tmp_dir).collect()}
    seen = set()
    for key, _, _, digest, subroot, root, proof in brute(rows, 16):
        row = next(r for r in rows if r[0] == key)
        text = row[1]
        if zlib.crc32(str(key).encode()) % 5 == 0 and text is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        h = leaf((key, text, *row[2:]))
        for left, right in proof:
            h = sha(left + h + right)
        r = got[key]
        assert (r["leaf"], r["subroot"], r["root"]) == (digest, subroot, root)
        assert r["proof_sha256"] == sha("".join(a + b for a, b in proof))
        assert (r["folded_root"], r["verified"]) == (h, h == root)
        seen.add(r["verified"])
    assert len(got) == len(rows) and seen == {True, False}


def test_empty_table(spark):
    assert run(spark, [], 16, 3) == []


def test_folding_a_proof(spark):
    rows = corpus({"a": 30, "b": 4})
    df = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest(df, merkle.COLUMNS, "doc_id", "source", 3, 1, carry={"size": F.length("text")})
    assert got.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert {r["size"] for r in got.collect()} == {None if r[1] is None else len(r[1]) for r in rows}
