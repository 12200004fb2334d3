import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclecount.llm import simhash
from cyclecount.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string"


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_equals_plain_and_spark_hash(spark):
    texts = [None, "", " \n\x0b", "One", "one TWO", "Éa b c d e f", "word " * 5000, "a b c a b c a"]
    assert [simhash.fingerprint(t.encode() if t is not None else None) for t in texts] == [plain(t) for t in texts]
    assert spark.sql("select xxhash64('one two')").first()[0] == np.uint64(plain("one TWO")).astype(np.int64)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=12), st.integers(0, 2**32))
def test_walk_finds_every_near_pair(seeds, salt):
    rng = random.Random(salt)
    fps = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds for _ in range(9)}
    x = np.sort(np.array(sorted(fps), dtype=np.uint64))
    got = {(int(i), int(j)) for a, b in simhash._walk(x, x, True, 2) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if (int(x[i]) ^ int(x[j])).bit_count() <= 2}
    assert got == want


def test_groups_equal_brute_force_over_many_leaves(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(340):
        fps.append(rng.choice(fps) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(set(fps))
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    edges = simhash.links(df, leaf=20)
    roots = {r.node: r.root for r in components(edges).collect()}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    want = brute(fps)
    got = [roots.get(f, f) for f in signed]
    by_got, by_want = {}, {}
    for f, g, w in zip(signed, got, want, strict=True):
        by_got.setdefault(g, set()).add(f)
        by_want.setdefault(w, set()).add(f)
    assert sorted(map(sorted, by_got.values())) == sorted(map(sorted, by_want.values()))


def test_documents_and_dedup(spark):
    long = "the quick brown fox jumps over the lazy dog " * 40
    rows = [(5, long), (3, long + "end"), (9, None), (8, " "), (2, "other words here now"), (2, "other words here now")]
    rows += [(None, "only without a key"), (None, "a second one without any key"), (7, "x")]
    df = spark.createDataFrame([(i, t, "en", "s", 0, "clash") for i, t in rows], SCHEMA)
    fps = [plain(t) for _, t in rows]
    comp = brute(fps)
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.groups(df).collect()}
    for (i, _), f, c in zip(rows, fps, comp, strict=True):
        ids = [rows[k][0] for k in range(len(rows)) if comp[k] == c and rows[k][0] is not None]
        assert got[(i, int(np.uint64(f).astype(np.int64)))] == (min(ids) if ids else None)
    out = simhash.dedup(df)
    assert out.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(["3", "8", "2", "None", "None", "7"])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.groups(empty).count() == 0 and simhash.dedup(empty).count() == 0
