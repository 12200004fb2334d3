import itertools
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclecount.llm import packing, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length string"


def check_plan(counts, room, plan):
    left = counts.copy()
    for pattern, times in plan:
        assert sum(pattern) <= room and times > 0
        for x in pattern:
            left[x] -= times
    assert (left == 0).all()


def fewest(sizes, room):
    """Brute force: the fewest bins, by trying to put each item into each open bin."""
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= room and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=9))
def test_solve_is_within_one_of_the_optimum(sizes):
    counts = np.bincount(sizes, minlength=20) if sizes else np.zeros(20, dtype=np.int64)
    plan = packing.solve(counts, 20)
    check_plan(counts, 20, plan)
    n = sum(t for _, t in plan)
    assert n <= fewest(sorted(sizes, reverse=True), 20) + 1


def test_solve_beats_best_fit_where_completion_helps():
    # best fit puts 6+3, 6+3, 5+4, 4 into four; completion finds 6+4, 6+4, 5+3+... in three
    counts = np.bincount([6, 6, 5, 4, 4, 3, 2], minlength=10)
    plan = packing.solve(counts, 10)
    check_plan(counts, 10, plan)
    assert sum(t for _, t in plan) == 3


def test_solve_large_counts_is_near_the_bound():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.integers(1, 1024, 200_000), minlength=1024)
    plan = packing.solve(counts, 1024)
    check_plan(counts, 1024, plan)
    bound = -(-int((counts * np.arange(1024)).sum()) // 1024)
    assert sum(t for _, t in plan) <= bound * 1.002


def test_pieces_are_whole_and_gapless(spark):
    texts = [None, "", "hello there", "word " * 3000, "x" * 5000, "hello there", "é 漢字  two"]
    df = spark.createDataFrame([(i if i else None, t, "en", "s", 0, "clash") for i, t in enumerate(texts)], SCHEMA)
    df = df.unionByName(df)
    got = packing.pack(df, keep_ids=True, room=256).collect()
    enc = tokens.Encoder(tokens.public("byte_bpe_50k.json"))
    want = {}
    for i, t in enumerate(texts):
        ids = enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids), 256), len(ids)]
        for p, (a, b) in enumerate(itertools.pairwise(cuts)):
            data = np.array(ids[a:b], dtype="<u4").tobytes()
            want[(i if i else None, p)] = (a, b - a, zlib.crc32(data), data)
    assert len(got) == 2 * len(want)
    for r in got:
        assert (r.start, r.length, r.ids_crc32, r.ids) == want[(r.doc_id, r.piece)]
    at = {}
    for r in got:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= 256


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_solve_fills_with_any_number_of_pieces():
    counts = np.zeros(1024, dtype=np.int64)
    counts[180], counts[152] = 1000, 500  # 4 * 180 + 2 * 152 = 1024
    plan = packing.solve(counts, 1024)
    check_plan(counts, 1024, plan)
    assert sum(t for _, t in plan) == 250


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=12), st.integers(1, 24))
def test_fillings_start_with_the_least_waste(sizes, space):
    counts = np.bincount(sizes, minlength=30)
    got = packing._fillings(counts, space, 29)
    sums = {sum(c) for k in range(len(sizes) + 1) for c in itertools.combinations(sizes, k)}
    assert got[0][0] == min(space - x for x in sums if x <= space)
    for waste, fill in got:
        assert sum(fill) == space - waste and all(fill.count(x) <= counts[x] for x in fill)
