import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclecount.llm import runlength

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string"


def brute(rows):
    body = [(t or "").encode() for _, t in rows]
    order = [runlength.LAST if i is None else i for i, _ in rows]
    least = {}
    for o, b in zip(order, body):
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            least[w] = min(o, least.get(w, o))
    out = []
    for (i, _), o, b in zip(rows, order, body):
        covered = [False] * len(b)
        for p in range(len(b) - 49):
            if least[b[p : p + 50]] < o:
                covered[p : p + 50] = [True] * 50
        spans = sum(c and not (p and covered[p - 1]) for p, c in enumerate(covered))
        left = bytes(x for x, c in zip(b, covered) if not c)
        out.append((-1 if i is None else i, len(b), sum(covered), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=12, unique=True))
def test_matches_equal_direct_comparison(strings):
    index = runlength.RunLengthIndex(strings)
    tails = sorted((s[k:] , n, k) for n, s in enumerate(strings) for k in range(len(s) + 1))
    flat = [index.starts[n] + k for _, n, k in tails]
    assert index.order.tolist() == flat
    want = np.zeros(len(flat), dtype=int)
    for r in range(1, len(tails)):
        a, b = tails[r - 1][0], tails[r][0]
        while want[r] < min(len(a), len(b)) and a[want[r]] == b[want[r]]:
            want[r] += 1
    assert index.matches()[index.order].tolist() == want.tolist()
    assert index.lengths.sum() == len(index.text)


def texts(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(80)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(8, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        t = " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        for _ in range(rng.randint(0, 3)):
            t += rng.choice(passages)[rng.randint(0, 20) :] + rng.choice(words)
        rows.append((i * 3, t))
    return rows


def run(spark, rows, parts):
    df = spark.createDataFrame([(i, t, "en", "s", 0, "clash") for i, t in rows], SCHEMA).repartition(parts)
    got = runlength.remove_repeats(df).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)


def test_documents_equal_brute_force(spark):
    rows = texts(120, 2)
    rows += [(7, rows[4][1]), (8, rows[4][1]), (8, rows[4][1]), (None, rows[9][1]), (None, "z" * 70), (None, "z" * 70)]
    rows += [(1001, None), (1002, ""), (1003, "a" * 500), (1004, "a" * 60 + "b"), (1005, "ab" * 300), (1006, "x" * 49)]
    rows += [(1007, "x" * 49), (1008, "\0" * 60), (1009, "\0" * 60), (1010, "é" * 40), (1011, "y" + "é" * 40)]
    rows += [(2000, " ".join(t for _, t in rows[:60] if t))]
    want = brute(rows)
    assert run(spark, rows, 5) == want
    assert run(spark, rows, 1) == want


def test_empty_table(spark):
    assert runlength.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_kept_text(spark):
    long = "a passage that stands in two documents and is long enough to go"
    df = spark.createDataFrame([(1, "x " + long), (2, long + " y")], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in runlength.remove_repeats(df, keep_text=True).collect()}
    assert got == {1: ("x " + long).encode(), 2: b" y"}


def test_runs_are_those_of_each_text():
    rng = random.Random(5)
    bodies = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 70, 49, 50, 0, 400, 51, 3, 130)] + [b"a" * 90, b"a" * 90, b"\xff" * 60]
    arr = pa.array([b"left out", *bodies], pa.binary())[1:]
    data, ends = runlength.flat(arr)
    assert data.tobytes() == b"".join(bodies) and np.diff(ends).tolist() == list(map(len, bodies))
    start, size, anchor, text = runlength.runs(data, ends)
    one = [runlength.runs(*runlength.flat(pa.array([b], pa.binary()))) for b in bodies]
    assert [(t, s - ends[t], n, a) for s, n, a, t in zip(start, size, anchor, text)] == [(t, s, n, a) for t, o in enumerate(one) for s, n, a, _ in zip(*o)]
    assert [size[text == t].sum() for t in range(len(bodies))] == [max(0, len(b) - 49) for b in bodies]
    # equal windows have equal anchors, wherever they stand
    seen = {}
    for s, n, a, t in zip(start, size, anchor, text):
        for p in range(s, s + n):
            assert seen.setdefault(data[p : p + 50].tobytes(), a) == a
    a, n, run = runlength.pieces(np.array([5, 200]), np.array([100, 48]))
    assert (a.tolist(), n.tolist(), run.tolist()) == ([5, 53, 101, 200], [48, 48, 4, 48], [0, 0, 0, 1])


def test_only_stretches_with_a_common_window_are_compared(monkeypatch):
    rng = random.Random(6)
    made = [bytes(rng.choice(b"ab ") for _ in range(rng.randint(50, 97))) for _ in range(40)]
    made += [made[0][5:60] + b"?" * 20, made[1][:55], b"z" * 60]  # the last one repeats itself
    windows = [[s[k : k + 50] for k in range(len(s) - 49)] for s in made]
    every = [w for mine in windows for w in mine]
    assert runlength.repeated(made).tolist() == [any(every.count(w) > 1 for w in mine) for mine in windows]
    keys, marks = np.arange(len(made))[::-1].copy(), np.zeros(len(made), dtype=np.uint64)
    least = {}
    for key, mine in zip(keys.tolist(), windows):
        for w in mine:
            least[w] = min(key, least.get(w, key))
    want = [sum((least[w] < key) << i for i, w in enumerate(mine[:48])) for key, mine in zip(keys.tolist(), windows)]
    built = []
    plain = runlength.RunLengthIndex
    monkeypatch.setattr(runlength, "RunLengthIndex", lambda strings: built.append(len(strings)) or plain(strings))
    got = runlength.solve_bucket([made], [keys], [marks])[0]
    assert got.tolist() == want and built == [5]


def test_matches_over_many_symbols():
    long = bytes(range(256)) + b"\xff" * 8
    strings = [long, long[:-1] + b"\0", b"\xfe" + long[1:], b"\xff\xfe" * 9, b"\0" * 30, b"\0" * 31]
    test_matches_equal_direct_comparison.hypothesis.inner_test(strings)
