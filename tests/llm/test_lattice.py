import itertools
import random
import re

import pytest

from cyclecount.llm import lattice

DOCS = "doc_id long, text string, source string, lang string, mask string"
LABELS = "doc_id long, quality int, toxic int, part string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def fails(rows, i):
    key, text, *_ = rows[i]
    text = text or ""
    words = WORD.findall(text)
    out = ""
    out += "A" if len(words) < 50 else ""
    out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
    out += "D" if re.search("[#$%&*|]", text) else ""
    same = any(k is not None and key is not None and k < key and (t or "") == text for k, t, *_ in rows)
    return out + ("E" if same else "")


def brute(rows, labels, orders):
    docs = []
    for i, r in enumerate(rows):
        good = any(k == r[0] and q == 1 for k, q, *_ in labels if k is not None)
        toxic = any(k == r[0] and t == 1 for k, _, t, *_ in labels if k is not None)
        docs.append((r[2] or "", fails(rows, i), good, toxic))
    out, shapley = [], {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in orders:
            for step, f in enumerate(order):
                alive = [d for d in mine if not set(d[1]) & set(order[:step])]
                hit = [d for d in alive if f in d[1]]
                redundant = sum(f in d[1] for d in mine) - len(hit)
                shapley[part, f] = shapley.get((part, f), 0) + len(hit)
                out.append((part, order, step + 1, f, len(alive) - len(hit), len(hit), redundant,
                            sum(d[1] == f for d in mine), sum(d[2] for d in hit), sum(d[3] for d in hit)))
    return sorted((*r, shapley[r[0], r[3]]) for r in out)


COLUMNS = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def corpus():
    rng = random.Random(11)
    kinds = [
        lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)),
        lambda: " ".join(rng.choice("ab") for _ in range(80)),
        lambda: "Short $ text " * rng.randrange(1, 3),
        lambda: "LOUD " * rng.randrange(1, 80),
        lambda: "",
        lambda: None,
        lambda: "  é" * 20,
        lambda: "the same passage in many documents # " + " ".join(map(str, range(70))),
    ]
    rows = [(i, rng.choice(kinds)(), rng.choice(["s1", "s1", "s1", "s2", "", None]), "xx", "clash") for i in range(160)]
    rows += [rows[3], rows[7], (None, "the same", "s1", None, None), (None, "the same", "s1", None, None), (500, "the same", None, None, None)]
    rows += [(501, "x y " * 30000 + "z", "s3", None, None), (-4, rows[10][1], "s2", None, None)]
    labels = [(i, rng.randrange(2), rng.randrange(2), "clash") for i in range(0, 160, 2)]
    labels += [(4, 1, 0, None), (4, 0, 1, None), (None, 1, 1, None), (9999, 1, 1, None), (6, None, None, None)]
    return rows, labels


def test_equals_every_order_run_by_hand(spark):
    rows, labels = corpus()
    counts = lattice.failures(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    assert rows_of(lattice.audit(counts, "ABCDE")) == brute(rows, labels, orders)


def test_bound_orders_are_the_only_paths(spark):
    rows, labels = corpus()
    counts = lattice.failures(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    bound = [("E", "A"), ("A", "C")]
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    orders = [o for o in orders if all(o.index(a) < o.index(b) for a, b in bound)]
    assert rows_of(lattice.audit(counts, "ABCDE", bound)) == brute(rows, labels, orders)


@pytest.mark.parametrize("n", [1, 3, 6])
def test_path_counts(n):
    names = "ABCDEF"[:n]
    forward, backward = lattice.paths(names)
    total = len(list(itertools.permutations(names)))
    for size in range(n + 1):
        at = [s for s in range(1 << n) if bin(s).count("1") == size]
        assert sum(forward[s] * backward[s] for s in at) == total


def test_empty_table(spark):
    counts = lattice.failures(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert rows_of(lattice.audit(counts, "ABCDE")) == []
