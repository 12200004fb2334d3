import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclecount.llm import iblt

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string"


def brute(a, b):
    x, y = set(iblt.digests(a).tolist()), set(iblt.digests(b).tolist())
    return len(x & y) / len(x | y)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 60), max_size=80), st.lists(st.integers(0, 60), max_size=80)), max_size=8))
def test_likeness_equals_the_sets(pairs):
    texts = [("\n".join(map(str, a)), "\n".join(map(str, b))) for a, b in pairs]
    got = iblt.likeness([(iblt.digests(a), iblt.digests(b)) for a, b in texts])
    assert got == [brute(a, b) for a, b in texts]


def test_peeling_recovers_the_digests_themselves():
    a, b = iblt.digests("one\ntwo\nthree\nfour"), iblt.digests("one\ntwo\nfive")
    cells = iblt.Sketches(1, 60)
    cells.add(np.zeros(len(a), dtype=np.int64), a, np.ones(len(a), dtype=np.int64))
    cells.add(np.zeros(len(b), dtype=np.int64), b, -np.ones(len(b), dtype=np.int64))
    done, _, keys, signs = cells.peel()
    assert done.all()
    assert {(int(k), int(s)) for k, s in zip(keys, signs, strict=True)} == {
        *((int(k), 1) for k in set(a) - set(b)),
        *((int(k), -1) for k in set(b) - set(a)),
    }


def test_documents(spark):
    texts = ["a b c\n" * 50, "é漢\nx", None, "", "word " * 3000, "a b c\n" * 50, "z", "line one\nline two\nline three"]
    rows = [(i, t, "en", "s", 0, "clash") for i, t in enumerate(texts)] + [(None, "no key", "en", "s", 0, "")]
    for parts in (1, 6):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = {r.doc_id: r for r in iblt.fingerprints(df).collect()}
        assert len(got) == len(rows)
        order = sorted(range(len(texts)), reverse=True) + [None]
        plain = {i: t or "" for i, t, *_ in rows}
        for i, j in zip(order, order[1:] + order[:1], strict=True):
            t, u = plain[i], plain[j]
            new = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
            assert got[i].n_chars == len(t)
            assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
            assert got[i].near_edited == brute(t, new) and got[i].near_next == brute(t, u)
        assert got[0].fingerprint == got[5].fingerprint != got[1].fingerprint


def test_one_document_and_empty_table(spark):
    one = spark.createDataFrame([(1, "abcdef", "en", "s", 0, "")], SCHEMA)
    r = iblt.fingerprints(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    assert r[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert iblt.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
