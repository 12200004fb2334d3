import zlib

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import types as T

from cyclecount.llm import arrow_ids, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string"


def rows():
    texts = ["hello there", None, "", "word " * 3000, "Ünï  code\n\t漢字", "x" * 4000, "hello there", "2 # #"]
    return [(k * 7 % 50, t) for k, t in enumerate(texts * 12)] + [(None, "no key")]


def test_files_give_back_every_document(spark, tmp_dir):
    data = rows()
    df = spark.createDataFrame([(i, t, "en", "s", 0, "clash") for i, t in data], SCHEMA).repartition(5)
    manifest = arrow_ids.write_ids(df, f"{tmp_dir}/ids")
    got = arrow_ids.read_ids(manifest, f"{tmp_dir}/ids", T.LongType()).collect()
    assert len(got) == len(data)
    tok = tokens.Encoder(tokens.public("word_bpe_49k.json")).tokenizer
    want = sorted(
        (-1 if i is None else i, zlib.crc32(np.array(x, dtype="<u4").tobytes()), len(x))
        for i, t in data
        for x in [tok.encode(t or "", add_special_tokens=False).ids + [2]]
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32, r.n_tokens) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys)


def test_sequences_are_zero_copy_views_with_masks(spark, tmp_dir):
    df = spark.createDataFrame([(1, "alpha beta " * 9000), (2, "gamma")], "doc_id long, text string").coalesce(1)
    manifest = arrow_ids.write_ids(df, f"{tmp_dir}/ids")
    names = [(r.name, r.n_tokens) for r in manifest.orderBy("part").collect()]
    tok = tokens.Encoder(tokens.public("word_bpe_49k.json")).tokenizer
    ids = [tok.encode(t, add_special_tokens=False).ids + [2] for t in ("alpha beta " * 9000, "gamma")]
    flat = [x for part in ids for x in part]
    back = []
    for name, n in names:
        shard = arrow_ids.ShardReader(f"{tmp_dir}/ids", name)
        for k in range(-(-n // arrow_ids.SEQUENCE)):
            seq, mask = shard.sequence(k)
            assert len(seq) == len(mask) == arrow_ids.SEQUENCE
            assert not seq.flags.owndata
            back += seq[mask].tolist()
    assert back == flat


def test_empty_table(spark, tmp_dir):
    manifest = arrow_ids.write_ids(spark.createDataFrame([], SCHEMA), f"{tmp_dir}/ids")
    assert arrow_ids.read_ids(manifest, f"{tmp_dir}/ids", T.LongType()).count() == 0


def test_ids_that_do_not_fit_are_refused(spark, tmp_dir):
    df = spark.createDataFrame([(1, "alpha beta")], "doc_id long, text string")
    with pytest.raises(PythonException, match="need more than 15 bits"):
        arrow_ids.write_ids(df, f"{tmp_dir}/few", bits=15)
    with pytest.raises(PythonException, match="need more than 16 bits"):
        arrow_ids.write_ids(df, f"{tmp_dir}/end", end_id=70_000)
