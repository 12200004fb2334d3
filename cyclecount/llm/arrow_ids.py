"""Operator 4: token ids in Arrow files of fixed-size-list batches.

Documents are dealt by ranges of their key; each range is one shard, written by its task in
ascending key order, a batch at a time. A shard is two Arrow files. ``ids``: record batches
of equal-length sequences, the columns ids and mask fixed-size lists without nulls, so that
sequence k of a memory-mapped file is a zero-copy view at a place known beforehand (batch
k // BATCH, row k % BATCH); the last sequence is padded, mask false. ``docs``: key, start in
the shard, and length of each document. Ids use 16 bits where the vocabulary fits. A file
gets its name only when it is complete, so a repeated task leaves whole files.

Defined cases: a null text is an empty text, the end id alone; a null key comes first;
repeated keys are documents of their own, ordered by text; an empty table gives no shards
and an empty result. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclecount.llm import tokens
from cyclecount.llm.common import bounded_batches, materialize, open_folder, table
from cyclecount.session import scratch_path

TOKENIZER, END_ID = "word_bpe_49k.json", 2
#: Ids of a sequence, and sequences of a record batch.
SEQUENCE, BATCH = 2048, 256


class ShardWriter:
    """Writes one shard: ids cut into equal-length sequences, and the documents' places."""

    def __init__(self, uri: str, name: str, key_type: pa.DataType, bits: int):
        self.fs, self.path = open_folder(uri)
        self.fs.create_dir(self.path, recursive=True)
        self.name, self.attempt = name, uuid.uuid4().hex
        self.dtype = np.dtype(f"<u{bits // 8}")
        ids = pa.list_(pa.field("item", pa.from_numpy_dtype(self.dtype), nullable=False), SEQUENCE)
        mask = pa.list_(pa.field("item", pa.bool_(), nullable=False), SEQUENCE)
        self.ids_schema = pa.schema([pa.field("ids", ids, nullable=False), pa.field("mask", mask, nullable=False)])
        self.docs_schema = pa.schema([("key", key_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.files = {k: self.fs.open_output_stream(self._temp(k)) for k in ("ids", "docs")}
        self.ids = pa.ipc.new_file(self.files["ids"], self.ids_schema)
        self.docs = pa.ipc.new_file(self.files["docs"], self.docs_schema)
        self.pending, self.held, self.n_tokens, self.n_docs = [], 0, 0, 0

    def _temp(self, kind: str) -> str:
        return f"{self.path}/_{self.name}.{kind}.{self.attempt}"

    def _put(self, flat: np.ndarray, real: int) -> None:
        mask = np.ones(len(flat), dtype=bool)
        mask[real:] = False
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(v), type=self.ids_schema.field(k).type)
            for k, v in enumerate((flat, mask))
        ]
        self.ids.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.ids_schema))

    def add(self, keys: pa.Array, ids: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        columns = [keys, pa.array(starts), pa.array(sizes)]
        self.docs.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.docs_schema))
        self.pending += ids
        self.held += int(sizes.sum())
        self.n_tokens += int(sizes.sum())
        self.n_docs += len(ids)
        block = SEQUENCE * BATCH
        if self.held >= block:
            flat = np.concatenate(self.pending).astype(self.dtype, copy=False)
            whole = len(flat) // block * block
            for at in range(0, whole, block):
                self._put(flat[at : at + block], block)
            self.pending, self.held = [flat[whole:]], len(flat) - whole

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.pending).astype(self.dtype, copy=False)
            padded = np.zeros(-(-len(flat) // SEQUENCE) * SEQUENCE, dtype=self.dtype)
            padded[: len(flat)] = flat
            self._put(padded, len(flat))
        for kind, writer in (("ids", self.ids), ("docs", self.docs)):
            writer.close()
            self.files[kind].close()
            self.fs.move(self._temp(kind), f"{self.path}/{self.name}.{kind}.arrow")


class ShardReader:
    """Random access to a shard's sequences and documents."""

    def __init__(self, uri: str, name: str):
        fs, path = open_folder(uri)

        def source(kind: str):
            file = f"{path}/{name}.{kind}.arrow"
            return pa.memory_map(file) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(file)

        self.ids, self.docs = pa.ipc.open_file(source("ids")), pa.ipc.open_file(source("docs"))
        self._at, self._flat = -1, None

    def _batch(self, k: int) -> np.ndarray:
        """The ids of record batch ``k``, a view of the file where it is memory-mapped."""
        if k != self._at:
            self._at, self._flat = k, self.ids.get_batch(k).column(0).flatten().to_numpy(zero_copy_only=True)
        return self._flat

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence ``k``'s ids and mask."""
        batch, row = divmod(k, BATCH)
        ids = self._batch(batch)[row * SEQUENCE : (row + 1) * SEQUENCE]
        mask = self.ids.get_batch(batch).column(1)[row].values.to_numpy(zero_copy_only=False)
        return ids, mask

    def tokens(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ``n`` ids from ``start`` on, in runs that don't cross record batches."""
        block = SEQUENCE * BATCH
        while n:
            k, at = divmod(start, block)
            run = self._batch(k)[at : at + n]
            yield run
            start, n = start + len(run), n - len(run)


def write_ids(
    docs: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    bits: int = 16,
) -> DataFrame:
    """Write the shards; returns the manifest, one row a shard: part, name, n_docs, n_tokens."""
    bounded_batches(docs.sparkSession, 500)
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    dealt = slim.repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, shard = f"shard-{part:07d}", None
        encoder = tokens.encoder(tokens.public(tokenizer))
        if max(encoder.greatest(), end_id) >> bits:
            raise ValueError(f"ids of {tokenizer} need more than {bits} bits")
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = shard or ShardWriter(folder, name, batch.column(0).type, bits)
            ids = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            shard.add(batch.column(0), [np.frombuffer(x + end, dtype="<u4").astype(shard.dtype) for x in ids])
        if shard:
            shard.close()
            row = {"part": part, "name": name, "n_docs": shard.n_docs, "n_tokens": shard.n_tokens}
            yield pa.RecordBatch.from_pylist([row])

    return materialize(dealt.mapInArrow(write, "part long, name string, n_docs long, n_tokens long"), "manifest")


def read_ids(manifest: DataFrame, folder: str, key_type: T.DataType, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start (over all shards), n_tokens, ids_crc32."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    shards = manifest.select("part", "name", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("before"))
    schema = T.StructType(
        [T.StructField(key, key_type), *[T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")]]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardReader(folder, row["name"])
                for k in range(shard.docs.num_record_batches):
                    docs = shard.docs.get_batch(k)
                    starts, sizes = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                    crcs = np.zeros(len(starts), dtype=np.int64)
                    for i, (start, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
                        crc = 0
                        for run in shard.tokens(start, n):
                            crc = zlib.crc32(run.astype("<u4").tobytes(), crc)
                        crcs[i] = crc
                    columns = [docs.column(0), pa.array(starts + row["before"]), docs.column(2), pa.array(crcs)]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

    spread = shards.repartition(max(1, manifest.count()))  # a shard or so for each task
    return spread.mapInArrow(read, schema)


def op4_arrow_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: writes all documents' ids to a folder beside the checkpoints and reads
    every document back from the files."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-ids")
    manifest = write_ids(docs, folder)
    return read_ids(manifest, folder, docs.schema["doc_id"].dataType)
