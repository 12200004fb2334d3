"""Parts of a corpus kept in the shared folder, for operators that go over the texts more than
once without shuffling them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext

from cyclecount.llm.common import open_folder

#: Bytes of a part's batches, so that what a task gathers of a part is bounded.
PART_BYTES = 32 << 20


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """The task's batches by parts of bounded size, with the part's number."""
    first = TaskContext.get().partitionId() << 20
    held: list[pa.RecordBatch] = []
    size, n = 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= PART_BYTES:
            yield first + n, held
            held, size, n = [], 0, n + 1
    if held:
        yield first + n, held


class Part:
    """The rows of one part, or what else is kept of it under a ``name``, in a file of the shared
    folder. A repeated task writes the same file again; it gets its name when it is complete."""

    def __init__(self, folder: str, part: int, name: str = "part"):
        self.fs, self.path = open_folder(folder)
        self.file = f"{self.path}/{name}-{part:012d}.parquet"

    def write(self, batches: list[pa.RecordBatch], rows: int = 500) -> None:
        self.fs.create_dir(self.path, recursive=True)
        temp = f"{self.path}/_{uuid.uuid4().hex}"
        pq.write_table(pa.Table.from_batches(batches), temp, filesystem=self.fs, compression="zstd", row_group_size=rows)
        self.fs.move(temp, self.file)

    def read(self) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_file(self.file) as source:
            yield from pq.ParquetFile(source).iter_batches(batch_size=500)

    def whole(self) -> pa.Table:
        with self.fs.open_input_file(self.file) as source:
            return pq.ParquetFile(source).read()
