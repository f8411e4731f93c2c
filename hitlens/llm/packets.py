"""Packets: bounded runs of documents, compressed into one value each.

Jobs that need a text twice, with what the corpus says about it in between,
move packets instead of texts, and ask the corpus once per packet instead of
once per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext

#: Text bytes of a packet; a longer document is a packet of its own.
PACKET_BYTES = 16 << 20


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def packets(batches: Iterator[pa.RecordBatch], text: int, size: int = PACKET_BYTES) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(packet id, its rows) over one partition; ``text`` is the index of the binary text column.

    Ids are unique within one run of the job, so its result is to be written
    before they are used.
    """
    base, count = TaskContext.get().partitionId() << 24, 0
    held: list[pa.RecordBatch] = []
    load = 0
    for batch in batches:
        lengths = [len(x) if x is not None else 0 for x in batch.column(text).to_pylist()]
        start = 0
        for i, n in enumerate(lengths):
            if load and load + n > size:
                yield base + count, pa.Table.from_batches([*held, batch.slice(start, i - start)]).combine_chunks().to_batches()[0]
                held, load, start, count = [], 0, i, count + 1
            load += n
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield base + count, pa.Table.from_batches(held).combine_chunks().to_batches()[0]
