"""Small helpers for Arrow batches of texts inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Bytes of text that a task works on at a time; a longer single text is a piece of its own.
CHUNK_BYTES = 4 << 20


def text_chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose texts have about ``most`` bytes together."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
