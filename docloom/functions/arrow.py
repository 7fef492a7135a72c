"""Row-stream helpers for mapInArrow operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa


def chunked(fn: Callable[[pa.RecordBatch], dict[str, list]], schema: pa.Schema, rows: int = 512) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that feeds ``fn`` slices of at most ``rows`` input rows.

    The slice bounds the Python memory of one step whatever the batch size is;
    an empty result yields no batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows))
                if out and len(next(iter(out.values()))):
                    yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run
