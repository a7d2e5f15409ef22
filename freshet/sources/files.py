"""What the readers of single files share: local paths, and Arrow batches of columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa

SPARK = {"b": "boolean", "i": "long", "u": "long", "f": "double", "U": "string", "O": "string", "S": "string"}


def local(path: str) -> str:
    """The path for readers that need a file; it must be the same place for driver and executors."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path} is no path of a file system that is mounted here")
    return path


@contextmanager
def whole(path: str) -> Iterator[str]:
    """A name to write to; the file gets its own name when it is whole."""
    path = local(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    unfinished = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        yield unfinished
        os.replace(unfinished, path)
    except BaseException:
        if os.path.exists(unfinished):
            os.remove(unfinished)
        raise


def spark_type(values: np.dtype) -> str:
    return SPARK[values.kind]


def batch(columns: Sequence[np.ndarray], names: Sequence[str]) -> pa.RecordBatch:
    """Columns as the Spark types of ``spark_type``; NaN becomes null."""
    kinds = {"boolean": pa.bool_(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c.tolist() if spark_type(c.dtype) == "string" else c, kinds[spark_type(c.dtype)], from_pandas=True) for c in columns], names=list(names))


def ranges(n: int, parts: int) -> list[tuple[int, int]]:
    """0 .. n in at most so many even ranges."""
    parts = max(1, min(parts, n))
    return [(n * k // parts, n * (k + 1) // parts) for k in range(parts)]
