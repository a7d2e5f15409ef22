"""Files that operators write and read themselves, in the shared folder and by any scheme that pyarrow opens."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@contextmanager
def writing(uri: str) -> Iterator:
    """An output stream; the file gets its name when it is whole, so that a failed or doubled task leaves no part of one."""
    store, path = _at(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    unfinished = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with store.open_output_stream(unfinished, compression=None, buffer_size=1 << 20) as f:
            yield f
        store.move(unfinished, path)
    except BaseException:
        if store.get_file_info(unfinished).is_file:
            store.delete_file(unfinished)
        raise


def reading(uri: str):
    store, path = _at(uri)
    return store.open_input_stream(path, compression=None, buffer_size=1 << 20)


def random_access(uri: str):
    store, path = _at(uri)
    return store.open_input_file(path)
