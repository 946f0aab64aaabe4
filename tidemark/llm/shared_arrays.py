"""Numeric arrays that tasks write to the shared work folder and other tasks memory-map.

They hold raw little-endian values without a header; whoever reads them knows type and shape."""

from __future__ import annotations

import functools
import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def write_array(path: str, values: np.ndarray) -> None:
    """Write raw values in one step: a retried task replaces the same content."""
    store, target = pafs.FileSystem.from_uri(path) if "://" in _plain(path) else (pafs.LocalFileSystem(), _plain(path))
    store.create_dir(os.path.dirname(target), recursive=True)
    fresh = f"{target}.{uuid.uuid4().hex}"
    with store.open_output_stream(fresh) as out:
        out.write(pa.py_buffer(np.ascontiguousarray(values)))
    store.move(fresh, target)


@functools.lru_cache(maxsize=512)
def mapped_array(path: str, dtype: str) -> np.ndarray:
    """The values of a file, memory-mapped where the shared folder is mounted; none if there is no file."""
    if "://" not in _plain(path):
        if not os.path.exists(_plain(path)) or not os.path.getsize(_plain(path)):
            return np.zeros(0, dtype)
        return np.memmap(_plain(path), dtype, mode="r")
    store, target = pafs.FileSystem.from_uri(path)
    if store.get_file_info(target).type == pafs.FileType.NotFound:
        return np.zeros(0, dtype)
    with store.open_input_stream(target) as source:
        return np.frombuffer(source.read(), dtype)
