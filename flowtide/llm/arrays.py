"""Raw numpy arrays in the shared folder: written once by tasks, memory-mapped by all workers.

A writer uses a name of its own and then renames, so a repeated or doubled task leaves one whole
file. Where the folder is no mounted file system, arrays go through ``pyarrow.fs`` and a reader keeps
them in memory.
"""

from __future__ import annotations

import mmap
import os
import uuid
from urllib.parse import urlparse

import numpy as np


def _local(path: str) -> str | None:
    parts = urlparse(path)
    return parts.path if parts.scheme in ("", "file") else None


def save(path: str, array: np.ndarray) -> None:
    if (place := _local(path)) is not None:
        os.makedirs(os.path.dirname(place), exist_ok=True)
        own = f"{place}.{uuid.uuid4().hex}"
        with open(own, "wb") as out:
            out.write(np.ascontiguousarray(array).data)
        os.replace(own, place)
        return
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    with system.open_output_stream(place) as out:
        out.write(np.ascontiguousarray(array).data)


def load(path: str, dtype: np.dtype | type) -> np.ndarray:
    if (place := _local(path)) is not None:
        if not os.path.getsize(place):
            return np.zeros(0, dtype)
        with open(place, "rb") as source:
            # The mapping outlives the file handle: thousands of shards need no open files.
            return np.frombuffer(mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), dtype)
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place) as source:
        return np.frombuffer(source.read(), dtype)
