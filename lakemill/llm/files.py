"""Flat binary files in the folder that all executors share."""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyarrow import fs


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path)
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def fresh(folder: str, ending: str) -> str:
    """A name that no other attempt of a task uses, so a repeated task never meets half a file."""
    return f"{folder}/{uuid.uuid4().hex}{ending}"


class Writer:
    """Writes a file piece by piece, so a task never holds all of it."""

    def __init__(self, path: str) -> None:
        system, name = _opened(path)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        self.path, self.stream = path, system.open_output_stream(name)

    def add(self, values: np.ndarray) -> None:
        self.stream.write(np.ascontiguousarray(values).tobytes())

    def close(self) -> None:
        self.stream.close()


def mapped(path: str, dtype: str, count: int, offset: int = 0) -> np.ndarray:
    """Values of a file, memory-mapped if the folder is mounted, else read."""
    if not count:
        return np.zeros(0, dtype)
    system, name = _opened(path)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(name, dtype=dtype, mode="r", offset=offset, shape=(count,))
    with system.open_input_file(name) as file:
        file.seek(offset)
        return np.frombuffer(file.read(count * np.dtype(dtype).itemsize), dtype=dtype)
