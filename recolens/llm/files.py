"""Binary files of tasks in the shared folder, and packed sorted arrays for the way through a shuffle."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def write_file(folder: str, name: str, arrays: list[np.ndarray]) -> str:
    """Write arrays one after another into a new file of their own; its path.

    Each attempt of a task writes a new file, and a file counts only through the row that the
    successful attempt returns, so a lost executor leaves at most an unused file.
    """
    system, where = file_system(folder)
    system.create_dir(where, recursive=True)
    tail = f"/{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(where + tail) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).data.cast("B") if a.size else b"")
    return folder + tail


def read_file(path: str) -> np.ndarray:
    """The bytes of a file: memory-mapped where it is on a mounted file system, else read."""
    system, where = file_system(path)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(where, np.uint8, "r")
    with system.open_input_file(where) as source:
        return np.frombuffer(source.read_buffer(), np.uint8)


_CODEC = "zstd"


def pack(values: np.ndarray) -> bytes:
    """A sorted unsigned array as compressed byte planes of its differences."""
    v = values.astype(np.uint64)
    steps = np.diff(v, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec=_CODEC, asbytes=True) if len(v) else b""


def unpack(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec=_CODEC), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Unsigned numbers in any order, small ones in few bytes."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec=_CODEC, asbytes=True) if len(values) else b""


def unpack_small(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec=_CODEC), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts
