"""Arrow functions on the executors, with this package sent along."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import millrace


def _send_package(spark: SparkSession) -> None:
    """Gives the executors this package once per Spark context; they need no installation of it."""
    context = spark.sparkContext
    if getattr(context, "_millrace_sent", False):
        return
    top = os.path.dirname(os.path.abspath(millrace.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("millrace", os.path.relpath(path, top)))
    context.addPyFile(target)
    context._millrace_sent = True


def give_back() -> None:
    """Memory that nothing uses any more goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidied(run: Callable) -> Callable:
    """``run``, after whose last batch its memory is given back: Spark uses a worker again, and free memory that it holds adds to the next task's."""

    def tidy(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def in_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` whose function may use this package's modules."""
    _send_package(df.sparkSession)
    return df.mapInArrow(tidied(run), schema)


def packed_numbers(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, byte by byte, so that the high bytes of small numbers take next to nothing."""
    head = [np.array([len(arrays)], np.int64), *(np.array([ord(x.dtype.char), x.itemsize, len(x)], np.int64) for x in arrays)]
    raw = b"".join(x.tobytes() for x in head) + b"".join(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in arrays)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked_numbers(blob) -> list[np.ndarray]:
    """The arrays that ``packed_numbers`` was given."""
    blob = memoryview(blob.as_buffer() if isinstance(blob, pa.Scalar) else blob)
    raw = pa.decompress(pa.py_buffer(blob[8:]), decompressed_size=int(np.frombuffer(blob[:8], np.int64)[0]), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    kinds, at, out = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(n, 3).tolist(), 8 + 24 * n, []
    for kind, size, length in kinds:
        flat = np.frombuffer(raw, np.uint8, size * length, at).reshape(size, length)
        out.append(np.ascontiguousarray(flat.T).view(np.dtype(chr(kind))).reshape(length))
        at += size * length
    return out
