"""Helpers shared by the operators of this subpackage.

Every operator keeps the caller's columns inside one struct (``rec``) while it
works, so its own working names can never clash with the caller's.  Numpy
kernels work on a few megabytes at a time (``BLOCK_BYTES``), whatever the size
of the Arrow batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

#: Bytes of text that one numpy step works on.
BLOCK_BYTES = 1 << 20

U64 = np.uint64
#: Fixed odd multipliers of the 64-bit mixers (any odd constants would do).
K1 = U64(0x9E3779B97F4A7C15)
K2 = U64(0xC2B2AE3D27D4EB4F)
K3 = U64(0x165667B19E3779F9)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The shuffles behind ``df`` are then garbage; the collection lets Spark's
    cleaner drop their files at once instead of at the driver's next one.
    ``options`` go to the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-llm-{name}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(frames: list[DataFrame]) -> None:
    """Delete tables that ``materialise`` wrote and nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def record(df: DataFrame, name: str = "rec", keep: list[str] | None = None) -> Column:
    """All columns of ``df``, or those to ``keep`` (one at least), as one struct."""
    return F.struct(*[df[f"`{c}`"] for c in (df.columns if keep is None else keep)]).alias(name)


def unpack(names: list[str], outputs: dict[str, Column], rec: str = "rec") -> list[Column]:
    """The caller's columns, then the outputs; an output replaces a caller's
    column of the same name (case-insensitively, as Spark resolves names)."""
    taken = {o.lower() for o in outputs}
    kept = [F.col(f"{rec}.`{c}`").alias(c) for c in names if c.lower() not in taken]
    return kept + [v.alias(k) for k, v in outputs.items()]


def fold(column: str | Column) -> Column:
    """crc32 of an id as text, or of nothing for a null id."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(33))) * K1
    x = (x ^ (x >> U64(29))) * K2
    return x ^ (x >> U64(32))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def blocks(values: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows that hold about ``limit`` bytes (one row at least)."""
    first, held = 0, 0
    for i, v in enumerate(values):
        if i > first and held + len(v) > limit:
            yield first, i
            first, held = i, 0
        held += len(v)
    if first < len(values):
        yield first, len(values)


def byte_class(separators: str) -> np.ndarray:
    """256 booleans: True where the byte separates words."""
    t = np.zeros(256, bool)
    t[[ord(c) for c in separators]] = True
    return t


#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Space and the five control characters 0x09-0x0D.
SPACES = byte_class("\t\n\x0b\x0c\r ")


def joined(values: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All rows in one byte array, each followed by ``gap``; and where each begins."""
    data = np.frombuffer(gap.join(values) + gap, np.uint8) if values else np.zeros(0, np.uint8)
    sizes = np.fromiter((len(v) for v in values), np.int64, len(values)) + len(gap)
    return data, np.concatenate(([0], np.cumsum(sizes)))


#: Masks of the first 0 to 8 bytes of a lane.
_HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def named(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit id of each string ``data[start:end]``, none of them empty.

    It sums the string's eight-byte lanes, each scrambled with its place by a
    bijection that no polynomial describes, and the length: strings that differ
    in one lane never share an id, others by chance only (1 in 2^64)."""
    size = ends - starts
    lanes = (size + 7) >> 3
    lane = np.cumsum(lanes) - lanes
    of = np.repeat(np.arange(len(size)), lanes)
    k = np.arange(len(of)) - lane[of]
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    view = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # eight bytes from each byte on
    x = view[starts[of] + 8 * k] & _HEAD[np.minimum(size[of] - 8 * k, 8)]
    x = mix(mix(x ^ K1) + (k + 1).astype(U64) * K2)
    return mix((np.add.reduceat(x, lane) if len(lane) else x) + size.astype(U64) * K3)


def words(values: list[bytes], separators: np.ndarray = SPACES
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit id per lower-cased word, words per row, and each word's first
    byte in its row.  A row's words are consecutive."""
    data, begins = joined(values)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], separators[data])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    per = np.diff(np.searchsorted(starts, begins))
    return named(LOWER[data], starts, ends), per, starts - np.repeat(begins[:-1], per)


def write_arrow(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
         else columns[f.name] for f in schema], schema=schema)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session.  Needed where they
    were not started with it on their path (``--py-files`` does the same)."""
    import os
    import tempfile
    import zipfile

    import tidemark

    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tidemark.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-ship-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tidemark_shipped = True
