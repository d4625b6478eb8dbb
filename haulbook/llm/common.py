"""Helpers shared by the training-data operators: stored tables in the shared folder, and hashed words."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed value of the word rule: everything but a space and the ASCII controls tab to carriage return.
WORDS = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names. A temporary folder serves a local session alone."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, and kept when executors are lost."""
    path = shared_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove stored frames that no later result reads."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc_of(name: str = "doc_id") -> Column:
    """crc32 of the id as text; an id that is null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_or_empty(name), F.lit(WORDS)).cast("long")


def ascii_words(text: str) -> list[bytes]:
    """Words of the word rule with A-Z in lower case, as UTF-8."""
    return text.encode().lower().split()


def word_codes(words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words and the distinct words, in the order of their first use."""
    boxed = np.empty(len(words), dtype=object)
    boxed[:] = words
    codes, kinds = pd.factorize(boxed)
    return codes.astype(np.int32), kinds


def word_hashes(kinds: np.ndarray) -> np.ndarray:
    """64-bit hashes of distinct words."""
    return pd.util.hash_array(kinds, categorize=False) if len(kinds) else np.zeros(0, dtype=np.uint64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well-spread 64-bit image of 64-bit numbers; the same salt gives the same image."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, lengths: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and the text each belongs to.

    ``words`` are word hashes of texts laid end to end, ``lengths`` their word counts.
    A text with fewer words is one run of all of them; one without words has none.
    """
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    runs = np.maximum(lengths - width + 1, np.minimum(lengths, 1))
    start = np.flatnonzero(place < runs[owner]) if len(words) else np.zeros(0, dtype=np.int64)
    left = np.minimum(lengths[owner[start]] - place[start], width)
    out = np.zeros(len(start), dtype=np.uint64)
    for k in range(width):
        at = np.minimum(start + k, max(len(words) - 1, 0))
        step = mixed(out ^ words[at], k)
        out = np.where(left > k, step, out)
    return out, owner[start]


def giving_back(run: Callable) -> Callable:
    """A task's function after which its Python worker returns free memory to the system: Spark keeps workers for later tasks,
    and what several operators once needed would stay with each of them."""
    @functools.wraps(run)
    def whole(frames):
        yield from run(frames)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # only glibc has it
        if trim:
            trim(0)

    return whole


def batched(frames: Iterator[pd.DataFrame], column: str, most: int) -> Iterator[pd.DataFrame]:
    """Slices of the frames whose texts hold about ``most`` characters together; one text is never cut."""
    for frame in frames:
        sizes = frame[column].str.len().to_numpy(dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        for cut in np.split(np.arange(len(frame)), np.flatnonzero(np.diff(part)) + 1):
            if len(cut):
                yield frame.iloc[cut]
