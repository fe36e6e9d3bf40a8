"""Small helpers shared by the operators of this package.

Words everywhere are maximal runs of `[^\\x20\\x09-\\x0D]`: `bytes.split()`
cuts at exactly those six characters, so UTF-8 words come from
`text.encode().split()`.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, hadoop_path
from ..sources.tables import read_table  # noqa: F401  (the queries of this package read tables with it)

#: Java regular expression of one word.
WORD = r"[^\x20\x09-\x0D]+"
#: The same characters for str.strip.
BLANKS = " \t\n\x0b\x0c\r"
#: Characters of text that a Python worker works on at a time; its arrays take
#: some fifty times as many bytes.
BATCH_BYTES = 3 << 20
#: Units per shuffle partition (see in_units).
UNITS = 2
INT64_MAX = (1 << 63) - 1
#: Narrow rows that a task takes at ease (see packed).
ROWS_PER_PARTITION = 100_000


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later plans start from files
    that survive any executor."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)


def forget(*frames: DataFrame) -> None:
    """Deletes the files of frames made by `cut` that nothing will read again."""
    for df in frames:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            fs, path = hadoop_path(df.sparkSession, file.get())
            fs.delete(path, True)


def packed(df: DataFrame, rows: int) -> DataFrame:
    """df in as many partitions as `rows` (a bound of its rows) need, at most
    those it has: what follows a shuffle of a few rows need not be dealt widely."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_PARTITION)))


def text_id(text: str | Column) -> Column:
    """128-bit identity of a text (16 bytes)."""
    return F.unhex(F.md5(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary")))


def release() -> None:
    """Gives freed memory back to the system: a Python worker outlives its task
    and idles beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not with every C library
        ctypes.CDLL(None).malloc_trim(0)


def chunks(batches: Iterable[pa.RecordBatch], weight: Callable[[dict], list[int]] | None = None,
           text: str = "text", limit: int = BATCH_BYTES) -> Iterator[dict[str, list]]:
    """Columns as Python lists, cut so that one piece holds about `limit`
    characters of `text` (a longer text is a piece of its own)."""
    for batch in batches:
        cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        lo, held = 0, 0
        for i, t in enumerate(cols[text]):
            held += len(t) if t is not None else 0
            if held >= limit:
                yield {n: v[lo:i + 1] for n, v in cols.items()}
                lo, held = i + 1, 0
        if lo < batch.num_rows:
            yield {n: v[lo:] for n, v in cols.items()}
        del cols
    release()


class Numbers(dict):
    """Numbers 0, 1, 2, ... for keys in order of first look-up."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def in_units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and unit: a share of the documents that is dealt by the
    hash of the row, so that every copy of a hot text sits elsewhere."""
    n = UNITS * shuffle_partitions(docs.sparkSession)
    return docs.select(
        F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)), F.lit(n)).cast("int").alias("unit"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
