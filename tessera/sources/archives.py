"""Archives of game records, and which of the files on offer are new."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.games import event_year


def safe_member(name: str) -> bool:
    """Whether an archive's member stays below the folder it is unpacked to."""
    parts = name.replace("\\", "/").split("/")
    return bool(name) and not name.startswith(("/", "\\")) and ".." not in parts and ":" not in parts[0]


def members(spark: SparkSession, path: str, years: tuple[int, int] | None = None, most_bytes: int = 1 << 28) -> DataFrame:
    """(path, member, content) of the files in zip archives, an archive a task; a member whose path leads out of its folder is an error.

    With ``years``, archives whose name stands for a year outside of it are not opened, nor are those without a year. A member of over ``most_bytes`` is an error, as
    it is held whole.
    """

    def unpack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for where, data in zip(part["path"], part["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
                    for info in z.infolist():
                        if info.is_dir():
                            continue
                        if not safe_member(info.filename):
                            raise ValueError(f"unsafe path in an archive: {info.filename}")
                        if info.file_size > most_bytes:
                            raise ValueError(f"too large: {info.filename}")
                        yield pd.DataFrame({"path": [where], "member": [info.filename], "content": [z.read(info)]})

    files = spark.read.format("binaryFile").load(path)
    if years:
        files = files.where(event_year(F.col("path")).between(*years))
    return files.select("path", "content").mapInPandas(unpack, "path string, member string, content binary")


def changed(listing: DataFrame, known: DataFrame) -> DataFrame:
    """The files (url, size) of a listing that aren't known with that size, which an incremental download fetches."""
    return listing.join(known.select("url", "size").distinct(), ["url", "size"], "left_anti")
