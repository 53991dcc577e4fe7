"""What many text files are: size, encoding and first line of each, found by two jobs whatever their number."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import bounded

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"


@dataclass(frozen=True)
class Source:
    """A CSV file, or a folder of them that were written as one."""
    path: str
    header: tuple[str, ...]
    encoding: str
    size: int


def plain(path: str) -> str:
    """A path without scheme, host and escapes, so that two spellings of it compare equal."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", unquote(path)).rstrip("/")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, size, line, whether it lies in the file's first block, and its place: lines of a block lie in one partition, in order."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("value").alias("line"),
        (F.col("_metadata.file_block_start") == 0).alias("opens"), F.monotonically_increasing_id().alias("place"))


def header_of(spark: SparkSession, path: str, encoding: str) -> list[str] | None:
    """The header of one CSV file, or folder of them, of a known encoding; none without a line.

    Nothing but the first lines is looked for, so reading stops at the first one of a file. Files of a folder
    have one header, which its scan checks.
    """
    first = _lines(spark, [path]).where("opens").select(F.col("line").cast("binary")).head(1)
    return next(csv.reader([bytes(first[0][0]).decode(encoding, "replace")]), []) if first else None


def inventory(spark: SparkSession, paths: list[str], encoding: str = "auto") -> list[Source]:
    """Each path's header, encoding and bytes, in the order of the paths; a path without a line is left out.

    One pass over all files finds the place of each first line and whether all lines are valid UTF-8: a line
    is never split between tasks, so neither is a character, and a file's findings add up over its blocks.
    With a named encoding only places are looked for. A second pass picks the lines at these places, a broadcast
    of a row for each file while they are few. A folder's header is that of its first file with a line; it is
    latin-1 if any of its files is.
    """
    lines = _lines(spark, paths)
    broken = F.count_if(~F.is_valid_utf8("line")) if encoding == "auto" else F.lit(0)
    found = lines.groupBy("file", "size").agg(F.min(F.when(F.col("opens"), F.col("place"))).alias("place"), broken.alias("broken"))
    firsts = spark.createDataFrame(found.toArrow())  # a row for each file
    opening = lines.join(bounded(firsts.select("place")), "place").select("file", F.col("line").cast("binary").alias("line"))
    texts = {r.file: bytes(r.line) for r in opening.collect()}
    roots = {plain(p): p for p in paths}
    files: dict[str, list] = {}
    for row in sorted(firsts.collect(), key=lambda r: r.file):
        name = plain(row.file)
        root = name if name in roots else name.rsplit("/", 1)[0]
        files.setdefault(roots[root], []).append(row)
    out = []
    for path in paths:
        if rows := files.get(path):
            if missing := [r.file for r in rows if r.file not in texts]:
                raise RuntimeError(f"files changed while they were read: {missing[:3]}")
            kind = encoding if encoding != "auto" else LATIN1 if any(r.broken for r in rows) else UTF8
            header = next(csv.reader([texts[rows[0].file].decode(kind, "replace")]), [])
            out.append(Source(path, tuple(header), kind, sum(r.size for r in rows)))
    return out
