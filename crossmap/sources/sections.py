"""Framework documents as a data source that splits large files.

`spark.read.format("framework_sections").load(folder)` gives one row for each top-level section of the documents in a folder:
(path, at, section_text), `at` being the byte where the section begins. Files are planned in ranges of bytes. A range
belongs to the sections whose key begins in it: its reader skips to the first one and reads on to the end of the last one,
so that a document of any length is read by as many tasks as it has ranges. As a stream, the source gives the
sections of files that have appeared since the last batch.

Files are opened by the tasks, so the folder has to be one that all executors see as such; for other stores there is
`read_documents`, which takes a document as one row. Sections have to be written as blocks, their keys at the beginning of a line. A
document that begins with a bracket is one section. Names that are given to parts (anchors) hold within a section.
"""

from __future__ import annotations

import json
import os
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from crossmap.functions import text
from crossmap.operators.sizes import broadcast_if_small
from crossmap.sources import decode
from crossmap.sources.schemas import NODE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT, SCHEMA = "framework_sections", "path STRING, at BIGINT, section_text STRING"
RANGE_BYTES = 32 << 20
ENDINGS = (".yaml", ".yml")
HIDDEN = ("_", ".")
#: A line that begins a section: neither indented nor a comment, a list item or the mark of a document.
_KEY = re.compile(rb"(?!---|\.\.\.|[\s#\-\[{}\]])[^\n]*:(?:\s|$)")
_BRACKET = re.compile(rb"\s*(?:(?:#[^\n]*|---[^\n]*)\n\s*)*[\[{]")


def files(folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the documents below a folder, without hidden folders."""
    found = []
    for where, folders, names in os.walk(folder):
        folders[:] = sorted(name for name in folders if not name.startswith(HIDDEN))
        found += [(os.path.join(where, name), os.path.getsize(os.path.join(where, name))) for name in sorted(names) if name.endswith(ENDINGS)]
    return found


class Range(InputPartition):
    """A range of bytes of a file."""

    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def ranges(listed: list[tuple[str, int]], size: int) -> list[Range]:
    return [Range(path, start, min(start + size, length)) for path, length in listed for start in range(0, length, size)]


def sections(part: Range) -> Iterator[tuple[str, int, str]]:
    """(path, at, section_text) of the sections that begin in a range."""
    with open(part.path, "rb") as source:
        if _BRACKET.match(source.read(1 << 16)):
            if part.start == 0:
                source.seek(0)
                yield part.path, 0, source.read().decode("utf-8-sig")
            return
        at = part.start
        if at:
            # A line that begins in front of the range belongs to the range before, whole or in part.
            source.seek(at - 1)
            at += len(source.readline()) - 1
        source.seek(at)
        begun, held = -1, []
        for line in source:
            plain = line.removeprefix(b"\xef\xbb\xbf") if at == 0 else line
            if _KEY.match(plain):
                if held:
                    yield part.path, begun, b"".join(held).decode()
                    held = []
                if at >= part.end:
                    return
                begun = at
            if begun >= 0 and not plain.startswith((b"---", b"...")):
                held.append(plain)
            elif at >= part.end:
                return
            at += len(line)
        if held:
            yield part.path, begun, b"".join(held).decode()


class _Options:
    def __init__(self, options: dict):
        self.folder = options["path"].removeprefix("file://").removeprefix("file:")
        self.size = int(options.get("rangeBytes", RANGE_BYTES))


class SectionReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = _Options(options)

    def partitions(self) -> list[Range]:
        return ranges(files(self.options.folder), self.options.size)

    def read(self, partition: Range) -> Iterator[tuple]:
        yield from sections(partition)


class SectionStream(DataSourceStreamReader):
    """An offset is the list of files seen so far, with their sizes."""

    def __init__(self, options: dict):
        self.options = _Options(options)

    def initialOffset(self) -> dict:
        return {"seen": "{}"}

    def latestOffset(self) -> dict:
        return {"seen": json.dumps(dict(files(self.options.folder)))}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        before, now = json.loads(start["seen"]), json.loads(end["seen"])
        return ranges([(path, size) for path, size in now.items() if before.get(path) != size], self.options.size)

    def read(self, partition: Range) -> Iterator[tuple]:
        yield from sections(partition)


class FrameworkSections(DataSource):
    """The sections of the framework documents in a folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return SectionReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SectionStream(self.options)


def read_sections(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, at, section_text) of a folder."""
    spark.dataSource.register(FrameworkSections)
    return spark.read.format(FORMAT).option("rangeBytes", range_bytes).load(folder)


def arriving_sections(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The same as a stream of the files that appear."""
    spark.dataSource.register(FrameworkSections)
    return spark.readStream.format(FORMAT).option("rangeBytes", range_bytes).load(folder)


def _decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for framework, path, at, content in batch.itertuples(index=False):
            rows = pd.DataFrame(list(decode.document_rows(framework, path, content)), columns=decode.COLUMNS)
            yield rows.assign(at=at)


def decode_sections(found: DataFrame, name: Column | None = None) -> DataFrame:
    """Item nodes of (path, at, section_text), numbered over the whole document.

    Sections are decoded apart. How many there are before each, and how many items they hold, are sums over the
    sections of a document, one short row each.
    """
    name = text.framework_name(F.col("path")) if name is None else name
    named = found.select(name.alias("framework"), "path", "at", "section_text")
    chosen = named.groupBy("framework").agg(F.max("path").alias("path"))
    nodes = named.join(broadcast_if_small(chosen), ["framework", "path"], "left_semi").mapInPandas(_decoded, f"{NODE}, at BIGINT")
    counts = nodes.groupBy("framework", "path", "at").agg(F.max("section_ord").alias("_sections"), F.max("pos").alias("_items"))
    before = Window.partitionBy("framework", "path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("framework", "path", "at", *(F.coalesce(F.sum(F.col(c) + 1).over(before), F.lit(0)).alias(c) for c in ("_sections", "_items")))
    placed = nodes.join(starts, ["framework", "path", "at"])
    pos = F.when(F.col("pos") >= 0, F.col("pos") + F.col("_items")).otherwise(F.col("pos"))
    return placed.withColumns({"section_ord": (F.col("section_ord") + F.col("_sections")).cast("int"), "pos": pos}).select(*decode.COLUMNS)
