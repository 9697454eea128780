"""Census responses as a data source: one partition a response, read as a stream of rows.

The files lie as ``sources.census`` says. Filters on year and variable choose the files before
any is opened, and a response of any length is never held as one text.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from trendspark.functions import zip_text

# the source travels to the executors whole
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 20
_PLACE = re.compile(r"/year=([0-9]+)/variable=([^/]+)/[^/._][^/]*$")


def _skip(text: str, at: int) -> int:
    while at < len(text) and text[at] in " \t\r\n":
        at += 1
    return at


def stream_rows(source, chunk: int = CHUNK_BYTES) -> Iterator[list]:
    """The inner arrays of a JSON array of arrays, one after the other, from a binary file.

    What is held is a chunk and the row that it ends in. Anything else than such an array raises ``ValueError``.
    """
    decoder, to_text = json.JSONDecoder(), codecs.getincrementaldecoder("utf-8")()
    text, at, ended = "", 0, False
    expected = "["  # then "row or ]", ", or ]", "row", "end"

    def more() -> None:
        nonlocal text, at, ended
        data = source.read(chunk)
        ended = not data
        text, at = text[at:] + to_text.decode(data, final=ended), 0

    while True:
        at = _skip(text, at)
        if at == len(text):
            if ended:
                break
            more()
            continue
        if expected in ("row", "row or ]") and text[at] == "[":
            # a row is whole once it decodes; until then more is read, at least as much again
            try:
                row, at = decoder.raw_decode(text, at)
            except json.JSONDecodeError:
                if ended:
                    raise
                held = len(text) - at
                while not ended and len(text) - at < 2 * held:
                    more()
                continue
            yield row
            expected = ", or ]"
            continue
        sign, following = text[at], None
        if expected == "[" and sign == "[":
            following = "row or ]"
        elif expected in ("row or ]", ", or ]") and sign == "]":
            following = "end"
        elif expected == ", or ]" and sign == ",":
            following = "row"
        if following is None:
            raise ValueError(f"a response is an array of arrays; expected {expected} before {text[at:at + 20]!r}")
        expected, at = following, at + 1
    if expected != "end":
        raise ValueError(f"a response ends where {expected} is expected")


@dataclass
class Response(InputPartition):
    path: str
    year: int
    variable: str


def _holds(filter_: Filter, response: Response) -> bool | None:
    """Whether a response can hold rows that pass; None if the filter is of another kind."""
    name = filter_.attribute[0].lower() if len(getattr(filter_, "attribute", ())) == 1 else ""
    if name not in ("year", "variable"):
        return None
    held = getattr(response, name)
    if isinstance(filter_, In):
        return held in filter_.value
    tests = {
        EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
        LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
    }
    test = tests.get(type(filter_))
    return None if test is None or filter_.value is None else test(held, filter_.value)


class ResponseReader(DataSourceReader):
    def __init__(self, root: str):
        self.root, self.filters = root, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        some = Response("", 0, "")
        for f in filters:
            if _holds(f, some) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[Response]:
        system, root = _file_system(self.root)
        found = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            place = _PLACE.search(info.path)
            if place and info.is_file:
                found.append(Response(info.path, int(place[1]), place[2]))
        chosen = [r for r in sorted(found, key=lambda r: r.path) if all(_holds(f, r) for f in self.filters)]
        return chosen or [Response("", 0, "")]

    def read(self, partition: Response) -> Iterator[tuple]:
        if not partition.path:  # none was chosen
            return
        with _file_system(self.root)[0].open_input_stream(partition.path) as source:
            rows = stream_rows(source)
            next(rows, None)  # the header
            for row in rows:
                yield partition.year, partition.variable, row[-1], None if row[1] is None else int(row[1])


def _file_system(root: str) -> tuple[fs.FileSystem, str]:
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", re.sub(r"^s3a:", "s3:", root)))


class CensusResponses(DataSource):
    @classmethod
    def name(cls) -> str:
        return "census_responses"

    def schema(self) -> str:
        return "year int, variable string, zipcode string, value bigint"

    def reader(self, schema) -> ResponseReader:
        return ResponseReader(self.options["path"])


def read_response_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows ``year, variable, zipcode, value`` of the responses below ``root``, as from ``census.parse_responses``.

    ``root`` is a path that the driver and the executors reach (local or shared folder, hdfs, s3, gs).
    A response is one task; filters on year and variable leave out whole responses. The session's filter push-down
    for Python sources is switched on.
    """
    spark.dataSource.register(CensusResponses)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("census_responses").load(root)
    return rows.withColumn("zipcode", zip_text(F.col("zipcode")))
