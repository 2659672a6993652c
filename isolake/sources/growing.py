"""A stream over one growing file of lines: byte offsets as cursor, a partial last line is left for later.

Registered as the data source `growing_lines`: `spark.dataSource.register(GrowingLines)`, then
`spark.readStream.format("growing_lines").option("path", ...)`. A file that became shorter is read again from its start.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType


def read_from(path: str, offset: int, limit: int) -> tuple[list[str], int]:
    """(whole lines, next offset) of at most `limit` lines after a byte offset."""
    try:
        size = os.path.getsize(path)
    except FileNotFoundError:
        return [], 0
    if offset > size:
        offset = 0
    out = []
    with open(path, "rb") as f:
        f.seek(offset)
        while len(out) < limit:
            line = f.readline()
            if not line.endswith(b"\n"):
                break
            offset += len(line)
            out.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
    return out, offset


class GrowingReader(SimpleDataSourceStreamReader):
    def __init__(self, path: str, limit: int) -> None:
        self.path, self.limit = path, limit

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        lines, end = read_from(self.path, start["at"], self.limit)
        return iter([(x,) for x in lines]), {"at": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = 0 if end["at"] < start["at"] else start["at"]
        with open(self.path, "rb") as f:
            f.seek(at)
            for line in f.read(end["at"] - at).split(b"\n")[:-1]:
                yield (line.rstrip(b"\r").decode("utf-8", "replace"),)


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return GrowingReader(self.options["path"], int(self.options.get("limit", "5000")))
