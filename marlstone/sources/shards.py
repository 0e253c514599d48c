"""Tar shards as a data source: one partition a shard, members streamed in order, keys filtered before a member is decoded.

Members are JSON or raw bytes. Serialised objects are never loaded.
"""

from __future__ import annotations

import re
import tarfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

SCHEMA = "shard int, key string, kind string, data binary"
_NAME = re.compile(r"shard-(\d+)\.tar$")


class _Shard(InputPartition):
    def __init__(self, path: str, number: int):
        super().__init__(number)
        self.path, self.number = path, number


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.wanted, self.keys = options["path"], options.get("shards"), None

    def pushFilters(self, filters: list[Filter]):  # noqa: N802 - the interface's name
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("key",):
                self.keys = {f.value}
            elif isinstance(f, In) and f.attribute == ("key",):
                self.keys = set(f.value)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from marlstone.sources.files import parse_range

        found = {int(m[1]): str(p) for p in Path(self.root.removeprefix("file://")).iterdir() if (m := _NAME.search(p.name))}
        return [_Shard(found[n], n) for n in parse_range(self.wanted, list(found))] or [_Shard("", -1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not partition.path:
            return
        with tarfile.open(partition.path, "r|*") as tar:
            for member in tar:
                if not member.isfile():
                    continue
                stem, dot, kind = member.name.rpartition(".")
                key = (stem if dot else member.name).replace("__", "/")
                if self.keys is not None and key not in self.keys:
                    continue
                yield partition.number, key, kind if dot else "", tar.extractfile(member).read()


class ShardSource(DataSource):
    """``spark.dataSource.register(ShardSource)``, then ``spark.read.format("shards").option("shards", "0-3").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
