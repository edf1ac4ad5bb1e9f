"""File inventory (S9) as a Python data source: executors list a folder tree, one partition per prefix.

The driver only names the prefixes (the folders of the first partition columns); each is listed by a task,
with all folders below it, through the file system that the path names.  Files whose names begin with ``_``
or ``.``, or that lie in such folders, are not data; empty files count.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerline.schemas import PARTITION_COLS
from ledgerline.session import list_folder, qualified


class Prefix(InputPartition):
    def __init__(self, path: str):
        self.path = path


class InventoryReader(DataSourceReader):
    def __init__(self, base: str, columns: list[str], prefixes: list[str]):
        self.base, self.columns, self.prefixes = base, columns, prefixes

    def partitions(self) -> list[Prefix]:
        return [Prefix(p) for p in self.prefixes] or [Prefix("")]

    def read(self, partition: Prefix) -> Iterator[tuple]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.base)
        found: dict = defaultdict(lambda: [0, 0])
        if partition.path:
            for info in files.get_file_info(fs.FileSelector(f"{root}/{partition.path}", recursive=True)):
                parts = info.path[len(root):].strip("/").split("/")
                if info.type != fs.FileType.File or any(p[0] in "_." for p in parts):
                    continue
                values = dict(p.split("=", 1) for p in parts[:-1] if "=" in p)
                if set(self.columns) <= set(values):
                    own = found[tuple(unquote(values[c]) for c in self.columns)]
                    own[0] += 1
                    own[1] += info.size or 0
        yield from ((*values, n, size) for values, (n, size) in found.items())


class FileInventory(DataSource):
    """Options: ``path``, ``columns`` (JSON list of the partition columns), ``prefixes`` (JSON list of folders)."""

    @classmethod
    def name(cls) -> str:
        return "file_inventory"

    def schema(self) -> str:
        return ", ".join([*(f"{c} string" for c in json.loads(self.options["columns"])), "n_files long", "n_bytes long"])

    def reader(self, schema) -> InventoryReader:
        return InventoryReader(self.options["path"], json.loads(self.options["columns"]), json.loads(self.options["prefixes"]))


def file_inventory(spark: SparkSession, base: str, partition_cols=PARTITION_COLS, depth: int = 2) -> DataFrame:
    """Files and bytes per partition, empty files included; no file is opened.

    The driver lists folders down to ``depth`` partition columns (of dates: a folder per month), tasks the rest."""
    prefixes = [""]
    for _ in range(min(depth, len(partition_cols))):
        prefixes = [f"{p}/{n}".lstrip("/") for p in prefixes for n, _ in list_folder(spark, f"{base.rstrip('/')}/{p}".rstrip("/"))
                    if "=" in n and n[0] not in "_."]
    spark.dataSource.register(FileInventory)
    return (spark.read.format("file_inventory").option("path", qualified(spark, base)).option("columns", json.dumps(list(partition_cols)))
            .option("prefixes", json.dumps(prefixes)).load())
