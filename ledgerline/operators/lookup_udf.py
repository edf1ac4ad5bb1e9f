"""User-function surface (B1, B2): pluggable remote lookups and writers.

Only for stores that cannot be read as a table.  The default path is the
declarative join (J1) and the file sinks (K2, K3); these give the same
results through Arrow-batched ``mapInPandas`` (never per-row Python UDFs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ledgerline.schemas import ENRICH_CHUNK_ROWS, LOOKUP_BATCH_KEYS


def batched_lookup(df: DataFrame, fetch: Callable[[list], pd.DataFrame], key: str, dim_schema: T.StructType,
                   chunk: int = ENRICH_CHUNK_ROWS, batch: int = LOOKUP_BATCH_KEYS) -> DataFrame:
    """B1: left lookup in chunks of ``chunk`` rows, at most ``batch`` distinct keys per call.

    Unmatched and null keys get nulls; rows are never dropped; memory is one
    chunk plus its lookup result.  The fetch runs on the executors.
    """
    dim_cols = [f.name for f in dim_schema.fields if f.name != key]
    out_schema = T.StructType(df.schema.fields + [f for f in dim_schema.fields if f.name != key])
    empty = pd.DataFrame({c: pd.Series(dtype="object") for c in [key, *dim_cols]})

    def run(batches):
        for pdf in batches:
            for start in range(0, len(pdf), chunk):
                part = pdf.iloc[start:start + chunk]
                keys = part[key].dropna().unique().tolist()
                found = [fetch(keys[i:i + batch]) for i in range(0, len(keys), batch)]
                dim = pd.concat(found, ignore_index=True) if found else empty
                dim = dim.drop_duplicates(key, keep="last")
                out = part.merge(dim, on=key, how="left", sort=False)
                yield out[[f.name for f in out_schema.fields]]

    return df.mapInPandas(run, out_schema)


def send_batches(df: DataFrame, send: Callable[[pd.DataFrame], dict], result: str, size: int = 1000) -> DataFrame:
    """B2: hand rows to ``send`` in batches of at most ``size`` per task; a row of ``result`` (a DDL
    schema) per batch from what ``send`` returns.

    ``send`` must raise on failure: the task then fails and is retried, so a
    partial write is never reported as success (D14); it must accept a batch twice.
    """
    def run(batches):
        for pdf in batches:
            for start in range(0, len(pdf), size):
                yield pd.DataFrame([send(pdf.iloc[start:start + size])])

    return df.mapInPandas(run, result)


def write_with(df: DataFrame, send: Callable[[pd.DataFrame], int], size: int = 1000) -> int:
    """B2: ``send_batches`` for a sender that returns how many rows it took; returns their sum."""
    sent = send_batches(df, lambda part: {"sent": int(send(part))}, "sent long", size)
    return int(sent.agg(F.sum("sent")).first()[0] or 0)


class StagedSink:
    """What a user gives to ``write_staged``: a store that takes batches aside first.

    ``stage`` runs in tasks and returns a token for the batch; ``publish`` makes all tokens of a write visible
    at once, on the driver; ``discard`` drops the tokens of a failed write.  A task that fails after staging
    is run again: its first tokens are in no commit and are never published."""

    def stage(self, rows: list[dict]) -> str:
        raise NotImplementedError

    def publish(self, tokens: list[str]) -> None:
        raise NotImplementedError

    def discard(self, tokens: list[str]) -> None:
        raise NotImplementedError


@dataclass
class Staged(WriterCommitMessage):
    tokens: list
    rows: int


class StagedWriter(DataSourceWriter):
    def __init__(self, sink: StagedSink, size: int):
        self.sink, self.size = sink, size

    def write(self, iterator: Iterator) -> Staged:
        tokens, held, n = [], [], 0
        for row in iterator:
            held.append(row.asDict(recursive=True))
            if len(held) == self.size:
                tokens.append(self.sink.stage(held))
                held, n = [], n + self.size
        if held:
            tokens.append(self.sink.stage(held))
        return Staged(tokens, n + len(held))

    def commit(self, messages: list) -> None:
        self.sink.publish([t for m in messages if m is not None for t in m.tokens])

    def abort(self, messages: list) -> None:
        self.sink.discard([t for m in messages if m is not None for t in m.tokens])


def staged_source(sink: StagedSink, size: int) -> type:
    """A data source class that writes to ``sink``."""

    class StagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "staged_sink"

        def writer(self, schema, overwrite: bool) -> StagedWriter:
            return StagedWriter(sink, size)

    return StagedSource


def write_staged(df: DataFrame, sink: StagedSink, size: int = 1000) -> None:
    """B2 with two phases: tasks stage batches of at most ``size`` rows, and only when all have ended are they
    published together, so that each row is delivered once however often a task failed, or none at all."""
    df.sparkSession.dataSource.register(staged_source(sink, size))
    df.write.format("staged_sink").mode("append").save()


class FolderSink(StagedSink):
    """JSON Lines files in a folder that driver and executors share (an Arrow file system's URI).

    Batches are staged in a folder of the write.  Publishing writes the list of its files first, as one file,
    and then moves them; ``recover`` repeats the moves of a list whose writer was lost in between."""

    def __init__(self, uri: str):
        self.uri, self.run = uri.rstrip("/"), uuid.uuid4().hex

    def _at(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.uri)

    def stage(self, rows: list[dict]) -> str:
        files, root = self._at()
        token = f"{self.run}/{uuid.uuid4().hex}.json"
        files.create_dir(f"{root}/_staged/{self.run}", recursive=True)
        with files.open_output_stream(f"{root}/_staged/{token}") as out:
            out.write("".join(json.dumps(r, default=str) + "\n" for r in rows).encode())
        return token

    def publish(self, tokens: list[str]) -> None:
        files, root = self._at()
        files.create_dir(f"{root}/_commits", recursive=True)
        with files.open_output_stream(f"{root}/_commits/{self.run}.part") as out:
            out.write(json.dumps(tokens).encode())
        files.move(f"{root}/_commits/{self.run}.part", f"{root}/_commits/{self.run}.json")
        self.recover()

    def recover(self) -> int:
        """Finish committed writes; how many."""
        from pyarrow import fs

        files, root = self._at()
        done = 0
        for info in files.get_file_info(fs.FileSelector(f"{root}/_commits", allow_not_found=True)):
            if not info.path.endswith(".json"):
                continue
            with files.open_input_stream(info.path) as lines:
                tokens = json.loads(lines.read())
            for token in tokens:
                if files.get_file_info(f"{root}/_staged/{token}").type == fs.FileType.File:
                    files.move(f"{root}/_staged/{token}", f"{root}/{token.split('/')[1]}")
            self._clear(files, f"{root}/_staged/{info.base_name[:-5]}")
            files.delete_file(info.path)
            done += 1
        return done

    def discard(self, tokens: list[str]) -> None:
        files, root = self._at()
        self._clear(files, f"{root}/_staged/{self.run}")

    @staticmethod
    def _clear(files, folder: str) -> None:
        files.create_dir(folder, recursive=True)
        files.delete_dir(folder)
