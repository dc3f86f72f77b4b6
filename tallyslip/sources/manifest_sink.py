"""A sink for manifests and error lists: one JSON array and one file of JSON lines per shard, under the shard's own name.

A task writes whole shards under names of its attempt; only the commit of the job gives them their own, so a task that fails and is run
again, or a job that ends, leaves no part of a manifest behind. Rows are streamed: a shard never is in memory."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tallyslip.operators.batch import shard_suffix

FORMAT = "shard_manifest"


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: (temporary path, path)."""

    files: list[tuple[str, str]]
    shards: list[int]


def _plain(value):
    if hasattr(value, "asDict"):
        return value.asDict(recursive=True)
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else value


class ShardFiles:
    """The open files of one shard of one attempt."""

    def __init__(self, fs, folder: str, name: str, array: bool, attempt: str):
        self.fs, self.count, self.array, self.files, self.out = fs, 0, array, [], {}
        for kind in ("json", "jsonl") if array else ("jsonl",):
            final = f"{folder}/{name}.{kind}"
            temporary = f"{folder}/_{name}.{kind}.{attempt}.tmp"
            self.files.append((temporary, final))
            self.out[kind] = fs.open_output_stream(temporary)

    def add(self, record: dict) -> None:
        self.out["jsonl"].write((json.dumps(record, ensure_ascii=False) + "\n").encode())
        if self.array:
            text = json.dumps(record, ensure_ascii=False, indent=2).replace("\n", "\n  ")
            self.out["json"].write((("[\n  " if not self.count else ",\n  ") + text).encode())
        self.count += 1

    def close(self) -> None:
        if self.array:
            self.out["json"].write(b"\n]\n" if self.count else b"[]\n")
        for stream in self.out.values():
            stream.close()


class ManifestWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.name, self.shards = options["path"], options["name"], int(options["shards"])
        self.array = options.get("array", "true") == "true"

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, rows: Iterator) -> Written:
        fs, folder = self._fs()
        attempt, now, shard, done = uuid.uuid4().hex, None, None, Written([], [])
        try:
            for row in rows:
                record = {k: _plain(v) for k, v in row.asDict().items()}
                number = record.pop("shard")
                if number != shard:
                    if now:
                        now.close()
                    now, shard = ShardFiles(fs, folder, self.name + shard_suffix(number, self.shards), self.array, attempt), number
                    done.files += now.files
                    done.shards.append(number)
                now.add(record)
            if now:
                now.close()
        except BaseException:
            self._drop(fs, done)
            raise
        return done

    def _drop(self, fs, done: Written) -> None:
        for temporary, _ in done.files:
            try:
                fs.delete_file(temporary)
            except FileNotFoundError:
                pass

    def commit(self, messages: list[Written | None]) -> None:
        """Every file gets its name; shards without rows get empty files."""
        fs, folder = self._fs()
        tasks = [m for m in messages if m]
        seen = [s for m in tasks for s in m.shards]
        if len(seen) != len(set(seen)):
            self.abort(messages)
            raise ValueError("a shard was written by two tasks")
        for number in sorted(set(range(self.shards)) - set(seen)):
            empty = ShardFiles(fs, folder, self.name + shard_suffix(number, self.shards), self.array, "empty")
            empty.close()
            tasks.append(Written(empty.files, [number]))
        for task in tasks:
            for temporary, final in task.files:
                fs.move(temporary, final)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = self._fs()
        for task in messages:
            if task:
                self._drop(fs, task)


class ShardManifest(DataSource):
    """Options: path (a folder, as a uri), name, shards, array. Rows have a column `shard`; those of a shard come in one task, in order."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> ManifestWriter:
        return ManifestWriter(dict(self.options))


def write_manifest(rows: DataFrame, path: str, name: str, shards: int, order: list[str], array: bool = True) -> None:
    """`rows` with a column `shard` as files of their shards in the folder `path` (a uri), in `order`. One shuffle by shard; a shard is the
    work of one task, as it is the unit that is run and resumed by itself. Names of a single shard have no number."""
    from pyarrow import fs

    where, folder = fs.FileSystem.from_uri(path)
    where.create_dir(folder, recursive=True)
    rows.sparkSession.dataSource.register(ShardManifest)
    dealt = rows.repartition("shard").sortWithinPartitions("shard", *order)
    dealt.write.format(FORMAT).mode("append").option("path", path).option("name", name).option("shards", str(shards)).option("array", str(array).lower()).save()


def write_errors(rows: DataFrame, path: str, shards: int, order: list[str], name: str = "inference_errors") -> None:
    """Error rows (source, error_type, message, shard) as JSON lines per shard."""
    write_manifest(rows.select("shard", "source", "error_type", "message"), path, name, shards, order, array=False)
