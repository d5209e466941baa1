"""Streaming sink for small result tables: the newest epoch's rows, and sums of each.

For queries in complete output mode.  Tasks write an epoch's files under final names of
their own; the commit writes one pointer, a small file named after the epoch, that lists
them.  A reader takes the newest pointer, so it sees one epoch whole, and the epoch that
is replayed replaces its pointer.  Files that no pointer of the last two epochs names are
deleted.

The pointer also carries the history: what the number columns added up to in each epoch.
The last ``TAIL`` epochs are in the pointer itself, older ones in sealed files of
``TAIL`` rows, so a commit writes a bounded amount.  Progress read from it is complete
whichever driver processes have run the stream.
"""

import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from uttersieve.sources.files import open_path, qualified

TAIL = 500


@dataclass
class _Part(WriterCommitMessage):
    file: str | None
    sums: dict


class EpochTable(DataSource):
    @classmethod
    def name(cls):
        return "epoch_table"

    def streamWriter(self, schema, overwrite):
        return _EpochWriter(self.options["path"])


class _EpochWriter(DataSourceStreamArrowWriter):
    def __init__(self, path):
        self.path = path.rstrip("/")

    def write(self, iterator):
        batches = [b for b in iterator if b.num_rows]
        if not batches:
            return _Part(None, {})
        fs, root = open_path(self.path)
        fs.create_dir(f"{root}/data", recursive=True)
        table, name = pa.Table.from_batches(batches), f"data/{uuid.uuid4().hex}.parquet"
        with fs.open_output_stream(f"{root}/{name}") as out:
            pq.write_table(table, out)
        numbers = [f.name for f in table.schema if pa.types.is_integer(f.type)]
        return _Part(name, {n: pc.sum(table[n]).as_py() or 0 for n in numbers})

    def commit(self, messages, batchId):
        fs, root = open_path(self.path)
        fs.create_dir(root, recursive=True)
        pointers = _pointers(fs, root)
        before = next((p for p in reversed(pointers) if p["epoch"] < batchId), None)
        sums: dict = {}
        for m in messages:
            for name, n in (m.sums if m else {}).items():
                sums[name] = sums.get(name, 0) + n
        tail = (before["tail"] if before else []) + [[batchId, sums]]
        sealed = list(before["sealed"]) if before else []
        if len(tail) > TAIL:
            name = f"history/{tail[0][0]:010d}-{tail[-2][0]:010d}.json"
            fs.create_dir(f"{root}/history", recursive=True)
            _write(fs, f"{root}/{name}", tail[:-1])
            sealed, tail = [*sealed, name], tail[-1:]
        now = {
            "epoch": batchId,
            "files": sorted(m.file for m in messages if m and m.file),
            "tail": tail,
            "sealed": sealed,
        }
        _write(fs, f"{root}/{_pointer(batchId)}", now)
        # a reader may still be at the epoch before
        kept = {f for p in (before, now) if p for f in p["files"]}
        for p in pointers:
            if p["epoch"] != batchId and (before is None or p["epoch"] < before["epoch"]):
                fs.delete_file(f"{root}/{_pointer(p['epoch'])}")
        for info in fs.get_file_info(pafs.FileSelector(f"{root}/data", allow_not_found=True)):
            if f"data/{info.base_name}" not in kept:
                fs.delete_file(info.path)

    def abort(self, messages, batchId):
        fs, root = open_path(self.path)
        for m in messages:
            if m and m.file:
                fs.delete_file(f"{root}/{m.file}")


def _pointer(epoch: int) -> str:
    return f"epoch-{epoch:010d}.json"


def _write(fs, path, value):
    """A small file that appears whole."""
    staged = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(staged, compression=None) as out:
        out.write(json.dumps(value).encode())
    fs.move(staged, path)


def _read(fs, path):
    with fs.open_input_stream(path, compression=None) as f:
        return json.loads(f.read())


def _pointers(fs, root) -> list:
    """Contents of all pointers, in order."""
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    names = [i.path for i in found if i.base_name.startswith("epoch-") and i.extension == "json"]
    return [_read(fs, n) for n in sorted(names)]


def _newest(spark, path):
    """Root with its scheme, and the newest pointer or None.

    A pointer may be deleted while the list is read, by a commit that has put a newer one there.
    """
    uri = qualified(spark, path).rstrip("/")
    fs, root = open_path(uri)
    for _ in range(10):
        try:
            found = _pointers(fs, root)
            return uri, fs, root, found[-1] if found else None
        except FileNotFoundError:
            continue
    raise FileNotFoundError(path)


def latest_epoch(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest epoch's table; ``schema`` as DDL text."""
    uri, _, _, pointer = _newest(spark, path)
    if pointer is None or not pointer["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{uri}/{f}" for f in pointer["files"]])


def epoch_sums(spark: SparkSession, path: str, columns) -> DataFrame:
    """``epoch`` and what each of ``columns`` added up to in it, of every epoch there was."""
    _, fs, root, pointer = _newest(spark, path)
    rows = []
    if pointer is not None:
        for name in pointer["sealed"]:
            rows += _read(fs, f"{root}/{name}")
        rows += pointer["tail"]
    schema = ", ".join(["epoch bigint", *[f"`{c}` bigint" for c in columns]])
    return spark.createDataFrame(
        [(epoch, *[sums.get(c, 0) for c in columns]) for epoch, sums in rows], schema
    )
