"""Audio files and archives.

Only paths and lengths go through the ``binaryFile`` scan; contents are opened
in the tasks through ``pyarrow.fs``, which reads local and cluster file systems.
"""

import bz2
import struct
import zipfile
import zlib
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from uttersieve.functions.audio import read_pcm16

_BATCH_BYTES = 32 << 20
_SPLIT_ENTRIES = 10_000
MANIFEST = "manifest.parquet"  # of an export
_DECODED = T.StructType(
    [
        T.StructField("samples", T.ArrayType(T.FloatType())),
        T.StructField("rate", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)


# the same stores under the names Hadoop gives them
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark would use: one without is not each worker's own
    disk but in the default file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def open_path(uri: str):
    """File system and path of a URI, ``file:`` or any scheme pyarrow or Hadoop names.

    A path without a scheme is local: :func:`qualified` adds it on the driver.
    """
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parsed.path) if parsed.scheme else uri
    scheme = _SCHEMES.get(parsed.scheme, parsed.scheme)
    return pafs.FileSystem.from_uri(uri.replace(parsed.scheme, scheme, 1))


def path_parts(path="path"):
    """Columns of a file path: base name without suffix, and its folder."""
    p = F.split(path, "/")
    return {
        "name": F.regexp_replace(F.element_at(p, -1), r"\.[^.]*$", ""),
        "speaker": F.try_element_at(p, F.lit(-2)),
    }


def wav_files(spark: SparkSession, root: str, symbol=None) -> DataFrame:
    """WAV files below ``root``, one folder per speaker: ``path, length, content,
    name, speaker``.  Order by ``path`` where order matters."""
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.wav")
        .option("recursiveFileLookup", "true")
        .load(root)
        .drop("modificationTime")
        .withColumns(path_parts())
    )
    return df if symbol is None else df.filter(F.col("speaker").contains(symbol))


def _exists(spark: SparkSession, path: str) -> bool:
    """By Spark's own file systems."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def published(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` holds a committed export."""
    return _exists(spark, f"{root.rstrip('/')}/{MANIFEST}")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The archives of a committed export: ``path, subset, folder_index, clips, bytes``."""
    root = qualified(spark, root).rstrip("/")
    listed = spark.read.parquet(f"{root}/{MANIFEST}")
    return listed.select(
        F.concat(F.lit(f"{root}/"), "name").alias("path"), *[c for c in listed.columns if c != "name"]
    )


def _archives(spark: SparkSession, root: str) -> DataFrame:
    """Paths of an export's archives, or, in a folder of other origin, of all zip files."""
    if published(spark, root):
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return manifest(spark, root).select("path").repartition(n, "path")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )


def _directory(path: str):
    """Files of a zip archive in the order of their places, from one look at its directory."""
    fs, local = open_path(path)
    with fs.open_input_file(local) as f, zipfile.ZipFile(f) as z:
        return sorted((i for i in z.infolist() if not i.is_dir()), key=lambda i: i.header_offset)


def archive_index(spark: SparkSession, root: str) -> DataFrame:
    """Entries of all zip archives below ``root``, from their directories only."""

    def entries(batches):
        for pdf in batches:
            for path in pdf["path"]:
                infos = _directory(path)
                for at in range(0, len(infos), 10_000):
                    part = infos[at : at + 10_000]
                    yield pd.DataFrame(
                        {
                            "archive": path,
                            "entry_path": [i.filename for i in part],
                            "size": [i.file_size for i in part],
                        }
                    )

    return _archives(spark, root).mapInPandas(
        entries, "archive string, entry_path string, size bigint"
    )


_SPLIT = pa.schema(
    [
        ("archive", pa.string()),
        ("first", pa.int64()),
        (
            "entries",
            pa.list_(
                pa.struct(
                    [("path", pa.string()), ("at", pa.int64()), ("packed", pa.int64()),
                     ("size", pa.int64()), ("method", pa.int32()), ("flags", pa.int32()),
                     ("crc", pa.int64())]
                )
            ),
        ),
    ]
)


def archive_splits(batches):
    """Arrow batches of archive paths to runs of neighbouring entries, with places and
    sizes: up to ``_BATCH_BYTES`` and ``_SPLIT_ENTRIES`` each."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            held, run, runs = 0, [], []
            for i in _directory(path):
                if run and (held + i.file_size > _BATCH_BYTES or len(run) == _SPLIT_ENTRIES):
                    runs.append(run)
                    held, run = 0, []
                held += i.file_size
                run.append(
                    {"path": i.filename, "at": i.header_offset, "packed": i.compress_size,
                     "size": i.file_size, "method": i.compress_type, "flags": i.flag_bits,
                     "crc": i.CRC}
                )
            runs += [run] if run else []
            for run in runs:
                yield pa.RecordBatch.from_pylist(
                    [{"archive": path, "first": run[0]["at"], "entries": run}], schema=_SPLIT
                )


def _contents(f, entry) -> bytes:
    """One file's bytes, from the place that the directory has named."""
    f.seek(entry["at"])
    head = f.read(30)
    if head[:4] != b"PK\x03\x04" or entry["flags"] & 1:
        raise ValueError(f"cannot read {entry['path']}: damaged or encrypted")
    # the name and the extra field are repeated here, with lengths of their own
    f.seek(sum(struct.unpack_from("<HH", head, 26)), 1)
    data = f.read(entry["packed"])
    if entry["method"] == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -15)
    elif entry["method"] == zipfile.ZIP_BZIP2:
        data = bz2.decompress(data)
    elif entry["method"] != zipfile.ZIP_STORED:
        raise ValueError(f"cannot read {entry['path']}: method {entry['method']}")
    if len(data) != entry["size"] or zlib.crc32(data) != entry["crc"]:
        raise ValueError(f"cannot read {entry['path']}: wrong checksum")
    return data


def read_splits(batches):
    """Arrow batches of :func:`archive_splits` to ``archive, entry_path, bytes``: an archive is
    opened once for each of its splits and read forwards, its directory not at all."""
    for batch in batches:
        for i in range(batch.num_rows):
            archive, entries = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
            fs, local = open_path(archive)
            with fs.open_input_file(local) as f:
                data = [_contents(f, e) for e in entries]
            yield pa.RecordBatch.from_arrays(
                [pa.array([archive] * len(data)), pa.array([e["path"] for e in entries]),
                 pa.array(data, pa.binary())],
                names=["archive", "entry_path", "bytes"],
            )


def unpack(spark: SparkSession, root: str, partitions=None) -> DataFrame:
    """Entries with their bytes.

    A task looks at an archive's directory once and cuts it into runs of neighbouring
    entries of about ``_BATCH_BYTES``; the runs, which are names and numbers, are dealt out, so
    one huge archive is read by many tasks.  Archives are opened once, and once for each run.
    """
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = from_arrow_schema(_SPLIT).simpleString()
    splits = _archives(spark, root).mapInArrow(archive_splits, kind[len("struct<") : -1])
    return splits.repartition(n, "archive", "first").mapInArrow(
        read_splits, "archive string, entry_path string, bytes binary"
    )


@F.pandas_udf(_DECODED)
def decode_wav(content: pd.Series) -> pd.DataFrame:
    """Samples and rate of 16-bit WAV bytes; ``error`` says what is wrong with a file."""
    return _decoded(content, lambda data: data)


def decoded_batches(batches, path, length=None, most=_BATCH_BYTES):
    """Arrow batches with the column ``path`` to batches with ``samples, rate, error``, too.

    A batch ends when its samples reach ``most`` bytes, or before a file whose ``length``
    would take it beyond that, so what is held does not depend on how many paths come at once.
    """
    for batch in batches:
        names = batch.schema.names
        paths = batch.column(names.index(path)).to_pylist()
        sizes = batch.column(names.index(length)).to_pylist() if length else [0] * len(paths)
        first, held, found = 0, 0, []

        def done(end):
            part = batch.slice(first, end - first)
            lists = [f[0] for f in found]
            bounds = np.cumsum([0] + [0 if x is None else len(x) for x in lists])
            flat = np.concatenate([np.zeros(0, np.float32), *[x for x in lists if x is not None]])
            starts = pa.array(bounds, pa.int32(), mask=np.array([x is None for x in lists] + [False]))
            return pa.RecordBatch.from_arrays(
                [*part.columns, pa.ListArray.from_arrays(starts, pa.array(flat)),
                 pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.string())],
                names=[*names, "samples", "rate", "error"],
            )

        for i, (name, size) in enumerate(zip(paths, sizes)):
            # 16-bit samples become floats: twice the bytes of the file
            if found and held + 2 * (size or 0) > most:
                yield done(i)
                first, held, found = i, 0, []
            found.append(_one(name, _bytes_at))
            held += 0 if found[-1][0] is None else found[-1][0].nbytes
            if held >= most:
                yield done(i + 1)
                first, held, found = i + 1, 0, []
        if found:
            yield done(len(paths))


def decoded_wavs(files: DataFrame, path="path", length=None) -> DataFrame:
    """``files`` with ``samples, rate, error``: each task opens its files itself, so no bytes
    are moved before, and holds about ``_BATCH_BYTES`` of samples at a time."""

    def run(batches):
        return decoded_batches(batches, path, length)

    new = {f.name: f for f in _DECODED}
    schema = T.StructType([f for f in files.schema if f.name not in new] + list(_DECODED))
    return files.select(*[c for c in files.columns if c not in new]).mapInArrow(run, schema)


def _bytes_at(path):
    fs, local = open_path(path)
    with fs.open_input_stream(local, compression=None) as f:
        return f.read()


def _one(value, read):
    """``(samples, rate, error)``; one bad file does not end the job."""
    try:
        return (*read_pcm16(read(value)), None)
    except Exception as e:
        return None, None, str(e) or type(e).__name__


def _decoded(values, read):
    return pd.DataFrame([_one(v, read) for v in values], columns=["samples", "rate", "error"])
