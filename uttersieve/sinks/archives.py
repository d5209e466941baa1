"""Archive sink: one zip per folder of clips, with its transcript.

``df.write.format("clip_archive").mode("append").save(path)``, where ``df`` has
``subset, folder_index, utt_id, text, clip`` and each folder sits in one
partition, in order (see :func:`prepared`).  A folder's zip holds
``NNNNNNNN/audio/{utt_id}.wav`` entries and ``NNNNNNNN/text.txt``.

Tasks write archives under their final names, in a hidden folder of the run and the task's
attempt.  What counts is the manifest: one small file that the commit puts in place,
which lists the archives of the attempts that finished.  So an export is there at once or
not at all, no archive is moved, and what a failed one has left is not read by anybody
and not in the way of the next.
"""

import uuid
import zipfile
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from uttersieve.sources.files import MANIFEST, open_path, published, qualified

_LISTED = pa.schema(
    [("name", pa.string()), ("subset", pa.string()), ("folder_index", pa.int64()),
     ("clips", pa.int64()), ("bytes", pa.int64())]
)


def prepared(clips: DataFrame, partitions=None) -> DataFrame:
    """Bring each folder into one task, in order.  A folder is limited in size,
    so however large its subset is, no task gets more than whole folders."""
    keys = ["subset", "folder_index"]
    spread = clips.repartition(partitions, *keys) if partitions else clips.repartition(*keys)
    return spread.sortWithinPartitions(*keys, "seq").select(*keys, "utt_id", "text", "clip")


def write_archives(clips: DataFrame, path: str, partitions=None) -> None:
    """Write ``subset, folder_index, seq, utt_id, text, clip`` as archives.

    ``path`` must not hold archives: an export is whole, and a second one into the
    same place would leave a mixture of both.
    """
    spark = clips.sparkSession
    if has_archives(spark, path):
        raise FileExistsError(f"{path} holds archives: export to a new path")
    spark.dataSource.register(ClipArchive)
    prepared(clips, partitions).write.format("clip_archive").mode("append").save(
        qualified(spark, path)
    )


def has_archives(spark, path: str) -> bool:
    """Whether an export into ``path`` has been committed."""
    return published(spark, path)


@dataclass
class _Written(WriterCommitMessage):
    files: list  # as in the manifest


class ClipArchive(DataSource):
    @classmethod
    def name(cls):
        return "clip_archive"

    def schema(self):
        return "subset string, folder_index bigint, utt_id string, text string, clip binary"

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only added: write to a new path")
        return _ArchiveWriter(self.options["path"])


class _ArchiveWriter(DataSourceArrowWriter):
    """An attempt of a task writes into a folder of its own, so one that is lost and run
    again, or two at once, do not touch each other's archives."""

    def __init__(self, path):
        self.path = path.rstrip("/")
        self.run = f"_run-{uuid.uuid4().hex}"

    def write(self, iterator):
        fs, root = open_path(self.path)
        mine = f"{self.run}/{uuid.uuid4().hex}"
        lines = f"{root}/{mine}/lines"  # transcript of the current folder, of any length
        files, current, out, archive, text = [], None, None, None, None

        def finish():
            if archive is None:
                return
            text.close()
            # a transcript may pass 2 GiB: only audio counts toward a folder's limit
            with archive.open(f"{current[1]:08d}/text.txt", "w", force_zip64=True) as entry:
                with fs.open_input_stream(lines, compression=None) as written:
                    while block := written.read(1 << 20):
                        entry.write(block)
            archive.close()
            out.close()

        for batch in iterator:
            columns = [batch.column(c) for c in ("subset", "folder_index", "utt_id", "text", "clip")]
            for values in zip(*columns):
                subset, folder, utt_id, line, clip = (v.as_py() for v in values)
                if (subset, folder) != current:
                    finish()
                    current = (subset, folder)
                    fs.create_dir(f"{root}/{mine}/subset={subset}", recursive=True)
                    name = f"{mine}/subset={subset}/{folder:08d}.zip"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    text = fs.open_output_stream(lines, compression=None)
                    files.append([name, subset, folder, 0, 0])
                text.write(f"{utt_id} {line}\n".encode())
                archive.writestr(f"{folder:08d}/audio/{utt_id}.wav", clip)
                files[-1][3] += 1
                files[-1][4] += len(clip)
        finish()
        if files:
            fs.delete_file(lines)
        return _Written(files)

    def commit(self, messages):
        fs, root = open_path(self.path)
        rows = sorted(tuple(f) for m in messages if m for f in m.files)
        columns = list(zip(*rows)) if rows else [[]] * len(_LISTED)
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, _LISTED)], schema=_LISTED)
        fs.create_dir(root, recursive=True)
        staged = f"{root}/_{uuid.uuid4().hex}"
        with fs.open_output_stream(staged, compression=None) as out:
            pq.write_table(table, out)
        fs.move(staged, f"{root}/{MANIFEST}")

    def abort(self, messages):
        import pyarrow.fs as pafs

        fs, root = open_path(f"{self.path}/{self.run}")
        if fs.get_file_info(root).type != pafs.FileType.NotFound:
            fs.delete_dir(root)


def extract(entries: DataFrame, root: str) -> None:
    """Write unpacked entries (``archive, entry_path, bytes``) as files below
    ``root``, one folder per archive.  A file appears whole or not at all, and a
    task that runs again writes the same files."""
    root = qualified(entries.sparkSession, root)

    def write(batches):
        for pdf in batches:
            for archive, entry, data in zip(pdf["archive"], pdf["entry_path"], pdf["bytes"]):
                parts = [p for p in entry.split("/") if p not in ("", ".", "..")]
                name = "/".join([*_folder_of(archive), *parts])
                fs, base = open_path(root)
                target = f"{base}/{name}"
                fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                staged = f"{target}.{uuid.uuid4().hex}"
                with fs.open_output_stream(staged, compression=None) as out:
                    out.write(data)
                fs.move(staged, target)
            yield pdf[["entry_path"]].iloc[:0]

    entries.mapInPandas(write, "entry_path string").write.format("noop").mode("overwrite").save()


def _folder_of(archive):
    """Archives of different subsets have entries of one name: keep the subset."""
    return [p for p in archive.split("/")[-2:-1] if p.startswith("subset=")]
