"""Sources, sinks, archives and whole jobs."""

import io
import random
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from models import CodedAudio, Frames
from pyspark.sql import functions as F

from uttersieve.functions import audio
from uttersieve.operators import infer
from uttersieve.plans import jobs
from uttersieve.schema import UTTERANCE
from uttersieve.sinks import archives, tables as sinks
from uttersieve.sources import files, idlists, tables
from uttersieve.streaming import curation, epochs


def corpus(spark, path, names, n=12, first=0):
    """Clips whose samples code their text; every 4th is heard wrongly, every 5th fails."""
    rows = []
    for subset in names:
        for i in range(first, first + n):
            said = f"Word {i}"
            heard = "other" if i % 4 == 3 else said
            samples = [-1.0] if i % 5 == 4 else [ord(c) / 1000 for c in heard]
            utt = (subset, i, str(i), f"{subset}-{i:04d}", (None, samples, 16), said)
            rows.append(utt)
    spark.createDataFrame(rows, UTTERANCE).repartition(3).write.mode("append").partitionBy(
        "subset"
    ).parquet(path)
    return [r for r in rows if r[1] % 4 != 3 and r[1] % 5 != 4]


def test_curate_stream_then_batch_then_export(spark, tmp_path):
    root, out = str(tmp_path / "corpus"), str(tmp_path / "out")
    hits = corpus(spark, root, ["en100", "es000"])
    totals = {r.subset: r for r in jobs.curate(spark, root, out, CodedAudio).collect()}
    assert {k: (r.total, r.correct) for k, r in totals.items()} == {
        k: (12, len(hits) // 2) for k in ("en100", "es000")
    }
    # a second stream run finds nothing new; a batch run takes what came since
    more = corpus(spark, root, ["en100"], n=6, first=12)
    jobs.curate(spark, root, out, CodedAudio, stream=False)
    again = {r.subset: r for r in jobs.curate(spark, root, out + "", CodedAudio, stream=False).collect()}
    assert again["en100"].total == 18 and again["es000"].total == 12
    assert again["en100"].correct == len(hits) // 2 + len(more)
    assert again["es000"].name == f"es000_{len(hits) // 2}_12_{round(len(hits) / 24, 2)}"

    zips = str(tmp_path / "zips")
    limit = 300
    jobs.export_matched(spark, out, zips, limit=limit)
    expected = {}
    for subset in ("en100", "es000"):
        folder, held = 1, 0
        for s, i, _, utt, (_, samples, _), said in sorted(hits + more):
            if s != subset:
                continue
            size = 44 + 2 * len(samples)
            if held + size > limit:
                folder, held = folder + 1, 0
            held += size
            entry = expected.setdefault((subset, folder), [{}, ""])
            entry[0][f"{folder:08d}/audio/{utt}.wav"] = audio.pcm16_wav(np.array(samples, "f4"), 16)
            entry[1] += f"{utt} {said}\n"
    found = {}
    for p in (tmp_path / "zips").rglob("*.zip"):
        with zipfile.ZipFile(p) as z:
            key = (p.parent.name.removeprefix("subset="), int(p.stem))
            text = z.read(f"{p.stem}/text.txt").decode()
            found[key] = [{n: z.read(n) for n in z.namelist() if n.endswith(".wav")}, text]
    assert found == {k: v for k, v in expected.items()}
    assert not list((tmp_path / "zips").glob("_*/*/lines"))


def test_curate_batch_then_stream(spark, tmp_path):
    root, out = str(tmp_path / "corpus"), str(tmp_path / "out")
    hits = corpus(spark, root, ["en100"], n=7)
    jobs.curate(spark, root, out, CodedAudio, stream=False)
    hits += corpus(spark, root, ["en100"], n=8, first=7)
    total = jobs.curate(spark, root, out, CodedAudio, spread=3).first()
    assert (total.total, total.correct) == (15, len(hits))
    done = jobs.results(spark, out)
    assert done.select("subset", "seq").distinct().count() == done.count() == 15
    kept = done.filter("clip is not null").collect()
    assert sorted(r.seq for r in kept) == sorted(r[1] for r in hits)


def test_unpack_foreign_archive(spark, tmp_path):
    for name in ("a", "b"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr(f"00000001/audio/{name}.wav", b"x" * 10)
            z.writestr("00000001/text.txt", f"{name} text\n")
    got = files.unpack(spark, str(tmp_path)).collect()
    assert {(r.archive[-5:], r.entry_path, bytes(r.bytes)) for r in got} >= {
        ("a.zip", "00000001/audio/a.wav", b"x" * 10),
        ("b.zip", "00000001/text.txt", b"b text\n"),
    }
    assert len(got) == 4


def _zipped(folder, archives=3, entries=40):
    rng = np.random.default_rng(1)
    expected = {}
    for a in range(archives):
        path = folder / f"{a}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for e in range(entries):
                data = rng.integers(0, 4, rng.integers(0, 3000)).astype(np.uint8).tobytes()
                method = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2)[e % 3]
                z.writestr(zipfile.ZipInfo(f"é{e}/x.bin"), data, method)
                expected[f"file:{path}", f"é{e}/x.bin"] = data
            z.writestr("folder/", b"")
    return expected


def test_unpack_opens_each_archive_once_and_once_for_each_split(tmp_path, monkeypatch):
    expected = _zipped(tmp_path)
    opened, real = [], files.open_path
    monkeypatch.setattr(files, "open_path", lambda uri: opened.append(uri) or real(uri))
    monkeypatch.setattr(files, "_BATCH_BYTES", 10_000)
    paths = pa.record_batch({"path": sorted({a for a, _ in expected})})
    splits = list(files.archive_splits([paths]))
    assert len(opened) == 3 and len(splits) > 9
    got = {}
    for batch in files.read_splits(splits):
        assert batch.nbytes < 15_000
        got |= {(r["archive"], r["entry_path"]): r["bytes"] for r in batch.to_pylist()}
    assert got == expected
    assert len(opened) == 3 + sum(b.num_rows for b in splits)


def test_unpack_in_spark(spark, tmp_path):
    expected = _zipped(tmp_path, 2)
    got = files.unpack(spark, str(tmp_path), partitions=5).collect()
    assert {(r.archive, r.entry_path): bytes(r.bytes) for r in got} == expected
    assert files.unpack(spark, str(tmp_path)).columns == ["archive", "entry_path", "bytes"]


def test_a_damaged_entry_is_an_error(tmp_path):
    _zipped(tmp_path, 1, 3)
    raw = bytearray((tmp_path / "0.zip").read_bytes())
    raw[60] ^= 1
    (tmp_path / "0.zip").write_bytes(raw)
    splits = files.archive_splits([pa.record_batch({"path": [f"file:{tmp_path}/0.zip"]})])
    with pytest.raises(Exception):
        list(files.read_splits(splits))


@pytest.mark.parametrize("sized", [False, True])
def test_decoding_holds_few_files(tmp_path, sized):
    """200 files of a megabyte at once: what is held is bounded, whatever the batch of paths."""
    import tracemalloc

    data = audio.pcm16_wav(np.linspace(-1, 1, 1 << 19), 16_000)
    (tmp_path / "a.wav").write_bytes(data)
    (tmp_path / "bad.wav").write_bytes(data[:99])
    paths = [f"file:{tmp_path}/{'bad' if i == 70 else 'a'}.wav" for i in range(200)]
    batch = pa.record_batch({"path": paths, "length": [len(data)] * 200, "k": range(200)})
    seen = []
    tracemalloc.start()
    for out in files.decoded_batches([batch], "path", "length" if sized else None, 16 << 20):
        assert out.nbytes <= 19 << 20
        rows = out.select(["k", "rate", "error"]).to_pylist()
        assert all(n == 1 << 19 for n in out.column("samples").value_lengths().drop_null().to_pylist())
        seen += rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r["k"] for r in seen] == list(range(200))
    assert [r["k"] for r in seen if r["error"]] == [70] and seen[70]["rate"] is None
    assert peak < 80 << 20  # all at once they would be 400 MB


def test_extract_keeps_inside(spark, tmp_path):
    entries = spark.createDataFrame(
        [("z.zip", "../../evil.wav", bytearray(b"e")), ("z.zip", "spk/ok.wav", bytearray(b"o"))],
        "archive string, entry_path string, bytes binary",
    )
    archives.extract(entries, str(tmp_path / "tree"))
    names = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.wav"))
    assert names == ["tree/evil.wav", "tree/spk/ok.wav"]


def test_archives_are_only_added(spark, tmp_path):
    spark.dataSource.register(archives.ClipArchive)
    rows = spark.createDataFrame(
        [("a", 1, "u", "t", bytearray(b"w"))],
        "subset string, folder_index bigint, utt_id string, text string, clip binary",
    )
    with pytest.raises(Exception, match="only added"):
        rows.write.format("clip_archive").mode("overwrite").save(str(tmp_path / "z"))


def test_feature_job_skips_done(spark, tmp_path):
    for spk in ("ann", "bob"):
        (tmp_path / "in" / spk).mkdir(parents=True)
        for i in range(2):
            wav = audio.pcm16_wav(np.full(32, 0.5), 16)
            (tmp_path / "in" / spk / f"{i}.wav").write_bytes(wav)
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = jobs.extract_features(spark, root, out, Frames, symbol="ann")
    assert {(r.speaker, r.name, len(r.features)) for r in first.collect()} == {
        ("ann", "0", 100), ("ann", "1", 100),
    }
    both = jobs.extract_features(spark, root, out, Frames)
    assert both.count() == 4 and both.select("speaker", "name").distinct().count() == 4


def test_id_lists(spark, tmp_path):
    odd = ["plain", "with,comma", 'with"quote', "end"]
    ids = spark.createDataFrame(
        [("a", i, x) for i, x in enumerate(odd)] + [("b", 0, "z")],
        "subset string, seq bigint, utt_id string",
    )
    sinks.write_id_rows(ids, str(tmp_path / "rows"), per_line=3)
    lines = [t for p in (tmp_path / "rows" / "subset=a").glob("*.txt") for t in p.read_text().splitlines()]
    assert sorted(lines) == sorted(['plain,"with,comma","with""quote"', "end"])
    back = idlists.read_id_rows(spark, str(tmp_path / "rows")).filter("subset = 'a'")
    assert sorted(r.utt_id for r in back.collect()) == sorted(odd)
    sinks.write_ids(ids, str(tmp_path / "lines"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "lines" / "subset=a").glob("*.txt")))
    assert text.split("\n")[:-1] == odd


def test_missing_log_is_empty(spark, tmp_path):
    assert tables.reopen(spark, str(tmp_path / "none"), "a int").count() == 0


def test_log_chunks(spark):
    log = spark.range(11).select(F.lit("a").alias("subset"), F.col("id").alias("seq"))
    got = tables.log_chunks(log, chunk_rows=4).groupBy("chunk").count().orderBy("chunk").collect()
    assert [(r.chunk, r["count"]) for r in got] == [(1, 4), (2, 4), (3, 3)]


def test_restarts_are_bounded():
    tries = []

    def start():
        tries.append(1)
        raise RuntimeError("stall")

    with pytest.raises(RuntimeError):
        curation.run_to_end(start, attempts=3, wait=0)
    assert len(tries) == 3


def test_failed_stream_goes_on(spark, tmp_path):
    """A run that dies in the middle neither loses nor repeats a row."""
    root, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for i in range(4):
        spark.range(i * 10, i * 10 + 10).write.mode("append").parquet(root)
    flag = tmp_path / "failed-once"

    def fail_once(pdf):
        if 25 in set(pdf["id"]) and not flag.exists():
            flag.touch()
            raise RuntimeError("lost")
        return pdf.assign(subset="a")

    def start():
        rows = tables.utterance_stream(spark, root, schema="id bigint", files_per_batch=1)
        return curation.append_query(
            infer.map_rows(rows, fail_once, "id bigint, subset string"), out, mark
        )

    curation.run_to_end(start, attempts=3, wait=0)
    assert flag.exists()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))


def test_decode_wav_bytes():
    data = audio.pcm16_wav(np.array([0.25, -0.25]), 8000)
    assert io.BytesIO(data).read(4) == b"RIFF"
    samples, rate = audio.read_pcm16(data)
    assert rate == 8000 and np.allclose(samples, [0.25, -0.25], atol=1e-4)


def test_two_runs_leave_each_id_once(spark, tmp_path):
    root, out = str(tmp_path / "corpus"), str(tmp_path / "out")
    first = corpus(spark, root, ["en100"])
    jobs.curate(spark, root, out, CodedAudio, stream=False)
    more = corpus(spark, root, ["en100"], n=6, first=12)
    jobs.curate(spark, root, out, CodedAudio, stream=False)
    listed = [r.value for r in spark.read.text(f"{out}/ids").select("value").collect()]
    assert sorted(listed) == sorted(r[3] for r in first + more)
    zips = str(tmp_path / "zips")
    jobs.export_matched(spark, out, zips, limit=300)
    with pytest.raises(FileExistsError):
        jobs.export_matched(spark, out, zips, limit=300)


def test_batch_commits_group_by_group(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "corpus"), str(tmp_path / "out")
    for first in (0, 6, 12):
        corpus(spark, root, ["en100"], n=6, first=first)
    files_there = len(tables.utterances(spark, root).inputFiles())
    seen = []
    real = curation.score_stream

    def failing(todo, *args, **kwargs):
        seen.append(todo.count())
        if len(seen) == 3:
            raise RuntimeError("lost")
        return real(todo, *args, **kwargs)

    monkeypatch.setattr(curation, "score_stream", failing)
    with pytest.raises(RuntimeError):
        jobs.curate(spark, root, out, CodedAudio, stream=False, files_per_batch=2, attempts=1)
    kept = jobs.results(spark, out).count()
    assert kept == sum(seen[:2]) > 0
    seen += [0] * 3  # no more failures
    totals = jobs.curate(spark, root, out, CodedAudio, stream=False, files_per_batch=2)
    assert totals.first().total == 18 and sum(seen[6:]) == 18 - kept
    assert files_there > 4


def test_a_group_reads_its_rows_and_the_index_only(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "corpus"), str(tmp_path / "out")
    corpus(spark, root, ["en100", "es000"])
    read, real = [], tables.reopen
    monkeypatch.setattr(tables, "reopen", lambda s, path, *a: read.append(path) or real(s, path, *a))
    at_end = len(read)
    jobs.results(spark, out)
    at_end = len(read)  # what the report reads
    read.clear()
    jobs.curate(spark, root, out, CodedAudio, stream=False, files_per_batch=1)
    groups = len(tables.utterances(spark, root).inputFiles())
    assert groups > 3 and len(read) == 2 + at_end  # both logs once, not once a group
    done = jobs.results(spark, out)
    assert done.count() == done.select("subset", "seq").distinct().count() == 24
    read.clear()
    jobs.curate(spark, root, out, CodedAudio, stream=False, files_per_batch=1)
    assert jobs.results(spark, out).count() == 24


def test_index_of_what_is_done(spark):
    rows = spark.range(100_000).selectExpr("if(id % 3 = 0, 'b', 'a') as subset", "id as seq")
    index = curation.Done(rows.filter("seq < 20000"))
    for low in (20_000, 50_000, 40_000):
        index.add(rows.filter(f"seq >= {low} and seq < {low} + 15000"))
    left = index.without(rows)
    assert left.count() == 45_000 - 10_000 + 5_000
    assert left.filter("seq < 35000 or seq between 40000 and 64999").count() == 0


class Short:
    def __init__(self, name):
        pass

    def __call__(self, payloads, languages):
        return ["one"]


def test_a_short_answer_is_a_failure():
    texts, errors = infer._run_safely(Short("m"), ["a", "b", "c"], ["en"] * 3)
    assert texts == ["one"] * 3 and errors == [None] * 3  # row by row it answers each
    none = lambda payloads, languages: []
    texts, errors = infer._run_safely(none, ["a", "b"], ["en"] * 2)
    assert texts == [None, None] and all("0 results" in e for e in errors)


def test_feature_job_keeps_errors(spark, tmp_path):
    (tmp_path / "in" / "ann").mkdir(parents=True)
    good = audio.pcm16_wav(np.full(32, 0.5), 16)
    (tmp_path / "in" / "ann" / "a.wav").write_bytes(good)
    (tmp_path / "in" / "ann" / "b.wav").write_bytes(good[:50])
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    assert [r.name for r in jobs.extract_features(spark, root, out, Frames).collect()] == ["a"]
    bad = spark.read.parquet(out).filter("error is not null").collect()
    assert [r.name for r in bad] == ["b"] and "announced" in bad[0].error
    (tmp_path / "in" / "ann" / "b.wav").write_bytes(good)
    again = jobs.extract_features(spark, root, out, Frames)
    assert sorted(r.name for r in again.collect()) == ["a", "b"]


@pytest.mark.parametrize("place_rows", [10, 10_000])
def test_ingest_of_mixed_and_unmixed_files(spark, tmp_path, monkeypatch, place_rows):
    """All subsets in one file, one in another, none in a third; in one run and in several."""
    monkeypatch.setattr(tables, "PLACE_ROWS", place_rows)
    monkeypatch.setattr(tables, "_PLACES", 4)
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    rng = random.Random(1)
    expected, seen = {}, {}
    for f in range(7):
        names = ["a"] if f in (2, 3) else ["a", "b", "c"][: 1 + f % 3]
        rows = [(rng.choice(names), f"{f}-{i}") for i in range(0 if f == 5 else 11)]
        table = pa.table({"subset": [r[0] for r in rows], "utt_id": [r[1] for r in rows]},
                         pa.schema([("subset", pa.string()), ("utt_id", pa.string())]))
        pq.write_table(table, str(raw / f"part-{f:02d}.parquet"), row_group_size=3)
        for s, u in rows:
            expected[u] = (s, seen.get(s, 0))
            seen[s] = seen.get(s, 0) + 1
    got = tables.ingest(spark, str(raw), out).collect()
    assert {r["utt_id"]: (r["subset"], r["seq"]) for r in got} == expected and len(got) == 66


def test_ingest_moves_no_audio(spark, tmp_path):
    """Mixed files are numbered where they are read: nothing wide below an exchange."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = spark.range(200).selectExpr("elt(1 + int(id % 3), 'a', 'b', 'c') as subset",
                                       "string(id) as utt_id", "repeat('x', 100) as wide_column")
    rows.coalesce(2).write.parquet(raw)
    plans = []
    keep = tables.materialize
    try:
        tables.materialize = lambda df, label: plans.append(df) or keep(df, label)
        assert tables.ingest(spark, raw, out).count() == 200
    finally:
        tables.materialize = keep
    assert len(plans) == 3  # counts, offsets, places
    for df in plans:
        assert "wide_column" not in df._jdf.queryExecution().executedPlan().toString()


def test_ingest_refuses_rows_without_a_subset(spark, tmp_path):
    raw = str(tmp_path / "raw")
    rows = [("a", "x"), (None, "y"), ("a", "z")]
    spark.createDataFrame(rows, "subset string, utt_id string").coalesce(1).write.parquet(raw)
    with pytest.raises(ValueError, match="without a subset"):
        tables.ingest(spark, raw, str(tmp_path / "out"))


@pytest.mark.parametrize("stream", [False, True])
def test_curate_refuses_rows_without_seq(spark, tmp_path, stream):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("en100", None, "1", "u1", ("p", [0.5], 16), "one")]
    spark.createDataFrame(rows, UTTERANCE).write.partitionBy("subset").parquet(root)
    with pytest.raises(Exception, match="without seq"):
        jobs.curate(spark, root, out, CodedAudio, stream=stream, attempts=1)
    assert jobs.results(spark, out).count() == 0


def test_progress_over_many_batches_and_a_restart(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for i in range(6):
        spark.range(i * 10, i * 10 + 10).selectExpr("id", "int(id % 2) as acc").coalesce(
            1).write.mode("append").parquet(source)
    limit = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(limit, "2")
    fail = tmp_path / "fail"
    fail.write_text("x")

    @F.udf("int")
    def acc(a, i):
        if i == 35 and fail.exists():
            raise RuntimeError("lost")
        return a

    kept = curation.Progress(spark)
    try:
        stream = spark.readStream.schema("id bigint, acc int").option("maxFilesPerTrigger", 1)
        rows = stream.parquet(source).select("id", acc("acc", "id").alias("acc"), F.lit("s").alias("subset"))

        def start():
            return curation.append_query(curation.observed(rows), out, mark)

        with pytest.raises(Exception):
            curation.run_to_end(start, attempts=1)
        fail.unlink()
        seen = kept.of(curation.run_to_end(start, attempts=1))
    finally:
        kept.close()
        spark.conf.unset(limit)
    assert (sum(n for _, n, _ in seen), sum(c for _, _, c in seen)) == (60, 30)
    assert len(seen) == 6
    assert spark.read.parquet(out).count() == 60


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from uttersieve import session

    class Elsewhere:
        conf = type("Conf", (), {"get": lambda self, key, default=None: None})()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Elsewhere())


def _few_clips(spark, n=30):
    return spark.range(n).selectExpr(
        "elt(1 + int(id % 2), 'a', 'b') as subset", "id as seq", "concat('u', id) as utt_id",
        "concat('text ', id) as text", "transform(sequence(1, 20), i -> float(i) / 40) as samples",
        "16 as rate",
    )


def test_a_half_export_is_not_there_and_not_in_the_way(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "zips")

    @F.udf("string")
    def bad(text, seq):
        if seq == 27:
            raise RuntimeError("lost")
        return text

    broken = _few_clips(spark).withColumn("text", bad("text", "seq"))
    with pytest.raises(Exception):
        jobs.export_clips(broken, path, limit=300, partitions=5)
    # also what a driver that died before its clean-up would have left
    left = tmp_path / "zips" / "_run-0" / "x" / "subset=a"
    left.mkdir(parents=True)
    (left / "00000001.zip").write_bytes(b"half")
    assert not archives.has_archives(spark, path)
    assert files.archive_index(spark, path).count() == 0
    jobs.export_clips(_few_clips(spark), path, limit=300, partitions=5)
    listed = files.manifest(spark, path).collect()
    assert sum(r.clips for r in listed) == 30 and sum(r.bytes for r in listed) == 30 * 84
    entries = files.unpack(spark, path).filter("entry_path like '%.wav'")
    assert entries.count() == 30 and entries.select("archive").distinct().count() == len(listed)
    with pytest.raises(FileExistsError):
        jobs.export_clips(_few_clips(spark), path, limit=300)


def test_the_commit_moves_no_archive(tmp_path):
    """The driver puts one small file in place, whatever has been written."""
    root = f"file:{tmp_path}/zips"
    writer = archives._ArchiveWriter(root)
    rows = [("s", f, f"u{f}{i}", "t", b"x" * 50) for f in (1, 2) for i in range(3)]
    names = ("subset", "folder_index", "utt_id", "text", "clip")
    batch = pa.record_batch({n: list(c) for n, c in zip(names, zip(*rows))})
    lost, done = writer.write(iter([batch])), writer.write(iter([batch]))
    before = {p: p.stat().st_ino for p in (tmp_path / "zips").rglob("*.zip")}
    assert len(before) == 4 and lost.files != done.files
    writer.commit([done, None])
    after = {p: p.stat().st_ino for p in (tmp_path / "zips").rglob("*.zip")}
    assert after == before
    table = pq.read_table(tmp_path / "zips" / files.MANIFEST).to_pylist()
    assert [r["name"] for r in table] == sorted(f[0] for f in done.files)
    assert [(r["folder_index"], r["clips"], r["bytes"]) for r in table] == [(1, 3, 150), (2, 3, 150)]


def _epoch(writer, epoch, totals):
    batches = [pa.record_batch({"subset": [k], "total": [n], "correct": [c]}) for k, n, c in totals]
    return writer.commit([writer.write(iter([b])) for b in batches] + [writer.write(iter([]))], epoch)


def test_epochs_are_compacted_and_their_history_stays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(epochs, "TAIL", 4)
    path = str(tmp_path / "totals")
    schema = "subset string, total bigint, correct bigint"
    assert epochs.latest_epoch(spark, path, schema).count() == 0
    assert curation.progress(spark, path).count() == 0
    for n in range(15):
        # each a new writer, as a new driver process would have
        _epoch(epochs._EpochWriter(f"file:{path}"), n, [("a", 10 * n, n), ("b", 5, n)])
        if n == 9:  # replayed
            _epoch(epochs._EpochWriter(f"file:{path}"), n, [("a", 90, 9), ("b", 5, 9)])
        newest = {tuple(r) for r in epochs.latest_epoch(spark, path, schema).collect()}
        assert newest == {("a", 10 * n, n), ("b", 5, n)}
        assert len(list((tmp_path / "totals" / "data").iterdir())) <= 4  # of two epochs
        assert len(list((tmp_path / "totals").glob("epoch-*.json"))) <= 2
    sums = epochs.epoch_sums(spark, path, ["total", "correct"]).collect()
    assert [tuple(r) for r in sorted(sums)] == [(n, 10 * n + 5, 2 * n) for n in range(15)]
    moved = sorted(map(tuple, curation.progress(spark, path).collect()))
    assert moved == [(0, 5, 0)] + [(n, 10, 2) for n in range(1, 15)]


def test_a_commit_that_fails_leaves_the_epoch_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "totals")
    schema = "subset string, total bigint, correct bigint"
    _epoch(epochs._EpochWriter(f"file:{path}"), 0, [("a", 3, 1)])
    real = epochs._write

    def failing(fs, name, value):
        raise OSError("disk")

    monkeypatch.setattr(epochs, "_write", failing)
    with pytest.raises(OSError):
        _epoch(epochs._EpochWriter(f"file:{path}"), 1, [("a", 7, 2)])
    monkeypatch.setattr(epochs, "_write", real)
    assert [tuple(r) for r in epochs.latest_epoch(spark, path, schema).collect()] == [("a", 3, 1)]
    _epoch(epochs._EpochWriter(f"file:{path}"), 1, [("a", 7, 2)])
    assert [tuple(r) for r in epochs.latest_epoch(spark, path, schema).collect()] == [("a", 7, 2)]
    assert sorted(map(tuple, curation.progress(spark, path).collect())) == [(0, 3, 1), (1, 4, 1)]


_RUN_STREAM = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
from uttersieve.session import build_session, ship_package
from uttersieve.streaming import curation, epochs
spark = build_session("local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "1g"}})
ship_package(spark)
stream = spark.readStream.schema("subset string, acc int").option("maxFilesPerTrigger", 1)
rows = stream.parquet({source!r})
curation.run_to_end(lambda: curation.totals_query(rows, {out!r}, {mark!r}), attempts=1)
spark.stop()
"""


def test_progress_over_two_driver_processes(spark, tmp_path):
    import subprocess
    import sys

    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    root = str(Path(__file__).resolve().parent.parent)
    code = _RUN_STREAM.format(root=root, tests=f"{root}/tests", source=source, out=out, mark=mark)
    for part in (3, 2):
        for _ in range(part):
            spark.range(20).selectExpr("elt(1 + int(id % 2), 'a', 'b') as subset", "int(id % 4 = 0) as acc"
                                       ).coalesce(1).write.mode("append").parquet(source)
        subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    got = sorted(map(tuple, curation.progress(spark, out).collect()))
    assert got == [(n, 20, 5) for n in range(5)]


def test_positions_pass_once_with_a_bit_of_state(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    n = 60_000
    rows = spark.range(n).selectExpr("if(id % 3 = 0, 'b', 'a') as subset", "id as seq", "string(id) as utt_id")
    schema = rows.schema
    for part in (rows.filter("id < 40000"), rows.filter("id > 30000"), rows.filter("id % 2 = 0")):
        part.union(part.limit(500)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        once = curation.without_repeated_positions(stream)
        curation.run_to_end(lambda once=once: curation.append_query(once, out, mark), attempts=1)
    got = spark.read.parquet(out)
    assert got.count() == got.select("subset", "seq").distinct().count() == n
    assert got.filter("utt_id <> string(seq) or (subset = 'b') <> (seq % 3 = 0)").count() == 0
    state = spark.read.format("statestore").option("stateVarName", "bits").load(mark)
    size = state.agg(F.sum(F.length("value.bits"))).first()[0]
    assert size < n / 2  # bytes: two subsets share the positions, a bit each


def test_positions_pass_once_in_a_session_of_sparks_own_settings(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    plain = spark.newSession()
    plain.conf.set(
        name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    )
    before = plain.conf.get(name)
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows = plain.range(50).selectExpr("'a' as subset", "id as seq")
    for _ in range(2):
        rows.union(rows).coalesce(1).write.mode("append").parquet(source)
        stream = plain.readStream.schema(rows.schema).parquet(source)
        once = curation.without_repeated_positions(stream)
        curation.run_to_end(lambda once=once: curation.append_query(once, out, mark), attempts=1)
    assert sorted(r["seq"] for r in plain.read.parquet(out).collect()) == list(range(50))
    assert plain.conf.get(name) == before


def test_paths_are_spark_paths(spark, tmp_path):
    assert files.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    fs, path = files.open_path(f"file:{tmp_path}/a%20b")
    assert path == f"{tmp_path}/a b"


def test_tsv(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b\tx"), (1, 'q"'), (3, None)], "k int, v string")
    sinks.write_tsv(rows, str(tmp_path / "t"), "k")
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*")))
    assert text == '\tv\n0\t"q"""\n1\t"b\tx"\n2\t\n'


def test_files_of_a_stream_grow_in_number_not_in_size(spark, monkeypatch):
    from uttersieve.plans import streams

    folder = "/root/testdata/sf0.001"
    one = streams.stream_progress_kept(spark, folder).first()
    monkeypatch.setattr(streams, "_FILE_BYTES", 20_000)
    path = str(spark.conf.get("uttersieve.scratch")) + "/grown"
    per_batch = list(streams._as_files(spark, folder, path, halves=True))
    files_written = spark.read.parquet(path).inputFiles()
    assert len(files_written) > 8 and min(per_batch) > 1
    assert spark.read.parquet(path).count() == one["rows_seen"]
    assert streams.stream_progress_kept(spark, folder).first() == one
