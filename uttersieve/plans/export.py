"""Queries that pack, encode and export clips."""

import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttersieve.functions import audio
from uttersieve.functions.text import transcript_line
from uttersieve.operators import infer, packing as ops
from uttersieve.plans import jobs, standins, views as v
from uttersieve.plans.catalog import query
from uttersieve.session import materialize, scratch_path
from uttersieve.sinks import tables as sinks
from uttersieve.sinks.archives import extract
from uttersieve.sources import files

_LIMIT = 20_000
_PCM = T.StructType(
    [T.StructField("header", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("rate", "samples", "pcm_sum")]
)


def _sized(spark, folder):
    return v.table(spark, folder, "documents").select(
        F.col("source").alias("subset"),
        F.col("doc_id").alias("seq"),
        v.utt_id(),
        F.col("n_chars").alias("size"),
        "text",
    )


# next-fit as a recursion over the rows of each source
_PACKED = f"""
n as (select source as subset, doc_id as seq, n_chars as size, text,
        'doc-' || lpad(cast(doc_id as varchar), 8, '0') as utt_id,
        row_number() over (partition by source order by doc_id) as pos from documents),
f as (
    select subset, seq, size, pos, cast(case when size > {_LIMIT} then 2 else 1 end as bigint)
        as folder_index, size as held from n where pos = 1
    union all
    select n.subset, n.seq, n.size, n.pos,
        f.folder_index + case when f.held + n.size > {_LIMIT} then 1 else 0 end,
        case when f.held + n.size > {_LIMIT} then n.size else f.held + n.size end
    from f join n on n.subset = f.subset and n.pos = f.pos + 1),
packed as (select n.subset, n.seq, n.utt_id, n.size, n.text, f.folder_index
    from n join f using (subset, seq))"""


def _packed(spark, folder):
    sized = _sized(spark, folder)
    ranges = materialize(ops.folder_ranges(sized, limit=_LIMIT), "folders")
    return ops.assign_folders(sized, ranges)


@query(
    f"""with recursive {_PACKED} select subset, seq, utt_id, size, folder_index,
    lpad(cast(folder_index as varchar), 8, '0') || '/audio/' || utt_id || '.wav' as entry_path
    from packed"""
)
def folder_packing(spark, folder):
    """Folder and entry path of every clip."""
    return _packed(spark, folder).select(
        "subset", "seq", "utt_id", "size", "folder_index", ops.entry_path().alias("entry_path")
    )


@query(
    f"""with recursive {_PACKED} select subset, folder_index, cast(sum(size) as bigint) as bytes,
    cast(count(*) as bigint) as clips from packed group by subset, folder_index"""
)
def folder_totals(spark, folder):
    return ops.folder_totals(ops.folder_ranges(_sized(spark, folder), limit=_LIMIT))


@query(
    f"""with recursive {_PACKED} select subset, folder_index,
    string_agg(utt_id || ' ' || text || chr(10), '' order by seq) as content
    from packed group by subset, folder_index"""
)
def folder_text(spark, folder):
    """Transcript of every folder.  Here the limit is on the text itself, so a
    folder is small; the archive sink streams its transcripts instead."""
    line = F.struct("seq", F.concat(transcript_line("utt_id", "text"), F.lit("\n")).alias("line"))
    ordered = F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"])
    return (
        _packed(spark, folder)
        .groupBy("subset", "folder_index")
        .agg(F.array_join(ordered, "").alias("content"))
    )


@query(
    f"""with recursive {_PACKED} select subset, folder_index, seq, utt_id || ' ' || text as line
    from packed"""
)
def folder_lines(spark, folder):
    """The same as rows, for folders of any size."""
    return _packed(spark, folder).select(
        "subset", "folder_index", "seq", transcript_line("utt_id", "text").alias("line")
    )


@query(
    v.with_views(
        "clips",
        body="""select vec_id, cast(44 + 2 * len(samples) as bigint) as size,
            len(samples) / rate as seconds,
            cast(ceil(len(samples) / rate * 50) as bigint) as frames from clips""",
    )
)
def clip_sizes(spark, folder):
    """WAV size, duration and frames, from the array length alone."""
    return v.clips(spark, folder).select(
        "vec_id",
        audio.wav_size("samples").alias("size"),
        audio.duration("samples", "rate").alias("seconds"),
        audio.frame_count("samples", "rate").alias("frames"),
    )


@query(
    v.with_views(
        "clips",
        body="""select vec_id, w as window_no, len(samples[w * 16 + 1 : w * 16 + 16]) as n,
            samples[w * 16 + 1] as first_sample
            from clips, generate_series(0, 3) g(w)""",
    )
)
def clip_windows(spark, folder):
    """One-second windows of every clip."""
    cut = v.clips(spark, folder).select(
        "vec_id", F.posexplode(audio.windows("samples", "rate", 1)).alias("w", "part")
    )
    return cut.select(
        "vec_id",
        F.col("w").cast("bigint").alias("window_no"),
        F.size("part").cast("bigint").alias("n"),
        F.element_at("part", 1).alias("first_sample"),
    )


def _features(spark, folder):
    clips = v.clips(spark, folder).withColumns(
        {"model_id": F.lit("encoder"), "language": F.lit(None).cast("string")}
    )
    return infer.features(clips, standins.FrameModel, audio="samples")


@query(
    v.with_views(
        "clips",
        body="""select vec_id, cast(200 as bigint) as n_frames, samples[1] as first_value,
            samples[199 % 64 + 2] as last_value from clips""",
    )
)
def frame_truncate(spark, folder):
    """Encoder output cut to the frames that cover the clip."""
    kept = audio.keep_frames("features", audio.frame_count("samples", "rate"))
    return (
        _features(spark, folder)
        .select("vec_id", kept.alias("f"))
        .select(
            "vec_id",
            F.size("f").cast("bigint").alias("n_frames"),
            F.col("f")[0][0].alias("first_value"),
            F.element_at(F.element_at("f", -1), -1).alias("last_value"),
        )
    )


@query(
    v.with_views(
        "clips",
        body="""select vec_id, cast(2 as bigint) as n_rows, cast(20 as bigint) as n_frames,
            samples[20] as corner, samples[52] as last_corner from clips""",
    )
)
def matrix_cap(spark, folder):
    """A dims-by-frames matrix capped to a model's maximum."""
    s = F.col("samples")
    matrix = F.array(F.slice(s, 1, 32), F.slice(s, 33, 32))
    return v.clips(spark, folder).select("vec_id", audio.cap_frames(matrix, 20).alias("m")).select(
        "vec_id",
        F.size("m").cast("bigint").alias("n_rows"),
        F.size(F.col("m")[0]).cast("bigint").alias("n_frames"),
        F.element_at(F.col("m")[0], -1).alias("corner"),
        F.element_at(F.col("m")[1], -1).alias("last_corner"),
    )


@F.pandas_udf(_PCM)
def _decode(data: pd.Series) -> pd.DataFrame:
    out = []
    for b in data:
        pcm = np.frombuffer(b, dtype="<i2", offset=44).astype(np.int64)
        out.append(
            (b[:4].decode(), struct.unpack_from("<I", b, 24)[0], len(pcm), int(pcm.sum()))
        )
    return pd.DataFrame(out, columns=["header", "rate", "samples", "pcm_sum"])


@query(
    v.with_views(
        "clips",
        body="""select vec_id, cast(44 + 2 * len(samples) as bigint) as size, 'RIFF' as header,
            cast(rate as bigint) as rate, cast(len(samples) as bigint) as samples,
            cast(list_sum(list_transform(samples, lambda x: cast(greatest(least(
                round_even(cast(x as double) * 32767, 0), 32767), -32768) as bigint))) as bigint)
                as pcm_sum from clips""",
    )
)
def clip_encode(spark, folder):
    """16-bit WAV bytes, decoded again and summed up."""
    wav = v.clips(spark, folder).select("vec_id", audio.encode_wav("samples", "rate").alias("wav"))
    return wav.select("vec_id", F.length("wav").cast("bigint").alias("size"), _decode("wav").alias("d")).select(
        "vec_id", "size", "d.*"
    )


def _clip_rows(spark, folder):
    """Clips as matched rows with their WAV size."""
    return v.clips(spark, folder).select(
        "subset",
        F.col("vec_id").alias("seq"),
        F.concat(F.lit("vec-"), F.col("vec_id").cast("string")).alias("utt_id"),
        F.concat(F.lit("clip "), F.col("vec_id").cast("string")).alias("text"),
        "samples",
        "rate",
    )


# 172 bytes a clip and a limit of 2000 make 11 clips a folder
_CLIP_FOLDERS = v.with_views(
    "clips",
    body="""select subset, vec_id, lpad(cast((row_number() over
        (partition by subset order by vec_id) - 1) // 11 + 1 as varchar), 8, '0') as folder
        from clips""",
)


def _archived(spark, folder):
    path = scratch_path(spark, "archives")
    jobs.export_clips(_clip_rows(spark, folder), path, limit=2000)
    return path


@query(
    f"""with c as ({_CLIP_FOLDERS})
    select subset, folder || '/audio/vec-' || vec_id || '.wav' as entry_path,
        cast(172 as bigint) as n_bytes, cast(null as varchar) as content from c
    union all select subset, folder || '/text.txt', cast(sum(length('vec-' || vec_id || ' clip '
        || vec_id) + 1) as bigint), string_agg('vec-' || vec_id || ' clip ' || vec_id || chr(10), ''
        order by vec_id) from c group by subset, folder"""
)
def archive_roundtrip(spark, folder):
    """Clips encoded, packed, written as archives and unpacked again."""
    entries = files.unpack(spark, _archived(spark, folder))
    is_text = F.col("entry_path").endswith(".txt")
    return entries.select(
        F.regexp_extract("archive", "subset=([^/]*)", 1).alias("subset"),
        "entry_path",
        F.length("bytes").cast("bigint").alias("n_bytes"),
        F.when(is_text, F.col("bytes").cast("string")).alias("content"),
    )


@query(
    f"""with c as ({_CLIP_FOLDERS})
    select 'vec-' || vec_id as name, 'audio' as speaker, cast(172 as bigint) as length,
        'RIFF' as header from c"""
)
def wav_scan(spark, folder):
    """Archives extracted to a folder tree, scanned as WAV files."""
    tree = scratch_path(spark, "tree")
    extract(files.unpack(spark, _archived(spark, folder)), tree)
    wavs = files.wav_files(spark, tree)
    return wavs.select(
        "name", "speaker", "length", F.substring("content", 1, 4).cast("string").alias("header")
    )


_HEARD = """'vec-' || vec_id as name, cast(rate as int) as rate,
    cast(len(samples) as bigint) as n_samples, cast(list_sum(list_transform(samples,
        lambda x: cast(greatest(least(round_even(cast(x as double) * 32767, 0), 32767), -32768)
        as bigint))) as bigint) as pcm_sum"""


def _heard(rows):
    """Rate, length and sum of decoded samples, as the 16-bit numbers they were."""
    pcm = F.transform("samples", lambda x: F.round(x * 32768).cast("bigint"))
    return rows.withColumns(
        {
            "n_samples": F.size("samples").cast("bigint"),
            "pcm_sum": F.aggregate(pcm, F.lit(0).cast("bigint"), lambda t, x: t + x),
        }
    )


@query(v.with_views("clips", body=f"select subset, {_HEARD} from clips"))
def archive_audio(spark, folder):
    """What the archives' clips sound like: unpacked, decoded and summed up."""
    clips = files.unpack(spark, _archived(spark, folder)).filter("entry_path like '%.wav'")
    decoded = clips.select(
        F.regexp_extract("archive", "subset=([^/]*)", 1).alias("subset"),
        F.regexp_extract("entry_path", r"([^/]*)\.wav$", 1).alias("name"),
        files.decode_wav("bytes").alias("a"),
    ).select("subset", "name", "a.samples", "a.rate")
    return _heard(decoded).drop("samples")


@query(v.with_views("clips", body=f"select {_HEARD}, cast(null as varchar) as error from clips"))
def wav_decode(spark, folder):
    """WAV files of a folder tree, opened and decoded in the tasks."""
    tree = scratch_path(spark, "tree")
    extract(files.unpack(spark, _archived(spark, folder)), tree)
    wavs = files.wav_files(spark, tree).select("path", "length", "name")
    return _heard(files.decoded_wavs(wavs, length="length")).select(
        "name", "rate", "n_samples", "pcm_sum", "error"
    )


@query(
    v.with_views(
        "clips",
        body="""select subset as speaker, 'vec-' || vec_id as name,
            cast(200 as bigint) as n_frames, samples[1] as first_value from clips""",
    )
)
def feature_table(spark, folder):
    """Features of every clip, saved by speaker and read back."""
    path = scratch_path(spark, "features")
    kept = audio.keep_frames("features", audio.frame_count("samples", "rate"))
    named = _features(spark, folder).select(
        F.col("subset").alias("speaker"),
        F.concat(F.lit("vec-"), F.col("vec_id").cast("string")).alias("name"),
        kept.alias("features"),
        "error",
    ).withColumn("path", F.concat_ws("/", "speaker", "name"))
    sinks.write_features(named, path)
    return spark.read.parquet(path).select(
        "speaker",
        "name",
        F.size("features").cast("bigint").alias("n_frames"),
        F.col("features")[0][0].alias("first_value"),
    )
