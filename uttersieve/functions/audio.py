"""Audio arrays: sizes, windows, frames and 16-bit WAV bytes."""

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttersieve.functions.text import _c
from uttersieve.schema import FRAMES_PER_SECOND, WINDOW_SECONDS

_HEADER = 44  # bytes of a canonical PCM header


def wav_size(samples) -> Column:
    """Bytes of the 16-bit mono WAV file, without making it."""
    return F.lit(_HEADER).cast("bigint") + F.size(_c(samples)).cast("bigint") * 2


def duration(samples, rate) -> Column:
    """Seconds of audio."""
    return F.size(_c(samples)) / _c(rate)


def frame_count(samples, rate, per_second=FRAMES_PER_SECOND) -> Column:
    """Encoder frames that cover the clip."""
    return F.ceil(duration(samples, rate) * per_second)


def keep_frames(frames, count) -> Column:
    """The first ``count`` frames of a frames-by-dims array."""
    return F.slice(_c(frames), F.lit(1), _c(count).cast("int"))


def cap_frames(matrix, most) -> Column:
    """The first ``most`` columns of a dims-by-frames array."""
    return F.transform(_c(matrix), lambda row: F.slice(row, 1, most))


def windows(samples, rate, seconds=WINDOW_SECONDS) -> Column:
    """Consecutive windows of ``seconds``; the last may be shorter."""
    s = _c(samples)
    step = (_c(rate) * seconds).cast("int")
    starts = F.when(
        F.size(s) > 0, F.sequence(F.lit(1), F.size(s), step)
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(s, i, step))


def pcm16_wav(samples: np.ndarray, rate: int) -> bytes:
    """One clip as WAV bytes; samples are scaled by 32767, rounded and clipped."""
    pcm = np.clip(np.rint(np.asarray(samples, dtype=np.float64) * 32767), -32768, 32767)
    body = pcm.astype("<i2").tobytes()
    head = b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt "
    head += struct.pack("<IHHIIHH", 16, 1, 1, rate, rate * 2, 2, 16)
    return head + b"data" + struct.pack("<I", len(body)) + body


def read_pcm16(data: bytes):
    """Samples in [-1, 1) and the rate of a 16-bit PCM WAV file.

    Chunks are walked, so others may stand before the samples; channels are averaged.
    Samples are divided by 32768, as decoders usually do.  Anything else raises.
    """
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form = 12, None
    while at + 8 <= len(data):
        name, size = struct.unpack_from("<4sI", data, at)
        body = at + 8
        if name == b"fmt ":
            if size < 16 or body + 16 > len(data):
                raise ValueError("the format chunk is cut off")
            form = struct.unpack_from("<HHIIHH", data, body)
        elif name == b"data":
            if form is None:
                raise ValueError("no format chunk before the samples")
            kind, channels, rate, _, _, bits = form
            if kind not in (1, 0xFFFE) or bits != 16 or channels < 1:
                raise ValueError(f"only 16-bit PCM is read: format {kind}, {bits} bits")
            if body + size > len(data):
                raise ValueError(f"{size} bytes of samples announced, {len(data) - body} there")
            pcm = np.frombuffer(data, "<i2", size // 2, body).astype(np.float32)
            pcm = pcm[: len(pcm) // channels * channels].reshape(-1, channels).mean(axis=1)
            return pcm.astype(np.float32) / np.float32(32768), rate
        at = body + size + size % 2
    raise ValueError("no samples chunk")


@F.pandas_udf(T.BinaryType())
def encode_wav(samples: pd.Series, rate: pd.Series) -> pd.Series:
    """Arrow-batched WAV encoder; null samples give null."""
    return pd.Series(
        [None if s is None else pcm16_wav(s, int(r)) for s, r in zip(samples, rate)]
    )
