"""Column functions against plain Python."""

import math
import string
import struct

import numpy as np
import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from uttersieve.functions import audio, numbers, text, times
from uttersieve.schema import LANGUAGES, PUNCTUATION, WHITESPACE

SLOW = settings(
    max_examples=8, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def plain_normalize(s):
    return s.strip().lower().translate(str.maketrans("", "", string.punctuation))


def column(spark, values, kind, fn):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_fixed_values():
    assert PUNCTUATION == string.punctuation
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert len(LANGUAGES) == len(set(LANGUAGES)) == 100


def test_normalize_golden(spark):
    cases = {
        " Hello, World! ": "hello world",
        "hello !": "hello ",
        "¿Qué?": "¿qué",
        "...": "",
        "A-B c": "ab c",
        "\tTab\n": "tab",
        "İ": "i̇",
        "ΑΣ": "ας",
        "\x1cx\x85": "x",
    }
    assert column(spark, cases, "string", text.normalize) == list(cases.values())
    assert column(spark, [None], "string", text.normalize) == [None]


# characters whose case mapping is the same in every Unicode version in use
ALPHABET = st.characters(codec="utf-8", max_codepoint=0x3000, categories=["L", "N", "P", "Z", "S", "Cc"])


@SLOW
@given(st.lists(st.text(ALPHABET, max_size=12), min_size=30, max_size=60))
def test_normalize_any_text(spark, values):
    values = [v.replace("\0", "") for v in values]
    assert column(spark, values, "string", text.normalize) == [plain_normalize(v) for v in values]


def test_language_and_model(spark):
    names = ["en100", "es104", "iw000", "h100", "haw00"]
    assert column(spark, names, "string", text.language) == ["en", "es", None, None, "ha"]
    aliased = column(spark, names, "string", lambda c: text.language(c, {"iw": "he"}))
    assert aliased == ["en", "es", "he", None, "ha"]
    models = column(spark, names, "string", text.model_for)
    assert ["distil" in m for m in models] == [True, False, False, False, False]


def test_noise(spark):
    heard = [
        "sound", "They danced to loud music", "a sound idea", "music", "Noise from the street",
        "sounds", " NOISE\n", "no music", None,
    ]
    kept = [h for h, n in zip(heard, column(spark, heard, "string", text.is_noise)) if not n]
    assert kept == [heard[i] for i in (1, 2, 4, 5, 7, 8)]


def test_rounding_is_pythons(spark):
    values = [0.125, 0.285, 0.295, 2.675, 0.005, 0.015, 0.0, 1.0, 99.995]
    values += [c / t for t in range(1, 120) for c in range(t + 1)]
    assert column(spark, values, "double", numbers.round2) == [round(v, 2) for v in values]
    assert column(spark, values, "double", numbers.percent_text) == [f"{v:.2%}" for v in values]
    assert column(spark, [None], "double", numbers.percent_text) == [None]


def test_label_values(spark):
    labels = ["12M", "3B", "450", "12.4M", "none", "7MB"]
    digits = column(spark, labels, "string", numbers.label_value)
    assert digits == [12_000_000, 3_000_000_000, 450, 124_000_000, None, 7_000_000]
    decimal = column(spark, labels, "string", lambda c: numbers.label_value(c, "decimal"))
    assert decimal == [12_000_000, 3_000_000_000, 450, 12_400_000, None, 7_000_000]


def test_month_labels(spark):
    assert column(spark, ["12 Jan", "Dec", "x 7"], "string", numbers.month_label) == [
        "2022.01", "2022.12", None,
    ]


def test_age(spark):
    as_of = F.to_timestamp(F.lit("2024-02-01T00:00:00Z"), "yyyy-MM-dd'T'HH:mm:ssX")
    got = column(
        spark,
        ["2024-01-01T23:00:00Z", "2024-01-01T00:00:00Z", "2024-01-01", "2024-01-01T00:00:00+02"],
        "string",
        lambda c: times.age_days(as_of, times.parse_utc(c)),
    )
    assert got == [30, 31, None, None]


def test_sentences_and_words(spark):
    got = column(spark, ["One. Two!  Three? four.five", ""], "string", text.sentences)
    assert got == [["One.", "Two!", "Three?", "four.five"], [""]]
    assert column(spark, [" a  b ", "", "\n"], "string", text.word_count) == [2, 0, 0]


def test_wav_bytes(spark):
    samples = [[0.0, 0.5, -1.0, 2.0], [], None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s array<float>")
    rows = df.orderBy("i").select(
        audio.encode_wav("s", F.lit(16000)).alias("wav"), audio.wav_size("s").alias("size")
    ).collect()
    assert len(rows[0].wav) == rows[0].size == 52
    assert len(rows[1].wav) == rows[1].size == 44
    assert rows[2].wav is None
    back, rate = audio.read_pcm16(bytes(rows[0].wav))
    assert rate == 16000 and np.allclose(back, [0.0, 0.5, -1.0, 1.0], atol=1e-4)


def test_windows_and_frames(spark):
    df = spark.createDataFrame([(list(map(float, range(70))), 16), ([], 16)], "s array<float>, r int")
    rows = df.select(
        audio.windows("s", "r", 2).alias("w"), audio.frame_count("s", "r").alias("n")
    ).collect()
    assert [len(w) for w in rows[0].w] == [32, 32, 6] and rows[1].w == []
    assert rows[0].n == math.ceil(70 / 16 * 50) and rows[1].n == 0


def wav(body, channels=1, bits=16, before=b"", cut=0):
    head = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, channels, 8000, 16000 * channels, 2, bits)
    chunks = b"WAVE" + head + before + struct.pack("<4sI", b"data", len(body)) + body
    data = b"RIFF" + struct.pack("<I", len(chunks)) + chunks
    return data[: len(data) - cut]


def test_wav_files_of_others():
    pcm = np.array([16384, -16384, 8192], "<i2").tobytes()
    listed = struct.pack("<4sI", b"LIST", 5) + b"INFOx" + b"\0"
    samples, rate = audio.read_pcm16(wav(pcm, before=listed))
    assert rate == 8000 and samples.tolist() == [0.5, -0.5, 0.25]
    stereo, _ = audio.read_pcm16(wav(np.array([16384, 0, -32768, 0], "<i2").tobytes(), channels=2))
    assert stereo.tolist() == [0.25, -0.5]
    for bad in (wav(pcm, cut=2), wav(pcm, bits=8), b"", b"RIFF", wav(pcm)[:30], b"x" * 60):
        with pytest.raises(ValueError):
            audio.read_pcm16(bad)
