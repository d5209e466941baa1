"""Declared schemas and fixed values shared by the whole package."""

from pyspark.sql import types as T

AUDIO = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("array", T.ArrayType(T.FloatType())),
        T.StructField("sampling_rate", T.IntegerType()),
    ]
)

# `seq` is the position of an utterance in its subset, written at ingest.  A
# table has no row order of its own, so everything order-dependent uses it.
UTTERANCE = T.StructType(
    [
        T.StructField("subset", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("utt_id", T.StringType()),
        T.StructField("audio", AUDIO),
        T.StructField("text", T.StringType()),
    ]
)

SEGMENT = T.StructType(
    [
        T.StructField("utt_id", T.StringType()),
        T.StructField("seg_idx", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)

CHANNEL_DETAILS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "snippet",
            T.StructType(
                [
                    T.StructField("title", T.StringType()),
                    T.StructField("email", T.StringType()),
                    T.StructField("country", T.StringType()),
                    T.StructField("lang", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "statistics",
            T.StructType([T.StructField("subscriberCount", T.StringType())]),
        ),
    ]
)

VIDEO_ITEM = T.StructType(
    [
        T.StructField("id", T.StructType([T.StructField("videoId", T.StringType())])),
        T.StructField(
            "snippet",
            T.StructType(
                [
                    T.StructField("channelId", T.StringType()),
                    T.StructField("publishedAt", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "statistics", T.StructType([T.StructField("viewCount", T.StringType())])
        ),
    ]
)

# Fixed value: the speech models' supported language codes.
LANGUAGES = (
    "af", "am", "ar", "as", "az", "ba", "be", "bg", "bn", "bo", "br", "bs", "ca", "cs", "cy",
    "da", "de", "el", "en", "es", "et", "eu", "fa", "fi", "fo", "fr", "gl", "gu", "ha", "haw",
    "he", "hi", "hr", "ht", "hu", "hy", "id", "is", "it", "ja", "jw", "ka", "kk", "km", "kn",
    "ko", "la", "lb", "ln", "lo", "lt", "lv", "mg", "mi", "mk", "ml", "mn", "mr", "ms", "mt",
    "my", "ne", "nl", "nn", "no", "oc", "pa", "pl", "ps", "pt", "ro", "ru", "sa", "sd", "si",
    "sk", "sl", "sn", "so", "sq", "sr", "su", "sv", "sw", "ta", "te", "tg", "th", "tk", "tl",
    "tr", "tt", "uk", "ur", "uz", "vi", "yi", "yo", "zh", "yue",
)

# Fixed value: the 32 ASCII punctuation marks.
PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""

# Fixed value: every character Python's str.strip() treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: texts that are only a sound label.
NOISE_WORDS = ("music", "noise", "sound")

# Fixed value: model names by engine, for English and for everything else.
MODELS = {
    "pipeline": ("distil-whisper/distil-large-v3", "openai/whisper-large-v3"),
    "fast": ("distil-large-v3", "large-v3"),
}

# Fixed value: month labels, in calendar order.
MONTHS = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)

# Fixed value: category search terms; "a|b" means either word.
CATEGORIES = ("food|cooking", "beauty", "fitness", "fashion", "tech")

FOLDER_LIMIT = 1 << 30  # bytes of audio in one export folder
CHUNK_ROWS = 200_000  # rows of the match log read at a time
WINDOW_SECONDS = 30  # audio window of the speech models
FRAMES_PER_SECOND = 50  # encoder frames per second of audio
INFERENCE_BATCH = 16
