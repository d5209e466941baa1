"""Text columns: normalising, languages, names, sentences."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from uttersieve.schema import LANGUAGES, MODELS, NOISE_WORDS, WHITESPACE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col) -> Column:
    """Python ``str.strip``: Unicode white space, not only blanks."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def normalize(col) -> Column:
    """Strip, lower-case, then delete ASCII punctuation, in this order.

    The order matters: a mark deleted at either end can leave a blank behind,
    which stays.  So this is not idempotent; apply it once per side.
    """
    return without_punctuation(F.lower(strip(col)))


def without_punctuation(col) -> Column:
    r"""Delete the ASCII punctuation marks: ``\p{Punct}`` is these 32 marks, and
    as one regular expression it is twice as fast as ``translate``."""
    return F.regexp_replace(_c(col), r"\p{Punct}", "")


def is_noise(col) -> Column:
    """True where the whole text is one of the noise words; a null text is not one."""
    return F.coalesce(F.lower(strip(col)).isin(*NOISE_WORDS), F.lit(False))


def language(subset, aliases=None) -> Column:
    """Language code of a subset name, null where no model speaks it.

    Only two characters are looked at, so three-letter codes never match.
    ``aliases`` maps old prefixes to supported codes, e.g. ``{"iw": "he"}``.
    """
    prefix = F.substring(_c(subset), 1, 2)
    for old, new in (aliases or {}).items():
        prefix = F.when(prefix == old, F.lit(new)).otherwise(prefix)
    return F.when(prefix.isin(*LANGUAGES), prefix)


def model_for(subset, engine="pipeline") -> Column:
    """Model name for a subset: the distilled one for English, else the large one."""
    english, other = MODELS[engine]
    return F.when(F.substring(_c(subset), 1, 2) == "en", F.lit(english)).otherwise(
        F.lit(other)
    )


def folder_name(index) -> Column:
    """Folder number with eight digits."""
    return F.format_string("%08d", _c(index))


def transcript_line(utt_id, text) -> Column:
    """``"{utt_id} {text}"``."""
    return F.concat(_c(utt_id), F.lit(" "), _c(text))


def word_count(col) -> Column:
    """Words between blanks; an empty text has none."""
    trimmed = strip(col)
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"\s+")))


def sentences(col) -> Column:
    """Array of sentences: cut after ``.``, ``!`` or ``?`` followed by white space."""
    return F.split(_c(col), r"(?<=[.!?])\s+")


def tokens(col) -> Column:
    """Array of lower-case words without punctuation."""
    return F.filter(
        F.split(without_punctuation(F.lower(_c(col))), r"\s+"),
        lambda w: w != "",
    )
