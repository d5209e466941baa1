"""Compare reference texts with hypotheses."""

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttersieve.functions.numbers import percent_text, round2
from uttersieve.functions.text import _c, normalize
from uttersieve.operators.order import BLOCK_ROWS, positions, running_sums


def pair(utterances: DataFrame, hypotheses: DataFrame, on="utt_id") -> DataFrame:
    """Each utterance with its hypothesis; failed ones keep a null hypothesis.

    Select only ids and texts before: the audio must not travel through a join.
    Both sides have a row per utterance, so neither is ever worth a broadcast:
    the merge join spreads them by id and spills.
    """
    heard = hypotheses.select(on, F.col("text").alias("hypothesis"), "error")
    return utterances.join(heard.hint("merge"), on, "left")


def matched_flag(reference="text", hypothesis="hypothesis") -> Column:
    """1 where the normalised texts are equal, else 0."""
    same = normalize(reference) == normalize(hypothesis)
    return F.coalesce(same.cast("int"), F.lit(0))


def scored(pairs: DataFrame, count_errors=True, normalized=False) -> DataFrame:
    """Add the 0/1 column ``acc``; ``count_errors=False`` drops failed rows.

    ``normalized=True`` takes the hypothesis as it is (segments that were
    normalised one by one must not be normalised again).
    """
    flag = (
        F.coalesce((normalize("text") == F.col("hypothesis")).cast("int"), F.lit(0))
        if normalized
        else matched_flag()
    )
    rows = pairs.withColumn("acc", flag)
    return rows if count_errors else rows.filter(F.col("error").isNull())


def matched_rows(rows: DataFrame, with_texts=False, extra=()) -> DataFrame:
    """Only the matches: ``id, utt_id, text``, or both texts for the older shape."""
    hits = rows.filter("acc = 1")
    if with_texts:
        return hits.select(
            "id",
            "utt_id",
            F.col("text").alias("expected"),
            normalize("hypothesis").alias("transcribed"),
            *extra,
        )
    return hits.select("id", "utt_id", "text", *extra)


def result_rows(rows: DataFrame, extra=()) -> DataFrame:
    """All rows with both texts and the flag."""
    return rows.select(
        "id", F.col("text").alias("exptext"), F.col("hypothesis").alias("tratext"), "acc", *extra
    )


def accuracy(rows: DataFrame, keys=("subset",)) -> DataFrame:
    """Total, matches and accuracy per key; accuracy is null without rows."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("acc"), F.lit(0)).alias("correct")
    ).withColumn(
        "accuracy", F.when(F.col("total") > 0, F.col("correct") / F.col("total"))
    )


def summary(per_subset: DataFrame) -> DataFrame:
    """Add the result name ``subset_correct_total_accuracy`` and the percent text."""
    return per_subset.withColumns(
        {
            "name": F.concat_ws(
                "_", "subset", "correct", "total", round2("accuracy").cast("string")
            ),
            "percent": percent_text("accuracy"),
        }
    )


def running_accuracy(
    rows: DataFrame, keys=("subset",), seq="seq", block_rows=BLOCK_ROWS
) -> DataFrame:
    """Iteration number, matches so far and accuracy so far, after every row."""
    return running_sums(
        rows,
        keys,
        seq,
        {"iteration": F.lit(1), "correct": F.col("acc")},
        block_rows=block_rows,
    ).withColumn("accuracy", F.col("correct") / F.col("iteration"))


def matched_ids(
    rows: DataFrame, id_col="utt_id", keys=("subset",), seq="seq", block_rows=BLOCK_ROWS
) -> DataFrame:
    """The ids of the matches in order, as rows with their place in the list."""
    hits = rows.filter("acc = 1").select(*keys, seq, id_col)
    return positions(hits, keys, seq, block_rows=block_rows)


def assemble(segments: DataFrame, mode="last", on="utt_id") -> DataFrame:
    """One hypothesis per utterance from its ordered segments.

    ``last`` keeps only the last segment, ``join_raw`` joins them with blanks,
    ``join_normalized`` normalises each segment first.  ``last`` is reduced
    before the shuffle; a join gathers what becomes one text anyway.
    """
    if mode == "last":
        text = F.max_by("text", "seg_idx")
    else:
        piece = F.col("text") if mode == "join_raw" else normalize("text")
        text = F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("seg_idx", piece.alias("piece")))),
                lambda s: s["piece"],
            ),
            " ",
        )
    return segments.groupBy(on).agg(text.alias("text"))


def assemble_array(segments, mode="last") -> Column:
    """The same for segments that sit in one array column: no shuffle at all."""
    s = _c(segments)
    if mode == "last":
        return F.try_element_at(s, F.lit(-1))
    if mode == "join_raw":
        return F.array_join(s, " ")
    return F.array_join(F.transform(s, normalize), " ")


@F.pandas_udf(T.DoubleType())
def _ratio(expected: pd.Series, transcribed: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if a is None or b is None else SequenceMatcher(None, a, b).ratio()
            for a, b in zip(expected, transcribed)
        ],
        dtype="float64",
    )


def agreement(pairs: DataFrame) -> DataFrame:
    """Add ``ratio``, the similarity of the whole normalised texts in the order
    (expected, transcribed).

    Equal texts are 1.0 without leaving the JVM; only the rest reaches Python.
    A failed row has a null ratio.  The work grows faster than the text; pairs
    come from a join by id, which deals long ones out at random.
    """
    texts = pairs.withColumns(
        {"_a": normalize("text"), "_b": normalize("hypothesis")}
    )
    differs = F.col("_a") != F.col("_b")
    return (
        texts.withColumn(
            "_r", _ratio(F.when(differs, F.col("_a")), F.when(differs, F.col("_b")))
        )
        .withColumn("ratio", F.when(F.col("_a") == F.col("_b"), 1.0).otherwise(F.col("_r")))
        .drop("_a", "_b", "_r")
    )


def agreement_report(rows: DataFrame, keys=("subset",), bins=10) -> DataFrame:
    """Pairs and mean ratio per key and histogram bin of the ratio."""
    return (
        rows.filter("ratio is not null")
        .withColumn("bin", F.least(F.floor(F.col("ratio") * bins), F.lit(bins - 1)))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("pairs"), F.avg("ratio").alias("mean_ratio"))
    )
