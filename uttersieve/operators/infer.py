"""Run a pluggable speech model over the rows.

A *factory* takes a model name and returns an object; it is called once per
worker process and model.  Only the payload goes to Python: these are Pandas
UDF columns, so Spark keeps the other columns of the row on its side.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame

from uttersieve.functions.memory import hand_back
from uttersieve.functions.text import _c
from uttersieve.schema import INFERENCE_BATCH

_KEPT = 2  # models a worker process keeps: the English one and the other
_loaded: dict = {}


def _model(factory, name):
    key = (factory.__module__, factory.__qualname__, name)
    if key not in _loaded:
        while len(_loaded) >= _KEPT:
            del _loaded[next(iter(_loaded))]
        _loaded[key] = factory(name)
    return _loaded[key]


def _answers(model, payloads, languages):
    """The model's results; one for each payload, or it has failed."""
    got = list(model(payloads, languages))
    if len(got) != len(payloads):
        raise ValueError(f"{len(got)} results for {len(payloads)} payloads")
    return got


def _run_safely(model, payloads, languages):
    """Results and errors of one batch; on failure row by row, to find the bad one."""
    try:
        return _answers(model, payloads, languages), [None] * len(payloads)
    except Exception:
        texts, errors = [], []
        for payload, lang in zip(payloads, languages):
            try:
                texts.append(_answers(model, [payload], [lang])[0])
                errors.append(None)
            except Exception as e:
                texts.append(None)
                errors.append(str(e) or type(e).__name__)
        return texts, errors


def _infer(factory, batch_size, returns, batches_held):
    """The UDF.  Results leave the process every ``batches_held`` model batches, so that
    it holds no more of them however many rows Spark sends at once."""
    from pyspark.sql.functions import pandas_udf

    rows_held = batch_size * batches_held

    def results(payload, names, languages):
        out = [None] * len(payload)
        errors = [None] * len(payload)
        langs = [x if isinstance(x, str) else None for x in languages]
        # a batch never mixes models
        for name, rows in names.groupby(names, sort=False).indices.items():
            model = _model(factory, name)
            for i in range(0, len(rows), batch_size):
                part = rows[i : i + batch_size]
                got, failed = _run_safely(
                    model, [payload.iloc[j] for j in part], [langs[j] for j in part]
                )
                for j, g, f in zip(part, got, failed):
                    out[j], errors[j] = g, f
        return pd.DataFrame({"result": out, "error": errors})

    def run(batches: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        try:
            for columns in batches:
                for i in range(0, len(columns[0]), rows_held):
                    yield results(*[
                        c.iloc[i : i + rows_held].reset_index(drop=True) for c in columns
                    ])
        finally:
            hand_back()

    run.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]],
        "return": Iterator[pd.DataFrame],
    }
    # a model may be random; the mark also keeps Spark from running it twice
    return pandas_udf(run, f"struct<result: {returns}, error: string>").asNondeterministic()


def transcribe(
    df: DataFrame,
    factory: Callable,
    audio="audio.array",
    model="model_id",
    language="language",
    batch_size=INFERENCE_BATCH,
    segments=False,
) -> DataFrame:
    """Add ``hypothesis`` (or the array ``segments``) and ``error``.

    ``factory(model)`` gives a callable ``(payloads, languages) -> texts`` (or
    lists of texts).  No shuffle: files are laid out by subset, hence by model,
    so a worker seldom changes its model.
    """
    call = _infer(factory, batch_size, "array<string>" if segments else "string", 16)
    name = "segments" if segments else "hypothesis"
    return (
        df.withColumn("_out", call(_c(audio), _c(model), _c(language)))
        .withColumns({name: _c("_out.result"), "error": _c("_out.error")})
        .drop("_out")
    )


def features(
    df: DataFrame, factory: Callable, audio="audio.array", model="model_id", language="language"
) -> DataFrame:
    """Add ``features``, a frames-by-dims matrix, and ``error``."""
    call = _infer(factory, INFERENCE_BATCH, "array<array<float>>", 4)
    return (
        df.withColumn("_out", call(_c(audio), _c(model), _c(language)))
        .withColumns({"features": _c("_out.result"), "error": _c("_out.error")})
        .drop("_out")
    )


def map_rows(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """User function from one Arrow batch (pandas) to another.

    A function over whole subsets is written as one over batches plus a Spark
    aggregate of what it returns, so that no task holds a subset.
    """

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def keep(df: DataFrame, predicate) -> DataFrame:
    """Rows the predicate accepts: a Column, or a Python function of a batch."""
    if isinstance(predicate, Column):
        return df.filter(predicate)
    return map_rows(df, lambda pdf: pdf[predicate(pdf)], df.schema)
