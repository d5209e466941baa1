"""Curation of a stream: score, keep the matches, resume, count, report."""

import time

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from uttersieve.functions.text import language, model_for
from uttersieve.operators.infer import transcribe
from uttersieve.operators.order import not_in_bitmaps, seq_bitmaps
from uttersieve.operators.scoring import accuracy, scored
from uttersieve.session import SETTINGS, materialize, scratch_path
from uttersieve.sources.files import qualified
from uttersieve.sources.tables import numbered
from uttersieve.streaming.epochs import EpochTable, epoch_sums


def score_stream(
    utterances: DataFrame, factory, audio="audio.array", engine="pipeline", spread=None
) -> DataFrame:
    """Transcribe and score; works on a stream and on a table alike.

    ``spread`` deals the rows out to that many tasks first.  It moves the audio,
    so it is for corpora with fewer files than there are workers for the model.
    """
    if spread:
        utterances = utterances.repartition(spread)
    routed = utterances.withColumns(
        {"language": language("subset"), "model_id": model_for("subset", engine)}
    )
    heard = transcribe(routed, factory, audio=audio)
    return scored(heard).drop("language", "model_id")


def observed(rows: DataFrame, name="curation") -> DataFrame:
    """Count rows and matches on the way; :class:`Progress` keeps each batch's numbers."""
    return rows.observe(
        name, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("acc"), F.lit(0)).alias("correct")
    )


class Progress(StreamingQueryListener):
    """Keeps ``(rows, correct)`` of every batch of every stream it hears of.

    A stream keeps its own last hundred batches only, and none of an earlier start.
    This one knows a stream by the id in its checkpoint, which outlives restarts, and
    a batch that runs again counts once.
    """

    def __init__(self, spark, name="curation"):
        self.name, self._seen, self._last = name, {}, {}
        self._spark = spark
        spark.streams.addListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self._last[str(p.id)] = p.batchId
        seen = p.observedMetrics.get(self.name)
        if seen is not None:
            self._seen[(str(p.id), p.batchId)] = (seen["rows"], seen["correct"])

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def of(self, query, patience=10.0) -> list:
        """``(batch, rows, correct)`` of all finished batches, in order.  Events come a
        little later than the batches, so the last one is waited for."""
        key, last = str(query.id), query.lastProgress
        until = time.time() + patience
        while last and self._last.get(key, -1) < last.batchId and time.time() < until:
            time.sleep(0.05)
        return sorted((b, *v) for (k, b), v in self._seen.items() if k == key)

    def close(self):
        self._spark.streams.removeListener(self)


def position(query):
    """The last finished batch and the offsets the query goes on from."""
    last = query.lastProgress
    return None if last is None else (last.batchId, [s.endOffset for s in last.sources])


_STORE = "spark.sql.streaming.stateStore.providerClass"
_IN_HEAP = "HDFSBackedStateStoreProvider"  # Spark's own choice


def _started(writer, spark):
    """Start a query with its state on disk, where the session leaves it to Spark.

    The store in the heap cannot hold a bitmap's state at all.  The query takes the
    session's settings when it starts; a checkpoint keeps the store it began with.
    """
    before = spark.conf.get(_STORE)
    if not before.endswith(_IN_HEAP):
        return writer.start()
    spark.conf.set(_STORE, SETTINGS[_STORE])
    try:
        return writer.start()
    finally:
        spark.conf.set(_STORE, before)


def append_query(rows: DataFrame, path: str, checkpoint: str, partition_by="subset"):
    """Append to a Parquet table exactly once, take all that is there, then stop.

    The file sink's commit log and the checkpoint's offsets make a replayed
    batch count once; the position needs no bookkeeping of ours.
    """
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return _started(writer, rows.sparkSession)


def totals_query(rows: DataFrame, path: str, checkpoint: str, keys=("subset",)):
    """Running totals and accuracy per subset as state: one row per subset, added
    up in every task before the shuffle."""
    rows.sparkSession.dataSource.register(EpochTable)
    return (
        accuracy(rows, keys)
        .writeStream.format("epoch_table")
        .outputMode("complete")
        .option("path", qualified(rows.sparkSession, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def progress(spark, path: str) -> DataFrame:
    """``epoch, rows, correct`` of a totals table: what every batch has added.

    It is read from the table itself, so it is complete whichever processes have run the
    stream, and a batch that ran twice counts once.
    """
    sums = epoch_sums(spark, path, ["total", "correct"])
    before = Window.orderBy("epoch")  # a short row for each batch
    return sums.select(
        "epoch",
        *[
            (F.col(c) - F.coalesce(F.lag(c).over(before), F.lit(0))).alias(n)
            for c, n in (("total", "rows"), ("correct", "correct"))
        ],
    )


_BITS = 32_768  # positions of one bitmap


def _unseen(names, seq):
    """The processor.  Its class is made here, so that Spark sends it by value: the process
    that sets up the state has no package of ours."""

    class Unseen(StatefulProcessor):
        """Lets each position of a bucket pass once; its state is a bit for each."""

        def init(self, handle):
            self.bits = handle.getValueState("bits", "bits binary")

        def handleInputRows(self, key, rows, timerValues):
            held = self.bits.get() if self.bits.exists() else (b"",)
            seen = np.zeros(_BITS // 8, np.uint8)
            seen[: len(held[0])] = np.frombuffer(bytes(held[0]), np.uint8)
            for pdf in rows:
                at = pdf[seq].to_numpy(dtype=np.int64) % _BITS
                new = (seen[at >> 3] >> (at & 7).astype(np.uint8) & 1) == 0
                new &= ~pdf[seq].duplicated().to_numpy()
                np.bitwise_or.at(seen, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
                yield pdf[new].assign(**dict(zip(names, key)))
            last = int(np.flatnonzero(seen)[-1]) + 1 if seen.any() else 0
            self.bits.update((seen[:last].tobytes(),))

        def close(self):
            pass

    return Unseen()


def without_repeated_positions(rows: DataFrame, keys=("subset",), seq="seq") -> DataFrame:
    """Drop rows of a stream whose ``(keys, seq)`` came before, also in an earlier batch.

    State is a bitmap for each run of ``_BITS`` positions of a subset, a bit a row however
    long the ids are.  A hot subset is as many keys as it has runs.  A null ``seq`` is an error.
    """
    bucket = "_bucket"
    dealt = numbered(rows, seq).withColumn(bucket, F.shiftright(seq, _BITS.bit_length() - 1))
    return (
        dealt.groupBy(*keys, bucket)
        .transformWithStateInPandas(
            statefulProcessor=_unseen([*keys, bucket], seq),
            outputStructType=dealt.schema,
            outputMode="Append",
            timeMode="None",
        )
        .drop(bucket)
    )


def without_repeats(rows: DataFrame, on="utt_id") -> DataFrame:
    """Drop rows whose id came before, also in an earlier batch.

    Only the ids are kept as state, spread over the shuffle partitions and, as the
    session is set up, on disk.
    """
    return rows.dropDuplicates([on])


def run_to_end(start, attempts=5, wait=1.0):
    """Start a query and wait for its end; after a failure start it again on the
    same checkpoint, a bounded number of times."""

    def run():
        query = start()
        query.awaitTermination()
        return query

    return run_again(run, attempts, wait)


def run_again(action, attempts=5, wait=1.0):
    """The action's result; after a failure it is tried again, ``attempts`` times in all."""
    for left in range(attempts - 1, -1, -1):
        try:
            return action()
        except Exception:
            if left == 0:
                raise
            time.sleep(wait)


class Done:
    """What a batch run has done: bitmaps of ``(keys, seq)``, only ever added to.

    The log is read once, when the run begins.  Each group then adds a few short rows,
    so what a group reads is its own rows and this index, however long the log grows.
    """

    def __init__(self, done: DataFrame, keys=("subset",), seq="seq"):
        self.keys, self.seq = list(keys), seq
        self._spark, self._path = done.sparkSession, scratch_path(done.sparkSession, "index")
        first = seq_bitmaps(done, self.keys, seq)
        self._schema = first.schema
        first.write.parquet(self._path)

    def add(self, rows: DataFrame):
        """Take up rows that are done now."""
        seq_bitmaps(rows, self.keys, self.seq).write.mode("append").parquet(self._path)

    def without(self, todo: DataFrame) -> DataFrame:
        """The rows of ``todo`` that are not done."""
        index = self._spark.read.schema(self._schema).parquet(self._path)
        merged = index.groupBy(*self.keys, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))
        return not_in_bitmaps(todo, merged, self.keys, self.seq)


def remaining(todo: DataFrame, done: DataFrame, keys=("subset",), seq="seq") -> DataFrame:
    """The rows of ``todo``, a table or a stream, that are not in ``done``.

    Exact whatever order the rows were done in.  Only ``(keys, seq)`` of what is
    done is read, and written down as a table of bitmaps, a bit per row, so that its
    size is known and the audio of ``todo`` need not be shuffled while that is small.
    """
    bitmaps = materialize(seq_bitmaps(done, keys, seq), "done")
    return not_in_bitmaps(todo, bitmaps, keys, seq)
