"""Packing without crossing (operator 2): binary lengths.

A document of ``n`` tokens (its ids and the end id) is cut into pieces whose
lengths are powers of two: whole ``4096``s first, then the binary digits of what
is left, large to small.  Pieces of one length form a bucket; every piece is a
sequence of its own, so none crosses documents and none is padded.  A trainer
draws batches from one bucket at a time; sequence ids are dense and run through
the buckets from long to short, so a bucket is one range of ids.

Tokenizing is the cost, so it is done once: the pieces (numbers only, no text) are
written down, and numbered in blocks afterwards.  Words are tokenized once per
task and joined as bytes; white space always separates words for this vocabulary.

Null and empty texts are one piece, the end id.  Repeated rows are packed like
others.  Pieces order by ``doc_id`` (nulls first) within their block.  Extra columns
are not looked at.
"""

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uttersieve.llm import kernels
from uttersieve.llm.registry import documents, query
from uttersieve.session import materialize, small_batches

MOST = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
_CACHED_WORDS, _CACHED_UNITS = 300_000, 200_000  # entries, then the cache starts anew
BLOCK_ROWS = 100_000
GROUP = 1000  # blocks whose counts come together in a window
# letters that are their own composed form and have a one-letter lower case
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]*)([^\\s\\w'<|̀-\U0010ffff]*)")
# Python splits at four separators that the vocabulary's pattern takes for marks
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile("[^\\S\x1c-\x1f]+")


class _Words(dict):
    """``word -> its ids as little-endian bytes``, filled when asked."""

    def __init__(self, path):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.units: dict = {}
        # the byte-level alphabet: printable bytes stand for themselves
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(own)]
        shown = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.shown = str.maketrans({chr(b): c for b, c in shown.items()})

    def _unit(self, text):
        got = self.units.get(text)
        if got is None:
            mapped = text if text.isascii() else text.encode().decode("latin-1").translate(self.shown)
            ids = [t.id for t in self.tokenizer.model.tokenize(mapped)]
            got = self.units[text] = np.array(ids, "<u4").tobytes()
        return got

    def __missing__(self, word):
        plain = _PLAIN.fullmatch(word)
        if plain:
            letters, marks = plain.groups()
            got = (self._unit(letters.lower()) if letters else b"") + (
                self._unit(marks) if marks else b""
            )
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            got = np.array(ids, "<u4").tobytes()
        self[word] = got
        return got

    def trim(self):
        if len(self) > _CACHED_WORDS:
            self.clear()
        if len(self.units) > _CACHED_UNITS:
            self.units.clear()


_loaded = kernels.kept("words")


def token_bytes(texts, path):
    """Ids of each text as little-endian unsigned 32-bit bytes, the end id not included."""
    if path not in _loaded:
        _loaded[path] = _Words(path)
    words = _loaded[path]
    for text in texts:
        if not text:
            yield b""
            continue
        parts = _BLANKS.split(text) if _SEPARATORS.search(text) else text.split()
        yield b"".join(map(words.__getitem__, filter(None, parts)))
        words.trim()


def binary_lengths(n: int, most: int = MOST) -> list:
    """Powers of two, none above ``most``, that add up to ``n``, large to small."""
    return [most] * (n // most) + [
        1 << k for k in range(most.bit_length() - 2, -1, -1) if (n % most) >> k & 1
    ]


def pieces(docs: DataFrame, path: str, end_id: int = END_ID, most: int = MOST, with_ids=False):
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``) per piece."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = {n: [] for n in ("row", "start", "length", "crc", "tokens", "ids")}
                for i, body in enumerate(token_bytes(part.column(1).to_pylist(), path)):
                    body += end
                    n, start = len(body) // 4, 0
                    for length in binary_lengths(n, most):
                        piece = body[4 * start : 4 * (start + length)]
                        rows["row"].append(i)
                        rows["start"].append(start)
                        rows["length"].append(length)
                        rows["crc"].append(zlib.crc32(piece))
                        rows["tokens"].append(n)
                        if with_ids:
                            rows["ids"].append(np.frombuffer(piece, "<i4"))
                        start += length
                columns = [part.column(0).take(pa.array(rows["row"], pa.int64()))] + [
                    pa.array(rows[n], pa.int64()) for n in ("start", "length", "crc", "tokens")
                ]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(rows["ids"], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        kernels.lean(run, "words"), schema + (", ids array<int>" if with_ids else "")
    )


def pack(docs: DataFrame, path: str, end_id=END_ID, most=MOST, with_ids=False, block_rows=BLOCK_ROWS):
    """Add ``sequence_id`` and ``offset`` to the pieces.

    A bucket is numbered in blocks dealt by a hash of document and place, so a
    bucket with most of the pieces is many blocks.  Their counts are summed up in two levels: a
    window holds the blocks of one group, and one more the groups' sums.
    """
    cut = materialize(pieces(docs, path, end_id, most, with_ids), "pieces")
    blocks = cut.count() // block_rows + 1
    cut = cut.withColumn("_block", F.pmod(F.xxhash64("doc_id", "start"), F.lit(blocks)))
    counts = cut.groupBy("length", "_block").agg(F.count("*").alias("_n")).withColumn(
        "_group", F.floor(F.col("_block") / GROUP)
    )
    order, upto = Window.orderBy(F.desc("length"), "_group"), (Window.unboundedPreceding, -1)
    groups = counts.groupBy("length", "_group").agg(F.sum("_n").alias("_n")).select(
        "length", "_group",
        F.coalesce(F.sum("_n").over(order.rowsBetween(*upto)), F.lit(0)).alias("_first"),
    )
    earlier = Window.partitionBy("length", "_group").orderBy("_block").rowsBetween(*upto)
    counts = counts.withColumn("_own", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(
        groups, ["length", "_group"]
    ).select("length", "_block", (F.col("_first") + F.col("_own")).alias("_before"))
    inside = Window.partitionBy("length", "_block").orderBy("doc_id", "start", "ids_crc32")
    return (
        cut.withColumn("_at", F.row_number().over(inside))
        .join(counts, ["length", "_block"])
        .withColumn("sequence_id", F.col("_before") + F.col("_at") - 1)
        .withColumn("offset", F.lit(0).cast("bigint"))
        .select(*[c for c in cut.columns if c != "_block"], "sequence_id", "offset")
    )


def vocabulary(name: str = VOCABULARY) -> str:
    """Where the public vocabulary lies; each machine has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_power_packing")
def op2(spark, folder):
    """Every piece of every document with its place."""
    return pack(documents(spark, folder), vocabulary())
