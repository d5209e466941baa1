r"""Document fingerprints (operator 9), DataFrame functions only: bottom-k sketches.

A text's shingles are its runs of five words (all words, if there are fewer); a
fingerprint is the ``K`` smallest of the distinct 64-bit shingle hashes.  The
smallest of a union are the smallest of the parts' smallest, so fingerprints of
parts merge into the fingerprint of the whole.  Two of them estimate
resemblance and containment, one the number of distinct shingles.

For the next document, rows are dealt into blocks of consecutive ids, about
``BLOCK_ROWS`` each and ``MOST_BLOCKS`` at most; every block also gets the first row of
the block after it, so one window per block sees each row's successor and no
window sees all rows.  Texts are shuffled once.

Null text: empty.  No words: an empty fingerprint, like another empty one (1.0)
and like nothing else (0.0).  Null ids come first.  Repeated ids order by the
hash of their text.  A single document's next one is itself.  Extra columns are not
looked at.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uttersieve.llm.registry import documents, query

K, SHINGLE = 64, 5
BLOCK_ROWS, MOST_BLOCKS = 1024, 100_000
_LEAST = -(2**63)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, shingle: int = SHINGLE):
    """Add ``name``, the sorted ``k`` smallest distinct shingle hashes of ``text``."""
    none = F.array().cast("array<bigint>")
    words = F.transform(
        F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), ""), lambda w: F.xxhash64(w)
    )
    runs = F.expr(
        f"transform(sequence(1, size(_words) - {shingle - 1}), "
        f"i -> xxhash64(slice(_words, i, {shingle})))"
    )
    shingles = (
        F.when(F.size("_words") >= shingle, runs)
        .when(F.size("_words") > 0, F.array(F.xxhash64("_words")))
        .otherwise(none)
    )
    return (
        df.withColumn("_words", words)
        .withColumn("_shingles", shingles)
        .withColumn(name, F.slice(F.sort_array(F.array_distinct("_shingles")), 1, k))
        .drop("_words", "_shingles")
    )


def distinct_shingles(sketch, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    s = F.col(sketch) if isinstance(sketch, str) else sketch
    share = (F.element_at(s, -1).cast("double") - float(_LEAST)) / 2.0**64
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def _parts(a, b, k):
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    return a, b, union


def resemblance(a, b, k: int = K) -> Column:
    """Estimated share of common shingles among all; 1.0 for two empty texts."""
    a, b, union = _parts(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def containment(a, b, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; null for an empty ``a``."""
    a, b, union = _parts(a, b, k)
    common = resemblance(a, b, k) * distinct_shingles(union, k)
    return F.when(F.size(a) > 0, F.least(common / distinct_shingles(a, k), F.lit(1.0)))


def merge(parts: DataFrame, keys, sketch: str, k: int = K) -> DataFrame:
    """The sketch of the whole from sketches of its parts, per key.

    A key with most of the parts is cut down in every task before the shuffle: the
    window keeps ``k`` values per key on both sides of it.
    """
    keys = list(keys)
    values = parts.select(*keys, F.explode(sketch).alias("_v")).distinct()
    least = Window.partitionBy(*keys).orderBy("_v")
    kept = values.withColumn("_r", F.row_number().over(least)).filter(F.col("_r") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias(sketch))


def as_text(sketch) -> Column:
    """16 hex digits per value, smallest first."""
    return F.lower(
        F.array_join(F.transform(F.col(sketch), lambda v: F.lpad(F.hex(v), 16, "0")), "")
    )


def from_text(text) -> Column:
    """The values of :func:`as_text`."""
    t = F.col(text) if isinstance(text, str) else text
    digits = F.filter(F.split(t, "(?<=\\G.{16})"), lambda x: x != "")
    return F.transform(
        digits,
        lambda x: F.shiftleft(F.conv(F.substring(x, 1, 8), 16, 10).cast("bigint"), 32).bitwiseOR(
            F.conv(F.substring(x, 9, 8), 16, 10).cast("bigint")
        ),
    )


def with_next(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id, text, next_text, _block, _key, _tie``: every row and its successor's text."""
    rows = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("doc_id", F.lit(_LEAST)).alias("_key"),
    )
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high = low or 0, high or 0
    blocks = min(max(n // block_rows, 1), MOST_BLOCKS)
    width = max((high - low + 1) / blocks, 1.0)
    block = F.floor((F.col("_key").cast("double") - float(low)) / width)
    rows = rows.withColumn("_block", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(block))
    # the first row of each block is also a guest of the block before it
    firsts = rows.groupBy("_block").agg(F.min("_key").alias("_first"))
    order = Window.orderBy("_block")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hosts = firsts.select(
        "_first", F.coalesce(F.lag("_block").over(order), F.max("_block").over(whole)).alias("_to")
    )
    guests = (
        rows.join(F.broadcast(hosts), F.col("_key") == F.col("_first"))
        .withColumn("_block", F.col("_to"))
        .drop("_first", "_to")
    )
    both = (
        rows.withColumn("_guest", F.lit(False))
        .unionByName(guests.withColumn("_guest", F.lit(True)))
        .withColumn("_tie", F.xxhash64("text"))
    )
    w = Window.partitionBy("_block").orderBy("_guest", "_key", "_tie")
    return both.withColumn("next_text", F.lead("text").over(w))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """The fingerprint of every text, of its edited text, and their likeness.

    The edited text ends in the start of the next document's: the last quarter of
    its characters is replaced.
    """
    w = Window.partitionBy("_block").orderBy("_guest", "_key", "_tie")
    rows = with_sketch(with_next(docs), "text", "_own", k)
    rows = rows.withColumn("_next", F.lead("_own").over(w)).filter(~F.col("_guest"))
    n = F.length("text")
    # beyond the whole next text its last characters are simply missing
    edited = F.concat(
        F.expr("substring(text, 1, int(length(text) - length(text) div 4))"),
        F.expr("substring(next_text, 1, int(length(text) div 4))"),
    )
    rows = rows.withColumn("n_chars", n.cast("bigint")).withColumn("_edited", edited)
    rows = with_sketch(rows, "_edited", "_changed", k)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        as_text("_own").alias("fingerprint"),
        as_text("_changed").alias("edited_fingerprint"),
        resemblance("_own", "_changed", k).alias("near_edited"),
        resemblance("_own", "_next", k).alias("near_next"),
        distinct_shingles("_own", k).alias("n_shingles_estimate"),
    )


@query("op9_bottom_k")
def op9(spark, folder):
    """Fingerprints of every document and of its edited text."""
    return fingerprints(documents(spark, folder))
