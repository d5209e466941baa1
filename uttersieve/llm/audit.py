r"""Filter interaction audit (operator 12): what each filter removes, in every order.

Five filters look at every whole text: ``A`` few words, ``B`` few distinct words, ``C`` many
capitals, ``D`` signs, ``E`` identical to the text of a smaller ``doc_id``.  What a filter
removes depends on those before it, so the audit needs for every document only which
of the five it fails, as bits, and one count per part and combination of bits.

``A`` to ``D`` are read off the text.  ``E`` is an existential self-join: left-semi on the
text's hash, the exact text and a smaller ``doc_id``.  Its right side is one row per
distinct text with the smallest id (combined in the tasks before the shuffle), and
only rows whose hash occurs under two ids take part, so unique texts are not
shuffled.  Rows of a hash with more than ``HOT_SHARE`` of the table (there are at most
``1 / HOT_SHARE`` such hashes) are dealt over several keys, with a copy of the right
side's row for each.  The ids the join marks are united with the other failure ids and
the bits of an id aggregated.

The audit itself works on one row per part: 32 counts, 120 orders of 5 steps.  The
Shapley column is the sum over all orders of what the filter removes.

Null text: empty.  Null lang is the part ``''``.  A null ``doc_id`` is not smaller than any
and has no smaller one: such rows never fail ``E`` and nobody fails because of them.
Repeated rows count each; they fail ``E`` only if a smaller id has their text.  Rows that
share an id but not the text are judged apart.  A document without labels is neither
good nor toxic; of several labels one 1 suffices.  An empty table gives no rows.  Extra
columns are not looked at.
"""

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps
from uttersieve.llm.registry import documents, query
from uttersieve.session import materialize

FILTERS = "ABCDE"
HOT_SHARE = 1e-4  # of all rows
DEAL_ROWS = 50_000  # rows of one key of a hot hash


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, h, bits`` for every row: filters A to D as bits 1, 2, 4, 8."""
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("_t"),
    )
    for name, column in [
        ("_w", F.array_remove(F.split("_t", r"[\x20\x09-\x0D]+"), "")),
        ("_n", F.size("_w")),
        ("_distinct", F.size(F.array_distinct("_w"))),
        ("_capitals", F.length("_t") - F.length(F.regexp_replace("_t", "[A-Z]+", ""))),
    ]:
        rows = rows.withColumn(name, column)
    failed = [
        F.col("_n") < 200,
        F.col("_distinct").cast("bigint") * 100 < F.col("_n") * 50,
        F.col("_capitals").cast("bigint") * 100 > F.length("_t") * 3,
        F.col("_t").rlike(r"[#$%&*|]"),
    ]
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))
    return rows.select("doc_id", "part", F.xxhash64("_t").alias("h"), bits.cast("int").alias("bits"))


def copies(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``doc_id, part, h`` of the rows whose text some smaller ``doc_id`` has; ``rows``
    is the written :func:`failures` of ``docs``."""
    total = rows.count()
    shared = materialize(
        rows.filter("doc_id is not null").groupBy("h")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
        .filter("least < last").select("h", "n"),
        "shared",
    )
    # at most 1 / HOT_SHARE hashes can have so many rows, whatever the size of the table
    hot = shared.filter(F.col("n") > max(DEAL_ROWS, total * HOT_SHARE)).select(
        "h", F.ceil(F.col("n") / DEAL_ROWS).cast("int").alias("keys")
    )
    texts = docs.filter("doc_id is not null").select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("h", F.xxhash64("text"))
    mine = bitmaps.sieve(texts, bitmaps.build(shared, "h"), F.col("h"))
    mine = mine.join(F.broadcast(hot), "h", "left").withColumn("keys", F.coalesce("keys", F.lit(1)))
    theirs = (
        mine.groupBy("h", "keys", "text").agg(F.min("doc_id").alias("least"))
        .select(
            F.col("h").alias("h2"), F.col("text").alias("text2"), "least",
            F.explode(F.sequence(F.lit(0), F.col("keys") - 1)).alias("key2"),
        )
    )
    key = F.pmod(F.xxhash64("doc_id"), F.col("keys")).cast("int")
    return mine.withColumn("key", key).join(
        theirs.hint("merge"),
        (F.col("h") == F.col("h2")) & (F.col("key") == F.col("key2"))
        & (F.col("text") == F.col("text2")) & (F.col("least") < F.col("doc_id")),
        "left_semi",
    ).select("doc_id", "part", "h")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, bits, n, good, toxic``: documents, good and toxic ones per part and
    combination of failed filters."""
    rows = materialize(failures(docs), "failures")
    marked = copies(docs, rows).select(
        "doc_id", "part", "h", F.lit(1 << FILTERS.index("E")).alias("bits"),
        F.lit(0).cast("bigint").alias("n"),
    )
    # equal rows are one with a count before anything is shuffled by id
    own = rows.groupBy("doc_id", "part", "h", "bits").agg(F.count("*").alias("n"))
    united = own.filter("doc_id is not null").unionByName(marked.distinct())
    known = united.groupBy("doc_id", "part", "h").agg(
        F.bit_or("bits").alias("bits"), F.sum("n").alias("n")
    )
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    known = known.join(marks, F.col("doc_id") == F.col("labelled"), "left")
    known = known.select("part", "bits", "n", "good", "toxic").unionByName(
        own.filter("doc_id is null").select(
            "part", "bits", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic")
        )
    )
    return known.groupBy("part", "bits").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    counts = combinations(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("c")  # 32 at most
    )
    orders = F.lit(["".join(o) for o in permutations(FILTERS)])
    rows = counts.withColumn("filter_order", F.explode(orders))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = f"shiftleft(1, instr('{FILTERS}', substr(filter_order, {{}}, 1)) - 1)"
    rows = rows.withColumn("own", F.expr(bit.format("step"))).withColumn(
        "before",
        F.expr(
            "aggregate(transform(sequence(1, step), i -> if(i < step, "
            + bit.format("i") + ", 0)), 0, (t, b) -> t | b)"
        ),
    )

    def total(value, condition):
        return F.expr(
            f"aggregate(filter(c, x -> {condition}), 0L, (t, x) -> t + x.{value})"
        )

    removed = "x.bits & before = 0 and x.bits & own <> 0"
    # orders of five in which the filter is the first of those a document fails
    share = "if(x.bits & own <> 0, x.n * 120 div bit_count(x.bits), 0L)"
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", "x.bits & (before | own) = 0").alias("kept"),
        total("n", removed).alias("removed"),
        total("n", "x.bits & before <> 0 and x.bits & own <> 0").alias("redundant"),
        total("n", "x.bits = own").alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        F.expr(f"aggregate(c, 0L, (t, x) -> t + {share})").alias("shapley"),
    )


_SQL = r"""
with w as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents),
f as (
  select doc_id, part, t,
         (len(ws) < 200)::int as a,
         (100 * len(list_distinct(ws)) < 50 * len(ws))::int as b,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int as c,
         regexp_matches(t, '[#$%&*|]')::int as d,
         coalesce(min(doc_id) over (partition by t) < doc_id, false)::int as e
  from w),
l as (
  select doc_id as labelled, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
  from labels where doc_id is not null group by all),
m as (
  select part, [a, b, c, d, e] as fails, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from f left join l on doc_id = labelled),
g as (
  select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by all),
letters as (select unnest([1, 2, 3, 4, 5]) as i),
orders as (
  select [v.i, w.i, x.i, y.i, z.i] as o,
         list_aggregate(list_transform([v.i, w.i, x.i, y.i, z.i], lambda k: substr('ABCDE', k, 1)),
                        'string_agg', '') as filter_order
  from letters v, letters w, letters x, letters y, letters z
  where len(list_distinct([v.i, w.i, x.i, y.i, z.i])) = 5),
steps as (
  select filter_order, s.step, o[s.step] as own, o[1:s.step - 1] as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step) s),
r as (
  select part, filter_order, step, own, n, good, toxic, fails[own] = 1 as fails_own,
         len(list_filter(before, lambda k: fails[k] = 1)) > 0 as gone,
         list_sum(fails) as n_fails
  from g, steps),
t as (
  select part, filter_order, step, own,
         coalesce(sum(n) filter (not gone and not fails_own), 0)::bigint as kept,
         coalesce(sum(n) filter (not gone and fails_own), 0)::bigint as removed,
         coalesce(sum(n) filter (gone and fails_own), 0)::bigint as redundant,
         coalesce(sum(n) filter (fails_own and n_fails = 1), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (not gone and fails_own), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (not gone and fails_own), 0)::bigint as toxic_lost
  from r group by all)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost,
       toxic_lost, (sum(removed) over (partition by part, own))::bigint as shapley
from t
"""


@query("op12_filter_audit", _SQL)
def op12(spark, folder):
    """Every order of the five filters over every document."""
    return audit(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
