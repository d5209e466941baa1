r"""Quality rules by host (operator 6), DataFrame functions only.

Every text is measured and held against four rules: ``short`` (under 20 words),
``repeat`` (over 30 % of the words in 8-word windows that occur twice), ``symbols``
(over one of ``[#*$%&|<>]`` in ten words) and ``capitals`` (over half of the word
characters A-Z).  ``short`` and ``repeat`` are the base and always decide alone.

Failures are counted per host and rule, and each rate is shrunk towards the corpus
by a beta prior that the hosts themselves give: its mean is the pooled rate, its
strength comes from how far the hosts' rates differ (method of moments, weighted
by documents).  A host with few documents thus needs more than bad luck.

* a host whose shrunk rate of a rule is at least ``BAD_RATE`` is bad: all its documents go
* a host whose shrunk rate is at most ``TRUSTED_RATE`` is trusted with that rule: a
  single document that fails it stays
* elsewhere a document that fails ``symbols`` or ``capitals`` goes

The measures are written down once (numbers, no texts); counting and joining
back read those.  Hosts are aggregated on the map side, so one host with a third
of all rows is a few rows in the shuffle.  Joining back moves numbers only.

Null text: no words, so ``short`` fails.  A null host is one host.  Repeated rows
count and are judged each.  An empty table gives no rows.  Extra columns are not
looked at.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps
from uttersieve.llm.registry import documents, query
from uttersieve.session import materialize

MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
BAD_RATE, TRUSTED_RATE = 0.5, 0.002
RULES = ("short", "repeat", "symbols", "capitals")


def repeat_words(words: str, window: int = WINDOW):
    """Staged columns that end in ``n_repeat_words`` for the word array ``words``.

    A window is a hash of its words.  Texts without an equal pair, i.e. nearly
    all, stop at the count of distinct hashes; the others sort ``(hash, place)``
    and add up what the windows with an equal neighbour cover.
    """
    none = F.array().cast("array<bigint>")
    n = F.size(words)
    spans = F.expr(
        f"transform(sequence(1, size({words}) - {window - 1}), i -> xxhash64(slice(_h, i, {window})))"
    )
    return [
        ("_h", F.transform(words, lambda w: F.xxhash64(w))),
        ("_w", F.when((n >= window) & (F.size("_h") > 0), spans).otherwise(none)),
        ("_s", F.when(
            F.size(F.array_distinct("_w")) < F.size("_w"),
            F.array_sort(F.expr("transform(_w, (h, i) -> struct(h as h, i as i))")),
        )),
        ("_p", F.when(
            F.size("_s") > 0,
            F.expr(
                "array_sort(transform(filter(sequence(0, size(_s) - 1), j -> "
                "coalesce(get(_s, j).h = get(_s, j - 1).h, false) or "
                "coalesce(get(_s, j).h = get(_s, j + 1).h, false)), j -> get(_s, j).i))"
            ),
        )),
        ("n_repeat_words", F.when(
            F.size("_p") > 0,
            F.expr(
                "aggregate(sequence(0, size(_p) - 1), 0L, (n, j) -> n + "
                f"least({window}, coalesce(get(_p, j + 1) - get(_p, j), {window})))"
            ),
        ).otherwise(F.lit(0)).cast("bigint")),
    ]


def measured(docs: DataFrame, host: str = "source", whole: bool = False) -> DataFrame:
    """``doc_id, host`` and the measures and rule failures of every row; with ``whole``
    the row itself, too, as the struct ``row``."""
    text = F.coalesce("text", F.lit(""))
    more = [F.struct(*docs.columns).alias("row")] if whole else []
    rows = docs.select("doc_id", F.col(host).cast("string").alias("host"), text.alias("_t"), *more)
    blank = r"[\x20\x09-\x0D]+"
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    for name, column in [
        ("_words", F.array_remove(F.split("_t", blank), "")),
        ("_lines", lines),
        ("n_words", F.size("_words").cast("bigint")),
        ("word_chars", F.length(F.regexp_replace("_t", blank, "")).cast("bigint")),
        ("n_symbols", F.length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("bigint")),
        ("n_upper", F.length(F.regexp_replace("_t", r"[^A-Z]+", "")).cast("bigint")),
        ("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")),
        *repeat_words("_words"),
    ]:
        rows = rows.withColumn(name, column)
    return rows.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("n_words") < MIN_WORDS).alias("short"),
        (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT).alias("repeat"),
        (F.col("n_symbols") * 10 > F.col("n_words")).alias("symbols"),
        (F.col("n_upper") * 2 > F.col("word_chars")).alias("capitals"),
        *(["row"] if whole else []),
    )


def host_verdicts(rows: DataFrame, bad=BAD_RATE, trusted=TRUSTED_RATE) -> DataFrame:
    """One row per host: documents, shrunk rate per rule, ``bad_host`` and what it
    is trusted with."""
    counts = rows.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("bigint")).alias(r) for r in RULES]
    )
    n = F.col("n")
    # sums over all hosts: a few numbers
    pooled = counts.agg(
        F.sum("n").alias("n"), F.count("*").alias("hosts"), *[F.sum(r).alias(r) for r in RULES]
    ).first()
    rows_, hosts = max(pooled["n"] or 0, 1), pooled["hosts"]
    mean = {r: (pooled[r] or 0) / rows_ for r in RULES}
    spread = counts.agg(
        *[(F.sum(n * F.pow(F.col(r) / n - mean[r], 2)) / rows_).alias(r) for r in RULES]
    ).first()
    out, shrunk = counts, {}
    for r in RULES:
        m, inside = mean[r], mean[r] * (1 - mean[r])
        # what chance alone does to the rates is not a difference between hosts
        between = max((spread[r] or 0.0) - inside * hosts / rows_, inside * 1e-4)
        strength = max(inside / between - 1, 1.0) if inside > 0 else 1.0
        shrunk[f"{r}_rate"] = (F.col(r) + m * strength) / (n + strength)
    out = out.withColumns(shrunk)
    return out.select(
        "host",
        "n",
        *shrunk,
        F.greatest(*[F.col(c) for c in shrunk]).__ge__(bad).alias("bad_host"),
        *[(F.col(f"{r}_rate") <= trusted).alias(f"trusted_{r}") for r in RULES[2:]],
    )


def _verdicts(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rows`` with ``base_failed`` and ``kept`` in the place of the rules."""
    hosts = hosts.withColumnRenamed("host", "_host")
    judged = rows.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left")
    soft = F.lit(False)
    for r in RULES[2:]:
        soft = soft | (F.col(r) & ~F.col(f"trusted_{r}"))
    base = F.col("short") | F.col("repeat")
    return judged.select(
        *[c for c in rows.columns if c not in RULES],
        base.alias("base_failed"),
        (~base & ~F.col("bad_host") & ~soft).alias("kept"),
    )


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row."""
    rows = materialize(measured(docs, host), "measures")
    return _verdicts(rows, host_verdicts(rows))


_SQL = r"""
with w as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents),
win as (
  select r, i, list_slice(ws, i, i + 7) as win
  from (select r, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) >= 8)),
twice as (select r, i from win qualify count(*) over (partition by r, win) > 1),
cover as (
  select r, sum(least(8, coalesce(next - i, 8))) as n_repeat_words
  from (select r, i, lead(i) over (partition by r order by i) as next from twice) group by r),
lines as (
  select r, count(*) - count(distinct line) as n_dup_lines
  from (select r, unnest(string_split(t, chr(10))) as line from w)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (
  select r, doc_id, source, len(ws) as n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
         coalesce(n_dup_lines, 0) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from w left join lines using (r) left join cover using (r)),
f as (
  select *, n_words < 20 as short, 100 * n_repeat_words > 30 * n_words as repeat,
         10 * n_symbols > n_words as symbols, 2 * n_upper > word_chars as capitals
  from m),
long as (
  select source, u.rule, u.failed
  from f, lateral (values ('short', short), ('repeat', repeat), ('symbols', symbols),
                          ('capitals', capitals)) u(rule, failed)),
h as (select source, rule, count(*) as n, sum(failed::int) as bad from long group by all),
p as (select rule, sum(bad) / sum(n) as m, count(*) as hosts, sum(n) as total from h group by rule),
v as (
  select rule, m, hosts, total, sum(n * (bad / n - m) ** 2) / sum(n) as v
  from h join p using (rule) group by all),
k as (
  select *, case when m * (1 - m) > 0 then greatest(m * (1 - m) /
           greatest(v - m * (1 - m) * hosts / total, m * (1 - m) * 1e-4) - 1, 1.0)
           else 1.0 end as strength from v),
rates as (
  select source, rule, (bad + m * strength) / (n + strength) as rate from h join k using (rule)),
hosts as (
  select source, max(rate) >= 0.5 as bad_host,
         max(rate) filter (rule = 'symbols') <= 0.002 as trusted_symbols,
         max(rate) filter (rule = 'capitals') <= 0.002 as trusted_capitals
  from rates group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       short or repeat as base_failed,
       not (short or repeat) and not bad_host and not (symbols and not trusted_symbols)
       and not (capitals and not trusted_capitals) as kept
from f join hosts on f.source is not distinct from hosts.source
"""


@query("op6_host_rules", _SQL)
def op6(spark, folder):
    """Measures and verdict of every document."""
    return judge(documents(spark, folder)).drop("host")


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows that pass, unchanged; rows of one ``doc_id`` pass only together."""
    rows = materialize(measured(docs, host), "measures")
    hosts = materialize(host_verdicts(rows), "hosts")
    name = bitmaps.fresh(docs, "rejected")
    rejected = _verdicts(rows.filter("doc_id is not null"), hosts).filter("not kept")
    rejected = materialize(rejected.select(F.col("doc_id").alias(name)).distinct(), "rejected")
    keyed, loose = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
    # rows without an id cannot be looked up, so they are measured again, whole
    loose = _verdicts(measured(loose, host, whole=True), hosts).filter("kept").select("row.*")
    good = keyed.join(rejected, F.col("doc_id") == F.col(name), "left_anti")
    return good.unionByName(loose)
