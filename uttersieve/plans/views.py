"""The engine's input tables, derived from the given Parquet tables.

Each view has its SQL twin in ``SQL``, used to check results in another engine.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttersieve.schema import PUNCTUATION, WHITESPACE

AS_OF = "2001-08-02T00:00:00Z"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utt(spark, folder, docs=None) -> DataFrame:
    """Utterances: ``subset, seq, id, utt_id, text``; documents are dense from 0."""
    d = table(spark, folder, "documents") if docs is None else docs
    return d.select(
        F.concat("lang", F.lpad(F.substring("source", 4, 100), 3, "0")).alias("subset"),
        F.col("doc_id").alias("seq"),
        F.col("doc_id").cast("string").alias("id"),
        utt_id(),
        "text",
    )


def utt_id(doc_id="doc_id"):
    return F.concat(F.lit("doc-"), F.lpad(F.col(doc_id).cast("string"), 8, "0")).alias("utt_id")


def hyp(spark, folder) -> DataFrame:
    """Hypotheses of five kinds: quoted, padded, first character lost, failed,
    without punctuation."""
    kind = F.col("doc_id") % 5
    text = F.col("text")
    said = (
        F.when(kind == 0, F.concat(F.lit('"'), text, F.lit('!"')))
        .when(kind == 1, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(kind == 2, F.expr("substring(text, 2)"))
        .when(kind == 3, F.lit(None).cast("string"))
        .otherwise(F.translate(text, PUNCTUATION, ""))
    )
    return table(spark, folder, "documents").select(
        utt_id(), said.alias("text"), F.when(kind == 3, F.lit("timeout")).alias("error")
    )


def spoken(spark, folder, docs=None) -> DataFrame:
    """Utterances with the payload of the stand-in speech model."""
    u = utt(spark, folder, docs)
    return u.withColumn("spoken", F.concat((F.col("seq") % 5).cast("string"), F.lit(":"), "text"))


def seg(spark, folder) -> DataFrame:
    """One row per line of a document."""
    return table(spark, folder, "documents").select(
        utt_id(), F.posexplode(F.split("text", "\n")).alias("seg_idx", "text")
    )


def clips(spark, folder) -> DataFrame:
    """64 samples at 16 samples a second."""
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.concat(F.lit("c"), F.lpad(F.col("label").cast("string"), 4, "0")).alias("subset"),
        F.col("embedding").alias("samples"),
        F.lit(16).alias("rate"),
    )


def channels(spark, folder) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("channel_id"),
        F.col("c_name").alias("title"),
        F.lit(None).cast("string").alias("email"),
        F.col("c_mktsegment").alias("category"),
        F.col("c_nationkey").alias("country"),
        F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 20).cast("bigint").alias("subs"),
    )


def videos(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("channel_id"),
        F.col("o_orderkey").alias("video_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        F.col("o_totalprice").alias("views"),
    )


def points(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.col("value").alias("x"))


def pages(spark, folder) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", "url", "html")


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PUNCT_SQL = _q(PUNCTUATION)


def norm_sql(col: str) -> str:
    return f"translate(lower(trim({col}, {_q(WHITESPACE)})), {PUNCT_SQL}, '')"


_ID = "'doc-' || lpad(cast(doc_id as varchar), 8, '0')"

SQL = {
    "utt": f"""select lang || lpad(substr(source, 4), 3, '0') as subset, doc_id as seq,
        cast(doc_id as varchar) as id, {_ID} as utt_id, text from documents""",
    "hyp": f"""select {_ID} as utt_id,
        case doc_id % 5 when 0 then '"' || text || '!"' when 1 then '  ' || text || ' '
            when 2 then substr(text, 2) when 3 then null
            else translate(text, {PUNCT_SQL}, '') end as hypothesis,
        case when doc_id % 5 = 3 then 'timeout' end as error from documents""",
    "rows": f"""select u.subset, u.seq, u.id, u.utt_id, u.text, h.hypothesis, h.error,
        coalesce(cast({norm_sql('u.text')} = {norm_sql('h.hypothesis')} as integer), 0) as acc
        from utt u left join hyp h using (utt_id)""",
    "seg": f"""select {_ID} as utt_id,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 as seg_idx,
        unnest(string_split(text, chr(10))) as text from documents""",
    "clips": """select vec_id, 'c' || lpad(cast(label as varchar), 4, '0') as subset,
        embedding as samples, 16 as rate from embeddings""",
    "channels": """select c_custkey as channel_id, c_name as title, c_mktsegment as category,
        c_nationkey as country,
        cast(floor(greatest(c_acctbal, 0) * 20) as bigint) as subs from customer""",
    "videos": """select o_custkey as channel_id, o_orderkey as video_id,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as published_at,
        o_totalprice as views from orders""",
    "points": "select event_id, value as x from events",
}


def with_views(*names: str, body: str, recursive=False) -> str:
    """A SQL query over some of the views."""
    needed = []
    for name in names:
        for n in ("utt", "hyp", "rows") if name == "rows" else (name,):
            if n not in needed:
                needed.append(n)
    views = ", ".join(f"{n} as ({SQL[n]})" for n in needed)
    return f"with {'recursive ' if recursive else ''}{views} {body}"
