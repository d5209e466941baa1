"""Queries that transcribe, normalise and score."""

from pyspark.sql import functions as F

from uttersieve.functions.numbers import percent_text, round2
from uttersieve.functions.text import is_noise, language, model_for, normalize
from uttersieve.operators import infer, scoring as ops
from uttersieve.plans import standins, views as v
from uttersieve.plans.catalog import query
from uttersieve.schema import LANGUAGES, MODELS
from uttersieve.session import materialize
from uttersieve.streaming.curation import score_stream


def rows(spark, folder, **options):
    return ops.scored(ops.pair(v.utt(spark, folder), v.hyp(spark, folder)), **options)


def _flags(spark, folder):
    """The scored rows without their texts, written down: the block-wise operators
    read them twice, and the texts should not be compared twice."""
    scored = rows(spark, folder).select("subset", "seq", "utt_id", "acc")
    return materialize(scored, "scored")


_ACCURACY = """select subset, cast(count(*) as bigint) as total,
    cast(sum(acc) as bigint) as correct, sum(acc) / count(*) as accuracy
    from {source} group by subset"""


@query(v.with_views("rows", body=_ACCURACY.format(source="rows")))
def accuracy_by_subset(spark, folder):
    """Total, matches and accuracy of every subset."""
    return ops.accuracy(rows(spark, folder))


@query(
    v.with_views(
        "rows", body=_ACCURACY.format(source="(select * from rows where error is null)")
    )
)
def accuracy_excluding_errors(spark, folder):
    return ops.accuracy(rows(spark, folder, count_errors=False))


@query(v.with_views("rows", body=_ACCURACY.format(source="rows")))
def transcribed_accuracy(spark, folder):
    """The same through the batched model operator."""
    heard = score_stream(v.spoken(spark, folder), standins.SpokenTextModel, audio="spoken")
    return ops.accuracy(heard)


@query(
    v.with_views(
        "rows",
        body="select utt_id, hypothesis, error, acc from rows",
    )
)
def transcribed_rows(spark, folder):
    heard = score_stream(v.spoken(spark, folder), standins.SpokenTextModel, audio="spoken")
    return heard.select("utt_id", "hypothesis", "error", "acc")


@query(f"select doc_id, {v.norm_sql('text')} as normalized from documents")
def normalized_text(spark, folder):
    return v.table(spark, folder, "documents").select(
        "doc_id", normalize("text").alias("normalized")
    )


_LANGS = ", ".join(f"'{x}'" for x in LANGUAGES)
_P, _F = MODELS["pipeline"], MODELS["fast"]


@query(
    v.with_views(
        "utt",
        body=f"""select subset, case when substr(subset, 1, 2) in ({_LANGS})
            then substr(subset, 1, 2) end as language,
            case when substr(subset, 1, 2) = 'en' then '{_P[0]}' else '{_P[1]}' end as model_id,
            case when substr(subset, 1, 2) = 'en' then '{_F[0]}' else '{_F[1]}' end as fast_model
            from (select subset from utt union all
                  select lower(n_name) from nation)""",
    )
)
def language_and_model(spark, folder):
    """Language and model of every row's subset; an unknown prefix has no language."""
    names = v.utt(spark, folder).select("subset").unionByName(
        v.table(spark, folder, "nation").select(F.lower("n_name").alias("subset"))
    )
    return names.select(
        "subset",
        language("subset").alias("language"),
        model_for("subset").alias("model_id"),
        model_for("subset", "fast").alias("fast_model"),
    )


@query(v.with_views("rows", body="select id, utt_id, text from rows where acc = 1"))
def matched_rows(spark, folder):
    return ops.matched_rows(rows(spark, folder))


@query(
    v.with_views(
        "rows",
        body=f"""select id, utt_id, text as expected,
            {v.norm_sql('hypothesis')} as transcribed from rows where acc = 1""",
    )
)
def matched_rows_with_texts(spark, folder):
    return ops.matched_rows(rows(spark, folder), with_texts=True)


@query(
    v.with_views(
        "rows", body="select id, text as exptext, hypothesis as tratext, acc from rows"
    )
)
def result_rows(spark, folder):
    return ops.result_rows(rows(spark, folder))


_HEARD = """case doc_id % 7 when 0 then ' Music ' when 1 then 'NOISE' when 2 then 'sound'
    when 3 then 'Background noise' else text end"""


@query(
    f"""select doc_id, heard from (select doc_id, {_HEARD} as heard from documents)
    where lower(trim(heard)) not in ('music', 'noise', 'sound')"""
)
def noise_filter(spark, folder):
    """Transcripts that are not only a noise word."""
    heard = v.table(spark, folder, "documents").select(
        "doc_id", F.expr(_HEARD).alias("heard")
    )
    return heard.filter(~is_noise("heard"))


@query(
    v.with_views(
        "seg", body="select utt_id, arg_max(text, seg_idx) as text from seg group by utt_id"
    )
)
def segments_last(spark, folder):
    return ops.assemble(v.seg(spark, folder), "last")


@query(
    v.with_views(
        "seg",
        body="""select utt_id, string_agg(text, ' ' order by seg_idx) as text
            from seg group by utt_id""",
    )
)
def segments_join_raw(spark, folder):
    return ops.assemble(v.seg(spark, folder), "join_raw")


@query(
    v.with_views(
        "seg",
        body=f"""select utt_id, string_agg({v.norm_sql('text')}, ' ' order by seg_idx) as text
            from seg group by utt_id""",
    )
)
def segments_join_normalized(spark, folder):
    return ops.assemble(v.seg(spark, folder), "join_normalized")


@query(
    v.with_views(
        "seg",
        body=f"""select utt_id,
            string_agg('  ' || text || ' ', ' ' order by seg_idx) as raw,
            string_agg({v.norm_sql('text')}, ' ' order by seg_idx) as normalized,
            arg_max('  ' || text || ' ', seg_idx) as last from seg group by utt_id""",
    )
)
def segments_from_model(spark, folder):
    """Segments as the model returns them, assembled in the row: no shuffle."""
    said = v.spoken(spark, folder).withColumns(
        {"model_id": model_for("subset"), "language": language("subset")}
    )
    heard = infer.transcribe(said, standins.SpokenLinesModel, audio="spoken", segments=True)
    return heard.select(
        "utt_id",
        ops.assemble_array("segments", "join_raw").alias("raw"),
        ops.assemble_array("segments", "join_normalized").alias("normalized"),
        ops.assemble_array("segments", "last").alias("last"),
    )


@query(
    v.with_views(
        "rows",
        body="""select subset, seq, acc, cast(row_number() over w as bigint) as iteration,
            cast(sum(acc) over w as bigint) as correct,
            sum(acc) over w / row_number() over w as accuracy
            from rows window w as (partition by subset order by seq
                rows between unbounded preceding and current row)""",
    )
)
def running_accuracy(spark, folder):
    return ops.running_accuracy(_flags(spark, folder).drop("utt_id"))


@query(
    v.with_views(
        "rows",
        body="""select subset, utt_id,
            cast(row_number() over (partition by subset order by seq) as bigint) as position
            from rows where acc = 1""",
    )
)
def matched_id_list(spark, folder):
    """The ids of the matches, in order, as rows."""
    return ops.matched_ids(_flags(spark, folder)).drop("seq")


@query()
def agreement_score(spark, folder):
    """Similarity of the whole texts of every pair."""
    scored = ops.agreement(rows(spark, folder))
    return scored.select("id", "acc", "ratio")


@query()
def agreement_histogram(spark, folder):
    return ops.agreement_report(ops.agreement(rows(spark, folder)))


@query(
    v.with_views(
        "rows",
        body="""select *, subset || '_' || correct || '_' || total || '_' ||
                cast(cast(printf('%.2f', accuracy) as double) as varchar) as name,
            cast(printf('%.2f', accuracy) as double) as rounded,
            printf('%.2f%%', accuracy * 100) as percent
            from (select subset, cast(count(*) as bigint) as total,
                cast(sum(acc) as bigint) as correct, sum(acc) / count(*) as accuracy
                from rows group by subset)""",
    )
)
def result_summary(spark, folder):
    """The result name, the rounded accuracy and the percent text."""
    per_subset = ops.summary(ops.accuracy(rows(spark, folder)))
    return per_subset.withColumn("rounded", round2("accuracy"))


@query(
    """select o_orderkey, cast(printf('%.2f', o_totalprice / 7) as double) as rounded,
    printf('%.2f%%', o_totalprice / 100000000 * 100) as percent from
    (select o_orderkey, o_totalprice from orders)"""
)
def rounding(spark, folder):
    """Rounding and percent text on many values."""
    return v.table(spark, folder, "orders").select(
        "o_orderkey",
        round2(F.col("o_totalprice") / 7).alias("rounded"),
        percent_text(F.col("o_totalprice") / 100000000).alias("percent"),
    )
