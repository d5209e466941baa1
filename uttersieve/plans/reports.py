"""Queries over channels and pages."""

from pyspark.sql import functions as F

from uttersieve.functions.times import age_days, parse_utc
from uttersieve.operators import channels as ch, elements as el, pages as pg
from uttersieve.plans import views as v
from uttersieve.plans.catalog import query
from uttersieve.session import scratch_path
from uttersieve.sinks import tables as sinks
from uttersieve.sources import channels as sources


def _as_of():
    return F.to_timestamp(F.lit(v.AS_OF), "yyyy-MM-dd'T'HH:mm:ssX")


@query(
    v.with_views(
        "videos",
        body="""select channel_id, video_id, published_at from videos qualify row_number()
            over (partition by channel_id order by published_at desc, video_id) = 1""",
    )
)
def newest_video(spark, folder):
    return ch.newest_video(v.videos(spark, folder))


@query(
    v.with_views(
        "videos",
        body="""select channel_id, video_id, views from videos qualify row_number()
            over (partition by channel_id order by views desc, video_id) = 1""",
    )
)
def popular_video(spark, folder):
    return ch.popular_video(v.videos(spark, folder))


@query(
    v.with_views(
        "videos",
        body="""select video_id, cast(floor((epoch(timestamp '2001-08-02') -
            epoch(strptime(published_at, '%Y-%m-%dT%H:%M:%SZ'))) / 86400) as bigint) as age
            from videos""",
    )
)
def video_age(spark, folder):
    """Whole days since publication."""
    age = age_days(_as_of(), parse_utc("published_at"))
    return v.videos(spark, folder).select("video_id", age.alias("age"))


_REPORT = """
newest as (select channel_id, published_at from videos qualify row_number()
    over (partition by channel_id order by published_at desc, video_id) = 1),
popular as (select channel_id, video_id from videos qualify row_number()
    over (partition by channel_id order by views desc, video_id) = 1),
report as (select cast(country as varchar) as "Country", title as "Channel Name",
    'N/A' as "E-mail", category as "Genre",
    'https://www.youtube.com/watch?v=' || p.video_id as "Video Link", channel_id
    from channels join newest n using (channel_id) join popular p using (channel_id)
    where subs > 100000 and floor((epoch(timestamp '2001-08-02') -
        epoch(strptime(n.published_at, '%Y-%m-%dT%H:%M:%SZ'))) / 86400) <= 30)"""


def _report(spark, folder):
    return ch.report(v.channels(spark, folder), v.videos(spark, folder), _as_of())


def _report_sql(body):
    return v.with_views("channels", "videos", body="").rstrip() + f", {_REPORT} {body}"


@query(_report_sql("select * from report"))
def channel_report(spark, folder):
    """Active channels with their most-viewed video."""
    return _report(spark, folder)


@query(
    _report_sql(
        """select cast(row_number() over (order by channel_id) - 1 as bigint) as row_no,
        "Channel Name", "Video Link" from report"""
    )
)
def channel_report_file(spark, folder):
    """The report as a tab-separated file with an index column, read back."""
    path = scratch_path(spark, "report")
    sinks.write_tsv(_report(spark, folder), path, "channel_id")
    back = spark.read.option("sep", "\t").option("header", True).option(
        "ignoreLeadingWhiteSpace", True
    ).csv(path)
    return back.select(
        F.col(back.columns[0]).cast("bigint").alias("row_no"),
        F.col("`Channel Name`"),
        F.col("`Video Link`"),
    )


_TERMS = ("building|machinery", "auto", "furniture", "hold")


@query(
    v.with_views(
        "channels",
        body=f"""select channel_id, term as category, cast(rn as bigint) as place from (
            select channel_id, term, row_number() over (partition by term order by channel_id) as rn
            from channels, (values {", ".join(f"('{t}')" for t in _TERMS)}) t(term)
            where regexp_matches(category, '(?i)' || term) and country = 7)
            where rn <= 50""",
    )
)
def channel_search(spark, folder):
    """At most 50 channels of one country per category."""
    channels = v.channels(spark, folder).withColumnRenamed("category", "segment")
    found = ch.search(channels, _TERMS, country=7, column="segment")
    return found.select("channel_id", "category", F.col("rank").cast("bigint").alias("place"))


@query(
    v.with_views(
        "channels",
        body=f"""select channel_id, term as category from channels,
            (values {", ".join(f"('{t}')" for t in _TERMS)}) t(term)
            where regexp_matches(category, '(?i)' || term)""",
    )
)
def channel_categories(spark, folder):
    """Every channel with the categories that find it."""
    channels = v.channels(spark, folder).withColumnRenamed("category", "segment")
    return ch.tag_categories(channels, _TERMS, "segment").select("channel_id", "category")


@query(
    v.with_views(
        "channels",
        "videos",
        body="""select cast(channel_id as varchar) as channel_id, title, 'N/A' as email,
            cast(subs as bigint) as subs, cast(video_id as varchar) as video_id, published_at,
            cast(floor(views) as bigint) as views from channels join videos using (channel_id)""",
    )
)
def nested_records(spark, folder):
    """Nested channel and video records written as JSON, read and flattened."""
    details, items = scratch_path(spark, "details"), scratch_path(spark, "items")
    text = F.col("channel_id").cast("string")
    v.channels(spark, folder).select(
        text.alias("id"),
        F.struct("title", "email", F.col("country").cast("string").alias("country")).alias("snippet"),
        F.struct(F.col("subs").cast("string").alias("subscriberCount")).alias("statistics"),
    ).write.json(details)
    v.videos(spark, folder).select(
        F.struct(F.col("video_id").cast("string").alias("videoId")).alias("id"),
        F.struct(text.alias("channelId"), F.col("published_at").alias("publishedAt")).alias("snippet"),
        F.struct(F.floor("views").cast("string").alias("viewCount")).alias("statistics"),
    ).write.json(items)
    channels = sources.channel_details(spark, details).select(
        "channel_id", "title", F.coalesce("email", F.lit("N/A")).alias("email"), "subs"
    )
    return channels.join(sources.video_items(spark, items), "channel_id")


@query("select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages")
def page_title(spark, folder):
    return v.pages(spark, folder).select("page_id", pg.title_of("html").alias("title"))


_LINKS = """(select page_id, unnest(l) as link, generate_subscripts(l, 1) as ord from
    (select page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) as l from pages))"""


@query(f"select page_id, cast(ord as bigint) as ord, link from {_LINKS}")
def page_links(spark, folder):
    return v.pages(spark, folder).select(
        "page_id", F.posexplode(pg.links_of("html")).alias("i", "link")
    ).select("page_id", (F.col("i") + 1).cast("bigint").alias("ord"), "link")


@query(
    f"""select page_id, regexp_extract(url, '^https?://[^/]+') || link as link
    from {_LINKS} join pages using (page_id) where ord = 1"""
)
def page_first_link(spark, folder):
    """The first link of a page as a full address."""
    first = F.try_element_at(pg.links_of("html"), F.lit(1))
    return v.pages(spark, folder).select(
        "page_id", F.concat(F.regexp_extract("url", "^https?://[^/]+", 0), first).alias("link")
    ).filter("link is not null")


@query(
    """select page_id, array_to_string(regexp_extract_all(html,
    '<div class="ad">([^<]*)</div>', 1), '|') as texts from pages"""
)
def page_class_text(spark, folder):
    return v.pages(spark, folder).select(
        "page_id", F.array_join(pg.class_text("html", "div", "ad"), "|").alias("texts")
    )


RULES = (
    pg.Rule("title", "h1"),
    pg.Rule("link", "a", attr="href", inside=("nav", None)),
    pg.Rule("name", "a", inside=("nav", None)),
    pg.Rule("ad", "div", cls="ad"),
    pg.Rule("paragraph", "p", inside=("article", None)),
)


def _plain(expr):
    """Decode the entities the pages use, also one that is cut off, and strip."""
    for pattern, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("#x27", "''"), ("amp", "&")):
        expr = f"regexp_replace({expr}, '&{pattern};?', '{char}', 'g')"
    return f"trim({expr}, {v._q(v.WHITESPACE)})"


_LONG = f"""
select page_id, 'title' as field, cast(1 as bigint) as ord,
    {_plain("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} as value from pages
union all select page_id, 'link', cast(ord as bigint), replace(link, '&amp;', '&') from {_LINKS}
union all select page_id, 'name', cast(generate_subscripts(l, 1) as bigint), {_plain("unnest(l)")}
    from (select page_id, regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) as l from pages)
union all select page_id, 'ad', cast(1 as bigint),
    {_plain("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")} from pages"""


@query(_LONG)
def page_fields(spark, folder):
    """Fields of every page as rows."""
    rows = pg.long_fields(v.pages(spark, folder), [r for r in RULES if r.field != "paragraph"])
    return rows.withColumn("ord", F.col("ord").cast("bigint"))


@query(
    f"""select page_id, count(*) filter (field = 'link') as links,
    string_agg(value, '|' order by ord) filter (field = 'name') as names,
    max(value) filter (field = 'title') as title from ({_LONG}) group by page_id"""
)
def page_arrays(spark, folder):
    """Repeated fields as arrays, straight from the page."""
    found = v.pages(spark, folder).select("page_id", pg.page_fields("html", RULES).alias("f"))
    return found.select(
        "page_id",
        F.size("f.link").cast("bigint").alias("links"),
        F.array_join("f.name", "|").alias("names"),
        F.element_at("f.title", 1).alias("title"),
    )


_MARKED = """
    <div class="stat box">\n<div> Views </div> since then<!-- c --><span class="v">12.<b>{0}</b>M</span></div>
    <div class="box stat"><DIV>Subscribers</div><p>{0} &lt;thousand><p>more</div><div>Views</div>
    <img class="wide thumbnail-changes-image" src="{1}/a.png?x=1&amp;y=2"><img class="thumb" src="b.png"/>
    <section class="main grid"><div class="card ad wide">out <div class="ad">in{0}</div><img class="thumbnail-changes-image"
    src='{1}/c.png'></div><i class=ad>no</i></section><div class="ad">last</div>"""


def _marked(spark, folder):
    """The pages with statistics, images and nested cards before their articles, parsed."""
    before, *rest = _MARKED.split("{")
    parts = [F.lit(before)]
    for piece in rest:
        parts += [F.col("page_id").cast("string") if piece[0] == "0" else F.col("url"), F.lit(piece[2:])]
    html = F.replace("html", F.lit("<article>"), F.concat(*parts, F.lit("<article>")))
    return v.pages(spark, folder).select("page_id", "url", el.page_elements(html).alias("page"))


@query(
    """select page_id, '12.' || page_id || 'M|' as views, page_id || ' <thousand>more' as subscribers,
    contains(html, '<article>') as has_article from pages"""
)
def page_label_siblings(spark, folder):
    """What follows a label under the same parent, whatever stands between them; a sibling
    without text counts.  The article is the sibling of the last card."""
    rows = _marked(spark, folder)
    after = {
        "views": el.select("page", "div", text="Views"),
        "subscribers": el.select("page", "div", text="Subscribers"),
    }
    last = el.next_siblings("page", el.select("page", "div", "ad", text="last"))
    return rows.select(
        "page_id",
        *[F.array_join(el.texts("page", el.next_siblings("page", e)), "|").alias(n) for n, e in after.items()],
        F.exists(last, lambda e: e["tag"] == "article").alias("has_article"),
    )


@query(
    """select page_id, url || '/a.png?x=1&y=2|' || url || '/c.png' as changes,
    url || '/c.png' as in_section, 'b.png' as thumbs from pages"""
)
def page_image_sources(spark, folder):
    """Addresses of images by one of their classes, on the page and inside a section."""
    changed = ("img", "thumbnail-changes-image")
    found = {
        "changes": el.select("page", *changed),
        "in_section": el.select("page", *changed, inside=("section", ["grid", "main"])),
        "thumbs": el.select("page", "img", "thumb"),
    }
    return _marked(spark, folder).select(
        "page_id",
        *[F.array_join(el.attributes(e, "src"), "|").alias(n) for n, e in found.items()],
    )


@query(
    f"""select page_id, {_plain("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")}
        || '|out in' || page_id || '|in' || page_id || '|last' as ads,
    'out in' || page_id as wide, 'out in' || page_id || '|in' || page_id as in_section,
    'in' || page_id as inside_card, 'stat box|box stat' as boxes from pages"""
)
def page_nested_classes(spark, folder):
    """Texts by tag and class where elements have several classes and lie in each other."""
    found = {
        "ads": el.select("page", "div", "ad"),
        "wide": el.select("page", "div", ["wide", "ad"]),
        "in_section": el.select("page", "div", "ad", inside=("section", "main")),
        "inside_card": el.select("page", "div", "ad", inside=(None, ["card", "wide"])),
    }
    boxes = el.attributes(el.select("page", "div", ["box", "stat"]), "class")
    return _marked(spark, folder).select(
        "page_id",
        *[F.array_join(el.texts("page", e), "|").alias(n) for n, e in found.items()],
        F.array_join(boxes, "|").alias("boxes"),
    )


@query()
def page_paragraphs(spark, folder):
    """Text of every paragraph, unclosed ones and nested marks included."""
    found = v.pages(spark, folder).select("page_id", pg.page_fields("html", RULES).alias("f"))
    return found.select("page_id", F.posexplode("f.paragraph").alias("ord", "text"))


_BLOCKS = f"""(select page_id, ord, trim(replace(replace(regexp_replace(regexp_replace(t,
        '(?s)</(p|article)>.*', ''), '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'),
        {v._q(v.WHITESPACE)}) as text
    from (select page_id, unnest(l) as t, generate_subscripts(l, 1) as ord from
        (select page_id, string_split(html, '<p>')[2:] as l from pages)))"""


def _blocks(spark, folder):
    """Paragraphs of the pages without their marks, entities decoded.  One ends at its
    end mark, at the next paragraph or with the article, so unclosed ones count."""
    found = F.slice(F.split("html", "<p>"), 2, 2**31 - 1)
    plain = F.regexp_replace(F.regexp_replace("text", r"(?s)</(p|article)>.*", ""), "<[^>]*>", "")
    plain = F.replace(F.replace(plain, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))
    return (
        v.pages(spark, folder)
        .select("page_id", F.posexplode(found).alias("i", "text"))
        .select(
            "page_id",
            (F.col("i") + 1).cast("bigint").alias("ord"),
            F.btrim(plain, F.lit(v.WHITESPACE)).alias("text"),
        )
    )


@query(
    rf"""select page_id, cast(ord as bigint) as ord, text from {_BLOCKS}
    where len(regexp_split_to_array(text, '\s+')) >= 10"""
)
def page_blocks(spark, folder):
    """Blocks of at least ten words."""
    return pg.large_blocks(_blocks(spark, folder))


@query(
    r"""select doc_id, generate_subscripts(l, 1) as ord, unnest(l) as sentence from (
    select doc_id, string_split(regexp_replace(text, '([.!?])[ \t\n\v\f\r]+', '\1' || chr(1), 'g'), chr(1)) as l
    from documents)"""
)
def page_sentences(spark, folder):
    """Sentences of every document."""
    docs = v.table(spark, folder, "documents").select("doc_id", "text")
    out = pg.page_sentences(docs)
    return out.withColumn("ord", F.col("ord").cast("bigint"))


_WORDS = rf"list_filter(regexp_split_to_array(translate(lower(text), {v.PUNCT_SQL}, ''), '[ \t\n\v\f\r]+'), lambda w: w != '')"


@query(
    f"""with t as (select doc_id, unnest({_WORDS}) as word from documents),
    n as (select count(*) as n from documents),
    df as (select word, ln((any_value(n) + 1) / (count(distinct doc_id) + 1)) + 1 as idf
        from t, n group by word),
    w as (select doc_id, word, count(*) * any_value(idf) as w, any_value(idf) as idf
        from t join df using (word) group by doc_id, word),
    q as (select sqrt(sum(idf * idf)) as q from df where word in ('the', 'de')),
    s as (select doc_id, round(sum(case when word in ('the', 'de') then w * idf else 0 end)
        / (sqrt(sum(w * w)) * any_value(q)), 6) as score from w, q group by doc_id)
    select doc_id, score from s where score >= 0.1"""
)
def page_relevant(spark, folder):
    """Documents close to the query words."""
    docs = v.table(spark, folder, "documents").select("doc_id", "text")
    return pg.relevant(docs, "the de", "doc_id")


_SIMILAR = r"""(select page_id, unnest(l) as name, generate_subscripts(l, 1) as ord from
    (select page_id, regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) as l from pages))"""


def _page_report(spark, folder):
    found = v.pages(spark, folder).select(
        "page_id", "url", pg.page_fields("html", RULES).alias("f")
    )
    similar = F.transform(
        "f.name",
        lambda n, i: F.struct(
            n.alias("name"), F.concat((i + 1).cast("string"), F.lit("%")).alias("similarity_score")
        ),
    )
    videos = found.withColumns({"similar": similar, "videos": F.col("f.link")})
    return pg.with_list(videos.select("page_id", "similar", "videos"), "similar", "videos")


@query(
    f"""with s as (select page_id, '[' || string_agg('{{"name":"' || name ||
        '","similarity_score":"' || ord || '%"}}', ',' order by ord) || ']' as "similar"
        from {_SIMILAR} group by page_id)
    select page_id, cast(ord - 1 as bigint) as ord, link as value, "similar"
    from {_LINKS} join s using (page_id)"""
)
def page_report(spark, folder):
    """Every video link with the page's whole list of similar channels, written
    as CSV with JSON cells and read back."""
    path = scratch_path(spark, "pagereport")
    report = _page_report(spark, folder)
    sinks.write_csv(report, path)
    back = spark.read.schema("page_id bigint, ord bigint, value string, similar string")
    return back.option("header", True).option("escape", '"').csv(path)


@query(f"select page_id, name, cast(ord as double) as score from {_SIMILAR}")
def similarity_scores(spark, folder):
    """Score texts as numbers."""
    each = _page_report(spark, folder).filter("ord = 0").select("page_id", F.inline("similar"))
    return each.select("page_id", "name", pg.score_number("similarity_score").alias("score"))
