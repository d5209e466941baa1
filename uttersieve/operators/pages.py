"""Fields, blocks, sentences and relevance of web pages."""

from collections import namedtuple
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttersieve.functions.text import _c, sentences, tokens, word_count

# What to take from a page.  ``tag``/``cls`` select elements (``inside``: only
# below an element ``(tag, cls)``); ``attr`` takes an attribute instead of the
# text; ``label`` selects by exact text and takes the text of the next sibling.
Rule = namedtuple("Rule", "field tag cls attr label inside", defaults=[None] * 4)

# HTML elements that never have content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN = frozenset(["script", "style"])
TASK_BYTES = 8 << 20  # of text whose words a task counts


class _Elements(HTMLParser):
    """Elements of one page in document order: tag, attributes, text, parents.

    Tolerant: an end tag closes up to its open element, or is ignored; what is
    never closed ends with the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self._open = [], []

    def handle_starttag(self, tag, attrs):
        parent = self._open[-1] if self._open else None
        element = {
            "tag": tag,
            "attrs": {k: v or "" for k, v in attrs},
            "parent": parent,
            "text": [],
        }
        self.found.append(element)
        if tag not in VOID:
            self._open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i]["tag"] == tag:
                del self._open[i:]
                break

    def handle_data(self, data):
        if self._open and self._open[-1]["tag"] in HIDDEN:
            return
        for element in self._open:
            element["text"].append(data)


def _fits(element, tag, cls):
    if tag and element["tag"] != tag:
        return False
    return not cls or cls in element["attrs"].get("class", "").split()


def _below(element, inside):
    parent = element["parent"]
    while parent is not None:
        if _fits(parent, *inside):
            return True
        parent = parent["parent"]
    return False


def _take(elements, rule):
    out = []
    for i, e in enumerate(elements):
        if not _fits(e, rule.tag, rule.cls):
            continue
        if rule.inside and not _below(e, rule.inside):
            continue
        if rule.label is not None:
            if "".join(e["text"]).strip() != rule.label:
                continue
            e = next((x for x in elements[i + 1 :] if x["parent"] is e["parent"]), None)
            if e is None:
                continue
        if rule.attr:
            if rule.attr in e["attrs"]:
                out.append(e["attrs"][rule.attr])
        else:
            out.append("".join(e["text"]).strip())
    return out


def page_fields(html, rules) -> Column:
    """Struct of one text array per field, in document order.

    The page goes to Python alone, in Arrow batches; nothing is shuffled, and a
    field's array is never larger than its page.
    """
    rules = [Rule(*r) for r in rules]
    fields = list(dict.fromkeys(r.field for r in rules))

    def extract(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            row = {f: [] for f in fields}
            if page is not None:
                parser = _Elements()
                parser.feed(page)
                parser.close()
                for rule in rules:
                    row[rule.field] += _take(parser.found, rule)
            rows.append(row)
        return pd.DataFrame(rows, columns=fields)

    kind = "struct<" + ", ".join(f"`{f}`: array<string>" for f in fields) + ">"
    return F.pandas_udf(extract, kind)(_c(html))


def long_fields(pages: DataFrame, rules, key="page_id", html="html") -> DataFrame:
    """One row per value: ``key, field, ord, value``."""
    fields = list(dict.fromkeys(Rule(*r).field for r in rules))
    found = pages.select(key, page_fields(html, rules).alias("_f"))

    def numbered(field):
        return F.transform(
            F.col(f"_f.{field}"),
            lambda v, i: F.struct(
                F.lit(field).alias("field"), (i + 1).alias("ord"), v.alias("value")
            ),
        )

    return found.select(key, F.inline(F.flatten(F.array(*map(numbered, fields)))))


def title_of(html) -> Column:
    """Text of the title element, without parsing the page."""
    return F.regexp_extract(_c(html), r"<title>([^<]*)</title>", 1)


def links_of(html) -> Column:
    """Targets of all plain links, in order."""
    return F.regexp_extract_all(_c(html), F.lit(r'<a href="([^"]*)"'), F.lit(1))


def class_text(html, tag, cls) -> Column:
    """Texts of the leaf elements with this tag and class."""
    return F.regexp_extract_all(
        _c(html), F.lit(f'<{tag} class="{cls}">([^<]*)</{tag}>'), F.lit(1)
    )


def with_list(rows: DataFrame, items: str, rows_column: str) -> DataFrame:
    """One row per element of ``rows_column``, each with the whole list ``items``
    of its own page: both are columns of the page, so there is no join."""
    return rows.withColumn("_items", _c(items)).select(
        *[c for c in rows.columns if c not in (rows_column, items)],
        F.posexplode(rows_column).alias("ord", "value"),
        F.col("_items").alias("similar"),
    )


def large_blocks(blocks: DataFrame, text="text", words=10) -> DataFrame:
    """Blocks of at least ``words`` words."""
    return blocks.filter(word_count(text) >= words)


def page_sentences(pages: DataFrame, text="text") -> DataFrame:
    """One row per sentence, numbered from 1."""
    return pages.select(
        *[c for c in pages.columns if c != text],
        F.posexplode(sentences(text)).alias("_i", "sentence"),
    ).select("*", (F.col("_i") + 1).alias("ord")).drop("_i")


def relevant(chunks: DataFrame, query: str, key, text="text", least=0.1) -> DataFrame:
    """Chunks whose TF-IDF vector has at least cosine ``least`` with the query.

    A chunk without a query word scores 0, so only the others are expanded into
    words.  Words are counted in every task before they are shuffled; the counts
    of a word that is in most chunks are split by the skew join if need be.
    """
    key = [key] if isinstance(key, str) else list(key)
    words = sorted(set(query.lower().split()))
    # the texts go to one task per key first: they are smaller than their words
    # with the key at each, and counting the words then needs no shuffle.  A task counts
    # the words of so many bytes of text: left to Spark it would take as many as fit into a
    # shuffle block when compressed, and hold their words all at once
    n_bytes = chunks.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    parts = max(1, -(-n_bytes // TASK_BYTES))
    bags = chunks.select(*key, text).repartition(parts, *key).select(*key, tokens(text).alias("_t"))
    n = chunks.agg(F.count(F.lit(1))).scalar()
    df = bags.select(F.explode(F.array_distinct("_t")).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("_df")
    )
    # a condition inside the explode, so that the words are not split again for a filter
    hit = F.arrays_overlap("_t", F.array(*[F.lit(w) for w in words]))
    counted = (
        bags.select(*key, F.explode(F.when(hit, F.col("_t"))).alias("word"))
        .groupBy(*key, "word")
        .agg(F.count(F.lit(1)).alias("_tf"))
    )
    idf = df.select("word", (F.log((n + 1) / (F.col("_df") + 1)) + 1).alias("_idf"))
    weighted = counted.join(idf, "word").withColumn("_w", F.col("_tf") * F.col("_idf"))
    asked = F.col("word").isin(*words)
    q_norm = idf.filter(asked).agg(F.sqrt(F.sum(F.col("_idf") * F.col("_idf")))).scalar()
    scores = weighted.groupBy(*key).agg(
        F.sum(F.when(asked, F.col("_w") * F.col("_idf")).otherwise(0.0)).alias("_dot"),
        F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"),
    )
    return (
        scores.withColumn("score", F.round(F.col("_dot") / (F.col("_norm") * q_norm), 6))
        .filter(F.col("score") >= least)
        .select(*key, "score")
    )


def score_number(col) -> Column:
    """A score's text as a number, e.g. ``87.5%`` → 87.5."""
    return F.regexp_extract(_c(col), r"[0-9]+(?:\.[0-9]+)?", 0).try_cast("double")
