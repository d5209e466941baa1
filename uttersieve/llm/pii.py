r"""Personal data (operator 7): fixed patterns, and contexts learned from what they find.

Base spans come from four fixed patterns (addresses, internet addresses, card
numbers that pass Luhn, phone numbers with a leading ``+``).  They are the seeds.

The method looks for identifiers that those patterns miss.  *Candidates* of one kind have a
loose form (``bob [at] x [dot] org``, a phone number without ``+``, a card number with a
wrong digit, a newer internet address).  *Open* candidates have no form: any token of
letters and digits, like a handle or a key.  Both count only when their surroundings speak for
them, and an open one is of the kind that its surroundings are of:

1. A context is the two words before or the two words after a span.
2. Every context of a seed or candidate is counted in the whole corpus: how often
   it surrounds any word at all.  Frequent phrases thus weigh little.
3. Contexts and instances (the spans' texts) form a graph.  A context's confidence
   for a kind is the belief in its instances over all its occurrences, given at
   least ``SUPPORT`` distinct instances believed in; an instance's belief is that at
   least one of its contexts is right.  Rounds alternate, seeds stay believed, until
   beliefs stand still, however many hops that takes.
4. Candidates believed at least ``BELIEF`` are added to the spans.

Found spans are written down once with their contexts; the scoring works on this
small table.  The corpus counts are one pass whose tasks add up before the shuffle.

Null or empty text: no span.  Repeated rows are each searched; a text that many
rows share is one instance.  Ids are not looked at, nor are extra columns.
"""

import bisect
import ipaddress
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps, kernels
from uttersieve.llm.registry import documents, query
from uttersieve.session import materialize, small_batches

KINDS = ("email", "ip", "card", "phone")
OPEN = len(KINDS)  # the number of no kind yet
SUPPORT, BELIEF = 3, 0.8
STILL = 0.01  # rise of all beliefs together that ends the rounds

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# a match never begins inside a run of digits: it would have begun where the run does
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\}|(?<=\s)at(?=\s))\s?", re.I)
_NAME = re.compile(r"[\w.%+-]")
_HOST = re.compile(
    r"[\w-]{1,64}(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\sdot\s|\.)\s?[\w-]{2,64}){1,4}", re.I
)
_COLONS = re.compile(r"(?<![\w:])[0-9A-Fa-f:]{2,39}(?![\w:])")
_GROUPS = re.compile(r"(?:[0-9A-Fa-f]{1,4}:){3,7}(?::|[0-9A-Fa-f]{1,4})")
_LOOSE_PHONE = re.compile(r"(?<![\w+(.])\(?[0-9][0-9() .-]{5,24}[0-9](?![\w])")
_DIGITS = re.compile(r"[0-9_]+")
_TOKEN = re.compile(r"\w+(?:[.+-]\w+)*")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text):
    at, p = 0, text.find("@")
    while p >= 0:
        start = p
        while start > at and _LOCAL.match(text[start - 1]):
            start -= 1
        tail = _DOMAIN.match(text, p + 1) if start < p else None
        if tail:
            yield start, tail.end()
            at = tail.end()
        p = text.find("@", max(p + 1, at))


def base_spans(text: str) -> list:
    """``(kind, start, end)`` of the fixed patterns, by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [
        ("ip", m.start(), m.end())
        for m in _IP.finditer(text)
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255
               for x in m.group().split("."))
    ]
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _spelled(text):
    """Addresses with a spelled or bracketed ``at``: a name of 64 characters at most
    before it, and a host with a dot, plain or spelled, after it."""
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and m.start() - start < 65 and _NAME.match(text[start - 1]):
            start -= 1
        host = _HOST.match(text, m.end())
        if host and 0 < m.start() - start < 65:
            yield start, host.end()
            end = host.end()


def _groups(text):
    """Internet addresses of colons and hexadecimal groups, shortened ones included."""
    for m in _COLONS.finditer(text):
        token = m.group()
        if token.count(":") < 2 or not token.strip(":"):
            continue
        a, b = m.span()
        if not _GROUPS.fullmatch(token):
            # a colon after an address is not part of it
            while token.endswith(":") and not token.endswith("::"):
                token, b = token[:-1], b - 1
            try:
                ipaddress.IPv6Address(token)
            except ValueError:
                continue
        yield a, b


def _tokens(text):
    """Tokens of 4 to 64 characters with a letter, and a digit or an underscore."""
    at = 0
    for m in _DIGITS.finditer(text):
        if m.start() < at:
            continue
        start = m.start()
        while start > at and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
            start -= 1
        while start < m.start() and text[start] in ".+-":
            start += 1
        # from the first part on, so that the token is whole
        token = _TOKEN.match(text, start)
        while token and token.end() <= m.start():
            start = token.end()
            while text[start] in ".+-":
                start += 1
            token = _TOKEN.match(text, start)
        at = token.end()
        if 4 <= at - start <= 64 and any(c.isalpha() for c in token.group()):
            yield start, at


def _candidates(text: str, base: list) -> list:
    """``(kind, start, end)`` by loose forms, each free of those before it; open ones last."""
    taken = sorted((a, b) for _, a, b in base)
    out = []

    def add(kind, a, b):
        at = bisect.bisect_left(taken, (a, b))
        before = at > 0 and taken[at - 1][1] > a
        after = at < len(taken) and taken[at][0] < b
        if not before and not after:
            out.append((kind, a, b))
            taken.insert(at, (a, b))

    for a, b in _spelled(text):
        add(KINDS.index("email"), a, b)
    if ":" in text:
        for a, b in _groups(text):
            add(KINDS.index("ip"), a, b)
    for m in _CARD.finditer(text):
        if 13 <= sum(c.isdigit() for c in m.group()) <= 19:
            add(KINDS.index("card"), m.start(), m.end())
    for m in _LOOSE_PHONE.finditer(text):
        if 7 <= sum(c.isdigit() for c in m.group()) <= 15:
            add(KINDS.index("phone"), m.start(), m.end())
    for a, b in _tokens(text):
        add(OPEN, a, b)
    return out


def _flagged(data, offsets):
    """Documents that can hold a span.  Every form has a digit, ``@``, an underscore, two
    colons, or an ``at`` that is no part of a word, with a dot, plain or spelled, somewhere."""
    n = len(data)

    def count(mark):
        sums = np.concatenate([[0], np.cumsum(mark)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    low = data | 0x20
    # bytes of letters and digits; those of other alphabets may be either
    inside = ((low >= 97) & (low <= 122)) | ((data >= 48) & (data <= 57)) | (data == 95)
    at, dot = np.zeros(n, bool), data == 46
    if n >= 4:
        at[1:-2] = (low[1:-2] == 97) & (low[2:-1] == 116) & ~inside[:-3] & ~inside[3:]
        dot[1:-2] |= (low[1:-2] == 100) & (low[2:-1] == 111) & (low[3:] == 116) & ~inside[:-3]
    plain = ((data >= 48) & (data <= 57)) | (data == 64) | (data == 95)
    return (count(plain) > 0) | (count(data == 58) > 1) | ((count(at) > 0) & (count(dot) > 0))


def _around(text, start, end):
    """The two whole words before and after a span, as bytes; None if there are fewer."""

    def words(side):
        width = 200
        while True:  # a third word, or the end of the text, says that two are whole
            part = text[max(0, start - width) : start] if side < 0 else text[end : end + width]
            found = part.encode().split()
            if len(found) > 2 or len(part) < width:
                return found[-2:] if side < 0 else found[:2]
            width *= 4

    left = words(-1) if start == 0 or text[start - 1].isspace() else []
    right = words(1) if end == len(text) or text[end].isspace() else []
    return (b" ".join(left) if len(left) == 2 else None,
            b" ".join(right) if len(right) == 2 else None)


def _context_hashes(pairs: list, side: int):
    """Hashes of two-word contexts; the same as :func:`_corpus_contexts` gives."""
    use = [i for i, p in enumerate(pairs) if p is not None]
    out: list = [None] * len(pairs)
    if use:
        data = np.frombuffer(b"\n".join(pairs[i] for i in use), np.uint8)
        words = kernels.Words(data, np.array([0, len(data)]), lower=True)
        h = words.hashes().reshape(-1, 2)
        for i, v in zip(use, kernels.signed(_bind(h[:, 0], h[:, 1], side)).tolist()):
            out[i] = v
    return out


def _bind(first, second, side):
    return kernels.mix(
        first * np.uint64(0x9E3779B97F4A7C15) + kernels.mix(second + np.uint64(side + 1))
    )


def found(docs: DataFrame, with_key: bool = False) -> DataFrame:
    """``doc_id, spans[, text_key]``: base spans and candidates of every row, with contexts."""
    fields = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
              ("seed", pa.bool_()), ("instance", pa.string()),
              ("left", pa.int64()), ("right", pa.int64())]
    kind_of = pa.list_(pa.struct(fields))

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in kernels.chunks(batch.column(1)):
                spans, where = [], [0]
                contexts = ([], [])
                maybe = _flagged(data, offsets)
                for i in range(hi - lo):
                    if maybe[i]:
                        text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                        base = base_spans(text)
                        seeds = [(KINDS.index(k), a, b) for k, a, b in base]
                        for seed, group in ((True, seeds), (False, _candidates(text, base))):
                            for kind, a, b in group:
                                left, right = _around(text, a, b)
                                contexts[0].append(left)
                                contexts[1].append(right)
                                shown = re.sub(r"\s+", " ", text[a:b].lower())
                                spans.append([kind, a, b, seed, shown])
                    where.append(len(spans))
                hashes = [_context_hashes(c, side) for side, c in enumerate(contexts)]
                rows = [dict(zip([f[0] for f in fields], [*s, x, y]))
                        for s, x, y in zip(spans, *hashes)]
                lists = [rows[a:b] for a, b in zip(where[:-1], where[1:])]
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(lists, kind_of)]
                if with_key:
                    columns.append(batch.column(2).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "spans", "text_key"][: len(columns)]
                )

    key = [F.sha2("text", 256).alias("text_key")] if with_key else []
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text", *key).mapInArrow(
        kernels.lean(run),
        "doc_id bigint, spans array<struct<kind: int, start: int, end: int, seed: boolean, "
        "instance: string, left: bigint, right: bigint>>" + (", text_key string" if key else ""),
    )


def _corpus_contexts(docs: DataFrame, sent) -> DataFrame:
    """``context, total``: how many words the wanted contexts surround, over all texts."""

    def run(batches):
        for batch in batches:
            got = []
            for _, _, data, offsets in kernels.chunks(batch.column(0)):
                words = kernels.Words(data, offsets, lower=True)
                h = words.hashes()
                if len(h) < 3:
                    continue
                number = np.zeros(len(h), np.int64)
                starts = words.first[1:-1]
                np.add.at(number, starts[starts < len(h)], 1)
                number = np.cumsum(number)
                one = number[2:] == number[:-2]  # three words of one text
                for side, (x, y) in enumerate(((h[:-2], h[1:-1]), (h[1:-1], h[2:]))):
                    c = kernels.signed(_bind(x[one], y[one], side))
                    got.append(c[bitmaps.contains(sent.value, c)])
            values, n = np.unique(np.concatenate([*got, np.zeros(0, np.int64)]),
                                  return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values), pa.array(n.astype(np.int64))], names=["context", "n"]
            )

    return (
        docs.select("text").mapInArrow(kernels.lean(run), "context bigint, n bigint")
        .groupBy("context").agg(F.sum("n").alias("total"))
    )


def discovered(docs: DataFrame, rows: DataFrame, support=SUPPORT, belief=BELIEF) -> DataFrame:
    """``kind, instance, as_kind`` of candidates whose contexts are trusted: an open one has
    the kind, of several the one most believed in, that its contexts give it."""
    spans = rows.select(F.explode("spans").alias("s")).select("s.*")
    edges = (
        spans.select("kind", "seed", "instance", F.explode(F.array("left", "right")).alias("context"))
        .filter("context is not null")
        .groupBy("kind", "instance", "context")
        .agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    )
    edges = materialize(edges, "edges")
    # only contexts with enough distinct instances can ever count
    busy = materialize(
        edges.groupBy("context").agg(F.count("*").alias("k")).filter(F.col("k") >= support)
        .select("context"),
        "contexts",
    )
    total = _corpus_contexts(docs, bitmaps.build(busy, "context"))
    # a bitmap lets others pass; the join is exact
    total = materialize(total.join(busy, "context", "left_semi"), "totals")
    edges = edges.join(total, "context")
    # an open candidate may turn out to be of any kind
    kinds = F.when(F.col("kind") == OPEN, F.array(*[F.lit(k) for k in range(OPEN)]))
    edges = materialize(
        edges.withColumn("as_kind", F.explode(F.coalesce(kinds, F.array("kind")))), "edges"
    )
    node = ["kind", "instance", "as_kind"]
    scores = materialize(
        edges.groupBy(*node).agg(F.max(F.col("seed").cast("double")).alias("fixed"))
        .withColumn("belief", F.col("fixed")),
        "beliefs",
    )
    last = 0.0
    while True:
        held = edges.join(scores.select(*node, "belief"), node)
        contexts = (
            held.groupBy("as_kind", "context")
            .agg(
                F.sum(F.col("n") * F.col("belief")).alias("mass"),
                F.sum(F.when(F.col("belief") >= belief, 1).otherwise(0)).alias("good"),
                F.sum("n").alias("seen"),
                F.max("total").alias("total"),
            )
            .filter(F.col("good") >= support)
            .select(
                "as_kind", "context",
                (F.col("mass") / F.greatest("total", "seen")).alias("confidence"),
            )
        )
        # a context that is not trusted says nothing
        doubt = F.when(
            F.col("confidence").isNotNull(), F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))
        ).otherwise(0.0)
        scores = materialize(
            edges.join(contexts, ["as_kind", "context"], "left")
            .groupBy(*node)
            .agg(
                F.max(F.col("seed").cast("double")).alias("fixed"),
                (1 - F.exp(F.sum(doubt))).alias("new"),
            )
            .select(*node, "fixed", F.greatest("fixed", "new").alias("belief")),
            "beliefs",
        )
        # beliefs only rise: a sum that stands still is every one of them standing still
        now = scores.agg(F.sum(F.col("belief") - F.col("fixed"))).first()[0] or 0.0
        if now - last < STILL:
            break
        last = now
    new = scores.filter((F.col("belief") >= belief) & (F.col("fixed") < 1))
    return new.groupBy("kind", "instance").agg(
        F.max_by("as_kind", F.struct("belief", -F.col("as_kind"))).alias("as_kind")
    )


def spans(docs: DataFrame, with_key: bool = False) -> DataFrame:
    """``doc_id, base, added[, text_key]``: arrays of ``(kind, start, end)`` per row, kinds
    by number."""
    rows = materialize(
        found(docs, with_key).withColumn("row", F.monotonically_increasing_id()), "found"
    )
    new = discovered(docs, rows)
    loose = rows.select("row", F.explode("spans").alias("s")).filter("not s.seed").select(
        "row", F.col("s.kind").alias("kind"), F.col("s.instance").alias("instance"),
        F.col("s.start").alias("start"), F.col("s.end").alias("end"),
    )
    added = loose.join(new, ["kind", "instance"]).groupBy("row").agg(
        F.collect_list(F.struct(F.col("as_kind").alias("kind"), "start", "end")).alias("added")
    )
    base = F.transform(
        F.filter("spans", lambda s: s["seed"]),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    none = F.array().cast("array<struct<kind: int, start: int, end: int>>")
    key = ["text_key"] if with_key else []
    return rows.select("row", "doc_id", base.alias("base"), *key).join(added, "row", "left").select(
        "doc_id", "base", F.coalesce("added", none).alias("added"), *key
    )


def _listed(column):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.sort_array(column),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts of base spans and all spans as text, for every row."""
    rows = spans(docs)

    def count(kind):
        # one parameter: a second one would be the place in the array
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )


@query("op7_context_bootstrap")
def op7(spark, folder):
    """Personal data in every document."""
    return report(documents(spark, folder))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with ``[EMAIL]`` etc. in the place of every span; ``n_chars`` counted anew.

    Spans that overlap become one mask, named by the first.  Rows may repeat, and a ``doc_id``
    may have several texts or be null: a row meets the spans of its own text.
    """
    name = bitmaps.fresh(docs, "spans")
    key = bitmaps.fresh(docs, "text_key")
    # a text's spans depend on nothing but the text and the corpus
    touched = spans(docs, with_key=True).select(
        F.col("text_key").alias(key), F.concat("base", "added").alias(name)
    ).filter(F.size(name) > 0).groupBy(key).agg(F.first(name).alias(name))
    rest, hit = bitmaps.meet(
        docs.withColumn(key, F.sha2("text", 256)), materialize(touched, "spans"), key
    )
    rest, hit = rest.drop(key), hit.drop(key)

    def mask(text, spans):
        if text is None:
            return None
        parts, at = [], 0
        for a, b, k in spans:
            if a >= at:
                parts += [text[at:a], f"[{KINDS[k].upper()}]"]
            at = max(at, b)
        return "".join([*parts, text[at:]])

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text")).to_pylist()
            spans = batch.column(names.index(name)).to_pylist()
            out = [
                mask(text, sorted((s["start"], s["end"], s["kind"]) for s in mine or []))
                for text, mine in zip(texts, spans)
            ]
            new = {"text": pa.array(out, pa.string())}
            if "n_chars" in names:
                old = batch.column(names.index("n_chars")).to_pylist()
                new["n_chars"] = pa.array(
                    [n if a == b else len(b) for n, a, b in zip(old, texts, out)], pa.int64()
                )
            keep = [n for n in names if n != name]
            yield pa.RecordBatch.from_arrays(
                [new[n] if n in new else batch.column(names.index(n)) for n in keep], names=keep
            )

    changed = hit.mapInArrow(kernels.lean(run), docs.schema)
    return rest.unionByName(changed)
