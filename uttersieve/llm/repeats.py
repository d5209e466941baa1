r"""Repeated passages across documents (operator 5): sharded phrase automata.

A window is 13 consecutive words.  Every word goes that is covered by a window
whose words also start in a document with a smaller ``doc_id``.

Copies of a whole text are settled by the text's digest: they keep words only if they
have fewer than 13, and only the first copy goes on.

1. Anchors.  The smallest hash among a window's 6-word runs depends on its words
   only, so equal windows have equal anchors; about every fifth run is one.  An
   anchor that two different texts have is recurring.
2. A bitmap of fixed size with the recurring anchors sieves the texts: documents
   without a recurring anchor are done; of the others the passages around such
   anchors go on, as text.
3. Confirming.  Equal passages are merged first; the passages of one anchor meet
   and their windows, compared word by word, give each recurring window its
   smallest document.  Runs of windows of one smallest document are the phrases.
   An anchor with over ``FREQUENT`` occurrences has its windows confirmed one by one,
   by a sum over equal windows, so its passages never meet in one task.
4. Phrases are dealt into shards by anchor; each shard's are compiled into an
   Aho-Corasick automaton over word numbers, and all passages of the shard stream
   through it.  An anchor with many phrases has several shards: a phrase goes to that of
   its first window, a passage to those of its windows, eight at most unless it repeats
   itself.  A shard with many passages is split: every part compiles the same
   phrases.  Every occurrence with a smaller document is marked.
5. Marks meet the sieved documents by row number and the words go.

Hashes only bring candidates together; words decide.  Memory: one automaton of
up to about ``PHRASES`` phrases, one batch of passages, the distinct windows of one anchor
that is not frequent.

Null or empty text: no words.  A null ``doc_id`` is compared with nothing and its
text stays.  Rows that share a ``doc_id`` are judged each and never take words from
each other.  Extra columns are not looked at.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps, kernels
from uttersieve.llm.registry import discard, documents, query
from uttersieve.session import materialize, small_batches

WINDOW, ANCHOR = 13, 6
PHRASES = 40_000  # of an automaton, hardly ever more; a quarter on average
PASSAGES = 200_000  # per part of a shard, about
FREQUENT = 50_000  # occurrences from which an anchor's windows are confirmed one by one
KNOWN = 10_000  # passages whose occurrences are remembered
CHUNK = 1 << 18  # bytes of text in hand at once, whole documents each


def _anchors(words: kernels.Words):
    """``(document, window, run, hash of the run)`` for every window, in order."""
    hashes = words.hashes()
    runs = kernels.window_hashes(hashes, ANCHOR)
    span = WINDOW - ANCHOR + 1
    per = np.maximum(np.diff(words.first) - WINDOW + 1, 0)
    total = int(per.sum())
    if not total:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    document = np.repeat(np.arange(len(per)), per)
    window = np.repeat(words.first[:-1] - (np.cumsum(per) - per), per) + np.arange(total)
    least = np.lib.stride_tricks.sliding_window_view(runs, span).argmin(axis=1)
    run = window + least[window]
    return document, window, run, runs[run]


def anchors(docs: DataFrame) -> DataFrame:
    """``h, t``: the anchors of every document, with a hash of its text."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in kernels.chunks(batch.column(0), CHUNK):
                document, _, place, h = _anchors(kernels.Words(data, offsets))
                texts = np.frombuffer(
                    b"".join(
                        _text_key(data[a:b])[:8] for a, b in zip(offsets[:-1], offsets[1:])
                    ),
                    np.int64,
                )
                new = np.ones(len(place), bool)
                new[1:] = place[1:] != place[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kernels.signed(h[new])), pa.array(texts[document[new]])],
                    names=["h", "t"],
                )

    small_batches(docs.sparkSession)
    return (
        docs.filter("doc_id is not null").select("text").mapInArrow(kernels.lean(run), "h bigint, t bigint")
    )


def _text_key(data: np.ndarray) -> bytes:
    """As Spark computes it: half of the text's SHA-256."""
    return hashlib.sha256(data).digest()[:16]


def kept_digest(body: bytes) -> str:
    return hashlib.sha256(b" ".join(body.split())).hexdigest()


def _sieved(docs: DataFrame, sent) -> DataFrame:
    """One row per document: words, digest, and where it is not done text and passages.

    A passage is the words of consecutive windows with one anchor: its hash, first
    window, windows, and place in the text (bytes).
    """
    spans = pa.list_(
        pa.struct([("h", pa.int64())] + [(n, pa.int32()) for n in ("at", "n", "start", "stop")])
    )

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in kernels.chunks(batch.column(1), CHUNK):
                words = kernels.Words(data, offsets)
                document, window, place, h = _anchors(words)
                h = kernels.signed(h)
                here = bitmaps.contains(sent.value, h) & known[lo + document]
                first = np.ones(len(place), bool)
                first[1:] = (place[1:] != place[:-1]) | (document[1:] != document[:-1])
                begin = np.flatnonzero(first)
                last = np.append(begin[1:], len(place)) - 1
                use = here[begin]
                begin, last = begin[use], last[use]
                owner = document[begin]
                base = offsets[owner]
                fields = [
                    pa.array(h[begin]),
                    pa.array((window[begin] - words.first[owner]).astype(np.int32)),
                    pa.array((last - begin + 1).astype(np.int32)),
                    pa.array((words.starts[window[begin]] - base).astype(np.int32)),
                    pa.array((words.ends[window[last] + WINDOW - 1] - base).astype(np.int32)),
                ]
                bounds = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
                bodies = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                flagged = np.diff(bounds) > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array([_text_key(b) for b in bodies], pa.binary()),
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.array([kept_digest(b) for b in bodies], pa.string()),
                        pa.array([b if f else None for b, f in zip(bodies, flagged)], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(bounds),
                            pa.StructArray.from_arrays(fields, fields=list(spans.value_type)),
                        ),
                    ],
                    names=["doc_id", "text_key", "n_words", "kept_sha256", "body", "spans"],
                )

    out = (
        "doc_id bigint, text_key binary, n_words bigint, kept_sha256 string, body binary, "
        "spans array<struct<h: bigint, at: int, n: int, start: int, stop: int>>"
    )
    return docs.select("doc_id", "text").mapInArrow(kernels.lean(run), out)


def _passages(rows: DataFrame, merged: bool = False) -> DataFrame:
    """``h, row, doc_id, at, words`` of the sieved documents' passages; or, ``merged``,
    ``h, words, low, high`` of the different passages of a few documents at a time."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                spans = part.column(3)
                flat = spans.flatten()
                owner = np.repeat(np.arange(part.num_rows), spans.value_lengths().to_numpy())
                bodies = part.column(2).to_pylist()
                start, stop = (flat.field(n).to_numpy().tolist() for n in ("start", "stop"))
                texts = [
                    b" ".join(bodies[o][a:b].split())
                    for o, a, b in zip(owner.tolist(), start, stop)
                ]
                ids = part.column(1).take(pa.array(owner))
                if merged:
                    yield _merged(*(c.to_numpy().tolist() for c in (flat.field("h"), ids)), texts)
                    continue
                yield pa.RecordBatch.from_arrays(
                    [flat.field("h"), part.column(0).take(pa.array(owner)), ids,
                     flat.field("at"), pa.array(texts, pa.binary())],
                    names=["h", "row", "doc_id", "at", "words"],
                )

    out = "h bigint, row bigint, doc_id bigint, at int, words binary"
    if merged:
        out = "h bigint, words binary, low bigint, high bigint"
    return rows.select("row", "doc_id", "body", "spans").mapInArrow(kernels.lean(run), out)


def _merged(anchors, ids, texts):
    """Equal passages as one, with their smallest and largest document."""
    seen: dict = {}
    for h, doc_id, words in zip(anchors, ids, texts):
        low, high = seen.get((h, words), (doc_id, doc_id))
        seen[(h, words)] = (min(low, doc_id), max(high, doc_id))
    return pa.RecordBatch.from_pydict(
        {
            "h": pa.array([k[0] for k in seen], pa.int64()),
            "words": pa.array([k[1] for k in seen], pa.binary()),
            "low": pa.array([v[0] for v in seen.values()], pa.int64()),
            "high": pa.array([v[1] for v in seen.values()], pa.int64()),
        }
    )


def _single_windows(passages: DataFrame) -> DataFrame:
    """``h, words, owner``: recurring windows one by one, for anchors so frequent that
    their passages should not meet in one task.  Spark adds up equal windows before
    and after the shuffle, as it does any sum."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size("_w") - (WINDOW - 1)),
        lambda i: F.array_join(F.slice("_w", i, WINDOW), " "),
    )
    return (
        passages.withColumn("_w", F.split(F.col("words").cast("string"), " "))
        .select("h", "low", "high", F.explode(F.array_distinct(windows)).alias("window"))
        .groupBy("h", "window")
        .agg(F.min("low").alias("owner"), F.max("high").alias("last"))
        .filter("owner < last")
        .select("h", F.col("window").cast("binary").alias("words"), "owner")
    )


def _phrases(passages: DataFrame) -> DataFrame:
    """``h, words, owner``: runs of recurring windows and their smallest document, from
    merged passages."""

    def confirmed(group):
        passages = {}  # equal ones, merged apart by several tasks, as one
        for words, a, b in group:
            low, high = passages.get(words, (a, b))
            passages[words] = (min(low, a), max(high, b))
        if len(passages) == 1:  # all its windows have these documents
            return {(words, a) for words, (a, b) in passages.items() if a < b}
        low, high, windows = {}, {}, []
        for words, (a, b) in passages.items():
            words = words.split(b" ")
            mine = [b" ".join(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)]
            windows.append((words, mine))
            for w in mine:
                low[w] = min(low.get(w, a), a)
                high[w] = max(high.get(w, b), b)
        found = set()
        for words, mine in windows:
            start = 0
            while start < len(mine):
                w = mine[start]
                end = start + 1
                if low[w] < high[w]:
                    while end < len(mine) and low[mine[end]] < high[mine[end]] and (
                        low[mine[end]] == low[w]
                    ):
                        end += 1
                    found.add((b" ".join(words[start : end + WINDOW - 1]), low[w]))
                start = end
        return found

    def run(batches):
        at, group = None, []
        for batch in batches:
            out = {"h": [], "words": [], "owner": []}

            def close():
                for words, owner in confirmed(group):
                    out["h"].append(at)
                    out["words"].append(words)
                    out["owner"].append(owner)

            h, words, low, high = batch.columns
            numbers = (c.to_numpy().tolist() for c in (h, low, high))
            for h, a, b, text in zip(*numbers, words.to_pylist()):
                if h != at:
                    close()
                    at, group = h, []
                group.append((text, a, b))
            yield pa.RecordBatch.from_pydict(out, schema=schema)
        out = {"h": [], "words": [], "owner": []}
        for words, owner in confirmed(group):
            out["h"].append(at)
            out["words"].append(words)
            out["owner"].append(owner)
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("h", pa.int64()), ("words", pa.binary()), ("owner", pa.int64())])
    return (
        passages.repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(kernels.lean(run), "h bigint, words binary, owner bigint")
    )


class _Automaton:
    """Aho-Corasick over word numbers; a word number is one character."""

    def __init__(self, phrases):
        import ahocorasick

        words = pa.array([w for w, _ in phrases], pa.binary())
        self.vocabulary = pc.split_pattern(words, " ").flatten().unique()
        self.known: dict = {}
        self.machine = ahocorasick.Automaton()
        owners: dict = {}
        for key, (_, owner) in zip(self._spelled(words), phrases):
            owners[key] = min(owners.get(key, owner), owner)
        for key, owner in owners.items():
            self.machine.add_word(key, (len(key), owner))
        if owners:
            self.machine.make_automaton()
        self.empty = not owners

    def _spelled(self, passages: pa.Array) -> list:
        """Each passage as a string of its word numbers; words of no phrase are 0."""
        words = pc.split_pattern(passages, " ")
        n = pc.index_in(words.flatten(), value_set=self.vocabulary).fill_null(-1).to_numpy() + 1
        text = np.where(n < 0xD800, n, n + 0x800).astype("<u4").tobytes()  # no surrogates
        text, ends = text.decode("utf-32-le"), np.cumsum(words.value_lengths().to_numpy()).tolist()
        return [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def found(self, body: str) -> list:
        """``(first, end, owner)`` of the phrases in a spelled passage, by their first words."""
        found = self.known.get(body)  # copies have equal passages
        if found is None:
            found = [] if self.empty else sorted(
                (end - length + 1, end + 1, owner)
                for end, (length, owner) in self.machine.iter(body)
            )
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[body] = found
        return found

    def marks(self, words: pa.Array, doc_id: np.ndarray):
        """``(passage, first, end)``: the word runs in passages of ``doc_id`` that are of
        phrases which a smaller document has, runs that touch as one."""
        distinct = words.dictionary_encode()
        found = [self.found(body) for body in self._spelled(distinct.dictionary)]
        each = np.array([len(f) for f in found], np.int64)
        flat = np.array([x for f in found for x in f], np.int64).reshape(-1, 3)
        which = distinct.indices.to_numpy()
        count = each[which]
        passage = np.repeat(np.arange(len(which)), count)
        begin = np.cumsum(each)[which] - count  # of the passage's phrases in ``flat``
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(len(passage))
        smaller = flat[at, 2] < doc_id[passage]
        passage, at = passage[smaller], at[smaller]
        if not len(passage):
            return passage, passage, passage
        apart = passage << 32  # no run reaches into the next passage
        first, end = flat[at, 0] + apart, np.maximum.accumulate(flat[at, 1] + apart)
        new = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
        last = np.append(new[1:], len(end)) - 1
        return passage[new], (first - apart)[new], (end - apart)[last]


def _sharded(rows: DataFrame, phrases: DataFrame, first_only: bool) -> DataFrame:
    """``rows`` with the ``shard`` of their anchor, or, where an anchor has many
    phrases, the shards of their windows (of the first one only)."""
    # a shard holds a quarter of PHRASES on average, in lots of an eighth at most, so that
    # hardly any is over PHRASES
    lot, shards = max(PHRASES // 8, 1), max(-(-phrases.count() * 4 // PHRASES), 1)
    # at most one anchor for every ``lot`` phrases
    many = phrases.groupBy("h").agg(F.ceil(F.count("*") / lot).cast("int").alias("lots"))
    many = many.filter("lots > 1")
    n = F.lit(1) if first_only else F.size("_w") - (WINDOW - 1)
    windows = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.pmod(
            F.xxhash64(
                "h", F.pmod(F.xxhash64(F.array_join(F.slice("_w", i, WINDOW), " ")), F.col("lots"))
            ),
            F.lit(shards),
        ),
    )
    split = (
        rows.join(F.broadcast(many), "h")
        .withColumn("_w", F.split(F.col("words").cast("string"), " "))
        .withColumn("shard", F.explode(F.array_distinct(windows)))
        .select(*rows.columns, "shard")
    )
    rest = rows.join(F.broadcast(many), "h", "left_anti")
    return rest.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).unionByName(split)


def _marks(passages: DataFrame, phrases: DataFrame) -> DataFrame:
    """``row, marks``: word runs to remove, from streaming all passages of a shard
    through the automaton of its phrases."""
    passages = _sharded(passages, phrases, first_only=False)
    phrases = _sharded(phrases, phrases, first_only=True)
    parts = materialize(
        passages.groupBy("shard")
        .agg(F.ceil(F.count("*") / PASSAGES).cast("int").alias("parts")),
        "parts",
    )
    kinds = ["shard", "part", "kind", "words", "doc_id", "row", "at"]
    compiled = (
        phrases.join(parts, "shard")
        .withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        .select("shard", "part", F.lit(0).alias("kind"), "words",
                F.col("owner").alias("doc_id"), F.lit(0).cast("bigint").alias("row"),
                F.lit(0).alias("at"))
    )
    streamed = (
        passages.join(parts, "shard")
        .withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
        .withColumn("kind", F.lit(1))
        .select(*kinds)
    )

    def run(batches):
        key, phrases, machine = None, [], None
        for batch in batches:
            words = batch.column(3)
            shard, part, kind, doc_id, row, at = (
                batch.column(i).to_numpy() for i in (0, 1, 2, 4, 5, 6)
            )
            change = (np.diff(shard) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)
            bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds[:-1], bounds[1:]):
                if a == b:
                    continue
                if (shard[a], part[a]) != key:
                    key, phrases, machine = (shard[a], part[a]), [], None
                if kind[a] == 0:
                    phrases += zip(words.slice(a, b - a).to_pylist(), doc_id[a:b].tolist())
                    continue
                if machine is None:
                    machine, phrases = _Automaton(phrases), []
                passage, first, end = machine.marks(words.slice(a, b - a), doc_id[a:b])
                passage = passage + a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[passage])]
                    + [pa.array((at[passage] + x).astype(np.int32)) for x in (first, end)],
                    names=["row", "first", "end"],
                )

    return (
        compiled.unionByName(streamed)
        .repartition("shard", "part")
        .sortWithinPartitions("shard", "part", "kind")
        .mapInArrow(kernels.lean(run), "row bigint, first int, end int")
        .groupBy("row")
        .agg(F.collect_list(F.struct("first", "end")).alias("marks"))
    )


def _cut(rows: DataFrame, with_text: bool) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256[, text, text_key]``: marked words are gone."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                removed, digests, texts = [], [], []
                marks = part.column(3).to_pylist()
                for body, mine in zip(part.column(2).to_pylist(), marks):
                    if mine:
                        data = np.frombuffer(body, np.uint8)
                        words = kernels.Words(data, np.array([0, len(data)]))
                        gone = np.zeros(len(words.starts) + 1, np.int64)
                        for m in mine:
                            gone[m["first"]] += 1
                            gone[m["end"]] -= 1
                        gone = np.cumsum(gone)[:-1] > 0
                        # a removed word goes with the blanks up to the next word
                        until = np.append(words.starts[1:], len(data))
                        keep = np.ones(len(data) + 1, np.int64)
                        keep[:] = 0
                        np.add.at(keep, words.starts[gone], 1)
                        np.add.at(keep, until[gone], -1)
                        body = data[np.cumsum(keep)[:-1] == 0].tobytes()
                        removed.append(int(gone.sum()))
                    else:
                        removed.append(0)
                    digests.append(kept_digest(body))
                    texts.append(body)
                columns = [part.column(0), part.column(1), pa.array(removed, pa.int64()),
                           pa.array(digests, pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns += [pa.array([t.decode() for t in texts], pa.string()), part.column(4)]
                    names += ["text", "text_key"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    key = ["text_key"] if with_text else []
    return rows.select("doc_id", "n_words", "body", "marks", *key).mapInArrow(
        kernels.lean(run), out + (", text string, text_key binary" if with_text else "")
    )


def _judged(docs: DataFrame, with_text: bool):
    """``(done, cut)``: documents without and with a recurring anchor."""
    recurring = materialize(
        anchors(docs)
        .groupBy("h")
        .agg(F.min("t").alias("low"), F.max("t").alias("high"), F.count("*").alias("n"))
        .filter("low < high")
        .select("h", "n"),
        "anchors",
    )
    sent = bitmaps.build(recurring, "h")
    sieved = materialize(
        _sieved(docs, sent).withColumn("row", F.monotonically_increasing_id()), "sieved"
    )
    # whole copies: all their windows start in the first one, too
    keys = sieved.filter("doc_id is not null").select("row", "doc_id", "text_key")
    firsts = keys.groupBy("text_key").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    ).filter("first < last")
    copies = materialize(
        keys.join(firsts, "text_key").filter("doc_id > first")
        .select("row", F.lit(True).alias("copy")),
        "copies",
    )
    key = ["text_key"] if with_text else []
    sieved = sieved.select("row", "doc_id", "n_words", "kept_sha256", "body", "spans", *key)
    rest, hit = bitmaps.meet(sieved, copies, "row")
    own = rest.unionByName(hit.filter("copy is null").drop("copy"))
    whole = hit.filter("copy").withColumn("n_removed", F.when(
        F.col("n_words") >= WINDOW, F.col("n_words")).otherwise(F.lit(0)).cast("bigint"))
    held = materialize(own.filter("body is not null"), "held")
    done = materialize(own.filter("body is null").select("doc_id", "n_words", "kept_sha256"), "done")
    nothing = hashlib.sha256(b"").hexdigest()
    whole = materialize(
        whole.select("doc_id", "n_words", "n_removed", "kept_sha256", *key), "whole"
    )
    discard(sieved)  # nothing reads it any more, and it holds most texts once again
    whole = whole.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.when(F.col("n_removed") > 0, F.lit(nothing)).otherwise(
            F.coalesce("kept_sha256", F.lit(nothing))
        ).alias("kept_sha256"),
        *([F.lit("").alias("text"), "text_key"] if with_text else []),
    )
    passages = _passages(held, merged=True)
    # a frequent anchor's passages do not meet in one task
    frequent = recurring.filter(F.col("n") > FREQUENT).select("h")
    if frequent.limit(1).count():
        found = _phrases(passages.join(frequent, "h", "left_anti")).unionByName(
            _single_windows(passages.join(frequent, "h", "left_semi"))
        )
    else:
        found = _phrases(passages)
    phrases = materialize(found, "phrases")
    marks = materialize(_marks(_passages(held), phrases), "marks")
    # only texts that lose words are moved to their marks, and by chance a few more
    sent = bitmaps.build(marks.select(F.xxhash64("row").alias("h")), "h")
    as_is = held.select("row", "doc_id", "n_words", "kept_sha256", *(["body", *key] if with_text else []))
    kept = bitmaps.sieve(as_is, sent, F.xxhash64("row"), inside=False)
    hit = bitmaps.sieve(
        held.select("row", "doc_id", "n_words", "body", *key), sent, F.xxhash64("row")
    ).join(marks.hint("merge"), "row", "left")
    kept = kept.select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256",
        *([F.col("body").cast("string").alias("text"), "text_key"] if with_text else []),
    )
    return done, _cut(hit, with_text).unionByName(kept).unionByName(whole)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``."""
    done, cut = _judged(docs, with_text=False)
    return done.select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256"
    ).unionByName(cut)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words gone from ``text`` and ``n_chars`` counted anew.

    Other columns, and texts without a repeat, stay as they are.  Rows may repeat and a
    ``doc_id`` may have several texts: a row meets the cut of its own id and text.
    """
    _, cut = _judged(docs, with_text=True)
    name, key = bitmaps.fresh(docs, "new_text"), bitmaps.fresh(docs, "row_key")
    # rows of one id and text lose the same words
    changed = (
        cut.filter("n_removed > 0 and doc_id is not null")
        .groupBy(F.concat_ws(":", "doc_id", F.lower(F.hex("text_key"))).alias(key))
        .agg(F.first("text").alias(name))
    )
    own = F.concat_ws(":", "doc_id", F.substring(F.sha2("text", 256), 1, 32))
    rest, hit = bitmaps.meet(
        docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), own)),
        materialize(changed, "cut"), key,
    )
    rest = rest.drop(key)
    columns = {"text": F.coalesce(name, "text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col(name).isNull(), F.col("n_chars")).otherwise(
            F.length(name).cast("bigint")
        )
    return rest.unionByName(hit.withColumns(columns).select(*docs.columns))


@query("op5_repeated_passages")
def op5(spark, folder):
    """What every document keeps."""
    return repeated_passages(documents(spark, folder))
