r"""Toxicity of deobfuscated text (operator 1).

A noisy channel writes ``idiot`` as ``1d10t``, ``i d i o t``, ``i.d.i.o.t`` or ``idiooot``.

1. A character 4-gram model is counted over the words of all documents (whole
   texts, one table of fixed size per task, summed by Spark).
2. Words that may be written so, i.e. with a digit or sign beside a letter or another
   sign, doubled letters, or letters set apart, become a lattice: each place may stand
   for itself, for the letters it looks like, for nothing or a word end (a separator),
   and a run of one letter for one or two.  The best path under the model and the
   channel's costs is the restored word, or words, whatever the length.  Letters set
   apart by blanks or signs, mixed or not, are one lattice up to the next plain word.
   Signs at an end may be letters or punctuation.  With fewer than two letters a word
   is restored only if that is likelier than a number or code of these characters.
   Other words have a lattice of one path and stay.
3. Restored words and their first 4 and 6 bytes are features.  Over all labelled
   training rows Spark counts in how many toxic and other documents each occurs;
   those that tell most (likelihood ratio) are kept, ``FEATURES`` at most, and a
   logistic regression is fitted on ``FIT_ROWS`` labelled rows at most.
4. Every whole text is scored in one pass without a shuffle.

Held out are rows whose crc32 of ``doc_id`` modulo 5 is 0; their labels are not read.
Null or empty text: the score of no features.  A null ``doc_id`` is in no label and
not held out.  Without toxic or without other training rows the score is their
share.  Extra columns are not looked at.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps, kernels
from uttersieve.llm.registry import documents, query
from uttersieve.session import materialize

LETTERS = 28  # word edge, a-z, any other byte of a letter
ORDER = 4
BEGINNINGS = (4, 6)
FEATURES = 4000  # of the classifier, at most
FIT_ROWS = 20_000  # labelled rows it is fitted on, at most
MIN_DOCUMENTS = 3  # toxic ones a feature must occur in
REMEMBERED = 200  # characters of a word whose path is kept for the next time, at most

# what a sign can stand for
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c",
}
_SEPARATORS = " .-_*"
_ENDING = "!|+$("  # may be punctuation at either end of a word
_EDGES = "\"'`,.;:?)]}>%&#*~^=_-/\\<{["
# a mark that is no letter, and all that stands outside of it
_TAIL = re.compile(f"[{re.escape(_EDGES)} ][{re.escape(_EDGES + _ENDING)} ]*$")
_HEAD = re.compile(f"^[{re.escape(_EDGES + _ENDING)} ]*[{re.escape(_EDGES)} ]")
_DRAWN = re.compile(r"(.)\1\1")
_DISGUISED = 5.0  # what a word of letters must gain by another reading
_OTHER = 27

_code = np.full(256, _OTHER, np.int64)
_code[:0x80] = 0
_code[np.arange(97, 123)] = np.arange(1, 27)
_code[np.arange(65, 91)] = np.arange(1, 27)
_letter = _code > 0
_leet = np.zeros(256, bool)
_leet[[ord(c) for c in LOOKS_LIKE]] = True
_apart = np.zeros(256, bool)
_apart[[ord(c) for c in _SEPARATORS.strip()]] = True


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all runs of ``ORDER`` characters, word edges included."""
    size = LETTERS**ORDER

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, _, data, offsets in kernels.chunks(batch.column(0)):
                code = np.zeros(len(data) + 2 * ORDER, np.int32)
                code[ORDER:-ORDER] = _code[data]
                gram = code[:-3] * LETTERS**3 + code[1:-2] * LETTERS**2
                gram += code[2:-1] * LETTERS + code[3:]
                total += np.bincount(gram, minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["gram", "n"]
        )

    counted = docs.select("text").mapInArrow(run, "gram bigint, n bigint")
    out = np.zeros(size, np.int64)
    summed = counted.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out[summed.column("gram").to_numpy()] = summed.column("n").to_numpy()
    return out


class Restorer:
    """Best path through a word's lattice; words seen before are remembered."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape((LETTERS,) * ORDER).astype(np.float64)
        p = np.full((LETTERS,), 1 / LETTERS)
        for order in range(ORDER):  # each order falls back on the one below
            n = c.sum(axis=tuple(range(ORDER - 1 - order))) if order < ORDER - 1 else c
            p = (n + 5 * p) / (n.sum(axis=-1, keepdims=True) + 5)
        self.score = np.log(p).ravel().tolist()
        self.seen: dict = {}
        self.words: dict = {}

    def __call__(self, word: str) -> str:
        got = self.seen.get(word)
        if got is None:
            got = self._decode(word)
            if len(word) <= REMEMBERED:
                if len(self.seen) > 200_000:
                    self.seen.clear()
                self.seen[word] = got
        return got

    def word(self, raw: bytes) -> str | None:
        """The :meth:`reading` of one word, remembered."""
        if raw in self.words:
            return self.words[raw]
        new = self.reading(raw.decode("utf-8", "replace"), True)
        if len(raw) <= REMEMBERED:
            if len(self.words) > 100_000:
                self.words.clear()
            self.words[raw] = new
        return new

    def reading(self, raw: str, one: bool) -> str | None:
        """What ``raw``, ``one`` word or several, reads if it reads differently."""
        core = _HEAD.sub("", _TAIL.sub("", raw))
        if one and "@" in core and "." in core:  # addresses
            return None
        new = self(core) if len(core) > 1 else core
        # what only lost marks at its ends is read as before
        if new and new.split() not in (core.split(), core.strip(_ENDING).split()):
            return new
        return None

    def _steps(self, word):
        """For each place ``[(letters, next place, cost)]``; a blank is a word end."""
        n, out = len(word), []
        ends = [n] * n  # of the run of equal characters around each place
        for i in range(n - 2, -1, -1):
            ends[i] = ends[i + 1] if word[i] == word[i + 1] else i + 1
        first = n - len(word.lstrip(_ENDING))
        last = len(word.rstrip(_ENDING))
        for i, c in enumerate(word):
            run = ends[i]
            here = []
            if c.isalpha():
                here.append((c, i + 1, 0.0))
                if run - i >= 3:  # a drawn-out letter
                    here += [(c, run, 0.5), (c + c, run, 0.5)]
                elif run - i == 2:
                    here.append((c, run, 3.0))
            elif c in LOOKS_LIKE:
                here += [(x, i + 1, 0.7) for x in LOOKS_LIKE[c]]
                if first <= i < last:
                    here.append(("", i + 1, 6.0))
                else:
                    here.append(("", run, 0.7 if c == "!" else 2.0))
                if run - i >= 2:
                    here += [(x, run, 1.5) for x in LOOKS_LIKE[c]]
            elif c == " " and run - i >= 2:  # a gap wider than others
                here += [("", run, 1.5), (" ", run, 0.2)]
            elif c in _SEPARATORS:
                here += [("", i + 1, 0.2), (" ", i + 1, 0.2 if c == " " else 0.7)]
            else:
                here.append(("", i + 1, 2.0))
            out.append(here)
        return out

    def _as_number(self, word):
        """Cost of a word read as a number or code: each character one of its class, and
        each change between letters and the rest."""
        cost, before = 0.0, None
        for c in word:
            cost += 3.3 if c.isalpha() else 2.3 if c.isdigit() else 0.2 if c == " " else 3.5
            if before is not None and before != c.isalpha():
                cost += 2.3
            before = c.isalpha()
        # without a letter it is hardly ever a word
        return cost - (0.0 if any(c.isalpha() for c in word) else 6.0)

    def _decode(self, word):
        """The best of all paths.  The state is the last three letters' codes, so there are
        ``LETTERS**3`` at most at a place, and nothing is pruned."""
        steps, n, score = self._steps(word), len(word), self.score
        # state -> (score, path so far, letters)
        states: list = [{} for _ in range(n + 1)]
        states[0][0] = (0.0, None, "")
        for i in range(n):
            here, states[i] = states[i], None
            for state, node in here.items():
                for letters, nxt, cost in steps[i]:
                    at, s = state, node[0] - cost
                    if letters == " " and at % LETTERS == 0:
                        continue  # no word to end
                    for letter in letters:
                        k = ord(letter) - 96 if "a" <= letter <= "z" else _OTHER
                        at = at * LETTERS + (k if letter != " " else 0)
                        s += score[at]
                        at %= LETTERS ** (ORDER - 1)
                    old = states[nxt].get(at)
                    if old is None or s > old[0]:
                        states[nxt][at] = (s, node, letters)
        best, text = None, ""
        for state, node in states[n].items():
            s = node[0] + (score[state * LETTERS] if state % LETTERS else 0.0)
            if state and (best is None or s > best[0]):
                best = (s, node)
        letters = sum(c.isalpha() for c in word)
        if best and letters < 2 and -best[0] >= self._as_number(word):
            return word
        if best and letters == n and not _DRAWN.search(word):  # doubled letters are common
            at, plain = 0, 0.0
            for c in word + " ":
                k = ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else _OTHER
                plain += score[at * LETTERS + k]
                at = (at * LETTERS + k) % LETTERS ** (ORDER - 1)
            if best[0] < plain + _DISGUISED:
                return word
        parts, node = [], best and best[1]
        while node:
            parts.append(node[2])
            node = node[1]
        text = "".join(reversed(parts)).strip()
        return text or word


def _suspicious(words: kernels.Words):
    """``(single, runs)``: words that need decoding, and ``[first, end)`` runs of words
    whose letters are all set apart, by blanks or signs."""
    data, n = words.data, len(words.data)
    letter, leet, apart = _letter[data], _leet[data], _apart[data]
    inside = letter | leet
    hit = np.zeros(n + 1, bool)
    if n >= 2:
        hit[:-2] |= (leet[:-1] & inside[1:]) | (letter[:-1] & leet[1:])
        hit[:-2] |= (data[1:] == data[:-1]) & letter[1:] & (data[1:] < 0x80)
    if n >= 5:
        hit[: n - 4] |= letter[:-4] & apart[1:-3] & letter[2:-2] & apart[3:-1] & letter[4:]

    def total(flags):
        return np.concatenate([[0], np.cumsum(flags)])

    count = total(hit[:n])
    length = words.ends - words.starts
    # the last byte's neighbour is in the next word
    single = (count[words.ends - 1] > count[words.starts]) & (length >= 3)
    # a letter may have several bytes; its first one begins it
    begins = inside & ((data & 0xC0) != 0x80)
    touch = np.zeros(n, bool)
    touch[1:] = begins[1:] & inside[:-1]
    places, touching, strange = total(begins), total(touch), total(~inside & ~apart)
    loose = touching[words.ends] == touching[words.starts + 1]
    loose &= strange[words.ends] == strange[words.starts]
    joined = np.zeros(len(length), bool)
    joined[1:] = loose[1:] & loose[:-1]
    joined[words.first[:-1][words.first[:-1] < len(length)]] = False
    begin = np.flatnonzero(loose & ~joined)
    broken = np.flatnonzero(np.append(~joined, True))
    stop = broken[np.searchsorted(broken, begin + 1)]
    if len(begin):
        use = places[words.ends[stop - 1]] - places[words.starts[begin]] >= 3
        begin, stop = begin[use], stop[use]
    taken = np.zeros(len(length) + 1, np.int64)
    np.add.at(taken, begin, 1)
    np.add.at(taken, stop, -1)
    single &= np.cumsum(taken)[:-1] == 0
    return np.flatnonzero(single), list(zip(begin.tolist(), stop.tolist()))


def _spelled(text, words: kernels.Words, a: int, b: int) -> str:
    """The words from ``a`` to ``b``; gaps wider than the narrowest become two blanks."""
    parts = [text[s:e] for s, e in zip(words.starts[a:b].tolist(), words.ends[a:b].tolist())]
    gaps = words.starts[a + 1 : b] - words.ends[a : b - 1]
    wide = (gaps > gaps.min()).tolist() if b - a > 1 else []
    out = [parts[0]]
    for part, far in zip(parts[1:], wide):
        out += [b"  " if far else b" ", part]
    return b"".join(out).decode("utf-8", "replace")


def _restored(words: kernels.Words, restore: Restorer):
    """``(first, end, text)`` of word runs that read differently when restored."""
    text = words.data.tobytes()
    single, runs = _suspicious(words)
    spans = zip(single.tolist(), words.starts[single].tolist(), words.ends[single].tolist())
    out = [(i, i + 1, restore.word(text[start:end])) for i, start, end in spans]
    out += [
        (a, b, restore.reading(_spelled(text, words, a, b), b - a == 1)) for a, b in runs
    ]
    return sorted(x for x in out if x[2] is not None)


def restored_text(text: str, restore: Restorer) -> str:
    """The text with its disguised words written out (A-Z lower-cased)."""
    data = np.frombuffer(text.encode(), np.uint8)
    words = kernels.Words(data, np.array([0, len(data)]), lower=True)
    body, parts, at = words.data.tobytes(), [], 0
    for a, b, new in _restored(words, restore):
        if words.starts[a] < at:
            continue
        parts += [body[at : words.starts[a]], new.encode()]
        at = words.ends[b - 1]
    return b"".join([*parts, body[at:]]).decode("utf-8", "replace")


def _trimmed(words: kernels.Words):
    """The same words without marks at their ends (only the spans change)."""
    data = words.data
    inner = _letter[data] | ((data >= 48) & (data <= 57))
    n = len(words.starts)
    at = np.flatnonzero(inner)
    if not n or not len(at):
        return np.zeros(0, np.int64)
    lo = np.searchsorted(at, words.starts)
    hi = np.searchsorted(at, words.ends) - 1
    some = hi >= lo
    words.starts = np.where(some, at[np.minimum(lo, len(at) - 1)], words.starts)
    words.ends = np.where(some, at[np.maximum(hi, 0)] + 1, words.ends)
    return words


def _features(data, offsets, restore):
    """``(document, hash)`` of all features of a run of documents, with repeats."""
    words = kernels.Words(data, offsets, lower=True)
    new = _restored(words, restore) if restore else []
    replaced = np.zeros(len(words.starts), bool)
    extra, owner = [], []
    documents_of = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    for a, b, text in new:
        replaced[a:b] = True
        for w in text.split():
            extra.append(w.encode())
            owner.append(documents_of[a])
    _trimmed(words)
    out_doc, out_hash = [], []

    def add(w, docs, skip):
        h = w.hashes()
        for at, values in [(np.arange(len(h)), h), *w.beginnings(BEGINNINGS)]:
            if skip is not None:
                use = ~skip[at]
                at, values = at[use], values[use]
            out_doc.append(docs[at])
            out_hash.append(values)

    add(words, documents_of, replaced if new else None)
    if extra:
        body = b" ".join(extra)
        more = kernels.Words(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
        add(more, np.array(owner), None)
    return np.concatenate(out_doc), kernels.signed(np.concatenate(out_hash))


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _labelled(docs, labels) -> DataFrame:
    """``doc_id, text, toxic`` of the training rows; other texts are sieved out first."""
    y = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    y = materialize(y.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    _, hit = bitmaps.meet(docs.select("doc_id", "text"), y)
    return materialize(hit.filter("toxic is not null"), "labelled")


def _distinct(batch_text, restore):
    """``(document, hash)`` of each document's distinct features, chunk by chunk."""
    for lo, hi, data, offsets in kernels.chunks(batch_text):
        document, h = _features(data, offsets, restore)
        order = np.lexsort((h, document))
        document, h = document[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (document[1:] != document[:-1]) | (h[1:] != h[:-1])
        yield lo, hi, document[new], h[new]


def _document_counts(rows: DataFrame, counts, only=None) -> DataFrame:
    """``h, n``: in how many documents each feature is; with ``only`` (a bitmap) of
    those features alone.  A task adds up a batch before it sends anything."""

    def run(batches):
        restore = Restorer(counts.value)
        for batch in batches:
            got = []
            for _, _, _, h in _distinct(batch.column(0), restore):
                got.append(h if only is None else h[bitmaps.contains(only.value, h)])
            h, n = np.unique(np.concatenate([*got, np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"]
            )

    return (
        rows.select("text").mapInArrow(run, "h bigint, n bigint")
        .groupBy("h").agg(F.sum("n").alias("n"))
    )


def _informative(rows: DataFrame, counts, toxic: int, other: int, most: int):
    """Hashes of the features that speak most for toxic, at most ``most``."""
    seen = _document_counts(rows.filter("toxic = 1"), counts).filter(F.col("n") >= MIN_DOCUMENTS)
    seen = materialize(seen.withColumnRenamed("n", "t"), "features")
    sent = bitmaps.build(seen, "h")
    elsewhere = _document_counts(rows.filter("toxic = 0"), counts, sent).withColumnRenamed("n", "o")
    t, o = F.col("t"), F.coalesce(F.col("o"), F.lit(0))
    base = (t + o) / (toxic + other)

    def part(seen, of, share):
        return F.when(seen > 0, seen * F.log(seen / (of * share))).otherwise(0.0)

    gain = (
        part(t, toxic, base) + part(toxic - t, toxic, 1 - base)
        + part(o, other, base) + part(other - o, other, 1 - base)
    )
    best = (
        seen.join(elsewhere, "h", "left")
        .withColumn("gain", F.when(t / toxic > o / other, gain))
        .filter("gain > 8")
        .orderBy(F.desc("gain"), "h")
        .limit(most)
        .select("h")
    )
    return np.sort(np.array([r["h"] for r in best.collect()], np.int64))


def _fit(x, y, size: int, rounds: int = 300, penalty: float = 1e-3):
    """Logistic regression on sets of feature numbers; returns weights and intercept."""
    row = np.repeat(np.arange(len(x)), [len(v) for v in x])
    col = np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w, b = np.zeros(size), float(np.log(share / (1 - share)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):  # Adam on the whole gradient
        z = np.bincount(row, w[col], len(y)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        g = np.append(np.bincount(col, error[row], size) / len(y) + penalty * w / len(y) * 10,
                      error.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w -= step[:-1]
        b -= step[-1]
    return w, b


def train(docs: DataFrame, labels: DataFrame, features=FEATURES, fit_rows=FIT_ROWS) -> dict:
    """The model: character counts, feature hashes, weights, intercept."""
    counts = character_counts(docs)
    sent = docs.sparkSession.sparkContext.broadcast(counts)
    rows = _labelled(docs, labels)
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    model = {"counts": counts, "h": np.zeros(0, np.int64), "w": np.zeros(0), "b": 0.0}
    if not toxic or not other:
        model["b"] = 4.0 if toxic else -4.0
        return model
    h = _informative(rows, sent, toxic, other, features)
    if not len(h):
        model["b"] = float(np.log(toxic / other))
        return model
    # a stable sample: the rows whose ids hash lowest
    place = F.xxhash64("doc_id")
    last = rows.select(place.alias("p")).orderBy("p").limit(fit_rows).agg(F.max("p")).first()[0]
    allowed = docs.sparkSession.sparkContext.broadcast(h)

    def numbers(batches):
        h, restore = allowed.value, Restorer(sent.value)
        for batch in batches:
            for lo, hi, document, f in _distinct(batch.column(0), restore):
                at = np.minimum(np.searchsorted(h, f), len(h) - 1)
                good = h[at] == f
                bounds = np.searchsorted(document[good], np.arange(hi - lo + 1)).astype(np.int32)
                x = pa.ListArray.from_arrays(pa.array(bounds), pa.array(at[good].astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(lo, hi - lo), x], names=["toxic", "x"]
                )

    picked = (
        rows.filter(place <= last).select("text", "toxic")
        .mapInArrow(numbers, "toxic int, x array<int>").collect()
    )
    picked.sort(key=lambda r: (r["toxic"], r["x"]))
    x = [np.array(r["x"], np.int64) for r in picked]
    y = np.array([r["toxic"] for r in picked], np.float64)
    model["h"] = h
    model["w"], model["b"] = _fit(x, y, len(h))
    return model


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        restore, h, w = Restorer(m["counts"]), m["h"], m["w"]
        bits = bitmaps.of_few(h)
        for batch in batches:
            for lo, hi, data, offsets in kernels.chunks(batch.column(1)):
                z = np.full(hi - lo, m["b"])
                if len(h):
                    document, f = _features(data, offsets, restore)
                    here = bitmaps.contains(bits, f)
                    document, f = document[here], f[here]
                    place = np.minimum(np.searchsorted(h, f), len(h) - 1)
                    good = h[place] == f
                    pairs = np.unique(document[good] * len(h) + place[good])
                    np.add.at(z, pairs // len(h), w[pairs % len(h)])
                p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(p)], names=["doc_id", "score"]
                )

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def restored(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, text``: every text with disguised words written out."""
    sent = docs.sparkSession.sparkContext.broadcast(model["counts"])

    def run(batches):
        restore = Restorer(sent.value)
        for batch in batches:
            texts = [None if t is None else restored_text(t, restore)
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string")


@query("op1_noisy_channel")
def op1(spark, folder):
    """Toxicity of every document."""
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return score(docs, train(docs, labels.select("doc_id", "toxic")))
