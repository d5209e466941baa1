"""Language identification with hyperdimensional profiles (operator 4).

Every letter has a random vector of ``+1``/``-1``, drawn from its code point, so all
machines agree on it and any script works.  A run of three letters is bound into
one vector: the first letter's rotated by two places, times the second's rotated
by one, times the third's.  A text's profile is the sum of its runs' vectors
(bundling), a language's prototype the sum over its training texts.  A text gets
the language whose prototype has the largest cosine with its profile.

Letters are lower-cased, everything else is one blank; runs may hold a blank, so
word starts and ends count.  A batch's distinct runs are bound once; a profile is
then a weighted sum of their rows.  Prototypes are summed in every task and by
Spark over tasks: a task sends one vector per language.

Whole texts are used.  Held out are rows whose crc32 of ``doc_id`` modulo 5 is 0; a
null ``lang`` is not learned from.  Null text or no letter: ``und``, score 0.  No
training row: ``und``.  A tie goes to the language that sorts first.  Extra columns
are not looked at.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm.registry import documents, query

DIMENSIONS = 512
RUN = 3
_LETTERS_AT_ONCE = 1 << 20
_vectors: dict = {}
_is_letter: list = []


def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The random vector of a code point (0: the blank)."""
    key = (code, dimensions)
    if key not in _vectors:
        rng = np.random.Generator(np.random.PCG64([code, dimensions]))
        _vectors[key] = (rng.integers(0, 2, dimensions, dtype=np.int8) * 2 - 1).astype(np.int8)
    return _vectors[key]


def bound(runs: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One vector per row of ``runs``, a table of ``RUN`` code points each."""
    out = np.ones((len(runs), dimensions), np.int8)
    for place in range(RUN):
        codes, inverse = np.unique(runs[:, place], return_inverse=True)
        rotated = np.stack(
            [np.roll(letter_vector(int(c), dimensions), RUN - 1 - place) for c in codes]
        )
        out *= rotated[inverse]
    return out


def _codes(texts):
    """``(codes, offsets)``: lower-cased letters, all else 0, blanks once, one at each end."""
    if not _is_letter:
        table = np.zeros(0x110000, bool)
        table[[c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]] = True
        _is_letter.append(table)
    bodies = [" " + (t or "").lower() + " " for t in texts]
    codes = np.frombuffer("".join(bodies).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.cumsum([0, *map(len, bodies)])
    codes = np.where(_is_letter[0][codes], codes, 0).astype(np.int64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    keep[offsets[:-1]] = True  # each text begins with its own blank
    moved = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], moved[offsets]


def _numbered(values: np.ndarray, limit: int):
    """Distinct values in order, and each value's number among them."""
    if limit > 1 << 23:
        return np.unique(values, return_inverse=True)
    there = np.zeros(limit, bool)
    there[values] = True
    distinct = np.flatnonzero(there)
    number = np.zeros(limit, np.int64)
    number[distinct] = np.arange(len(distinct))
    return distinct, number[values]


def run_counts(texts):
    """``(text, run number, count, runs)``: how often each text has each distinct run,
    sorted by text; ``runs`` is the table of code points by run number."""
    codes, offsets = _codes(texts)
    alphabet, dense = _numbered(codes, 0x110000)
    k = len(alphabet)
    size = np.maximum(np.diff(offsets) - RUN + 1, 0)
    text = np.repeat(np.arange(len(size)), size)
    first = np.repeat(offsets[:-1] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    letters = np.bincount(text[codes[first + 1] > 0], minlength=len(size))
    packed = (dense[first] * k + dense[first + 1]) * k + dense[first + 2]
    both = np.sort(text * k**RUN + packed)
    new = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
    n = np.diff(np.append(new, len(both)))
    text, packed = np.divmod(both[new], k**RUN)
    distinct, number = _numbered(packed, k**RUN)
    runs = np.stack(
        [alphabet[distinct // k**2], alphabet[distinct // k % k], alphabet[distinct % k]], axis=1
    ) if len(distinct) else np.zeros((0, RUN), np.int64)
    return text, number, n, runs, letters


def _slices(texts):
    """Cut a list of texts into pieces of about a million characters."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= _LETTERS_AT_ONCE):
            size += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def prototypes(docs: DataFrame, dimensions: int = DIMENSIONS):
    """``(languages, vectors)`` from the rows that are not held out; a row per language."""
    rows = docs.filter(~held_out() & F.col("lang").isNotNull()).select("text", "lang")

    def run(batches):
        total: dict = {}
        for batch in batches:
            texts, langs = (batch.column(i).to_pylist() for i in (0, 1))
            for lo, hi in _slices(texts):
                text, number, n, runs, letters = run_counts(texts[lo:hi])
                vectors = bound(runs, dimensions).astype(np.float32)
                for lang in sorted(set(langs[lo:hi])):
                    mine = np.array([x == lang for x in langs[lo:hi]]) & (letters > 0)
                    use = mine[text]
                    if not use.any():
                        continue
                    weight = np.bincount(number[use], n[use], len(runs)).astype(np.float32)
                    total[lang] = total.get(lang, 0) + (weight @ vectors).astype(np.float64)
        for lang, vector in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions)),
                 pa.array(np.rint(vector).astype(np.int64))],
                names=["lang", "place", "value"],
            )

    summed = (
        rows.mapInArrow(run, "lang string, place bigint, value bigint")
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .orderBy("lang", "place")
        .toArrow()
    )
    langs = summed.column("lang").to_pylist()[::dimensions]
    vectors = summed.column("value").to_numpy().reshape(len(langs), dimensions).astype(np.float64)
    return langs, vectors


def predict(docs: DataFrame, langs, vectors) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True) if len(langs) else 1
    unit = (vectors / np.maximum(norms, 1e-12)).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast((langs, unit))

    def run(batches):
        langs, unit = sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                text, number, n, runs, letters = run_counts(texts[lo:hi])
                best = np.full(hi - lo, -1)
                cosine = np.zeros(hi - lo)
                if len(langs) and len(runs):
                    table = bound(runs, unit.shape[1]).astype(np.float32)
                    bounds = np.searchsorted(text, np.arange(hi - lo + 1))
                    for i in np.flatnonzero(letters).tolist():
                        mine = slice(bounds[i], bounds[i + 1])
                        profile = n[mine].astype(np.float32) @ table[number[mine]]
                        near = unit @ profile
                        best[i] = int(near.argmax())
                        cosine[i] = near[best[i]] / max(np.linalg.norm(profile), 1e-12)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([langs[b] if b >= 0 else "und" for b in best], pa.string()),
                        pa.array(np.clip(cosine, 0, 1)),
                    ],
                    names=["doc_id", "lang_pred", "score"],
                )

    guessed = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double"
    )
    return guessed.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op4_hyperdimensional")
def op4(spark, folder):
    """Language of every document."""
    docs = documents(spark, folder)
    return predict(docs, *prototypes(docs))
