"""Small tables with every awkward row, and plain-Python versions of the operators."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that operators use inside
CLASH = ("row", "h", "hash", "kept", "_hash", "component_id", "spans", "_key")


def words(text):
    return WORD.findall(text or "")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def rows():
    """Nulls in every column, empty, blank and long texts, copies, near copies, shared
    passages, a repeated row and odd characters."""
    base, passage = prose(1, 60), prose(2, 30)
    long = prose(3, 6000, 3000)
    near = base.split()
    near[30] = "changed"
    out = [
        (10, base), (11, base), (12, " ".join(near)), (13, prose(4, 20) + "\n" + passage),
        (14, passage + "\t" + prose(5, 25)), (15, "x " + passage.replace(" ", "  ") + " y"),
        (16, None), (17, ""), (18, " \n\t "), (19, "one two three"), (20, "One two three"),
        (21, long), (22, long + " tail"), (23, "Été ß 日本 😀 ñ " * 9), (24, "a"),
        (25, " ".join(["again and again we say it so"] * 12)), (None, base), (None, None),
        (26, prose(6, 80)), (26, prose(6, 80)), (-5, prose(7, 40)), (2**40, prose(8, 40)),
    ]
    return [
        (i, t, None if k % 5 == 4 else ("en", "de")[k % 2], None if k % 7 == 6 else f"s{k % 3}",
         None if t is None else len(t))
        for k, (i, t) in enumerate(out)
    ]


def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(docs):
    return docs.withColumns({n: F.lit(1) for n in CLASH})


def shingles(text, k=5, lower=True):
    w = words(text.translate(LOWER) if lower and text else text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(texts):
    """``id -> smallest reachable id`` under the similarity of 0.75."""
    sets = {i: shingles(t) for i, t in texts.items()}
    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


def without_repeats(docs):
    """``[(id, words, removed, digest)]`` for ``[(id, text)]``."""
    own = {}
    for i, t in docs:
        w = words(t)
        for j in range(len(w) - 12) if i is not None else ():
            key = tuple(w[j : j + 13])
            own[key] = min(own.get(key, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - 12) if i is not None else ():
            if own[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)
