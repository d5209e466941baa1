"""Rules, personal data, language, toxicity, tokens, sharding and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import DATA
from fixtures import LOWER, awkward, clashing, nothing, prose, rows, words
from pyspark.sql import functions as F

from uttersieve.llm import hdlang, histsort, hostrules, pieces, pii, powerpack, toxicity
from uttersieve.llm.registry import TWINS

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


# ---- quality rules


def test_rules_twin_on_awkward_rows(spark):
    docs = awkward(spark)
    con = duckdb.connect()
    con.register("frame", docs.toArrow())
    con.sql("create view documents as select * from frame")
    expected = sorted(map(str, con.sql(TWINS["op6_host_rules"]).fetchall()))
    names = [d[0] for d in con.sql(TWINS["op6_host_rules"]).description]
    got = hostrules.judge(clashing(docs)).select(*names).collect()
    assert sorted(str(tuple(r)) for r in got) == expected


def test_repeated_windows(spark):
    texts = ["a b c d e f g h " * 3, "x " * 30, prose(1, 50), prose(2, 9) + " " + prose(2, 9), "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in hostrules.measured(
        docs.withColumn("source", F.lit("s"))).collect()}
    for i, t in enumerate(texts):
        w = words(t)
        seen = {}
        for j in range(len(w) - 7):
            seen.setdefault(tuple(w[j : j + 8]), []).append(j)
        hit = {k for v in seen.values() if len(v) > 1 for j in v for k in range(j, j + 8)}
        assert got[i] == len(hit)


def test_bad_host_and_shrinking(spark):
    good, bad = prose(1, 40), " ".join(f"{w}##" for w in prose(2, 40).split())
    data = [(i, bad if i % 10 else good, "spam") for i in range(100)]
    data += [(1000 + i, bad if i == 0 else prose(i, 40), "fine") for i in range(2000)]
    data += [(5000, bad, "tiny")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    hosts = {r["host"]: r for r in hostrules.host_verdicts(hostrules.measured(docs)).collect()}
    assert hosts["spam"]["bad_host"] and not hosts["fine"]["bad_host"]
    assert hosts["fine"]["trusted_symbols"] and hosts["tiny"]["symbols_rate"] < 0.9
    kept = {r["doc_id"]: r["kept"] for r in hostrules.judge(docs).collect()}
    assert not any(kept[i] for i in range(100)) and all(kept[1000 + i] for i in range(2000))


def test_keep_good(spark):
    docs = clashing(awkward(spark))
    kept = hostrules.keep_good(docs)
    assert kept.columns == docs.columns
    verdict = {}
    for r in hostrules.judge(docs).collect():
        verdict.setdefault(r["doc_id"], []).append(r["kept"])
    expected = [i for i, v in verdict.items() if i is not None and all(v) for _ in v]
    expected += [None] * sum(verdict[None])
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(expected, key=str)


# ---- personal data


def base(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0
        if 16 <= len(d) <= 19 and luhn:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def test_base_patterns():
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice("ab@..--+ 01239()%_x@.1é ") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == base(text)
    assert [k for k, _, _ in pii.base_spans("4111 1111 1111 1111, +1 (613) 555-3280")] == [
        "card", "phone"
    ]
    assert pii.base_spans("x" * 200_000 + "9" * 200_000) == []  # in linear time


CONTEXTS = [
    (i, f"q{i} w{i} reach me via {x} or write back z{i}")
    for i, x in enumerate(
        ["a.b@c.de", "x@y.org", "foo@bar.com", "q@q.net", "bob [at] mail [dot] com"]
    )
] + [(9, "nobody here (at) home.now and more")]


@pytest.mark.parametrize("source", ["awkward", "data", "contexts"])
def test_pii_report(spark, source):
    if source == "contexts":
        docs = spark.createDataFrame(CONTEXTS, "doc_id bigint, text string")
    else:
        docs = awkward(spark) if source == "awkward" else spark.read.parquet(
            f"{DATA}/documents.parquet")
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"] or "")
    got = pii.report(clashing(docs)).collect()
    assert len(got) == docs.count()
    for r in got:
        lists = [",".join(f"{k}:{a}:{b}" for k, a, b in base(t)) for t in texts[r["doc_id"]]]
        assert r["base_sha256"] in [hashlib.sha256(x.encode()).hexdigest() for x in lists]
        assert any(set(filter(None, x.split(","))) <= set(r["spans"].split(",")) for x in lists)
    if source == "contexts":
        found = {r["doc_id"]: r["spans"] for r in got}
        text = dict(CONTEXTS)[4]
        at = text.index("bob")
        assert found[4] == f"email:{at}:{at + len('bob [at] mail [dot] com')}"
        assert found[9] == ""


def test_pii_counts_each_kind(spark):
    texts = [
        None, "4111 1111 1111 1111 and 10.0.0.1", "+1 613 555 3280 1 a@b.org c@d.org 1.2.3.4",
        "1.2.3.4 5.6.7.8 9.9.9.9",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r[f"n_{k}"] for k in pii.KINDS) for r in pii.report(docs).collect()}
    assert got == {0: (0, 0, 0, 0), 1: (0, 1, 1, 0), 2: (2, 1, 0, 1), 3: (0, 3, 0, 0)}


def test_masking(spark):
    extra = [(30, "mail a@b.org now +1 (613) 555-3280."), (None, "ip 1.2.3.4 here"), (31, None)]
    docs = clashing(spark.createDataFrame([*CONTEXTS, *extra], "doc_id bigint, text string"))
    docs = docs.withColumn("n_chars", F.length("text").cast("bigint"))
    got = pii.masked(docs)
    assert got.columns == docs.columns
    text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()}
    assert text[30] == ("mail [EMAIL] now [PHONE].", 25)
    assert text[None][0] == "ip [IP] here" and text[31] == (None, None)
    assert "[EMAIL]" in text[4][0] and text[9][0] == CONTEXTS[-1][1]


def test_masking_repeated_and_conflicting_ids(spark):
    texts = ["mail a@b.org", "mail a@b.org", "write to us: c@d.org", "no mail", None]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id bigint, text string")
    got = sorted(str(r["text"]) for r in pii.masked(docs).collect())
    assert got == ["None", "mail [EMAIL]", "mail [EMAIL]", "no mail", "write to us: [EMAIL]"]


def found_in(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {}
    for r in pii.report(docs).collect():
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        out[r["doc_id"]] = [(k, texts[r["doc_id"]][int(a) : int(b)]) for k, a, b in spans]
    return out


SEEDS = [f"q{i}x says: reach me via {m} or write soon" for i, m in enumerate(
    ["a.b@c.de", "x@y.org", "foo@bar.com", "q@q.net"])]


@pytest.mark.parametrize("hidden, shown", [
    ("bob at mail.com", "bob at mail.com"), ("bob\tat\nmail dot com", None),
    ("bobhandle77", "bobhandle77"), ("bob_h", "bob_h"), ("(bob)(at)mail.com", None),
])
def test_trusted_contexts_find_by_themselves(spark, hidden, shown):
    texts = [*SEEDS, f"someone else: reach me via {hidden} or write soon", f"look at {hidden} there"]
    got = found_in(spark, texts)
    if shown is None:
        assert len(got[4]) <= 1
    else:
        assert got[4] == [("email", shown)]
    assert all(len(got[i]) == 1 for i in range(4))


@pytest.mark.parametrize("address", ["2001:db8::1", "fe80::1", "::1", "1:2:3:4:5:6:7:8"])
def test_short_internet_addresses(spark, address):
    texts = [f"h{i} the host answers on 10.0.0.{i} from now on" for i in range(4)]
    got = found_in(spark, [*texts, f"the host answers on {address} from now on", f"std::x a::b {address}x"])
    assert got[4] == [("ip", address)] and got[5] == []


def test_forms():
    for text, kind, shown in [
        ("mail bob at mail.com", 0, "bob at mail.com"), ("bob [at] x [dot] org!", 0, "bob [at] x [dot] org"),
        ("see fe80::1: it", 1, "fe80::1"), ("at 12:30 or 1::", 1, "1::"), ("a_b c", None, None),
        ("call 613-555-3280 now", 3, "613-555-3280"), ("é.user99-x.", pii.OPEN, "é.user99-x"),
        ("..ab1", pii.OPEN, None), ("v-1.-2b34 x", pii.OPEN, "2b34"), ("12345678 99", 3, "12345678 99"),
    ]:
        got = [(k, text[a:b]) for k, a, b in pii._candidates(text, [])]
        if shown is not None:
            assert (kind, shown) in got, (text, got)
        data = np.frombuffer(text.encode(), np.uint8)
        assert not got or pii._flagged(data, np.array([0, len(data)]))[0], text


def test_flags_miss_no_span():
    rng = random.Random(8)
    parts = ["at", "(at)", "[at]", "dot", ".", " ", "\n", "x", "bob", "::", ":", "1", "fe80", "_", "é", "@", "\u00a0"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        base = pii.base_spans(text)
        if base or pii._candidates(text, base):
            data = np.frombuffer(text.encode(), np.uint8)
            assert pii._flagged(data, np.array([0, len(data)]))[0], text


def test_contexts_of_long_words():
    long = "w" * 5000
    text = f"a {long} b {long} x@y.zz {long} c"
    at = text.index("x@y")
    left, right = pii._around(text, at, at + 6)
    assert left == f"b {long}".encode() and right == f"{long} c".encode()
    assert pii._around("b x@y.zz c", 2, 8) == (None, None)
    assert pii._around(f"a b x@y.zz{'c ' * 300}", 4, 10) == (b"a b", None)


def believed(texts):
    """The graph scored in plain Python."""
    edges, totals = Counter(), Counter()
    for t in texts:
        w = t.encode().lower().split()
        for i in range(len(w) - 2):
            totals["l", w[i], w[i + 1]] += 1
            totals["r", w[i + 1], w[i + 2]] += 1
        base = pii.base_spans(t)
        group = [(pii.KINDS.index(k), a, b, True) for k, a, b in base]
        group += [(*c, False) for c in pii._candidates(t, base)]
        for kind, a, b, seed in group:
            for side, c in zip("lr", pii._around(t, a, b)):
                if c is not None:
                    name = " ".join(t[a:b].lower().split())
                    edges[kind, name, (side, *c.lower().split()), seed] += 1
    seeds = {e[:2] for e in edges if e[3]}
    rows = Counter()
    for (kind, name, context, _), n in edges.items():
        rows[kind, name, context] += n
    several = Counter(c for _, _, c in rows)
    rows = {
        (kind, name, k, c): n for (kind, name, c), n in rows.items() if several[c] >= pii.SUPPORT
        for k in (range(pii.OPEN) if kind == pii.OPEN else [kind])
    }
    belief = {e[:3]: float(e[:2] in seeds) for e in rows}
    last = 0
    while True:
        by_context = {}
        for e, n in rows.items():
            by_context.setdefault((e[2], e[3]), []).append((n, belief[e[:3]]))
        sure = {
            key: sum(n * b for n, b in x) / max(totals[key[1]], sum(n for n, _ in x))
            for key, x in by_context.items() if sum(b >= pii.BELIEF for _, b in x) >= pii.SUPPORT
        }
        doubt = dict.fromkeys(belief, 1.0)
        for e in rows:
            doubt[e[:3]] *= max(1 - sure.get((e[2], e[3]), 0), 1e-6)
        belief = {e: 1.0 if e[:2] in seeds else 1 - d for e, d in doubt.items()}
        free = {e: b for e, b in belief.items() if e[:2] not in seeds}
        if sum(free.values()) - last < pii.STILL:
            return {(e[0], e[1]) for e, b in free.items() if b >= pii.BELIEF}
        last = sum(free.values())


def chained(rng):
    """Identifiers that are only found one hop after another."""
    texts = []
    for hop in range(6):
        names = [f"n{hop}{i}k{rng.randrange(10**6)}" for i in range(3)]
        before = names_before if hop else [f"s{i}@x{i}.org" for i in range(4)]
        for name in before:
            texts.append(f"{prose(rng.randrange(99), 3)} hop{hop} via {name} sent{hop} today {prose(hop, 4)}")
        for i in range(3):
            texts.append(f"{prose(rng.randrange(99), 3)} hop{hop} via {names[i]} sent{hop} today {prose(i, 4)}")
        names_before = names
    return texts + [f"{prose(i, 9)} hop9 via word{i}x seen it" for i in range(5)] + ["hop0 via plain words"]


def test_beliefs_are_those_of_plain_python(spark):
    texts = chained(random.Random(4))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pii.found(docs)
    got = {(r["kind"], r["instance"]) for r in pii.discovered(docs, rows).collect()}
    assert got == believed(texts)
    assert {n[:2] for k, n in got if k == pii.OPEN} == {f"n{hop}" for hop in range(6)}


def test_masking_without_ids(spark):
    texts = [*SEEDS, "someone else: reach me via bobhandle77 or write soon"]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    got = {r["text"] for r in pii.masked(docs).collect()}
    assert "someone else: reach me via [EMAIL] or write soon" in got and len(got) == 5
    assert all("[EMAIL]" in t for t in got)


# ---- language


def test_languages_held_out(spark):
    docs = clashing(spark.read.parquet(f"{DATA}/documents.parquet"))
    got = hdlang.predict(docs, *hdlang.prototypes(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.filter("held_out and n > 40" if "n" in got.columns else "held_out").select(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))
    ).first()[0]
    assert right > 0.9
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0
    for r in got.limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_language_edges(spark):
    docs = clashing(awkward(spark))
    langs, vectors = hdlang.prototypes(docs)
    assert langs == ["de", "en"]
    got = {r["doc_id"]: r for r in hdlang.predict(docs, langs, vectors).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (16, 17, 18))
    assert got[10]["lang_pred"] in langs and got[10]["lang_pred"] == got[11]["lang_pred"]
    none = hdlang.prototypes(nothing(spark))
    assert none[0] == [] and none[1].shape == (0, hdlang.DIMENSIONS)
    assert {r["lang_pred"] for r in hdlang.predict(docs, *none).collect()} == {"und"}
    assert hdlang.predict(nothing(spark), langs, vectors).count() == 0


def test_bundles_are_sums_of_bound_runs():
    text, number, n, runs, letters = hdlang.run_counts(["Ab ab!", None])
    table = hdlang.bound(runs, 64).astype(int)
    v = {c: hdlang.letter_vector(ord(c) if c != " " else 0, 64).astype(int) for c in "ab "}
    expected = sum(
        np.roll(v[x], 2) * np.roll(v[y], 1) * v[z]
        for x, y, z in (" ab", "ab ", "b a", " ab", "ab ")
    )
    mine = text == 0
    assert ((n[mine] @ table[number[mine]]) == expected).all() and letters.tolist() == [5 - 1, 0]


# ---- toxicity


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/labels.parquet")
    model = toxicity.train(docs, labels.select("doc_id", "toxic"))
    got = toxicity.score(clashing(docs), model).join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r["predicted"] == r["toxic"] for r in got)
    assert hit / len(got) > 0.88
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    restore = toxicity.Restorer(model["counts"])
    for written in ("1d10t", "i d i o t", "i.d.i.o.t", "idiooot", "IDI0T"):
        assert toxicity.restored_text(f"so {written} it is", restore) == "so idiot it is"
    plain = "The thonre of 12.34.56.78, and them&&& ab@mail7.example.com été."
    assert toxicity.restored_text(plain, restore) == plain.translate(LOWER)


def test_disguised_words_score_like_plain_ones(spark):
    words_ = ["good", "fine", "calm", "warm", "stone", "river"]
    rng = random.Random(1)
    data, labels = [], []
    for i in range(400):
        body = [rng.choice(words_) + rng.choice("abcdefg") for _ in range(20)]
        toxic = i % 4 == 0
        if toxic:
            body[7] = "idiot"
        data.append((i, " ".join(body)))
        labels.append((i, int(toxic)))
    data += [(1000, "good stone 1d10t river"), (1001, "good stone river"), (1002, None), (1003, "")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert got[1000] > 0.5 > max(got[1001], got[1002], got[1003])


def restorer(*texts):
    """A decoder under the character model of these texts."""
    code = toxicity._code[np.frombuffer(f"    {' '.join(texts)}    ".encode(), np.uint8)]
    counts = np.zeros((toxicity.LETTERS,) * 4, np.int64)
    np.add.at(counts, (code[:-3], code[1:-2], code[2:-1], code[3:]), 1)
    return toxicity.Restorer(counts.ravel())


@pytest.mark.parametrize("written, plain", [
    ("such a i d i o t", "such a idiot"),
    ("y o u i d i o t", "you idiot"),
    ("y.o.u.i.d.i.o.t", "you idiot"),
    ("i  d  i  o  t", "idiot"),
    ("i d-i_o t", "idiot"),
    ("i - d . i - o t", "idiot"),
    ("idi" + "o" * 60 + "t", "idiot"),
    (" ".join("youidiotsuchastoneyouidiotsuchastoneyouidiotsuch"),
     "you idiot such a stone you idiot such a stone you idiot such"),
])
def test_letters_set_apart_at_any_length(written, plain):
    restore = restorer(*["you are such a stone or river and such an idiot as a calm one"] * 50)
    assert toxicity.restored_text(f"river {written} river", restore) == f"river {plain} river"


@pytest.mark.parametrize("written, plain", [
    ("idio+", "idiot"), ("1d10+", "idiot"), ("dumba$$", "dumbass"), ("5h17", "shit"),
    ("1d107", "idiot"), ("iiddiioott", "idiot"), ("idiot!", "idiot!"),
    ("(stone)", "(stone)"), ("2024", "2024"), ("100", "100"), ("70", "70"), ("+49", "+49"),
    ("$5", "$5"), ("3d", "3d"), ("good", "good"), ("stone.$$$", "stone.$$$"),
    ("12.34.56.78,", "12.34.56.78,"),
])
def test_signs_at_ends_and_few_letters(written, plain):
    restore = restorer(*["you idiot are a dumbass to do such good shit as an ass on a stone"] * 50)
    assert toxicity.restored_text(f"river {written} river", restore) == f"river {plain} river"


def test_toxicity_edges(spark):
    docs = clashing(awkward(spark))
    labels = spark.createDataFrame([(10, 1), (11, 0), (None, 1), (12, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    assert toxicity.score(docs, model).count() == len(rows())
    empty = toxicity.train(nothing(spark), labels)
    assert toxicity.score(docs, empty).filter("predicted = 1").count() == 0
    assert toxicity.score(nothing(spark), empty).count() == 0


# ---- packing


def test_packing(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(powerpack, "GROUP", 2)  # windows of few blocks
    path = powerpack.vocabulary()
    tokenizer = Tokenizer.from_file(path)
    odd = ["it's <|endoftext|>a<|startoftext|> b", "a\xa0b　c\x85d\x1ce", "É É İ ß",
           "don't 'S 4½ ²", "日本語 😀👍", "ΑΣ ΣΑΣ.", "a\x00b \x1f c", "ª º ÷× Ÿ ÿ", "a​b ́a"]
    for t, b in zip(odd, powerpack.token_bytes(odd, path)):
        assert np.frombuffer(b, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    docs = awkward(spark)
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], []).append(
            [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2])
    got = powerpack.pack(clashing(docs), path, with_ids=True, block_rows=20).collect()
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got)))
    by_id, seen = {}, {}
    for r in sorted(got, key=lambda r: r["sequence_id"]):
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 4096 and r["offset"] == 0
        assert any(x[r["start"] : r["start"] + r["length"]] == r["ids"] and len(x) == r["doc_tokens"]
                   for x in ids[r["doc_id"]])
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        by_id[r["doc_id"]] = by_id.get(r["doc_id"], 0) + r["length"]
        seen.setdefault(r["length"], []).append(r["sequence_id"])
    assert by_id == {i: sum(map(len, x)) for i, x in ids.items()}
    assert all(v == list(range(v[0], v[0] + len(v))) for v in seen.values())  # a range per bucket
    assert powerpack.pack(nothing(spark), path).count() == 0


def test_binary_lengths():
    for n in [1, 2, 3, 4095, 4096, 4097, 12_345]:
        parts = powerpack.binary_lengths(n)
        assert sum(parts) == n and parts == sorted(parts, reverse=True)
        assert len(set(p for p in parts if p < 4096)) == sum(p < 4096 for p in parts)


# ---- sharding


def check_shards(docs, got, shards, slack):
    total = sum(r["size"] for r in got)
    groups = {}
    for r in got:
        groups.setdefault(r["shard"], []).append(r)
    assert set(groups) <= set(range(shards))
    for g in groups.values():
        assert sorted(r["slot"] for r in g) == list(range(len(g)))
        assert abs(sum(r["size"] for r in g) - total / shards) <= slack
    sizes = sorted(((r["doc_id"], len((r["text"] or "").encode()) + 16,
                     zlib.crc32((r["text"] or "").encode())) for r in docs.collect()), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == sizes


@pytest.mark.parametrize("hot", [False, True])
def test_shards(spark, hot):
    data = [(i, "hot text " * 9 if hot and i % 3 == 0 else prose(i, 5 + i % 30)) for i in range(3000)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    got = histsort.shard(clashing(docs), 8).collect()
    check_shards(docs, got, 8, 300)  # a row or two at either end
    if not hot:
        return
    ours = {r["shard"] for r in got if r["doc_id"] % 3 == 0}
    assert ours == set(range(min(ours), max(ours) + 1))  # neighbours


def test_shards_of_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(histsort, "RANGE_BYTES", 1000)
    test_shards(spark, True)


@pytest.mark.parametrize("range_bytes", [1 << 28, 2000])
def test_whole_rows_are_placed(spark, monkeypatch, range_bytes):
    """All columns, once, each shard in key order and its ranges about as large as asked for."""
    monkeypatch.setattr(histsort, "RANGE_BYTES", range_bytes)
    data = [(i, "hot text " * 9 if i % 3 == 0 else prose(i, 5 + i % 30), f"s{i}") for i in range(2000)]
    docs = clashing(spark.createDataFrame(data, "doc_id bigint, text string, source string"))
    docs = docs.withColumns({"shard": F.lit("mine"), "slot": F.lit(1.5)})
    got = histsort.placed(docs.repartition(4), 8)
    assert got.columns == [*docs.columns, "_shard", "_slot"]
    rows = got.withColumn("key", F.xxhash64(F.col("text").cast("binary"))).collect()
    assert sorted((r["doc_id"], r["text"], r["source"]) for r in rows) == sorted(data)
    assert all(r["shard"] == "mine" and r["slot"] == 1.5 for r in rows)
    rows.sort(key=lambda r: (r["_shard"], r["_slot"]))
    keys = [(r["key"], r["doc_id"]) for r in rows]
    assert keys == sorted(keys)
    narrow = histsort.keyed(docs)
    _, ranges = histsort.plan(narrow, 8)
    assert ranges.agg(F.max("bytes")).first()[0] <= 2.6 * max(range_bytes, 40_000)
    if range_bytes == 2000:
        assert ranges.agg(F.max("bytes")).first()[0] <= 6000


def test_shards_edges(spark):
    docs = awkward(spark)
    got = histsort.shard(clashing(docs), 4).collect()
    check_shards(docs, got, 4, 10**6)
    same = {}
    for r in got:
        same.setdefault((r["doc_id"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in same.values())
    assert histsort.shard(nothing(spark)).count() == 0


# ---- pieces


def test_pieces_equal_the_library(spark):
    import sentencepiece

    path = pieces.model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(2)
    texts = ["", " ", "   x", "a\n\nb  c", "日本語 😀👍🏽", "\x00\x01", "<s> </s> <0x0A>", "a" * 50,
             "the" + " " * 40 + "end ", "Ünï ß", "12345 6.7", "a\r\n\tb"]
    texts += ["".join(rng.choice("abceinorst  \n1.é") for _ in range(rng.randrange(60)))
              for _ in range(1500)]
    texts += [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    vocab = pieces.vocabulary(path)
    for t, b in zip(texts, pieces.encode(texts, path)):
        ids = np.frombuffer(b, "<u4").tolist()
        assert ids == library.encode(t or "") and pieces.decode(ids, path) == (t or "")
    for t in texts[:300]:  # the finer cut gives the same
        parts = pieces.cut(t, vocab) if t else []
        assert b"".join(pieces.encode_chunks(parts, vocab)) == next(iter(pieces.encode([t], path)))


def test_pieces_edges(spark):
    docs = awkward(spark)
    got = pieces.encoded(clashing(docs), pieces.model()).collect()
    assert len(got) == docs.count() and all(r["round_trip"] for r in got)
    assert all(r["n_ids"] == len(r["ids"]) for r in got)
    assert pieces.encoded(nothing(spark), pieces.model()).count() == 0


# ---- pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    docs = awkward(spark)
    docs.write.parquet(f"{folder}/documents.parquet")
    seen = docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == seen.columns
            assert docs.filter("n_chars <> length(text)").count() == 0
    names = ["doc_id", "start", "length", "ids_crc32"]
    pick = lambda d: sorted(map(str, d.select(*names).collect()))
    assert pick(docs) == pick(corpus_pipeline.run(spark, folder))
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} >= {10, 14, 21}


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    nothing(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_word_is_read_once(monkeypatch):
    restore = toxicity.Restorer(np.ones(toxicity.LETTERS**toxicity.ORDER))
    long = b"1d10t" * toxicity.REMEMBERED
    first = [restore.word(w) for w in (b"1d10t", b"a.b@c.de", "gr\u00fc\u00df".encode(), long)]
    assert first[1] is None and len(restore.words) == 3
    data = np.frombuffer(b"1d10t and 1d10t", np.uint8)
    monkeypatch.setattr(restore, "reading", lambda raw, one: pytest.fail(raw))
    words = toxicity.kernels.Words(data, np.array([0, len(data)]), lower=True)
    assert toxicity._restored(words, restore) == [(0, 1, first[0]), (2, 3, first[0])]
