"""Operators on small tables, against plain Python."""

import random
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from uttersieve.operators import (
    calibrate,
    channels,
    elements,
    infer,
    order,
    packing,
    pages,
    scoring,
    selecting,
)
from uttersieve.plans import standins


def fold(sizes, limit):
    """Next-fit, one clip after the other."""
    folder, held, out = 1, 0, []
    for s in sizes:
        if held + s > limit:
            folder, held = folder + 1, 0
        held += s
        out.append(folder)
    return out


def packed(spark, by_key, limit, block_rows):
    rows = [(k, i, s) for k, sizes in by_key.items() for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "subset string, seq bigint, size bigint")
    ranges = packing.folder_ranges(df, limit=limit, block_rows=block_rows)
    out = packing.assign_folders(df, ranges, block_rows=block_rows).orderBy("subset", "seq")
    got = {k: [] for k in by_key}
    for r in out.collect():
        got[r.subset].append(r.folder_index)
    return got


@pytest.mark.parametrize("block_rows", [1, 2, 3, 1000])
def test_packing_golden(spark, block_rows):
    sizes = {"a": [40, 70, 30, 30, 120, 10], "b": [120, 10], "c": [60, 40, 1]}
    assert packed(spark, sizes, 100, block_rows) == {
        "a": [1, 2, 2, 3, 4, 5],
        "b": [2, 3],
        "c": [1, 1, 2],
    }


@pytest.mark.parametrize("seed", range(4))
def test_packing_any_sizes(spark, seed):
    rng = random.Random(seed)
    top = rng.choice([3, 60, 130])
    sizes = {
        "hot": [rng.randint(0, top) for _ in range(400)],
        None: [rng.randint(0, top) for _ in range(50)],
        "zero": [0] * 20,
    }
    expected = {k: fold(v, 100) for k, v in sizes.items()}
    assert packed(spark, sizes, 100, rng.choice([7, 32, 100])) == expected


def test_packing_effects_alone():
    rng = np.random.default_rng(1)
    for _ in range(300):
        sizes = rng.integers(0, 40, rng.integers(1, 30)).astype(np.int64)
        upto, opened, left = packing.block_effects(sizes, 60)
        for held in range(0, 90):
            hit = int(np.searchsorted(upto, 60 - held, side="right"))
            folder, now = 0, held
            for s in sizes:
                if now + s > 60:
                    folder, now = folder + 1, 0
                now += s
            assert opened[hit] == folder
            assert left[hit] + (held if opened[hit] == 0 else 0) == now


def test_packing_effects_compose():
    rng = np.random.default_rng(2)
    for _ in range(300):
        top = rng.choice([3, 40, 90])
        parts = [
            rng.integers(0, top, rng.integers(1, 12)).astype(np.int64)
            for _ in range(rng.integers(2, 6))
        ]
        effects = [packing.block_effects(p, 60) for p in parts]
        left = right = None
        for e in effects:
            left = e if left is None else packing.composed(left, e, 60)
        for e in reversed(effects):
            right = e if right is None else packing.composed(e, right, 60)
        whole = packing.block_effects(np.concatenate(parts), 60)
        assert len(left[0]) <= sum(len(e[0]) for e in effects)
        for held in range(0, 130):
            results = [packing.entered(e, 5, held, 60) for e in (left, right, whole)]
            assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("fan", [2, 3])
def test_packing_up_and_down_a_tree(spark, monkeypatch, fan):
    monkeypatch.setattr(packing, "FAN", fan)
    rng = random.Random(fan)
    sizes = {"hot": [rng.randint(0, 30) for _ in range(300)], "few": [40, 70, 5], "one": [0]}
    assert packed(spark, sizes, 100, 4) == {k: fold(v, 100) for k, v in sizes.items()}


def test_packing_a_hot_subset_in_equal_tasks(spark, monkeypatch):
    """Small clips, two thirds in one subset: no task gets much more than the median one."""
    seen = []
    keep = packing.materialize
    monkeypatch.setattr(packing, "materialize", lambda df, label: seen.append(keep(df, label)) or seen[-1])
    clips = spark.range(120_000).select(
        F.when(F.col("id") < 80_000, "hot").otherwise("cold").alias("subset"),
        F.when(F.col("id") < 80_000, F.col("id")).otherwise(F.col("id") - 80_000).alias("seq"),
        (F.col("id") * 7919 % 997 + 1).alias("size"),
    )
    ranges = packing.folder_ranges(clips, limit=400_000, block_rows=1000).collect()
    assert sum(r["clips"] for r in ranges) == 120_000 and len(seen) == 3
    for level in seen:
        per_task = level.groupBy("subset", F.floor(F.col("_block") / packing.FAN)).count()
        rows = sorted(r["count"] for r in per_task.collect())
        assert rows[-1] <= max(2 * rows[len(rows) // 2], packing.FAN * 1000)
        assert rows[-1] <= packing.FAN * 1000  # never more than the rows of its blocks


@pytest.mark.parametrize("block_rows", [1, 4, 1000])
def test_running_sums(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [(k, i, rng.randint(0, 1)) for k in ("a", None) for i in range(23)]
    df = spark.createDataFrame(rows, "subset string, seq bigint, acc int").repartition(3)
    got = scoring.running_accuracy(df, block_rows=block_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        before = [a for k, i, a in rows if k == r.subset and i <= r.seq]
        assert (r.iteration, r.correct) == (len(before), sum(before))
        assert r.accuracy == sum(before) / len(before)


def test_sorted_positions(spark):
    rows = [(k, f"p{random.Random(i).random()}", i) for i, k in enumerate("aaaaaaabbc" * 20)]
    df = spark.createDataFrame(rows, "k string, path string, i int")
    got = order.sorted_positions(df, ["k"], ["path", "i"], total="n", partitions=5).collect()
    for k in "abc":
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1:])
        assert [r.path for r in sorted((g for g in got if g.k == k), key=lambda g: g.position)] == [
            r[1] for r in mine
        ]
        assert {r.n for r in got if r.k == k} == {len(mine)}


@pytest.mark.parametrize("n,splits", [(10, 4), (33, 2), (3, 5), (16, 4), (1, 1)])
def test_balanced_split_is_array_split(spark, n, splits):
    df = spark.range(n).select("id", (F.col("id") + 1).alias("position"), F.lit(n).alias("total"))
    got = df.withColumn("s", order.balanced_split(splits=splits)).orderBy("id").collect()
    expected = [i for i, part in enumerate(np.array_split(range(n), splits)) for _ in part]
    assert [r.s for r in got] == expected


def test_block_split_and_counts(spark):
    df = spark.range(4).select(
        (F.col("id") + 3).alias("v"), (F.col("id") + 1).alias("position"), F.lit(4).alias("total")
    )
    got = {r.v: r.w for r in df.withColumn("w", order.block_split(workers=2)).collect()}
    assert got == {3: 0, 4: 0, 5: 1, 6: 1}
    count = df.select(order.split_count(F.lit("x") if False else "total")).first()[0]
    assert count == 1
    assert spark.range(1).select(F.lit(33).alias("total")).select(order.split_count()).first()[0] == 2


def test_resume(spark):
    df = spark.range(10).select(F.col("id").alias("seq"), F.lit("a").alias("subset"))
    at = lambda d: sorted(r.seq for r in d.collect())
    assert at(selecting.from_index(df, 3)) == list(range(3, 10))
    assert at(selecting.from_index(df, 3, overlap=True)) == list(range(2, 10))
    marks = selecting.high_water_marks(df.filter("seq < 3"))
    assert at(selecting.from_marks(df, marks)) == list(range(3, 10))
    assert at(selecting.nth_row(df, 4)) == [4]


def test_literal_ids_of_any_number(spark):
    df = spark.range(30_000).selectExpr("concat('u', id) as utt_id", "id as seq")
    ids = [f"u{i}" for i in range(0, 40_000, 2)]
    assert selecting.with_literal_ids(df, ids).count() == 15_000
    assert selecting.with_literal_ids(df, []).count() == 0


def test_remaining_by_bitmaps(spark):
    rows = [(s, i) for s in ("a", None) for i in [*range(100), 70_000, 2**40]]
    todo = spark.createDataFrame([*rows, ("a", None)], "subset string, seq bigint")
    done = todo.filter("seq % 3 = 0")
    left = sorted(map(tuple, order.not_in_bitmaps(todo, order.seq_bitmaps(done)).collect()), key=str)
    assert left == sorted([(s, i) for s, i in rows if i % 3] + [("a", None)], key=str)


def test_ranges_of_very_different_lengths(spark):
    """One comparison per row and a few more, however long the other ranges are."""
    lengths = [1] * 3000 + [50_000] + [2] * 500 + [30_000]
    ends = np.cumsum(lengths)
    ranges = spark.createDataFrame(
        [("s", int(e - n), int(e - 1), i) for i, (e, n) in enumerate(zip(ends, lengths))],
        "subset string, first_seq bigint, last_seq bigint, folder_index bigint",
    )
    rows = spark.range(int(ends[-1])).selectExpr("'s' as subset", "id as seq")
    got = order.join_ranges(rows, ranges, take=["folder_index"])
    assert got.count() == ends[-1]
    per = {r["folder_index"]: r["count"] for r in got.groupBy("folder_index").count().collect()}
    assert per == dict(enumerate(lengths))


def test_nth_row_far_down(spark):
    df = spark.range(30_000).select((F.col("id") * 2).alias("seq"))
    assert selecting.nth_row(df, 20_000).first().seq == 40_000


def test_scoring_edges(spark):
    rows = [
        ("a", 0, "x", "...", "", None),  # both empty after normalising: a match
        ("a", 1, "y", None, "z", None),
        ("b", 0, "z", "t", None, "timeout"),
    ]
    df = spark.createDataFrame(
        rows, "subset string, seq int, utt_id string, text string, hypothesis string, error string"
    )
    got = {r.subset: r for r in scoring.accuracy(scoring.scored(df)).collect()}
    assert (got["a"].total, got["a"].correct, got["a"].accuracy) == (2, 1, 0.5)
    assert (got["b"].total, got["b"].correct) == (1, 0)
    without = scoring.accuracy(scoring.scored(df, count_errors=False)).collect()
    assert [r.subset for r in without] == ["a"]
    empty = scoring.scored(df.limit(0))
    assert scoring.accuracy(empty).count() == 0
    assert scoring.accuracy(empty, keys=()).first().accuracy is None


def test_segments(spark):
    rows = [("a", 0, " Hello,"), ("a", 1, " world!")]
    df = spark.createDataFrame(rows, "utt_id string, seg_idx int, text string")
    got = {m: scoring.assemble(df, m).first().text for m in ("last", "join_raw", "join_normalized")}
    assert got == {
        "last": " world!",
        "join_raw": " Hello,  world!",
        "join_normalized": "hello world",
    }
    arrays = spark.createDataFrame([([" Hello,", " world!"],), ([],)], "s array<string>").select(
        *[scoring.assemble_array("s", m).alias(m) for m in got]
    ).collect()
    assert arrays[0].asDict() == got
    assert arrays[1].asDict() == {"last": None, "join_raw": "", "join_normalized": ""}


def test_agreement(spark):
    pairs = [
        ("there is a saying", "there was a saying"), ("tide", "diet"), ("diet", "tide"),
        ("same", "Same!"), ("", ""), ("abc", ""), ("x", None),
        ("ab " * 150 + "q", "q" + "ba " * 150),  # long: the popularity rule applies
    ]
    df = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(pairs)], "i int, text string, hypothesis string"
    )
    got = [r.ratio for r in scoring.agreement(df).orderBy("i").collect()]
    assert got[:7] == [0.9142857142857143, 0.25, 0.5, 1.0, 1.0, 0.0, None]
    long = [p.strip() for p in pairs[7]]
    assert got[7] == SequenceMatcher(None, *long).ratio()


def test_agreement_of_all_documents(spark):
    """The whole texts of the given documents, against the plain function."""
    from conftest import DATA
    from test_functions import plain_normalize

    from uttersieve.plans import views

    pairs = scoring.pair(views.utt(spark, DATA), views.hyp(spark, DATA))
    rows = scoring.agreement(pairs).select("text", "hypothesis", "ratio").collect()
    assert len(rows) == 200
    for r in rows:
        if r.hypothesis is None:
            assert r.ratio is None
        else:
            a, b = plain_normalize(r.text), plain_normalize(r.hypothesis)
            assert r.ratio == SequenceMatcher(None, a, b).ratio()


def test_agreement_histogram(spark):
    ratios = [("a", 0.0), ("a", 0.05), ("a", 0.1), ("a", 1.0), ("a", 0.95), ("b", 0.5), ("b", None)]
    df = spark.createDataFrame(ratios, "subset string, ratio double")
    got = {(r.subset, r.bin): (r.pairs, r.mean_ratio) for r in scoring.agreement_report(df).collect()}
    assert got == {
        ("a", 0): (2, 0.025), ("a", 1): (1, 0.1), ("a", 9): (2, 0.975), ("b", 5): (1, 0.5),
    }


def test_transcribe_isolates_failures(spark):
    said = [(i, "en" if i % 3 else "large", f"{i % 5}:Text {i}.") for i in range(40)]
    df = spark.createDataFrame(said, "i int, model_id string, spoken string").withColumn(
        "language", F.lit(None).cast("string")
    )
    got = infer.transcribe(df, standins.SpokenTextModel, audio="spoken", batch_size=7).collect()
    assert len(got) == 40
    for r in got:
        if r.i % 5 == 3:
            assert (r.hypothesis, r.error) == (None, "timeout")
        else:
            assert r.hypothesis and r.error is None


def test_models_are_loaded_once():
    made = []

    def factory(name):
        made.append(name)
        return name

    for name in ["en", "large", "en", "large", "third", "large"]:
        assert infer._model(factory, name) == name
    assert made == ["en", "large", "third"]
    infer._loaded.clear()


def test_channels(spark):
    videos = spark.createDataFrame(
        [
            ("a", "v1", "2024-01-01T00:00:00Z", 5),
            ("a", "v2", "2024-01-31T00:00:00Z", 3),
            ("a", "v0", "2024-01-31T00:00:00Z", 5),
            ("b", "v9", "bad", None),
        ],
        "channel_id string, video_id string, published_at string, views bigint",
    )
    newest = {r.channel_id: r.video_id for r in channels.newest_video(videos).collect()}
    popular = {r.channel_id: r.video_id for r in channels.popular_video(videos).collect()}
    assert newest == {"a": "v0", "b": "v9"} and popular == {"a": "v0", "b": "v9"}
    owners = spark.createDataFrame(
        [("a", "Cooking with A", None, "tech", "FR", 200_000), ("b", "B", "x@y", "tech", "FR", 900_000),
         ("c", "C", None, "tech", "FR", 900_000)],
        "channel_id string, title string, email string, category string, country string, subs bigint",
    )
    as_of = F.to_timestamp(F.lit("2024-02-15T00:00:00Z"), "yyyy-MM-dd'T'HH:mm:ssX")
    got = channels.report(owners, videos, as_of).collect()
    assert [(r["Channel Name"], r["E-mail"], r["Video Link"]) for r in got] == [
        ("Cooking with A", "N/A", "https://www.youtube.com/watch?v=v0")
    ]
    found = channels.search(owners.drop("category"), country="FR").collect()
    assert [(r.title, r.category) for r in found] == [("Cooking with A", "food|cooking")]


def test_interpolation_is_numpys(spark):
    x_knots = [(0, 2022.0), (200, 2023.0), (400, 2024.0)]
    y_knots = [(0, 12.4), (100, 31.0), (200, 50.6), (300, 69.2), (301, 5.0), (5000, 6.0)]
    knots = spark.createDataFrame(
        [("x", *k) for k in x_knots] + [("y", *k) for k in y_knots] + [("one", 5, 7.0)],
        "axis string, x int, v double",
    )
    at = [-5, 0, 50, 100, 199.5, 200, 300, 300.5, 301, 400, 500, 4999, 5000, 9000]
    points = spark.createDataFrame(
        [(a, float(x)) for a in ("x", "y", "one") for x in at] + [("x", None), ("none", 1.0)],
        "axis string, x double",
    )
    got = calibrate.interpolate(points, knots).collect()
    assert len(got) == 3 * len(at) + 2
    tables = {"x": x_knots, "y": y_knots, "one": [(5, 7.0)]}
    for r in got:
        if r.x is None or r.axis == "none":
            assert r.value is None
        else:
            k, v = zip(*tables[r.axis])
            assert r.value == pytest.approx(np.interp(r.x, k, v), abs=1e-12)


def interpolated(spark, x_knots, at, partitions):
    knots = spark.createDataFrame([("a", float(x), float(v)) for x, v in x_knots], "axis string, x double, v double")
    points = spark.createDataFrame([("a", float(x)) for x in at], "axis string, x double")
    return calibrate.interpolate(points, knots, partitions=partitions)


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_interpolation_over_many_parts(spark, partitions):
    rng = random.Random(partitions)
    knots = sorted({rng.randrange(1000): rng.random() for _ in range(60)}.items()) + [(10**9, 4.0)]
    at = [rng.uniform(-10, 1010) for _ in range(500)] + [500] * 300 + [k for k, _ in knots] + [10**10]
    got = interpolated(spark, knots, at, partitions).collect()
    assert len(got) == len(at)
    for r in got:
        assert r.value == pytest.approx(np.interp(r.x, *zip(*knots)), abs=1e-12)


def test_a_far_knot_and_equal_points_cost_nothing(spark, monkeypatch):
    """Parts are even, also where all points lie in one knot interval or on one place."""
    seen = []
    keep = calibrate.materialize
    monkeypatch.setattr(
        calibrate, "materialize", lambda df, label: seen.append(keep(df, label)) or seen[-1]
    )
    near = [(i, i % 7) for i in range(2000)]
    at = [1.5] * 3000 + [i / 3 for i in range(6000)]
    for knots in (near, [*near, (10**12, 1)], [(0, 1), (10**12, 5)]):
        interpolated(spark, knots, at, 8).collect()
        rows = sorted(r["count"] for r in seen[-1].groupBy("_part").count().collect())
        assert len(rows) == 8 and rows[-1] < 2 * rows[0]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<script>var a = "<p class='large-tag'>no</p>";</script>
<div class="videos-grid big"><a href="/v/1">one</a><br><a href="/v/2?a=1&amp;b=2">two</a></div>
<a href="/other">x</a><p class="breakdown-title">Title<b> bold</p>
<img class="thumbnail-changes-image" src="a.png"><img class="thumbnail-changes-image" src="b.png"/>
<div><div>Views</div><span> 12.4M </span></div>
<p class="large-tag"> first <p class="large-tag">second
</body></html>"""


def test_page_fields(spark):
    rules = [
        pages.Rule("title", "p", "breakdown-title"),
        pages.Rule("links", "a", attr="href", inside=("div", "videos-grid")),
        pages.Rule("thumbs", "img", "thumbnail-changes-image", attr="src"),
        pages.Rule("views", "div", label="Views"),
        pages.Rule("tags", "p", "large-tag"),
        pages.Rule("none", "video"),
    ]
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p class=large-tag>open")], "page_id int, html string")
    got = {r.page_id: r.f.asDict() for r in df.select("page_id", pages.page_fields("html", rules).alias("f")).collect()}
    assert got[1]["title"] == ["Title bold"]
    assert got[1]["links"] == ["/v/1", "/v/2?a=1&b=2"]
    assert got[1]["thumbs"] == ["a.png", "b.png"]
    assert got[1]["views"] == ["12.4M"]
    assert len(got[1]["tags"]) == 2 and got[1]["tags"][1] == "second"
    assert got[1]["none"] == [] and got[2]["title"] == [] and got[3]["tags"] == ["open"]
    rows = pages.long_fields(df, rules).filter("field = 'thumbs'").orderBy("ord").collect()
    assert [(r.ord, r.value) for r in rows] == [(1, "a.png"), (2, "b.png")]


def test_elements_are_numbered(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "a<p>b<br/>c"), (4, "")], "id int, html string")
    got = {r.id: r.p for r in df.select("id", elements.page_elements("html").alias("p")).collect()}
    assert got[2] is None and got[4].elements == [] and got[4].text == ""
    assert [(e.tag, e.pre, e.last, e.parent) for e in got[3].elements] == [("p", 1, 2, 0), ("br", 2, 2, 1)]
    found = got[1].elements
    assert [e.pre for e in found] == list(range(1, len(found) + 1))
    for e in found:
        inside = [x for x in found if e.pre < x.pre <= e.last]
        assert all(x.last <= e.last and e.at <= x.at <= x.stop <= e.stop for x in inside)
        assert all(x.parent >= e.pre for x in inside) and e.parent < e.pre


def test_selectors_are_those_of_the_rules(spark):
    """Both ways to take fields from a page agree, also on the given pages."""
    rules = [
        pages.Rule("links", "a", attr="href", inside=("div", "videos-grid")),
        pages.Rule("thumbs", "img", "thumbnail-changes-image", attr="src"),
        pages.Rule("views", "div", label="Views"),
        pages.Rule("tags", "p", "large-tag"),
        pages.Rule("nav", "a", inside=("nav", None)),
        pages.Rule("paragraphs", "p", inside=("article", None)),
    ]
    given = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "html")
    extra = spark.createDataFrame([(-1, PAGE), (-2, None), (-3, "<p class=large-tag>open")], given.schema)
    df = given.unionByName(extra).select(
        "page_id", pages.page_fields("html", rules).alias("f"), elements.page_elements("html").alias("p")
    )
    ways = {}
    for r in rules:
        inside = (r.inside[0], r.inside[1] or ()) if r.inside else None
        found = elements.select("p", r.tag, r.cls or (), inside, r.label)
        if r.label:
            found = elements.next_siblings("p", found)
        ways[r.field] = elements.attributes(found, r.attr) if r.attr else elements.texts("p", found)
    rows = df.select("page_id", "f", F.struct(*[w.alias(n) for n, w in ways.items()]).alias("w")).collect()
    for r in rows:
        w = r.w.asDict()
        assert r.f.asDict() == {k: x or [] for k, x in w.items()}
    assert len(rows) > 3 and any(r.f.links for r in rows)


def test_nth_row_leaves_the_rows_where_they_are(spark):
    rows = [(2, "d", {"k": 1}), (1, "c", {}), (1, "b", {}), (None, "a", {}), (7, "e", {})]
    df = spark.createDataFrame(rows, "seq bigint, text string, m map<string, int>")
    got = [selecting.nth_row(df, n) for n in range(6)]
    assert [[r["text"] for r in g.collect()] for g in got] == [["a"], ["b"], ["c"], ["d"], ["e"], []]
    plan = got[1]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_results_leave_the_model_in_parts():
    run = infer._infer(_Echo, 4, "string", 2).func
    text = pd.Series([f"t{i}" for i in range(30)], index=range(100, 130))
    names = pd.Series(["a", "b"] * 15, index=text.index)
    parts = list(run(iter([(text, names, names)])))
    assert [len(p) for p in parts] == [8, 8, 8, 6]
    assert [x for p in parts for x in p["result"]] == [
        f"{m}:{t}" for m, t in zip(names, text)
    ]


class _Echo:
    def __init__(self, name):
        self.name = name

    def __call__(self, payloads, languages):
        return [f"{self.name}:{p}" for p in payloads]


def test_pages_are_parsed_in_parts(monkeypatch):
    monkeypatch.setattr(elements, "PART_BYTES", 10)
    html = pa.array(["<p>a</p>", None, "", "<b>" * 40, "x", "<i>y</i>"])
    parts = list(elements._parts(html))
    assert [len(p) for p in parts] == [2, 1, 1, 1, 1]
    whole = elements._parsed(html).to_pylist()
    assert [x for p in parts for x in elements._parsed(p).to_pylist()] == whole


def test_relevance_counts_so_many_bytes_a_task(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, f"the word{i % 7} " * (i % 5 + 1)) for i in range(60)] + [(3, "the end"), (60, None)],
        "id bigint, text string",
    )
    whole = sorted(map(tuple, pages.relevant(docs, "the word1", "id").collect()))
    monkeypatch.setattr(pages, "TASK_BYTES", 100)
    parts = pages.relevant(docs, "the word1", "id")
    n = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert f"{-(-n // 100)}), REPARTITION_BY_NUM" in plan
    assert sorted(map(tuple, parts.collect())) == whole
