import numpy as np
import pytest
from pyspark.sql import functions as F

from phyllo.operators import evaluate as ev
from phyllo.operators import vectors as vec


def images(spark, rows):
    return spark.createDataFrame([(i, t, False, 0, [float(x) for x in p]) for i, (t, p) in enumerate(rows)], "image_id long, truth int, captive boolean, grp long, p array<double>")


def test_tally(spark):
    df = images(spark, [(0, [0.9, 0.05, 0.05]), (1, [0.8, 0.1, 0.1]), (2, [0.3, 0.1, 0.6])])
    r = ev.tally(ev.read(df), 0.7).first()
    assert tuple(r) == (3, 2, 3, 2, 1)
    assert tuple(ev.tally(ev.read(df.limit(0)), 0.7).first()) == (0, 0, 0, 0, 0)


def test_mask_and_threshold(spark):
    df = images(spark, [(0, [0.35, 0.05, 0.60])])
    assert ev.read(df).first()["right"] is False
    assert ev.read(df.withColumn("p", ev.masked("p", [0, 1]))).first()["right"] is True
    half = images(spark, [(0, [0.5, 0.1, 0.4])])
    assert ev.tally(ev.read(half.withColumn("p", ev.masked("p", [0, 1]))), 0.7).first()["accepted"] == 0
    assert ev.tally(ev.read(half.withColumn("p", ev.masked("p", [0, 1], True))), 0.7).first()["accepted"] == 1
    bare = images(spark, [(0, [0.0, 0.0, 1.0])])
    assert bare.select(ev.context_mask("p", [0, 1])).first()[0] == [0.0, 0.0, 1.0]


def test_masked_renormalisation_is_the_softmax_of_the_rest(spark):
    v = [0.3, -1.0, 2.0, 0.5, 1.5]
    row = spark.createDataFrame([(v,)], "v array<double>").select(ev.masked(ev.softmax(F.col("v")), [0, 2, 4], True).alias("a")).first()["a"]
    e = np.exp([v[i] for i in (0, 2, 4)])
    assert np.allclose([row[i] for i in (0, 2, 4)], e / e.sum())


def test_top3_and_ties(spark):
    df = ev.read(images(spark, [(3, [0.4, 0.3, 0.2, 0.1]), (2, [0.4, 0.3, 0.2, 0.1]), (1, [0.25, 0.25, 0.25, 0.25])]))
    assert [r["in_top3"] for r in df.collect()] == [False, True, True]
    assert [r["guess"] for r in df.collect()] == [0, 0, 0]


def test_truncate(spark):
    df = images(spark, [(0, [0.4, 0.3, 0.2, 0.1])])
    assert df.select(ev.truncated("p", 2)).first()[0] == [0.4, 0.3, 0.0, 0.0]
    assert df.select(ev.truncated("p", 0)).first()[0] == df.select(ev.truncated("p", 9)).first()[0] == [0.4, 0.3, 0.2, 0.1]


def test_genus_answer(spark):
    groups = [1, 1, 1, 0]
    df = images(spark, [(0, [0.3, 0.25, 0.2, 0.25]), (0, [0.75, 0.05, 0.1, 0.1]), (3, [0.3, 0.2, 0.15, 0.35])]).withColumn("m", ev.group_mass("p", groups))
    assert np.allclose(df.first()["m"], [0.25, 0.75])
    assert [tuple(r[0]) for r in df.select(ev.answer("p", "m", 0.7)).collect()] == [("genus", 1), ("species", 0), ("nothing", -1)]


def test_confusion_and_chance(spark):
    df = images(spark, [(0, [0.1, 0.9, 0, 0]), (2, [0, 0, 0.9, 0.1]), (3, [0.9, 0, 0, 0.1])])
    g = lambda c: F.expr(f"{c} div 2")
    got = dict(map(tuple, ev.confusion(ev.read(df), g("truth"), F.lit(0), g("guess"), F.lit(0)).collect()))
    assert got == {"within_genus": 1, "right": 1, "same_family": 1}
    classes = spark.createDataFrame([("a-one", "a", "X"), ("a-two", "a", "X"), ("b-one", "b", "X")], "class string, genus string, family string")
    r = ev.by_chance(classes).first()
    assert abs(r["genus"] - 1 / 3) < 1e-12 and abs(r["family"] - 2 / 3) < 1e-12
    assert r["beyond"] == 0 and r["alone"] == 1
    assert tuple(ev.by_chance(classes.limit(1)).first()) == (1, 0.0, 0.0, 0.0, 0)
    apart = spark.createDataFrame([("a-one", "a", "X"), ("b-one", "b", "Y"), ("c-x-one", "c", "Z")], "class string, genus string, family string")
    assert ev.by_chance(apart).first()["beyond"] == 1


def test_taxa_of_classes(spark):
    plants = spark.createDataFrame([("ab-one", "Zed one", " Fam "), ("cd-x-two", "", None)], "internal_id string, scientific_name string, family string")
    classes = spark.createDataFrame([("ab-one",), ("cd-x-two",), ("ef-three",)], "class_id string")
    got = {r["class_id"]: (r["genus"], r["family"]) for r in ev.taxa(classes, plants).collect()}
    assert got == {"ab-one": ("zed", "fam"), "cd-x-two": ("cd", "?cd-x-two"), "ef-three": ("ef", "?ef-three")}


def test_genus_measure_without_answers(spark):
    df = images(spark, [(0, [0.3, 0.3, 0.2, 0.2]), (2, [0.1, 0.1, 0.7, 0.1]), (3, [0.1, 0.1, 0.4, 0.4])])
    r = ev.genus_measure(df, [0, 0, 1, 1], 0.6).first()
    assert (r["images"], round(r["species_rate"], 3), r["species_precision"], round(r["genus_rate"], 3), r["genus_precision"], r["autonomy"]) == (3, 0.333, 1.0, 0.667, 1.0, 1.0)
    none = ev.genus_measure(df, [0, 1, 2, 3], 0.9).first()
    assert none["autonomy"] == 0 and none["precision"] is None and none["genus_precision"] is None


def test_compare_two_models(spark):
    rows = [(m, i, t, c, p) for m, p in (("A", [0.6, 0.3, 0.1]), ("B", [0.2, 0.5, 0.3])) for i, (t, c) in enumerate([(0, True), (1, False), (2, False)])]
    df = spark.createDataFrame(rows, "model string, image_id long, truth int, captive boolean, p array<double>")
    got = {(r["ground"], r["model"], r["reading"], r["threshold"]): (r["images"], r["top1"], r["accepted"]) for r in ev.compare(df, {"A": [0, 1], "B": [0, 1, 2]}, [0.5, 0.7]).collect()}
    assert got["common", "A", "masked", 0.7] == (2, 1, 0) and got["common", "A", "renormalised", 0.5] == (2, 1, 2) and got["common", "B", "renormalised", 0.7] == (2, 1, 2)
    assert got["captive", "A", "full", 0.7] == (1, 1, 0) and got["gained", "B", "full", 0.7] == (1, 0, 0) and ("gained", "A", "full", 0.7) not in got
    assert len(got) == 2 * 2 * 4 + 1


def test_theft(spark):
    df = images(spark, [(0, [0.6, 0.1, 0.3]), (1, [0.2, 0.35, 0.45]), (0, [0.2, 0.4, 0.4])])
    assert [tuple(r) for r in ev.theft_costs(df, [0, 1], [2]).collect()] == [(2, 1)]
    costs = spark.createDataFrame([(0, 3), (1, 0), (2, 0)], "candidate int, cost long")
    assert [r["candidate"] for r in ev.by_theft(costs, {0: 0, 2: 1, 1: 2}).orderBy("rank").collect()] == [2, 1, 0]


def test_nested_sets(spark):
    rows = spark.createDataFrame([("a", 0, 0), ("b", 0, 0), ("e", 1, 0), ("d", 1, 1), ("c", 2, 0)], "class string, tier int, prio int")
    got = {}
    for r in ev.nested_sets(rows, [1, 3, 9]).collect():
        got.setdefault(r["size"], set()).add(r["class"])
    assert got == {2: {"a", "b"}, 3: {"a", "b", "e"}, 5: set("abcde")}


def test_like_app(spark):
    one = images(spark, [(0, [0.6, 0.3, 0.1])])
    assert ev.like_app(one, "grp", 2, 0.2).first()["p"] == [0.6, 0.3, 0.1]
    none = images(spark, [(0, [0.1, 0.1, 0.1]), (0, [0.1, 0.1, 0.1])])
    assert ev.like_app(none, "grp", 2, 0.2).first()["p"] == [0.0, 0.0, 0.0]
    two = ev.like_app(images(spark, [(0, [0.6, 0.3, 0.1]), (0, [0.1, 0.8, 0.1])]), "grp", 2, 0.2).first()["p"]
    raw = np.array([np.sqrt(0.6 * 0.2), np.sqrt(0.3 * 0.8)])
    assert np.allclose(two[:2], raw / raw.sum() * (0.9 + 0.8) / 2) and two[2] == 0


def test_upper_median(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 5.0)], "k string, v double")
    assert dict(map(tuple, ev.upper_median(df, ["k"], "v").collect())) == {"a": 3.0, "b": 5.0}


def test_class_weights(spark):
    classes = spark.createDataFrame([(0,), (1,), (2,)], "class int")
    counts = spark.createDataFrame([(0, 6), (1, 3)], "class int, n long")
    assert {r["class"]: r["weight"] for r in ev.class_weights(classes, counts).collect()} == {0: 0.5, 1: 1.0, 2: 3.0}


@pytest.fixture
def vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(rng.integers(4)), [float(x) for x in rng.normal(size=8)]) for i in range(80)]
    return rows, spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")


def test_vectors_against_numpy(spark, vectors):
    rows, df = vectors
    u = vec.units(df)
    v = np.array([r[2] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    lab = np.array([r[1] for r in rows])
    cos, same = v @ v.T, lab[:, None] == lab[None]
    up = np.triu(np.ones_like(cos, bool), 1)
    got = vec.separability(u).first()
    assert np.allclose([got["intra"], got["inter"]], [cos[same & up].mean(), cos[~same & up].mean()])
    sums = np.array([v[lab == k].sum(0) for k in range(4)])
    for r in vec.leave_one_out(u).collect():
        s = sums.copy()
        s[lab[r["id"]]] -= v[r["id"]]
        assert r["guess"] == int(np.argmax(s @ v[r["id"]] / np.linalg.norm(s, axis=1)))
    assert vec.p_value(vec.permutation_control(u, 0)).first()["p"] is None
    draws = {r["draw"]: r["intra"] for r in vec.permutation_control(u, 5).collect()}
    assert len(draws) == 6 and np.isclose(draws[0], got["intra"])


def test_prototypes(spark):
    df = spark.createDataFrame([(1, 0, [2.0, 0.0, 0.0]), (2, 0, [0.0, 2.0, 0.0])], "vec_id long, label int, embedding array<double>")
    p = vec.prototypes(vec.units(df)).first()["v"]
    assert np.isclose(np.linalg.norm(p), 1) and np.isclose(p[0], p[1])
    assert vec.leave_one_out(vec.units(df)).count() == 0


def test_leave_one_out_in_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(9)), [float(x) for x in rng.normal(size=5)]) for i in range(120)] + [(500, 77, [1.0, 0.0, 0.0, 0.0, 0.0])]
    u = vec.units(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    whole = {tuple(r) for r in vec.leave_one_out(u).collect()}
    assert len(whole) == 120 and whole == {tuple(r) for r in vec.leave_one_out(u, most_labels=2, piece=25).collect()}
