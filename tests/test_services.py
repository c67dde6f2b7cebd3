import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from phyllo.operators import features, services


def test_best_taxon(spark):
    rows = [
        ("Tazela × mola", 0, 1, "Tazela rova", "species", "Tazela mola", True), ("Tazela × mola", 1, 41, "Tazela mola", "hybrid", "x", True), ("Pirola", 0, 2, "Pirola", "genus", "Pirola", True),
        ("Aloe vera", 0, 3, "Aloe vera", "species", "Aloe vera", False), ("Old name", 0, 4, "New name", "species", "old  name", None),
    ]
    df = spark.createDataFrame(rows, "asked string, pos int, id long, name string, rank string, matched_term string, is_active boolean")
    assert {r["asked"]: (r["id"], r["is_synonym"]) for r in services.best_taxon(df).collect()} == {"Tazela × mola": (41, False), "Old name": (4, True)}


def test_foreign_counts(spark):
    meta = spark.createDataFrame([("a", "1", "cc-by-sa", "habit"), ("b", "1", "cc-by-nc", "leaf"), ("c", "1", "cc0", "leaf"), ("d", "9", None, None)], "image_id string, species_id string, license string, organ string")
    mapping = services.mapped_classes(spark.createDataFrame([("1", "Tazela x mola L."), ("9", "No one")], "id string, name string"), spark.createDataFrame([("tazela-x-mola",)], "class_id string"))
    got = {(r["kind"], r["key"]): r["n"] for r in services.foreign_counts(meta, mapping, ["cc-by-sa", "cc0"]).collect()}
    assert got[("whole", "")] == 2 and got[("license", "?")] == 1 and got[("license", "cc-by-nc")] == 1 and got[("organ", "leaf")] == 1 and got[("species", "tazela-x-mola")] == 2


def test_verdict(spark):
    df = spark.createDataFrame([(0.05, 0.0), (0.8, 0.1), (0.8, 0.6), (0.3, 0.1)], "a double, b double")
    assert [r[0] for r in df.select(services.verdict(F.col("a"), F.col("b"))).collect()] == ["no candidate", "accepted", "uncertain", "uncertain"]


def test_picture_hash(spark):
    rng = np.random.default_rng(0)
    grey = rng.random((32, 32))
    df = spark.createDataFrame([(grey.ravel().tolist(),), (np.clip(grey + 0.001, 0, 2).ravel().tolist(),), ([1.0],), (None,)], "g array<double>")
    got = [r[0] for r in df.select(features.picture_hash(F.col("g"))).collect()]
    assert len(got[0]) == 16 and bin(int(got[0], 16) ^ int(got[1], 16)).count("1") <= 1 and got[2:] == [None, None]
    # a cosine transform by its definition
    k = np.arange(32)
    slow = np.array([[sum(grey[y, x] * np.cos(np.pi * (2 * x + 1) * u / 64) * np.cos(np.pi * (2 * y + 1) * v / 64) for x in k for y in k) for u in range(8)] for v in range(8)]).ravel()
    assert int(got[0], 16) == int("".join("1" if b else "0" for b in slow > np.median(slow[1:])), 2)


def test_encoded_resumes(spark, tmp_path):
    seen = []
    rows = spark.range(64).withColumnRenamed("id", "image_id")

    def encode(part):
        seen.append(1)
        if len(seen) == 3:
            raise RuntimeError("dies")
        return part.withColumn("v", F.col("image_id") * 2)

    folder = str(tmp_path)
    with pytest.raises(RuntimeError):
        features.encoded(rows, encode, "s1", folder, parts=4)
    got = features.encoded(rows, encode, "s1", folder, parts=4)
    assert len(seen) == 5 and got.count() == 64
    features.encoded(rows, encode, "s1", folder, parts=4)
    assert len(seen) == 5
    features.encoded(rows, encode, "s2", folder, parts=4)
    assert len(seen) == 9


def test_predict(spark):
    def make():
        return lambda b: np.stack([b["x"], 1 - b["x"]], 1)

    df = spark.createDataFrame(pd.DataFrame({"image_id": [1, 2], "x": [0.25, 1.0]}))
    assert sorted((r["image_id"], r["p"]) for r in features.predict(df, make, ["image_id", "x"]).collect()) == [(1, [0.25, 0.75]), (2, [1.0, 0.0])]


def test_sizes_and_masks(spark):
    assert features.input_sizes(224) == (224, 256)
    for bad in (16, 400):
        with pytest.raises(ValueError):
            features.input_sizes(bad)
    assert features.parse_masks(["a=b=c"]) == {"a": "b=c"}
    with pytest.raises(ValueError):
        features.parse_masks(["a"])
    labels = spark.createDataFrame([(0, "x"), (1, "y")], "class_idx int, class_id string")
    masks = spark.createDataFrame([("m", "y"), ("full", "x"), ("full", "y"), ("none", "z")], "mask string, class_id string")
    assert [tuple(r) for r in features.sized_masks(labels, masks).collect()] == [("m", 1, "y")]
