import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from phyllo import session
from phyllo.operators import dedup
from phyllo.operators.components import components, mixed, unmixed
from phyllo.operators.hamming import self_pairs


def signed(x):
    x = int(x)
    return x - (1 << 64) if x >= 1 << 63 else x


def brute(values, t):
    v = sorted(set(values))
    return {(a, b) for i, a in enumerate(v) for b in v[i + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= t}


def union(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)] + [(900, i) for i in range(700, 800)]
    edges = [(a, b) for a, b in edges if a != b]
    rows = edges + edges[:20] + [(5, None), (None, None), (10_000, 10_000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == union(edges)


def test_components_empty(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("t", [0, 1, 6, 10])
@pytest.mark.parametrize("bucket", [10**9, 100, 5])
def test_self_pairs(spark, t, bucket):
    rng = np.random.default_rng(t)
    base = [signed(x) for x in rng.integers(0, 2**63, 400, dtype=np.uint64) * 2]
    hot = [signed(int(x) & 0x0000FF0FFF00FFFF) for x in rng.integers(0, 2**63, 400, dtype=np.uint64)]
    near = [signed((b & (2**64 - 1)) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64)))) for b in base[:150] + hot[:150]]
    values = base + hot + near
    df = spark.createDataFrame([(v,) for v in values + base[:5]] + [(None,)], "h long")
    got = self_pairs(df, "h", t, bucket).collect()
    assert len({(r["a"], r["b"]) for r in got}) == len(got)
    assert {(r["a"], r["b"]) for r in got} == brute(values, t)


def test_buckets_that_stay_full(spark):
    rng = random.Random(9)
    values = sorted({sum(1 << b for b in rng.sample(range(12), rng.randrange(4))) for _ in range(400)})
    df = spark.createDataFrame([(v,) for v in values], "h long")
    got = self_pairs(df, "h", 3, bucket=20).collect()
    assert len(got) == len({(r["a"], r["b"]) for r in got}) and {(r["a"], r["b"]) for r in got} == brute(values, 3)


def test_near_pairs_within(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(150):
        h = signed(rng.integers(0, 2**63, dtype=np.uint64))
        rows += [(len(rows), h, "a"), (len(rows) + 1, h ^ 5, "a"), (len(rows) + 2, h, "b"), (len(rows) + 3, h, "a")]
    df = spark.createDataFrame(rows + [(9999, None, "a")], "seq long, h long, g string")
    first = {}
    for i, h, g in rows:
        first.setdefault((h, g), i)
    far = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    for within in ("g", None):
        reps = {k if within else (k[0], ""): i for k, i in reversed(first.items())}
        want = sorted((min(i, j), max(i, j), far(a, b)) for (a, g), i in reps.items() for (b, k), j in reps.items() if a < b and g == k and far(a, b) <= 6)
        assert sorted((r["a"], r["b"], r["distance"]) for r in dedup.near_pairs(df, 6, within).collect()) == want
    assert {r["id"]: r["class"] for r in dedup.hash_classes(df, "g").collect()} == {i: first[h, g] for i, h, g in rows}


RECORDS = "seq long, species string, checksum string, phash string, downloaded_at string, status string, reason string, duplicate_of string"


def test_mark_duplicates(spark):
    rows = [
        (1, "M", "a", "0" * 16, "2024-01-02", "kept", "", ""), (2, "M", "a", "0" * 16, "2024-01-02", "kept", "", ""),
        (3, "M", "c", "0" * 15 + "1", "2024-01-03", "kept", "", ""), (4, "M", "d", "f" * 16, "2024-01-01", "kept", "", ""),
        (5, "F", "e", "f" * 15 + "e", "2024-01-01", "kept", "", ""), (6, "M", "a", "0" * 16, "", "rejected", "small", ""), (7, "M", "", None, None, "kept", "", ""), (8, "M", "", "", None, "kept", "", ""),
    ]
    df = spark.createDataFrame(rows, RECORDS)
    got = {r["seq"]: (r["status"], r["duplicate_of"]) for r in dedup.mark_duplicates(df).collect()}
    assert got == {1: ("kept", ""), 2: ("duplicate", "a"), 3: ("duplicate", "a"), 4: ("kept", ""), 5: ("kept", ""), 6: ("rejected", ""), 7: ("kept", ""), 8: ("kept", "")}
    assert sorted(map(tuple, dedup.cross_species(df).collect())) == [(4, 5), (5, 4)]
    assert dedup.mark_duplicates(df.limit(0)).count() == 0


class Elsewhere:
    """What shared_dir reads of a session that is not local and names no shared folder."""

    master = "spark://somewhere:7077"
    sparkContext = conf = property(lambda self: self)

    def get(self, key, default=None):
        return default

    def getConf(self):
        return self


def test_no_shared_folder_off_local():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere())


def test_scratch_is_deleted(spark):
    with session.scratch():
        path = session.materialize(spark.range(3), "test")._phyllo_path.removeprefix("file://")
        assert Path(path).is_dir()
    assert not Path(path).exists()


def test_mix_is_reversible(spark):
    values = [0, 1, -1, 2**63 - 1, -(2**63), 1 << 32, -(1 << 32), *(random.Random(1).getrandbits(64) - 2**63 for _ in range(200))]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", mixed(F.col("v")).alias("m"))
    rows = df.select("v", "m", unmixed(F.col("m")).alias("w")).collect()
    assert all(r["v"] == r["w"] for r in rows) and len({r["m"] for r in rows}) == len(set(values))


def test_chain_in_order(spark):
    df = spark.range(4000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(df).groupBy("root").count().collect()
    assert [tuple(r) for r in got] == [(0, 4001)]
