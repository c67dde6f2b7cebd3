"""Grouped splits, cross-split overlaps, quota samples and survivors against brute force on small dirty tables."""

import random
from collections import Counter, defaultdict

import pytest

from phyllo.llm import cross_split, grouped_splits, quota_sample, survivors

FIELDS = "seq long, species string, internal_plant_id string, source string, source_id string, original_url string, image_url string, author string, license string, license_url string, downloaded_at string, checksum string, path string, observation_id string, publisher string, dataset_key string, width int, height int, phash string, status string, reason string, duplicate_of string, extra map<string,string>"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def record(seq, **kw):
    row = dict.fromkeys(NAMES)
    row |= {"seq": seq, "species": "A b", "source": "gbif", "source_id": str(seq), "checksum": f"{seq:064x}", "path": f"p/{seq}.jpg", "width": 100, "status": "kept", "license": "cc0", "downloaded_at": f"2024-01-{1 + seq % 28:02d}T00:00:00Z"}
    return tuple((row | kw)[n] for n in NAMES)


def dirty(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n // 3)]
    out = []
    for s in range(1, n + 1):
        h = rng.choice(base)
        for _ in range(rng.randrange(9)):
            h ^= 1 << rng.randrange(64)
        phash = rng.choice([f"{h:016x}", f"{h:016X}", None, "", "bad"]) if rng.random() < 0.3 else f"{h:016x}"
        out.append(
            record(
                s, species=rng.choice(["A b", "C d", None]), author=rng.choice(["Ada Lé", "le, ADA", "© Ada  Le", "Bo", "unknown", "", None, "N/A"]), source=rng.choice(["gbif", "inat", None]),
                observation_id=rng.choice([None, "", " ", str(rng.randrange(n // 2))]), checksum=rng.choice([f"{rng.randrange(n):064x}", f"{rng.randrange(n):064X}", None, ""]), phash=phash,
                status=rng.choice(["kept", "kept", "duplicate", None]), license=rng.choice(["cc0", "", None, " "]), width=rng.choice([0, None, 100, 200]),
                downloaded_at=rng.choice(["", None, "2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "2024-05-01T00:00:00Z", "soon"]), extra=rng.choice([None, {}, {"captive": "Yes"}, {"captive": "no"}]), source_id=str(rng.randrange(n)),
            )
        )
    return out


def roots(n, links):
    up = list(range(n + 1))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in range(1, n + 1)}


def as_dicts(rows):
    return [dict(zip(NAMES, r)) for r in rows]


def bits(p):
    p = (p or "").strip()
    try:
        return int(p, 16) if len(p) == 16 else None
    except ValueError:
        return None


def far(a, b):
    return 99 if a is None or b is None else bin(a ^ b).count("1")


@pytest.mark.parametrize("name", ["Ada Lé", "le, ADA", "© Ada  Le", "(c) ada LE", "Lé Ada", "ada lé"])
def test_one_author(name):
    assert grouped_splits.author_key(name) == "ada le"


@pytest.mark.parametrize("name", ["", " ", "-", "N/A", "Unknown author", "anonymous", "?", "\t"])
def test_no_author(name):
    assert grouped_splits.author_key(name) is None


@pytest.mark.parametrize("n", [0, 60, 150])
def test_record_groups(spark, n):
    rows = dirty(n, n)
    seen, links = {}, []
    for r in as_dicts(rows):
        author = grouped_splits.author_key(r["author"]) if r["author"] is not None else None
        keys = []
        if (r["observation_id"] or "").strip():
            keys.append(("o", r["source"], r["observation_id"].strip()))
        if author and r["species"] is not None:
            keys.append(("a", r["species"], author))
        for k in keys:
            links.append((seen.setdefault(k, r["seq"]), r["seq"]))
    root = roots(n, links)
    size = Counter(root.values())
    df = spark.createDataFrame(rows, FIELDS)
    assert dict(map(tuple, grouped_splits.record_groups(df).collect())) == {s: r for s, r in root.items() if size[r] > 1}
    split = grouped_splits.assign_splits(df).collect()
    assert {r["seq"]: r["first_seq"] for r in split} == root
    sides = defaultdict(set)
    for r in split:
        sides[r["first_seq"]].add(r["split"])
    assert all(len(x) == 1 for x in sides.values())


def test_related_by_three_keys(spark):
    rows = [(1, "a", None, None), (2, "a", "x", None), (3, None, "x", "p"), (4, None, None, "p"), (5, "b", None, "q"), (6, None, "y", "q"), (7, "c", "z", "r"), (8, None, None, None)]
    df = spark.createDataFrame(rows, "seq long, a string, b string, c string")
    got = grouped_splits.related(df, "seq", [df.a, df.b, df.c]).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 5)]


def test_more_records_move_no_group(spark):
    rows = [record(s, author=f"name {s // 3}", observation_id=str(s)) for s in range(1, 1500)]
    few, many = ({r["first_seq"]: r["split"] for r in grouped_splits.assign_splits(spark.createDataFrame(rows[:n], FIELDS), heavy_share=0.01).collect()} for n in (1200, 1499))
    assert all(many[k] == v for k, v in few.items())


def test_split_shares_with_a_giant(spark):
    rows = [record(s, author="Ada Le" if s <= 1000 else None, observation_id=str(s)) for s in range(1, 3001)]
    n = Counter(r["split"] for r in grouped_splits.assign_splits(spark.createDataFrame(rows, FIELDS)).collect())
    assert abs(n["train"] / 3000 - 0.8) < 0.03 and abs(n["val"] / 3000 - 0.1) < 0.03 and abs(n["test"] / 3000 - 0.1) < 0.03


@pytest.mark.parametrize("n", [0, 120])
def test_overlaps(spark, n):
    rows, rng = dirty(n, 7), random.Random(1)
    splits = [(f"p/{rng.randrange(1, n + 20)}.jpg", rng.choice(["train", "train", "val", "test", None])) for _ in range(2 * n)] + [(None, "train")]
    side = defaultdict(set)
    for p, s in splits:
        side[p].add(s)
    want = set()
    ds = as_dicts(rows)
    for a in ds:
        for b in ds:
            if a["seq"] != b["seq"] and "train" in side[a["path"]] and side[b["path"]] & {"val", "test"}:
                same = (a["checksum"] or "").lower() == (b["checksum"] or "").lower() != ""
                if same or far(bits(a["phash"]), bits(b["phash"])) <= 6:
                    want.add(tuple(sorted((a["seq"], b["seq"]))))
    df, sp = spark.createDataFrame(rows, FIELDS), spark.createDataFrame(splits, "path string, split string")
    got = cross_split.overlap_pairs(df, sp).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == want
    n_pairs, n_exact, touched = Counter(), Counter(), defaultdict(set)
    for a in ds:
        for b in ds:
            exact = (a["checksum"] or "").lower() == (b["checksum"] or "").lower() != ""
            if a["seq"] != b["seq"] and "train" in side[b["path"]] and (exact or far(bits(a["phash"]), bits(b["phash"])) <= 6):
                for s in side[a["path"]] & {"val", "test"}:
                    n_pairs[s, a["source"]] += 1
                    n_exact[s, a["source"]] += exact
                    touched[s, a["source"]].add(a["seq"])
    told = {(r["split"], r["source"]): (r["n_pairs"], r["n_exact"], r["n_records"]) for r in cross_split.overlap_report(df, sp).collect()}
    assert told == {k: (n, n_exact[k], len(touched[k])) for k, n in n_pairs.items()}


@pytest.mark.parametrize(("t", "hot", "pieces"), [(6, 1.0, 4), (6, 0.0, 4), (3, 0.0, 4), (11, 0.0, 4), (6, 1.0, 3), (6, 0.0, 3)])
def test_near_pairs_with_hot_pieces(spark, t, hot, pieces):
    rng = random.Random(t)
    held = [rng.getrandbits(62) & (0x3FFF0000FFFFFFFF if i % 2 else (1 << 62) - 1) for i in range(200)]
    train = [h ^ sum(1 << b for b in rng.sample(range(60), rng.randrange(t + 3))) for h in held] + [rng.getrandbits(62) & 0x3FFF0000FFFFFFFF for _ in range(200)]
    df = lambda v: spark.createDataFrame([(x,) for x in [*v, None]], "h long")
    got = [(r["e"], r["r"]) for r in cross_split.near_pairs(df(held), df(train), t, hot, pieces).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in set(held) for b in set(train) if far(a, b) <= t}


TARGET = "target_id long, draw_id int, species string, source string, captive int, share_permille int, min_rows long, sample_rows long"


@pytest.mark.parametrize("n", [0, 200])
def test_quota_sample(spark, n):
    rows = dirty(n, 3)
    targets = [(1, 1, "A b", "gbif", 0, 100, 2, 100), (2, 1, "A b", "gbif", 1, 900, 0, 1000), (3, 1, "C d", "inat", 0, 1, 0, 1001), (4, 1, "no", "gbif", 0, 0, 0, 0), (5, 2, "A b", "gbif", 0, None, None, None), (6, 2, None, "gbif", 0, 1, 1, 1)]
    have = defaultdict(set)
    for r in as_dicts(rows):
        if r["status"] == "kept":
            have[r["species"], r["source"], int((r["extra"] or {}).get("captive", "no") == "Yes")].add(r["source_id"])
    df, ta = spark.createDataFrame(rows, FIELDS), spark.createDataFrame(targets, TARGET)
    got = {r["target_id"]: r for r in quota_sample.report(df, ta).collect()}
    for t, _, sp, so, ca, share, least, size in targets:
        need = max(least or 0, -(-(share or 0) * (size or 0) // 1000))
        there = len(have[sp, so, ca]) if sp else 0
        assert (got[t]["need"], got[t]["taken"], got[t]["exhausted"]) == (need, min(need, there), there < need)
        assert got[t]["available"] == there or got[t]["taken"] == 0
    drawn = quota_sample.sample(df, ta).collect()
    assert len(set(map(tuple, drawn))) == len(drawn)
    again = quota_sample.sample(df.repartition(7), ta).collect()
    assert set(map(tuple, again)) == set(map(tuple, drawn))


def test_quotas():
    assert quota_sample.quotas([500, 300, 200], [0, 0, 0], 10) == [5, 3, 2]
    assert quota_sample.quotas([334, 333, 333], [0, 0, 0], 10) == [4, 3, 3]
    assert quota_sample.quotas([900, 50, 50], [0, 10, 10], 100) == [80, 10, 10]
    assert quota_sample.quotas([1000, 0], [0, 7], 10) == [3, 7]
    assert quota_sample.quotas([500, 500], [8, 8], 10) == [8, 8]
    assert quota_sample.quotas([100, 200], [0, 0], 10) == [1, 2]
    assert quota_sample.quotas([], [], 10) == [] and quota_sample.quotas([0, 0], [0, 1], 0) == [0, 1]
    rng = random.Random(2)
    for _ in range(500):
        n = rng.randrange(1, 12)
        cuts = sorted(rng.randrange(1001) for _ in range(n - 1))
        shares = [b - a for a, b in zip([0, *cuts], [*cuts, 1000])]
        least, size = [rng.randrange(9) for _ in range(n)], rng.randrange(120)
        got = quota_sample.quotas(shares, least, size)
        assert all(q >= m for q, m in zip(got, least)) and sum(got) == max(size, sum(least))
        # the shares of two targets above their minimums are kept, but for rounding
        free = [i for i in range(n) if got[i] > least[i] + 1]
        assert all(abs(got[i] * shares[j] - got[j] * shares[i]) <= shares[i] + shares[j] for i in free for j in free)


def test_reservoirs_are_bounded(spark):
    rows = [(1, 5, s, (s * 7919) % 100_003) for s in range(20_000)] + [(2, 0, 1, 5), (3, 100, 2, 6)]
    df = spark.createDataFrame(rows, "target_id long, need long, seq long, priority long").repartition(3)
    got = quota_sample.reservoirs(df).collect()
    assert sum(r["target_id"] == 1 for r in got) <= 15 and sum(r["seen"] for r in got if r["target_id"] == 1) == 20_000
    low = sorted((p, s) for t, _, s, p in rows if t == 1)[:5]
    assert set(low) <= {(r["priority"], r["seq"]) for r in got if r["target_id"] == 1}
    assert [(r["seen"], r["seq"]) for r in got if r["target_id"] == 2] == [(1, None)] and quota_sample.reservoirs(df.limit(0)).count() == 0


def test_sample_keeps_to_quotas(spark):
    rows = dirty(200, 3)
    targets = [(1, 1, "A b", "gbif", 0, 600, 2, 10), (2, 1, "A b", "gbif", 1, 300, 0, 10), (3, 1, "C d", "inat", 0, 100, 4, 10), (4, None, "C d", "gbif", 0, 1000, 0, 5)]
    df, ta = spark.createDataFrame(rows, FIELDS), spark.createDataFrame(targets, TARGET)
    got = {r["target_id"]: r for r in quota_sample.drawn(df, ta).collect()}
    assert {t: r["quota"] for t, r in got.items()} == {1: 4, 2: 2, 3: 4, 4: 5}
    assert Counter(r["target_id"] for r in quota_sample.sample(df, ta).collect()) == {t: r["drawn"] for t, r in got.items() if r["drawn"]}
    assert all(r["drawn"] + r["short"] == r["quota"] for r in got.values())


SOURCES = [("gbif", "G", 2), ("inat", "I", 1)]


@pytest.mark.parametrize("n", [0, 90])
def test_survivors(spark, n):
    rows = dirty(n, 11)
    ds = as_dicts(rows)
    links = []
    for i, a in enumerate(ds):
        for b in ds[i + 1 :]:
            same = (a["checksum"] or "").lower() == (b["checksum"] or "").lower() != ""
            if same or far(bits(a["phash"]), bits(b["phash"])) <= 6:
                links.append((a["seq"], b["seq"]))
    root = roots(n, links)
    groups = defaultdict(list)
    instant = {"2024-01-01T00:00:00Z": 1, "2024-01-01T02:00:00+02:00": 1, "2024-05-01T00:00:00Z": 2}
    for r in ds:
        quality = (r["status"] == "kept", -{"inat": 1, "gbif": 2}.get(r["source"], 9), bool((r["license"] or "").strip()), r["width"] or 0, instant.get(r["downloaded_at"], 0))
        groups[root[r["seq"]]].append((r["seq"], quality))
    want = {}
    for first, members in groups.items():
        if len(members) > 1:
            best = [s for s, q in members if all(s == o or (all(x >= y for x, y in zip(q, p)) and q != p) for o, p in members)]
            want[first] = (len(members), best[0] if best else None)
    df, so = spark.createDataFrame(rows, FIELDS), spark.createDataFrame(SOURCES, "source string, title string, trust_rank int")
    got = {r["first_seq"]: (r["n_rows"], r["best_seq"]) for r in survivors.survivors(df, so).collect()}
    assert got == want
    built = {r["first_seq"]: r for r in survivors.build_survivors(df, so).collect()}
    assert set(built) == set(want)
    by_seq = {r["seq"]: r for r in ds}
    for first, members in groups.items():
        if first in built:
            assert built[first]["status"] == ("kept" if any(by_seq[s]["status"] == "kept" for s, _ in members) else built[first]["status"])
            assert (built[first]["width"] or 0) == max(by_seq[s]["width"] or 0 for s, _ in members)


def test_choose_against_all_combinations():
    rng = random.Random(4)
    for _ in range(300):
        rows = [
            {"s": -n, "lic": rng.choice([None, "x", "y"]), "sp": rng.choice([None, "p", "q"]), "observed": rng.random() < 0.5, "kept": rng.randrange(2), "trust": -rng.randrange(1, 4), "width": rng.randrange(3), "at": rng.randrange(3)}
            for n in range(1, rng.randrange(2, 6))
        ]
        options = []
        for key in {(r["lic"], r["sp"]) for r in rows}:
            own = [r | {"licensed": int(r["lic"] is not None), "named": int(r["sp"] is not None)} for r in rows if (r["lic"], r["sp"]) == key]
            option = {"lic": key[0], "sp": key[1], "whole": max(own, key=lambda r: (r["kept"], r["trust"], r["licensed"], r["width"], r["at"], r["s"]))}
            for b, c in survivors.KEYS.items():
                top = max(own, key=lambda r: (r[c], r["at"], r["s"]))
                option[b] = {"v": top[c], "t": top["at"], "s": top["s"], "observed": top["observed"]}
            options.append(option)
        got = survivors.choose(options)
        full = {-r["s"]: r | {"licensed": int(r["lic"] is not None), "named": int(r["sp"] is not None)} for r in rows}
        gain = {}
        for b, c in survivors.KEYS.items():
            ranks = {v: n for n, v in enumerate(sorted({r[c] for r in full.values()}), 1)}
            gain[b] = {s: survivors.WEIGHTS[b] * ranks[r[c]] / len(ranks) for s, r in full.items()}
        five = [b for b in survivors.KEYS if b != "name"]

        def value(pick):
            o = full[pick["origin"]]
            if o["lic"] is not None and full[pick["rights"]]["lic"] != o["lic"] or o["observed"] and full[pick["name"]]["sp"] != o["sp"]:
                return None
            return round(sum(gain[b][pick[b]] for b in five), 6), len({pick[b] for b in five}) == 1, round(gain["name"][pick["name"]], 6)

        # the bundles but origin, rights and name are free, so each takes its best or the origin's record
        free = {b: [max(gain[b], key=gain[b].get)] for b in ("standing", "file", "time")}
        best = max(
            v for o in full for r in full for n in full for st in (*free["standing"], o) for fi in (*free["file"], o) for ti in (*free["time"], o)
            if (v := value({"origin": o, "rights": r, "name": n, "standing": st, "file": fi, "time": ti}))
        )
        assert value(got) == best


def test_branch_and_bound_keeps_dependencies():
    c = lambda seq, gain, lic, sp="s", observed=True: {"seq": seq, "gain": gain, "lic": lic, "sp": sp, "observed": observed}
    # the best origin states a licence that only a poorer rights bundle shares
    chosen = survivors.solve({"origin": [c(1, 4, "x"), c(2, 2, None)], "rights": [c(1, 1, "x"), c(2, 3, "y")], "name": [c(1, 1, "x")]})
    assert chosen == {"origin": 1, "rights": 1, "name": 1}
    chosen = survivors.solve({"origin": [c(1, 4, "x"), c(2, 3.5, None)], "rights": [c(1, 1, "x"), c(2, 3, "y")], "name": [c(1, 1, "x")]})
    assert chosen == {"origin": 2, "rights": 2, "name": 1}
