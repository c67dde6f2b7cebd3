import json

from pyspark.sql import functions as F

from phyllo.sources import commons, files, paged, sinks
from phyllo.streaming import streams


def test_manifest_round_trip(spark, tmp_path):
    path = str(tmp_path / "manifest.jsonl")
    (tmp_path / "manifest.jsonl").write_text("\n".join([json.dumps({"species": "A b", "source": "gbif", "width": 5, "new_key": 1, "extra": {"photo_id": "7"}}), "", json.dumps({"status": "rejected", "species": "é"})]), encoding="utf-8")
    m = files.read_manifest(spark, path)
    rows = m.orderBy("seq").collect()
    assert [(r["species"], r["status"], r["width"], r["checksum"], r["extra"]) for r in rows] == [("A b", "kept", 5, "", {"photo_id": "7"}), ("é", "rejected", 0, "", {})]
    target = str(tmp_path / "out")
    sinks.rewrite_manifest(m, target)
    sinks.rewrite_manifest(files.read_manifest(spark, target), target)
    assert sorted(r["species"] for r in files.read_manifest(spark, target).collect()) == ["A b", "é"]
    sinks.append_manifest(m, target)
    assert files.read_manifest(spark, target).count() == 4
    assert files.read_manifest(spark, str(tmp_path / "absent")).count() == 0


def test_plants_round_trip(spark, tmp_path):
    head = "internal_id,scientific_name,genus,epithet,family,common_fr,common_en,common_de,common_it,synonyms,gbif_key,wikidata_id,plantnet_id,image"
    (tmp_path / "plants.csv").write_text(head + '\n,"Tazela ruvora Bo",,,Tazaceae,,"red, moon",,,"A b | |C d",12,,,\nx,,,,,,,,,,,,,\n', encoding="utf-8")
    p = files.read_plants(spark, str(tmp_path / "plants.csv"))
    r = p.collect()
    assert len(r) == 1
    assert (r[0]["internal_id"], r[0]["scientific_name"], r[0]["common_names"], r[0]["synonyms"], r[0]["gbif_key"], r[0]["image"]) == ("tazela-ruvora", "Tazela ruvora", {"en": "red, moon"}, ["A b", "C d"], 12, None)
    sinks.write_plants(p, str(tmp_path / "out"))
    assert [x.asDict() for x in files.read_plants(spark, str(tmp_path / "out")).collect()] == [x.asDict() for x in r]


def test_lists_splits_images(spark, tmp_path):
    (tmp_path / "list.txt").write_text("\n  a-b \n\nc d\n", encoding="utf-8")
    assert [r["value"] for r in files.read_lines(spark, str(tmp_path / "list.txt")).orderBy("seq").collect()] == ["a-b", "c d"]
    assert [tuple(r) for r in files.read_labels(spark, str(tmp_path / "list.txt")).orderBy("class_idx").collect()] == [(0, "a-b"), (1, "c"), (2, "d")]
    (tmp_path / "splits.csv").write_text("path,species,internal_plant_id,split,group,captive\np/1.jpg,A,a,train,g,1\np/2.jpg,A,a,val,g,0\n")
    present = spark.createDataFrame([("p/1.jpg",)], "path string")
    assert [(r["path"], r["captive"]) for r in files.read_splits(spark, str(tmp_path / "splits.csv"), files=present).collect()] == [("p/1.jpg", True)]
    assert files.read_splits(spark, str(tmp_path / "splits.csv"), "test").count() == 0
    for name in ("a/x.JPG", "a/y.txt", "b/z.webp"):
        (tmp_path / "img" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "img" / name).write_bytes(b"abc")
    assert sorted(r["folder"] for r in files.list_images(spark, str(tmp_path / "img")).collect()) == ["a", "b"]
    assert files.read_images(spark, str(tmp_path / "img"), 2).count() == 0
    (tmp_path / "meta.json").write_text(json.dumps({"i1": {"species_id": "5", "license": "cc0", "organ": "leaf"}, "i2": {"species_id": "6"}}))
    assert {r["image_id"]: r["license"] for r in files.read_metadata(spark, str(tmp_path / "meta.json")).collect()} == {"i1": "cc0", "i2": None}


def flaky(query, page):
    if query == "busy":
        return 429, None, False
    return 200, json.dumps({"q": query, "page": page}), page == 2


def test_paged_source(spark, tmp_path):
    paged.register(spark)
    for i in range(3):
        (tmp_path / "q").mkdir(exist_ok=True)
        (tmp_path / "q" / f"{i}.json").write_text(f'{{"n": {i}}}')
    df = spark.read.format("paged").option("root", str(tmp_path)).option("queries", '["q", "none"]').load()
    assert sorted((r["query"], r["page"]) for r in df.collect()) == [("q", 0), ("q", 1), ("q", 2)]
    reader = paged.PagedReader({"queries": '["ok", "busy"]', "fetcher": f"{__name__}:flaky", "attempts": "2", "wait": "0"})
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[0], r[1], r[2], r[3] is None) for r in rows] == [("ok", 0, 200, False), ("ok", 1, 200, False), ("ok", 2, 200, False), ("busy", 0, 429, True)]


def test_commons(spark):
    info = lambda mime, lic, **k: [{"mime": mime, "url": "https://u", "descriptionurl": "d", "extmetadata": {"LicenseUrl": {"value": lic}, "Artist": {"value": "<b>Ada</b>"}} | k}]
    pages = {"query": {"pages": [{"pageid": 1, "title": "File:A.jpg", "imageinfo": info("image/jpeg", "https://creativecommons.org/licenses/by/4.0/")}, {"pageid": 2, "title": "File:B.svg", "imageinfo": info("image/svg", "x")}, {"pageid": 3, "title": "File:Herbarium C.jpg", "imageinfo": info("image/jpeg", "x")}, {"pageid": 4, "title": "File:D.jpg"}]}}
    got = commons.files(spark.createDataFrame([(json.dumps(pages),), (None,)], "body string")).collect()
    assert [(r["source_id"], r["author"]) for r in got] == [("commons:1", "Ada")]


def test_credits_and_release(spark):
    rows = [("kept", "B", "", "gbif", "2", "CC0", "", "u2", "p2"), ("kept", "A", "Zoe", "gbif", "1", "CC0", "", "u1", "p1"), ("rejected", "A", "x", "gbif", "3", "CC0", "", "u3", "p3")]
    df = spark.createDataFrame(rows, "status string, species string, author string, source string, source_id string, license string, license_url string, original_url string, path string")
    text = [r["value"] for r in sinks.attributions_text(df).collect()]
    assert text == ["## A\n\n- Zoe, CC0, u1\n", "## B\n\n- author not stated, CC0, u2\n"]
    assert sorted((r["source_id"], r["heading"]) for r in sinks.with_headings(df).collect()) == [("1", True), ("2", True), ("3", False)]
    made = spark.createDataFrame([("m", bytearray(b"abc"))], "name string, content binary")
    labels = spark.createDataFrame([("a",), ("b",)], "class_id string")
    sha = made.select(F.sha2("content", 256)).first()[0]
    card = spark.createDataFrame([("m", sha, 3, 5)], "name string, sha256 string, size int, classes long")
    assert dict(map(tuple, sinks.release_checks(made, labels, card).collect())) == {"sha256": True, "size": True, "classes": False}


def test_streams_resume(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "k string, o long, ts timestamp_ntz"
    batch = lambda rows: spark.createDataFrame(rows, "k string, o long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    make = lambda: streams.quota(streams.read_parquet(spark, src, batch([]).schema), "k", "o", 3)
    batch([("a", 1, "2024-01-01 00:00:00"), ("a", 2, None), ("b", 3, None)]).coalesce(1).write.mode("append").parquet(src)
    streams.run(make(), out, ck)
    batch([("a", 4, None), ("a", 5, None), ("b", 6, None)]).coalesce(1).write.mode("append").parquet(src)
    streams.run(make(), out, ck)
    assert sorted((r["k"], r["o"]) for r in spark.read.parquet(out).collect()) == [("a", 1), ("a", 2), ("a", 4), ("b", 3), ("b", 6)]
    streams.append_batches(streams.dedupe(streams.read_parquet(spark, src, batch([]).schema), ["k"]), str(tmp_path / "ap"), str(tmp_path / "ck2"))
    assert spark.read.json(str(tmp_path / "ap")).select("k").distinct().count() == 2
    del schema
