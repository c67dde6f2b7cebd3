import json

import pytest

from phyllo.operators import ingest, nested

GBIF = "page_id long, fetched_at timestamp, page_offset int, page_limit int, end_of_records boolean, total_count int, results array<struct<occ_key:bigint,dataset_key:string,basis_of_record:string,license:string,recorded_by:string,rights_holder:string,ref_url:string,publishing_org_key:string,scientific_name:string,media:array<struct<media_type:string,media_format:string,ref_url:string,created:string,creator:string,publisher:string,license:string,rights_holder:string,identifier:string>>>>"
INAT = "page_id long, fetched_at timestamp, http_status int, body string"


def medium(url, licence, kind="StillImage"):
    return (kind, None, None, None, None, None, licence, None, url)


def occurrence(key, media, licence=None):
    return (key, None, None, licence, "Ada", None, None, None, "X y", media)


def gbif(spark, *pages):
    return spark.createDataFrame([(i, None, 0, 100, True, 1, p) for i, p in enumerate(pages)], GBIF)


def inat(spark, *bodies):
    return spark.createDataFrame([(i, None, 200, b) for i, b in enumerate(bodies)], INAT)


def test_gbif_levels(spark):
    pages = gbif(
        spark,
        [occurrence(1, [medium("http://a", "cc"), None, medium(" ", "cc"), medium("http://b", "\t")]), None, occurrence(2, None), occurrence(3, [])],
        None, [], [occurrence(None, [medium("http://c", "x" * 100_000)])],
    )
    t = nested.gbif_tables(pages)
    parents = sorted((r["page_id"], r["result_pos"], r["parent_id"]) for r in t["parents"].collect())
    assert parents == [(0, 0, 1), (0, 1, None), (0, 2, 2), (0, 3, 3), (3, 0, None)]
    photos = sorted((r["page_id"], r["result_pos"], r["parent_id"], r["photo_pos"], r["url"]) for r in t["photos"].collect() if True)
    assert [p[:4] for p in photos] == [(0, 0, 1, 0), (0, 0, 1, 1), (0, 0, 1, 2), (0, 0, 1, 3), (3, 0, None, 0)]
    assert photos[1][4] is None
    found = nested.complete_photos(pages, inat(spark, None)).collect()
    assert sorted((r["page_id"], r["photo_pos"]) for r in found) == [(0, 0), (3, 0)]
    assert {r["page_id"]: r["n_results"] for r in t["pages"].collect()} == {0: 4, 1: 0, 2: 0, 3: 1}


def test_inat_dirt(spark):
    photo = {"id": 5, "license_code": "cc0", "url": "http://p/square.jpg"}
    bodies = [
        json.dumps({"results": [{"id": "7", "photos": photo}, None, {"photos": [None, photo | {"id": "8"}], "id": 9}]}),
        '{"results": [{"id": 1, "photos": [', None, "", '{"error": "busy", "results": null}', "[1, 2]", '{"results": [3, "x", {"id": [], "photos": "none", "user": 4}]}',
        json.dumps({"results": [{"id": 1, "photos": [photo | {"license_code": None}, photo | {"url": ""}, 5]}]}),
    ]
    t = nested.inat_tables(inat(spark, *bodies))
    photos = sorted((r["page_id"], r["result_pos"], r["parent_id"], r["photo_pos"], r["photo_id"]) for r in t["photos"].collect())
    assert photos[:3] == [(0, 0, 7, 0, "5"), (0, 2, 9, 0, None), (0, 2, 9, 1, "8")]
    assert [p[:2] for p in photos[3:]] == [(7, 0)] * 3
    assert {r["page_id"]: r["readable"] for r in t["pages"].collect()} == {0: True, 1: False, 2: False, 3: False, 4: True, 5: True, 6: True, 7: True}
    found = nested.complete_photos(gbif(spark, None), inat(spark, *bodies)).collect()
    assert sorted((r["page_id"], r["result_pos"], r["photo_pos"]) for r in found) == [(0, 0, 0), (0, 2, 1)]


def test_empty_and_clashing(spark):
    assert nested.complete_photos(gbif(spark).limit(0), inat(spark).limit(0)).count() == 0
    df = spark.createDataFrame([(1, [(1, "a")]), (2, None), (1, [(1, "a")])], "id long, xs array<struct<id:int,v:string>>")
    rows = nested.child_table(df, {"id": "parent"}, [{"array": "xs", "pos": "n"}], {"id": "id", "v": "v"}).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 1, "a"), (1, 0, 1, "a")]
    with pytest.raises(ValueError, match="one name"):
        nested.child_table(df, {"id": "id"}, [{"array": "xs", "pos": "n"}], {"id": "ID"})


def test_candidates(spark):
    page = gbif(spark, [occurrence(42, [medium("https://a/photos/1/x.jpg", "CC0_1_0"), medium("https://b", None, "Sound"), medium("ftp://c", "x"), medium("http://d", "")], "CC_BY_4_0")])
    got = sorted((r["source_id"], r["license"], r["author"]) for r in ingest.gbif_candidates(page).collect())
    assert got == [("42#0", "CC0_1_0", "Ada"), ("42#3", "CC_BY_4_0", "Ada")]
    assert ingest.with_allowed_license(ingest.gbif_candidates(page)).count() == 2
    assert ingest.with_allowed_license(ingest.gbif_candidates(gbif(spark, [occurrence(1, [medium("http://a", "CC_BY_SA_4_0")])])), True).count() == 1
    assert ingest.with_allowed_license(ingest.gbif_candidates(gbif(spark, [occurrence(1, [medium("http://a", "CC_BY_SA_4_0"), medium("http://b", None)])]))).count() == 0
    known = spark.createDataFrame([("gbif", "42#3")], "source string, source_id string")
    assert [r["source_id"] for r in ingest.new_candidates(ingest.gbif_candidates(page), known, ["source_id"]).collect()] == ["42#0"]
    photos = [{"id": 1, "license_code": "cc-by", "url": "http://x/square.jpg"}, {"id": 2, "license_code": "cc0", "url": "http://x", "hidden": True}, {"id": 3, "url": "http://x"}, {"id": 4, "license_code": "cc-by", "url": "http://x/square.jpg"}]
    rows = ingest.inat_candidates(inat(spark, json.dumps({"results": [{"id": 13754959, "photos": photos}]}))).collect()
    assert sorted((r["source_id"], r["image_url"]) for r in rows) == [("13754959#1", "http://x/large.jpg"), ("13754959#4", "http://x/large.jpg")]
