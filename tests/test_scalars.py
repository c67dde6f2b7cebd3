import hashlib

import pytest
from pyspark.sql import functions as F

from phyllo.functions import licenses, scalars
from phyllo.operators.hamming import band, bands, hash_bits

#: From the rule: an address or a code, its kind, conditions and version; (notation, code, allowed, allowed with share-alike).
LICENCES = [
    *[(f"{scheme}://{host}/licenses/{kind}/{version}{rest}", f"CC {kind.upper()} {version}", free, ours) for scheme, host, version, rest in (("http", "creativecommons.org", "2.5", ""), ("HTTPS", "www.CreativeCommons.org", "3.0", "/deed.it"))
      for kind, free, ours in (("by", True, True), ("by-sa", False, True), ("by-nd", False, False), ("by-nc-nd", False, False))],
    *[(sep.join(["cc", *kind, *version]), " ".join(["CC", "-".join(kind).upper(), ".".join(version) or "4.0"]), free, ours) for sep in ("-", "_", "  ") for version in ((), ("2", "0"))
      for kind, free, ours in ((("by",), True, True), (("by", "sa"), False, True), (("by", "nc"), False, False))],
    ("Cc By 1.0", "CC BY 1.0", True, True), ("ccby-3.0", "CC BY 3.0", True, True), (" cc0\t", "CC0 1.0", True, True), ("cc-0", "CC0 1.0", True, True), ("CC0 2.0", "CC0 2.0", True, True),
    ("creativecommons.org/publicdomain/zero", "CC0 1.0", True, True), ("see creativecommons.org/publicdomain/mark/1.0 for it", "Public Domain Mark 1.0", True, True), ("PDM", "Public Domain Mark 1.0", True, True), ("PublicDomain", "Public Domain Mark 1.0", True, True),
    *[(x, None, False, False) for x in (None, "", "  ", "?", "cc", "cc-", "by-sa", "cc by 4", "cc by 4.0.1", "cc-4.0-by", "cc by xx", "cc0 nc", "mit", "© me", "https://creativecommons.org/", "https://creativecommons.org/licenses/sampling/1.0/", "https://other.example/licenses/by/4.0/")],
]


def test_licences(spark):
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(LICENCES)], "i int, v string").withColumn("l", licenses.parse_license("v"))
    got = df.orderBy("i").select("l.code", licenses.is_allowed(F.col("l")), licenses.is_allowed(F.col("l"), True)).collect()
    assert [tuple(r) for r in got] == [x[1:] for x in LICENCES]


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression).first()[0]


def test_addresses_and_markup(spark):
    assert one(spark, "https://a.example/x/photos/40/square.png?1", scalars.photo_id_of("v")) == "40"
    assert one(spark, "", scalars.photo_id_of("v")) is None
    assert one(spark, "<b>Tazel</b><br/>Ruvo\n &nbsp; Mo", scalars.plain_text("v")) == "Tazel Ruvo Mo"
    assert one(spark, "Ro &amp; Li &#039;n&#039; Co", scalars.plain_text("v")) == "Ro & Li 'n' Co"
    assert one(spark, "&amp;lt;", scalars.plain_text("v")) == "<"
    assert one(spark, "x" * 500, F.length(scalars.plain_text("v"))) == 200
    assert one(spark, "File:KÖHLER plate.jpg", scalars.is_photo_title("v")) is False


def test_split_fraction(spark):
    assert one(spark, "gbif:1", scalars.split_fraction("v")) == 0.8710871846114954
    assert one(spark, "gbif:1", scalars.split_of("v")) == "val"


def test_split_shares(spark):
    df = spark.range(5000).select(scalars.split_of(F.concat(F.lit("gbif:"), F.col("id").cast("string"))).alias("s"))
    n = {r["s"]: r["count"] / 5000 for r in df.groupBy("s").count().collect()}
    assert abs(n["train"] - 0.8) < 0.03 and abs(n["val"] - 0.1) < 0.03 and abs(n["test"] - 0.1) < 0.03


@pytest.mark.parametrize("h", ["0" * 16, "f" * 16, "8000000000000001", "zz", "", None, " 00000000000000FF "])
def test_hash_bits(spark, h):
    got = one(spark, h, hash_bits("v"))
    ok = h is not None and len(h.strip()) == 16
    assert got == (None if not ok else int(h.strip(), 16) - (1 << 64 if int(h.strip(), 16) >= 1 << 63 else 0))


def test_bands_put_a_hash_together(spark):
    assert [w for _, w in bands(7)] == [9, 9, 9, 9, 9, 9, 10]
    v = int(hashlib.sha256(b"x").hexdigest()[:16], 16)
    cols = [band(hash_bits("v"), c) for c in bands(7)]
    row = spark.createDataFrame([(f"{v:016x}",)], "v string").select(*cols).first()
    assert sum(x << s for x, (s, _) in zip(row, bands(7))) == v


def test_image_rules(spark):
    rows = [("JPEG", 1, 400, 400, None), ("GIF", 1, 400, 400, "format"), ("WEBP", 3, 400, 400, "animated"), ("PNG", 1, 319, 400, "too small"), ("PNG", 1, 400, 4800, None), ("PNG", 1, 400, 4801, "too narrow"), (None, 1, 1, 1, "unreadable")]
    df = spark.createDataFrame(rows, "f string, n int, w int, h int, want string")
    c = F.col
    assert all(r[0] == r[1] for r in df.select("want", scalars.image_verdict(c("f"), c("n"), c("w"), c("h"))).collect())
    assert tuple(df.select(scalars.fitted_size(F.lit(1000), F.lit(1))).first()[0]) == (384, 1)


def test_paths(spark):
    df = spark.createDataFrame([("kept", "_review/a/b.jpg"), ("duplicate", "a/b.jpg"), ("rejected", "")], "s string, p string")
    assert [r[0] for r in df.select(scalars.status_path("s", "p")).collect()] == ["a/b.jpg", "_duplicates/a/b.jpg", ""]
