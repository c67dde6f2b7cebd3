"""Queries over small tables that hold the rows which their SQL leaves out."""

import pytest

from phyllo.plans.registry import queries


@pytest.fixture
def run(spark, tmp_path):
    """Runs a query over tables given as name=(rows, schema)."""

    def go(query, **tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return queries()[query](spark, str(tmp_path)).collect()

    return go


LICENCES = ["CC BY 4.0", "cc0", "CC BY-NC 4.0", None, "", "Public Domain Mark 1.0", "pd", "https://creativecommons.org/licenses/by/3.0/", "https://elsewhere.example/licenses/by/4.0/"]


def test_agg07_counts_every_licence(run):
    rows = [("gbif", x, "kept", f"species {i}", {"quality_grade": "research"}) for i, x in enumerate(LICENCES)]
    rows += [("wikimedia", None, "kept", "a", {}), ("wikimedia", "Public Domain Mark 1.0", "rejected", "b", None)]
    got = {r["source"]: (r["n_all"], r["n_free"], r["kept_species"], r["research"]) for r in run("agg07_filtered_counts", records=(rows, "source string, license string, status string, species string, extra map<string,string>"))}
    assert got == {"gbif": (9, 4, 9, 9), "wikimedia": (2, 0, 1, 0)}


def test_scl10_lists_every_notation(run):
    got = {r["license"]: (r["n"], r["code"]) for r in run("scl10_parse_license", records=([(x,) for x in [*LICENCES, None]], "license string"))}
    codes = ["CC BY 4.0", "CC0 1.0", "CC BY-NC 4.0", None, None, None, "Public Domain Mark 1.0", "CC BY 3.0", None]
    assert got == {x: (2 if x is None else 1, c) for x, c in zip(LICENCES, codes, strict=True)}


PLANTS = [
    ("ficus-elastica", "Ficus elastica", "Ficaceae", "Ficus decora"), ("ficus-decora", "Ficus decora", "Ficaceae", ""), ("citrus-limon", "Citrus limon", "Paroraceae", ""),
    ("x-fatshedera-lizei", "× Fatshedera lizei", "Paroraceae", ""), ("rosa-canina", "Rosa canina", "Rosaceae", ""), ("x-cuprocyparis-leylandii", "× Cuprocyparis leylandii", "Paroraceae", None),
]
PLANTS = (PLANTS, "internal_id string, scientific_name string, family string, synonyms string")
SPLITS = ([("ficus-elastica",), ("citrus-x-limon",), ("x-fatshedera-lizei",), (None,), ("",)], "internal_plant_id string")


def test_jn10_every_fallback(run):
    got = {r["asked"]: (r["label"], r["how"]) for r in run("jn10_resolve_labels", plants=PLANTS, splits=SPLITS)}
    assert got == {
        "ficus-elastica": ("ficus-elastica", "direct"), "ficus-decora": ("ficus-elastica", "synonym"), "citrus-limon": ("citrus-x-limon", "hybrid"),
        "x-fatshedera-lizei": ("x-fatshedera-lizei", "direct"), "rosa-canina": (None, None), "x-cuprocyparis-leylandii": (None, None),
    }


def test_jn13_every_species(run):
    records = [("× Fatshedera lizei", "x-fatshedera-lizei"), ("Citrus limon", ""), ("× Cuprocyparis leylandii", None), ("Ficus elastica", "ficus-elastica")]
    got = run("jn13_mapped_classes", plants=PLANTS, records=(records, "species string, internal_plant_id string"))
    assert sorted(map(tuple, got)) == [("Citrus limon", "citrus-limon"), ("× Cuprocyparis leylandii", "x-cuprocyparis-leylandii"), ("× Fatshedera lizei", "x-fatshedera-lizei")]


def test_jn14_every_kind(run):
    records = [("plantnet300k", "Rosa canina", "CC0 1.0", "kept"), ("plantnet300k", "Rosa canina", "CC BY 4.0", "kept"), ("plantnet300k", "× Fatshedera lizei", "CC0 1.0", "rejected"), ("plantnet300k", "Unknown", None, "kept"), ("gbif", "Rosa canina", "CC0 1.0", "kept")]
    got = {(r["kind"], r["key"]): r["n"] for r in run("jn14_foreign_counts", plants=PLANTS, records=(records, "source string, species string, license string, status string"))}
    assert got == {
        ("license", "CC0 1.0"): 2, ("license", "CC BY 4.0"): 1, ("license", "?"): 1, ("whole", ""): 3, ("organ", "kept"): 2, ("organ", "rejected"): 1,
        ("species", "rosa-canina"): 2, ("species", "x-fatshedera-lizei"): 1,
    }


def test_names_with_a_sign_before_the_genus(run):
    assert {r["internal_id"]: r["comparable"] for r in run("scl06_comparable", plants=PLANTS)}["x-fatshedera-lizei"] == "fatshedera lizei"
    got = {r["internal_id"]: (r["genus"], r["epithet"]) for r in run("scl05_genus_epithet", plants=PLANTS)}
    assert got["rosa-canina"] == ("Rosa", "canina") and got["x-fatshedera-lizei"] == ("Fatshedera", "Fatshedera")


def test_sel01_every_plant(run):
    got = run("sel01_keep_candidates", plants=PLANTS, splits=SPLITS)
    assert sorted(r[0] for r in got) == ["ficus-decora", "rosa-canina", "x-cuprocyparis-leylandii"]
