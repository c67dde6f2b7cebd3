import pytest
from pyspark.sql import functions as F

from phyllo.functions import names

#: Invented names, one a rule: authors, years, case, blanks, hybrid signs, ranks, cultivars, underscores, accents.
CANONICAL = [
    ("Tazela ruvora Mill. ex Bo", "Tazela ruvora"), ("Tazela ruvora (Mill.) Bo, 1799", "Tazela ruvora"), ("TAZELA RUVORA", "Tazela ruvora"), ("tazela ruvora", "Tazela ruvora"), ("\t Tazela \u00a0 ruvora ", "Tazela ruvora"),
    ("Tazela × mola Bo", "Tazela × mola"), ("Tazela ×mola", "Tazela × mola"), ("Tazela x mola", "Tazela × mola"), ("Tazela ×", "Tazela"), ("× Tazelora mola Bo", "× Tazelora mola"),
    ("Tazela ruvora subsp. pina (Bo) Mill.", "Tazela ruvora subsp. pina"), ("Tazela ruvora VAR. pina", "Tazela ruvora var. pina"), ("Tazela 'Red Moon'", "Tazela 'Red Moon'".replace(" Moon", "")), ("Tazela ruvora, Bo", "Tazela ruvora"),
    ("Tazéla_ruvöra", "Tazela ruvora"), ("Tazela", "Tazela"), ("", ""), (" ", ""), (None, ""),
]


def values(spark, rows, *cols):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(len(rows[0]))))
    return [tuple(r)[1:] if len(cols) > 1 else r[1] for r in df.select("i", *cols).orderBy("i").collect()]


def test_canonical(spark):
    assert values(spark, [(a,) for a, _ in CANONICAL], names.canonical_name("c0")) == [b for _, b in CANONICAL]


def test_slug_and_id(spark):
    got = values(spark, [("Tazela × mola",), ("Tazela ruvora var. pina",), ("× Tazelora mola",), ("Tazela",)], names.slug("c0"), names.internal_id("c0"), names.genus_of("c0"), names.epithet_of("c0"))
    assert got == [("Tazela_x_mola", "tazela-x-mola", "Tazela", "mola"), ("Tazela_ruvora_var_pina", "tazela-ruvora-var-pina", "Tazela", "ruvora"), ("x_Tazelora_mola", "x-tazelora-mola", "Tazelora", "Tazelora"), ("Tazela", "tazela", "Tazela", "")]


def test_variants(spark):
    got = values(spark, [("Tazela × mola",), ("Tazela",)], F.array_join(names.title_variants("c0"), "|"), names.comparable("c0"))
    assert got == [("Tazela × mola|Tazela x mola|Tazela mola", "tazela mola"), ("Tazela", "tazela")]
    assert values(spark, [("tazela-x-mola",), ("tazela-mola",)], F.array_join(F.array_sort(names.id_variants("c0")), "|")) == ["tazela-mola|tazela-x-mola"] * 2


@pytest.mark.parametrize(
    ("name", "parent", "want"),
    [
        ("Tazela ruvora ʽMoon’", "Tazela ruvora", "Moon"), ("Tazela `Two Moons´ x", "Tazela", "Two Moons"), ("TAZELA ruvora Moon", "Tazela ruvora", "Moon"), ("Tazela ruvora moon", "Tazela ruvora", None),
        ("Tazela Var. pina", "Tazela", None), ("Other Moon", "Tazela", None), ("Tazela", "Tazela", None), ("", "", None), (None, None, None),
    ],
)
def test_cultivar(spark, name, parent, want):
    assert values(spark, [(name, parent)], names.cultivar("c0", "c1")) == [want]
