"""Names, tokens, leaks and stuffing on small cases."""

import itertools
import os
import random
import time

import pytest

from phyllo.llm import bpe, eval_leaks, keyword_spam, name_matching

PLANTS = [
    ("monstera-deliciosa", "Monstera deliciosa", "Tornelia fragrans Gutierrez|  Philodendron  pertusum"), ("citrus-x-limon", "Citrus × limon", None), ("ficus-elastica", "Ficus elastica", ""),
    ("ficus-benjamina", "Ficus benjamina", None), ("ficus-benjamina-var-nuda", "Ficus benjamina var. nuda", None), ("x-fatshedera-lizei", "× Fatshedera lizei", None), ("dracaena-trifasciata", "Dracaena trifasciata", "Sansevieria trifasciata Prain"),
    (None, "Nothing here", None), ("blank", None, None),
]
ASKED = [
    ("Monstera deliciosa", "monstera-deliciosa"), ("MONSTERA  DELICIOSA Liebm.", "monstera-deliciosa"), ("Mönstera_deliciósa (L.) Auct., 1893", "monstera-deliciosa"), ("citrus limon", "citrus-x-limon"), ("Citrus &times; limon", "citrus-x-limon"),
    ("Citrus ×limon 'Meyer'", "citrus-x-limon"), ("Fcus elastica", "ficus-elastica"), ("Ficus elatsica", "ficus-elastica"), ("Ficus elastcia var.", "ficus-elastica"), ("F. elastica", "ficus-elastica"), ("M. deliciosa cv. Aurea", "monstera-deliciosa"),
    ("Ficus benjamina var. nuda (Miq.) Barrett", "ficus-benjamina-var-nuda"), ("Ficus benjamina v. nvda", "ficus-benjamina-var-nuda"), ("Ficus benjamina L.", "ficus-benjamina"), ("Ficus bejamina var. nvda", "ficus-benjamina-var-nuda"), ("Ficus benjamina var. alba", "ficus-benjamina"), ("x Fatshedera lizei", "x-fatshedera-lizei"), ("Sansevieria trifasciata", "dracaena-trifasciata"),
    ("tornelia fragrans", "monstera-deliciosa"), ("Ficus cf. elastica ?", "ficus-elastica"), ("Ficus sp.", ""), ("Ficus", ""), ("Ficus hybrid", ""), ("Plantae", ""), ("12", ""), ("", ""), (" ", ""), (None, ""), ("Rosa canina", ""), ("Ficus lyrata", ""), ("x" * 20_000, ""),
]


def plants(spark, rows=None):
    return spark.createDataFrame(PLANTS if rows is None else rows, "internal_id string, scientific_name string, synonyms string")


def test_names(spark):
    rows = [(i, a, None, "extra") for i, (a, _) in enumerate(ASKED)] + [(100 + i, None, a, "extra") for i, (a, _) in enumerate(ASKED)]
    df = spark.createDataFrame(rows, "answer_id long, matched_as string, canonical_name string, internal_id string")
    for block in (100_000, 2):
        got = dict(map(tuple, name_matching.match_names(df.drop("internal_id"), plants(spark), block=block).collect()))
        assert [got[i] for i in range(len(ASKED))] == [b for _, b in ASKED]
        assert [got[100 + i] for i in range(len(ASKED))] == [got[i] for i in range(len(ASKED))]
    assert set(r[1] for r in name_matching.match_names(df, plants(spark, []), columns=("matched_as",)).collect()) == {""}
    assert name_matching.match_names(df.limit(0), plants(spark)).count() == 0
    lost = {r["value"]: r["n_answers"] for r in name_matching.unmatched(df, plants(spark)).collect()}
    assert lost["Rosa canina"] == 2 and "Ficus elastica" not in lost


FREE = [
    ("deliciosa Monstera", "monstera-deliciosa"), ("elastica (Ficus)", "ficus-elastica"), ("delicioza, Monstera", "monstera-deliciosa"), ("Monstera huge deliciosa", "monstera-deliciosa"), ("Ficus (elastica)", "ficus-elastica"),
    ("Ficuselastica", "ficus-elastica"), ("Fi cus elas tica", "ficus-elastica"), ("Mon ste radelic iosa", "monstera-deliciosa"), ("M. delicosa", "monstera-deliciosa"), ("F. elastita", ""), ("Rosa canina (Ficus elastica)", ""), ("elastica", ""),
]


@pytest.mark.parametrize("block", [100_000, 3, 1])
def test_names_in_any_order(spark, block):
    df = spark.createDataFrame([(i, a, None) for i, (a, _) in enumerate(FREE)], "answer_id long, matched_as string, canonical_name string")
    more = plants(spark, [*PLANTS, ("felicia-elastita", "Felicia elastita", None), ("ficus-elastata", "Ficus elastata", "Fagus elastita")])
    want = [b for _, b in FREE]
    got = dict(map(tuple, name_matching.match_names(df, more, block=block, piece=5).collect()))
    assert [got[i] for i in range(len(FREE))] == want
    own = spark.createDataFrame([(1, "F. elastica", None)], "answer_id long, matched_as string, canonical_name string")
    assert name_matching.match_names(own, plants(spark, [("ficus-elastica", "Ficus elastica", None), ("felicia-elastita", "Felicia elastita", None)]), block=block).first()["internal_id"] == "ficus-elastica"


def test_blocks_dont_change_answers(spark):
    from phyllo.session import table

    data = "/root/testdata/sf0.01"
    if not os.path.isdir(data):
        pytest.skip("no test tables")
    answers, listed = table(spark, data, "name_answers"), table(spark, data, "plants")
    one, few, many = ({(r["answer_id"], r["internal_id"]) for r in name_matching.match_names(answers, listed, block=n).collect()} for n in (100_000, 300, 50))
    assert one == few == many


def test_distance():
    def slow(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    rng = random.Random(0)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(9)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(9)))
        for most in (0, 1, 2, 3):
            assert name_matching.distance(a, b, most) == min(slow(a, b), most + 1), (a, b, most)


TEXTS = [None, "", " ", "Hello world", "it's 'S 're we'll", "<|endoftext|>x", "é　x  \n\n y ", "日本語テキスト" * 50, "\U0001f33f\U0001f3fd‍", "a" * 5000, "1234567 ½ ٣", "\u0085z ", "ab" * 3000, "�﻿", "x\x00y\x1fz"]


def test_bpe(spark):
    tiktoken = pytest.importorskip("tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", mergeable_ranks=bpe.read_ranks(bpe.vocabulary()), special_tokens={})
    rows = [(i, t, "ids") for i, t in enumerate(TEXTS)] + [(3, "Hello world", "ids"), (None, "again", "ids")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode(df)
    few = {(r["doc_id"], tuple(r["ids"])) for n in (0, 3) for r in bpe.encode(df, frequent=n).collect()}
    assert few == {(r["doc_id"], tuple(r["ids"])) for r in got.collect()}
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append(r["ids"])
    for i, t, _ in rows:
        assert by[i][0] == (encoding.encode_ordinary(t) if t else []), t
    assert len(by[3]) == 2 and len(got.collect()) == len(rows)
    back = {r["doc_id"]: r["text"] for r in bpe.decode(got).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS))
    assert bpe.encode(df.limit(0)).count() == 0


def test_another_pattern(spark):
    tiktoken = pytest.importorskip("tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=r"\d|\D+", mergeable_ranks=bpe.read_ranks(bpe.vocabulary()), special_tokens={})
    texts = ["room 1204 is warm", "77", "no number"]
    got = bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), pattern=r"[0-9]|[^0-9]+").collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: encoding.encode_ordinary(t) for i, t in enumerate(texts)}


def test_long_words():
    ranks = bpe.read_ranks(bpe.vocabulary())
    tiktoken = pytest.importorskip("tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(0)
    for n in (0, 1, 2, 3, 50, 700, 3000):
        for alphabet in ("a", "ab", "the quick", "é日a"):
            word = "".join(rng.choice(alphabet) for _ in range(n))
            assert bpe.merge_bytes(word.encode(), ranks) == encoding.encode_ordinary(word), (n, alphabet)
    began, tokens = time.time(), {r: t for t, r in ranks.items()}
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000)).encode()
    assert b"".join(tokens[i] for i in bpe.merge_bytes(word, ranks)) == word
    assert time.time() - began < 20


ITEM = "While a curled petiole keeps the dense margin, the silvery label slowly holds 179 times the deep tuber. Near the window the ribbed sheath protects a vein because the radiator seldom tightens the filtered canopy."


def leaked(spark, texts, items=((1, ITEM, "test"), (2, None, "val"), (3, "", "val"), (4, "too short to leak", "val")), **kw):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    return sorted((r["doc_id"], r["item_id"]) for r in eval_leaks.leaks(docs, spark.createDataFrame(list(items), "item_id long, text string, split string"), **kw).collect())


def test_leaks(spark):
    w = ITEM.split()
    noise = "Give it water once a week and keep it in the shade of other plants. " * 30
    changed = [x if i % 10 != 4 else "other" for i, x in enumerate(w)]
    texts = [
        ITEM, noise + " ".join(w[5:22]) + noise, ITEM.upper(), noise + " ".join(changed), "<b>" + "</b> <i>".join(w) + "</i>", " ".join(x for i, x in enumerate(w) if i % 11 != 3), ITEM.replace("179", "23"),
        None, "", " ", noise, " ".join(w[:8]) + noise, " ".join(reversed(w)), " ".join(random.Random(1).sample(w, len(w))), noise * 200 + " ".join(w[3:20]), "ﬀ " + ITEM.replace("e", "é"),
    ]
    assert leaked(spark, texts) == [(i, 1) for i in (0, 1, 2, 3, 4, 5, 6, 14, 15)]
    assert leaked(spark, texts, items=[(i, ITEM if i == 7 else f"item {i} " * 20, "t") for i in range(30)], block=4) == [(i, 7) for i in (0, 1, 2, 3, 4, 5, 6, 14, 15)]
    assert leaked(spark, []) == [] and leaked(spark, texts, items=[]) == []


def test_slots():
    items = eval_leaks.Items([(1, "Mix 3 parts of bark with 5 parts of peat and 3 parts of sand then wait 9 days before the first light watering")], frozenset())
    assert items.leaks("Mix 7 parts of bark with 2 parts of peat and 7 parts of sand then wait 4 days before the first light watering")[0][1] == 24
    assert items.leaks("Mix 7 parts of bark with 2 parts of peat and 8 parts of sand then wait 4 days before the first light watering")[0][1] == 23
    assert eval_leaks.tokens("un pÃ©tiole <b>l’eau</b>") == ["un", "petiole", "l", "eau"]


def test_slots_both_ways():
    items = eval_leaks.Items([(1, "Mix 3 parts of bark with 5 parts of peat and 3 parts of sand then wait 9 days before the first light watering")], frozenset())
    one = items.leaks("Mix 7 parts of bark with 7 parts of peat and 7 parts of sand then wait 7 days before the first light watering")
    assert one[0][1] == 22  # the 5 and the 9 may not become 7 as well
    many = eval_leaks.Items([(1, "Add 1 of bark 2 of peat 3 of sand 4 of moss 5 of grit 6 of loam 7 of ash 8 of leaf")], frozenset())
    assert many.leaks("Add 9 of bark 9 of peat 9 of sand 9 of moss 9 of grit 9 of loam 9 of ash 9 of leaf") == []
    assert many.leaks("Add 11 of bark 12 of peat 13 of sand 14 of moss 15 of grit 16 of loam 17 of ash 18 of leaf")[0][1] == 25


def test_any_number_of_items(spark):
    rng = random.Random(3)
    vocabulary = [f"w{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(25)), "t") for i in range(40)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(60)) + " " + " ".join(rng.choice(items)[1].split()[rng.randrange(5) :][:20]) for _ in range(60)]
    direct = leaked(spark, texts, items=items)
    assert len(direct) >= 50 and leaked(spark, texts, items=items, block=3) == direct


def test_leak_report(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (2, ITEM, "b"), (3, None, None)], "doc_id long, text string, source string")
    items = spark.createDataFrame([(1, ITEM, "test"), (2, None, "val")], "item_id long, text string, split string")
    assert sorted(map(tuple, eval_leaks.leak_report(docs, items).collect())) == [(1, "test", 2, 2), (2, "val", 0, 0)]


PROSE = "The plant likes a shaded place and the soil should never dry out. If the leaves turn yellow, it is because of the water. "
LOG = "\n".join(f"[{i}/90] Ficus name{i}: {i * 3} kept (gbif {i}, inat {i * 2})" for i in range(1, 60))
STUFFED = [
    "cheap plants, buy plants online, best price ficus, " * 20, "\n".join(f"https://shop.example/{i}" for i in range(40)), "#plant #ficus #sale #root " * 20, " ".join(f'<a href="http://x.example/{i}">plant sale</a>' for i in range(30)),
    "\n".join(f"Ficus elastica M SKU-{i}00 {i},99 EUR sale" for i in range(20)), "order now ficus order now elastica best price " * 15, PROSE + "[sale](https://a.example/b) " * 60, "leaf root bark stem tuber bract vein node crown sepal anther petiole margin sheath cutting tray label shelf lamp pot moss " * 3,
]
HONEST = [None, "", " \n", "!?", PROSE, PROSE * 40, LOG, PROSE * 3 + "Tags: #ficus #root", PROSE * 5 + "\n[1] " + PROSE + " https://herbarium.example/a/1", "1. Keep it in the shade.\n2. Water it once a week.\n3. The leaves are green.", "Ficus elastica: The leaf is green and it grows to 3 m.\nFicus lyrata: The leaf is large and it likes the light."]


@pytest.mark.parametrize("text", STUFFED)
def test_stuffed(text):
    assert keyword_spam.stuffing(text)[0] > 0.5


@pytest.mark.parametrize("text", HONEST)
def test_honest(text):
    assert text is None or keyword_spam.stuffing(text)[0] <= 0.5


def test_spam_table(spark):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(STUFFED + HONEST)], "doc_id long, text string, stuffed double")
    assert {r["doc_id"] for r in keyword_spam.spam(docs).collect()} == set(range(len(STUFFED)))
    assert keyword_spam.spam(docs.limit(0)).count() == 0


FOREIGN = [
    "Комнатные растения требуют регулярного полива и хорошего освещения. Зимой воду дают реже, потому что рост замедляется. Весной пересадите цветок в более просторный горшок.",
    "Bitkiyi doğrudan güneş ışığından uzak tutmak gerekir. Toprak kurudukça haftada bir kez sulama yapılır. Kışın sulama sıklığı azaltılmalıdır çünkü büyüme yavaşlar.",
    "A növényt közvetlen napfénytől védett helyen kell tartani. A földet csak akkor öntözzük, amikor a felső rétege kiszáradt. Télen ritkábban kap vizet, mert lassabban nő.",
    "Roślinę należy ustawić w jasnym miejscu z dala od kaloryfera. Podlewamy ją raz w tygodniu, gdy wierzchnia warstwa ziemi przeschnie. Zimą ograniczamy podlewanie i nie nawozimy.",
    "Zet de plant op een lichte plek zonder felle middagzon. Geef eens per week water en laat de grond tussendoor opdrogen. In de winter groeit de plant langzamer en heeft hij minder nodig.",
]
LEARNED = keyword_spam.Learned({"en": {"the": True, "a": True, "for": False, "and": False, "of": False, "it": False}})


@pytest.mark.parametrize("text", FOREIGN)
@pytest.mark.parametrize("lang", ["", "en", "xx"])
def test_prose_of_unknown_languages_stays(text, lang):
    assert keyword_spam.stuffing(text, lang)[0] == keyword_spam.stuffing(text, lang, LEARNED)[0] == 0


@pytest.mark.parametrize("text", ["buy plants for the garden and cheap plants for the garden " * 60, "buy the monstera, buy the monstera " * 30])
def test_function_words_dont_excuse_repetition(text):
    assert keyword_spam.stuffing(text)[0] > 0.5 < keyword_spam.stuffing(text, "en", LEARNED)[0]


def test_function_words_are_learned(spark):
    rng = random.Random(5)
    nouns, rows = [f"noun{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)], []
    for i in range(60):
        rows.append((i, " ".join(f"The {rng.choice(nouns)} of the {rng.choice(nouns)} keeps {rng.choice(nouns)} near." for _ in range(6)), "EN" if i % 2 else "en-GB"))
    rows += [(100, None, "en"), (101, "", "en"), (102, "kot ma mleko i nic poza tym.", "pl")]
    got = {(r["lang"], r["word"]): r["share"] for r in keyword_spam.function_words(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert set(got) == {("en", w) for w in ("the", "of", "keeps", "near")} and all(abs(x - 1) < 1e-9 for x in got.values())
    known = keyword_spam.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert keyword_spam.stuffing(" ".join(nouns[:90]), "en", known)[0] == 1
