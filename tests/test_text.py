"""Golden cases of the scalar expressions."""

import pytest

from shelfwise.functions import ngrams, text

WEIGHTS = [
    ("Чипсы 1,5 КГ", 1500), ("100гр", 100), ("0.57кг 40г", 570), ("1.005 кг", 1004), ("5 глаз", 5),
    ("нет", None), (None, None), ("5 г", None), ("4607012351999г", 4607012351999),
]
PACKS = [
    ("Чипсы туба 100г", "Туба"), ("PRINGLES 165г", "Туба"), ("American snack", "Туба"), ("Чипсы 50г", "Пакет"),
    ("Big Bon Chips", "Туба"), (None, "Пакет"),
]
ADDRESSES = [
    ("г.Челябинск, ул. Мира", "город челябинск улица мира"), ("г. Москва", "г москва"), (None, ""),
    ("Респ Татарстан, пр-кт Ленина", "республика татарстан проспект ленина"), ("бульвар угол", "бульвар угол"),
]
PLACES = [("«Санкт-Петербург»", "санкт петербург"), (None, ""), (" A \tb. ", "a b")]
BRANDS = [("Lay's 150г Краб/сыр", "lay s краб сыр"), (None, ""), ("ЁЖ 5шт", "ёж")]
TITLES = [("big-bon o'neil 5d", "Big-Bon O'Neil 5D"), (" LAY'S ", "Lay'S"), ("от мартина", "От Мартина")]
TABLES = [("Magnit_Янв-2024.csv", "magnit_____2024"), ("x5_a.b.csv", "x5_a_b")]


@pytest.mark.parametrize(
    "function, cases",
    [
        (text.extract_weight_g, WEIGHTS),
        (text.packaging_type, PACKS),
        (text.normalize_address, ADDRESSES),
        (text.clean_place_text, PLACES),
        (text.clean_brand_text, BRANDS),
        (text.normalize_brand_label, TITLES),
        (text.table_name_for, TABLES),
        (text.preprocess_text, [("\n Ab \t", "ab"), (None, "")]),
        (text.compose_features, [("г.Омск, ул. Мира", "город омск улица мира natasha:омск"), (None, " natasha:")]),
    ],
    ids=lambda p: getattr(p, "__name__", ""),
)
def test_golden(spark, function, cases):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    got = [r["v"] for r in df.select("i", function("t").alias("v")).orderBy("i").collect()]
    assert got == [c[1] for c in cases]


def test_no_python_in_the_plans(spark, capsys):
    df = spark.createDataFrame([("a",)], "t string")
    df.select(text.extract_weight_g("t"), text.normalize_address("t"), ngrams.char_ngrams("t", 3, 6)).explain()
    assert "Python" not in capsys.readouterr().out


def _char_grams(value: str, low: int, high: int) -> list[str]:
    found = []
    for word in value.lower().split():
        padded = f" {word} "
        for n in range(low, high + 1):
            found += [padded[i : i + n] for i in range(max(1, len(padded) - n + 1))]
            if len(padded) <= n:
                break
    return found


@pytest.mark.parametrize("value", ["в", "Город Омск", "a bb  ccc dddd\neeeee ffffffff", ""])
def test_char_ngrams(spark, value):
    df = spark.createDataFrame([(value,)], "t string")
    got = df.select(ngrams.char_ngrams("t", 3, 6).alias("g")).first()["g"]
    assert got == _char_grams(value, 3, 6)


def test_word_ngrams_of_short_texts(spark):
    df = spark.createDataFrame([("Сырный чипс г 5", ), ("один",), ("",)], "t string")
    tokens = df.withColumn("k", ngrams.word_tokens("t", ngrams.BRAND_STOP_WORDS))
    got = [r["g"] for r in tokens.select(ngrams.word_ngrams("k", 1, 3).alias("g")).collect()]
    assert got == [["сырный", "чипс", "сырный чипс"], ["один"], []]


def test_char_ngrams_pad_each_word_once(spark):
    """Nothing is joined per gram; grams equal brute force, also of words shorter than n."""
    assert "substring(concat" not in ngrams.char_ngrams_sql("t", 3, 6)
    texts = ["", None, " a  Ёж\tсыр🧀 ", "x", "abcdefgh"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = dict(df.select("id", ngrams.char_ngrams("t", 3, 6)).collect())
    for i, t in enumerate(texts):
        want = []
        for w in (f" {w} " for w in (t or "").lower().split()):
            for n in range(3, min(6, max(3, len(w))) + 1):
                want += [w[k : k + n] for k in range(max(1, len(w) - n + 1))]
        assert got[i] == (None if t is None else want)
