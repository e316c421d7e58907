import random

import pytest
from pyspark.sql import functions as F

from lumbung.functions import classify, lexicon, text, topics


def values(spark, rows, make):
    return [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string").orderBy("i").select(make(F.col("x"))).collect()]


def test_clean_and_strip(spark):
    rows = ["  a \t b\n", None, "\x1c x \x1f", "é  z", ""]
    assert values(spark, rows, text.clean_text) == [" ".join((r or "").split()) for r in rows]
    assert values(spark, [r for r in rows if r is not None], text.strip_text) == [r.strip() for r in rows if r is not None]


def test_truncate_counts_code_points(spark):
    assert values(spark, ["é😀x"], lambda c: text.truncate(c, 2)) == ["é😀"]


def test_ids_and_sources(spark):
    urls = ["https://www.health.detik-x1y.com/a", "no scheme", "http://a.co.id/x", "x https://www.b.com.c/", "https://a/b"]
    assert values(spark, urls, text.domain_source)[:4] == ["Health.Detik-X1Y", "News", "A", "B.C"]
    assert values(spark, urls, text.url_id)[4] == "177e8bf5dbad"


def test_urls(spark):
    assert values(spark, ["a.jpg", "a.JPG", "a.jpg?x"], text.not_media) == [False, True, True]
    assert values(spark, ["demam berdarah & x"], text.quote_query) == ["demam%20berdarah%20%26%20x"]
    assert text.topic_url_pattern({"a": ["tb", "demam berdarah", "isk", "covid"]}) == "(demam[-_.]berdarah|covid)"
    assert values(spark, ["X/Kesehatan/1"], lambda c: text.url_keyword(c, "kesehatan")) == [True]


def test_whole_words(spark):
    rows = ["miskin", "ISK berat", "isk_x", "aisk", "(isk)", "éisk"]
    assert values(spark, rows, lambda c: text.any_keyword(c, ["isk"])) == [False, True, False, False, True, False]
    assert values(spark, ["covid-19 covid"], lambda c: text.keyword_count(c, ["covid", "covid-19"])) == [3]


@pytest.mark.parametrize(
    ("title", "content", "label"),
    [
        ("Warga miskin butuh bantuan", "isk", "Umum / Lainnya"), ("Tips hidup sehat", "diabetes kanker", "Umum / Lainnya"), ("Kasus flu burung meningkat", "", "Flu / Influenza"),
        ("Kasus flu burung meningkat", "Virus H5N1 dan H5N6 pada unggas terinfeksi", "Flu Burung"), ("Demam berdarah naik", "", "DBD / Dengue"), ("Demam berdarah naik", "demam tinggi, demam", "Demam"),
        ("Herpes zoster pada lansia", None, "Cacar Ular"), ("Penyakit tikus", "", "HANTA VIRUS"), ("Covid-19 dan flu", "flu flu covid-19", "COVID-19"), ("Stroke dan diabetes", "insulin gula darah", "Diabetes"),
        ("Influenza dan TBC", "", "Flu / Influenza"), ("Flu_burung", "", "Umum / Lainnya"),
    ],
)
def test_topics(spark, title, content, label):
    df = spark.createDataFrame([(title, content)], "t string, c string")
    assert df.select(classify.label_topic(F.col("t"), F.col("c"), topics.TOPICS)).first()[0] == label


@pytest.mark.parametrize("which", ["few", "all"])
def test_topic_expressions_agree(spark, which):
    r = random.Random(1)
    lex = topics.TOPICS if which == "all" else {k: topics.TOPICS[k] for k in ("COVID-19", "Flu / Influenza", "Flu Burung", "Demam")}
    keywords = [w for ws in lex.values() for w in ws]
    words = ["flu", "burung", "Flu Burung", "demam", "tinggi", "tikus", "covid-19", "x", "stroke", "flu_burung", "berdarah", ",", "É", "gula darah"]
    rows = [(i, " ".join(r.choices(words + r.choices(keywords, k=4), k=5)), " ".join(r.choices(words + r.choices(keywords, k=8), k=14))) for i in range(300)]
    rows += [(900, "", "x"), (901, None, "flu"), (902, "flu demam", None)]
    df = spark.createDataFrame(rows, "i int, t string, c string")
    compiled = classify.compiled(lex)
    for x in df.withColumn("a", classify.label_topic(F.col("t"), F.col("c"), lex)).collect():
        assert x["a"] == (classify.topic_of(x["t"], x["c"], compiled) if x["t"] is not None else lexicon.DEFAULT_TOPIC), x


# Golden cases of FIXTURES.md, with the whole lexicon.
GOLDEN = [
    ("Warga miskin butuh bantuan", "isk", "Umum / Lainnya"), ("Tips hidup sehat", "diabetes kanker", "Umum / Lainnya"), ("Kasus flu burung meningkat", "", "Flu / Influenza"),
    ("Kasus flu burung meningkat", "Virus H5N1 dan H5N6 pada unggas terinfeksi", "Flu Burung"), ("Demam berdarah naik", "", "DBD / Dengue"), ("Demam berdarah naik", "demam tinggi, demam", "Demam"),
    ("Herpes zoster pada lansia", "", "Cacar Ular"), ("Penyakit tikus", "", "HANTA VIRUS"), ("Covid-19 dan flu", "flu flu covid-19", "COVID-19"), ("Stroke dan diabetes", "insulin gula darah", "Diabetes"),
    ("Influenza dan TBC", "", "Flu / Influenza"), ("Flu_burung", "", "Umum / Lainnya"), ("Radang usus buntu", "", "Usus Buntu (Apendisitis)"),
]


def test_golden_topics(spark):
    df = spark.createDataFrame(GOLDEN, "t string, c string, label string")
    for x in df.withColumn("a", classify.label_topic(F.col("t"), F.col("c"), topics.TOPICS)).collect():
        assert x["a"] == x["label"], x


def test_golden_places(spark):
    rows = [("Banjir di Papua Barat", "Papua"), ("Wabah di Manokwari", "Papua Barat"), ("Kasus di Kepulauan Riau", "Riau"), ("Batam siaga", "Kepulauan Riau"), ("Maluku Utara", "Maluku"), ("Jakarta dan Banda Aceh", "Aceh"), ("Virus menyerang warga", "Tidak Terdeteksi"), ("Anjing serang warga", "Banten")]
    df = spark.createDataFrame(rows, "t string, label string")
    for x in df.withColumn("a", classify.label_place(F.col("t"))).collect():
        assert x["a"] == x["label"], x


def test_places(spark):
    rows = {"Banjir di Papua Barat": "Papua", "Wabah di Manokwari": "Papua Barat", "Kasus di Kepulauan Riau": "Riau", "Batam siaga": "Kepulauan Riau", "Maluku Utara": "Maluku", "Jakarta dan Banda Aceh": "Aceh", "Virus menyerang warga": "Tidak Terdeteksi", "Anjing serang warga": "Banten"}
    assert values(spark, list(rows), classify.label_place) == list(rows.values())


def test_lexicon_tables(spark):
    table = lexicon.to_table(spark, lexicon.PROVINCES, "location")
    assert lexicon.from_table(table, "location") == lexicon.PROVINCES
    with pytest.raises(ValueError):
        lexicon.checked({"a": ["-x"]})
