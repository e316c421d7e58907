"""The default topic lexicon is the whole one."""

from lumbung.functions import lexicon
from lumbung.plans import articles


def test_default_topics(spark):
    context = articles.Context("2026-11-26T12:00:00")
    assert len(context.topics) == 49 and sum(map(len, context.topics.values())) == 270 and lexicon.checked(context.topics) == context.topics
    rows = [(1, "S", "Kasus malaria naik", "nyamuk", "u1", None), (2, "S", "Waspada mpox", None, "u2", None), (3, "S", "Stroke iskemik", "", "u3", None), (4, "S", "Cuaca cerah", "malaria", "u4", None)]
    items = spark.createDataFrame(rows, "seq long, source string, title string, content string, url string, pub struct<instant: timestamp, local: timestamp_ntz>")
    assert [r["Penyakit"] for r in articles.make_rows(items, context).orderBy("seq").collect()] == ["Malaria", "Mpox", "Stroke", lexicon.DEFAULT_TOPIC]
