from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.topics import field_grams, split_concepts


def _grams(spark, texts, profile, delimiter=None):
    df = spark.createDataFrame([(i, "0", t) for i, t in enumerate(texts)], "topic_id long, field string, text string")
    if delimiter:
        df = split_concepts(df, delimiter)
    rows = field_grams(df, profile).collect()
    return sorted((r.topic_id, r.n, r.t1, r.t2) for r in rows)


def test_char_profile_blank_breaks_bigrams(spark):
    g = _grams(spark, ["ab c"], T.CHAR)
    assert (0, 2, "a", "b") in g
    assert not [x for x in g if x[1] == 2 and " " in (x[2], x[3])]
    assert [x for x in g if x[1] == 1] == [(0, 1, "a", ""), (0, 1, "b", ""), (0, 1, "c", "")]


def test_deleted_punctuation_and_control_chars_bridge_bigrams(spark):
    # the marks and \n are deleted before splitting, so b-c becomes a bigram
    g = _grams(spark, ["ab，\ncd"], T.CHAR)
    assert (0, 2, "b", "c") in g
    # a mark that is not in the list stays a character
    g2 = _grams(spark, ["a（b"], T.CHAR)
    assert (0, 1, "（", "") in g2 and (0, 2, "a", "（") in g2


def test_adjacent_concepts_do_not_form_bigrams(spark):
    g = _grams(spark, ["ab、cd"], T.CHAR, delimiter="、")
    assert (0, 2, "b", "c") not in g
    assert (0, 2, "a", "b") in g and (0, 2, "c", "d") in g


def test_word_profile_lowercases_and_pairs(spark):
    g = _grams(spark, ["The cat, the HAT"], T.WORD)
    assert (0, 2, "cat", "the") in g
    assert sum(1 for x in g if x == (0, 1, "the", "")) == 2


def test_empty_and_missing_fields_give_nothing(spark):
    df = spark.createDataFrame([(0, "0", ""), (1, "0", None), (2, "0", "x")], "topic_id long, field string, text string")
    rows = field_grams(df.fillna(""), T.CHAR).collect()
    assert [(r.topic_id, r.t1) for r in rows] == [(2, "x")]


def test_topic_number_and_doc_key(spark):
    df = spark.createDataFrame([("SETATopicXY001 \n", "Coll/Sub/NEWS_A_17")], "a string, b string")
    r = df.select(T.topic_number("a").alias("n"), T.doc_key("b").alias("k")).first()
    assert (r.n, r.k) == ("001", "news_a_17")


def test_doc_path_drops_repeated_folder(spark):
    df = spark.createDataFrame([("coll/a/b",), ("x/y",)], "p string")
    got = [r.q for r in df.select(T.doc_path("/data/coll/", "p").alias("q")).collect()]
    assert got == ["/data/coll/a/b", "/data/coll/x/y"]


def test_html_paragraphs_skip_scripts_and_unclosed(spark):
    html = ('<html><head><title>T&amp;x</title><script>var t="</p>";</script></head>'
            '<body><p><b>open<br><p>one <i>two</i></p><p class="c">三，</p></body></html>')
    df = spark.createDataFrame([(html,)], "h string")
    r = df.select(T.html_title("h").alias("t"), T.html_paragraphs("h").alias("p")).first()
    assert r.t == "T&x"
    assert r.p == ["one two", "三，"]
    lens = df.select(F.transform(T.html_paragraphs("h"), lambda s: T.cleaned_length(s)).alias("l")).first().l
    assert lens == [7, 1]
