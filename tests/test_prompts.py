from pyspark.sql import functions as F

from chatloom.functions import prompts as Q
from chatloom.functions import turns as T
from chatloom.operators import open_keys as K


def test_unknown_places_and_nulls_in_templates(spark):
    df = spark.createDataFrame([("a{b}", None)], "x string, y string")
    assert df.select(Q.fill("{x}-{y}-{z}{", x=F.col("x"), y=F.col("y"))).first()[0] == "a{b}--{z}{"


def test_tokens_by_words_and_by_a_tokenizer_agree_on_plain_words(spark):
    df = spark.createDataFrame([("one two  three",), ("",), (None,)], "text string")
    words = [tuple(r) for r in Q.with_tokens(df, "text", 3).select("tokens", "long").collect()]
    assert words == [(3, True), (0, False), (0, False)]
    assert words == [tuple(r) for r in Q.with_tokens(df, "text", 3, str.split).select("tokens", "long").collect()]


def test_whole_numbers_from_json(spark):
    said = ["7", "-7.9", "1e3", "true", "false", "null", '" +8 "', '"1_0"', '"1__0"', '"x"', '""', "[1]", None]
    df = spark.createDataFrame([(s,) for s in said], "j string")
    assert [r[0] for r in df.select(K.integer_of(F.col("j"))).collect()] == [7, -7, 1000, 1, 0, None, 8, 10, None, None, None, None, None]


def test_conversations_without_an_answer(spark):
    df = spark.sql("SELECT array(named_struct('from', 'GPT ', 'value', CAST(NULL AS STRING))) AS c UNION ALL SELECT array(named_struct('from', NULL, 'value', 'x'))")
    assert [r[0] for r in df.select(T.first_assistant_text(F.col("c"))).collect()] == ["", ""]
    asked = df.select(T.asked(F.lit("q"), F.lit("a")).alias("a")).first()["a"]
    assert [tuple(t) for t in asked] == [("user", "q"), ("assistant", "a")]
