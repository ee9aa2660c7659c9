from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkrank.functions import term_counts, tokenize

BLANKS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
NOT_BLANK = "\u200b\u180e\ufeff_-"


def tokens_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = df.select("i", tokenize(F.col("text")).alias("t")).orderBy("i").collect()
    return [list(r["t"]) for r in rows]


def test_tokens_are_those_of_str_split(spark):
    texts = [f"a{b}b{b}{b}c{b}" for b in BLANKS] + ["", "   ", " lead", "trail ", "A a, a."]
    texts += [f"x{c}y" for c in NOT_BLANK]
    assert tokens_of(spark, texts) == [t.split() for t in texts]


def test_null_text_has_no_tokens(spark):
    assert tokens_of(spark, [None]) == [[]]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.text(alphabet="ab\u00e9 \n\t\u2003\u3000\x1c\U0001d538", max_size=30),
        min_size=1,
        max_size=20,
    )
)
def test_term_counts_equal_counter(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = (
        df.select("i", term_counts(tokenize(F.col("text"))).alias("c")).orderBy("i").collect()
    )
    for text, row in zip(texts, rows, strict=True):
        assert {c["term"]: c["tf"] for c in row["c"]} == Counter(text.split())
