import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomcurate.functions import chat
from loomcurate.functions import text as tx


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "url,want",
    [
        ("HTTPS://Host.Example:8080/a/b//?q=1#f", "https://Host.Example:8080/a/b"),
        ("http://user@h/p;x=1", "http://user@h/p"),
        ("https://h", "https://h"),
        ("https://h/", "https://h"),
        ("https://h?q", "https://h"),
        ("/plain/path/?q", "/plain/path"),
    ],
)
def test_normalize_url(spark, url, want):
    assert one(spark, tx.normalize_url(F.col("u")), u=url) == want


@pytest.mark.parametrize("text", ["a b", "a b\x1cc\x85d", "", "  ", "one two\tthree\n"])
def test_word_count_is_that_of_split(spark, text):
    assert one(spark, tx.word_count(F.col("t")), t=text) == len(text.split())


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB é \t\n\x1c.1", max_size=12), min_size=1, max_size=20))
def test_scalars_equal_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", tx.word_count(F.col("t")).alias("n"), tx.normalized_hash(F.col("t")).alias("h"), tx.is_blank(F.col("t")).alias("b")).collect()
    for r in got:
        assert r["n"] == len(r["t"].split())
        assert r["h"] == hashlib.sha256(r["t"].strip().lower().encode()).hexdigest()
        assert r["b"] == (not r["t"].strip())


@pytest.mark.parametrize(
    "text,want",
    [
        ("metadata only", None),
        ("we use META here", "meta"),
        ("émeta", None),
        ("meta_x", None),
        ("such as x and far away meta", None),
        ("such as\nmeta", "meta"),
        ("github or google", "google"),
        ("ask stack overflow", "stack overflow"),
        (None, None),
    ],
)
def test_brand_leak(spark, text, want):
    assert one(spark, tx.brand_leak(F.col("t")), t=text) == want


def test_fill_is_sequential(spark):
    got = one(spark, tx.fill(F.lit("{a}-{b}"), {"a": F.col("a"), "b": F.col("b")}), a="x{b}", b="$1")
    assert got == "x$1-$1"


def test_html_text_drops_scripts_first(spark):
    html = "<html><head><title>T &amp; x</title><script>var a='</p>';</script></head><body><p>One  two</p><!-- no --><div>a&lt;b</div><footer>f</footer></body></html>"
    assert one(spark, tx.html_text(F.col("h")), h=html) == "T & x One two\na<b"
    assert one(spark, tx.html_text(F.col("h")), h="<p></p>") is None
    assert one(spark, tx.first_filled(tx.html_title(F.col("h")), F.lit("feed")), h="<title></title>") == "feed"


def test_truncate_and_lists(spark):
    assert one(spark, tx.truncate_words(F.col("t"), 2), t="a  b c") == "a b"
    assert one(spark, tx.truncate_words(F.col("t"), 3), t="a  b c") == "a  b c"
    assert one(spark, tx.joined(F.array(F.col("t"), F.lit("y"))), t="x") == "x, y"
    assert one(spark, tx.joined(F.array().cast("array<string>"), "none specified"), t="x") == "none specified"


def test_messages(spark):
    row = spark.range(1).select(
        chat.single_turn(F.lit("q"), F.lit("a"), F.lit("f"), "P").alias("s"),
        chat.multi_turn(F.expr("array(struct('u' as user, 'c' as chain_of_thought, 'r' as response))"), "P").alias("m"),
    )
    got = row.select("s", "m", chat.render(F.col("s")).alias("t"), chat.to_json(F.col("s")).alias("j"), chat.response_mask(F.col("m")).alias("k")).first()
    assert [(m["role"], m["content"], m["channel"]) for m in got["s"]] == [("developer", "P", None), ("user", "q", None), ("assistant", "a", "analysis"), ("assistant", "f", "final")]
    assert len(got["m"]) == 4 and [m["train"] for m in got["k"]] == [False, False, False, True]
    assert got["j"].startswith('[{"role":"developer","content":"P"},') and "null" not in got["j"]
    assert got["t"].endswith("<|start|>assistant<|channel|>final<|message|>f<|end|>")
