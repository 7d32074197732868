from conftest import rows
from pyspark.sql import functions as F

from encore.config import DURATION_BIN_LABELS, DURATION_EDGES, DURATION_LABELS
from encore.functions import (
    adjacent_pairs,
    bin_label,
    clean_text,
    clip_keep_null,
    compact_number,
    flip_the,
    gate_range,
    lenient,
    match_key,
    minutes_seconds,
    model_slug,
    non_blank_lines,
    word_list,
    year_prefix,
)


def apply(spark, values, schema, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_lenient_and_gates(spark):
    assert apply(spark, ["1999", "x", "", None], "string", lambda v: lenient(v, "int")) == [1999, None, None, None]
    assert apply(spark, [1899, 1900, 2025, 2026, None], "int", lambda v: gate_range(v, 1900, 2025)) == [None, 1900, 2025, None, None]
    assert apply(spark, [-5.0, 10.0, 950.0, None], "double", lambda v: clip_keep_null(v, 0.0, 900.0)) == [0.0, 10.0, 900.0, None]
    assert apply(spark, ["1999-05", "", None, "87"], "string", year_prefix) == ["1999", None, None, "87"]


def test_bucket_edges_differ_by_side(spark):
    values = [89.9, 90.0, 180.0, 420.0, 500.0, None]
    left = apply(spark, values, "double", lambda v: bin_label(v, DURATION_EDGES, DURATION_LABELS, "left"))
    right = apply(spark, values, "double", lambda v: bin_label(v, DURATION_EDGES, DURATION_BIN_LABELS, "right"))
    assert left == ["0_<1.5min", "1_1.5-3min", "2_3-4min", "5_7+min", "5_7+min", None]
    assert right == ["<1.5min", "<1.5min", "1.5-3min", "5-7min", "7+min", None]


def test_compact_numbers_round_like_binary_doubles(spark):
    values = [0.0, 2.5, 999.0, 1000.0, 118850.0, 1250.0, 1350.0, 1_234_567.0, -2500.0]
    want = []
    for v in values:
        a = abs(v)
        want.append(f"{v / 1e6:.1f}M" if a >= 1e6 else f"{v / 1e3:.1f}K" if a >= 1e3 else f"{v:,.0f}")
    assert apply(spark, values, "double", compact_number) == want
    assert apply(spark, [225.0, 59.9, None], "double", minutes_seconds) == ["3:45", "0:59", None]


def test_text_keys(spark):
    assert apply(spark, ["  The B-52's! ", "a  b\t\nc", "\x1d x", "?!"], "string", match_key) == ["the b52s", "a b c", "x", ""]
    assert apply(spark, ["the x", "x", "theme", "the the x"], "string", flip_the) == ["x", "the x", "the theme", "the x"]
    assert apply(spark, ["Gradient Boosting (tuned)", "PCA + Ridge", "A-b"], "string", model_slug) == ["gradient_boosting_tuned", "pca_+_ridge", "a_b"]


def test_clean_text(spark):
    raw = "12 Contributors  rest\n[Verse 1]\nLine [a\nb]\nYou might also like this\nEnd Embed \n"
    # A line separator is not a line feed: the artifact runs to the real end of line.
    assert apply(spark, [raw, "[x]"], "string", clean_text) == ["Line [a\nb]\n \nEnd", ""]


def test_words(spark):
    text = "Oh yeah, the LOVE loves 123 x don't x2 café ٣٤ ² it's"
    assert apply(spark, [text, ""], "string", word_list) == [["love", "loves", "dont", "café"], []]
    assert apply(spark, [["a", "b", "c"], ["a"], []], "array<string>", adjacent_pairs) == [["a b", "b c"], [], []]


def test_lines(spark):
    assert apply(spark, ["a\r\nb\n \n\x0bc d"], "string", non_blank_lines) == [["a", "b", "c", "d"]]


def test_cells_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("x",)], "v string").select(clean_text(match_key(F.col("v"))))
    assert "Python" not in df._jdf.queryExecution().toString()
    assert rows(df) == [("x",)]
