import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL
from weekloom.functions import labels, numbers, text

TIDY_CASES = [
    ("Song (feat. Someone)", "Song"),
    ("Song FEAT. Someone else", "Song"),
    ("Song [Live] here", "Song here"),
    ("a (b) c (d)", "a"),
    ("(Intro) name", "(Intro) name"),
    ('"Quoted"', "Quoted"),
    ('say ""hey"" now', 'say "hey" now'),
    ("“Curly’", "Curly"),
    ("  many\t blanks here ", "many blanks here"),
    ("line (one)\nline (two)", "line (one) line"),
    ("line feat. x\nnext", "line feat. x next"),
    ("defeat. no", "defeat. no"),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("raw,want", TIDY_CASES)
def test_tidy(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(text.tidy(F.col("s"))).first()[0] == want


def test_primary_artist_and_key(spark):
    df = spark.createDataFrame([("  First ,Second, Third ",), (" Solo　",), (", x",)], "s string")
    assert [r[0] for r in df.select(text.primary_artist(F.col("s"))).collect()] == ["First", "Solo", ""]
    keys = spark.createDataFrame([("  ÀB c ",), (None,)], "s string").select(text.clean_key(F.col("s"))).collect()
    assert [r[0] for r in keys] == ["àb c", None]


def test_split_labels(spark):
    df = spark.createDataFrame([(" Pop, ,Hip Hop ,",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(labels.split_labels(F.col("s"))).collect()] == [["pop", "hip hop"], [], []]
    tags = spark.createDataFrame([("a|b.c| |D",)], "s string").select(labels.split_labels(F.col("s"), "|")).first()[0]
    assert tags == ["a", "b.c", "d"]


def test_label_names(spark):
    df = spark.createDataFrame([("R&B/soul-x (y)",)], "s string")
    genre, tag = df.select(labels.safe_label(F.col("s")), labels.safe_label(F.col("s"), tag=True)).first()
    assert (genre, tag) == ("RandB_soul-x_(y)", "RandB_soul_x_y")
    assert labels.safe_label_name("R&B/soul-x (y)") == genre
    assert labels.safe_label_name("R&B/soul-x (y)", tag=True) == tag


def test_numbers(spark):
    rows = [("1,234,567",), (" ",), ("",), ("x",), (None,)]
    parsed = spark.createDataFrame(rows, "s string").select(numbers.parse_grouped_int(F.col("s"))).collect()
    assert [r[0] for r in parsed] == [1234567, 0, 0, 0, 0]
    text_numbers = spark.createDataFrame([("1.5",), ("NaN",), ("—",), (None,)], "s string")
    assert [r[0] for r in text_numbers.select(numbers.to_number(F.col("s"))).collect()] == [1.5, None, None, None]
    probs = spark.createDataFrame([(0.5,), (0.51,), (None,)], "p double")
    assert [r[0] for r in probs.select(numbers.binarize(F.col("p"))).collect()] == [0, 1, None]


def test_names_without_patterns_are_cleaned_alike(spark):
    rng = random.Random(4)
    parts = ["a", "B c", " ", "  ", '"', '""', "'", "“", "(x)", "[y]", "feat.", "FEAT. z", "\n", "\t", "\x1c", "\u2003", ".", ",", "é"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(7))),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "s string").withColumn("tidy", text.tidy(F.col("s"))).withColumn("full", text._cleaned_up(F.col("s")))
    assert df.where("tidy is distinct from full").collect() == []


def test_names_are_cleaned_once(spark):
    plan = entry.queries()["drop_empty_keys"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("feat") - plan.count("(feat. ") <= 2  # one for titles, one for artists
