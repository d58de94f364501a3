import hashlib

import pytest
from pyspark.sql import functions as F

from weekloom.llm.fill_in_middle import Cutter, Middle, fill_in_middle, restored
from weekloom.llm.queries import QUERIES
from tests.conftest import SMALL

ROWS = [(k, f"text {k} é🙂\n" * (k % 7 + 1)) for k in range(200)] + [
    (200, None), (201, ""), (202, "a<P>b"), (203, "<S>"), (204, "x <M"), (205, "<<P <S <M " * 4), (206, "M>M> >S>" * 9), (None, "no id at all"),
    (207, "\x00\r\n x"), (208, "long é" * 60_000), (5, "another text of one id"), (5, "another text of one id"),
]


def plain_version(id_, text):
    text = text or ""
    key = hashlib.sha256(f"1:{'' if id_ is None else id_}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(key[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (id_, n, "plain", None, None, text)
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return (id_, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (id_, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def table(spark, rows):
    clash = [(d, t, "clash", 1, "clash") for d, t in rows]
    return spark.createDataFrame(clash, "doc_id bigint, text string, output string, n int, form string").repartition(3)


def test_forms_and_round_trip(spark):
    made = fill_in_middle(table(spark, ROWS)).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in made), key=repr) == sorted((plain_version(*r) for r in ROWS), key=repr)
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    texts = sorted((str(d), t or "") for d, t in ROWS)
    assert sorted((str(r.doc_id), r.back) for r in made) == texts


def test_empty_table(spark):
    assert fill_in_middle(table(spark, [])).collect() == []


@pytest.mark.parametrize("unit", [r"(?s:.)", r"\S+\s*|\s+"])
def test_regions_cut_where_one_match_does(unit):
    text = "one two  three\n\néé four " * 40
    whole, regions = Cutter(unit), Cutter(unit, region=7)
    n = whole.cut(text, 0, 0)[0]
    assert n == (len(text) if unit.startswith("(?s") else 5 * 40)
    for first, second in ((0, 0), (n, 0), (3, n - 1), (7, 14), (n + 1, 2 * n + 1), (6, 8)):
        assert regions.cut(text, first, second) == whole.cut(text, first, second)


def test_words_as_units(spark):
    rule = Middle(unit=r"\S+\s*|\s+", transformed=100, suffix_first=50)
    rows = [(k, "alpha beta  gamma\ndelta") for k in range(40)]
    made = fill_in_middle(table(spark, rows), rule=rule).withColumn("back", restored(F.col("output"), F.col("form"), rule)).collect()
    assert {r.back for r in made} == {"alpha beta  gamma\ndelta"}
    assert {r.n for r in made} == {4} and {r.prefix_chars for r in made} <= {0, 6, 12, 18, 23}


def test_a_unit_that_does_not_cover_is_refused():
    with pytest.raises(ValueError):
        Cutter("[a-z]").cut("abc1", 0, 0)


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d, t in docs:
        row = plain_version(d, t)
        want[d] = (*row[1:5], *(hashlib.sha256(x.encode()).hexdigest() for x in (row[5], t or "")))
    got = QUERIES["op12_fill_in_middle"](spark, SMALL).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
