import random

from pyspark.sql import functions as F

import weekloom.llm.near_dup as near_dup_module
from weekloom.llm.components import components
from weekloom.llm.near_dup import Shape, near_duplicates, one_of_each
from weekloom.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.brute import near_dup, shingles

SCHEMA = "doc_id bigint, text string, kept string, component_id string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def varied(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((k, " ".join(copy)))
            k += 1
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "ONE"), (905, "Été été"), (906, "été été"), (None, rows[0][1])]
    rows += [rows[3], rows[3], (5, "quite another text under the same id as one above"), (950, "long " * 40_000 + "end")]
    return rows


def test_all_links_and_components(spark):
    rows = varied()
    for n in (2, 5):
        assert got(near_duplicates(frame(spark, rows), shape=Shape(shingle=n))) == near_dup(rows, n)


def test_units_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dup_module, "FEW", 1)
    monkeypatch.setattr(near_dup_module, "UNIT", 3)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(90):
        copy = list(base)
        for _ in range(rng.choice((1, 2, 3, 4))):
            copy[rng.randrange(60)] = f"x{rng.randrange(40)}"
        rows.append((k, " ".join(copy)))
    want = near_dup(rows, 2)
    assert 1 < sum(r[3] for r in want) < 60
    assert got(near_duplicates(frame(spark, rows), shape=Shape(shingle=2))) == want


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = near_dup([tuple(r) for r in docs], 2)
    assert any(not r[3] for r in want)
    assert got(QUERIES["op2_near_duplicates"](spark, SMALL)) == want


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    assert one_of_each(frame(spark, [])).collect() == []


def test_one_of_each_keeps_columns_and_one_row(spark):
    rows = varied()
    left = one_of_each(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "kept", "component_id"]
    named = {d for d, n, c, kept in near_dup(rows, 5) if kept and n and d is not None}
    want = sorted(d for d, _ in {(d, shingles(t, 5)) for d, t in rows if d in named})  # different texts of one id are not linked here
    ids = [r.doc_id for r in left.collect() if r.doc_id is not None and (r.text or "").strip()]
    assert sorted(ids) == want and want.count(5) == 2
    assert sum(r.doc_id is None for r in left.collect()) == 1
    assert sum(not (r.text or "").strip() for r in left.collect()) == 3


def test_unlinked_texts_of_one_id_all_stay(spark):
    rows = [(1, "one text about rivers and hills and more"), (1, "another one on ships that sail the sea"), (1, "a third of quite other words altogether here")]
    rows += [(2, rows[0][1]), (1, rows[0][1])]
    assert sorted(r.text for r in one_of_each(frame(spark, rows)).collect()) == sorted(t for _, t in rows[:3])


def test_a_stranger_in_a_large_bucket_ships_each_text_once(spark):
    members = spark.range(5000).select(
        F.lit(1).alias("key"), F.col("id").cast("string").cast("binary").alias("node"), F.lit(5000).alias("m"), F.lit(20).alias("n"),
        F.when(F.col("id") == 7, F.lit(b"b")).otherwise(F.lit(b"a")).alias("label"),
    )
    units = near_dup_module._units(members)
    assert units.count() == 5000 + 5000 // near_dup_module.UNIT
    long = near_dup_module._units(members.withColumn("n", F.lit(near_dup_module.UNIT_SHINGLES // 100)))
    assert long.groupBy("key", "i", "j").count().agg(F.max("count")).first()[0] < 2 * 100


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)]
    found = {r.u: r.v for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 1 for i in range(2, 61)}, **{i: 100 for i in range(101, 140)}}
