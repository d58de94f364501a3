"""Whole jobs on small hand-made inputs, and the shape of their plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL
from weekloom.operators.aggregates import best_per_group_composite, best_per_group_row, genre_weekly_sum_of_facts, joined_copies
from weekloom.operators.joins import join_by_clean_key_left, join_by_id_left, pending_anti
from weekloom.operators.reshape import one_hot_multilabel, upsert_by_key
from weekloom.operators.rows import cutoff_from_model, keep_first
from weekloom.plans.clean_chart import clean_chart, track_list
from weekloom.plans.compare_models import combine_predictions, long_predictions
from weekloom.plans.genre_forecast import all_forecasts, naive_report
from weekloom.plans.master_features import master_features
from weekloom.plans.model_dataset import model_dataset
from weekloom.queries.stand_ins import genre_weekly


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (1, "Song (feat. X)", "Ann, Bob", "2", "1", "3", 100, "2020-01-06"),
        (3, "song", "Ann", "2", "x", "3", 300, "2020-01-12"),
        (5, "Song", "Ann", "2", "1", "3", 300, "2020-01-12"),
        (2, "Song", "Ann", "2", "1", "3", 50, "2020-01-13"),
        (2, None, "Ann", "2", "1", "3", 50, "2020-01-13"),
        (2, "Song", " ", "2", "1", "3", 50, "2020-01-13"),
        (2, "Song", "Ann", "2", "1", "3", 50, "soon"),
    ]
    names = ["Position", "Song Title", "Artists", "Last Week", "Peak Position", "Weeks on Chart", "Streams", "Date"]
    types = ["int", "string", "string", "string", "string", "string", "bigint", "string"]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in zip(names, types)))


def test_clean_chart(raw):
    got = {(r.year_week, r.song): r for r in clean_chart(raw).collect()}
    assert set(got) == {("2020-01-06/2020-01-12", "Song"), ("2020-01-06/2020-01-12", "song"), ("2020-01-13/2020-01-19", "Song")}
    first = got[("2020-01-06/2020-01-12", "Song")]
    assert (first.artist, first.spotify_position, first.spotify_streams, first.spotify_peak_position) == ("Ann", 3.0, 200.0, 1.0)
    assert got[("2020-01-06/2020-01-12", "song")].spotify_peak_position is None
    assert track_list(clean_chart(raw)).count() == 2


@pytest.fixture(scope="module")
def tables(spark):
    base = spark.createDataFrame(
        [("Ann", "Song", "m1"), ("Ann", "Song", "m1"), (" ann", "SONG", None), ("Bob", "Tune", None), ("Cy", "Hit", "m9")],
        "artist string, song string, mbid string",
    )
    acoustic = spark.createDataFrame([("m1", 0.9, None), (None, 0.1, "failed")], "mb_recording_id string, ab_x_prob double, error string")
    albums = spark.createDataFrame(
        [("ANN ", "song", "Pop", 5, "2020-01-01", "single", 2), ("ANN ", "song", "Rock & Roll,Pop", 0, "2020-01-01", "album", 1),
         ("Bob", "tune", "", 7, None, None, 3)],
        "artist string, song string, genres string, album_track_count int, release_date string, album_record_type string,"
        " ingest_seq int",
    )
    tags = spark.createDataFrame(
        [("ann", "song", 5, "Indie|lo-fi"), ("ann", "song", 9, "lo-fi"), ("bob", "tune", 0, None)],
        "artist string, song string, listeners int, tags string",
    )
    return base, acoustic, albums, tags


def test_master_features(tables):
    got = master_features(*tables, top_tags=1)
    rows = {(r.artist, r.song): r for r in got.collect()}
    assert len(rows) == got.count() == 4
    ann = rows[("Ann", "Song")]
    assert (ann.acoustic_ab_x_prob, ann.deezer_genres, ann.deezer_genre_pop, ann.deezer_genre_rock_and_roll) == (0.9, "Rock & Roll,Pop", 1, 1)
    assert (rows[(" ann", "SONG")].acoustic_ab_x_prob, rows[(" ann", "SONG")].deezer_genre_pop) == (None, 1)
    assert "ingest_seq" not in got.columns
    # lo-fi occurs most once every copy on either side is counted.
    assert [c for c in got.columns if c.startswith("lfm_tag_")] == ["lfm_tag_lo_fi"]
    assert (ann.lastfm_listeners, rows[("Bob", "Tune")].lastfm_listeners, rows[("Cy", "Hit")].lastfm_listeners) == (5, None, None)


def test_master_features_takes_what_is_there(tables):
    assert master_features(tables[0]).count() == 4


def test_master_features_without_genres(tables):
    base, acoustic, albums, *rest = tables
    got = master_features(base, acoustic, albums.drop("genres"), *rest, top_tags=1)
    assert got.count() == 4 and not [c for c in got.columns if c.startswith("deezer_genre_")]


def test_tag_ranks_count_the_copies_of_every_side(spark):
    base = spark.createDataFrame([("A", "one", "m1"), ("A", "one", "m1"), ("B", "two", "m2"), ("C", "x", None)], "artist string, song string, mbid string")
    tags = spark.createDataFrame([("A", "one", "alpha"), ("B", "two", "zeta"), ("C", "x", "null id")], "artist string, song string, tags string")
    albums = spark.createDataFrame([("b", "TWO", "g", k) for k in range(3)] + [(None, "two", "g", 9)], "artist string, song string, genres string, ingest_seq int")
    acoustic = spark.createDataFrame([("m1", 1.0)] * 2 + [(None, 0.5)] * 9, "mb_recording_id string, ab_x_prob double")

    def first_tag(*sides):
        return [c for c in master_features(base, *sides, tags, top_tags=1).columns if c.startswith("lfm_tag_")]

    assert first_tag(None, None) == ["lfm_tag_alpha"]
    assert first_tag(None, albums) == ["lfm_tag_zeta"]
    assert first_tag(acoustic, albums) == ["lfm_tag_alpha"]  # 4 against 3


def test_track_models_to_genres(spark):
    from weekloom.plans.track_forecast import longest_tracks, track_model_metrics, track_models_to_genres

    forecasts = spark.createDataFrame(
        [("a", "s", "2020-01-05", 10.0, 8.0), ("a", "t", "2020-01-05", 5.0, None), ("a", "u", "2020-01-05", 1.0, 1.0)],
        "artist string, song string, date string, actual double, predicted double",
    )
    labels = spark.createDataFrame([("a", "s", ["pop", "rock", "pop"]), ("a", "t", ["pop"]), ("a", "u", None)], "artist string, song string, genres array<string>")
    got = {(r.genre, r.actual, r.predicted) for r in track_models_to_genres(forecasts, labels).collect()}
    assert got == {("pop", 15.0, 8.0), ("rock", 10.0, 8.0)}
    weeks = spark.range(40).select(F.explode(F.array(*[F.lit(x) for x in "stu"])).alias("song"), F.lit("a").alias("artist"), F.date_add(F.lit("2020-01-05").cast("date"), (F.col("id") * 7).cast("int")).alias("date"), (F.lit(100.0) + F.col("id") % 2).alias("spotify_streams"))
    rows = weeks.filter("song <> 'u' OR date < '2020-05-01'")
    assert {r.song for r in longest_tracks(rows, 2).select("song").distinct().collect()} == {"s", "t"}
    small = {"ranges": {"trees": (5, 8), "depth": (2, 4), "split": (2, 3), "leaf": (1, 3)}, "draws": 2}
    scores = track_model_metrics(rows, labels, ["rf"], 2, **small).collect()
    assert {(r.genre, r.model) for r in scores} == {("pop", "RandomForest"), ("rock", "RandomForest")}
    assert all(r.mae < 1 and r.mape < 1 for r in scores)


def test_model_dataset(spark, raw, tables):
    weekly = clean_chart(raw)
    features = master_features(*tables, top_tags=1)
    got = {(str(r.date), r.song): r for r in model_dataset(weekly, features).collect()}
    assert len(got) == 3
    second = got[("2020-01-19", "Song")]
    assert (second.spotify_streams_lag_1, second.spotify_streams_roll_mean_4, second.spotify_streams_roll_std_4) == (200.0, 125.0, pytest.approx(106.066, abs=1e-3))
    assert (second.song_age_days, second.is_new_release_last_28d, second.release_dayofweek, second.weekofyear) == (18, 1, 2, 3)
    assert second.acoustic_ab_x_prob == 1 and second.dART_album == 1 and second.deezer_album_track_count is None
    unmatched = got[("2020-01-12", "song")]
    assert (unmatched.song_age_days, unmatched.release_year, unmatched.is_new_release_last_28d, unmatched.dART_album) == (-1, 0, 0, 0)


def test_null_ids_match_nothing(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "id string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "rid string, y int")
    assert {(r.x, r.y) for r in join_by_id_left(left, right, "id", "rid").collect()} == {(1, None), (2, 20)}


def test_copies_fan_out_in_the_plain_join(spark):
    left = spark.createDataFrame([("A", "s")], "artist string, song string")
    right = spark.createDataFrame([("a ", "S", 1), ("a", "s", 2), (None, "s", 3)], "artist string, song string, v int")
    assert sorted(r.v for r in join_by_clean_key_left(left, right).collect()) == [1, 2]


def test_label_sum_with_large_dimension_equals_small(spark):
    fact = spark.range(3000).select((F.col("id") % 7).alias("k"), F.date_add(F.lit("2020-01-05").cast("date"), (F.col("id") % 3 * 7).cast("int")).alias("date"), F.lit(1.0).alias("v"))
    fact = fact.union(fact.filter("k = 0").withColumn("v", F.lit(2.0)))
    dim = spark.createDataFrame([(i, ["a", "b" if i % 2 else "c"]) for i in range(7)], "k bigint, genres array<string>")
    small = genre_weekly_sum_of_facts(fact, dim, "k", "genres", "date", "v")
    want = {(r.genre, r.date): r.total for r in small.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = genre_weekly_sum_of_facts(fact, dim, "k", "genres", "date", "v")
        plan = executed(large)
        assert {(r.genre, r.date): r.total for r in large.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("sum(v") >= 4  # partial and final, before and after the join


def test_first_rows_are_chosen_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    kept = keep_first(df, ["k"], [F.desc("v")])
    assert sorted((r.k, r.v) for r in kept.collect()) == [(0, 999), (1, 997), (2, 998)]
    assert "WindowGroupLimit" in executed(kept)


def test_report_reads_the_facts_once(spark):
    plan = executed(naive_report(genre_weekly(spark, SMALL)))
    final = plan.split("Initial Plan")[0]
    assert final.count("l_extendedprice") and final.count("FileScan parquet [l_partkey") == 1
    assert "Cartesian" not in final and "NestedLoop" not in final


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("s", "a", 1), ("t", "b", 2)], "song string, artist string, v int")
    new = spark.createDataFrame([("s", "a", 9), ("u", "c", 3)], "song string, artist string, v int")
    once = upsert_by_key(old, new, ["song", "artist"], ["v"])
    twice = upsert_by_key(once, new, ["song", "artist"], ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("s", "a", 9), ("t", "b", 2), ("u", "c", 3)]
    assert [tuple(r) for r in pending_anti(new, old).select("song").collect()] == [("u",)]


def test_best_models(spark):
    rows = [("pop", "RF", 5.0, None), ("pop", "MA", 7.0, 4), ("pop", "NA", None, 9), ("rock", "MA", 2.0, None)]
    df = spark.createDataFrame(rows, "genre string, model string, rmse double, ma_window int")
    whole = {r.genre: (r.model, r.rmse, r.ma_window) for r in best_per_group_row(df, "genre", "rmse", ["model"]).collect()}
    mixed = {r.genre: (r.model, r.rmse, r.ma_window) for r in best_per_group_composite(df, "genre", "rmse", ["model", "rmse", "ma_window"]).collect()}
    assert whole == {"pop": ("RF", 5.0, None), "rock": ("MA", 2.0, None)}
    assert mixed == {"pop": ("RF", 5.0, 4), "rock": ("MA", 2.0, None)}


def test_cutoff_without_the_model_keeps_all(spark):
    df = spark.createDataFrame([("A", "2020-01-05"), ("B", "2020-01-12"), ("B", None)], "model string, date string").withColumn("date", F.to_date("date"))
    assert cutoff_from_model(df, "C").count() == 3
    assert cutoff_from_model(df, "B").count() == 1


def test_one_hot_sums_equal_label_counts(spark):
    df = spark.createDataFrame([(1, ["a", "b c"]), (2, ["a"]), (3, None)], "id int, genres array<string>")
    wide = one_hot_multilabel(df, "genres", ["a", "b c"], "g_").agg(F.sum("g_a"), F.sum("g_b_c")).first()
    assert tuple(wide) == (2, 1)


def test_prediction_files_to_long_table(spark, tmp_path):
    (tmp_path / "genre_sarima_predictions.csv").write_text("date,genre,actual_streams,predicted_streams_sarima\n2020-01-12,pop,10,11\n")
    (tmp_path / "genre_RF_predictions.csv").write_text(
        "date,genre,actual_streams_total,predicted_streams_total,zero\n2020-01-05,pop,1,2,0\n2020-01-12,pop,3,4,0\n"
    )
    wide = combine_predictions(spark, str(tmp_path))
    assert "predicted_streams_RF_tscv_tuned" in wide.columns
    got = sorted((r.model, str(r.date), r.actual, r.predicted) for r in long_predictions(wide).collect())
    assert got == [("RandomForest", "2020-01-12", 3.0, 4.0), ("SARIMA", "2020-01-12", 10.0, 11.0)]


def test_all_families_forecast_the_same_weeks(spark):
    got = all_forecasts(genre_weekly(spark, SMALL), 2).toPandas()
    counts = got.groupby("model").size()
    assert set(counts.index) == {"Naive", "MovingAverage", "Autoregression", "SARIMA", "Prophet"}
    assert (counts == 16).all() and got.predicted.notna().all()
    assert got.groupby(["genre", "date"]).actual.nunique().max() == 1


def test_registered_names():
    assert len(entry.queries()) >= 130


def test_rows_without_a_key_are_spread(spark):
    rows = [(None, f"t{i % 4}") for i in range(4000)] + [(1, "t0"), (2, "t1")]
    left = spark.createDataFrame(rows, "id int, track string").repartition(8)
    side = spark.createDataFrame([(1,), (1,), (None,), (3,)], "id bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = joined_copies(left, [(side, ["id"])]).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.id, r.track, r.n_copies) for r in made if r.id) == [(1, "t0", 2), (2, "t1", 1)]
    assert sum(r.id is None and r.n_copies == 1 for r in made) == 4000
    plan = joined_copies(left, [(side, ["id"])])._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan


def test_model_dataset_reads_the_chart_once(spark):
    plan = model_dataset_of(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and "l_orderkey" not in plan  # below what is stored


def model_dataset_of(spark):
    return entry.queries()["model_dataset"](spark, SMALL)
