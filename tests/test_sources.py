import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from weekloom.functions import payloads
from weekloom.operators.rows import keep_first
from weekloom.sources.readers import (
    MissingColumns,
    chart_page_rows,
    load_model_dataset,
    read_csv_chart,
    read_optional,
    row_order,
    scan_result_files,
    with_ingest_order,
)
from weekloom.sources.records import lines, quote_parity
from weekloom.sources.writers import write_per_group, write_table


def test_chart_csv(spark, tmp_path):
    good = tmp_path / "chart.csv"
    good.write_text('Position,Song Title,Artists,Streams,Date\n1,"Say ""hey""","A, B",12,2020-01-02\n2,,C,x,bad\n')
    rows = read_csv_chart(spark, str(good)).orderBy("Position").collect()
    assert [tuple(r) for r in rows] == [(1, 'Say "hey"', "A, B", 12, "2020-01-02"), (2, None, "C", None, "bad")]
    bad = tmp_path / "bad.csv"
    bad.write_text("Position,Artists,Date\n1,A,2020-01-02\n")
    with pytest.raises(MissingColumns, match="Song Title"):
        read_csv_chart(spark, str(bad))
    with pytest.raises(AnalysisException):
        read_csv_chart(spark, str(tmp_path / "absent.csv"))
    assert read_optional(spark, str(tmp_path / "absent")) is None


ROW = (
    '<tr data-encore-id="tableRow"><td data-encore-id="tableCell">x</td><td data-encore-id="tableCell">1</td><td data-encore-id="tableCell"><span class="styled__StyledTruncatedTitle-s">{title}</span>'
    '<div class="styled__StyledArtistsTruncatedDiv-s"><a href="#">A &amp; B</a>, <a href="#">C</a></div></td>'
    + "".join(f'<td data-encore-id="tableCell">{x}</td>' for x in ("2", "1", "{weeks}", "{streams}"))
    + "</tr>"
)


def test_chart_pages(spark):
    html = "<table>" + ROW.format(title="One", weeks=3, streams="1,234,567") + "<tr><td>short</td></tr>"
    html += ROW.format(title="Two <b>x</b>", weeks=1, streams=" ") + "</table>"
    got = chart_page_rows(spark.createDataFrame([("2020-01-02", html)], "Date string, html string"), "html", ["Date"])
    rows = [tuple(r) for r in got.orderBy("Position").collect()]
    assert rows[0] == ("2020-01-02", 1, "One", "A & B, C", "2", "1", "3", 1234567)
    assert rows[1][1:4] == (2, "Two x", "A & B, C") and rows[1][-1] == 0


def test_line_breaks_and_column_order(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", "x", "2020-01-02"), ("c", "y", "2020-01-09")], "`Song Title` string, Artists string, Date string")
    write_table(df, str(tmp_path / "chart"), "csv")
    back = read_csv_chart(spark, str(tmp_path / "chart")).orderBy("Date").collect()
    assert [r["Song Title"] for r in back] == ["a\nb", "c"]
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    (mixed / "a.csv").write_text("Song Title,Artists,Date\nt,a,2020-01-02\n")
    (mixed / "b.csv").write_text("Artists,Song Title,Date\na,t,2020-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_chart(spark, str(mixed)).collect()
    (mixed / "c.csv").write_text('Song Title,Artists,Date\n"t\nu",a,2020-01-02\n')
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_chart(spark, str(mixed)).collect()


def test_one_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    import csv
    import random

    rng = random.Random(4)
    words = ["plain", 'a "quoted" word', "two\nlines", "three\n\n\"lines\"\n", "comma, inside", "é", "", 'x""y', "cr\r\nlf"]
    rows = [(k, rng.choice(words) + str(k), rng.choice(words), k * 7, "2020-01-02") for k in range(3000)]
    path = tmp_path / "chart.csv"
    with path.open("w", newline="") as out:
        writer = csv.writer(out, lineterminator="\r\n")
        writer.writerow(["Position", "Song Title", "Artists", "Streams", "Date"])
        writer.writerows(rows)
    with path.open("a", newline="") as out:
        out.write('9000,"no end of line","' + "long\n" * 5000 + '",1,2020-01-02')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = read_csv_chart(spark, str(path))
        ranges = quote_parity(lines(spark, str(path))).collect()
        got = sorted(tuple(r) for r in read.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(ranges) > 20 and sum(r.begins_open for r in ranges) > 5
    want = [(k, t, a or None, s, d) for k, t, a, s, d in rows] + [(9000, "no end of line", "long\n" * 5000, 1, "2020-01-02")]
    assert got == sorted(want)


def test_files_without_line_breaks_keep_the_plain_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Song Title,Artists,Date\n"a ""b"" c",x,2020-01-02\n\n')
    read = read_csv_chart(spark, str(tmp_path / "a.csv"))
    assert [tuple(r) for r in read.collect()] == [('a "b" c', "x", "2020-01-02")]
    assert "FileScan csv" in read._jdf.queryExecution().executedPlan().toString()


def test_text_columns_of_result_files_stay(spark, tmp_path):
    (tmp_path / "genre_naive_metrics.csv").write_text("genre,mae,note\npop,1,hello\n")
    row = scan_result_files(spark, str(tmp_path), "metrics").first()
    assert (row.mae, row.note) == (1.0, "hello")


def test_names_for_the_wide_scored_map(spark):
    body = '{"highlevel": {"mood-happy": {"value": "happy", "probability": 0.75}, "bpm": 120, "odd": "12d"}}'
    df = spark.createDataFrame([(1, body), (2, None)], "id int, body string")
    assert payloads.scored_feature_names(df, "body") == (["mood_happy"], ["bpm"])


def test_result_files_with_different_headers(spark, tmp_path):
    (tmp_path / "genre_naive_metrics.csv").write_text("genre,mae,rmse,mape\npop,1,2,3\n,4,5,6\n")
    (tmp_path / "genre_sarima_metrics.csv").write_text('genre,sarima_order,mae,rmse,mape\npop,"(1,1,0)",7,8,9\n')
    (tmp_path / "combined_metrics.csv").write_text("genre,mae\npop,0\n")
    (tmp_path / "genre_naive_predictions.csv").write_text("date,genre\n2020-01-05,pop\n")
    got = scan_result_files(spark, str(tmp_path), "metrics").orderBy("mae").collect()
    assert [(r.genre, r.model, r.mae, r.sarima_order, r.source_file) for r in got] == [
        ("pop", "Naive", 1.0, None, "genre_naive_metrics.csv"),
        (None, "Naive", 4.0, None, "genre_naive_metrics.csv"),
        ("pop", "SARIMA", 7.0, "(1,1,0)", "genre_sarima_metrics.csv"),
    ]
    assert scan_result_files(spark, str(tmp_path / "nothing"), "metrics") is None


def test_jobs_do_not_grow_with_result_files(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / f"of {n}"
        folder.mkdir()
        for k in range(n):
            (folder / f"genre_naive_metrics_{k}.csv").write_text(f"genre,mae{',\"a, b\"' if k % 2 else ''}\npop,{k}{',1' if k % 2 else ''}\n")
        group = f"headers of {n}"
        spark.sparkContext.setJobGroup(group, group)
        found = scan_result_files(spark, str(folder), "metrics")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert found.count() == n and set(found.columns) == {"genre", "mae", "a, b", "source_file", "model"}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    # beyond 32 paths the listing itself is a job for each scan
    assert jobs(120) == jobs(80) <= jobs(4) + 3


def test_tables_round_trip(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).cast("string").alias("genre"), F.lit(' a "b" ').alias("t"))
    write_table(df, str(tmp_path / "csv"), "csv")
    back = spark.read.options(header=True, escape='"').csv(str(tmp_path / "csv"))
    assert back.count() == 100 and {r.t for r in back.select("t").distinct().collect()} == {' a "b" '}
    write_per_group(df, str(tmp_path / "groups"), "genre")
    assert {p.name for p in (tmp_path / "groups").iterdir() if p.is_dir()} == {"genre=0", "genre=1", "genre=2"}
    assert spark.read.parquet(str(tmp_path / "groups")).count() == 100


def test_model_dataset_order(spark):
    df = spark.createDataFrame([("b", "s", "2020-01-12"), ("a", "s", "2020-01-12"), ("a", "s", "2020-01-05")], "artist string, song string, date string")
    rows = load_model_dataset(df).collect()
    assert [(r.artist, str(r.date)) for r in rows] == [("a", "2020-01-05"), ("a", "2020-01-12"), ("b", "2020-01-12")]


def test_scored_map(spark):
    body = '{"highlevel": {"mood-happy": {"value": "happy", "probability": 0.75}, "bpm": 120, "odd": {"value": "x"}}}'
    df = spark.createDataFrame([(1, body), (2, None)], "id int, body string")
    wide = {r.id: r for r in payloads.flatten_scored_map(df, "body", ["id"], ["mood_happy", "odd"], ["bpm"]).collect()}
    assert (wide[1].ab_mood_happy_value, wide[1].ab_mood_happy_prob, wide[1].ab_bpm) == ("happy", 0.75, 120.0)
    assert (wide[1].ab_odd_value, wide[1].ab_odd_prob, wide[1].error) == (None, None, None)
    assert (wide[2].ab_bpm, wide[2].error) == (None, "failed")
    long = {r.name: (r.value, r.prob, r.number) for r in payloads.scored_features(df, "body", ["id"]).collect()}
    assert long == {"mood_happy": ("happy", 0.75, None), "bpm": (None, None, 120.0)}


def test_first_row_in_file_order(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("k,v\n" + "".join(f"{i % 5},{1000 - i}\n" for i in range(500)))
    read = with_ingest_order(spark.read.csv(str(path), header=True, schema="k int, v int"))
    kept = keep_first(read.repartition(6), ["k"], row_order(read))
    assert sorted((r.k, r.v) for r in kept.collect()) == [(i, 1000 - i) for i in range(5)]
