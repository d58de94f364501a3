from pyspark.sql import functions as F

from weekloom.operators.aggregates import distinct_labels, label_occurrences, most_frequent
from weekloom.operators.reshape import (
    coalesce_model_columns,
    label_names,
    melt,
    one_hot_long,
    one_hot_multilabel,
    one_hot_single,
    union_by_name,
    upsert_by_key,
    wide_to_series_list,
)
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import ALL_FORECASTS_SQL, SCORED_SQL, TRACKS_SQL, forecasts, scored, table, tracks


@query(
    "union_by_name",
    "key:i price:f2 discount:f2",
    """SELECT l_orderkey AS key, NULL AS price, l_discount AS discount FROM lineitem
        UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders""",
)
def _union_by_name(spark, d):
    return union_by_name(
        table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_discount").alias("discount")),
        table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price")),
    )


_GENRES = ("anvil", "blue", "bolt", "red")


@query(
    "one_hot_multilabel",
    "p_partkey:i labels:i " + " ".join(f"deezer_genre_{g}:i" for g in _GENRES),
    "SELECT p_partkey, (SELECT count(DISTINCT x) FROM (SELECT unnest(string_split(p_name, ' ')) AS x FROM part)) AS labels, "
    + ", ".join(f"CAST(list_contains(string_split(p_name, ' '), '{g}') AS INT) AS deezer_genre_{g}" for g in _GENRES)
    + " FROM part",
)
def _one_hot_multilabel(spark, d):
    labelled = table(spark, d, "part").withColumn("genres", F.split("p_name", " "))
    names = label_names(distinct_labels(labelled, "genres"))
    return one_hot_multilabel(labelled, "genres", names).withColumn("labels", F.lit(len(names)))


@query(
    "one_hot_topn",
    "p_partkey:i tag:s",
    """WITH words AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part),
        top AS (SELECT tag FROM words GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 5)
        SELECT p_partkey, tag FROM words WHERE tag IN (SELECT tag FROM top)""",
)
def _one_hot_topn(spark, d):
    labelled = table(spark, d, "part").withColumn("tags", F.split("p_name", " "))
    counts = label_occurrences(labelled, "tags")
    names = [r["label"] for r in most_frequent(counts, 5, "label").collect()]
    wide = one_hot_multilabel(labelled, "tags", names, "lfm_tag_", tag=True)
    flags = [c for c in wide.columns if c.startswith("lfm_tag_")]
    held = wide.unpivot(["p_partkey"], flags, "tag", "held").filter("held = 1")
    return held.withColumn("tag", F.replace("tag", F.lit("lfm_tag_"), F.lit("")))


@query(
    "one_hot_long",
    "l_orderkey:i l_linenumber:i label:s",
    f"WITH {TRACKS_SQL} SELECT l_orderkey, l_linenumber, unnest(genres) AS label FROM tracks",
)
def _one_hot_long(spark, d):
    return one_hot_long(tracks(spark, d), ["l_orderkey", "l_linenumber"], "genres")


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")


@query(
    "one_hot_single",
    "p_partkey:i kinds:i " + " ".join(f"dART_{t}:i" for t in _TYPES),
    "SELECT p_partkey, (SELECT count(DISTINCT p_type) FROM part WHERE p_type <> 'PROMO') AS kinds, "
    + ", ".join(f"CAST(p_type = '{t}' AS INT) AS dART_{t}" for t in _TYPES)
    + " FROM part",
)
def _one_hot_single(spark, d):
    kind = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    part = table(spark, d, "part").select("p_partkey", kind.alias("label"))
    values = label_names(part.select("label").dropna().distinct())
    return one_hot_single(part, "label", values).withColumn("kinds", F.lit(len(values)))


@query(
    "melt",
    "genre:s model:s metric_type:s metric_value:f4",
    f"WITH {SCORED_SQL} "
    + " UNION ALL ".join(
        f"SELECT genre, model, '{m}' AS metric_type, {m} AS metric_value FROM scored" for m in ("rmse", "mae")
    ),
)
def _melt(spark, d):
    return melt(scored(spark, d), ["genre", "model"], ["rmse", "mae"])


@query(
    "coalesce_model_columns",
    "l_orderkey:i l_linenumber:i predicted_streams_RF_tscv_tuned:f2 predicted_streams_LGBM_tuned_ts_cv:f2",
    """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag = 'A' THEN l_extendedprice END AS "predicted_streams_RF_tscv_tuned",
        CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS "predicted_streams_LGBM_tuned_ts_cv" FROM lineitem""",
)
def _coalesce_model_columns(spark, d):
    model = F.when(F.col("l_returnflag") == "A", "RandomForest").when(F.col("l_returnflag") == "R", "LightGBM")
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", model.alias("model"), F.col("l_extendedprice").alias("predicted_streams_total")
    )
    return coalesce_model_columns(rows)


@query(
    "wide_to_series_list",
    "genre:s model:s points:i actual:s predicted:s",
    f"""WITH {ALL_FORECASTS_SQL} SELECT genre, model, count(*) AS points,
        string_agg(CAST(CAST(round(actual) AS BIGINT) AS VARCHAR), ',' ORDER BY date) AS actual,
        string_agg(CAST(CAST(round(predicted) AS BIGINT) AS VARCHAR), ',' ORDER BY date) AS predicted
        FROM forecasts GROUP BY genre, model""",
)
def _wide_to_series_list(spark, d):
    lists = wide_to_series_list(forecasts(spark, d), ["genre", "model"])

    def text(c):
        return F.array_join(F.transform(c, lambda x: F.round(x, 0).cast("bigint").cast("string")), ",")

    return lists.select(
        "genre", "model", F.size("actual").alias("points"), text("actual").alias("actual"), text("predicted").alias("predicted")
    )


@query(
    "upsert_by_key",
    "o_orderkey:i price:f2 batch:i",
    """SELECT o_orderkey, o_totalprice * CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS price,
        CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS batch FROM orders
        WHERE o_orderkey % 3 = 0 OR o_orderstatus <> 'P'""",
)
def _upsert_by_key(spark, d):
    orders = table(spark, d, "orders")
    existing = orders.filter("o_orderstatus <> 'P'").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.lit(0).alias("batch")
    )
    incoming = orders.filter("o_orderkey % 3 = 0").select(
        "o_orderkey", (F.col("o_totalprice") * 2).alias("price"), F.lit(1).alias("batch")
    )
    once = upsert_by_key(existing, incoming, ["o_orderkey"], ["price"])
    return upsert_by_key(once, incoming, ["o_orderkey"], ["price"])
