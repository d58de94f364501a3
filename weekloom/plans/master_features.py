"""Track list and enrichment tables to one wide row per track."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions.labels import split_labels
from weekloom.functions.numbers import to_number, zero_to_null
from weekloom.operators.aggregates import distinct_labels, joined_copies, joined_tag_frequency, most_frequent
from weekloom.operators.columns import prefix_columns, select_present
from weekloom.operators.joins import first_per_clean_key, join_by_clean_key_left, join_by_id_left, with_clean_keys
from weekloom.operators.reshape import label_names, one_hot_multilabel
from weekloom.operators.rows import keep_first
from weekloom.sources.readers import INGEST_ORDER, row_order

TOP_TAGS = 25
NAMES = ["artist", "song"]

# Tag-service columns taken, in both spellings, and their names here.
TAG_COLUMNS = {
    "lastfm_listeners": "lastfm_listeners", "listeners": "lastfm_listeners",
    "lastfm_playcount": "lastfm_playcount", "playcount": "lastfm_playcount",
    "lastfm_duration_ms": "lastfm_duration_ms", "duration_ms": "lastfm_duration_ms",
    "lastfm_album": "lastfm_album_name", "album": "lastfm_album_name",
    "lastfm_tags": "lastfm_tags_str", "tags": "lastfm_tags_str",
}
TAG_NUMBERS = ("lastfm_listeners", "lastfm_playcount", "lastfm_duration_ms")


def _counted_base(base: DataFrame, acoustic: DataFrame | None, albums: DataFrame | None) -> DataFrame:
    """The clean keys of ``base`` and ``_n``, the rows each of its rows becomes when
    the other sides are joined with all their copies."""
    has_id = acoustic is not None and "mbid" in base.columns
    names = [f"_k_{n}" for n in NAMES]
    keyed, sides = with_clean_keys(base, NAMES).select(*names, *(["mbid"] if has_id else [])), []
    if has_id:
        id_col = "mb_recording_id" if "mb_recording_id" in acoustic.columns else "mbid"
        keyed = keyed.withColumn("_id", F.col("mbid").cast("string"))
        sides.append((acoustic.select(F.col(id_col).cast("string").alias("_id")), ["_id"]))
    if albums is not None:
        sides.append((with_clean_keys(albums, NAMES).select(*names), names))
    return joined_copies(keyed, sides, "_n")


def master_features(
    base: DataFrame,
    acoustic: DataFrame | None = None,
    albums: DataFrame | None = None,
    tags: DataFrame | None = None,
    top_tags: int = TOP_TAGS,
) -> DataFrame:
    """One row per track with every enrichment that is given.

    The table keeps one row per track in the end, the first match of the first
    row.  So each side is reduced to its first row per key before it is joined:
    copies never multiply.  "First" is the ingest order where a table carries it
    (see ``with_ingest_order``).  Tag frequencies, which count the copies of every
    side, come from counts per key."""
    keys = [*NAMES, "mbid"] if "mbid" in base.columns else NAMES
    counted_base = _counted_base(base, acoustic, albums)
    df = keep_first(base, keys, row_order(base)).drop(INGEST_ORDER)
    if acoustic is not None and "mbid" in base.columns:
        id_col = "mb_recording_id" if "mb_recording_id" in acoustic.columns else "mbid"
        acoustic = acoustic.withColumnRenamed(id_col, "_acoustic_id")
        first = keep_first(acoustic.filter("_acoustic_id IS NOT NULL"), ["_acoustic_id"], row_order(acoustic)).drop(INGEST_ORDER)
        df = join_by_id_left(df, prefix_columns(first, "acoustic_", ["_acoustic_id", "error"]), "mbid", "_acoustic_id")
    if albums is not None:
        first = first_per_clean_key(albums, row_order(albums), NAMES).drop(INGEST_ORDER)
        df = join_by_clean_key_left(df, prefix_columns(first, "deezer_", NAMES), NAMES)
        if "deezer_genres" in df.columns:
            df = df.withColumn("_genres", split_labels(F.col("deezer_genres"), ","))
            wanted = label_names(distinct_labels(df, "_genres"))
            df = one_hot_multilabel(df, "_genres", wanted).drop("_genres")
    if tags is not None:
        slim = select_present(tags, TAG_COLUMNS, [*NAMES, *([INGEST_ORDER] if INGEST_ORDER in tags.columns else [])])
        first = first_per_clean_key(slim, row_order(slim), NAMES).drop(INGEST_ORDER)
        df = join_by_clean_key_left(df, first, NAMES)
        df = df.withColumns({c: zero_to_null(to_number(F.col(c))) for c in TAG_NUMBERS if c in df.columns})
        if "lastfm_tags_str" in df.columns:
            names = [f"_k_{n}" for n in NAMES]
            counted = with_clean_keys(slim.withColumn("_t", split_labels(F.col("lastfm_tags_str"), "|")), NAMES)
            frequency = joined_tag_frequency(counted_base, counted, names, "_t", "_n")
            wanted = [r["tag"] for r in most_frequent(frequency, top_tags).collect()]
            df = df.withColumn("_t", split_labels(F.col("lastfm_tags_str"), "|"))
            df = one_hot_multilabel(df, "_t", wanted, "lfm_tag_", tag=True).drop("_t", "lastfm_tags_str")
    return df
