"""The two staging tables, derived from the generated test tables.

The derivation plants what the load has to cope with: repeated song ids and titles, plays
of unknown songs, missing artists, missing timestamps, anonymous users, repeated events.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemart.operators.joins import hinted, join_hint

ARTISTS = 97

# The columns used, declared so that no file has to be opened to plan a query.
SCHEMAS = {
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
        "value DOUBLE, props STRING"
    ),
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _padded(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 16, "0"))


def staging_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One song record per part."""
    key = F.col("p_partkey")
    title_no = F.when(key % 20 == 19, key - 1).otherwise(key)
    id_no = F.when(key % 10 == 7, key - 1).otherwise(key)
    artist_no = title_no % ARTISTS
    first_word = F.when((key % 10).isin(6, 7), F.col("p_name")).otherwise(F.lit("Song"))
    located = key % 3 != 0
    half = F.lit(Decimal("0.5"))
    quarter = F.lit(Decimal("0.25"))
    return _table(spark, sf_dir, "part").select(
        _padded("SO", id_no).alias("song_id"),
        F.concat(first_word, F.lit(" "), title_no.cast("string")).alias("title"),
        _padded("AR", artist_no).alias("artist_id"),
        F.concat(F.lit("Artist "), artist_no.cast("string")).alias("artist_name"),
        F.when(key % 4 != 0, F.col("p_type")).alias("artist_location"),
        F.when(located, (F.col("p_size") + quarter).cast("decimal(9,6)")).alias("artist_latitude"),
        F.when(located, (-F.col("p_size") - half).cast("decimal(9,6)")).alias("artist_longitude"),
        F.floor("p_retailprice").cast("decimal(18,0)").alias("duration"),
        F.when(key % 5 == 0, F.lit(0)).otherwise(F.col("p_size") + 1960).alias("year"),
        F.lit(1).alias("num_songs"),
    )


def staging_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One activity record per event, every fiftieth event twice."""
    events = _table(spark, sf_dir, "events")
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    # A tenth more song numbers than parts, so that some plays match no song.
    song_numbers = (
        _table(spark, sf_dir, "part").select(F.expr("count(*) * 11 div 10").alias("n")).scalar()
    )

    key = F.col("event_id")
    kind = F.col("event_type")
    is_play = kind.isin("view", "purchase")
    song_no = key % song_numbers
    page = (
        F.when(is_play, F.lit("NextSong"))
        .when(kind == "click", F.lit("Home"))
        .otherwise(F.lit("Login"))
    )
    named_artist = F.concat(F.lit("Artist "), (song_no % ARTISTS).cast("string"))
    once = (
        events.join(hinted(customer, join_hint(customer)), F.col("c_custkey") == F.col("user_id"))
        .join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .select(
            "event_id",
            F.when(is_play & (key % 41 != 0), named_artist).alias("artist"),
            F.when(kind == "error", F.lit("Logged Out")).otherwise(F.lit("Logged In")).alias("auth"),
            F.col("c_mktsegment").alias("firstName"),
            F.col("c_name").alias("lastName"),
            F.when(F.col("user_id") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
            (key % 20).cast("int").alias("itemInSession"),
            F.floor("value").cast("decimal(18,0)").alias("length"),
            F.when(key % 3 == 0, F.lit("paid")).otherwise(F.lit("free")).alias("level"),
            F.col("n_name").alias("location"),
            page.alias("page"),
            F.expr("event_id div 20").cast("int").alias("sessionId"),
            F.when(is_play, F.concat(F.lit("Song "), song_no.cast("string"))).alias("song"),
            F.when(is_play | (key % 97 != 0), F.col("ts")).alias("ts"),
            F.col("props").alias("userAgent"),
            F.when(kind != "error", F.col("user_id").cast("int")).alias("userId"),
        )
    )
    copies = F.when(key % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return once.select("*", F.explode(copies).alias("copy")).drop("event_id", "copy")
