"""Where a schedule and its recordings come from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.plans.config import Config
from talkloom.schemas import schema
from talkloom.sources import listing, rest
from talkloom.sources.artifacts import append_results, checkpointed, exists, read_schedule, with_position


def fetch_schedule(spark: SparkSession, config: Config, cache: str | None = None, fetcher: Callable[[], Callable[[str], str]] = lambda: rest.get) -> DataFrame:
    """Raw sessions, from the first that is configured: the API (URL and key), the site (URL), a file, or none.

    ``cache`` is the path of a table of detail pages: those in it are not fetched again, new ones are added.
    """
    c = config.conference
    if c.schedule_url and c.sched_api_key:
        spark.dataSource.register(rest.ScheduleApi)
        return with_position(spark.read.format("schedule_api").option("url", c.schedule_url).option("api_key", c.sched_api_key).load())
    if c.schedule_url:
        return scrape(spark, c.schedule_url, cache, fetcher)
    if c.schedule:
        return read_schedule(spark, c.schedule)
    return with_position(spark.createDataFrame([], schema("raw_session")))


DETAIL = "event_id string, abstract string, speakers array<struct<name:string,company:string>>, track string, time string, tags array<string>"


def scrape(spark: SparkSession, url: str, cache: str | None = None, fetcher: Callable[[], Callable[[str], str]] = lambda: rest.get) -> DataFrame:
    """Sessions of a site: the listing, and the detail page of each session that the cache lacks. Pages that fail are not cached."""
    page = rest.fetch_pages(spark.createDataFrame([(url,)], "url string"), fetcher, workers=1, spacing=0)
    sessions = checkpointed(listing.listing_sessions(page))
    known = spark.read.schema(DETAIL).parquet(cache) if cache and exists(spark, cache) else spark.createDataFrame([], DETAIL)
    new = listing.fetch_plan(sessions, known)
    fetched = rest.fetch_pages(new, fetcher).where("error is null")
    details = listing.detail_sessions(fetched).withColumnRenamed("url", "detail_url")
    full = checkpointed(new.join(details, F.col("url") == F.col("detail_url")).select("event_id", "abstract", "speakers", "track", "time", "tags"))
    if cache:
        append_results(full, cache)
    got = sessions.join(full.unionByName(known), "event_id", "left")
    track = F.coalesce(F.nullif("track", F.lit("")), "venue")
    return got.select("title", "abstract", "speakers", track.alias("track"), F.lit("").alias("format"), "time", "tags", F.col("_i").cast("long").alias("_pos"))


def recordings(playlist: DataFrame, configured: list[str], media: DataFrame) -> DataFrame:
    """(video_id, path) of the playlist's and configured ids that have landed media (video_id, path)."""
    ids = listing.video_ids(playlist, configured, playlist.sparkSession)
    return ids.join(media, "video_id", "left").where("path is not null").orderBy("_pos").select("video_id", "path")


def with_sidecar(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """Add title ("" where unknown) and duration (0.0 where unknown) of the video's metadata."""
    m = meta.groupBy("video_id").agg(F.first("title", ignorenulls=True).alias("meta_title"), F.max("duration").alias("duration"))
    return rows.join(m, "video_id", "left").withColumn(
        "meta_title", F.coalesce("meta_title", F.lit(""))
    ).withColumn("duration", F.coalesce("duration", F.lit(0.0)))
