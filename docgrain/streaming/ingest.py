"""Incremental page ingest and rebuild with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgrain.functions.text import canonical_url, host
from docgrain.operators.stack import carry_over
from docgrain.sources.stages import stage
from docgrain.sources.versions import VersionedTable

PARTS_OF_HOST = 8


def page_stream(spark: SparkSession, path: str, schema, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def one_per_url(pages: DataFrame, key: list[str] | None = None) -> DataFrame:
    """The first row of each canonical URL. State grows with the URLs; for endless feeds use ``ingest_new``."""
    return pages.withColumn("url", canonical_url("url")).dropDuplicates([*(key or []), "url"])


def one_per_url_within(pages: DataFrame, event_time: str, delay: str) -> DataFrame:
    """As ``one_per_url``, with state that is dropped ``delay`` after a URL was seen."""
    return pages.withColumn("url", canonical_url("url")).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["url"])


def seen_index(spark: SparkSession, sink: str, buckets: int = 512) -> VersionedTable:
    """The index of the URLs in ``sink``: a host's URLs lie in at most ``PARTS_OF_HOST`` of its buckets."""
    return VersionedTable(spark, f"{sink}-seen", ["host", "part"], buckets)


def with_bucket_key(urls: DataFrame) -> DataFrame:
    return urls.withColumn("host", host("url")).withColumn("part", F.pmod(F.xxhash64("url"), F.lit(PARTS_OF_HOST)).cast("int"))


def ingest_new(pages: DataFrame, sink: str, checkpoint: str, buckets: int = 512):
    """Rows of new canonical URLs are appended to ``sink``, under the number of their batch.

    What has been seen is an index in buckets of hosts beside the sink: a batch reads the buckets of its own URLs and adds to
    them, so its cost follows the batch and not the sink, and no state is kept. A batch that is run again, because its job
    died, finds its number in the index and does nothing, or writes the same rows to the same folder. Of equal URLs of one
    batch one row stays. Late files are batches like others.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        index = seen_index(spark, sink, buckets)
        if index.mark("batch") >= epoch:
            return
        fresh = stage(batch.withColumn("url", canonical_url("url")).dropDuplicates(["url"]), "ingest")
        urls = with_bucket_key(fresh.select("url"))
        seen = index.read(index.buckets_of(urls), schema=urls.schema)
        new = stage(fresh.join(seen.select("url"), "url", "left_anti"), "ingest-new")
        kept = new.withColumn("epoch", F.lit(epoch))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(sink)
        index.append(with_bucket_key(new.select("url")), {"batch": epoch})
        index.compact()

    return pages.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rebuild_touched(changes: DataFrame, everything: Callable[[], DataFrame], build: Callable[[DataFrame], DataFrame], current: str, target: Callable[[int], str], checkpoint: str):
    """Of each batch the touched buildings are built again from all their pages; the rows of the others are carried over.

    This writes a whole new table for each batch; ``rebuild_buckets`` touches only what changes.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        touched = batch.select("building_id").distinct()
        rebuilt = build(everything().join(touched, "building_id", "left_semi"))
        carry_over(batch.sparkSession.read.parquet(current), rebuilt).write.mode("overwrite").parquet(target(epoch))

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rebuild_buckets(changes: DataFrame, pages: VersionedTable, build: Callable[[DataFrame], DataFrame], table: VersionedTable, checkpoint: str):
    """New pages are added to ``pages``, and the buildings that they belong to are built again, both in buckets of building_id.

    Of either table only the buckets of touched buildings are read, and of ``table`` only these are written; the files of all
    others stay as they are. A building of which nothing can be built keeps its rows. Each table notes the batch that it has
    taken in, so a batch that is run again does what is left of it.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        held = [VersionedTable(session, t.path, t.key, t._buckets) for t in (pages, table)]
        if held[0].mark("batch") < epoch:
            held[0].append(batch, {"batch": epoch})
        if held[1].mark("batch") >= epoch:
            return
        touched = stage(batch.select("building_id").distinct(), "rebuild-touched")
        rebuilt = stage(build(held[0].read(held[0].buckets_of(touched)).join(touched, "building_id", "left_semi")), "rebuilt")
        numbers = held[1].buckets_of(touched)
        old = held[1].read(numbers, schema=rebuilt.schema)
        held[1].replace(carry_over(old, rebuilt), numbers, {"batch": epoch})

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
