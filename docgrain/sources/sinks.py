"""Writers: stacked files, shards, benchmark, crawl log, warnings, review sheets, nested payloads, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgrain import schemas
from docgrain.sources.stages import ranked


def cell(c: Column, kind: T.DataType) -> Column:
    """A value as the text of a cell: lists joined by "; ", maps and structs as JSON, null as nothing."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        text = F.array_join(c, "; ")
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def as_cells(df: DataFrame) -> DataFrame:
    return df.select(*[cell(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def write_per_building(stacked: DataFrame, path: str, fmt: str = "csv") -> None:
    cells = as_cells(stacked).repartition("building_id").sortWithinPartitions("building_id", "bang", "record_key")
    cells.write.mode("overwrite").partitionBy("building_id").option("header", True).format(fmt).save(path)


def write_crawl(crawled: DataFrame, identity: DataFrame, path: str, packed: bool = False) -> None:
    """A crawl folder: of each building its manifest, its identity and the bodies of its pages, which the readers of crawl output read.

    ``crawled`` has building_id and, for each source, some of the fields of a manifest's sources, with ``text`` and ``html`` as
    the bodies of ``text_file`` and ``raw_file``; ``identity`` has building_id and fields of the resolved identity. A file
    is a folder ``building_id=.../file=<name>`` with its only part. Bodies meet in no row with others; a manifest, which is
    one document, holds its building's sources in order of idx. ``packed`` writes the same files as rows (building_id, file,
    value) of one table instead, for crawls of so many pages that a file of each would cost more than its bytes.
    """
    fields = T.StructType.fromDDL(schemas.MANIFEST)["sources"].dataType.elementType
    listed = F.array_sort(F.collect_list(F.struct(*[(F.col(f.name) if f.name in crawled.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])))
    per = crawled.groupBy("building_id").agg(F.max("accessed_at").alias("accessed_at"), F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), listed.alias("sources"))
    file = lambda rows, name, value: rows.select("building_id", name.alias("file"), value.alias("value"))
    manifest = file(per, F.lit("manifest.json"), F.to_json(F.struct("building_id", "accessed_at", "total", "ok", "sources")))
    known = file(identity, F.lit("sources.json"), F.to_json(F.struct(F.col("building_id").alias("query"), F.struct(*[c for c in identity.columns if c != "building_id"]).alias("resolved"))))
    bodies = [file(crawled.where(F.col(n).isNotNull() & F.col(b).isNotNull()), F.col(n), F.col(b)) for n, b in (("text_file", "text"), ("raw_file", "html"))]
    files = reduce(DataFrame.unionByName, [manifest, known, *bodies])
    if packed:
        files.write.mode("overwrite").parquet(path)
    else:
        files.write.mode("overwrite").partitionBy("building_id", "file").text(path)


def shard_of(df: DataFrame, shards: int, key: str = "building_id") -> DataFrame:
    """Round robin over the sorted ids: the distinct ids are ranked, rows get their shard by a join. Rows without an id are
    those of one more id, the first."""
    ids = ranked(df.select(key).distinct(), key).select(F.col(key).alias("_id"), (F.col("rank") % shards).cast("int").alias("shard"))
    return df.join(ids, F.col(key).eqNullSafe(F.col("_id"))).drop("_id")


def write_shards(df: DataFrame, path: str, shards: int, stamp: str) -> None:
    rows = shard_of(df, shards).withColumn("stamp", F.lit(stamp)).repartition("shard").sortWithinPartitions("building_id", "bang", "record_key")
    as_cells(rows.drop("shard", "stamp")).columns  # noqa: B018  fails early on types that have no cell
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stamp", "shard").parquet(path)


def append_shards(spark: SparkSession, df: DataFrame, path: str, shards: int, day: str) -> None:
    """Shards written on a day that has some already carry its first stamp on, and those beyond the new number go."""
    try:
        seen = spark.read.parquet(path).where(F.col("stamp").cast("string").startswith(day)).agg(F.min(F.col("stamp").cast("string"))).first()[0]
    except AnalysisException as e:  # nothing has been written yet
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        seen = None
    rows = shard_of(df, shards).repartition("shard").sortWithinPartitions("building_id", "bang", "record_key")
    # the folder of one stamp is replaced as a whole, which takes stale shards along
    rows.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/stamp={seen or day}")


def write_features(rows: DataFrame, path: str) -> None:
    """One flat file of cells, one row a building."""
    as_cells(rows).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def non_empty_columns(df: DataFrame) -> list[str]:
    """Columns that hold something in some row: one pass for all."""
    held = df.agg(*[F.count(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))).alias(c) for c in df.columns]).first().asDict()
    return [c for c in df.columns if held[c]]


def benchmark(stacked: DataFrame) -> DataFrame:
    """Only the buildings, without the columns of the stack and without empty ones."""
    rows = stacked.where("bang = 'building'").drop("bang", "bang_ten", "record_key", "record_label", "confidence", "source_urls", "evidence_json")
    return rows.select(*non_empty_columns(rows))


def crawl_log(sources: DataFrame) -> DataFrame:
    return sources.select(*schemas.CRAWL_LOG)


def write_warnings(warnings: DataFrame, path: str) -> None:
    warnings.select("building_id", F.col("message").alias("value")).write.mode("overwrite").partitionBy("building_id").text(path)


def review_sheet(rooms: DataFrame, types: DataFrame) -> DataFrame:
    """Rooms with their type code and an empty ``verified`` to fill in."""
    return rooms.join(types.select("unit_type_id", "type_code"), "unit_type_id", "left").withColumn("verified", F.lit(""))


def write_review_sheet(sheet: DataFrame, path: str) -> None:
    sheet.write.mode("errorifexists").option("header", True).csv(path)


def nested_payload(parent: DataFrame, key: str, children: dict[str, DataFrame]) -> DataFrame:
    """Each parent with arrays of its children; children are gathered by the key before the joins."""

    def with_child(df: DataFrame, item: tuple[str, DataFrame]) -> DataFrame:
        name, rows = item
        fields = [c for c in rows.columns if c != key]
        gathered = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        return df.join(gathered, key, "left")

    return reduce(with_child, children.items(), parent)


def upsert(old: DataFrame, new: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The newest row of each key. ``versions.VersionedTable.upsert`` writes it and switches readers over."""
    every = old.unionByName(new)
    return every.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")


def grow_dictionary(known: DataFrame, pairs: DataFrame, source_script: str) -> DataFrame:
    """Insert-only: new terms with a translation that is not blank, not the term itself and not in source script."""
    good = pairs.where((F.trim("translation") != "") & (F.col("translation") != F.col("term")) & ~F.col("translation").rlike(f"[{source_script}]"))
    return known.unionByName(good.dropDuplicates(["term"]).join(known, "term", "left_anti").select(*known.columns))


def write_records(records: dict[str, DataFrame], path: str) -> None:
    for table, rows in records.items():
        rows.write.mode("overwrite").json(f"{path}/{table}")
