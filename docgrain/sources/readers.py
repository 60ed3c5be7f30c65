"""Readers: name and source lists, crawl output, saved records, stacked files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgrain import schemas
from docgrain.functions.text import blank_to_null, canonical_url, clean, strip, true_word

#: Fixed value: names of batch files.
BATCH_FILE = r"^thread\d+_(\d{8}(?:_\d{6})?)\.csv$"
NAME_HINTS = ("name", "building", "tên", "project")
CITY_HINTS = ("city", "thành phố", "location")


def stem(column: Column | None = None) -> Column:
    return F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path") if column is None else column, "/"), -1), r"\.[^.]*$", "")


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no (from 1), line of every text file under ``path``; files are split where they are read."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return texts.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("i", "line")).select("path", (F.col("i") + 1).alias("line_no"), "line")


def plain_names(lines: DataFrame) -> DataFrame:
    """One name a line; blank lines, comments and table rows do not count."""
    line = F.trim("line")
    return lines.where((line != "") & ~line.startswith("#") & ~line.startswith("|")).select("path", "line_no", line.alias("name"))


def markdown_names(lines: DataFrame) -> DataFrame:
    """Names from markdown tables: the columns that the header names; the city is added where the name lacks it."""
    cell = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"\[([^\]]*)\]\([^)]*\)", "$1"), r"\*\*|__|`", ""))
    order = Window.partitionBy("path").orderBy("line_no")
    rows = lines.where(F.trim("line").startswith("|")).withColumn("gap", (F.col("line_no") - F.lag("line_no", 1, -9).over(order) > 1).cast("int")).withColumn("table", F.sum("gap").over(order))
    rows = rows.where(~F.trim("line").rlike(r"^\|(\s*:?-+:?\s*\|)+$"))
    cells = rows.select("path", "table", "line_no", F.transform(F.split(strip(F.trim("line"), "|"), r"\|"), cell).alias("c"))
    inside = Window.partitionBy("path", "table").orderBy("line_no")
    numbered = cells.withColumn("n", F.row_number().over(inside)).withColumn("head", F.first("c").over(inside))
    at = lambda hints: F.filter(F.transform("head", lambda h, i: F.when(F.exists(F.array(*[F.lit(x) for x in hints]), lambda x: F.contains(F.lower(h), x)), i + 1)), lambda i: i.isNotNull())[0]
    named = numbered.where("n > 1").select("path", "line_no", F.try_element_at("c", F.coalesce(at(NAME_HINTS), F.lit(1))).alias("name"), F.try_element_at("c", at(CITY_HINTS)).alias("city"))
    full = F.when(F.col("city").isNull() | (F.col("city") == "") | F.contains(F.lower("name"), F.lower("city")), F.col("name")).otherwise(F.concat_ws(", ", "name", "city"))
    return named.where("name <> ''").select("path", "line_no", full.alias("name"))


def building_names(spark: SparkSession, path: str) -> DataFrame:
    lines = lines_of(spark, path)
    return plain_names(lines).unionByName(markdown_names(lines))


def source_list(lines: DataFrame, default_purpose: str = "official_overview") -> DataFrame:
    """URL | purpose | note lines: the first URL, the first known purpose, the rest as what is expected there."""
    parts = F.transform(F.split("line", r"\|"), lambda x: F.trim(x))
    rows = lines.where(~F.trim("line").startswith("#")).withColumn("url", F.regexp_extract("line", r"(https?://[^\s|)\]]+)", 1)).where("url <> ''").withColumn("parts", parts)
    known = F.filter("parts", lambda x: F.lower(x).isin(schemas.PURPOSES))
    note = F.filter("parts", lambda x: ~F.lower(x).isin(schemas.PURPOSES) & ~F.contains(x, F.col("url")))
    title = F.nullif(F.regexp_extract("line", r"\[([^\]]+)\]\(", 1), F.lit(""))
    return rows.select(
        stem(F.col("path")).alias("building_id"), "line_no", "url", F.coalesce(title, F.concat(F.lit("source "), F.col("line_no"))).alias("title"),
        F.coalesce(F.lower(F.try_element_at(known, F.lit(1))), F.lit(default_purpose)).alias("purpose"), F.array_join(note, " ").alias("expected_content"),
        F.lit(True).alias("is_official"), F.lit(None).cast("string").alias("language"), F.lit(1).alias("priority"),
    )


def by_priority(sources: DataFrame, key: str, ordinal: list[str], out: str = "place") -> DataFrame:
    """``place`` of each source of a building: by priority, then by its number."""
    return sources.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy("priority", *ordinal)))


def missing_sources(buildings: DataFrame, sources: DataFrame) -> DataFrame:
    """Buildings without a source file, as error rows."""
    return buildings.join(sources.select("building_id").distinct(), "building_id", "left_anti").select("building_id", F.lit("no source file").alias("error"))


def _crawl_file(pattern: str) -> str:
    """A file of each building's folder: as crawlers leave it, or as ``sinks.write_crawl`` does, a folder of its name."""
    return f"*/{{{pattern},file={pattern}}}"


def _owner() -> Column:
    path = F.col("_metadata.file_path")
    return F.coalesce(F.nullif(F.regexp_extract(path, r"/building_id=([^/]*)/file=[^/]*/[^/]*$", 1), F.lit("")), F.element_at(F.split(path, "/"), -2))


def _packed(spark: SparkSession, raw_dir: str, ending: str) -> DataFrame:
    """Files of a crawl that ``sinks.write_crawl`` packed: building_id, file, value of those whose names end so."""
    return spark.read.schema("building_id string, file string, value string").parquet(raw_dir).where(F.col("file").endswith(ending))


def manifests(spark: SparkSession, raw_dir: str, packed: bool = False) -> DataFrame:
    if packed:
        return _packed(spark, raw_dir, "manifest.json").where("file = 'manifest.json'").select(F.from_json("value", schemas.MANIFEST).alias("m")).select("m.*")
    return spark.read.schema(schemas.MANIFEST).json(f"{raw_dir}/{_crawl_file('manifest.json')}", multiLine=True)


def manifest_sources(manifest: DataFrame) -> DataFrame:
    return manifest.select("building_id", F.explode("sources").alias("s")).select("building_id", "s.*")


def load_pages(spark: SparkSession, raw_dir: str, manifest: DataFrame, packed: bool = False) -> DataFrame:
    """Pages that were fetched well, with the bodies of their text and HTML files; a missing file is an empty body."""
    good = manifest_sources(manifest).where("status = 'ok' AND text_file IS NOT NULL")
    path, written = F.col("_metadata.file_path"), r"/file=([^/]*)/[^/]*$"
    name_of = F.coalesce(F.nullif(F.regexp_extract(path, written, 1), F.lit("")), F.col("_metadata.file_name"))
    value = F.when(path.rlike(written), F.regexp_replace("value", r"\n\z", "")).otherwise(F.col("value"))  # the end of its only row
    body = lambda pattern, name: spark.read.text(f"{raw_dir}/{_crawl_file(pattern)}", wholetext=True).select(_owner().alias("building_id"), name_of.alias(name + "_file"), value.alias(name))
    if packed:
        body = lambda pattern, name: _packed(spark, raw_dir, pattern[1:]).select("building_id", F.col("file").alias(name + "_file"), F.col("value").alias(name)).hint("merge")
    joined = good.join(body("*.txt", "text"), ["building_id", "text_file"], "left").join(body("*.html", "raw"), ["building_id", "raw_file"], "left")
    return joined.select(
        "building_id", F.col("idx").alias("page_idx"), F.col("text_file").alias("name"), "url", "purpose", F.coalesce("page_title", "title").alias("title"),
        F.coalesce("raw", F.lit("")).alias("html"), F.coalesce("text", F.lit("")).alias("text"),
    )


def resolved_identity(spark: SparkSession, raw_dir: str, packed: bool = False) -> DataFrame:
    """building_id with its resolved names; without a name the id in title case."""
    if packed:
        rows = _packed(spark, raw_dir, "sources.json").where("file = 'sources.json'").select("building_id", F.from_json("value", schemas.RESOLVED).alias("s")).select("building_id", "s.*")
    else:
        rows = spark.read.schema(schemas.RESOLVED).json(f"{raw_dir}/{_crawl_file('sources.json')}", multiLine=True).withColumn("building_id", _owner())
    name = F.coalesce(blank_to_null("resolved.building_name"), F.initcap(F.replace(F.col("building_id"), F.lit("_"), F.lit(" "))))
    return rows.select("building_id", name.alias("building_name"), *[F.col(f"resolved.{c}") for c in ("building_name_local", "project_name", "country", "city", "official_website", "developer")])


def saved_floorplans(spark: SparkSession, raw_dir: str) -> DataFrame:
    """One row a plan, with its rooms."""
    rows = spark.read.schema(schemas.FLOORPLANS).json(f"{raw_dir}/{_crawl_file('extract_floorplan.json')}", multiLine=True)
    return rows.select(_owner().alias("building_id"), F.posexplode("plans").alias("plan_idx", "p")).select("building_id", "plan_idx", "p.*")


def saved_records(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Records of a table that were extracted before, with the file they stand in."""
    return spark.read.schema(schemas.TABLES[table]).json(f"{path}/{table}").withColumn("source_path", F.col("_metadata.file_path"))


def earlier_shards(spark: SparkSession, path: str, stamp: str | None = None) -> DataFrame:
    """Rows of shards written before, with all the columns they have."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows if stamp is None else rows.where(F.col("stamp") == stamp)


def verified_rooms(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return rows.where(true_word("verified")).withColumns({c: rows[c].try_cast("double") for c in ("area_m2", "width_m", "length_m")} | {c: true_word(c) for c in ("has_window", "is_ensuite")})


def stacked_csv(spark: SparkSession, path: str) -> DataFrame:
    """Stacked output files: strings, without a byte-order mark; the id is filled from the row's key or the file's name.

    Files are grouped by their own header, so columns of one that stand in another order, or are missing, do not shift; files
    without the two columns of the stack, of batches and with a leading underscore do not count. The number of different
    headers is that of versions of the schema.
    """
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.substring_index("value", "\n", 1).alias("head"))
    name = F.element_at(F.split("file", "/"), -1)
    usable = lines.where(~name.startswith("_") & ~name.rlike(BATCH_FILE)).withColumn("head", strip(F.regexp_replace("head", "^\ufeff", "")))
    parts = []
    for head in [r.head for r in usable.select("head").distinct().collect()]:  # one a version of the schema
        columns = [c.strip().strip('"') for c in head.split(",")]
        if not {"bang", "record_key"} <= set(columns):
            continue
        files = [r.file for r in usable.where(F.col("head") == head).select("file").collect()]
        rows = spark.read.csv(files, header=True, multiLine=True, escape='"', schema=", ".join(f"`{c}` string" for c in columns), enforceSchema=True)
        own = blank_to_null("building_id") if "building_id" in columns else F.lit(None).cast("string")
        parts.append(rows.withColumn("building_id", F.coalesce(own, owner_of_key("record_key"), F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1))))
    if not parts:
        raise ValueError("no stacked file: bang and record_key are missing")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def owner_of_key(key: str) -> Column:
    return F.when(F.contains(F.col(key), F.lit("__")), F.substring_index(key, "__", 1))


def latest_batch(files: DataFrame, name: str = "file_name", every: bool = False) -> DataFrame:
    """Of batch files ``threadN_YYYYMMDD[_HHMMSS].csv`` those of the newest stamp; without any the other files."""
    rows = files.withColumn("stamp", F.nullif(F.regexp_extract(name, BATCH_FILE, 1), F.lit("")))
    if every:
        return rows
    newest = rows.agg(F.max("stamp").alias("newest"))  # one row
    return rows.join(F.broadcast(newest), rows["stamp"].eqNullSafe(F.col("newest"))).drop("newest")


def done_index(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """query, building_id of JSON objects that map one to the other: one a file, or one a line."""
    text = spark.read.text(path, wholetext=whole)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("query", "building_id"))


def retyped(rows: DataFrame) -> DataFrame:
    """Text columns of a stacked file by what their names say: counts and years whole, areas, prices, shares numbers, is_/has_/includes_ yes or no."""
    whole = ("num_", "year_", "bedrooms", "units_per_floor", "amenity_count", "sample_size")
    number = ("_m2", "_m", "_pct", "_ratio", "price_min", "price_max", "price_avg", "latitude", "longitude", "fx_rate_to_usd")

    def typed(c: str) -> Column:
        if c.startswith(("is_", "has_", "includes_")):
            return true_word(c)
        if c.startswith(whole):
            return F.round(F.trim(c).try_cast("double")).cast("long")
        return F.trim(c).try_cast("double") if c.endswith(number) or c in number else blank_to_null(c)

    return rows.select(*[typed(c).alias(c) for c in rows.columns])


def infobox(cells: DataFrame, key: str = "page_id") -> DataFrame:
    """Facts of an encyclopaedia infobox from label/value cells: coordinates, height, place, year, architect."""
    pick = lambda words: F.min_by("value", F.when(F.lower("label").rlike(words), F.col("kv_idx")))
    raw = cells.groupBy(key).agg(pick("coordinates").alias("c"), pick("height|tip").alias("h"), pick("location|address").alias("p"), pick("completed|opened|built").alias("y"), pick("architect").alias("architect"))
    degree = lambda k: F.regexp_extract("c", r"([-+]?\d+(?:\.\d+)?)\s*[;,]\s*([-+]?\d+(?:\.\d+)?)", k).try_cast("double")
    metres = lambda unit: F.replace(F.regexp_extract(clean("h"), rf"([\d,.]+)\s*{unit}\b", 1), F.lit(","), F.lit("")).try_cast("double")
    place = F.transform(F.split("p", ","), lambda x: F.trim(x))
    return raw.select(
        key, degree(1).alias("latitude"), degree(2).alias("longitude"), metres("m").alias("height_m"), metres("ft").alias("height_ft"),
        F.try_element_at(place, F.lit(-1)).alias("country"), F.try_element_at(place, F.lit(-2)).alias("city"), F.regexp_extract("y", r"((?:18|19|20)\d{2})", 1).try_cast("int").alias("year_completed"), "architect",
    )


def new_urls(sources: DataFrame, crawled: DataFrame, ordinal: str = "idx") -> DataFrame:
    """Sources whose canonical URL is not crawled yet, the first of each, numbered on from the largest index there is."""
    keyed = sources.withColumn("url", canonical_url("url"))
    fresh = keyed.join(crawled.select("building_id", canonical_url("url").alias("url")).distinct(), ["building_id", "url"], "left_anti")
    first = fresh.withColumn("n", F.row_number().over(Window.partitionBy("building_id", "url").orderBy(ordinal))).where("n = 1").drop("n")
    last = crawled.groupBy("building_id").agg(F.max("idx").alias("last"))
    order = Window.partitionBy("building_id").orderBy(ordinal)
    return first.join(last, "building_id", "left").withColumn("new_idx", F.coalesce("last", F.lit(0)) + F.row_number().over(order)).drop("last")
