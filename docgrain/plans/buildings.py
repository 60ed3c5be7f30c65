"""From crawled pages to the seven tables of buildings: one job graph for all buildings, keyed by building_id.

Extractors are functions from DataFrames to DataFrames, registered by table; a site can register its own with a higher
priority (``src_rank`` 0) for its hosts, whose pages alone it sees, and the coalescing merge decides field by field. An
extractor that fails, when it is planned or in a task, leaves a row of errors and no gap in what the others find.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgrain import schemas
from docgrain.functions import domain, numbers
from docgrain.functions.text import clean, clean_literal, slug, squash
from docgrain.functions.text import host as host_of
from docgrain.operators import cells as C
from docgrain.operators import derive, records
from docgrain.plans import dictionaries as D
from docgrain.sources.stages import stage

class Extractor(NamedTuple):
    """What finds records of a table; with hosts it sees the pages of these hosts and their subdomains only."""

    rank: int
    run: Callable
    hosts: tuple[str, ...] | None = None


EXTRACTORS: dict[str, list[Extractor]] = {}
ERRORS = "table string, extractor string, hosts string, error string"


def extractor(table: str, rank: int = 1, hosts: tuple[str, ...] | None = None, registry: dict[str, list[Extractor]] | None = None) -> Callable:
    """Register a function (pages, cells, as_of) -> rows as an extractor of ``table``; a site's has rank 0 and its hosts."""
    into = EXTRACTORS if registry is None else registry

    def register(f: Callable) -> Callable:
        into.setdefault(table, []).append(Extractor(rank, f, hosts))
        return f

    return register


def of_hosts(pages: DataFrame, hosts: tuple[str, ...] | None, host: str = "host") -> DataFrame:
    """The pages of the hosts, or their subdomains, that a site's extractor is for; all pages without any."""
    if not hosts:
        return pages
    return pages.where(reduce(lambda a, b: a | b, [(F.col(host) == h) | F.col(host).endswith("." + h) for h in hosts]))


def run_extractors(pages: DataFrame, extractors: list[tuple[Callable, tuple | None]]) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """(records of each extractor that works, (name, error) of those whose plan fails): one bad extractor ends no job.

    An extractor is declared over all its pages at once, so what is wrong with it shows when its plan is made.
    """
    found, errors = [], []
    for f, hosts in extractors:
        try:
            rows = f(of_hosts(pages, hosts))
            rows.schema  # noqa: B018  makes the plan
            found.append(rows)
        except AnalysisException as e:
            errors.append((f.__name__, str(e)[:300]))
    return found, errors


def page_cells(pages: DataFrame) -> DataFrame:
    """Cells of all pages with what the pages are trusted for; a page that can't be parsed has a row with an error."""
    about = ["url", "purpose", "title", "name", "trust", "confidence"]
    known = pages.where("building_id IS NOT NULL AND page_idx IS NOT NULL").withColumns({"trust": C.trust(F.col("purpose")), "confidence": C.confidence(F.col("purpose"))})
    cells = C.page_cells(known, ["building_id", "page_idx", *about])
    return cells.select("building_id", "page_idx", *[c for c in cells.columns if c not in ("building_id", "page_idx", *about)], *about)


def good_cells(cells: DataFrame) -> DataFrame:
    return cells.where("error IS NULL").drop("error") if "error" in cells.columns else cells


LABELS = [(f, x, i) for f, words in D.FIELD_LABELS.items() for i, x in enumerate(words)]


def _valid(field: Column, v: Column) -> Column:
    """The validator of each field."""
    return (
        F.when(field == "address", domain.is_address(v)).when(field == "num_units_total", domain.is_count(v, 2)).when(field == "structure", v.rlike(r"\d+\s*階"))
        .when(field.isin("land_area_m2", "gfa_m2"), domain.is_area(v)).when(field.isin("handover", "completion", "launch"), domain.year(v).isNotNull())
        .when(field == "developer", domain.has_company(v)).when(field == "architect", domain.is_company(v)).when(field == "kind", (F.length(v) <= 20) & F.contains(v, F.lit("マンション")))
        .when(field == "parking", v.rlike(r"\d+\s*台")).when(field == "price", numbers.money_jpy(v).isNotNull()).when(field == "period", domain.period(v).isNotNull()).otherwise(False)
    )


ORDER = ["label_rank", "trust", "page_idx", "kv_idx"]


@extractor("building")
def building(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    matches = C.label_matches(cells, LABELS)
    best = C.best_cell(matches.where(_valid(F.col("field"), F.col("value"))), "building_id", ORDER)
    v = lambda f: F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"_{f}")
    wide = best.groupBy("building_id").agg(*[v(f) for f in D.FIELD_LABELS])
    flat = pages.select("building_id", "page_idx", C.trust(F.col("purpose")).alias("trust"), clean("text").alias("flat"))
    order = F.struct("trust", "page_idx")
    flat = flat.withColumn("h", domain.height_m("flat")).withColumn("c", domain.ceiling_m("flat"))
    scanned = flat.groupBy("building_id").agg(
        F.min_by("h", F.when(F.col("h").isNotNull(), order)).alias("height_m"), F.min_by("c", F.when(F.col("c").isNotNull(), order)).alias("floor_to_ceiling_m"),
        *[F.max(F.contains("flat", F.lit(clean_literal(t)))).alias(f"_t{i}") for i, t in enumerate(D.SIGNATURE_TERMS)],
    )
    features = F.array_compact(F.array(*[F.when(F.col(f"_t{i}"), F.lit(t)) for i, t in enumerate(D.SIGNATURE_TERMS)]))
    handed, units, storeys = F.col("handed"), F.col("units"), F.col("storeys")
    ids = pages.select("building_id").distinct()
    rows = ids.join(wide.hint("merge"), "building_id", "left").join(scanned.hint("merge"), "building_id", "left")
    rows = rows.withColumn("handed", F.coalesce(domain.year("_handover"), domain.year("_completion"))).withColumn("units", numbers.int_of("_num_units_total")).withColumn("storeys", domain.floors("_structure"))
    return rows.select(
        "building_id", F.trim(F.substring_index("_address", "地図", 1)).alias("address"), domain.district("_address").alias("district"), units.alias("num_units_total"),
        storeys["above"].alias("num_floors_above"), storeys["below"].alias("num_basements"), numbers.area_m2("_land_area_m2").alias("land_area_m2"),
        numbers.area_m2("_gfa_m2").alias("gfa_m2"), handed.alias("year_handover"), domain.status(handed, F.coalesce("_completion", "_handover"), F.lit(int(as_of[:4]))).alias("status"),
        domain.year("_launch").alias("year_launch"), domain.companies("_developer").alias("developer"), F.trim(F.substring_index("_architect", "、", 1)).alias("architect_firm"),
        F.when(F.col("_kind").isNotNull(), F.lit("chung_cu")).alias("building_type"), "height_m", "floor_to_ceiling_m", domain.parking_ratio("_parking", units).alias("parking_ratio"),
        F.when(F.size(features) > 0, features).alias("signature_features"),
    )


def type_blocks(cells: DataFrame) -> DataFrame:
    """Cells in blocks of one type each: a type label opens a block, and a layout cell does where only the title has a code."""
    label = F.col("label")
    opens = reduce(lambda a, b: a | b, [F.contains(label, F.lit(clean_literal(w))) for w in D.TYPE_LABELS]) & ~F.contains(label, F.lit("間取り"))
    marked = cells.withColumn("opens", opens).withColumn("code", F.when(opens, domain.type_code("value", C.KNOWN_LABELS)))
    blocks = C.segment(marked, ["building_id", "page_idx"], "kv_idx", F.col("opens"))
    inside = Window.partitionBy("building_id", "page_idx", "block")
    own = F.max("code").over(inside)
    layout = F.min(F.when(F.contains(label, F.lit("間取り")), F.col("kv_idx"))).over(inside)
    titled = F.when(own.isNull() & (F.col("kv_idx") >= layout), domain.title_code("title"))
    return blocks.withColumn("block_code", F.coalesce(own, titled)).where("block_code IS NOT NULL AND NOT opens")


@extractor("unit_type")
def unit_type(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    label = F.col("label")
    slot = (
        F.when(F.contains(label, F.lit("間取り")), "layout").when(F.contains(label, F.lit("専有")) & F.contains(label, F.lit("面積")), "area")
        .when(F.contains(label, F.lit("バルコニ")) & F.contains(label, F.lit("面積")) & ~F.contains(label, F.lit("サービス")) & ~F.contains(label, F.lit("サ-ビス")), "balcony")
    )
    slots = type_blocks(cells).withColumn("slot", slot).where("slot IS NOT NULL")
    first = lambda s, c: F.min_by(c, F.when(F.col("slot") == s, F.col("kv_idx"))).alias(f"{s}_{c}")
    per = slots.groupBy("building_id", "page_idx", "block", "block_code", "trust", "purpose", "url").agg(first("layout", "value"), first("area", "value"), first("area", "label"), first("balcony", "value"))
    per = per.withColumn("lo", numbers.area_range_m2("area_value")["lo"]).withColumn("basis", domain.area_basis(F.concat_ws(" ", "area_label", "area_value"), F.col("area_label")))
    per = per.withColumn("plan", domain.layout("layout_value")).withColumn("balcony", numbers.area_m2("balcony_value"))
    lo, basis, plan, balcony = F.when(F.col("lo").between(8, 1000), F.col("lo")), F.col("basis"), F.col("plan"), F.col("balcony")
    net = basis == "thong_thuy"
    tabled = per.select(
        "building_id", "trust", "page_idx", F.col("block").alias("ord"), F.col("block_code").alias("type_code"), plan["bedrooms"].alias("bedrooms"), plan["layout_class"].alias("layout_class"),
        plan["has_multipurpose_room"].alias("has_multipurpose_room"), F.when(net, lo).alias("area_net_m2"), F.when(~net, lo).alias("area_gross_m2"), F.when(lo.isNotNull(), basis).alias("area_basis_reported"),
        F.when(balcony.between(0.5, 300), balcony).alias("area_balcony_m2"), F.when(F.col("purpose") == "floorplan", F.col("url")).alias("floorplan_url"),
    )
    texts = text_blocks(pages).withColumn("plan", domain.layout("layout")).withColumn("m2", numbers.area_m2("area"))
    area = F.when(F.col("m2").between(8, 1000), F.col("m2"))
    written = texts.select(
        "building_id", "trust", "page_idx", F.col("line_no").alias("ord"), F.col("code").alias("type_code"), plan["bedrooms"].alias("bedrooms"), plan["layout_class"].alias("layout_class"),
        plan["has_multipurpose_room"].alias("has_multipurpose_room"), area.alias("area_net_m2"), F.when(area.isNotNull(), F.lit("thong_thuy")).alias("area_basis_reported"),
    )
    return tabled.unionByName(written, allowMissingColumns=True)


def text_blocks(pages: DataFrame, span: int = 8) -> DataFrame:
    """Types as lines of text: a code line, then its layout, area and price within the next lines."""
    coded = pages.where(clean("text").rlike(r"[A-Z][-‐]\d"))  # no other text has a code line
    lines = coded.select("building_id", "page_idx", "url", "purpose", C.trust(F.col("purpose")).alias("trust"), F.posexplode(F.split("text", r"\r?\n")).alias("line_no", "line")).withColumn("line", clean("line"))
    ahead = C.look_ahead(lines, ["building_id", "page_idx"], "line_no", "line", span).where(F.col("line").rlike(r"^[A-Z]{1,3}[-‐]\d{1,3}[A-Za-z]{0,4}$"))
    plan = r"(?i)\d\s*(?:LDK|DK|SLDK|K|R)"
    rows = ahead.where(F.array_join("window", " ").rlike(plan))
    layout = F.try_element_at(F.filter("window", lambda x: x.rlike(plan) & ~F.contains(x, F.lit("面積"))), F.lit(1))
    price = F.filter("window", lambda x: ~F.contains(x, F.lit("価格帯")))
    return rows.select("building_id", "page_idx", "url", "purpose", "trust", "line_no", F.col("line").alias("code"), layout.alias("layout"), C.after_colon_or_next(F.col("window"), "専有面積").alias("area"), C.after_colon_or_next(price, "価格").alias("price"), squash(F.concat_ws(" ", "line", F.array_join("window", " ")), 200).alias("snippet"))


@extractor("handover_item")
def handover_item(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    official = pages.where(F.col("purpose").isin(schemas.OFFICIAL))
    found = C.dictionary_matches(official, ["building_id", "page_idx"], "text", D.HANDOVER, ["term", "item_code", "item_category"], D.OPTION_HINTS)
    first = C.first_per_code(found, "building_id", "item_code", ["page_idx", "dict_idx"])
    return first.select("building_id", F.lit(0).alias("trust"), "page_idx", F.col("dict_idx").alias("ord"), "item_code", "item_category", F.col("term").alias("item_name"), F.nullif(squash("sentence", 200), F.lit("")).alias("item_spec"), "is_included")


@extractor("amenity")
def amenity(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    official = pages.where(F.col("purpose").isin(schemas.OFFICIAL))
    found = C.dictionary_matches(official, ["building_id", "page_idx", "purpose"], "text", D.AMENITY, ["term", "slug", "amenity_category", "is_indoor"], limit=120)
    first = C.first_per_code(found, "building_id", "slug", ["page_idx", "dict_idx"])
    return first.select(
        "building_id", F.lit(0).alias("trust"), "page_idx", F.col("dict_idx").alias("ord"), "slug", "amenity_category", F.col("term").alias("amenity_name"), F.col("term").alias("amenity_name_local"), "is_indoor",
        F.when(F.col("purpose") == "amenities", True).alias("is_highlight"), domain.floor_mention(F.col("sentence")).alias("floor_level"),
    )


@extractor("price_obs")
def price_obs(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    """Prices a unit: those of single types, and one range for the building; under a million yen, or without a period, none."""
    matches = C.label_matches(cells, LABELS).where(_valid(F.col("field"), F.col("value")))
    per_page = Window.partitionBy("building_id", "page_idx", "field").orderBy("label_rank", "kv_idx")
    picked = stage(matches.where(F.col("field").isin("price", "period")).withColumn("_n", F.row_number().over(per_page)).where("_n = 1").drop("_n"), "picked")
    periods = picked.where("field = 'period'").select("building_id", "page_idx", domain.period("value").alias("period"))
    usable = lambda df: df.where(~F.col("purpose").isin("price_secondary", "market_report", "news_report"))
    dated = lambda df: df.join(periods.hint("merge"), ["building_id", "page_idx"], "left").withColumn("period", F.coalesce("period", F.lit(as_of[:7])))
    source = F.when(F.col("purpose").isin(schemas.OFFICIAL), "cdt_official").otherwise("portal_niem_yet")
    same = [F.lit("so_cap").alias("market"), F.lit("JPY").alias("currency"), F.lit("per_unit").alias("price_unit"), F.lit("khong_ro").alias("price_basis"), "period", source.alias("source_type"), F.col("url").alias("listing_url")]
    types = dated(usable(text_blocks(pages))).withColumn("price_avg", numbers.money_jpy("price")).where("price_avg >= 1e6")
    typed = types.select("building_id", "trust", "page_idx", F.col("line_no").alias("ord"), F.col("code").alias("unit_type_code"), "price_avg", *same)
    ranges = dated(usable(picked.where("field = 'price'"))).withColumn("money", numbers.money_range_jpy("value")).withColumn("price_min", F.col("money.lo")).withColumn("hi", F.col("money.hi")).where("price_min >= 1e6")
    one = ranges.withColumn("_m", F.row_number().over(Window.partitionBy("building_id").orderBy("trust", "page_idx"))).where("_m = 1")
    ranged = one.select("building_id", "trust", "page_idx", F.lit(-1).alias("ord"), F.lit(None).cast("string").alias("unit_type_code"), "price_min", F.when(F.col("hi") != F.col("price_min"), F.col("hi")).alias("price_max"), *same)
    return typed.unionByName(ranged, allowMissingColumns=True)


def _sites(registered: dict[str, list[Extractor]]) -> list[tuple[str, ...]]:
    """The sites in the order in which they were registered; a site is what its extractors give as hosts."""
    return list(dict.fromkeys(x.hosts for found in registered.values() for x in found if x.hosts))


def site_number(host: Column, sites: list[tuple[str, ...]]) -> Column:
    """The number of the first site that has the host or a domain above it; null for a page of no site."""
    fits = lambda hosts: reduce(lambda a, b: a | b, [(host == h) | host.endswith("." + h) for h in hosts])
    return F.coalesce(F.lit(None).cast("int"), *[F.when(fits(hosts), F.lit(i)) for i, hosts in enumerate(sites)])


def _empty(pages: DataFrame, table: str) -> DataFrame:
    """No records, with all columns that any may have: what is left of a table whose extractors all failed."""
    columns = schemas.TABLES[table]
    more = [f"{k} string" for k in schemas.DEDUP_KEYS[table] if f"{k} " not in columns]
    return pages.sparkSession.createDataFrame([], ", ".join([columns, *more, "ord struct<src_rank:int,trust:int,page_idx:int,ord:int>"]))


def _merged(table: str, rows: DataFrame) -> DataFrame:
    """One record a key: better sources first, duplicates coalesced field by field. Rows are dealt by building as they are
    found, so a field is parsed once, not wherever the aggregate names it."""
    order = [c for c in ("src_rank", "trust", "page_idx", "ord") if c in rows.columns]
    key = ["building_id", *schemas.DEDUP_KEYS[table]]
    fields = [c for c in rows.columns if c not in {*key, *order}]
    several = len(order) > 1
    dealt = (rows.where("building_id IS NOT NULL") if several else rows).repartition("building_id")
    merged = records.coalesce_merge(dealt, key, fields, order, first="ord" if several else None)
    return merged.withColumns({k: F.nullif(F.col(k), F.lit("")) for k in schemas.DEDUP_KEYS[table]})


def extract_guarded(pages: DataFrame, as_of: str, extractors: dict[str, list[Extractor]] | None = None, cells: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Merged records of each table, and an error row (table, extractor, hosts, error) for each extractor that failed.

    A page that can't be parsed has an error row too (``cells``, its address). A page belongs to the first site registered for its host, and only that site's extractors see it, beside the general
    ones, which see all. Plans are made one by one, so one that can't be made is left out at once. All extractors of a table
    run together; if that fails in a task, the rows of each are written as a stage of their own, and those that can be
    written are merged. A failure that none of them has alone is raised.
    """
    registered = EXTRACTORS if extractors is None else extractors
    every = stage(page_cells(pages), "cells") if cells is None else cells
    cells = good_cells(every)
    sites, errors, out = _sites(registered), [], {}
    placed = lambda df: df.withColumn("_site", site_number(host_of("url"), sites))
    seen = lambda df, x: df if not x.hosts else placed(df).where(F.col("_site") == sites.index(x.hosts)).drop("_site")

    def failed(table: str, x: Extractor, e: Exception) -> None:
        errors.append((table, x.run.__name__, ", ".join(x.hosts or ()), str(e)[:1000]))

    for table, found in registered.items():
        parts, union = [], None
        for x in found:
            try:
                rows = x.run(seen(pages, x), seen(cells, x), as_of).withColumn("src_rank", F.lit(x.rank))
                together = rows if union is None else union.unionByName(rows, allowMissingColumns=True)
                together.schema  # noqa: B018  makes the plan
            except Exception as e:  # whatever an extractor does wrong, it does not end the job
                failed(table, x, e)
                continue
            parts.append((x, rows))
            union = together
        try:
            out[table] = _empty(pages, table) if union is None else stage(_merged(table, union), f"records-{table}")
        except (PySparkException, Py4JError):
            written = []
            for x, rows in parts:
                try:
                    written.append(stage(rows, f"rows-{table}"))
                except (PySparkException, Py4JError) as e:
                    failed(table, x, e)
            if len(written) == len(parts):
                raise
            union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), written) if written else None
            out[table] = _empty(pages, table) if union is None else stage(_merged(table, union), f"records-{table}")
    told = pages.sparkSession.createDataFrame(errors, ERRORS)
    if "error" in every.columns:
        broken = every.where("error IS NOT NULL").select(F.lit("cells").alias("table"), F.col("url").alias("extractor"), host_of("url").alias("hosts"), "error")
        told = told.unionByName(broken)
    return out, told


def extract(pages: DataFrame, as_of: str, extractors: dict[str, list[Extractor]] | None = None, cells: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of ``extract_guarded``."""
    return extract_guarded(pages, as_of, extractors, cells)[0]


def _keyed(rows: DataFrame, parts: list[Column], out: str, scope: str = "building_id") -> DataFrame:
    return records.unique_keys(rows.withColumn("_base", F.concat_ws("__", scope, *parts)), "_base", ["ord"], out).drop("_base")


def assemble(found: dict[str, DataFrame], identity: DataFrame, plans: DataFrame, verified: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The seven tables: keys, foreign keys, rooms and plates from plans, derived columns.

    ``plans`` are rows of saved_floorplans, ``verified`` rooms checked by hand (with building_id and type_code).
    """
    coded = found["unit_type"].where("type_code IS NOT NULL")
    types = records.project(_keyed(coded, [slug("type_code")], "unit_type_id"), schemas.TABLES["unit_type"] + ", ord struct<src_rank:int,trust:int,page_idx:int,ord:int>")
    types = stage(types.withColumn("ratio_net_gross_pct", numbers.percent(F.col("area_net_m2"), F.col("area_gross_m2"))), "types")
    resolve = lambda rows, code: records.resolve_foreign_key(rows, code, types, "type_code", "unit_type_id", "ord", ["building_id"])

    unit_plans = resolve(plans.where("is_floorplan AND plan_kind = 'unit'"), "matched_type_code")
    drawn = unit_plans.where("unit_type_id IS NOT NULL").select("building_id", "unit_type_id", F.col("matched_type_code").alias("type_code"), "plan_idx", F.posexplode("rooms").alias("i", "r")).select("building_id", "unit_type_id", "type_code", "plan_idx", "i", "r.*")
    drawn = drawn.withColumn("source_type", F.lit("floorplan_image"))
    by_hand = resolve(verified, "type_code").where("unit_type_id IS NOT NULL").withColumn("source_type", F.lit("manual")).withColumn("plan_idx", F.lit(0)).withColumn("i", F.row_number().over(Window.partitionBy("unit_type_id").orderBy("room_code")))
    rooms = records.override(drawn, by_hand.select(*[c for c in drawn.columns if c in by_hand.columns]), ["building_id", "type_code", "room_code"])
    rooms = _keyed(rooms.withColumn("ord", F.struct("plan_idx", "i")), [slug("room_code")], "room_id", "unit_type_id")

    floors = plans.where("is_floorplan AND plan_kind = 'floor' AND units_on_floor IS NOT NULL").select("building_id", "tower_code", "floor_range", "floor_label", F.col("units_on_floor").alias("units_per_floor"), F.col("plan_idx").alias("ord"))
    written = found.get("floor_plate")
    plates = floors if written is None else records.fallback(written, floors, "building_id")
    plates = _keyed(records.project(plates, schemas.TABLES["floor_plate"] + ", ord int").drop("floor_plate_id"), [slug("tower_code", fallback="main"), slug("floor_range", fallback="na")], "floor_plate_id")
    plates = plates.withColumn("efficiency_per_floor_pct", numbers.percent(F.col("nfa_per_floor_m2"), F.col("gfa_per_floor_m2"))).withColumn("units_per_elevator", numbers.per_elevator(F.col("units_per_floor"), F.col("num_elevators")))

    plates = stage(plates, "plates")
    items = _keyed(found["handover_item"], [slug("item_code")], "handover_id")
    amenities = stage(_keyed(found["amenity"], [F.col("slug")], "amenity_id"), "amenities")
    priced = resolve(found["price_obs"].withColumn("price_avg", numbers.average_price(F.col("price_avg"), F.col("price_min"), F.col("price_max"))), "unit_type_code")
    fx = priced.sparkSession.createDataFrame(list(schemas.FX_TO_USD.items()), "currency string, usd_rate double")
    priced = derive.usd_per_m2(priced, fx).withColumn("observed_at", F.lit(as_of))
    prices = _keyed(priced, [F.coalesce("unit_type_id", F.lit("all")), F.coalesce("market", F.lit("na")), F.coalesce("period", F.lit("na"))], "price_id")

    share = lambda otherwise: derive.weight("num_units_of_type", "share_of_total_pct", otherwise)
    wide = types
    area = derive.bounds_with_fallback(wide, "building_id", "area_net_m2", "area_gross_m2").withColumnsRenamed({"lo": "unit_area_min_m2", "hi": "unit_area_max_m2"})
    classes = wide.groupBy("building_id").agg(derive.distinct_list("layout_class").alias("unit_types_summary"))
    mode = derive.weighted_mode(wide, "building_id", "layout_class", share(1.0), "ord").withColumnRenamed("mode", "dominant_layout_class")
    mix = derive.mix_map(derive.mix_percent(wide, "building_id", "bedrooms", share(0.0)), "building_id", "bedrooms").withColumnRenamed("mix", "mix_by_bedroom_pct")
    typical = plates.groupBy("building_id").agg(F.max(F.when(F.col("floor_label") == "dien_hinh", F.col("units_per_floor"))).alias("units_per_floor_typical"))
    brands = records.project(items, schemas.TABLES["handover_item"]).groupBy("building_id").agg(derive.distinct_list("brand").alias("handover_brands"))
    top = derive.top_rows(amenities, ["building_id"], ["ord"], 8).groupBy("building_id").agg(derive.highlights("ord", "amenity_name").alias("amenity_highlights"))
    count = amenities.groupBy("building_id").agg(F.count("*").alias("amenity_count"))
    own = found["building"].join(identity.withColumnsRenamed({c: f"_{c}" for c in ("building_name_local", "project_name", "developer") if c in identity.columns}).hint("merge"), "building_id", "left")
    # what a record says itself comes first
    said = lambda c: F.nullif(F.col(c), F.lit("")) if c in found["building"].columns else F.lit(None).cast("string")
    own = own.withColumns({c: F.coalesce(said(c), F.col(f"_{c}")) for c in ("building_name_local", "project_name", "developer")})
    buildings = reduce(lambda a, b: a.join(b.hint("merge"), "building_id", "left"), [area, classes, mode, mix, typical, brands, top, count], own)
    tables = {"building": buildings, "unit_type": types, "unit_room": rooms, "floor_plate": plates, "handover_item": items, "amenity": amenities, "price_obs": prices}
    return {name: records.project(rows, schemas.TABLES[name]) for name, rows in tables.items()}


#: What each labelled cell of a building gives evidence for.
EVIDENCE_OF = {
    "address": ["address", "district"], "num_units_total": ["num_units_total"], "structure": ["num_floors_above", "num_basements"], "land_area_m2": ["land_area_m2"], "gfa_m2": ["gfa_m2"],
    "handover": ["year_handover"], "completion": ["status"], "launch": ["year_launch"], "developer": ["developer"], "architect": ["architect_firm"], "kind": ["building_type"], "parking": ["parking_ratio"],
}


def evidence(pages: DataFrame, tables: dict[str, DataFrame], cells: DataFrame | None = None) -> DataFrame:
    """Evidence rows of buildings (the cells that won), equipment and amenities (the sentences found), for filled fields only.

    ``cells`` are those that the tables were extracted from, where they are at hand.
    """
    cells = good_cells(stage(page_cells(pages), "evidence-cells") if cells is None else cells)
    matches = C.label_matches(cells, LABELS)
    best = C.best_cell(matches.where(_valid(F.col("field"), F.col("value"))), "building_id", ORDER)
    fields = F.create_map(*[x for k, v in EVIDENCE_OF.items() for x in (F.lit(k), F.array(*[F.lit(f) for f in v]))])
    shared = lambda table, key: [F.lit(table).alias("table"), F.col(key).alias("record_key")]
    cell = best.select(*shared("building", "building_id"), "building_id", F.explode(F.try_element_at(fields, F.col("field"))).alias("field"), F.col("url").alias("source_url"), F.col("name").alias("source_file"), squash(F.concat_ws(": ", "label", "value")).alias("snippet"), "confidence", "kv_idx")
    about = pages.select("building_id", F.col("url").alias("source_url"), F.col("name").alias("source_file"), F.lit("high").alias("confidence"), C.trust(F.col("purpose")).alias("trust"), "page_idx").where("trust = 0")
    first = about.withColumn("_n", F.row_number().over(Window.partitionBy("building_id").orderBy("page_idx"))).where("_n = 1").drop("_n", "trust", "page_idx")
    found = [cell]
    for table, key, said in (("handover_item", "handover_id", "item_spec"), ("amenity", "amenity_id", "amenity_name")):
        columns = [c.split()[0] for c in schemas.TABLES[table].split(", ") if not c.split()[0].endswith("_id")]
        filled = records.filled_fields(tables[table].select("building_id", key, *columns), key, columns).join(tables[table].select(key, "building_id", F.col(said).alias("snippet")), key)
        found.append(filled.join(first, "building_id").select(*shared(table, key), "building_id", "field", "source_url", "source_file", squash("snippet").alias("snippet"), "confidence", F.lit(0).alias("kv_idx")))
    rows = reduce(lambda a, b: a.unionByName(b), found).withColumn("ord", F.col("kv_idx"))
    values = records.filled_fields(tables["building"], "building_id", sorted({f for v in EVIDENCE_OF.values() for f in v})).select(F.lit("building").alias("table"), F.col("building_id").alias("record_key"), "field", "value")
    for table, key in (("handover_item", "handover_id"), ("amenity", "amenity_id")):
        columns = [c.split()[0] for c in schemas.TABLES[table].split(", ") if not c.split()[0].endswith("_id")]
        values = values.unionByName(records.filled_fields(tables[table].select(key, *columns), key, columns).select(F.lit(table).alias("table"), F.col(key).alias("record_key"), "field", "value"))
    one = records.one_provenance(rows, ["table", "record_key"], values)
    return one.join(values, ["table", "record_key", "field"])


def rewritten(rows: DataFrame, dictionary: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(rows with their texts rewritten, terms still in source script with counts); verbatim fields are left alone."""
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string" and not f.name.endswith("_id") and f.name not in schemas.VERBATIM and not f.name.endswith(schemas.VERBATIM_ENDINGS)]
    done = rows.withColumns({c: F.when(F.col(c).isNotNull(), domain.rewrite_phrase(F.col(c), dictionary)) for c in texts})
    left = F.flatten(F.array(*[F.coalesce(domain.residual_terms(F.col(c), F.col(c)), F.array().cast("array<string>")) for c in texts]))
    return done, done.select(F.explode(left).alias("term")).groupBy("term").agg(F.count("*").alias("count"))


def benchmark(tables: dict[str, DataFrame], manifest: DataFrame, as_of: str) -> DataFrame:
    """Buildings with counts of their children, price indices and growth."""
    prices = tables["price_obs"].withColumn("year", F.left("period", F.lit(4)).try_cast("int"))
    rooms = tables["unit_room"].join(tables["unit_type"].select("unit_type_id", "building_id"), "unit_type_id")
    children = {"num_unit_types": tables["unit_type"], "num_rooms_captured": rooms, "num_handover_items": tables["handover_item"], "num_amenities": tables["amenity"], "num_price_obs": tables["price_obs"]}
    rows = derive.child_counts(tables["building"], "building_id", children)
    growth = derive.growth_yoy(prices.where("market = 'so_cap' AND price_usd_per_m2 <> 0"), "building_id", "year", "price_usd_per_m2").select("building_id", F.col("growth_pct").alias("price_growth_pct_yoy"))
    index = derive.price_index(prices, "building_id").withColumnsRenamed({"usd_primary": "price_usd_per_m2_primary", "usd_secondary": "price_usd_per_m2_secondary", "premium_pct": "secondary_premium_pct"})
    ok = manifest.select("building_id", F.col("ok").alias("sources_ok"))
    return reduce(lambda a, b: a.join(b, "building_id", "left"), [index, growth, ok], rows).withColumn("extracted_at", F.lit(as_of))
