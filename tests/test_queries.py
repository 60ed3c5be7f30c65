"""Every registered query of the library against its SQL, with 1 and with 8 shuffle partitions."""

import os

import duckdb
import pytest

from docgrain.plans import building_queries, file_queries, page_queries, parse_queries, record_queries, rollup_queries, rule_queries  # noqa: F401
from docgrain.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def value(x):
    if isinstance(x, float):
        return f"{x:.6g}" if x == x else None
    if isinstance(x, int) and not isinstance(x, bool):
        return f"{float(x):.6g}" if abs(x) < 1e5 else str(x)
    return str(x) if x is not None and type(x).__name__ == "Decimal" else x


def rows(got):
    return sorted((tuple(value(v) for v in r) for r in got), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = rows(df.select(*columns).collect())
    if name in SQL:
        quoted = ", ".join(f'"{c}"' for c in columns)
        assert got == rows(duck.sql(f"SELECT {quoted} FROM ({SQL[name]})").fetchall())
    else:
        assert got


@pytest.mark.parametrize("name", ["q_url_canonical", "q_coalesce_merge", "q_weighted_mode", "q_slug_key", "q_yoy_growth"])
def test_partitions_do_not_matter(spark, name):
    out = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = QUERIES[name](spark, SF)
        out.append(rows(df.select(*sorted(df.columns)).collect()))
    assert out[0] == out[1]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_name_lists_in_many_files(spark, duck):
    """No table loses its header to another file, wherever the files begin."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in ("7", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = [(r.name,) for r in QUERIES["q_name_lists"](spark, SF).collect()]
            assert rows(got) == rows(duck.sql(SQL["q_name_lists"]).fetchall())
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_price_means_hang_on_no_order(spark):
    """A mean that lies just between two tenths is rounded up, though its sum in doubles ends below; a premium alike."""
    from docgrain.operators import derive

    usd = [("a", "so_cap", x) for x in (4.25, 6.81, 1.78, 3.76)] + [("a", "thu_cap", 4.15), ("b", "so_cap", 200.0), ("b", "thu_cap", 199.9), ("c", "thu_cap", float("nan")), ("c", "so_cap", 0.0)]
    data = spark.createDataFrame(usd, "k string, market string, price_usd_per_m2 double").selectExpr("*", "'net' AS price_basis", "CAST(NULL AS boolean) AS includes_vat")
    got = {r.k: tuple(r)[1:] for r in derive.price_index(data, "k").collect()}
    assert got == {"a": (4.2, 4.2, 0.0), "b": (200.0, 199.9, -0.1), "c": (None, None, None)}
