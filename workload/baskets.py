"""Cleaning and basket queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import baskets, clean, sequences
from weft.plans import report

from . import data, sql
from .registry import query

# every tenth brand line loses its item and every fifteenth its order key, to exercise the null rules
_DIRTY = """SELECT CASE WHEN l_linenumber = 7 AND l_partkey % 15 = 0 THEN NULL ELSE l_orderkey END AS k,
    CASE WHEN l_partkey % 10 = 3 THEN NULL ELSE '  ' || p_brand || ' ' END AS item
    FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _dirty(spark, sf):
    return data.order_lines(spark, sf).select(
        F.expr("CASE WHEN l_linenumber = 7 AND l_partkey % 15 = 0 THEN NULL ELSE cast(l_orderkey AS string) END").alias("k"),
        F.expr("CASE WHEN l_partkey % 10 = 3 THEN NULL ELSE '  ' || p_brand || ' ' END").alias("item"),
    )


@query("clean_rows", f"SELECT k, trim(item) AS item FROM ({_DIRTY}) WHERE k IS NOT NULL AND item IS NOT NULL")
def clean_rows(spark, sf):
    return clean.clean_rows(_dirty(spark, sf), "k", "item", integer_key=True)


@query(
    "parse_dates",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate END AS ordered FROM orders",
)
def parse_dates(spark, sf):
    text = data.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.date_format("o_orderdate", "dd.MM.yyyy HH:mm")).alias("ordered"),
    )
    return clean.parse_dates(text, ["ordered"], "dd.MM.yyyy HH:mm").withColumn("ordered", F.col("ordered").cast("timestamp_ntz"))


@query(
    "null_profile",
    f"""WITH d AS ({_DIRTY}), n AS (SELECT count(*) AS n, count(k) AS k, count(item) AS i FROM d)
    SELECT 'k' AS column_name, n AS n_rows, n - k AS n_null, round((n - k) / n, 6) AS null_share FROM n
    UNION ALL SELECT 'item', n, n - i, round((n - i) / n, 6) FROM n""",
)
def null_profile(spark, sf):
    return clean.null_profile(_dirty(spark, sf), ["k", "item"])


_GROUPED = "SELECT tid, string_agg(item, '|' ORDER BY item) AS items FROM ({}) GROUP BY tid"


@query("baskets_grouped", _GROUPED.format(sql.PAIRS["brand"]))
def baskets_grouped(spark, sf):
    return data.brand_baskets(spark, sf)


@query(
    "baskets_null_literal",
    _GROUPED.format(f"SELECT DISTINCT k AS tid, coalesce(item, 'nan') AS item FROM ({_DIRTY}) WHERE k IS NOT NULL"),
)
def baskets_null_literal(spark, sf):
    dirty = _dirty(spark, sf).withColumn("k", F.col("k").cast("bigint"))
    return baskets.grouped(dirty, "k", "item", null_items="literal")


@query(
    "baskets_clean",
    _GROUPED.format(f"SELECT DISTINCT k AS tid, trim(item) AS item FROM ({_DIRTY}) WHERE k IS NOT NULL AND item IS NOT NULL"),
)
def baskets_clean(spark, sf):
    dirty = _dirty(spark, sf).withColumn("k", F.col("k").cast("bigint"))
    return baskets.grouped_clean(dirty, "k", "item")



@query(
    "baskets_delimited",
    """WITH lines AS (SELECT p_partkey, ' ' || p_brand || ' | ' || p_type || '|| ' || p_name || '|' || p_brand AS line FROM part),
    parts AS (SELECT DISTINCT p_partkey, trim(unnest(string_split(line, '|'))) AS item FROM lines)
    SELECT p_partkey AS tid, string_agg(item, '|' ORDER BY item) AS items FROM parts WHERE item <> '' GROUP BY p_partkey""",
)
def baskets_delimited(spark, sf):
    lines = data.table(spark, sf, "part").select(
        "p_partkey", F.expr("' ' || p_brand || ' | ' || p_type || '|| ' || p_name || '|' || p_brand").alias("line")
    )
    return baskets.from_rows(lines, "p_partkey", item_string_col="line", delimiter="|")


_WIDE = """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE ' ' || p_brand END AS a,
    CASE WHEN p_size % 3 = 0 THEN '  ' ELSE p_type END AS b, p_name AS c, p_type || ' ' AS d FROM part"""


@query(
    "baskets_wide",
    f"""WITH w AS ({_WIDE}), i AS (SELECT DISTINCT p_partkey, trim(unnest([a, b, c, d])) AS item FROM w)
    SELECT p_partkey AS tid, string_agg(item, '|' ORDER BY item) AS items FROM i
    WHERE item IS NOT NULL AND item <> '' GROUP BY p_partkey""",
)
def baskets_wide(spark, sf):
    rows = data.table(spark, sf, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE ' ' || p_brand END AS a",
        "CASE WHEN p_size % 3 = 0 THEN '  ' ELSE p_type END AS b",
        "p_name AS c",
        "p_type || ' ' AS d",
    )
    return baskets.from_rows(rows, "p_partkey", item_columns=["a", "b", "c", "d", "absent"])


@query(
    "baskets_custom",
    "SELECT o_custkey AS tid, string_agg(item, '|' ORDER BY item) AS items FROM "
    "(SELECT DISTINCT o_custkey, o_orderstatus AS item FROM orders WHERE o_totalprice > 100000) GROUP BY o_custkey",
)
def baskets_custom(spark, sf):
    def build(df):
        large = df.where("o_totalprice > 100000")
        return baskets.grouped(large, "o_custkey", "o_orderstatus")

    return baskets.custom(data.table(spark, sf, "orders"), build)


# the closed vocabulary of part types, fixed values
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "one_hot",
    "SELECT tid, " + ", ".join(f"bool_or(item = '{t}') AS \"{t}\"" for t in TYPES) + f" FROM ({sql.PAIRS['type']}) GROUP BY tid",
)
def one_hot(spark, sf):
    return baskets.one_hot(data.type_baskets(spark, sf), TYPES)


@query(
    "one_hot_sparse",
    f"""WITH p AS ({sql.PAIRS['brand']}), v AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS place FROM (SELECT DISTINCT item FROM p))
    SELECT tid, place AS item_index FROM (SELECT DISTINCT tid, item FROM p) JOIN v USING (item)""",
)
def one_hot_sparse(spark, sf):
    named = data.brand_baskets(spark, sf)
    rows = baskets.one_hot_sparse(named, sequences.item_dictionary(baskets.explode_items(named)))
    return rows.select("tid", F.explode("indices").alias("item_index"))


@query(
    "vertical_tidlists",
    f"""SELECT item, tid // 4096 AS chunk, string_agg(CAST(tid AS VARCHAR), '|' ORDER BY tid) AS tids
    FROM ({sql.PAIRS['brand']}) GROUP BY item, tid // 4096""",
)
def vertical_tidlists(spark, sf):
    lists = baskets.vertical(data.brand_baskets(spark, sf), F.expr("tid div 4096"))
    return lists.select("item", "chunk", F.array_join(F.col("tids").cast("array<string>"), "|").alias("tids"))


@query(
    "basket_stats",
    f"""WITH p AS ({sql.PAIRS['brand']}), b AS (SELECT tid, count(*) AS c FROM p GROUP BY tid)
    SELECT count(*) AS n_baskets, round(avg(c), 6) AS avg_items, max(c) AS max_items, min(c) AS min_items,
    (SELECT count(DISTINCT item) FROM p) AS n_items, max(c) = 1 AS single_item_only FROM b""",
)
def basket_stats(spark, sf):
    return baskets.basket_stats(data.brand_baskets(spark, sf))


_SUPPORT = f"""WITH p AS ({sql.PAIRS['brand']})
    SELECT item, count(*) AS support_count, round(count(*) / (SELECT count(DISTINCT tid) FROM p), 6) AS support
    FROM p GROUP BY item"""


@query("item_support", _SUPPORT)
def item_support(spark, sf):
    return baskets.item_support(data.brand_baskets(spark, sf))


@query("top_items", _SUPPORT + " ORDER BY support_count DESC, item LIMIT 20")
def top_items(spark, sf):
    return report.top_items(baskets.item_support(data.brand_baskets(spark, sf)), 20)
