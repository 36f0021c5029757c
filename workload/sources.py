"""Source and sink queries: tables written in the format under test, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import pattern_key
from weft.operators import itemsets, sequences
from weft.runtime import scratch_path
from weft.sources import csv, results, text

from . import data, mining, sql
from .registry import query


@query("csv_scan", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, round(p_retailprice, 6) AS p_retailprice FROM part")
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    part = data.table(spark, sf, "part")
    part.write.option("header", True).csv(path)
    return csv.scan_csv(spark, path, schema=part.schema)


@query("csv_scan_dates", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def csv_scan_dates(spark, sf):
    path = scratch_path(spark, "csv-dates")
    rows = data.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "dd.MM.yyyy HH:mm").alias(" o_orderdate ")
    )
    rows.write.option("header", True).csv(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderdate string"
    back = csv.scan_csv(spark, path, schema, parse_date_columns=["o_orderdate"], date_format="dd.MM.yyyy HH:mm")
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query(
    "csv_dialect",
    """SELECT CAST(l_orderkey AS VARCHAR) AS "BillNo", round(l_extendedprice, 6) AS "Price",
    CASE WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS "Flag" FROM lineitem WHERE l_linenumber <> 3""",
)
def csv_dialect(spark, sf):
    path = scratch_path(spark, "csv-dialect")
    # line number 2 comes out short, line number 3 one field too long
    lines = data.table(spark, sf, "lineitem").select(
        F.expr("l_orderkey || ';' || replace(cast(cast(l_extendedprice AS decimal(18,2)) AS string), '.', ',')"
               " || CASE l_linenumber WHEN 2 THEN '' WHEN 3 THEN ';' || l_returnflag || ';more' ELSE ';' || l_returnflag END")
    )
    lines.write.text(path)
    return csv.scan_csv_dialect(spark, path, [" BillNo", "Price ", "Flag"], decimal_columns=["Price"], header=False)


@query("sample_rows", "SELECT least(1000, count(*)) AS n, least(1000, count(*)) AS n_distinct, least(1000, count(*)) AS n_known FROM orders")
def sample_rows(spark, sf):
    """The rows of a sample cannot be named in SQL; how many there are, how many differ and how many are known can."""
    orders = data.table(spark, sf, "orders")
    sample = csv.sample_rows(orders, "o_orderkey", 1000)
    known = sample.join(orders.select("o_orderkey", F.lit(1).alias("known")), "o_orderkey", "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("n_distinct"), F.count("known").alias("n_known"))


@query("table_scan", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def table_scan(spark, sf):
    return csv.scan_table(spark, f"{sf}/customer.parquet").select("c_custkey", "c_name", "c_nationkey")


_RULES_BACK = f"WITH {sql.itemsets('type', mining.TYPE, 6)}, {sql.rules('confidence >= 0.4')} SELECT {sql.RULE_COLUMNS} FROM rules"


@query("json_sink", _RULES_BACK.replace(" FROM rules", ", round(conviction, 6) AS conviction, certain, round(leverage, 6) AS leverage FROM rules"))
def json_sink(spark, sf):
    path = scratch_path(spark, "json")
    results.write_json(mining.type_rules(spark, sf), path)
    schema = (
        "antecedent array<string>, consequent array<string>, support_count bigint, support double, confidence double, lift double, "
        "conviction string, leverage double"
    )
    back, certain = spark.read.schema(schema).json(path), F.col("conviction") == "inf"
    return back.withColumn("certain", certain).withColumn("conviction", F.when(~certain, F.col("conviction").cast("double")))


@query("csv_sink", f"WITH {sql.itemsets('brand', mining.BRAND, 4)} SELECT {sql.ITEMSET_COLUMNS} FROM itemsets")
def csv_sink(spark, sf):
    path = scratch_path(spark, "csv-sink")
    results.write_csv(itemsets.fpgrowth(data.brand_baskets(spark, sf), mining.BRAND), path)
    schema = "items string, size bigint, support_count bigint, support double"
    return csv.scan_csv(spark, path, schema)


_CODED = f"""e AS (SELECT sid, pos, item FROM ({sql.ELEMENTS['purchase']})),
    d AS (SELECT item, row_number() OVER (ORDER BY item) AS id FROM (SELECT DISTINCT item FROM e)),
    c AS (SELECT sid, pos, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY id) AS part FROM e JOIN d USING (item) GROUP BY sid, pos)"""


def _coded(spark, sf, elements=None):
    elements = data.purchase_sequences(spark, sf) if elements is None else elements
    dictionary = sequences.item_dictionary(sequences.explode_items(elements))
    return sequences.encode(elements, dictionary), dictionary


@query(
    "sequence_text_export",
    f"WITH {_CODED} SELECT string_agg(part, ' -1 ' ORDER BY pos) || ' -1 -2' AS value FROM c GROUP BY sid",
)
def sequence_text_export(spark, sf):
    path = scratch_path(spark, "sequences")
    text.write_sequence_text(_coded(spark, sf)[0], path)
    return spark.read.text(path)


@query(
    "pattern_text_import",
    f"""WITH {sql.patterns('purchase', mining.PURCHASE)} SELECT key AS elements, n_elements, support_count FROM patterns""",
)
def pattern_text_import(spark, sf):
    """Mined patterns written as pattern text, with a comment line among them, and read back through the dictionary."""
    path = scratch_path(spark, "patterns")
    elements = data.purchase_sequences(spark, sf)
    found, _ = mining.purchase_rules(spark, sf, elements=elements)
    dictionary = _coded(spark, sf, elements)[1]
    coded = (
        found.select(pattern_key("elements").alias("n"), "support_count", F.posexplode("elements").alias("at", "e"))
        .select("n", "support_count", "at", F.explode("e").alias("item"))
        .join(dictionary, "item")
        .groupBy("n", "support_count", "at")
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
        .select(F.struct("n", "support_count").alias("sequence_id"), F.col("at").alias("position"), "items")
    )
    lines = text.sequence_lines(coded).select(
        F.concat(F.regexp_replace("value", " -2$", ""), F.lit(" #SUP: "), F.col("sequence_id.support_count")).alias("value")
    )
    lines.unionByName(lines.limit(1).select(F.lit("% no support here").alias("value"))).write.text(path)
    return text.read_pattern_text(spark, path, dictionary)
