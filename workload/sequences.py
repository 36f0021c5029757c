"""Sequence builder and containment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import contains_pattern
from weft.operators import patterns, sequences
from weft.plans import report

from . import data, sql
from .registry import query


def _numbered(source: str, rank: str = "dense_rank()") -> str:
    """One row per element: position by time, items as text."""
    return f"""SELECT sid AS sequence_id, CAST(p AS BIGINT) AS position, string_agg(item, '|' ORDER BY item) AS items
    FROM (SELECT sid, item, {rank} OVER (PARTITION BY sid ORDER BY pos) AS p FROM ({sql.ELEMENTS[source]})) GROUP BY sid, p"""


@query("sequences_temporal", _numbered("priority"))
def sequences_temporal(spark, sf):
    return data.priority_sequences(spark, sf)


@query(
    "sequences_nested",
    f"""SELECT sequence_id, string_agg(items, '>' ORDER BY position) AS elements FROM ({_numbered('priority')}) GROUP BY sequence_id""",
)
def sequences_nested(spark, sf):
    return sequences.assemble(data.priority_sequences(spark, sf))


@query("sequences_event", _numbered("event"))
def sequences_event(spark, sf):
    return data.event_sequences(spark, sf)


def _sessions(gap: int) -> str:
    return f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
      > INTERVAL {gap} MINUTE THEN 1 ELSE 0 END AS opens FROM events),
    s AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM g)
    SELECT user_id || '_' || session AS sequence_id, user_id, session,
      row_number() OVER (PARTITION BY user_id, session ORDER BY ts, event_id) AS position, event_type AS items FROM s"""


@query("sequences_session", _sessions(30))
def sequences_session(spark, sf):
    return data.event_sessions(spark, sf, 30)


@query("sequences_session_wide", _sessions(720))
def sequences_session_wide(spark, sf):
    return data.event_sessions(spark, sf, 720)


@query("sequences_by_txn", _numbered("purchase"))
def sequences_by_txn(spark, sf):
    return data.purchase_sequences(spark, sf)


@query(
    "sequences_custom",
    "SELECT o_custkey AS sequence_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS position, "
    "o_orderstatus AS items FROM orders WHERE o_orderstatus <> 'P'",
)
def sequences_custom(spark, sf):
    def build(df):
        return sequences.events(df.where("o_orderstatus <> 'P'"), "o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")

    return sequences.custom(data.table(spark, sf, "orders"), build)


@query(
    "item_dictionary",
    "SELECT p_name AS item, row_number() OVER (ORDER BY p_name) AS item_id FROM (SELECT DISTINCT p_name FROM part)",
)
def item_dictionary(spark, sf):
    return sequences.item_dictionary(data.table(spark, sf, "part").select(F.col("p_name").alias("item")))


@query("sequences_roundtrip", _numbered("purchase"))
def sequences_roundtrip(spark, sf):
    elements = data.purchase_sequences(spark, sf)
    dictionary = sequences.item_dictionary(sequences.explode_items(elements))
    return sequences.decode(sequences.encode(elements, dictionary), dictionary)


@query(
    "sequence_shape",
    f"""WITH e AS ({_numbered('purchase')}), i AS ({sql.ELEMENTS['purchase']})
    SELECT e.sequence_id, count(*) AS n_elements, CAST(sum(len(string_split(items, '|'))) AS BIGINT) AS n_items,
      any_value(d.c) AS n_distinct
    FROM e JOIN (SELECT sid, count(DISTINCT item) AS c FROM i GROUP BY sid) d ON d.sid = e.sequence_id GROUP BY e.sequence_id""",
)
def sequence_shape(spark, sf):
    return sequences.shape(data.purchase_sequences(spark, sf))


@query(
    "sequence_flatten",
    f"""SELECT sid AS sequence_id, p AS position, row_number() OVER (PARTITION BY sid, p ORDER BY item) - 1 AS slot, item
    FROM (SELECT sid, item, dense_rank() OVER (PARTITION BY sid ORDER BY pos) AS p FROM ({sql.ELEMENTS['purchase']}))""",
)
def sequence_flatten(spark, sf):
    return sequences.flatten(data.purchase_sequences(spark, sf))


_PER_SEQUENCE = f"SELECT sid, count(DISTINCT pos) AS l, count(*) AS i FROM ({sql.ELEMENTS['purchase']}) GROUP BY sid"


@query(
    "sequence_stats",
    f"""SELECT count(*) AS n_sequences, round(avg(l), 6) AS avg_events, min(l) AS min_events, max(l) AS max_events,
    round(sum(i) / sum(l), 6) AS avg_items_per_event, CAST(sum(l) AS BIGINT) AS total_events, CAST(sum(i) AS BIGINT) AS total_items
    FROM ({_PER_SEQUENCE})""",
)
def sequence_stats(spark, sf):
    return sequences.sequence_stats(data.purchase_sequences(spark, sf))


def _buckets(edges) -> str:
    rows = []
    for label, low, high in edges:
        rows.append(f"SELECT '{label}' AS bucket, {low} AS lo, {high} AS hi")
    return f"""WITH s AS ({_PER_SEQUENCE}), b AS ({' UNION ALL '.join(rows)})
    SELECT bucket, count(l) AS n, round(100.0 * count(l) / (SELECT count(*) FROM s), 6) AS percent
    FROM b LEFT JOIN s ON l BETWEEN lo AND hi GROUP BY bucket"""


@query("sequence_length_histogram", _buckets([("1", 1, 1), ("2-5", 2, 5), ("6-10", 6, 10), (">10", 11, 10**9)]))
def sequence_length_histogram(spark, sf):
    return sequences.length_histogram(data.purchase_sequences(spark, sf), "statistics")


@query(
    "sequence_length_buckets",
    _buckets([("1", 1, 1), ("2-5", 2, 5), ("6-10", 6, 10), ("11-20", 11, 20), (">20", 21, 10**9)]),
)
def sequence_length_buckets(spark, sf):
    return sequences.length_histogram(data.purchase_sequences(spark, sf), "performance")


_ITEM_SUPPORT = f"""WITH e AS ({sql.ELEMENTS['priority']})
    SELECT item, count(DISTINCT sid) AS support_count, round(count(DISTINCT sid) / (SELECT count(DISTINCT sid) FROM e), 6) AS support
    FROM e GROUP BY item"""


@query("sequence_item_support", _ITEM_SUPPORT)
def sequence_item_support(spark, sf):
    return sequences.item_support(data.priority_sequences(spark, sf))


@query("sequence_top_items", _ITEM_SUPPORT + " ORDER BY support_count DESC, item LIMIT 3")
def sequence_top_items(spark, sf):
    return report.top_items(sequences.item_support(data.priority_sequences(spark, sf)), 3)


# patterns put to the containment test
_URGENT_LOW = [["1-URGENT"], ["5-LOW"]]
_GIVEN = {
    "1-URGENT>5-LOW": _URGENT_LOW,
    "5-LOW>1-URGENT>5-LOW": [["5-LOW"], ["1-URGENT"], ["5-LOW"]],
    "2-HIGH>2-HIGH": [["2-HIGH"], ["2-HIGH"]],
    "1-URGENT|2-HIGH": [["1-URGENT", "2-HIGH"]],
    "3-MEDIUM": [["3-MEDIUM"]],
    "3-MEDIUM>UNKNOWN": [["3-MEDIUM"], ["UNKNOWN"]],
}


def _literal(pattern):
    return F.array(*[F.array(*[F.lit(i) for i in e]) for e in pattern])


@query(
    "sequence_contains",
    f"""WITH e AS ({sql.ELEMENTS['priority']}),
    u AS (SELECT sid, min(pos) AS lo FROM e WHERE item = '1-URGENT' GROUP BY sid)
    SELECT e.sid AS sequence_id, coalesce(bool_or(e.item = '5-LOW' AND e.pos > u.lo), false) AS contained
    FROM e LEFT JOIN u ON u.sid = e.sid GROUP BY e.sid""",
)
def sequence_contains(spark, sf):
    nested = sequences.assemble(data.priority_sequences(spark, sf))
    return nested.select("sequence_id", contains_pattern(F.col("elements"), _literal(_URGENT_LOW)).alias("contained"))


def _given(elements):
    """The fixed patterns as a table, next to every single item that occurs in the data."""
    fixed = elements.sparkSession.createDataFrame(
        list(_GIVEN.items()), "pattern string, elements array<array<string>>"
    )
    singles = sequences.explode_items(elements).select("item").distinct()
    observed = singles.select(F.col("item").alias("pattern"), F.array(F.array("item")).alias("elements"))
    return fixed.unionByName(observed).dropDuplicates(["pattern"])


@query(
    "count_patterns",
    f"""WITH e AS ({sql.ELEMENTS['priority']}),
    u AS (SELECT sid, min(pos) AS lo FROM e WHERE item = '1-URGENT' GROUP BY sid),
    l AS (SELECT sid, min(pos) AS lo FROM e WHERE item = '5-LOW' GROUP BY sid),
    lu AS (SELECT e.sid, min(pos) AS lo FROM e JOIN l ON l.sid = e.sid WHERE item = '1-URGENT' AND pos > lo GROUP BY e.sid)
    SELECT item AS pattern, item AS elements, count(DISTINCT sid) AS support_count FROM e GROUP BY item
    UNION ALL SELECT '1-URGENT>5-LOW', '1-URGENT>5-LOW', count(DISTINCT e.sid) FROM e JOIN u ON u.sid = e.sid WHERE item = '5-LOW' AND pos > lo
    UNION ALL SELECT '5-LOW>1-URGENT>5-LOW', '5-LOW>1-URGENT>5-LOW', count(DISTINCT e.sid) FROM e JOIN lu ON lu.sid = e.sid WHERE item = '5-LOW' AND pos > lo
    UNION ALL SELECT '2-HIGH>2-HIGH', '2-HIGH>2-HIGH', count(*) FROM (SELECT sid FROM e WHERE item = '2-HIGH' GROUP BY sid HAVING count(DISTINCT pos) > 1)
    UNION ALL SELECT '1-URGENT|2-HIGH', '1-URGENT|2-HIGH', count(DISTINCT a.sid) FROM e a JOIN e b ON a.sid = b.sid AND a.pos = b.pos WHERE a.item = '1-URGENT' AND b.item = '2-HIGH'
    UNION ALL SELECT '3-MEDIUM>UNKNOWN', '3-MEDIUM>UNKNOWN', 0""",
)
def count_patterns(spark, sf):
    elements = data.priority_sequences(spark, sf)
    return patterns.count_patterns(elements, _given(elements))
