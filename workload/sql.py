"""SQL fragments shared by the oracles: plain self-joins, independent of the miners."""

from __future__ import annotations

PAIRS = {
    "brand": "SELECT DISTINCT l_orderkey AS tid, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey",
    "type": "SELECT DISTINCT l_orderkey AS tid, p_type AS item FROM lineitem JOIN part ON l_partkey = p_partkey",
}

# sid, pos (any order value), item
ELEMENTS = {
    "priority": "SELECT DISTINCT o_custkey AS sid, o_orderdate AS pos, o_orderpriority AS item FROM orders",
    "event": "SELECT user_id AS sid, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, "
    "event_type AS item FROM events",
    "session720": """SELECT user_id || '_' || session AS sid, row_number() OVER (PARTITION BY user_id, session ORDER BY ts, event_id) AS pos, event_type AS item
      FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
            FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 720 MINUTE THEN 1 ELSE 0 END AS opens FROM events))""",
    "purchase": "SELECT DISTINCT o_custkey AS sid, (o_orderdate, o_orderkey) AS pos, p_type AS item FROM lineitem "
    "JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey",
}


def itemsets(source: str, support: float, longest: int, prefix: str = "", query: str | None = None) -> str:
    """CTEs up to ``{prefix}itemsets(items, size, support_count, support)``; level k grows from the sets of level k - 1."""
    p = prefix
    ctes = [
        f"{p}pairs AS MATERIALIZED ({query or PAIRS[source]})",
        f"{p}n AS MATERIALIZED (SELECT count(DISTINCT tid) AS n FROM {p}pairs)",
        f"{p}th AS MATERIALIZED (SELECT greatest(1, ceil({support} * n - 1e-9)) AS c FROM {p}n)",
        f"{p}f AS MATERIALIZED (SELECT * FROM {p}pairs WHERE item IN (SELECT item FROM {p}pairs GROUP BY item "
        f"HAVING count(*) >= (SELECT c FROM {p}th)))",
        f"{p}o1 AS (SELECT tid, [item] AS items, item AS last_item FROM {p}f)",
    ]
    levels = []
    for k in range(1, longest + 1):
        if k > 1:
            ctes.append(
                f"{p}o{k} AS MATERIALIZED (SELECT o.tid, list_append(o.items, t.item) AS items, t.item AS last_item FROM {p}o{k - 1} o "
                f"JOIN {p}s{k - 1} s ON s.items = o.items JOIN {p}f t ON t.tid = o.tid AND t.item > o.last_item)"
            )
        ctes.append(
            f"{p}s{k} AS MATERIALIZED (SELECT items, {k} AS size, count(*) AS support_count FROM {p}o{k} GROUP BY items "
            f"HAVING count(*) >= (SELECT c FROM {p}th))"
        )
        levels.append(f"SELECT * FROM {p}s{k}")
    body = " UNION ALL ".join(levels)
    ctes.append(
        f"{p}itemsets AS MATERIALIZED (SELECT items, CAST(size AS BIGINT) AS size, support_count, "
        f"support_count / (SELECT n FROM {p}n) AS support FROM ({body}))"
    )
    return ", ".join(ctes)


def rules(condition: str, prefix: str = "") -> str:
    """CTE ``{prefix}rules`` over ``{prefix}itemsets``; every split by bit mask."""
    p = prefix
    return f"""{p}splits AS MATERIALIZED (
      SELECT list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS antecedent,
             list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 0) AS consequent,
             support_count, support
      FROM (SELECT *, unnest(generate_series(1, (1 << size) - 2)) AS m FROM {p}itemsets WHERE size >= 2)),
    {p}rules AS MATERIALIZED (
      SELECT * FROM (
        SELECT s.antecedent, s.consequent, s.support_count, s.support,
               s.support_count / a.support_count AS confidence,
               (s.support_count / a.support_count) / c.support AS lift,
               CASE WHEN s.support_count = a.support_count THEN NULL
                    ELSE (1 - c.support) / (1 - s.support_count / a.support_count) END AS conviction,
               s.support_count = a.support_count AS certain,
               s.support - a.support * c.support AS leverage
        FROM {p}splits s JOIN {p}itemsets a ON a.items = s.antecedent JOIN {p}itemsets c ON c.items = s.consequent)
      WHERE {condition})"""


def text(column: str) -> str:
    return f"array_to_string({column}, '|')"


RULE_COLUMNS = (
    f"{text('antecedent')} AS antecedent, {text('consequent')} AS consequent, support_count, "
    "round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift"
)
ITEMSET_COLUMNS = f"{text('items')} AS items, size, support_count, round(support, 6) AS support"


def patterns(source: str, support: float, longest: int = 3) -> str:
    """CTEs up to ``patterns(key, n_elements, n_items, support_count, support)`` for up to ``longest`` items.

    ``e`` holds where each itemset of an element occurs, ``c`` the earliest end of each chain of such itemsets.
    """
    sets, chains = [], []
    for m in range(2, longest + 1):
        sets.append(
            f"i{m} AS MATERIALIZED (SELECT a.sid, a.pos, a.k || '|' || b.item AS k, b.item AS last_item, {m} AS m FROM i{m - 1} a JOIN o1 b "
            f"ON a.sid = b.sid AND a.pos = b.pos AND a.last_item < b.item)"
        )
    for j in range(2, longest + 1):
        chains.append(
            f"c{j} AS MATERIALIZED (SELECT c.sid, c.key || '>' || e.k AS key, {j} AS n_elements, c.n_items + e.m AS n_items, min(e.pos) AS lo "
            f"FROM c{j - 1} c JOIN e ON c.sid = e.sid AND e.pos > c.lo AND c.n_items + e.m <= {longest} GROUP BY ALL)"
        )
    every = " UNION ALL ".join(f"SELECT sid, pos, k, m FROM i{m}" for m in range(1, longest + 1))
    held = " UNION ALL ".join(f"SELECT sid, key, n_elements, n_items FROM c{j}" for j in range(1, longest + 1))
    return f"""elems AS MATERIALIZED ({ELEMENTS[source]}),
    n AS MATERIALIZED (SELECT count(DISTINCT sid) AS n FROM elems),
    th AS MATERIALIZED (SELECT greatest(1, ceil({support} * n - 1e-9)) AS c FROM n),
    o1 AS MATERIALIZED (SELECT sid, pos, item FROM elems WHERE item IN (
      SELECT item FROM elems GROUP BY item HAVING count(DISTINCT sid) >= (SELECT c FROM th))),
    i1 AS MATERIALIZED (SELECT sid, pos, item AS k, item AS last_item, 1 AS m FROM o1),
    {", ".join(sets)},
    e AS MATERIALIZED (SELECT DISTINCT * FROM ({every})),
    c1 AS MATERIALIZED (SELECT sid, k AS key, 1 AS n_elements, m AS n_items, min(pos) AS lo FROM e GROUP BY ALL),
    {", ".join(chains)},
    held AS MATERIALIZED ({held}),
    patterns AS MATERIALIZED (
      SELECT key, CAST(n_elements AS BIGINT) AS n_elements, CAST(n_items AS BIGINT) AS n_items,
             count(*) AS support_count, count(*) / (SELECT n FROM n) AS support
      FROM held GROUP BY key, n_elements, n_items HAVING count(*) >= (SELECT c FROM th))"""


PATTERN_COLUMNS = "key AS elements, n_elements, n_items, support_count, round(support, 6) AS support"


def sequence_rules(min_confidence: float) -> str:
    """CTE ``srules`` over ``patterns``."""
    return f"""cuts AS (
      SELECT support_count, support, string_split(key, '>') AS els, unnest(generate_series(1, n_elements - 1)) AS cut
      FROM patterns WHERE n_elements >= 2),
    sides AS (
      SELECT array_to_string(list_slice(els, 1, cut), '>') AS antecedent, array_to_string(list_slice(els, cut + 1, len(els)), '>') AS consequent,
             support_count, support FROM cuts),
    srules AS (
      SELECT * FROM (
        SELECT s.*, s.support_count / a.support_count AS confidence,
               (s.support_count / a.support_count) / c.support AS lift
        FROM sides s JOIN patterns a ON a.key = s.antecedent LEFT JOIN patterns c ON c.key = s.consequent)
      WHERE confidence >= {min_confidence})"""
