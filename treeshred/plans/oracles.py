"""Expected results of the registered queries as SQL over the same tables."""

from __future__ import annotations

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"
SRC = "'/captures/' || year(o_orderdate) || '.xml'"
NAME_DROP = r"[^\p{L}\p{Nd}.]|[\x{10000}-\x{10FFFF}]"
RUN = r"(?:[^\p{L}\p{Nd}]|[\x{10000}-\x{10FFFF}])+"
ASTRAL = r"[\x{10000}-\x{10FFFF}]"


def fold(sorted_list: str) -> str:
    """Texts joined in order, repeats of the text merged so far skipped."""
    return (f"list_reduce({sorted_list}, lambda acc, x: CASE WHEN lower(acc) = lower(x) THEN acc "
            f"ELSE acc || ' / ' || x END)")


def combined(prefix: str, suffix: str) -> str:
    p, s = f"string_split({prefix}, '.')", f"string_split({suffix}, '.')"
    k = (f"coalesce(list_max(list_filter(range(1, least(len({p}), len({s})) + 1), "
         f"lambda k: lower(array_to_string({p}[len({p}) - k + 1:], '.')) = lower(array_to_string({s}[:k], '.')))), 0)")
    return f"array_to_string(list_concat({p}[1:len({p}) - {k}], {s}), '.')"


def values_of(table: str, key: str, columns: dict[str, tuple[str, str, str]]) -> str:
    """name -> (kind, text, more) unpivoted with UNION ALL."""
    return " UNION ALL ".join(
        f"SELECT {key} AS key, '{n}' AS name, {kind} AS kind, {text} AS text FROM {table}"
        for n, (kind, text, _) in columns.items())


def uint_kind(v: str) -> str:
    return f"CASE WHEN {v} <= 65535 THEN 'Int32' WHEN {v} <= 4294967295 THEN 'Int64' ELSE 'BigInteger' END"


def int_kind(v: str) -> str:
    return f"CASE WHEN {v} BETWEEN -2147483648 AND 2147483647 THEN 'Int32' ELSE 'Int64' END"


ORDER_SQL = ("SELECT o_orderkey AS _number, o_orderkey AS order_key, o_orderstatus AS order_status, "
             "o_totalprice AS order_total, o_orderdate AS order_date, o_orderpriority AS order_priority FROM orders")

ITEM_LABEL = "CASE WHEN l_linenumber = 1 THEN 'first' WHEN l_linenumber <= 4 THEN 'middle' WHEN l_linenumber <= 7 THEN 'late' END"

# Dictionary lines made from part, see queries.part_lines.
SHORT = "lower(replace(p_brand, '#', '')) || '.' || p_size"
FIELD = "lower(p_type) || '.' || p_size"

PART_FIELDS = f"""
lines AS (SELECT p_partkey AS seq, {FIELD} AS short_name, p_name, p_brand,
  CASE p_brand WHEN 'Brand#1' THEN 'string' WHEN 'Brand#2' THEN NULL ELSE 'u32' END AS cls,
  CASE WHEN p_brand = 'Brand#3' THEN 'unknown protocol' WHEN p_brand = 'Brand#2' THEN 'unknown type' END AS early FROM part),
owner AS (SELECT short_name, arg_min(cls, seq) AS own FROM lines WHERE early IS NULL GROUP BY 1),
checked AS (SELECT l.*, coalesce(early, CASE WHEN cls <> own THEN 'type conflict' END) AS reason
  FROM lines l LEFT JOIN owner USING (short_name)),
fields AS (SELECT short_name, any_value(cls) AS cls, {fold("list(p_name ORDER BY seq)")} AS long_name,
  {fold("list(p_brand ORDER BY seq)")} AS description FROM checked WHERE reason IS NULL GROUP BY 1)"""

PART_LABELS = f"""{PART_FIELDS},
labs AS (SELECT p_partkey AS seq, CASE WHEN p_brand = 'Brand#4' THEN 'lost.field' ELSE {FIELD} END AS field,
  CASE p_brand WHEN 'Brand#1' THEN 'R' WHEN 'Brand#2' THEN 'T' ELSE 'V' END AS kind,
  CASE WHEN p_brand IN ('Brand#2', 'Brand#3') THEN NULL ELSE p_size::BIGINT END AS lo,
  CASE WHEN p_brand = 'Brand#1' THEN 99::BIGINT WHEN p_brand IN ('Brand#2', 'Brand#3') THEN NULL ELSE p_size::BIGINT END AS hi,
  p_name AS label, CASE WHEN p_brand = 'Brand#2' THEN p_type END AS false_label FROM part),
lchecked AS (SELECT l.*, CASE WHEN kind <> 'T' AND lo IS NULL THEN 'bad number'
  WHEN f.short_name IS NULL THEN 'unknown field' END AS reason FROM labs l LEFT JOIN fields f ON l.field = f.short_name)"""

PROTO_LINES = f"""
plines AS (SELECT p_partkey AS seq, {SHORT} AS short_name, p_type,
  CASE WHEN p_partkey % 10 = 0 THEN 'other' ELSE {SHORT} END AS filter_name FROM part),
pown AS (SELECT short_name, arg_min(filter_name, seq) AS own FROM plines GROUP BY 1),
pchecked AS (SELECT plines.*, own, lower(filter_name) <> lower(own) AS bad FROM plines JOIN pown USING (short_name))"""

LINES_SQL = """
clean AS (SELECT doc_id, source, regexp_replace(text, '["\\\\,]', ' ', 'g') AS body FROM documents),
ls AS (SELECT doc_id, source, unnest(list_filter(string_split(body, chr(10)), lambda x: x <> '')) AS text,
  generate_subscripts(list_filter(string_split(body, chr(10)), lambda x: x <> ''), 1) - 1 AS pos FROM clean),
cls AS (SELECT doc_id, source, pos, text, instr(text, '%') AS p, instr(text, ':') AS c,
  length(text) - length(replace(text, ':', '')) AS colons FROM ls),
outc AS (SELECT *, CASE WHEN p = 0 AND c = 0 THEN 'Constant'
  WHEN c > 1 AND (p = 0 OR p > c) AND colons = 1 THEN 'Prefix'
  WHEN c > 1 AND (p = 0 OR p > c) THEN 'Failed - Multiple colons'
  ELSE 'Failed - No colon before first percent' END AS outcome FROM cls),
ruled AS (SELECT *, CASE outcome WHEN 'Prefix' THEN split_part(text, ':', 1) WHEN 'Constant' THEN text END AS rule_text FROM outc)"""

NAMES = """CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'doc' || doc_id ELSE source END
  WHEN doc_id % 3 = 1 THEN 'own' || doc_id ELSE 'd' || doc_id END"""


def renamed(cases: dict[int, tuple[str, str, str, str]]) -> str:
    """Four event nodes per event; ``cases`` override name, show, showname and value per position."""
    show = {0: "event_type", 1: "'Props:  ' || props", 2: "event_type || ': ' || user_id", 3: "event_type"}
    parts = []
    for i, text in show.items():
        name, new, shown, value = cases.get(i, ("NULL", text, "NULL", "NULL"))
        if i == 3:
            name = "'named'"
        parts.append(f"SELECT event_id AS packet_no, {i}::BIGINT AS position, {name} AS name, {new} AS show, "
                     f"{shown} AS showname, {value} AS value FROM events")
    return " UNION ALL ".join(parts)


def constant_case(hits: dict[str, str]) -> tuple[str, str, str, str]:
    pick = lambda hit, miss: f"CASE WHEN event_type IN ({', '.join(repr(h) for h in hits)}) THEN {hit} ELSE {miss} END"
    name = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in hits.items()) + " END"
    return name, pick("''", "event_type"), pick("''", "NULL"), pick("''", "NULL")


def prefix_case(hits: dict[str, str]) -> tuple[str, str, str, str]:
    raw = "event_type || ': ' || user_id"
    pick = lambda miss: f"CASE WHEN event_type IN ({', '.join(repr(h) for h in hits)}) THEN user_id::VARCHAR ELSE {miss} END"
    name = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in hits.items()) + " END"
    return name, pick(raw), pick("NULL"), pick("NULL")


PAGE = r"^(https?)://([^/]+)/(\w+)/(\d+)"
PAGE_HIT = f"regexp_matches(url, '{PAGE}')"

ORDER_CELLS = """SELECT 'orders_' || o_orderstatus AS "table", 'o.key' AS "column",
  CASE WHEN k <= 65535 THEN 'Int32' WHEN k <= 4294967295 THEN 'Int64' ELSE 'BigInteger' END AS kind, k::VARCHAR AS text
  FROM (SELECT *, o_orderkey * CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 300007 END AS k FROM orders)
UNION ALL SELECT 'orders_' || o_orderstatus, 'o.total', 'Float', NULL FROM orders
UNION ALL SELECT 'orders_' || o_orderstatus, 'o.date', 'DateTime', NULL FROM orders
UNION ALL SELECT 'orders_' || o_orderstatus, 'o.mixed', CASE WHEN o_orderkey % 2 <> 0 THEN 'String16'
  WHEN o_custkey <= 65535 THEN 'Int32' ELSE 'Int64' END, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::VARCHAR ELSE o_orderpriority END FROM orders
UNION ALL SELECT 'orders_' || o_orderstatus, 'o.priority', 'String16', o_orderpriority FROM orders"""

WIDEN = """SELECT "table", "column", CASE WHEN count(DISTINCT kind) = 1 THEN any_value(kind)
  WHEN bool_and(kind IN ('Int32', 'Int64', 'BigInteger')) THEN
    CASE WHEN bool_or(kind = 'BigInteger') THEN 'BigInteger' ELSE 'Int64' END
  ELSE 'String16' END AS kind, bool_and(kind = 'String16') AS pure, max(length(text)) AS longest, count(*) AS filled
  FROM cells GROUP BY 1, 2"""

BUCKET = "CASE WHEN {0} <= 250 THEN 250 WHEN {0} <= 500 THEN 500 WHEN {0} <= 1000 THEN 1000 WHEN {0} <= 2000 THEN 2000 ELSE 4000 END"

ITEMS = f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS rank FROM lineitem)"

ORACLES: dict[str, str] = {
    "status_totals": """WITH n AS (SELECT l_orderkey, count(*) AS items FROM lineitem GROUP BY 1)
        SELECT o_orderstatus AS order_status, sum(floor(o_totalprice)::BIGINT)::BIGINT AS total_len,
          coalesce(sum(items), 0)::BIGINT AS items FROM orders LEFT JOIN n ON l_orderkey = o_orderkey GROUP BY 1""",
    "shred_order_table": ORDER_SQL,
    "shred_customer_table": f"""SELECT o_orderkey AS _number, {SRC} || '/' || o_orderkey || '/1' AS parent_order,
        o_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS customer_segment
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "shred_line_branch_rows": f"""SELECT o_orderkey AS _number, {SRC} || '/' || o_orderkey || '/3' AS parent_line,
        l_linenumber AS _value, l_quantity AS line_quantity, l_extendedprice AS line_price, l_quantity::INT AS line_size
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "node_attributes": """SELECT o_orderkey AS packet_no, '1' AS path, 'proto' AS type, 'order' AS name, NULL AS show, true AS is_branch,
          NULL AS parent_row_table FROM orders
        UNION ALL SELECT o_orderkey, '1.0', 'field', 'order.key', o_orderkey::VARCHAR, false, 'order' FROM orders
        UNION ALL SELECT o_orderkey, '1.1', 'field', 'order.status', o_orderstatus, false, 'order' FROM orders
        UNION ALL SELECT o_orderkey, '1.2', 'field', 'order.total', CASE WHEN o_totalprice = floor(o_totalprice)
          THEN (o_totalprice::BIGINT) || '.0' ELSE o_totalprice::VARCHAR END, false, 'order' FROM orders
        UNION ALL SELECT o_orderkey, '1.3', 'field', 'order.date', strftime(o_orderdate, '%b %-d, %Y %H:%M:%S.%f') || '000', false, 'order' FROM orders
        UNION ALL SELECT o_orderkey, '1.4', 'field', 'order.priority', o_orderpriority, false, 'order' FROM orders
        UNION ALL SELECT o_orderkey, '1.5', 'field', 'order.customer', NULL, true, 'order' FROM orders
        UNION ALL SELECT o_orderkey, '1.5.0', 'field', 'customer.key', o_custkey::VARCHAR, false, 'order.customer' FROM orders
        UNION ALL SELECT o_orderkey, '1.5.1', 'field', 'customer.name', c_name, false, 'order.customer' FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        UNION ALL SELECT o_orderkey, '1.5.2', 'field', 'customer.segment', c_mktsegment, false, 'order.customer' FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "protocol_chain_parent": """SELECT o_orderkey AS packet_no, 0::BIGINT AS layer, NULL AS parent_table FROM orders
        UNION ALL SELECT o_orderkey, 1, 'geninfo' FROM orders
        UNION ALL SELECT o_orderkey, 3, 'order' FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "conversation_chain": """SELECT conv_id, turn, parent_turn, parent_role FROM (
        SELECT conv_id, turn, text, lag(turn) OVER w AS parent_turn, lag(role) OVER w AS parent_role
        FROM conversations WHERE length(text) >= 100 WINDOW w AS (PARTITION BY conv_id ORDER BY turn))""",
    "multivalue_column": f"""SELECT l_orderkey AS _number, CASE WHEN count(*) = 1 THEN any_value(l_partkey)::VARCHAR
        ELSE '{{ ' || string_agg(l_partkey::VARCHAR, ', ' ORDER BY {LINE_ORDER}) || ' }}' END AS line_part
        FROM lineitem GROUP BY l_orderkey""",
    "nameless_values": f"""SELECT l_orderkey AS _number, {SRC} || '/' || o_orderkey || '/3' AS parent_line,
        (rank - 1)::INT AS _index, l_returnflag AS _value FROM {ITEMS} JOIN orders ON l_orderkey = o_orderkey""",
    "nameless_groups": f"""SELECT l_orderkey AS _number, (row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1)::INT AS _index,
        l_discount AS line_discount FROM lineitem WHERE l_discount > 0.05""",
    "own_value_and_label": f"""SELECT l_orderkey AS _number, l_linenumber AS _value, {ITEM_LABEL} AS _string,
        l_linestatus = 'O' AS line_open, CASE WHEN l_linestatus = 'O' THEN 'open' ELSE 'closed' END AS line_open_string,
        l_extendedprice AS line_price FROM lineitem""",
    "empty_layer_pruned": """SELECT 'geninfo' AS "table", count(*) AS n FROM orders UNION ALL SELECT 'order', count(*) FROM orders
        UNION ALL SELECT 'line', count(DISTINCT l_orderkey) FROM lineitem""",
    "sibling_order": """SELECT 1 AS depth, 2::BIGINT AS class, (SELECT 2 * count(*) FROM orders) + (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n
        UNION ALL SELECT 2, 2, (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)
        UNION ALL SELECT 2, 0, (SELECT count(*) FROM lineitem)
        UNION ALL SELECT 2, 1, (SELECT count(*) FROM lineitem WHERE l_discount > 0.05)""",
    "source_path_column": f"""SELECT o_orderkey AS num, o_orderdate AS timestamp, {SRC} AS file, NULL::BIGINT AS _number FROM orders""",
    "normalise_names": f"""SELECT doc_id, lower(regexp_replace(translate(split_part(text, ':', 1), ' _-', '...'), '{NAME_DROP}', '', 'g')) AS node_name,
        lower(regexp_replace(regexp_replace(regexp_replace(translate(text, ' _-', '...'), '{NAME_DROP}', '', 'g'), '\\.+', '.', 'g'), '^\\.|\\.$', '', 'g')) AS rule_name,
        lower(regexp_replace(regexp_replace(text, '{RUN}', '.', 'g'), '\\.$', '')) AS template_name,
        CASE WHEN length(esc) > 96 THEN left(esc, 23) || '___' || right(esc, 70) ELSE esc END AS escaped
        FROM (SELECT *, regexp_replace(regexp_replace(text, '{ASTRAL}', '__', 'g'), '[^\\p{{L}}\\p{{Nd}}]', '_', 'g') AS esc FROM documents)""",
    "overlap_join_names": f"""SELECT p_partkey, {combined("prefix", "upper(string_split(lower(p_name), ' ')[-1]) || '.' || lower(p_type)")} AS one_part,
        {combined("prefix", "replace(lower(p_name), ' ', '.') || '.' || lower(p_brand)")} AS two_parts,
        {combined("prefix", "lower(p_brand)")} AS no_overlap
        FROM (SELECT *, 'part.' || replace(lower(p_name), ' ', '.') AS prefix FROM part)""",
    "type_unsigned": values_of("orders", "o_orderkey", {
        "u.small": (uint_kind("o_custkey"), "o_custkey::VARCHAR", ""),
        "u.wide": (uint_kind("(o_orderkey + 1) * 65521"), "((o_orderkey + 1) * 65521)::VARCHAR", ""),
        "u.huge": ("CASE WHEN o_orderkey::HUGEINT * o_orderkey * 100000000000 + o_orderkey > 18446744073709551615 THEN 'String16' ELSE "
                   + uint_kind("o_orderkey::HUGEINT * o_orderkey * 100000000000 + o_orderkey") + " END",
                   "(o_orderkey::HUGEINT * o_orderkey * 100000000000 + o_orderkey)::VARCHAR", ""),
        "u.text": ("'String16'", "o_custkey::VARCHAR", "")}),
    "type_signed": values_of("orders", "o_orderkey", {
        "s.small": (int_kind("-o_custkey"), "(-o_custkey)::VARCHAR", ""),
        "s.wide": (int_kind("-(o_orderkey + 1) * 300007"), "(-(o_orderkey + 1) * 300007)::VARCHAR", "")}),
    "type_float": """SELECT o_orderkey AS key, 'f.total' AS name, 'Float' AS kind, o_totalprice AS number, NULL AS kept_as_text FROM orders
        UNION ALL SELECT o_orderkey, 'f.bad', 'String16', NULL, 'f.bad' FROM orders""",
    "type_bool": """SELECT CASE WHEN l_returnflag IN ('A', 'N') THEN 'Boolean' ELSE 'String16' END AS kind,
        CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '0' ELSE 'True' END AS text, count(*) AS n FROM lineitem GROUP BY 1, 2""",
    "type_hex": values_of("customer", "c_custkey", {
        "h.raw": ("'Bytes'", "lower(hex(c_name::BLOB))", ""),
        "h.odd": ("'Bytes'", "'0f' || lower(lpad(to_hex(c_custkey + 1), 4, '0'))", ""),
        "h.u": (uint_kind("c_custkey + 1"), "(c_custkey + 1)::VARCHAR", ""),
        "h.long": (uint_kind("c_custkey + 1"), "(c_custkey + 1)::VARCHAR", ""),
        "h.neg": ("'Int32'", "(c_custkey + 1 - 65536)::VARCHAR", "")}),
    "integer_literals": """SELECT p_partkey, p_partkey AS dec, p_partkey AS pad, p_partkey AS hex, p_partkey AS basic,
        NULL::BIGINT AS bad, lower(hex(p_name::BLOB)) AS name_hex FROM part""",
    "type_time": """SELECT event_id AS key, 't.at' AS name, 'DateTime' AS kind, ts AS at, false AS kept_as_text FROM events
        UNION ALL SELECT event_id, 't.iso', 'String16', NULL, true FROM events""",
    "type_time_zone": "SELECT o_orderkey AS key, o_orderdate - INTERVAL 2 HOUR AS at FROM orders",
    "type_fallback": """SELECT event_id AS key, 'e.props' AS name, 'String16' AS kind, props AS text FROM events
        UNION ALL SELECT event_id, 'e.click', 'String16', CASE WHEN event_type = 'click' THEN 'v-click' ELSE event_type END FROM events
        UNION ALL SELECT event_id, 'e.free', 'String16', event_type FROM events
        UNION ALL SELECT event_id, 'e.none', 'String16', NULL FROM events""",
    "type_net_guid_span": """WITH c AS (SELECT c_custkey AS k, md5(c_custkey::VARCHAR) AS h FROM customer),
        d AS (SELECT *, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS g,
          ((k >> 16) % 256) || '.' || ((k >> 8) % 256) || '.' || (k % 256) AS tail FROM c)
        SELECT k AS key, 'n.ip' AS name, 'String8' AS kind, '10.' || tail AS text FROM d
        UNION ALL SELECT k, 'n.raw', 'String8', ((k >> 24) % 256) || '.' || tail FROM d
        UNION ALL SELECT k, 'n.guid', 'Guid', g FROM d UNION ALL SELECT k, 'n.plain', 'Guid', g FROM d
        UNION ALL SELECT k, 'n.bad', 'String16', h[1:31] FROM d UNION ALL SELECT k, 'n.span', 'Float', k || '.25' FROM d""",
    "dict_protocol_merge": f"""WITH {PROTO_LINES} SELECT short_name, {fold("list(p_type ORDER BY seq)")} AS long_name,
        any_value(own) AS filter_name FROM pchecked WHERE NOT bad GROUP BY 1 UNION ALL SELECT 'known', 'Known', 'known'""",
    "dict_field_merge": f"""WITH {PART_FIELDS} SELECT short_name, cls, long_name, description, 'BASE_DEC' AS base, '0x0' AS bitmask FROM fields""",
    "dict_label_merge": f"""WITH {PART_LABELS} SELECT field, kind, any_value(lo) AS lo, any_value(hi) AS hi,
        {fold("list(label ORDER BY seq)")} AS label, CASE WHEN kind = 'T' THEN {fold("list(false_label ORDER BY seq)")} END AS false_label,
        min(seq) AS ordinal FROM lchecked WHERE reason IS NULL GROUP BY field, kind, coalesce(lo, 0), coalesce(hi, 0)""",
    "dict_rejects": f"""WITH {PART_LABELS}, {PROTO_LINES}
        SELECT 'fields' AS stage, reason, count(*) AS n FROM checked WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'values', reason, count(*) FROM lchecked WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT * FROM (SELECT 'protocols', 'filter name conflict', count(*) AS n FROM pchecked WHERE bad) WHERE n > 0""",
    "bounded_split": """WITH t AS (SELECT doc_id, regexp_replace(text, '[ \\n]', chr(9), 'g') AS line FROM documents),
        p AS (SELECT doc_id, line, string_split(line, chr(9)) AS a FROM t),
        q AS (SELECT doc_id, a, CASE WHEN len(a) > 4 THEN 4 ELSE len(a) END AS size,
          CASE WHEN len(a) > 3 THEN array_to_string(a[4:], chr(9)) END AS rest FROM p),
        r AS (SELECT *, size > 1 AND CASE WHEN size = 4 THEN rest = '' ELSE a[size] = '' END AS open FROM q)
        SELECT doc_id, """ + ", ".join(
            f"CASE WHEN size = {i + 1} AND open THEN NULL WHEN size > {i} THEN {f'a[{i + 1}]' if i < 3 else 'rest'} WHEN open THEN NULL ELSE '' END AS part{i}"
            for i in range(4)) + " FROM r",
    "label_lookup_range": """WITH labels AS (SELECT n_nationkey AS lo, CASE WHEN n_nationkey % 5 = 0 THEN n_nationkey
          ELSE n_nationkey + n_nationkey % 7 * 4 END AS hi, n_name AS label, 25 - n_nationkey AS ordinal FROM nation)
        SELECT l_orderkey, l_linenumber, l_partkey,
          (SELECT arg_min(label, ordinal) FROM labels WHERE l_quantity BETWEEN lo AND hi) AS label FROM lineitem""",
    "rename_constant": renamed({0: constant_case({"click": "mouse.click", "error": "error"})}),
    "rename_prefix": renamed({1: ("'props'", "props", "props", "props"), 2: prefix_case({"view": "viewed.by"})}),
    "rename_speculative": renamed({0: constant_case({"purchase": "bought", "signup": "joined"}),
                                   2: prefix_case({"purchase": "purchase", "signup": "joined"})}),
    "rename_template": f"""SELECT page_id AS packet_no,
        CASE WHEN url LIKE '%#top' THEN 'top.top' WHEN {PAGE_HIT} THEN
          'url.' || regexp_extract(url, '{PAGE}', 1) || '.' || lower(regexp_extract(url, '{PAGE}', 3))
          ELSE 'page.link' END AS name,
        CASE WHEN url LIKE '%#top' THEN NULL WHEN {PAGE_HIT} THEN
          regexp_extract(url, '{PAGE}', 2) || '|' || regexp_extract(url, '{PAGE}', 4) || '|' ELSE url END AS "show",
        "show" AS showname, "show" AS value FROM pages""",
    "filter_tables": """SELECT 'order' AS "table", count(*) AS n FROM orders
        UNION ALL SELECT 'line_item', count(*) FROM lineitem UNION ALL SELECT 'line__value', count(*) FROM lineitem""",
    "filter_columns": """SELECT t AS "table", c AS "column", count(*) AS n FROM orders, (VALUES ('geninfo', 'num'), ('geninfo', 'timestamp'),
        ('geninfo', 'len'), ('order', 'order_key'), ('order_customer', 'customer_key')) v(t, c) GROUP BY 1, 2""",
    "filter_preset": """WITH names AS (SELECT event_type || '_x' AS t FROM events
        UNION ALL SELECT regexp_replace(lower(url), '[^a-z0-9]', '_', 'g') FROM pages UNION ALL SELECT lower('ip' || p_type) FROM part)
        SELECT regexp_matches(t, '^(geninfo$|arp|eth|ip|tcp|udp|icmp|dns|http|media|image|ftp|tftp|smtp|pop|imap|imf|ssl|ssh|telnet|x11|umts|dhcp|nntp|smb|mailslot|nbdgm|nbns|exec|messenger|msnms|irc|x224*$|tpkt*$)') AS kept,
        count(*) AS n FROM names GROUP BY 1""",
    "filter_promote_children": """SELECT 'geninfo' AS "table", NULL AS parent_table, NULL AS parent_path, count(*) AS n FROM orders
        UNION ALL SELECT 'order_customer', 'geninfo', '0', count(*) FROM orders
        UNION ALL SELECT 'line_item', 'geninfo', '0', count(*) FROM lineitem
        UNION ALL SELECT 'line__value', 'geninfo', '0', count(*) FROM lineitem
        UNION ALL SELECT 'line__group', 'geninfo', '0', count(*) FROM lineitem WHERE l_discount > 0.05""",
    "binary_drop": """SELECT 'part/' || p_partkey || '/0' AS _id, NULL AS dropped, p_size, lower(hex(p_name::BLOB)) AS kept, '{ ' || lower(hex(p_name::BLOB)) || ', ' || lower(hex(p_name::BLOB)) || ' }' AS p_twin FROM part""",
    "infer_kinds": f"""WITH cells AS ({ORDER_CELLS}) SELECT "table", "column", kind, count(*) AS n FROM cells GROUP BY 1, 2, 3""",
    "widen_types": f"""WITH cells AS ({ORDER_CELLS}), w AS ({WIDEN}) SELECT "table", "column", kind,
        CASE WHEN kind <> 'String16' THEN NULL WHEN pure THEN {BUCKET.format("longest")} ELSE 4000 END AS width, filled FROM w""",
    "text_widths": f"""SELECT 'docs_' || lang AS "table", 'String16' AS kind, {BUCKET.format("max(length(text))")} AS width,
        max(length(text))::INT AS longest FROM documents GROUP BY lang""",
    "evolve_append": """SELECT o_orderkey AS key, o_totalprice AS total, o_custkey::VARCHAR AS mixed, NULL::TIMESTAMP AS date FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey * 300007, o_totalprice, o_orderpriority, o_orderdate FROM orders WHERE o_orderstatus <> 'F'""",
    "text_profile": "SELECT doc_id, substring(text, 1, 4000) AS text, length(text) > 4000 AS clipped FROM documents",
    "compat_profile": """SELECT o_orderkey AS order_key, o_totalprice::FLOAT::DOUBLE AS order_total,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date, o_orderstatus AS order_status FROM orders""",
    "clip_report": """SELECT 'docs_' || lang AS "table", doc_id::VARCHAR AS id, 'text' AS "column", (length(text) - 4000)::INT AS truncated
        FROM documents WHERE length(text) > 4000""",
    "render_values": "SELECT event_id, CASE WHEN value > 50 THEN '1' ELSE '0' END AS flag, '{ ' || event_type || ', ' || user_id || ' }' AS both FROM events",
    "lineage_columns": """WITH r AS (SELECT 'geninfo' AS "table", NULL AS num, NULL AS ts, NULL AS f FROM orders
          UNION ALL SELECT 'order', o_orderkey, o_orderdate, year(o_orderdate) FROM orders
          UNION ALL SELECT 'order_customer', o_orderkey, o_orderdate, year(o_orderdate) FROM orders
          UNION ALL SELECT DISTINCT 'line', o_orderkey, o_orderdate, year(o_orderdate) FROM orders JOIN lineitem ON l_orderkey = o_orderkey
          UNION ALL SELECT 'line_item', o_orderkey, o_orderdate, year(o_orderdate) FROM orders JOIN lineitem ON l_orderkey = o_orderkey
          UNION ALL SELECT 'line__value', o_orderkey, o_orderdate, year(o_orderdate) FROM orders JOIN lineitem ON l_orderkey = o_orderkey
          UNION ALL SELECT 'line__group', o_orderkey, o_orderdate, year(o_orderdate) FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_discount > 0.05)
        SELECT "table", count(*) AS n, count(num) AS numbered, sum(num)::BIGINT AS number_sum, min(ts) AS first_time, count(DISTINCT f) AS files FROM r GROUP BY 1""",
    "source_dimension": f"SELECT dense_rank() OVER (ORDER BY path) AS _id, path FROM (SELECT DISTINCT {SRC} AS path FROM orders)",
    "dense_ids": f"""SELECT l_orderkey AS packet_no, (rank - 1) * 8 + 1 AS position,
        row_number() OVER (ORDER BY {SRC}, l_orderkey, rank) AS id FROM {ITEMS} JOIN orders ON l_orderkey = o_orderkey""",
    "key_relationships": """SELECT 'order' AS "table", 'parent_geninfo' AS "column", 'geninfo' AS parent_table, count(*) AS links FROM orders
        UNION ALL SELECT 'order_customer', 'parent_order', 'order', count(*) FROM orders
        UNION ALL SELECT 'line', 'parent_order', 'order', count(DISTINCT l_orderkey) FROM lineitem
        UNION ALL SELECT 'line_item', 'parent_line', 'line', count(*) FROM lineitem
        UNION ALL SELECT 'line__value', 'parent_line', 'line', count(*) FROM lineitem
        UNION ALL SELECT 'line__group', 'parent_line', 'line', count(*) FROM lineitem WHERE l_discount > 0.05""",
    "orphan_check": "SELECT count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    "navigate_packet": f"""WITH p AS (SELECT l_orderkey AS k, CASE WHEN count(*) = 1 THEN any_value(l_partkey)::VARCHAR
        ELSE '{{ ' || string_agg(l_partkey::VARCHAR, ', ' ORDER BY {LINE_ORDER}) || ' }}' END AS parts FROM lineitem GROUP BY 1)
        SELECT l_orderkey AS _number, l_extendedprice AS line_price, parts FROM lineitem JOIN p ON k = l_orderkey""",
    "xml_roundtrip": ORDER_SQL,
    "recursive_listing": "SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders",
    "table_sink": f"""SELECT o_orderkey AS _number, {SRC} AS path, {SRC} || '/' || o_orderkey || '/3' AS parent_line,
        l_linenumber AS item, l_extendedprice AS line_price FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "table_widen": """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN (o_orderkey % 100)::VARCHAR WHEN 1 THEN (o_orderkey + 5000000000)::VARCHAR
        ELSE o_orderstatus END AS code FROM orders""",
    "stream_ingest": """SELECT o_orderkey AS _number, o_orderkey AS order_key, o_orderstatus AS order_status, o_totalprice AS order_total,
        o_orderpriority AS order_priority FROM orders""",
    "mine_includes": "SELECT doc_id, 1::BIGINT AS pos, '/src/epan/dissectors/' || source || '.h' AS unit FROM documents",
    "mine_names": f"SELECT doc_id, {NAMES} AS protocols FROM documents",
    "mine_definitions": """SELECT DISTINCT '/src/epan/dissectors/' || source || '.h' AS unit, 'PROTO_NAME' AS key, '"' || source || '"' AS value FROM documents
        UNION ALL SELECT '/src/epan/dissectors/packet-d' || doc_id || '.c', 'PROTO_NAME', '"doc' || doc_id || '"' FROM documents WHERE doc_id % 2 = 0""",
    "mine_speculative": r"""WITH c AS (
        SELECT 'packet-d' || doc_id || '.c' AS unit, '#include <glib.h>' || chr(10) || '#include "common/' || source || '.h"' || chr(10)
          || CASE WHEN doc_id % 2 = 0 THEN '#define PROTO_NAME "doc' || doc_id || '"' || chr(10) ELSE '' END
          || CASE WHEN doc_id % 3 = 2 THEN '' ELSE 'proto_register_protocol("Long name", "Short", /* key */ '
               || CASE WHEN doc_id % 3 = 0 THEN 'PROTO_NAME' ELSE '"own' || doc_id || '"' END || ');' || chr(10) END
          || coalesce(array_to_string(list_transform(list_filter(string_split(regexp_replace(text, '["\\,]', ' ', 'g'), chr(10)), lambda x: x <> ''),
               lambda x: '  proto_tree_add_text(tree, tvb, 0, 1, "' || x || '", v);' || chr(10)), ''), '') AS t FROM documents
        UNION ALL SELECT DISTINCT source || '.h', 'static char PROTO_NAME[] = "' || source || '";' || chr(10) FROM documents),
      m AS (SELECT unit, regexp_extract_all(t, '"( *[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}(][\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\- ()'']{1,64})(?:: *)?"', 1) AS x FROM c)
      SELECT unit, unnest(range(len(x)))::INT AS "at", unnest(x) AS text FROM m""",
    "quality_counts": f"""WITH {PART_LABELS}, {PROTO_LINES}, r AS (
        SELECT 'nodes' AS stage, 'error' AS severity, count(*) AS n FROM part WHERE p_brand = 'Brand#1'
        UNION ALL SELECT 'values', 'warning', (SELECT count(*) FROM part WHERE p_brand <> 'Brand#1')
          + (SELECT count(*) FROM lchecked WHERE reason IS NOT NULL)
        UNION ALL SELECT 'fields', 'warning', count(*) FROM checked WHERE reason IS NOT NULL
        UNION ALL SELECT 'protocols', 'warning', count(*) FROM pchecked WHERE bad)
        SELECT * FROM r WHERE n > 0""",
    "discovered_schema": """WITH o AS (SELECT count(*) AS n, max(o_orderkey) AS k, max(floor(o_totalprice)) AS len, max(o_custkey) AS c FROM orders),
        l AS (SELECT count(*) AS n, count(DISTINCT l_orderkey) AS d, count(*) FILTER (l_discount > 0.05) AS g FROM lineitem)
        SELECT t AS "table", c AS "column", kind, filled FROM (
          SELECT unnest([
            {'t': 'geninfo', 'c': 'file', 'kind': 'String16', 'filled': o.n}, {'t': 'geninfo', 'c': 'timestamp', 'kind': 'DateTime', 'filled': o.n},
            {'t': 'geninfo', 'c': 'num', 'kind': CASE WHEN o.k > 65535 THEN 'Int64' ELSE 'Int32' END, 'filled': o.n},
            {'t': 'geninfo', 'c': 'len', 'kind': CASE WHEN o.len > 65535 THEN 'Int64' ELSE 'Int32' END, 'filled': o.n},
            {'t': 'order', 'c': 'order_key', 'kind': CASE WHEN o.k > 65535 THEN 'Int64' ELSE 'Int32' END, 'filled': o.n},
            {'t': 'order', 'c': 'order_status', 'kind': 'String16', 'filled': o.n}, {'t': 'order', 'c': 'order_priority', 'kind': 'String16', 'filled': o.n},
            {'t': 'order', 'c': 'order_total', 'kind': 'Float', 'filled': o.n}, {'t': 'order', 'c': 'order_date', 'kind': 'DateTime', 'filled': o.n},
            {'t': 'order_customer', 'c': 'customer_key', 'kind': CASE WHEN o.c > 65535 THEN 'Int64' ELSE 'Int32' END, 'filled': o.n},
            {'t': 'order_customer', 'c': 'customer_name', 'kind': 'String16', 'filled': o.n},
            {'t': 'order_customer', 'c': 'customer_segment', 'kind': 'String16', 'filled': o.n},
            {'t': 'line', 'c': 'line_part', 'kind': 'String16', 'filled': l.d}, {'t': 'line_item', 'c': '_value', 'kind': 'Int32', 'filled': l.n},
            {'t': 'line_item', 'c': '_string', 'kind': 'String16', 'filled': l.n}, {'t': 'line_item', 'c': 'line_open', 'kind': 'Boolean', 'filled': l.n},
            {'t': 'line_item', 'c': 'line_open_string', 'kind': 'String16', 'filled': l.n}, {'t': 'line_item', 'c': 'line_price', 'kind': 'Float', 'filled': l.n},
            {'t': 'line_item', 'c': 'line_quantity', 'kind': 'Float', 'filled': l.n}, {'t': 'line_item', 'c': 'line_size', 'kind': 'Int32', 'filled': l.n},
            {'t': 'line__value', 'c': '_index', 'kind': 'Int32', 'filled': l.n}, {'t': 'line__value', 'c': '_value', 'kind': 'String16', 'filled': l.n},
            {'t': 'line__group', 'c': '_index', 'kind': 'Int32', 'filled': l.g}, {'t': 'line__group', 'c': 'line_discount', 'kind': 'Float', 'filled': l.g}
          ], recursive := true) FROM o, l)""",
}

# Speculative literals of a document: those of its own source, and those of the header that it includes.
GUESSES = f"""guesses AS ({ORACLES["mine_speculative"]}),
  guessed AS (SELECT doc_id, source, g.text FROM documents JOIN guesses AS g ON g.unit = 'packet-d' || doc_id || '.c'
    UNION ALL SELECT doc_id, source, g.text FROM documents JOIN guesses AS g ON g.unit = source || '.h')"""

ORACLES |= {
    "mine_classify": f"""WITH {LINES_SQL}, {GUESSES}
        SELECT 'packet-d' || doc_id || '.c' AS unit, 0 AS phase, pos::INT AS at_, text, outcome, rule_text FROM ruled
        UNION ALL SELECT unit, 1, "at", text, 'Speculative', text FROM guesses""",
    "mine_dedupe": f"""WITH {LINES_SQL}, {GUESSES}
        SELECT lower(outcome) AS kind, {NAMES} AS protocol, rule_text AS text FROM ruled WHERE rule_text IS NOT NULL
        UNION SELECT 'speculative', {NAMES}, text FROM guessed""",
    "mine_trace": f"""WITH {LINES_SQL}, {GUESSES} SELECT outcome, count(*) AS n FROM ruled GROUP BY 1
        UNION ALL SELECT 'Speculative', count(*) FROM guessed""",
    "mine_written_trace": f"""WITH {LINES_SQL}, {GUESSES}
        SELECT 'packet-d' || doc_id || '.c' AS unit, coalesce(rule_text, text) AS text, outcome, 1 AS n FROM ruled
        UNION ALL SELECT g.unit, g.text, 'Speculative', 1 FROM guesses AS g WHERE g.unit LIKE '%.c'
        UNION ALL SELECT g.unit, g.text, 'Speculative', c.n FROM guesses AS g
          JOIN (SELECT source || '.h' AS unit, count(*) AS n FROM documents GROUP BY 1) AS c ON c.unit = g.unit""",
    "mine_rejects": """SELECT doc_id, 'mining' AS stage, 'unable to parse protocol name' AS reason, 'warning' AS severity
        FROM documents WHERE doc_id % 3 = 0 AND doc_id % 2 = 1""",
    "mine_literals": f"""WITH {LINES_SQL}, {GUESSES}
        SELECT 'packet-d' || doc_id || '.c' AS unit, 0 AS phase, pos::INT AS at_, text FROM ruled
        UNION ALL SELECT unit, 1, "at", text FROM guesses""",
    "xml_whole_packets": """SELECT l_orderkey AS _number, l_linenumber::BIGINT AS _value, l_quantity::DOUBLE AS line_quantity,
        l_extendedprice AS line_price, l_quantity::BIGINT AS line_size, l_linestatus = 'O' AS line_open FROM lineitem""",
    "recover_packets": ORDER_SQL + " WHERE o_orderkey % 7 NOT IN (3, 4, 5)",
    "packet_rejects": """SELECT CASE WHEN o_orderkey % 7 = 5 THEN 'bad size or position in a layer' ELSE 'malformed packet' END AS reason,
        'error' AS severity, count(*) AS n FROM orders WHERE o_orderkey % 7 IN (3, 4, 5) GROUP BY 1""",
    "packet_places": "SELECT o_orderkey AS order_key, o_orderkey % 10 AS number, 1 AS packets FROM orders",
    "packet_rollup": f"""WITH RECURSIVE row_of AS (
          SELECT o_orderkey AS k, 'geninfo' AS t, NULL AS up, 0 AS i, NULL AS upi FROM orders UNION ALL SELECT o_orderkey, 'order', 'geninfo', 0, 0 FROM orders
          UNION ALL SELECT o_orderkey, 'order_customer', 'order', 0, 0 FROM orders UNION ALL SELECT DISTINCT l_orderkey, 'line', 'order', 0, 0 FROM lineitem
          UNION ALL SELECT l_orderkey, u.t, 'line', row_number() OVER (), 0 FROM lineitem, (VALUES ('line_item'), ('line__value')) AS u(t)
          UNION ALL SELECT l_orderkey, 'line__group', 'line', row_number() OVER (), 0 FROM lineitem WHERE l_discount > 0.05),
        tree AS (SELECT k, t, i, 0 AS depth, t AS root FROM row_of WHERE up IS NULL
          UNION ALL SELECT r.k, r.t, r.i, tree.depth + 1, tree.root FROM tree JOIN row_of AS r ON r.k = tree.k AND r.up = tree.t AND r.upi = tree.i)
        SELECT k AS packet_no, t AS "table", depth, root AS root_table FROM tree""",
    "run_totals": """WITH o AS (SELECT count(*) AS n FROM orders), l AS (SELECT count(*) AS n, count(DISTINCT l_orderkey) AS d,
          count(*) FILTER (l_discount > 0.05) AS g FROM lineitem)
        SELECT unnest(['nodes', 'values', 'rejected nodes', 'rows geninfo', 'rows order', 'rows order_customer', 'rows line', 'rows line_item',
                       'rows line__value', 'rows line__group']) AS measure,
               unnest([16 * o.n + 7 * l.n + 2 * l.g, 11 * o.n + 7 * l.n + l.g, 0, o.n, o.n, o.n, l.d, l.n, l.n, l.g]) AS n FROM o, l""",
    "dense_tables": "SELECT row_number() OVER () AS id, true AS same_packet FROM lineitem",
    "mine_rules_reloaded": f"""WITH {LINES_SQL}, {GUESSES}
        SELECT lower(outcome) AS kind, {NAMES} AS protocol, rule_text AS text FROM ruled WHERE rule_text IS NOT NULL
        UNION SELECT 'speculative', {NAMES}, text FROM guessed""",
}
