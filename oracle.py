"""SQL for comparison with the registered queries, over the same tables."""

from __future__ import annotations

AS_OF = "DATE '2024-06-01'"
STAMP = "'%Y-%m-%d %H:%M:%S'"


def _placed(key: str, shift: str = "0") -> str:
    return (f"(TIMESTAMP '2021-03-15 00:00:00' "
            f"+ to_seconds((({key} * 7) % 86400 + {shift})::BIGINT))")


def _text(at: str) -> str:
    return f"strftime({at}, {STAMP})"


SPLIT = ("(l_extendedprice::DECIMAL(12,2) * (1::DECIMAL(4,2) - l_discount::DECIMAL(4,2)))"
         "::DECIMAL(18,2)")
SHIFT = "((l_linenumber * 5 + l_partkey) % 16 - 8)"


def bucket(at: str, width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', {at}, TIMESTAMP '1970-01-01')"


def _window(at: str, width: str) -> str:
    start = bucket(at, width)
    return f"{_text(start)} AS stt, {_text(f'({start} + INTERVAL {width!r})')} AS edt"


# Named pieces; a query lists the ones it needs, in order.
CTE = {
    "info": f"""SELECT o_orderkey AS id, o_custkey % 26 AS province_id,
        CASE WHEN o_orderkey % 31 = 1 THEN -o_custkey - 1 ELSE o_custkey END AS user_id,
        o_orderstatus AS order_status, o_totalprice::DECIMAL(18,2) AS total_amount,
        {_placed('o_orderkey')} AS at_time, {_text(_placed('o_orderkey'))} AS create_time,
        {_text(_placed('o_orderkey', '900'))} AS expire_time FROM orders""",
    "detail": f"""SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS order_id,
        l_partkey AS sku_id, l_quantity::BIGINT AS sku_num,
        l_extendedprice::DECIMAL(18,2) AS order_price, {SPLIT} AS split_total_amount,
        'line ' || l_partkey AS sku_name, {_placed('l_orderkey', SHIFT)} AS at_time FROM lineitem""",
    "joined": """SELECT d.id AS detail_id, o.id AS order_id, d.sku_id, d.order_price, d.sku_num,
        d.sku_name, o.province_id, o.order_status, o.user_id, o.total_amount,
        d.split_total_amount, o.expire_time, o.create_time, o.at_time
        FROM info o JOIN detail d ON o.id = d.order_id
        AND d.at_time BETWEEN o.at_time - INTERVAL 5 SECOND AND o.at_time + INTERVAL 5 SECOND""",
    "users": """SELECT c_custkey AS id,
        CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
        (DATE '1950-01-01' + (c_custkey * 37 % 20000)::INTEGER)::DATE AS birthday FROM customer""",
    "provinces": """SELECT n_nationkey AS id, n_name AS name, '0' || n_nationkey AS area_code,
        'CN-' || n_nationkey AS iso_code, 'R' || n_regionkey AS iso_3166_2 FROM nation""",
    "products": """SELECT p_partkey AS id, p_name AS sku_name, p_retailprice::DECIMAL(18,2) AS price,
        p_partkey % 120 AS spu_id, s_name AS spu_name,
        substr(p_brand, 7)::BIGINT AS tm_id, p_brand AS tm_name,
        (p_size % 6)::BIGINT AS category3_id, r_name AS category3_name
        FROM part LEFT JOIN supplier ON s_suppkey = p_partkey % 120
        LEFT JOIN region ON r_regionkey = p_size % 6""",
    "wide": f"""SELECT j.* EXCLUDE (sku_name), p.sku_name, v.name AS province_name,
        v.area_code, v.iso_code, v.iso_3166_2,
        datesub('year', u.birthday, {AS_OF})::INTEGER AS user_age, u.gender AS user_gender,
        p.spu_id, p.tm_id, p.category3_id, p.spu_name, p.tm_name, p.category3_name
        FROM joined j LEFT JOIN users u ON u.id = j.user_id
        LEFT JOIN provinces v ON v.id = j.province_id
        LEFT JOIN products p ON p.id = j.sku_id""",
    "payment": f"""SELECT o_orderkey + 1000000000 AS id, o_orderkey AS order_id,
        o_custkey AS user_id, o_totalprice::DECIMAL(18,2) AS total_amount,
        o_orderpriority AS subject,
        CASE WHEN o_orderkey % 101 <> 0
             THEN {_placed('o_orderkey', 'o_orderkey % 20 * 60')} END AS at_time
        FROM orders WHERE o_orderstatus <> 'P'""",
    "paid": """SELECT p.id AS payment_id, p.subject, p.at_time AS paid_at, p.order_id AS p_order_id,
        p.user_id AS p_user_id, p.total_amount AS p_total_amount, w.*
        FROM payment p JOIN {source} w ON p.order_id = w.order_id
        AND w.at_time BETWEEN p.at_time - INTERVAL 15 MINUTE AND p.at_time""",
    "logrow": """SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts, make_timestamp(epoch_us(ts) // 1000 * 1000) AS at_time,
        (user_id % 7 + 110000)::VARCHAR AS ar, 'ch_' || (user_id % 3) AS ch,
        (event_id % 2)::VARCHAR AS is_new, 'mid_' || user_id AS mid, 'v' || (event_id % 3) AS vc,
        floor(value * 100)::BIGINT AS during_time, json_extract_string(props, '$.k') AS item,
        CASE WHEN event_id % 4 = 0 THEN 'promotion_id' ELSE 'sku_id' END AS item_type,
        CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN NULL
             WHEN event_type = 'view' THEN '' WHEN event_type = 'click' THEN 'search'
             ELSE 'home' END AS last_page_id,
        CASE WHEN event_type = 'click' THEN 'good_detail' ELSE event_type END AS page_id,
        CASE WHEN event_type = 'signup' THEN event_id % 3 ELSE 0 END AS n_displays,
        CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '{"entry":"icon"}' END AS start
        FROM events""",
    "good": "SELECT * FROM logrow WHERE seq % 50 NOT IN (7, 9)",
    "page": "SELECT * FROM logrow WHERE start IS NULL",
    "good_page": "SELECT * FROM good WHERE start IS NULL",
    "entry": "SELECT * FROM page WHERE coalesce(last_page_id, '') = ''",
    "uniques": """SELECT * FROM entry QUALIFY row_number() OVER (
        PARTITION BY mid, at_time::DATE ORDER BY ts, seq) = 1""",
    "jumps": """SELECT * FROM entry e WHERE NOT EXISTS (
        SELECT 1 FROM page f WHERE f.mid = e.mid AND coalesce(f.last_page_id, '') <> ''
        AND f.ts >= e.ts AND f.ts < e.ts + {timeout})""",
    "busy_page": """SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'busy' ELSE mid END AS mid)
        FROM logrow WHERE start IS NULL""",
    "busy_entry": "SELECT * FROM busy_page WHERE coalesce(last_page_id, '') = ''",
    "busy_jumps": """SELECT * FROM busy_entry e WHERE NOT EXISTS (
        SELECT 1 FROM busy_page f WHERE f.mid = e.mid AND coalesce(f.last_page_id, '') <> ''
        AND f.ts >= e.ts AND f.ts < e.ts + {timeout})""",
    "display_row": """SELECT l.page_id, l.ts, l.mid, ((l.seq * 7 + n) % 2000)::VARCHAR AS item,
        CASE WHEN (l.seq + n) % 4 = 0 THEN 'promotion_id' ELSE 'sku_id' END AS item_type,
        n::VARCHAR AS place
        FROM {source} l, (SELECT unnest([1, 2]) AS n) WHERE n <= l.n_displays""",
    "change": """SELECT 'shop' AS "database", 'table_' || (c_custkey % 60) AS "table",
            'insert' AS type, c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS segment,
            CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
            NULL AS user_id, NULL AS status, c_custkey AS key, c_custkey * 4 AS seq FROM customer
        UNION ALL
        SELECT 'shop', 'table_' || (c_custkey % 60), 'update', c_custkey::VARCHAR, NULL, 'CHANGED',
            NULL, NULL, NULL, c_custkey, c_custkey * 4 + 1 FROM customer WHERE c_custkey % 10 = 0
        UNION ALL
        SELECT 'shop', 'table_' || (c_custkey % 60), 'delete', NULL, NULL, NULL,
            NULL, NULL, NULL, c_custkey, c_custkey * 4 + 2 FROM customer WHERE c_custkey % 25 = 0
        UNION ALL
        SELECT 'shop', 'order_info', 'insert', o_orderkey::VARCHAR, NULL, NULL, NULL,
            o_custkey::VARCHAR, o_orderstatus, o_orderkey, o_orderkey * 4 + 3 FROM orders""",
    # The data map of a change as sorted text.
    "changed": """SELECT *, CASE
        WHEN "table" = 'order_info' THEN 'id=' || id || ',status=' || status || ',user_id=' || user_id
        WHEN type = 'insert' THEN 'gender=' || gender || ',id=' || id || ',name=' || name
                                  || ',segment=' || segment
        WHEN type = 'update' THEN 'gender=NULL,id=' || id || ',segment=CHANGED'
        ELSE '' END AS data FROM change""",
    "rule_change": """SELECT 'table_' || (p_partkey % 50) AS source_table,
            CASE WHEN p_partkey % 100 < 50 THEN 'insert' ELSE 'update' END AS operate_type,
            CASE p_size % 3 WHEN 0 THEN 'kafka' WHEN 1 THEN 'hbase' ELSE 'clickhouse' END AS sink_type,
            CASE WHEN p_size % 3 = 1 THEN 'dim_' ELSE 'dwd_' END || (p_partkey % 50) AS sink_table,
            CASE WHEN p_partkey % 2 = 0 THEN 'id,segment,gender' ELSE 'id,name,gender' END AS sink_columns,
            CASE p_partkey % 3 WHEN 0 THEN 'id' WHEN 1 THEN '' END AS sink_pk,
            NULL::VARCHAR AS sink_extend, p_size = 50 AS gone, p_partkey AS seq FROM part
        UNION ALL
        SELECT 'order_info', 'insert', 'kafka', 'dwd_order_info',
            CASE WHEN n_nationkey = 24 THEN 'id,user_id,status' ELSE 'id,user_id' END,
            'id', NULL, false, n_nationkey FROM nation""",
    "rule": """SELECT * EXCLUDE (gone, seq) FROM (SELECT * FROM rule_change QUALIFY row_number() OVER (
        PARTITION BY source_table, operate_type ORDER BY seq DESC) = 1) WHERE NOT gone""",
    # Which columns each kind of change carries decides what is left after the cut.
    "routed": """SELECT c.*, r.sink_type, r.sink_table,
        coalesce(nullif(r.sink_pk, ''), 'id') AS pk, CASE
        WHEN "table" = 'order_info' THEN 'id=' || id || CASE WHEN sink_columns LIKE '%status'
             THEN ',status=' || status ELSE '' END || ',user_id=' || user_id
        WHEN type = 'insert' AND sink_columns LIKE '%name%'
             THEN 'gender=' || gender || ',id=' || id || ',name=' || name
        WHEN type = 'insert' THEN 'gender=' || gender || ',id=' || id || ',segment=' || segment
        WHEN type = 'update' AND sink_columns LIKE '%name%' THEN 'gender=NULL,id=' || id
        WHEN type = 'update' THEN 'gender=NULL,id=' || id || ',segment=CHANGED'
        ELSE '' END AS cut FROM changed c
        JOIN rule r ON c."table" = r.source_table AND c.type = r.operate_type""",
    # the version of the rule that counts at the change's own number
    "rule_version": """SELECT *, lead(seq) OVER (
        PARTITION BY source_table, operate_type ORDER BY seq) AS until FROM rule_change""",
    "search": """SELECT text, make_timestamp((1615766400 + doc_id * 60) * 1000000) AS at_time
        FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0""",
    "entry_word": r"""SELECT DISTINCT word FROM (
        SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS word FROM benchmark)
        WHERE word <> ''""",
}
WORDS = r"unnest(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'))"


def _with(names: str, body: str, **given: str) -> str:
    def piece(name: str) -> str:
        text = CTE[name]
        for key, value in given.items():
            text = text.replace("{" + key + "}", value)
        return f"{name} AS ({text})"
    return "WITH " + ",\n".join(piece(n) for n in names.split()) + "\n" + body


ORDER_SIDE = """order_id, order_price::DOUBLE AS order_price, sku_id, sku_num, sku_name, province_id,
    order_status, user_id, total_amount::DOUBLE AS total_amount,
    0::DOUBLE AS activity_reduce_amount, 0::DOUBLE AS coupon_reduce_amount,
    total_amount::DOUBLE AS original_total_amount, 5::DOUBLE AS feight_fee,
    NULL::DOUBLE AS split_feight_fee, 0::DOUBLE AS split_activity_amount,
    NULL::DOUBLE AS split_coupon_amount, split_total_amount::DOUBLE AS split_total_amount"""
TIMES = """expire_time, create_time, NULL::VARCHAR AS operate_time,
    substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour"""
DIMS = """province_name, area_code AS province_area_code, iso_code AS province_iso_code,
    iso_3166_2 AS province_3166_2_code, user_age, user_gender, spu_id, tm_id, category3_id,
    spu_name, tm_name, category3_name"""
FLAT = "mid, vc, ch, ar, is_new, page_id, last_page_id, item, during_time, ts, seq"

ORDER_JOIN = _with("info detail joined", f"SELECT detail_id, {ORDER_SIDE}, {TIMES} FROM joined")

PROVINCE_STATS = _with("info detail joined provinces", f"""
    SELECT {_window('at_time', '10 seconds')}, province_id, v.name AS province_name,
        v.area_code AS province_area_code, v.iso_code AS province_iso_code,
        v.iso_3166_2 AS province_3166_2_code,
        sum(split_total_amount)::DECIMAL(18,2)::DOUBLE AS order_amount,
        count(DISTINCT order_id) AS order_count, count(*) AS detail_count
    FROM joined LEFT JOIN provinces v ON v.id = province_id GROUP BY ALL""")

# What each stream adds to the product statistics.
PAGE_PARTS = """
    SELECT item::BIGINT AS sku_id, at_time, 1 AS click FROM page
        WHERE page_id = 'good_detail' AND item_type = 'sku_id'
    UNION ALL BY NAME
    SELECT item::BIGINT AS sku_id, make_timestamp(ts * 1000) AS at_time, 1 AS display
        FROM display_row WHERE item_type = 'sku_id'"""
PARTS = f"""{PAGE_PARTS}
    UNION ALL BY NAME
    SELECT event_id % 2000 AS sku_id, date_trunc('second', ts) AS at_time, 1 AS favor
        FROM events WHERE event_type = 'purchase'
    UNION ALL BY NAME
    SELECT event_id % 2000 AS sku_id, date_trunc('second', ts) AS at_time, 1 AS cart
        FROM events WHERE event_type = 'error'
    UNION ALL BY NAME
    SELECT sku_id, at_time, order_id, sku_num, split_total_amount AS amount FROM joined
    UNION ALL BY NAME
    SELECT sku_id, paid_at AS at_time, order_id AS paid_id, split_total_amount AS paid FROM paid
    UNION ALL BY NAME
    SELECT l_partkey AS sku_id, {_placed('l_orderkey', '3600')} AS at_time,
        l_orderkey AS refund_id, {SPLIT} AS refund FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL BY NAME
    SELECT l_partkey AS sku_id, {_placed('l_orderkey', '7200')} AS at_time, 1 AS comment,
        CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS good FROM lineitem"""
COUNTS = """coalesce(sum(display), 0)::BIGINT AS display_ct, coalesce(sum(click), 0)::BIGINT AS click_ct,
    coalesce(sum(favor), 0)::BIGINT AS favor_ct, coalesce(sum(cart), 0)::BIGINT AS cart_ct,
    coalesce(sum(sku_num), 0)::BIGINT AS order_sku_num,
    coalesce(sum(comment), 0)::BIGINT AS comment_ct,
    coalesce(sum(good), 0)::BIGINT AS good_comment_ct"""
AMOUNTS = """coalesce(sum(amount), 0)::DECIMAL(18,2)::DOUBLE AS order_amount,
    coalesce(sum(paid), 0)::DECIMAL(18,2)::DOUBLE AS payment_amount,
    coalesce(sum(refund), 0)::DECIMAL(18,2)::DOUBLE AS refund_amount"""
DISTINCTS = """count(DISTINCT order_id) AS order_ct, count(DISTINCT paid_id) AS paid_order_ct,
    count(DISTINCT refund_id) AS refund_order_ct"""

VISITOR_PARTS = """
    SELECT vc, ch, ar, is_new, at_time, ts, 1 AS pv,
        CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv, during_time AS dur FROM page
    UNION ALL BY NAME SELECT vc, ch, ar, is_new, at_time, ts, 1 AS uv FROM uniques
    UNION ALL BY NAME SELECT vc, ch, ar, is_new, at_time, ts, 1 AS uj FROM jumps"""

CUTS = r"""runs AS (SELECT {group}, run, count(*) AS copies FROM (
        SELECT {group}, """ + WORDS.format("text") + r""" AS run FROM {source}) WHERE run <> '' GROUP BY ALL),
    starts AS (SELECT *, unnest(generate_series(1, length(run))) AS pos FROM runs),
    cuts AS (SELECT {group}, copies, substr(run, pos, n) AS word
        FROM starts, (SELECT DISTINCT length(word) AS n FROM entry_word) WHERE pos + n - 1 <= length(run))"""


def _cuts(group: str, source: str) -> str:
    return CUTS.replace("{group}", group).replace("{source}", source)


KEYWORDS = _with("search", f"""
    SELECT word AS keyword, count(*) AS ct, 'SEARCH' AS source, {_window('at_time', '1 hour')}
    FROM (SELECT {WORDS.format('text')} AS word, at_time FROM search)
    WHERE word <> '' GROUP BY ALL""")

UPSERT_CHANGED = """
    stored AS (SELECT (c_custkey * 2)::VARCHAR AS id FROM customer),
    ins AS (SELECT c.id, c.name, c.segment, c.gender, c.key FROM change c
        WHERE c.type = 'insert' AND "table" LIKE 'table_%'),
    merged AS (SELECT coalesce(i.id, s.id) AS id,
        CASE WHEN i.id IS NULL THEN 'old' ELSE i.name END AS name,
        CASE WHEN i.id IS NULL THEN 'old' WHEN i.key % 10 = 0 THEN 'CHANGED' ELSE i.segment END AS segment,
        CASE WHEN i.id IS NULL THEN 'old' WHEN i.key % 10 = 0 THEN NULL ELSE i.gender END AS gender,
        CASE WHEN s.id IS NOT NULL THEN 'old' END AS extra, i.key
        FROM ins i FULL JOIN stored s ON i.id = s.id)"""

FIRST_PART = "(o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0)"
SECOND_PART = "(o_orderkey % 5 <> 1 AND o_orderkey % 3 <> 1)"
PARTIAL_MONEY = ["coupon_reduce_amount", "activity_reduce_amount", "original_total_amount",
                 "feight_fee", "total_amount", "order_price", "split_activity_amount",
                 "split_coupon_amount", "split_total_amount"]

ORACLE: dict[str, str] = {
    "order_detail_interval_join": ORDER_JOIN,
    "stream_order_join": ORDER_JOIN,
    "order_wide": _with("info detail joined users provinces products wide",
                        f"SELECT detail_id, {ORDER_SIDE}, {TIMES}, {DIMS} FROM wide"),
    "payment_wide": _with(
        "info detail joined users provinces products wide payment paid",
        f"""SELECT payment_id, subject, '1101' AS payment_type, {_text('paid_at')} AS payment_create_time,
        {_text('paid_at')} AS callback_time, detail_id,
        {ORDER_SIDE.replace('order_status, user_id, total_amount::DOUBLE',
                            'order_status, p_user_id AS user_id, p_total_amount::DOUBLE')
                   .replace(' total_amount::DOUBLE AS original', ' total_amount::DOUBLE AS original')},
        create_time AS order_create_time, {DIMS} FROM paid""", source="wide"),
    "untimed_payments": """SELECT o_orderkey + 1000000000 AS id, 'soon' AS create_time FROM orders
        WHERE o_orderstatus <> 'P' AND o_orderkey % 101 = 0""",
    "merge_partial_wide": "SELECT o_orderkey AS order_id, " + ", ".join(
        [f"CASE WHEN {FIRST_PART} OR {SECOND_PART} THEN o_totalprice END AS {c}"
         for c in PARTIAL_MONEY]
        + [f"CASE WHEN {FIRST_PART} THEN o_custkey WHEN {SECOND_PART} THEN o_custkey + 1 END AS {c}"
           for c in ("user_id", "sku_id", "sku_num")]
        + [f"CASE WHEN {FIRST_PART} THEN 'a' WHEN {SECOND_PART} THEN 'b' END || o_orderstatus AS {c}"
           for c in ("order_status", "create_time", "create_date", "sku_name")]) + " FROM orders",
    "order_time_columns": _with("info", """SELECT id, create_time,
        substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour,
        epoch_ms(at_time) AS create_ts FROM info"""),
    "detail_time_column": _with("detail",
                                "SELECT id, sku_id, epoch_ms(at_time) AS create_ts FROM detail"),
    "time_text": _with("info", """SELECT id, epoch_ms(at_time) - 28800000 AS ms,
        create_time AS "text" FROM info"""),
    "user_age": _with("users", f"""SELECT id::VARCHAR AS id, strftime(birthday, '%Y-%m-%d') AS birthday,
        datesub('year', birthday, {AS_OF})::INTEGER AS age FROM users"""),
    "join_user": _with("info users", f"""SELECT i.id, i.user_id,
        datesub('year', birthday, {AS_OF})::INTEGER AS user_age, gender AS user_gender
        FROM info i LEFT JOIN users u ON u.id = i.user_id"""),
    "join_user_inner": _with("info users", f"""SELECT i.id, i.user_id,
        datesub('year', birthday, {AS_OF})::INTEGER AS user_age, gender AS user_gender
        FROM info i JOIN users u ON u.id = i.user_id"""),
    "join_province": _with("info provinces", """SELECT i.id, i.province_id, name AS province_name,
        area_code AS province_area_code, iso_code AS province_iso_code,
        iso_3166_2 AS province_3166_2_code
        FROM info i LEFT JOIN provinces v ON v.id = i.province_id"""),
    "join_product": _with("products", """SELECT l_orderkey AS order_id, l_partkey AS sku_id, sku_name,
        price::DOUBLE AS sku_price, spu_id, spu_name, tm_id, tm_name, category3_id, category3_name
        FROM lineitem LEFT JOIN products ON id = l_partkey WHERE l_returnflag = 'R'"""),
    "dim_lookup": """SELECT p_partkey::VARCHAR AS id, p_name AS "skuName",
        p_retailprice::DECIMAL(18,2)::VARCHAR AS price, (p_partkey % 120)::VARCHAR AS "spuId",
        substr(p_brand, 7) AS "tmId", (p_size % 6)::VARCHAR AS "category3Id"
        FROM part WHERE p_partkey = 17""",
    "province_stats": PROVINCE_STATS,
    "province_stats_clock": f"SELECT stt, edt, province_id, order_count, true AS is_now FROM ({PROVINCE_STATS})",
    "stream_province_stats": PROVINCE_STATS,
    "product_measures": _with("info detail joined payment paid logrow page display_row",
                              f"SELECT sku_id, {COUNTS}, {AMOUNTS} FROM ({PARTS}) GROUP BY sku_id",
                              source="{source}").replace("JOIN {source}", "JOIN joined")
        .replace("FROM {source}", "FROM page"),
    "product_stats": _with("info detail joined payment paid logrow page display_row products", f"""
        SELECT s.*, sku_name, price::DOUBLE AS sku_price, spu_id, spu_name, tm_id, tm_name,
            category3_id, category3_name
        FROM (SELECT {_window('at_time', '1 hour')}, sku_id, {COUNTS}, {AMOUNTS}, {DISTINCTS},
              epoch_ms(min(at_time)) AS ts FROM ({PARTS}) GROUP BY ALL) s
        LEFT JOIN products p ON p.id = s.sku_id""", source="{source}")
        .replace("JOIN {source}", "JOIN joined").replace("FROM {source}", "FROM page"),
    "stream_product_stats": _with("detail logrow page display_row", f"""
        SELECT {_window('at_time', '1 hour')}, sku_id, {COUNTS}, {AMOUNTS}, {DISTINCTS},
            epoch_ms(min(at_time)) AS ts
        FROM (SELECT NULL::BIGINT AS sku_id, NULL::INT AS favor, NULL::INT AS cart, NULL::INT AS comment,
                  NULL::INT AS good, NULL::INT AS paid, NULL::INT AS refund, NULL::INT AS paid_id,
                  NULL::INT AS refund_id WHERE false
              UNION ALL BY NAME {PAGE_PARTS}
              UNION ALL BY NAME SELECT sku_id, at_time, order_id, sku_num,
                  split_total_amount AS amount FROM detail)
        GROUP BY ALL""", source="page"),
    "visitor_measures": _with("logrow page", """SELECT vc, ch, ar, is_new, 0::BIGINT AS uv_ct,
        count(*) AS pv_ct, sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END)::BIGINT AS sv_ct,
        0::BIGINT AS uj_ct, sum(during_time)::BIGINT AS dur_sum FROM page GROUP BY ALL"""),
    "visitor_stats": _with("logrow page entry uniques jumps", f"""
        SELECT {_window('at_time', '1 hour')}, vc, ch, ar, is_new,
            coalesce(sum(uv), 0)::BIGINT AS uv_ct, coalesce(sum(pv), 0)::BIGINT AS pv_ct,
            coalesce(sum(sv), 0)::BIGINT AS sv_ct, coalesce(sum(uj), 0)::BIGINT AS uj_ct,
            coalesce(sum(dur), 0)::BIGINT AS dur_sum, min(ts) AS ts
        FROM ({VISITOR_PARTS}) GROUP BY ALL""", timeout="3600000"),
    "stream_visitor_stats": _with("logrow page entry uniques jumps", f"""
        SELECT {_window('at_time', '1 hour')}, vc, ch, ar, is_new,
            coalesce(sum(uv), 0)::BIGINT AS uv_ct, coalesce(sum(pv), 0)::BIGINT AS pv_ct,
            coalesce(sum(sv), 0)::BIGINT AS sv_ct, coalesce(sum(uj), 0)::BIGINT AS uj_ct,
            coalesce(sum(dur), 0)::BIGINT AS dur_sum, min(ts) AS ts
        FROM ({VISITOR_PARTS}) GROUP BY ALL""", timeout="3600000"),
    "stream_late_pages": _with("logrow page", """SELECT mid, seq, ts, count(*) OVER () AS counted
        FROM page p WHERE (ts // 3600000 + 1) * 3600000 <= (
            SELECT max(ts) - 86400000 FROM page e WHERE e.seq % 4 <= p.seq % 4 - 2)"""),
    "stream_page_stats": _with("logrow page", f"""
        SELECT {_window('at_time', '1 hour')}, vc, ch, ar, is_new, count(*) AS pv_ct,
            sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END)::BIGINT AS sv_ct,
            sum(during_time)::BIGINT AS dur_sum, min(ts) AS ts FROM page GROUP BY ALL"""),
    "keyword_stats": KEYWORDS,
    "keyword_stats_udtf": KEYWORDS,
    "stream_keyword_stats": KEYWORDS.replace(
        "FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0", "FROM documents"),
    "keyword_stats_dictionary": _with("search entry_word", "").rstrip() + ",\n" + _cuts(
        "at_time", "search") + f"""
        SELECT word AS keyword, sum(copies)::BIGINT AS ct, 'SEARCH' AS source,
            {_window('at_time', '1 day')}
        FROM cuts WHERE word IN (SELECT word FROM entry_word) GROUP BY ALL""",
    "search_rows": _with("search",
                         f"SELECT text AS full_words, {_text('at_time')} AS rowtime FROM search"),
    "split_words": f"""SELECT doc_id, word FROM (SELECT doc_id, {WORDS.format('text')} AS word
        FROM documents) WHERE word <> ''""",
    "dictionary_words": _with("entry_word", "").rstrip() + ",\n" + _cuts("lang", "documents") + """
        SELECT lang, word, sum(copies)::BIGINT AS ct FROM cuts
        WHERE word IN (SELECT word FROM entry_word) GROUP BY ALL""",
    "parse_logs": _with("logrow good", """SELECT mid, is_new, page_id, last_page_id, item, during_time,
        n_displays::INTEGER AS n_displays, start, ts, seq FROM good"""),
    # A line cut to 40 characters keeps only the head of its first object.
    "dirty_logs": _with("logrow", """SELECT seq, CASE WHEN seq % 50 = 9 THEN seq::VARCHAR
        ELSE substr('{"common":{"ar":"' || ar || '","ch":"' || ch || '","is_new":"', 1, 40) END AS value
        FROM logrow WHERE seq % 50 IN (7, 9)"""),
    "page_split": _with("logrow good good_page", f"SELECT {FLAT} FROM good_page"),
    "start_split": _with("logrow good", "SELECT mid, start, ts, seq FROM good WHERE start IS NOT NULL"),
    "display_explode": _with("logrow good good_page display_row", """SELECT 'item=' || item
        || ',item_type=' || item_type || ',order=' || place || ',page_id=' || page_id AS display
        FROM display_row""", source="good_page"),
    "new_visitor_flag": _with("logrow", """SELECT seq, mid, ts, CASE WHEN is_new = '1' AND row_number()
        OVER (PARTITION BY mid, is_new ORDER BY ts, seq) > 1 THEN '0' ELSE is_new END AS is_new
        FROM logrow"""),
    "split_logs": _with("logrow good", f"""SELECT {FLAT} FROM (SELECT * REPLACE (
        CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, seq) > 1
        THEN '0' ELSE is_new END AS is_new) FROM good) WHERE start IS NULL"""),
    "log_payload": _with("logrow good", """SELECT mid, is_new, page_id, ts::VARCHAR AS ts,
        CASE WHEN seq % 7 = 0 THEN 'x' END AS sid,
        CASE WHEN seq % 7 = 0 THEN 1.5::DOUBLE END AS action FROM (SELECT * REPLACE (
        CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, seq) > 1
        THEN '0' ELSE is_new END AS is_new) FROM good) WHERE start IS NULL"""),
    "unique_visitor": _with("logrow page entry uniques", f"SELECT {FLAT} FROM uniques"),
    "unique_visitor_utc8": _with("logrow page entry", f"""SELECT {FLAT} FROM entry
        QUALIFY row_number() OVER (PARTITION BY mid, (at_time + INTERVAL 8 HOUR)::DATE
        ORDER BY ts, seq) = 1"""),
    "stream_unique_visitor": _with("logrow page entry", """SELECT DISTINCT mid,
        strftime(at_time, '%Y-%m-%d') AS day FROM entry"""),
    "stream_unique_visitor_busy": _with("logrow busy_page busy_entry", """SELECT DISTINCT mid,
        strftime(at_time, '%Y-%m-%d') AS day, 1 AS n, 1 AS entries FROM busy_entry"""),
    "stream_user_jump_timers": _with("logrow busy_page busy_entry busy_jumps",
                                     f"SELECT {FLAT} FROM busy_jumps", timeout="3600000"),
    "user_jump": _with("logrow page entry jumps", f"SELECT {FLAT} FROM jumps", timeout="3600000"),
    "stream_user_jump": _with("logrow page entry jumps", f"SELECT {FLAT} FROM jumps",
                              timeout="3600000"),
    "user_jump_ten_seconds": _with("logrow page entry jumps", f"SELECT {FLAT} FROM jumps",
                                   timeout="10000"),
    "entry_pages": _with("logrow page entry", f"SELECT {FLAT} FROM entry"),
    "normalise_changes": _with("change changed",
                               'SELECT "database", "table", type, data, seq FROM changed'),
    "capture_records": _with("change changed",
                             'SELECT "database", "table", type, data, seq FROM changed'),
    "parse_changes": _with("change changed", """SELECT "database", "table", type, data, seq
        FROM changed WHERE seq % 40 <> 0"""),
    "nonempty_changes": _with("change changed",
                              'SELECT "table", type, data, seq FROM changed WHERE seq % 16 <> 0'),
    "latest_rules": _with("rule_change rule", "SELECT * FROM rule"),
    "rule_versions": _with("rule_change", "SELECT * EXCLUDE (sink_extend, seq), seq AS since FROM rule_change"),
    "route_asof": _with("change changed rule_change rule_version routed", """SELECT "table", type,
        sink_type, sink_table, pk AS sink_pk, cut AS data, seq FROM routed""").replace(
        "JOIN rule r ON", "JOIN rule_version r ON NOT r.gone AND c.seq >= r.seq AND c.seq < coalesce("
        "r.until, 9223372036854775807) AND"),
    "unrouted_asof": _with("change rule_change rule_version", """SELECT "table", type, seq FROM change c
        WHERE NOT EXISTS (SELECT 1 FROM rule_version r
        WHERE r.source_table = c."table" AND r.operate_type = c.type AND r.sink_type IN ('kafka', 'hbase')
        AND NOT r.gone AND c.seq >= r.seq AND c.seq < coalesce(r.until, 9223372036854775807))"""),
    "route_facts": _with("change changed rule_change rule routed", """SELECT sink_table,
        pk AS sink_pk, cut AS data, seq FROM routed WHERE sink_type = 'kafka'"""),
    "route_dims": _with("change changed rule_change rule routed", """SELECT sink_table,
        pk AS sink_pk, type, cut AS data, seq FROM routed WHERE sink_type = 'hbase'"""),
    "unrouted": _with("change rule_change rule", """SELECT "table", type, seq FROM change c
        WHERE NOT EXISTS (SELECT 1 FROM rule r WHERE r.source_table = c."table"
        AND r.operate_type = c.type AND r.sink_type IN ('kafka', 'hbase'))"""),
    "filter_columns": _with("change", """SELECT seq, CASE
        WHEN seq % 3 <> 0 THEN CASE WHEN segment IS NULL THEN '' ELSE 'segment=' || segment END
        WHEN id IS NULL THEN '' ELSE 'id=' || id || CASE WHEN name IS NULL THEN ''
        ELSE ',name=' || name END END AS data FROM change"""),
    "fact_payload": _with("change changed rule_change rule routed", """SELECT sink_table AS topic, CASE
        WHEN "table" = 'order_info' THEN '{"id":"' || id || '","user_id":"' || user_id ||
             CASE WHEN cut LIKE '%status%' THEN '","status":"' || status ELSE '' END || '"}'
        WHEN type = 'insert' AND cut LIKE '%name%'
             THEN '{"id":"' || id || '","name":"' || name || '","gender":"' || gender || '"}'
        WHEN type = 'insert'
             THEN '{"id":"' || id || '","segment":"' || segment || '","gender":"' || gender || '"}'
        WHEN cut LIKE '%segment%' THEN '{"id":"' || id || '","segment":"CHANGED","gender":null}'
        ELSE '{"id":"' || id || '","gender":null}' END AS value
        FROM routed WHERE sink_type = 'kafka'"""),
    "dim_upsert": _with("change", "").rstrip() + "," + UPSERT_CHANGED + """
        SELECT id, name, segment, gender, extra FROM merged""",
    "dim_upsert_remove": _with("change", "").rstrip() + "," + UPSERT_CHANGED + """
        SELECT id, name, segment, gender, extra FROM merged
        WHERE key IS NULL OR key % 25 <> 0""",
    "dim_upsert_compacted": _with("change", """SELECT id, name,
        CASE WHEN key % 10 = 0 THEN 'CHANGED' ELSE segment END AS segment,
        CASE WHEN key % 10 <> 0 THEN gender END AS gender
        FROM change WHERE type = 'insert' AND "table" LIKE 'table_%' AND key % 25 <> 0"""),
    "dim_upsert_two_rules": _with("change", """SELECT id, name,
        CASE WHEN key % 10 = 0 THEN 'CHANGED' END AS segment, NULL::VARCHAR AS gender
        FROM change WHERE type = 'insert' AND "table" LIKE 'table_%'"""),
    "stream_split_logs": _with("logrow good", """SELECT mid, is_new, page_id, ts FROM (SELECT * REPLACE (
        CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, seq) > 1
        THEN '0' ELSE is_new END AS is_new) FROM good) WHERE start IS NULL"""),
}
ORACLE["stream_route_changes"] = ORACLE["fact_payload"]
ORACLE["stream_payment_wide"] = ORACLE["payment_wide"]
