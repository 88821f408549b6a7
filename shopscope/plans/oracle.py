"""Independent SQL for every registered query (DuckDB dialect).

The stand-in tables are defined again here in plain SQL over the test
tables (pre-registered as views), and each query is written from its
definition, not from the DataFrame code.
"""

from __future__ import annotations

# A payment is a lineitem; its user is the (largest) customer of its order,
# null where there is no order (read back from a line: empty), as on the
# DataFrame side.
_STANDIN = """
WITH shop_info AS (
    SELECT CAST(s_suppkey AS VARCHAR) AS shop_id,
           r_name AS city_name,
           CAST(s_nationkey AS INTEGER) AS location_id,
           CAST(FLOOR(CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal END) AS INTEGER) AS per_pay,
           CAST(p_size % 6 AS INTEGER) AS score,
           CAST(p_size AS INTEGER) AS comment_cnt,
           CAST(p_size % 3 AS INTEGER) AS shop_level,
           p_type AS cate_1_name,
           p_brand AS cate_2_name,
           p_name AS cate_3_name
    FROM supplier
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON p_partkey = s_suppkey
),
pay_raw AS (
    SELECT CAST((SELECT max(o_custkey) FROM orders WHERE o_orderkey = l_orderkey) AS VARCHAR) AS user_id,
           CAST(l_suppkey AS VARCHAR) AS shop_id,
           CAST(l_shipdate AS VARCHAR) AS time_stamp
    FROM lineitem
),
user_pay AS (
    SELECT user_id, shop_id, time_stamp,
           CASE WHEN length(trim(time_stamp)) > 10 THEN substr(trim(time_stamp), 1, 10)
                ELSE time_stamp END AS day
    FROM pay_raw
),
user_view AS (
    SELECT CAST(user_id AS VARCHAR) AS user_id,
           CAST(event_id % (SELECT COUNT(*) FROM supplier) AS VARCHAR) AS shop_id,
           CAST(ts AS VARCHAR) AS time_stamp
    FROM events WHERE event_type = 'view'
),
sel AS (
    SELECT * FROM shop_info
    WHERE (contains(cate_1_name, 'AR') OR contains(cate_2_name, 'AR') OR contains(cate_3_name, 'AR'))
      AND city_name IN ('AFRICA', 'AMERICA', 'ASIA')
),
sel_pay AS (
    SELECT * FROM user_pay WHERE shop_id IN (SELECT shop_id FROM sel)
),
all_dc AS (
    SELECT shop_id, day, COUNT(*) AS n FROM user_pay GROUP BY shop_id, day
),
sel_dc AS (
    SELECT shop_id, day, COUNT(*) AS n FROM sel_pay GROUP BY shop_id, day
),
sel_stats AS (
    SELECT shop_id, MAX(n) AS day_max, CAST(SUM(n) AS BIGINT) AS pay_total, COUNT(*) AS active_days
    FROM sel_dc GROUP BY shop_id
),
sel_pop AS (
    SELECT t.shop_id, s.city_name, s.per_pay,
           (CAST(0.7 AS DOUBLE) * s.score) / 5
             + ((CAST(0.3 AS DOUBLE) * (t.pay_total * CAST(s.per_pay AS BIGINT))) / t.active_days)
               / NULLIF(t.day_max * CAST(s.per_pay AS BIGINT), 0) AS pop
    FROM sel_stats t JOIN sel s ON t.shop_id = s.shop_id
)
"""

_SHOP_COLS = ("shop_id, city_name, location_id, per_pay, score, comment_cnt, shop_level, "
              "cate_1_name, cate_2_name, cate_3_name")

# The files of the file queries hold, beside each row's line, lines derived from
# some rows; here is what the reading rules make of each kind.
_SHOP_LINES = f"""
    SELECT {_SHOP_COLS} FROM shop_info
    UNION ALL
    SELECT 'n' || shop_id, city_name, location_id, per_pay, score, comment_cnt, shop_level, cate_1_name, cate_2_name, ''
    FROM shop_info WHERE location_id % 5 = 0
    UNION ALL
    SELECT 'b' || shop_id, city_name, 0, per_pay, 0, 0, shop_level, cate_1_name, '', cate_3_name
    FROM shop_info WHERE location_id % 3 = 0"""

_QUERIES = {
    "shop_file_rows": _SHOP_LINES,
    "shop_file_exact_fields": f"SELECT * FROM ({_SHOP_LINES}) WHERE shop_id[1] <> 'n'",
    "shop_file_quarantine": """
        SELECT concat_ws(',', 'e' || shop_id, city_name, location_id, per_pay, score, comment_cnt, shop_level, cate_1_name) AS line,
               '8 fields' AS reason FROM shop_info WHERE location_id % 4 = 0
        UNION ALL
        SELECT concat_ws(',', 'x' || shop_id, city_name, location_id, '12x', score, comment_cnt, shop_level, cate_1_name, cate_2_name, cate_3_name),
               'not an integer: per_pay' FROM shop_info WHERE location_id % 4 = 1
        UNION ALL
        SELECT '', 'blank line' FROM shop_info WHERE shop_level = 0""",
    "pay_file_rows": """
        SELECT coalesce(user_id, '') AS user_id, shop_id,
               CASE WHEN day LIKE '%7' THEN chr(9) ELSE '' END || time_stamp AS time_stamp, day FROM user_pay""",
    "view_file_rows": "SELECT user_id, shop_id, time_stamp FROM user_view",
    "shop_file_json": f"""
        SELECT {_SHOP_COLS} FROM shop_info
        UNION ALL
        SELECT 'k' || shop_id, '', 0, per_pay, 0, 0, 0, cate_1_name, '', '' FROM shop_info WHERE location_id % 3 = 0""",
    "pay_file_json": """
        SELECT coalesce(user_id, '') AS user_id, shop_id, time_stamp, day, NULL::VARCHAR AS _bad FROM user_pay
        UNION ALL SELECT '', '', '', '', 'payment at ' || shop_id FROM user_pay WHERE day LIKE '%15'
        UNION ALL SELECT '', '', '', '', '' FROM user_pay WHERE day LIKE '%25'""",
    "view_file_json": "SELECT user_id, shop_id, time_stamp FROM user_view",
    "view_days_sql": "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY ALL",
    "closed_gate_pays": """
        SELECT user_id, shop_id, time_stamp, day FROM user_pay
        WHERE EXISTS (SELECT 1 FROM shop_info WHERE cate_1_name = 'LARGE' AND city_name = 'NOWHERE')""",
    "popularity_top3_per_city": """
        SELECT city_name, CAST(rank AS INTEGER) AS rank, shop_id FROM (
            SELECT *, row_number() OVER (PARTITION BY city_name ORDER BY CASE per_pay WHEN 0 THEN 'NaN'::DOUBLE ELSE pop END DESC, shop_id) AS rank
            FROM sel_pop)
        WHERE rank <= 3""",
    "shop_info_typed": f"SELECT {_SHOP_COLS} FROM shop_info",
    "shop_info_json": f"SELECT {_SHOP_COLS} FROM shop_info",
    "user_pay_daily": "SELECT coalesce(user_id, '') AS user_id, shop_id, time_stamp, day FROM user_pay",
    "user_pay_json": "SELECT coalesce(user_id, '') AS user_id, shop_id, time_stamp, day FROM user_pay",
    "user_view_log": "SELECT user_id, shop_id, time_stamp FROM user_view",
    "user_view_json": "SELECT user_id, shop_id, time_stamp FROM user_view",
    "shop_info_exact_fields": f"SELECT {_SHOP_COLS} FROM shop_info WHERE cate_3_name <> ''",
    "epoch_to_day": """
        SELECT event_id, epoch_s,
               CAST(CAST(make_timestamp(epoch_s * 1000000) AS DATE) AS VARCHAR) AS day
        FROM (SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS epoch_s FROM events) e""",
    "keyword_shops": f"""
        SELECT {_SHOP_COLS} FROM shop_info
        WHERE contains(cate_1_name, 'AR') OR contains(cate_2_name, 'AR') OR contains(cate_3_name, 'AR')""",
    "city_shops": f"SELECT {_SHOP_COLS} FROM shop_info WHERE city_name IN ('AFRICA', 'AMERICA', 'ASIA')",
    "selected_shops": f"SELECT {_SHOP_COLS} FROM sel",
    "selected_pays": "SELECT user_id, shop_id, time_stamp, day FROM sel_pay",
    "exists_gate_pays": """
        SELECT user_id, shop_id, time_stamp, day FROM user_pay
        WHERE EXISTS (SELECT 1 FROM shop_info WHERE cate_1_name = 'LARGE'
                      AND city_name IN ('AFRICA', 'AMERICA', 'ASIA'))""",
    "shop_with_pay_count": f"""
        SELECT {', '.join('s.' + c.strip() for c in _SHOP_COLS.split(','))}, c.pay_count
        FROM shop_info s
        JOIN (SELECT shop_id, COUNT(*) AS pay_count FROM user_pay GROUP BY shop_id) c
          ON s.shop_id = c.shop_id""",
    "shop_with_pay_day": f"""
        SELECT {', '.join('s.' + c.strip() for c in _SHOP_COLS.split(','))}, p.day
        FROM shop_info s JOIN user_pay p ON s.shop_id = p.shop_id""",
    "shop_pay_count": "SELECT shop_id, COUNT(*) AS pay_count FROM user_pay GROUP BY shop_id",
    "shop_day_count": "SELECT shop_id, day, n FROM all_dc",
    "shop_day_max": "SELECT shop_id, MAX(n) AS day_max FROM all_dc GROUP BY shop_id",
    "shop_pay_total": "SELECT shop_id, CAST(SUM(n) AS BIGINT) AS pay_total FROM all_dc GROUP BY shop_id",
    "shop_active_days": "SELECT shop_id, COUNT(*) AS active_days FROM all_dc GROUP BY shop_id",
    "shop_day_stats": """
        SELECT shop_id, MAX(n) AS day_max, CAST(SUM(n) AS BIGINT) AS pay_total, COUNT(*) AS active_days
        FROM all_dc GROUP BY shop_id""",
    "shop_pay_days_list": """
        SELECT shop_id,
               string_agg(day || ':' || CAST(n AS VARCHAR), ',' ORDER BY day) AS day_list,
               CAST(SUM(n) AS BIGINT) AS n_pays,
               COUNT(*) AS n_days
        FROM all_dc GROUP BY shop_id""",
    "shop_visit_stats": """
        SELECT shop_id, COUNT(*) AS visits, COUNT(DISTINCT day) AS distinct_days
        FROM user_pay GROUP BY shop_id""",
    "shop_day_revenue": """
        SELECT p.shop_id, p.day, CAST(SUM(CAST(s.per_pay AS BIGINT)) AS BIGINT) AS revenue
        FROM sel_pay p JOIN sel s ON p.shop_id = s.shop_id
        GROUP BY p.shop_id, p.day""",
    "shop_revenue_stats": """
        SELECT shop_id, MAX(revenue) AS max_day_revenue, CAST(SUM(revenue) AS BIGINT) AS total_revenue,
               COUNT(*) AS active_days
        FROM (SELECT p.shop_id, p.day, CAST(SUM(CAST(s.per_pay AS BIGINT)) AS BIGINT) AS revenue
              FROM sel_pay p JOIN sel s ON p.shop_id = s.shop_id
              GROUP BY p.shop_id, p.day) r
        GROUP BY shop_id""",
    "shop_day_count_rows": "SELECT COUNT(*) AS n_rows FROM all_dc",
    "shop_turnover_top10": """
        SELECT rank, shop_id, turnover FROM (
            SELECT shop_id, turnover,
                   CAST(ROW_NUMBER() OVER (ORDER BY turnover DESC, shop_id ASC) AS INTEGER) AS rank
            FROM (SELECT s.shop_id, c.pay_count * CAST(s.per_pay AS BIGINT) AS turnover
                  FROM shop_info s
                  JOIN (SELECT shop_id, COUNT(*) AS pay_count FROM user_pay GROUP BY shop_id) c
                    ON s.shop_id = c.shop_id) t
        ) r WHERE rank <= 10""",
    "shop_avg_daily_turnover_top10": """
        SELECT rank, shop_id, avg_daily_turnover FROM (
            SELECT shop_id, avg_daily_turnover,
                   CAST(ROW_NUMBER() OVER (ORDER BY avg_daily_turnover DESC, shop_id ASC) AS INTEGER) AS rank
            FROM (SELECT s.shop_id,
                         CAST(d.total * CAST(s.per_pay AS BIGINT) AS DOUBLE) / d.days AS avg_daily_turnover
                  FROM shop_info s
                  JOIN (SELECT shop_id, CAST(SUM(n) AS BIGINT) AS total, COUNT(*) AS days
                        FROM all_dc GROUP BY shop_id) d
                    ON s.shop_id = d.shop_id) t
        ) r WHERE rank <= 10""",
    "popularity_score": """
        SELECT shop_id, city_name, CASE WHEN per_pay = 0 THEN NULL ELSE pop END AS popularity
        FROM sel_pop""",
    "popularity_top10": """
        SELECT rank, shop_id FROM (
            SELECT shop_id,
                   CAST(ROW_NUMBER() OVER (ORDER BY CASE WHEN per_pay = 0 THEN 'NaN'::DOUBLE ELSE pop END DESC,
                                               shop_id ASC) AS INTEGER) AS rank
            FROM sel_pop
        ) r WHERE rank <= 10""",
    "popularity_top10_per_city": """
        SELECT city_name, rank, shop_id FROM (
            SELECT shop_id, city_name,
                   CAST(ROW_NUMBER() OVER (PARTITION BY city_name
                                      ORDER BY CASE WHEN per_pay = 0 THEN 'NaN'::DOUBLE ELSE pop END DESC,
                                               shop_id ASC) AS INTEGER) AS rank
            FROM sel_pop
        ) r WHERE rank <= 10""",
    "popularity_score_integer": """
        SELECT v.shop_id,
               CASE WHEN s.per_pay = 0 THEN NULL ELSE
                 CAST(0.7 AS DOUBLE) * (CAST(s.per_pay AS BIGINT) // 5)
                 + CAST(0.3 AS DOUBLE) * (((v.visits * CAST(s.per_pay AS BIGINT)) // v.distinct_days)
                                          // NULLIF(m.day_max * CAST(s.per_pay AS BIGINT), 0))
               END AS popularity_int
        FROM (SELECT shop_id, COUNT(*) AS visits, COUNT(DISTINCT day) AS distinct_days
              FROM sel_pay GROUP BY shop_id) v
        JOIN sel s ON v.shop_id = s.shop_id
        JOIN (SELECT shop_id, MAX(n) AS day_max FROM sel_dc GROUP BY shop_id) m ON v.shop_id = m.shop_id""",
    "popularity_score_simplified": """
        SELECT t.shop_id,
               (CAST(0.7 AS DOUBLE) * s.score) / 5
                 + (CAST(0.3 AS DOUBLE) * (CAST(t.pay_total AS DOUBLE) / t.active_days)) / t.day_max
                 AS popularity_simplified
        FROM sel_stats t JOIN sel s ON t.shop_id = s.shop_id""",
    "popularity_sql": """
        SELECT s.shop_id,
               CAST(0.7 AS DOUBLE) * (s.score / 5)
                 + CAST(0.3 AS DOUBLE) * ((s.per_pay * CAST(list_sum(a.daily) AS BIGINT) / len(a.daily))
                                          / NULLIF(s.per_pay * list_max(a.daily), 0)) AS popularity
        FROM shop_info s, (
            SELECT key.shop_id, list(n) AS daily
            FROM (SELECT {'shop_id': shop_id, 'day': left(time_stamp, 10)} AS key, count(*) AS n FROM pay_raw GROUP BY 1)
            GROUP BY 1
        ) a, (SELECT bool_or(cate_1_name = 'LARGE' AND city_name IN ('AFRICA', 'AMERICA', 'ASIA')) AS open FROM shop_info) g
        WHERE s.shop_id = a.shop_id AND g.open""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _STANDIN + body for name, body in _QUERIES.items()}
