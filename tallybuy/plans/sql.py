"""Building blocks of the check SQL: the driver tables as log, pairs, profile."""

from __future__ import annotations

_PARTS = {
    "log_all": """
        SELECT o_custkey AS user_id, l_partkey AS item_id,
               CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS BIGINT) AS cat_id,
               l_suppkey AS seller_id, CAST(substr(p_brand, 7) AS INTEGER) AS brand_id,
               CAST(month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS time_stamp,
               CAST((l_orderkey * 7 + l_linenumber) % 4 AS INTEGER) AS action_type,
               CAST(o_orderdate AS DATE) AS event_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "dated_log": "SELECT * FROM log_all WHERE event_date < DATE '2000-01-01'",
    "acts": "SELECT * EXCLUDE (event_date) FROM dated_log",
    "raw_log": """
        SELECT * REPLACE (CASE WHEN item_id % 97 = 0 THEN NULL ELSE brand_id END AS brand_id) FROM acts""",
    "pairs": """
        SELECT DISTINCT user_id, seller_id, (user_id * 7 + seller_id * 13) % 4 = 0 AS is_test
        FROM acts WHERE action_type = 2 AND time_stamp BETWEEN 1101 AND 1130""",
    "came_back": "SELECT DISTINCT user_id, seller_id FROM log_all WHERE event_date >= DATE '2000-01-01'",
    "labelled": """
        SELECT p.user_id, p.seller_id, CAST(r.user_id IS NOT NULL AS INTEGER) AS label
        FROM pairs p LEFT JOIN came_back r ON p.user_id = r.user_id AND p.seller_id = r.seller_id
        WHERE NOT p.is_test""",
    "unlabelled": "SELECT user_id, seller_id FROM pairs WHERE is_test",
    "raw_profile": """
        SELECT c_custkey AS user_id,
               CAST(CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_nationkey % 9 END AS INTEGER) AS age_range,
               CAST(CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_custkey % 3 END AS INTEGER) AS gender
        FROM customer""",
    "profile": """
        SELECT user_id, coalesce(age_range, 0) AS age_range, coalesce(gender, 2) AS gender FROM raw_profile""",
    "format2": """
        SELECT user_id, seller_id AS merchant_id,
               CAST(CASE WHEN (user_id + seller_id) % 5 = 0 THEN -1 ELSE label END AS INTEGER) AS label
        FROM labelled""",
    "scores": """
        SELECT k AS source, user_id, seller_id,
               ((user_id * a + seller_id * b) % 997 + 1) / 999.0::DOUBLE AS prob
        FROM unlabelled CROSS JOIN (VALUES (1, 31, 17), (2, 13, 101), (3, 7, 59)) AS f(k, a, b)""",
}

_NEEDS = {
    "dated_log": ["log_all"],
    "acts": ["dated_log"],
    "raw_log": ["acts"],
    "pairs": ["acts"],
    "came_back": ["log_all"],
    "labelled": ["pairs", "came_back"],
    "unlabelled": ["pairs"],
    "profile": ["raw_profile"],
    "format2": ["labelled"],
    "scores": ["unlabelled"],
}


def _closure(names: tuple[str, ...]) -> list[str]:
    wanted: set[str] = set()
    stack = list(names)
    while stack:
        name = stack.pop()
        if name not in wanted:
            wanted.add(name)
            stack.extend(_NEEDS.get(name, []))
    return [name for name in _PARTS if name in wanted]


def over(*names: str, body: str, **more: str) -> str:
    """``WITH`` the named parts (and what they need), extra CTEs, then ``body``."""
    ctes = [f"{name} AS ({_PARTS[name].strip()})" for name in _closure(names)]
    ctes += [f"{name} AS ({text.strip()})" for name, text in more.items()]
    return f"WITH {', '.join(ctes)}\n{body.strip()}" if ctes else body.strip()
