"""DuckDB SQL of the stage tables, composed into the queries' counterparts."""

from __future__ import annotations

from marketloom.fixtures import HISTORY_END
from marketloom.plans.content import CATEGORICAL, NUMERIC


def r6(expr: str, name: str | None = None) -> str:
    """Rounded to 6 decimals, without negative zero."""
    return f"round(({expr})::DOUBLE, 6) + 0.0e0" + (f" AS {name}" if name else "")


def when(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')" + (f" AS {name}" if name else "")


def mm(expr: str, lo: str, hi: str) -> str:
    """Min-max scaling; 0 for a constant column."""
    return f"CASE WHEN {expr} IS NULL THEN NULL WHEN {hi} = {lo} THEN 0.0e0 ELSE ({expr} - {lo})::DOUBLE / ({hi} - {lo}) END"


# categories and subcategories of the generated part table, in order
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SUBCATEGORIES = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
STRENGTH = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'add_to_cart' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END::BIGINT"
HOT = ", ".join(
    [f"(coalesce(category = '{c}', false))::BIGINT AS cat_{c}" for c in CATEGORIES]
    + [f"(coalesce(subcategory = '{c}', false))::BIGINT AS subcat_{c}" for c in SUBCATEGORIES]
)
EVENT_COLUMNS = """user_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
 CASE event_type WHEN 'signup' THEN 'add_to_cart' ELSE event_type END AS event_type,
 CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS duration_seconds"""

USER_ATTRIBUTES = ["age", "age_scaled", "location_city", "location_country", "tier"]
PRODUCT_ATTRIBUTES = [
    "category_id", "category", "subcategory_id", "subcategory", "brand", "price", "price_scaled",
    "rating_avg", "rating_count", "rating_count_log", "stock_quantity_scaled",
]


def first_known(column: str) -> str:
    return f"first({column} ORDER BY timestamp, {column}) FILTER (WHERE {column} IS NOT NULL) AS {column}"


def users_of(source: str) -> str:
    return f"""SELECT b.*, preferred_category, category_confidence FROM (
  SELECT user_id, count(*) AS interaction_count, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
   min(timestamp) AS first_at, max(timestamp) AS last_at, {', '.join(map(first_known, USER_ATTRIBUTES))}
  FROM {source} GROUP BY user_id) b
 LEFT JOIN (SELECT user_id, first(category ORDER BY n DESC, category) AS preferred_category,
   max(n)::DOUBLE / sum(n)::DOUBLE AS category_confidence
  FROM (SELECT user_id, category, count(*) AS n FROM {source} WHERE category IS NOT NULL GROUP BY ALL) GROUP BY user_id) c
 USING (user_id)"""


def finish_users(source: str) -> str:
    days = "(CASE WHEN last_at = first_at THEN 1.0e0 ELSE (last_at - first_at) / 86400.0e0 END)"
    return f"""SELECT user_id, coalesce(age, -1)::DOUBLE AS age, coalesce(age_scaled, 0) AS age_scaled,
 {', '.join(f"coalesce({c}, 'Unknown') AS {c}" for c in USER_ATTRIBUTES[2:])}, interaction_count::BIGINT AS interaction_count,
 interaction_count / {days} AS activity_frequency, purchases / interaction_count::DOUBLE AS purchase_ratio,
 make_timestamp(first_at * 1000000) AS first_interaction, make_timestamp(last_at * 1000000) AS last_interaction,
 coalesce(preferred_category, 'Unknown') AS preferred_category, coalesce(category_confidence, 0) AS category_confidence,
 TIMESTAMP '2025-01-01' AS created_at, TIMESTAMP '2025-01-01' AS updated_at FROM ({source})"""


def products_of(source: str) -> str:
    return f"""SELECT product_id, count(*) AS interaction_count, count(DISTINCT user_id) AS unique_users,
 count(*) FILTER (WHERE event_type = 'purchase') AS purchases, {', '.join(map(first_known, PRODUCT_ATTRIBUTES))}
 FROM {source} GROUP BY product_id"""


def finish_products(source: str) -> str:
    return f"""SELECT product_id, coalesce(category_id, 0)::BIGINT AS category_id, coalesce(category, 'Unknown') AS category,
 coalesce(subcategory_id, 0)::BIGINT AS subcategory_id, coalesce(subcategory, 'Unknown') AS subcategory,
 coalesce(brand, 'Unknown') AS brand, coalesce(price, 0) AS price, coalesce(price_scaled, 0) AS price_scaled,
 coalesce(rating_avg, 0) AS rating_avg, coalesce(rating_count, 0)::BIGINT AS rating_count,
 coalesce(rating_count_log, 0) AS rating_count_log, coalesce(stock_quantity_scaled, 0) AS stock_quantity_scaled,
 interaction_count::BIGINT AS interaction_count, unique_users::BIGINT AS unique_users,
 interaction_count::DOUBLE / max(interaction_count) OVER () AS popularity_score,
 purchases::DOUBLE / interaction_count AS conversion_rate, unique_users::DOUBLE / interaction_count AS diversity_score,
 TIMESTAMP '2025-01-01' AS created_at, TIMESTAMP '2025-01-01' AS updated_at FROM ({source})"""


def merged(old: str, new: str, key: str, sums: list[str], lasts: list[str], extra: str = "") -> str:
    """Two batches added up; attributes take the newest known value."""
    cols = ", ".join(
        [f"coalesce(o.{c}, 0) + coalesce(n.{c}, 0) AS {c}" for c in sums]
        + [f"coalesce(n.{c}, o.{c}) AS {c}" for c in lasts]
    )
    return f"SELECT {key}, {cols}{extra} FROM ({old}) o FULL JOIN ({new}) n USING ({key})"


def interactions_of(source: str) -> str:
    return f"""SELECT user_id, product_id, interaction_count, implicit_score,
 sin(2 * pi() * hour(m) / 24) AS hour_sin, cos(2 * pi() * hour(m) / 24) AS hour_cos,
 sin(2 * pi() * (isodow(m) - 1) / 7) AS day_sin, cos(2 * pi() * (isodow(m) - 1) / 7) AS day_cos, duration_scaled,
 coalesce((us - lag(us) OVER (PARTITION BY user_id, product_id ORDER BY us)) // 1000000, 0)::BIGINT AS time_since_last_seconds,
 interaction_date, TIMESTAMP '2025-01-01' AS created_at
 FROM (SELECT *, make_timestamp(us) AS m FROM (
  SELECT user_id, product_id, make_timestamp(timestamp * 1000000)::DATE AS interaction_date, count(*) AS interaction_count,
   sum(event_strength)::DOUBLE AS implicit_score, avg(duration_scaled) AS duration_scaled,
   ((sum(timestamp) // count(*)) * 1000000 + ((sum(timestamp) % count(*)) * 1000000) // count(*))::BIGINT AS us
  FROM {source} GROUP BY ALL))"""


SPLIT_BUCKET = "('0x' || substr(md5(concat_ws(':', user_id, product_id, interaction_date)), 1, 8))::BIGINT % 100"
_scaled = {c: mm(f"coalesce({c}, 0)", f"min(coalesce({c}, 0)) OVER ()", f"max(coalesce({c}, 0)) OVER ()") for c in NUMERIC}

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_interactions": (
        (),
        f"SELECT {EVENT_COLUMNS} FROM events UNION ALL SELECT {EVENT_COLUMNS} FROM events WHERE event_id % 50 = 0",
    ),
    "raw_profiles": (
        (),
        """SELECT CASE WHEN c_custkey % 10 = 9 THEN c_custkey + 1000000000 ELSE c_custkey END AS user_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 18 + c_custkey % 63 END AS age,
 n_name AS location_city, r_name AS location_country,
 CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'premium' ELSE 'basic' END AS tier
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "raw_catalog": (
        (),
        """SELECT CASE WHEN p_partkey % 25 = 24 THEN p_partkey + 1000000000 ELSE p_partkey END AS product_id, p_name AS product_name, length(p_type) AS category_id, p_type AS category,
 length(split_part(p_name, ' ', 2)) AS subcategory_id, split_part(p_name, ' ', 2) AS subcategory, p_brand AS brand,
 CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice END AS price, 1.0E0 + (p_size % 9) / 2.0E0 AS rating_avg,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE (p_size * 3)::BIGINT END AS rating_count,
 CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_size::BIGINT END AS stock_quantity FROM part""",
    ),
    "raw_order_interactions": (
        (),
        """SELECT o_custkey AS user_id, l_partkey AS product_id,
 CASE WHEN l_returnflag = 'R' THEN 'view' WHEN l_returnflag = 'A' THEN 'click' WHEN l_linestatus = 'F' THEN 'add_to_cart' ELSE 'purchase' END AS event_type,
 CAST(floor(epoch(l_shipdate)) AS BIGINT) AS timestamp, l_quantity AS duration_seconds
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "raw_runs": (
        (),
        """SELECT *, CASE WHEN status <> 'RUNNING' THEN start_time + to_seconds(k % 5000) END AS end_time FROM (
 SELECT o_orderkey AS k, 'run-' || o_orderkey AS run_id,
 CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
 o_orderdate + to_seconds(o_orderkey % 86400) AS start_time,
 CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0 THEN (o_orderkey * 7919 % 1000) / 1000.0e0 END AS c_hr,
 CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey * 7919 % 1000) / 1000.0e0 / 10.0e0 END AS c_pr,
 CASE WHEN o_orderkey % 2 <> 0 AND o_orderkey % 5 <> 0 THEN (o_orderkey * 7919 % 1000) / 1000.0e0 END AS s_hr,
 CASE WHEN o_orderkey % 2 <> 0 THEN (o_orderkey * 7919 % 1000) / 1000.0e0 / 10.0e0 END AS s_pr,
 CASE WHEN o_orderkey % 10 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'content' ELSE 'svd' END END AS model_type,
 o_orderpriority AS clerk FROM orders)""",
    ),
    "cur_interactions": (
        ("raw_interactions",),
        f"""SELECT f.*, {STRENGTH} AS event_strength, make_timestamp(timestamp * 1000000) AS dt,
 hour(make_timestamp(timestamp * 1000000)) AS hour_of_day, isodow(make_timestamp(timestamp * 1000000)) - 1 AS day_of_week,
 hour(make_timestamp(timestamp * 1000000)) / 23.0e0 AS hour_norm,
 (isodow(make_timestamp(timestamp * 1000000)) - 1) / 6.0e0 AS day_norm,
 {mm("duration_seconds", "min(duration_seconds) OVER ()", "max(duration_seconds) OVER ()")} AS duration_scaled
 FROM (SELECT user_id, product_id, event_type, timestamp, coalesce(duration_seconds, 0) AS duration_seconds
  FROM (SELECT DISTINCT * FROM raw_interactions WHERE user_id IS NOT NULL AND product_id IS NOT NULL)) f""",
    ),
    "cur_profiles": (
        ("raw_profiles",),
        f"""SELECT *, (tier = 'basic')::BIGINT AS tier_basic, (tier = 'premium')::BIGINT AS tier_premium,
 {mm("age", "min(age) OVER ()", "max(age) OVER ()")} AS age_scaled
 FROM (SELECT * REPLACE (coalesce(age, median(age) OVER ())::DOUBLE AS age) FROM (SELECT DISTINCT * FROM raw_profiles))""",
    ),
    "cur_catalog": (
        ("raw_catalog",),
        f"""SELECT *, {HOT}, {mm("price", "min(price) OVER ()", "max(price) OVER ()")} AS price_scaled,
 {mm("stock_quantity", "min(stock_quantity) OVER ()", "max(stock_quantity) OVER ()")} AS stock_quantity_scaled,
 ln(1 + rating_count) AS rating_count_log
 FROM (SELECT * REPLACE (coalesce(price, median(price) OVER ()) AS price, coalesce(stock_quantity, 0) AS stock_quantity,
  coalesce(rating_count, 0) AS rating_count) FROM (SELECT DISTINCT * FROM raw_catalog))""",
    ),
    "curated": (
        ("cur_interactions", "cur_profiles", "cur_catalog"),
        "SELECT * FROM cur_interactions LEFT JOIN cur_profiles USING (user_id) LEFT JOIN cur_catalog USING (product_id)",
    ),
    "curated_old": (("curated",), f"SELECT * FROM curated WHERE timestamp < {HISTORY_END}"),
    "curated_new": (("curated",), f"SELECT * FROM curated WHERE timestamp >= {HISTORY_END}"),
    "user_features": (("curated",), finish_users(users_of("curated"))),
    "product_features": (("curated",), finish_products(products_of("curated"))),
    "interaction_features": (("curated",), interactions_of("curated")),
    "train": (("interaction_features",), f"SELECT * FROM interaction_features WHERE {SPLIT_BUCKET} >= 30"),
    "test": (("interaction_features",), f"SELECT * FROM interaction_features WHERE {SPLIT_BUCKET} < 30"),
    "item_vectors": (
        ("product_features",),
        " UNION ALL ".join(
            [f"SELECT product_id, '{c}' AS dim, {e} AS value FROM product_features" for c, e in _scaled.items()]
            + [f"SELECT product_id, '{c}=' || coalesce({c}, 'None') AS dim, 1.0e0 AS value FROM product_features" for c in CATEGORICAL]
        ),
    ),
    "user_profiles_cb": (
        ("item_vectors", "train"),
        """SELECT user_id, dim, sum(w * value) / any_value(total) AS value FROM (
 SELECT t.user_id, t.product_id, t.implicit_score AS w, sum(t.implicit_score) OVER (PARTITION BY t.user_id) AS total
 FROM train t WHERE t.product_id IN (SELECT product_id FROM item_vectors)) JOIN item_vectors USING (product_id)
 WHERE total > 0 GROUP BY user_id, dim""",
    ),
    "content_scores": (
        ("user_profiles_cb", "item_vectors"),
        """SELECT user_id, product_id, round(coalesce(d, 0) / nullif(un * pn, 0), 9) AS score FROM
 (SELECT user_id, sqrt(sum(value * value)) AS un FROM user_profiles_cb GROUP BY 1)
 CROSS JOIN (SELECT product_id, sqrt(sum(value * value)) AS pn FROM item_vectors GROUP BY 1)
 LEFT JOIN (SELECT user_id, product_id, sum(u.value * p.value) AS d FROM user_profiles_cb u JOIN item_vectors p USING (dim) GROUP BY 1, 2)
 USING (user_id, product_id)""",
    ),
    "content_recs": (
        ("content_scores", "train"),
        """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS rank FROM content_scores
 ANTI JOIN train USING (user_id, product_id) QUALIFY rank <= 10""",
    ),
    # the two leading singular vectors by power iteration on A'A, held as a list of lists
    "svd_m": (("train",), "SELECT user_id, product_id, sum(implicit_score)::DOUBLE AS score FROM train GROUP BY 1, 2"),
    "svd_items": (("svd_m",), "SELECT product_id, row_number() OVER (ORDER BY product_id) AS i FROM (SELECT DISTINCT product_id FROM svd_m)"),
    "svd_mi": (("svd_items",), "SELECT user_id, i, score FROM svd_m JOIN svd_items USING (product_id)"),
    "svd_pairs": (("svd_mi",), "SELECT a.i, b.i AS j, sum(a.score * b.score) AS s FROM svd_mi a JOIN svd_mi b USING (user_id) GROUP BY 1, 2"),
    "svd_dense": (
        ("svd_pairs",),
        """SELECT list(r ORDER BY i) AS g FROM (SELECT x.i, list(coalesce(s, 0.0e0) ORDER BY y.i) AS r
 FROM svd_items x CROSS JOIN svd_items y LEFT JOIN svd_pairs p ON x.i = p.i AND y.i = p.j GROUP BY 1)""",
    ),
    "svd_one": (
        ("svd_dense",),
        """SELECT 0 AS n, [1.0e0 FOR r IN g] AS v FROM svd_dense UNION ALL
 SELECT n + 1, [x / sqrt(list_dot_product(w, w)) FOR x IN w] FROM (SELECT n, [list_dot_product(r, v) FOR r IN g] AS w FROM svd_one, svd_dense WHERE n < 200)""",
    ),
    "svd_first": (("svd_one",), "SELECT v AS v1, sqrt(list_dot_product(v, [list_dot_product(r, v) FOR r IN g])) AS s1 FROM svd_one, svd_dense WHERE n = 200"),
    # A'A without its first direction
    "svd_rest": (("svd_first",), "SELECT [[g[i][j] - s1 * s1 * v1[i] * v1[j] FOR j IN range(1, len(g) + 1)] FOR i IN range(1, len(g) + 1)] AS h FROM svd_first, svd_dense"),
    "svd_two": (
        ("svd_rest",),
        """SELECT 0 AS n, [1.0e0 + i % 7 FOR i IN range(len(h))] AS v FROM svd_rest UNION ALL
 SELECT n + 1, [x / sqrt(list_dot_product(w, w)) FOR x IN w] FROM (SELECT n, [list_dot_product(r, v) FOR r IN h] AS w FROM svd_two, svd_rest WHERE n < 1500)""",
    ),
    "svd_second": (("svd_two",), "SELECT v AS v2, sqrt(list_dot_product(v, [list_dot_product(r, v) FOR r IN h])) AS s2 FROM svd_two, svd_rest WHERE n = 1500"),
    "svd_v": (("svd_second",), "SELECT product_id, i, v1[i] AS x, v2[i] AS y FROM svd_items, svd_first, svd_second"),
    "svd_u": (("svd_v",), "SELECT user_id, sum(score * x) AS x, sum(score * y) AS y FROM svd_mi JOIN svd_v USING (i) GROUP BY 1"),
    "svd_predicted": (
        ("svd_u", "test"),
        """SELECT t.user_id, t.product_id, t.implicit_score, coalesce(u.x * v.x + u.y * v.y, 0) AS prediction
 FROM test t LEFT JOIN svd_u u USING (user_id) LEFT JOIN svd_v v USING (product_id)""",
    ),
    "svd_recs": (
        ("svd_u",),
        """SELECT user_id, product_id, round(u.x * v.x + u.y * v.y, 9) AS score,
 row_number() OVER (PARTITION BY user_id ORDER BY round(u.x * v.x + u.y * v.y, 9) DESC, product_id) AS rank
 FROM svd_u u CROSS JOIN svd_v v ANTI JOIN svd_m USING (user_id, product_id) QUALIFY rank <= 10""",
    ),
}


def with_(body: str, *names: str) -> str:
    """``body`` preceded by the stage tables it names and those they need."""
    needed: list[str] = []

    def add(name: str) -> None:
        for dep in CTES[name][0]:
            add(dep)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    # the steps of the iteration would compute what they read again and again
    kept = lambda n: "MATERIALIZED " if n.startswith("svd_") else ""
    prelude = ",\n".join(f"{n} AS {kept(n)}({CTES[n][1]})" for n in needed)
    recursive = "RECURSIVE " if "svd_one" in needed else ""
    return f"WITH {recursive}{prelude}\n{body}" if needed else body
