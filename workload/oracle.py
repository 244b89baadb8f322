"""The same queries in SQL, over views of the driver tables."""

from __future__ import annotations

from prismcube.contract import CUBE_DIMENSIONS, SALES

from .queries import CODED, DIMS, ORDER_CONTRACT, ORDER_DIMS, SMALL_DIMS
from .tables import CUBE_ROLES, FIRST_DAY, LAST_DAY

ROWS = f"""rows6 AS (
  SELECT {", ".join(f"{column} AS {role}" for role, column in CUBE_ROLES.items())},
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount, l_orderkey AS order_sk
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey)"""

MEASURES = """CAST(sum(total_amount) AS DOUBLE) AS sum_amount, count(*) AS count,
  CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_amount,
  CAST(min(total_amount) AS DOUBLE) AS min_amount, CAST(max(total_amount) AS DOUBLE) AS max_amount"""

ORDERS = """order_rows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sales_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS sales_date,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount, c_name AS customer_id,
         c_mktsegment AS customer_segment, o_orderpriority AS store_type, o_orderstatus AS salesperson_role,
         n_name AS residential_location, CAST(year(o_orderdate) AS INTEGER) AS order_year,
         CAST(quarter(o_orderdate) AS INTEGER) AS order_quarter
  FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey)"""

ACCEPTED = f"WITH {ORDERS} SELECT * FROM order_rows WHERE customer_id IS NOT NULL"


def mask(dims) -> str:
    bits = " + ".join(f"(1 - grouping({d})) * {1 << i}" for i, d in enumerate(dims))
    return f"CAST({bits} AS INTEGER)"


def cube_sql(dims, source="rows6", prefix=f"WITH {ROWS} ") -> str:
    keys = ", ".join(dims)
    return f"{prefix}SELECT {mask(dims)} AS cuboid_mask, {keys}, {MEASURES} FROM {source} GROUP BY CUBE ({keys})"


# Short names of the cube's dimensions, for table names that would be longer than 64 characters.
SHORT = {
    "category": "cat",
    "brand": "brd",
    "customer_segment": "cseg",
    "store_type": "styp",
    "salesperson_role": "srole",
    "campaign_name": "cname",
}


def name_case(dims) -> str:
    """The table name of a cuboid, spelled from its mask."""

    def joined(names) -> str:
        parts = ", ".join(f"CASE WHEN cuboid_mask & {1 << i} > 0 THEN '{n}' END" for i, n in enumerate(names))
        return f"concat_ws('_', 'cuboid', {parts})"

    whole, short = joined(dims), joined([SHORT[d] for d in dims])
    return f"CASE WHEN cuboid_mask = 0 THEN 'cuboid_apex' WHEN length({whole}) <= 64 THEN {whole} ELSE left({short}, 64) END"


def date_role(prefix: str, alias: str) -> str:
    parts = {
        "date": f"{alias}.d",
        "year": f"CAST(year({alias}.d) AS INTEGER)",
        "month": f"CAST(month({alias}.d) AS INTEGER)",
        "day": f"CAST(day({alias}.d) AS INTEGER)",
        "weekday": f"CAST(isodow({alias}.d) AS INTEGER)",
        "quarter": f"CAST(quarter({alias}.d) AS INTEGER)",
    }
    return ", ".join(f"{expression} AS {prefix}_{part}" for part, expression in parts.items())


DATES = f"""dates AS (SELECT CAST(range AS DATE) AS d
  FROM range(DATE '{FIRST_DAY}', DATE '{LAST_DAY}' + INTERVAL 1 DAY, INTERVAL 1 DAY))"""

CODED_ROWS = "coded AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"


def codes(name: str, where: str = "true") -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, min(o_orderkey) AS p FROM coded WHERE {where} GROUP BY {c}"
        for c in CODED
    )
    return f"""{name} AS (SELECT "column", value,
      row_number() OVER (PARTITION BY "column" ORDER BY p) - 1 AS code FROM ({parts}))"""


BUILD = f"WITH {CODED_ROWS}, {codes('full_codes')} "


def cut(key: str, table: str, part: int, parts: int) -> str:
    """The key at a fraction between the least and the greatest one."""
    return f"(SELECT min({key}) + (max({key}) + 1 - min({key})) * {part} // {parts} FROM {table})"


EARLY = f"o_orderkey < {cut('o_orderkey', 'orders', 1, 10)}"


def coded_join(table: str, on: str, output: str) -> str:
    joins = " ".join(
        f"LEFT JOIN (SELECT * FROM {table} WHERE \"column\" = '{c}') AS t_{c} ON {on.format(c=c)}" for c in CODED
    )
    return f"{', '.join(output.format(c=c) for c in CODED)} FROM {{source}} {joins}"


ENCODE = "SELECT o_orderkey, " + coded_join("full_codes", "coded.{c} = t_{c}.value", "t_{c}.code AS {c}").format(
    source="coded"
)
DECODE = "SELECT o_orderkey, " + coded_join(
    "early_codes", "encoded.{c} = t_{c}.code", "coalesce(t_{c}.value, '<INVALID>') AS {c}"
).format(source="encoded")

INT_PREFIX = r"^\s*([+-]?[0-9]+)"
FLOAT_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def as_int(text: str) -> str:
    return f"coalesce(TRY_CAST(regexp_extract({text}, '{INT_PREFIX}', 1) AS INTEGER), 0)"


def as_float(text: str) -> str:
    value = f"TRY_CAST(regexp_extract({text}, '{FLOAT_PREFIX}', 1) AS FLOAT)"
    return f"CAST(CASE WHEN isfinite({value}) THEN {value} ELSE 0 END AS DOUBLE)"


SALES_STAR = f"""WITH {DATES},
  campaigns AS (SELECT CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS INTEGER) AS sk,
      CAST(date_trunc('quarter', min(o_orderdate)) AS DATE) AS first_day, CAST(count(*) AS INTEGER) AS budget
    FROM orders GROUP BY 1),
  places AS (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
  wide AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2))) AS sales_id,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS sales_date,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
    c_name AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
    lower(c_name) || '@example.com' AS email, cn.n_name AS residential_location, c_mktsegment AS customer_segment,
    'PROD_' || p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
    'size ' || p_size AS origin_location,
    'STR_' || s_suppkey AS store_id, s_name AS store_name, sn.r_name AS store_type, sn.n_name AS store_location,
    'SP_' || sp.n_nationkey AS salesperson_id, sp.n_name AS salesperson_name, sp.r_name AS salesperson_role,
    'CAMP_' || campaigns.sk AS campaign_id,
    quarter(first_day) || ' of ' || year(first_day) AS campaign_name, budget AS campaign_budget,
    'SP_' || sn.n_nationkey AS store_manager_id, sn.n_name AS store_manager_name, sn.r_name AS store_manager_role,
    {date_role("campaign_start", "ds")}, {date_role("campaign_end", "de")}
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN places AS cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN places AS sn ON s_nationkey = sn.n_nationkey
  LEFT JOIN places AS sp ON l_linenumber = sp.n_nationkey
  LEFT JOIN campaigns ON year(o_orderdate) * 10 + quarter(o_orderdate) = campaigns.sk
  LEFT JOIN dates AS ds ON ds.d = first_day
  LEFT JOIN dates AS de ON de.d = first_day + INTERVAL 3 MONTH - INTERVAL 1 DAY)
SELECT {", ".join(SALES.names)} FROM wide"""


def contract_check() -> str:
    present = set(ORDER_CONTRACT.names)
    parts = []
    for name in SALES.names:
        gaps = f"count(*) FILTER (WHERE {name} IS NULL)" if name in present else "count(*)"
        present_sql = str(name in present).lower()
        parts.append(f"SELECT '{name}' AS column_name, {present_sql} AS present, {gaps} AS missing_rows FROM order_rows")
    return f"WITH {ORDERS} " + " UNION ALL ".join(parts)


LINE_SPLIT = cut("order_sk", "rows6", 4, 5)
ORDER_CODES = ("customer_segment", "store_type", "salesperson_role", "residential_location")


def distinct_codes(where: str) -> str:
    """How many dictionary entries the accepted orders have."""
    counts = " + ".join(f"count(DISTINCT {c}) FILTER (WHERE {where})" for c in ORDER_CODES)
    return f"(SELECT {counts} FROM order_rows WHERE customer_id IS NOT NULL)"


ROUNDED = f"""SELECT {", ".join(CUBE_DIMENSIONS)}, sum_amount, count,
  CAST(printf('%.2f', avg_amount) AS DOUBLE) AS avg_amount, min_amount, max_amount,
  {name_case(CUBE_DIMENSIONS)} AS cuboid_name FROM ({cube_sql(CUBE_DIMENSIONS)})"""

# Outcome of the two order loads: open orders first, then all orders.
LOADS = f"""WITH {ORDERS}, n AS (SELECT
    count(*) FILTER (WHERE salesperson_role = 'O') AS open_lines,
    count(*) FILTER (WHERE salesperson_role = 'O' AND customer_id IS NOT NULL) AS open_good,
    count(*) AS all_lines,
    count(*) FILTER (WHERE customer_id IS NOT NULL) AS all_good
  FROM order_rows) """


def oracle() -> dict[str, str]:
    three = ", ".join(SMALL_DIMS)
    return {
        "scan_projected": "SELECT l_orderkey, l_returnflag, l_linestatus, l_extendedprice FROM lineitem",
        "scan_row_range": f"""SELECT *,
              CASE WHEN o_orderkey IS NULL OR o_orderkey < {cut("o_orderkey", "orders", 1, 4)} THEN 0
              WHEN o_orderkey < {cut("o_orderkey", "orders", 2, 4)} THEN 1
              WHEN o_orderkey < {cut("o_orderkey", "orders", 3, 4)} THEN 2 ELSE 3 END AS range_no FROM orders""",
        "resume_scan": f"""SELECT *,
              CASE WHEN event_id IS NULL OR event_id < {cut("event_id", "events", 1, 2)} THEN 1 ELSE 2 END AS run
            FROM events""",
        "rename_drop_keys": """SELECT s_name AS name, s_acctbal, n_name AS name_nation
            FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
        "filter_equality": f"""WITH {ROWS} SELECT {", ".join(CUBE_DIMENSIONS)}, CAST(total_amount AS DOUBLE) AS total_amount
            FROM rows6 WHERE category = 'ECONOMY' AND customer_segment = 'BUILDING'""",
        "star_left_join": """SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderpriority, c_name, c_mktsegment,
              p_name, p_brand
            FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
            LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
            LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) ON l_partkey = p_partkey""",
        "role_nation_join": """SELECT l_orderkey, l_linenumber, sn.n_name AS supplier_nation, cn.n_name AS customer_nation
            FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN supplier ON l_suppkey = s_suppkey
            LEFT JOIN nation AS sn ON s_nationkey = sn.n_nationkey
            LEFT JOIN nation AS cn ON c_nationkey = cn.n_nationkey""",
        "role_date_join": f"""WITH {DATES} SELECT l_orderkey, l_linenumber,
              {date_role("ordered", "od")}, {date_role("shipped", "sd")}
            FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
            LEFT JOIN dates AS od ON od.d = CAST(o_orderdate AS DATE)
            LEFT JOIN dates AS sd ON sd.d = CAST(l_shipdate AS DATE)""",
        "denormalise_star": SALES_STAR,
        "int_lenient": f"""SELECT event_id, {as_int("props")} AS from_props, {as_int("substring(props, 7)")} AS from_tail,
              {as_int("CAST(value AS VARCHAR)")} AS from_value,
              {as_int("'  -' || event_id || 'abc'")} AS from_signed,
              {as_int("event_id || '99999999'")} AS from_long,
              {as_int("nullif(event_type, 'error')")} AS from_word FROM events""",
        "float_lenient": f"""SELECT event_id, {as_float("substring(props, 7)")} AS from_tail,
              {as_float("' ' || value || 'kg'")} AS from_value, {as_float("value || 'e2'")} AS from_exponent,
              {as_float("value || 'e99'")} AS from_large, {as_float("event_type")} AS from_word,
              {as_float("'-.' || event_id")} AS from_fraction FROM events""",
        "reject_not_null": f"""WITH {ORDERS} SELECT sales_id, 'not_null:customer_id' AS reject_reason
            FROM order_rows WHERE customer_id IS NULL""",
        "unique_first_wins": """WITH e AS (SELECT event_id, user_id, event_type <> 'error' AS ok,
              min(event_id) FILTER (WHERE event_type <> 'error') OVER (PARTITION BY user_id) AS first_pos FROM events)
            SELECT event_id, CAST(user_id AS VARCHAR) AS "user", CASE WHEN event_id > first_pos THEN 'unique:user'
              WHEN NOT ok THEN 'not_null:kind' END AS reject_reason FROM e""",
        "validation_summary": f"""WITH {ORDERS} SELECT outcome, count(*) AS rows FROM (
              SELECT CASE WHEN customer_id IS NULL THEN 'not_null:customer_id' ELSE 'accepted' END AS outcome FROM order_rows
              UNION ALL SELECT 'width' FROM order_rows) GROUP BY outcome""",
        "contract_check": contract_check(),
        "count_reconcile": f"""{LOADS} SELECT all_good AS table_rows, all_good AS recorded_rows, true AS matches FROM n""",
        "incremental_append": ACCEPTED,
        "load_audit": f"""{LOADS}
            SELECT 1::BIGINT AS version, open_lines AS watermark, open_good AS rows, open_good AS total_rows,
              open_lines - open_good AS errors, 0::BIGINT AS width_errors,
              {distinct_codes("salesperson_role = 'O'")} AS codes, {distinct_codes("salesperson_role = 'O'")} AS total_codes FROM n
            UNION ALL
            SELECT 2, open_lines + all_lines, all_good - open_good, all_good,
              all_lines - all_good + open_good, 0,
              {distinct_codes("true")} - {distinct_codes("salesperson_role = 'O'")}, {distinct_codes("true")} FROM n""",
        "reject_report": f"""{LOADS}
            SELECT 1::BIGINT AS load_version, 'not_null:customer_id' AS reject_reason, open_lines - open_good AS rows FROM n
            UNION ALL SELECT 2, 'not_null:customer_id', all_lines - all_good FROM n
            UNION ALL SELECT 2, 'unique:sales_id', open_good FROM n""",
        "dict_build": f"{BUILD} SELECT * FROM full_codes",
        "dict_extend": f"{BUILD} SELECT * FROM full_codes",
        "dict_encode": f"{BUILD} {ENCODE}",
        "dict_decode": f"{BUILD}, {codes('early_codes', EARLY)}, encoded AS ({ENCODE}) {DECODE}",
        "measures_by_one_dim": f"WITH {ROWS} SELECT brand, {MEASURES} FROM rows6 GROUP BY brand",
        "cuboid_three_dims": f"WITH {ROWS} SELECT {three}, {MEASURES} FROM rows6 GROUP BY {three}",
        "cuboid_apex": f"WITH {ROWS} SELECT {MEASURES} FROM rows6",
        "cube_full": cube_sql(DIMS),
        "cube_named": f"SELECT *, {name_case(DIMS)} AS cuboid_name FROM ({cube_sql(DIMS)})",
        "cube_grouping_sets": f"""WITH {ROWS} SELECT {mask(DIMS)} AS cuboid_mask, {", ".join(DIMS)}, {MEASURES} FROM rows6
            GROUP BY GROUPING SETS ((category, brand), (customer_segment, store_type),
              (salesperson_role, campaign_name), ())""",
        "cuboid_ordered_rounded": f"""WITH {ROWS} SELECT {three}, CAST(sum(total_amount) AS DOUBLE) AS sum_amount,
              count(*) AS count,
              CAST(printf('%.2f', CAST(sum(total_amount) AS DOUBLE) / count(*)) AS DOUBLE) AS avg_amount,
              CAST(min(total_amount) AS DOUBLE) AS min_amount, CAST(max(total_amount) AS DOUBLE) AS max_amount,
              row_number() OVER (ORDER BY concat_ws('|', {", ".join(f"coalesce({d}, '')" for d in SMALL_DIMS)})) - 1 AS position
            FROM rows6 GROUP BY {three}""",
        "delta_cube": f"""WITH {ROWS},
              old_rows AS (SELECT * FROM rows6 WHERE order_sk < {LINE_SPLIT}),
              new_rows AS (SELECT * FROM rows6 WHERE order_sk >= {LINE_SPLIT})
            SELECT *, 0 AS delta_no FROM ({cube_sql(DIMS, "old_rows", "")})
            UNION ALL SELECT *, 1 AS delta_no FROM ({cube_sql(DIMS, "new_rows", "")})""",
        "cube_merge": cube_sql(DIMS),
        "cube_lookup": f"""SELECT * FROM ({cube_sql(DIMS)})
            WHERE cuboid_mask = 33 AND category = 'ECONOMY' AND campaign_name = 'A'""",
        "cube_refresh": cube_sql(
            ORDER_DIMS,
            "good",
            f"WITH {ORDERS}, good AS (SELECT * REPLACE (CAST(total_amount AS DECIMAL(18,2)) AS total_amount) "
            "FROM order_rows WHERE customer_id IS NOT NULL) ",
        ),
        "refresh_report": f"""WITH {ORDERS}, n AS (SELECT
              count(*) FILTER (WHERE salesperson_role <> 'F') AS first_lines,
              count(*) FILTER (WHERE salesperson_role <> 'F' AND customer_id IS NOT NULL) AS first_good,
              count(*) AS all_lines, count(*) FILTER (WHERE customer_id IS NOT NULL) AS all_good FROM order_rows)
            SELECT 1::BIGINT AS version, first_good AS rows, 64::BIGINT AS cuboids, 0::BIGINT AS watermark_before,
              first_lines AS watermark FROM n
            UNION ALL SELECT 2, all_good - first_good, 64, first_lines, all_lines FROM n""",
        "sales_pipeline": f"""WITH sales AS (SELECT DISTINCT * FROM ({SALES_STAR})),
              good AS (SELECT * REPLACE (CAST(total_amount AS DECIMAL(18,2)) AS total_amount) FROM sales
                WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND store_id IS NOT NULL
                  AND salesperson_id IS NOT NULL AND campaign_id IS NOT NULL)
            SELECT *, {name_case(CUBE_DIMENSIONS)} AS cuboid_name FROM ({cube_sql(CUBE_DIMENSIONS, "good", "")})""",
        "csv_round_trip": "SELECT * FROM events",
        "cuboid_publish_round_trip": ROUNDED,
        "cube_publish": ROUNDED,
        "stream_append": ACCEPTED,
        "batch_then_stream_append": ACCEPTED,
        "stream_refresh": cube_sql(DIMS),
    }
