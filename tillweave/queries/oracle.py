r"""SQL for DuckDB that gives the results of the registered queries.

It is written from the rules and not from the Spark plans: product identity is followed by recursion, the daily cost by
an as-of join, and the cleaned cells are stated directly instead of being cleaned.
"""

from __future__ import annotations

from tillweave.queries.checksums import CHECKSUMS
from tillweave.queries.report import CALENDAR

_MONTHS = " ".join(CALENDAR.months.values())
_DAYS = " ".join(CALENDAR.days.values())

# Report rows with their cells as they must come out of cleaning.
_ROWS = """
rows AS (
  SELECT CAST(l_shipdate AS DATE) AS report_date,
         'report ' || strftime(l_shipdate, '%d.%m.%y') || '.xlsx' AS source_file,
         l_suppkey AS spot_id_raw,
         (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS row_ord,
         l_linenumber IN (1, 2) AS is_heated,
         CASE WHEN l_linenumber = 3 AND l_tax = 0.08 THEN NULL
              WHEN l_linenumber = 7 AND p_size <= 25 THEN 'CAT01-X-3-4'
              WHEN l_linenumber = 7 THEN 'CAT02-X-' || p_size || '-4'
              ELSE p_type || '-' || p_size END AS code,
         CASE WHEN l_linenumber = 1 THEN 'C_' || p_type || '-' || p_size
              WHEN l_linenumber = 2 THEN '  c-' || p_type || '-' || p_size || chr(160)
              WHEN l_linenumber = 3 AND l_tax = 0.08 THEN NULL
              WHEN l_linenumber = 7 AND p_size <= 25 THEN 'CAT01-X-3-4'
              WHEN l_linenumber = 7 THEN 'CAT02-X-' || p_size || '-4'
              ELSE p_type || '-' || p_size END AS code_raw,
         CASE WHEN l_linenumber = 3 AND l_tax = 0.08 THEN NULL
              WHEN l_linenumber = 7 AND p_size <= 25 THEN 'CAT01'
              WHEN l_linenumber = 7 THEN 'CAT02'
              ELSE p_type END AS fallback,
         CASE WHEN l_tax = 0.0 AND l_linenumber = 7 AND p_size <= 25 THEN 'CAT01-X-3-4'
              WHEN l_tax = 0.0 AND l_linenumber = 7 THEN 'CAT02-X-' || p_size || '-4'
              WHEN l_tax = 0.0 THEN p_type || '-' || p_size
              WHEN l_tax = 0.02 THEN upper(p_name)
              WHEN l_tax = 0.03 AND l_linenumber = 4 THEN p_name || ' | ' || p_type
              ELSE p_name END AS name,
         CASE WHEN p_size <= 5 THEN CAST(p_partkey AS VARCHAR) END AS recipe,
         CAST(round(l_discount * 100) AS INTEGER) AS pct,
         CASE WHEN l_discount = 0.0 AND l_tax = 0.08 THEN NULL ELSE l_quantity END AS sold,
         CASE WHEN l_tax <> 0.07 THEN l_quantity END AS suma,
         l_extendedprice AS brutto,
         l_quantity AS qty,
         l_returnflag AS flag,
         CASE WHEN l_discount < 0.09 THEN p_retailprice + l_tax END AS unit_cost,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_quantity * p_retailprice END AS receipt_cost
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
r AS (
  SELECT *, CASE WHEN recipe IS NOT NULL THEN 'RECIPE_' || recipe
                 ELSE strftime(report_date, '%d_%m_%y') || '_' || coalesce(code, 'NO_CODE') END AS work_key,
         row_number() OVER (ORDER BY source_file, spot_id_raw, row_ord) AS rn
  FROM rows
)"""

_CORRECTIONS = """
corrections(source_name, canonical_name, canonical_group, action) AS (
  VALUES ('red plate', 'Red Plate', 'PLATES', 'replace'),
         ('blue ring', 'blue ring', 'RINGS', 'keep'),
         ('old rod', 'old rod', 'RODS', 'replace')
)"""

_NAMES = """
rolled AS (
  SELECT work_key, first(name ORDER BY length(name) DESC, name) AS selected,
         list_sort(list(DISTINCT name)) AS alternatives
  FROM r GROUP BY work_key
),
names AS (
  SELECT rolled.*, array_to_string(alternatives, ' | ') AS joined,
         coalesce(canonical_name, selected) AS canonical_name, canonical_group,
         coalesce(canonical_name <> selected OR action = 'replace', false) AS corrected,
         coalesce(action, 'keep') AS action
  FROM rolled LEFT JOIN corrections ON source_name = selected
)"""

_CANDIDATES = """
first_rows AS (
  SELECT work_key, first(report_date ORDER BY report_date, rn) AS first_date,
         first(recipe ORDER BY report_date, rn) AS recipe, first(fallback ORDER BY report_date, rn) AS fallback
  FROM r GROUP BY work_key
),
cand AS (
  SELECT work_key, first_date, recipe, selected, joined, coalesce(canonical_group, fallback) AS grp,
         row_number() OVER (ORDER BY first_date, recipe IS NULL, work_key) AS o
  FROM first_rows JOIN names USING (work_key)
)"""

_RESOLVE = """
cand_names AS (
  SELECT o, grp, lower(selected) AS name FROM cand
  UNION
  SELECT o, grp, lower(trim(unnest(string_split(joined, '|')))) FROM cand
),
owner AS (SELECT coalesce('+' || grp, '-') AS g, name, min(o) AS o FROM cand_names WHERE name <> '' GROUP BY ALL),
parents AS (
  SELECT cand.o, CASE WHEN recipe IS NOT NULL THEN cand.o ELSE owner.o END AS parent
  FROM cand JOIN owner ON owner.g = coalesce('+' || grp, '-') AND owner.name = lower(selected)
),
walk AS (
  SELECT o, parent AS p FROM parents
  UNION
  SELECT walk.o, parents.parent FROM walk JOIN parents ON parents.o = walk.p WHERE parents.parent <> walk.p
),
roots AS (SELECT o, min(p) AS root FROM walk GROUP BY o),
ident AS (
  SELECT cand.work_key AS product_work_key,
         CASE WHEN top.recipe IS NOT NULL THEN 'RECIPE_' || top.recipe ELSE 'TEMP_' || top.work_key END
           AS product_business_key,
         CASE WHEN cand.recipe IS NOT NULL THEN 'RECIPE' WHEN cand.o = top.o THEN 'TEMPORARY' ELSE 'NAME_MATCH' END
           AS product_identity_type,
         cand.recipe IS NOT NULL AS is_historical_stable,
         CASE WHEN cand.recipe IS NOT NULL THEN 'RECIPE' WHEN cand.o = top.o THEN 'TEMP' ELSE 'NAME_MATCH' END
           AS identity_match_source
  FROM cand JOIN roots USING (o) JOIN cand AS top ON top.o = roots.root
)"""

_PRODUCTS = """
keyed AS (
  SELECT r.*, product_business_key AS bk, product_identity_type AS kind, selected, joined,
         coalesce(canonical_group, fallback) AS grp
  FROM r JOIN ident ON ident.product_work_key = r.work_key JOIN names ON names.work_key = r.work_key
),
groups AS (SELECT bk, grp, count(*) AS n, min(rn) AS rn FROM keyed WHERE grp IS NOT NULL GROUP BY ALL),
types AS (
  SELECT bk, first(grp ORDER BY n DESC, rn) AS product_type, count(*) AS n_groups FROM groups GROUP BY bk
),
key_names AS (
  SELECT DISTINCT bk, name FROM (
    SELECT bk, selected AS name FROM keyed
    UNION
    SELECT bk, trim(unnest(string_split(joined, '|'))) FROM (SELECT DISTINCT bk, joined FROM keyed)
  ) WHERE name <> ''
),
all_names AS (
  SELECT bk, string_agg(name, ' | ' ORDER BY name) AS joined,
         bool_or(lower(name) IN ('old rod', 'hot ring')) AS listed,
         bool_or(regexp_matches(lower(name), '^small .*t$') OR regexp_matches(lower(name), '^blue ')) AS pattern
  FROM key_names GROUP BY bk
),
prod AS (
  SELECT keyed.bk,
         CASE WHEN bool_or(kind = 'RECIPE') THEN 'RECIPE' WHEN bool_or(kind = 'NAME_MATCH') THEN 'NAME_MATCH'
              ELSE 'TEMPORARY' END AS kind,
         max(recipe) AS recipe, first(selected ORDER BY length(selected) DESC, selected) AS product_name,
         coalesce(bool_or(upper(code_raw) LIKE '%-X-%'), false) AS keyword,
         coalesce(bool_or(grp IN ('PROMO', 'LARGE')), false) AS in_two,
         coalesce(bool_or(grp = 'ECONOMY'), false) AS in_economy
  FROM keyed GROUP BY keyed.bk
),
dimp AS (
  SELECT CAST(row_number() OVER (ORDER BY prod.bk) AS INTEGER) AS product_id, prod.bk AS product_business_key,
         kind AS product_identity_type, kind = 'RECIPE' AS is_historical_stable, recipe AS recipe_number,
         product_name,
         trim(replace(regexp_replace(lower(product_name), '[^a-z0-9_ ]', '', 'g'), ' ', '_'), '_')
           AS normalized_product_name,
         product_type,
         CASE WHEN recipe IS NOT NULL THEN 'INSIDE' WHEN keyword THEN 'OUTSIDE' WHEN pattern AND in_two THEN 'PATTERN'
              WHEN listed THEN 'LISTED' WHEN in_economy THEN 'GROUPED' ELSE 'Unsorted' END AS source,
         all_names.joined AS product_alternative_names
  FROM prod LEFT JOIN types USING (bk) LEFT JOIN all_names USING (bk)
)"""

_SPOTS = """
spots AS (
  SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS INTEGER) AS spot_id, CAST(s_suppkey AS INTEGER) AS spot_id_raw,
         replace(s_name, '#', ' #') AS spot_name, 'ul. ' || s_suppkey AS address, n_name AS city
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
)"""

_FACT_ROWS = """
f AS (SELECT keyed.*, product_id, spot_id FROM keyed
      JOIN dimp ON dimp.product_business_key = bk JOIN spots USING (spot_id_raw)),
cost AS (
  SELECT report_date AS date, product_id, max(unit_cost) AS productcost, count(DISTINCT unit_cost) AS n
  FROM f WHERE flag = 'N' AND unit_cost IS NOT NULL GROUP BY ALL
)"""

_VALUED = """
moves AS (
  SELECT f.report_date AS date, spot_id, f.product_id,
         CASE flag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 4 END AS movement_type_id,
         qty, flag = 'N' AS is_receipt, CASE WHEN flag = 'N' THEN receipt_cost END AS given, productcost
  FROM f ASOF LEFT JOIN cost ON cost.product_id = f.product_id AND f.report_date >= cost.date
)"""

_MOVEMENTS = """
SELECT date, spot_id, product_id, movement_type_id, sum(qty) AS quantity,
       CAST(sum(CAST(coalesce(given, qty * productcost, 0) AS DECIMAL(28, 8))) AS DOUBLE) AS cost
FROM moves GROUP BY ALL"""


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE" if recursive else "WITH") + ",".join(parts)


_TO_NAMES = (_ROWS, _CORRECTIONS, _NAMES)
_TO_IDENTITY = (*_TO_NAMES, _CANDIDATES, _RESOLVE)
_TO_PRODUCTS = (*_TO_IDENTITY, _PRODUCTS)
_TO_FACTS = (*_TO_PRODUCTS, _SPOTS, _FACT_ROWS)


def _calendar_names(words: str, number: str) -> str:
    return f"string_split('{words}', ' ')[{number}]"


_BLANK = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _squeezed(value: str) -> str:
    return f"trim(regexp_replace({value}, '{_BLANK}+', ' ', 'g'))"


_DISCOUNTS = ", ".join(f"sum(l_quantity) FILTER (pct = {pct}) AS qty_{pct}_pct" for pct in range(3, 11))

_EVENT_CODE = """
codes AS (
  SELECT event_id, event_type, user_id,
         CASE event_type WHEN 'view' THEN 'cat' ELSE '' END || user_id || '-X-' || event_type || '-' || user_id || '-'
           || event_type || ' bar ' || event_id AS code_clean
  FROM events
)"""

ORACLE: dict[str, str] = {
    "file_and_sheet_metadata": """
        SELECT DISTINCT 'report ' || strftime(l_shipdate, '%d.%m.%y') || '.xlsx' AS source_file,
               'Spot#' || l_suppkey AS source_sheet_clean, strftime(l_shipdate, '%d.%m.%y') AS report_date_raw,
               CAST(l_suppkey AS INTEGER) AS spot_id_raw
        FROM lineitem WHERE l_suppkey IS NOT NULL AND l_orderkey % 2 = 1""",
    "cells_to_columns": f"""
        WITH l AS (SELECT *, CAST(round(l_discount * 100) AS INTEGER) AS pct FROM lineitem)
        SELECT CAST(l_partkey AS VARCHAR) AS code, count(*) AS n_rows,
               (SELECT count(DISTINCT pct) FROM l) AS n_sale_columns,
               sum(l_quantity) FILTER (pct = 0) AS qty_Sprzedaz, sum(l_quantity) FILTER (pct = 1) AS qty_Paczki_1,
               sum(l_quantity) FILTER (pct = 2) AS qty_Paczki_2, {_DISCOUNTS}
        FROM l GROUP BY l_partkey""",
    "union_by_name": """
        SELECT event_id, value, NULL::BIGINT AS user_id, NULL::VARCHAR AS event_type
        FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, NULL, user_id, event_type FROM events WHERE event_type <> 'click'""",
    "raw_layer": f"""
        {_with(_ROWS)} SELECT strftime(report_date, '%d.%m.%y') AS report_date_raw, count(*) AS n_rows,
               count(CASE WHEN recipe IS NOT NULL THEN 1 WHEN row_ord // 10000000 % 10 = 5 THEN 1 END) AS n_recipes,
               sum(suma) AS suma FROM r GROUP BY report_date""",
    "csv_table": f"{_with(_SPOTS)} SELECT * FROM spots",
    "text_clean": f"""
        SELECT doc_id, CASE WHEN t NOT IN ('', '0', ')') THEN t END AS basic, length(nullif(t, '')) AS n_tidy,
               nullif(lower(t), '') AS identity_name, lower(source || ' ' || lang) AS origin
        FROM (SELECT *, {_squeezed("text")} AS t FROM documents)""",
    "normalized_name": rf"""
        SELECT doc_id, nullif(trim(replace(regexp_replace({_squeezed("lower(text)")}, '[^\p{{L}}\p{{N}}_ ]', '', 'g'),
               ' ', '_'), '_'), '') AS normalized FROM documents""",
    "split_names": f"""
        WITH pieces AS (
          SELECT doc_id, regexp_replace(regexp_replace(unnest(string_split(replace(text, chr(10), '|'), '|')),
                 '^{_BLANK}+', ''), '{_BLANK}+$', '') AS name FROM documents)
        SELECT doc_id, CAST(count(name) FILTER (name <> '') AS INTEGER) AS n_names,
               coalesce(string_agg(DISTINCT name, ' | ' ORDER BY name) FILTER (name <> ''), '') AS names
        FROM pieces GROUP BY doc_id""",
    "product_group": rf"""
        {_with(_EVENT_CODE)}
        SELECT event_id, event_type IN ('click', 'view') AS is_heated, code_clean,
               CASE WHEN event_type = 'view' THEN 'CAT' || user_id
                    ELSE upper(replace(trim(event_type || ' bar'), ' ', '_')) END AS product_group
        FROM codes""",
    "numeric_coerce": """
        SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'purchase'
               THEN CAST(CAST(value AS VARCHAR) || 'e1' AS DOUBLE) ELSE value END AS number,
               CAST(NULL AS DOUBLE) AS nan_number FROM events""",
    "date_parse": """
        SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN NULL WHEN '2' THEN NULL
          WHEN '3' THEN CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN NULL
                             ELSE make_date(1969, month(o_orderdate), day(o_orderdate)) END
          WHEN '4' THEN make_date(2068, month(o_orderdate), day(o_orderdate))
          ELSE CAST(o_orderdate AS DATE) END AS report_date FROM orders""",
    "product_cells": f"""
        {_with(_ROWS)} SELECT source_file, CAST(spot_id_raw AS INTEGER) AS sheet, row_ord, is_heated,
               code AS product_code_clean, name AS product_name_clean, recipe AS recipe_number_clean,
               recipe IS NOT NULL AS has_recipe_number,
               CASE WHEN recipe IS NOT NULL THEN 'RECIPE_NUMBER' ELSE 'DATE_CODE' END AS product_identity_basis,
               work_key AS product_work_key, fallback AS product_group_fallback FROM r""",
    "sales_control": f"""
        {_with(_ROWS)} SELECT CAST(spot_id_raw AS INTEGER) AS sheet, row_ord, report_date,
               CASE WHEN pct IN (1, 2) THEN sold ELSE 0.0::DOUBLE END AS paczki, coalesce(sold, 0) AS sales_total_computed,
               coalesce(suma, 0) - coalesce(sold, 0) AS sales_total_difference,
               coalesce(suma, 0) = coalesce(sold, 0) AS sales_total_matches_control, false AS sales_validation_excluded
        FROM r""",
    "spot_mapping": f"""
        {_with(_SPOTS)} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS spot_id_raw,
               ' ' || replace(s_name, '#', '  #') AS spot_name, n_name AS city,
               CASE WHEN s_name IS NOT NULL THEN 'ul. ' || l_suppkey END AS street, s_name IS NOT NULL AS spot_mapping_found
        FROM lineitem LEFT JOIN (SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
          WHERE n_name <> 'NATION_3') ON s_suppkey = l_suppkey""",
    "missing_spots": """
        SELECT DISTINCT CAST(l_suppkey AS INTEGER) AS spot_id_raw FROM lineitem WHERE l_suppkey NOT IN (
          SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name <> 'NATION_3')""",
    "name_rollup": f"""
        {_with(*_TO_NAMES)} SELECT work_key AS product_work_key, selected AS product_name_selected,
               joined AS product_alternative_names, CAST(len(alternatives) AS INTEGER) AS product_alternative_names_count
        FROM names""",
    "name_corrections": f"""
        {_with(*_TO_NAMES)} SELECT work_key AS product_work_key, canonical_name AS product_name_canonical,
               canonical_group AS product_canonical_group, corrected AS product_name_corrected,
               action AS product_correction_action FROM names""",
    "staging_products": f"""
        {_with(*_TO_NAMES)} SELECT CAST(spot_id_raw AS INTEGER) AS sheet, row_ord, report_date,
               work_key AS product_work_key, selected AS product_name_selected,
               CAST(len(alternatives) AS INTEGER) AS product_alternative_names_count,
               coalesce(canonical_group, fallback) AS product_group_final, false AS is_system_product,
               selected IS NULL AS is_product_name_missing, code IS NULL AS is_product_code_missing,
               length(selected) <= 6 AS is_short_product_name_warning
        FROM r JOIN names USING (work_key)""",
    "staging_table": f"""
        {_with(*_TO_NAMES, _SPOTS)} SELECT report_date, ' ' || replace(s_name, '#', '  #') AS spot_name, city,
               count(*) AS n_rows, count(*) FILTER (length(selected) <= 6) AS n_short,
               CAST(sum(len(alternatives)) AS BIGINT) AS n_names, max(selected) AS last_name, coalesce(sum(sold), 0) AS total
        FROM r JOIN names USING (work_key) JOIN spots USING (spot_id_raw) JOIN supplier ON s_suppkey = spot_id_raw
        GROUP BY ALL""",
    "staging_hot_key": f"""
        {_with(_ROWS)},
        h AS (SELECT CASE WHEN flag = 'R' THEN 'NO_DATE_NO_CODE' ELSE work_key END AS work_key,
                     CASE WHEN flag <> 'R' OR code IS NULL OR name <> code THEN name END AS name FROM r),
        rolled AS (SELECT work_key, count(*) AS n, first(name ORDER BY length(name) DESC, name) FILTER (name IS NOT NULL) AS selected,
                          count(DISTINCT name) AS names FROM h GROUP BY work_key)
        SELECT work_key = 'NO_DATE_NO_CODE' AS is_hot, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
               CAST(sum(n * names) AS BIGINT) AS n_names, max(selected) AS last_name
        FROM rolled GROUP BY is_hot""",
    "dim_date": f"""
        WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
             d AS (SELECT CAST(unnest(generate_series(CAST(CAST(lo AS DATE) AS TIMESTAMP), CAST(CAST(hi AS DATE) AS TIMESTAMP),
                   INTERVAL 1 DAY)) AS DATE) AS date FROM b)
        SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(month(date) AS INTEGER) AS month, {_calendar_names(_MONTHS, "month(date)")} AS month_name,
               CAST(week(date) AS INTEGER) AS week, CAST(day(date) AS INTEGER) AS day,
               CAST(isodow(date) AS INTEGER) AS day_of_week, {_calendar_names(_DAYS, "isodow(date)")} AS day_name,
               isodow(date) >= 6 AS is_weekend, strftime(date, '%Y-%m') AS year_month,
               isoyear(date) || '-W' || lpad(CAST(week(date) AS VARCHAR), 2, '0') AS year_week FROM d""",
    "dim_spot": f"{_with(_SPOTS)} SELECT * FROM spots",
    "dim_sale_type": """
        WITH p AS (SELECT DISTINCT CAST(round(l_discount * 100) AS INTEGER) AS pct FROM lineitem WHERE l_discount > 0.025)
        SELECT 1 AS sale_type_id, 'FULL_PRICE' AS sale_type_code, 'Sprzedaż pełnopłatna' AS sale_type_name,
               'Sprzedaż' AS source_column, 'FIXED' AS sale_type_kind, false AS is_dynamic, NULL::INTEGER AS discount_pct,
               true AS is_active
        UNION ALL SELECT 2, 'TGTG', 'Paczki', 'Paczki', 'FIXED', false, NULL, true
        UNION ALL SELECT CAST(2 + row_number() OVER (ORDER BY pct) AS INTEGER), 'DISCOUNT_' || pct, pct || '%', pct || '%',
               'DISCOUNT', true, pct, true FROM p""",
    "dim_movement_type": """
        WITH k AS (
          SELECT DISTINCT 'move ' || l_returnflag || CASE l_linestatus WHEN 'O' THEN ' - detail' ELSE '' END
                 AS movement_type_column, l_linestatus || ' ' || l_returnflag AS movement_type_name,
                 CASE l_returnflag WHEN 'N' THEN 'IN' ELSE 'OUT' END AS movement_direction,
                 l_linestatus = 'O' AS is_additional_detail,
                 CASE l_linestatus WHEN 'O' THEN 'move ' || l_returnflag END AS parent_movement_type_column FROM lineitem)
        SELECT CAST(row_number() OVER (ORDER BY is_additional_detail, movement_direction, movement_type_name,
               movement_type_column) AS INTEGER) AS movement_type_id, * FROM k""",
    "movement_type_checks": """
        SELECT 'missing_parent' AS check_name, 'error' AS severity, 'dim_movement_type' AS table_name,
               'missing_parent' AS key, count(DISTINCT l_returnflag) AS n FROM lineitem WHERE l_linestatus = 'O'
        UNION ALL SELECT 'direction', 'error', 'dim_movement_type', 'movement_direction',
               count(DISTINCT l_returnflag = 'N') FROM lineitem""",
    "surrogate_ids": """
        SELECT CAST(row_number() OVER (ORDER BY p_name, p_partkey DESC) AS INTEGER) AS part_id, p_name, p_partkey
        FROM part""",
    "product_candidates": f"""
        {_with(*_TO_NAMES, _CANDIDATES)} SELECT work_key AS product_work_key, first_date AS first_seen_date,
               recipe AS recipe_number_clean, selected AS product_name_selected, replace(joined, ' | ', '|') AS alternative_names,
               grp AS product_group_final FROM cand""",
    "product_identity": f"{_with(*_TO_IDENTITY, recursive=True)} SELECT * FROM ident",
    "product_identity_from_staging": f"""
        WITH RECURSIVE r AS (
          SELECT CAST(l_shipdate AS DATE) AS report_date, p_type AS fallback, p_name AS name, 1 AS rn,
                 CASE WHEN p_size <= 5 THEN CAST(p_partkey AS VARCHAR) END AS recipe,
                 CASE WHEN p_size <= 5 THEN 'RECIPE_' || p_partkey
                      ELSE strftime(l_shipdate, '%d_%m_%y') || '_' || p_type END AS work_key
          FROM lineitem JOIN part ON l_partkey = p_partkey),
        {",".join((_CORRECTIONS, _NAMES, _CANDIDATES, _RESOLVE))} SELECT * FROM ident""",
    "dq_group_conflicts": f"""
        {_with(*_TO_NAMES, _CANDIDATES)}
        SELECT lower(selected) AS name, count(DISTINCT coalesce('+' || grp, '-')) AS n_groups,
               coalesce(string_agg(DISTINCT grp, ' | ' ORDER BY grp), '') AS groups
        FROM cand GROUP BY 1 HAVING n_groups > 1""",
    "dim_product": f"{_with(*_TO_PRODUCTS, recursive=True)} SELECT * FROM dimp",
    "product_types": f"""
        {_with(*_TO_PRODUCTS, recursive=True)} SELECT bk AS product_business_key, product_type, n_groups FROM types""",
    "fact_sales_quantity": f"""
        {_with(*_TO_FACTS, recursive=True)}
        SELECT report_date AS date, spot_id, product_id,
               CASE pct WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE pct END AS sale_type_id, is_heated,
               sum(sold) AS quantity
        FROM f WHERE sold <> 0 GROUP BY ALL""",
    "fact_sales_gross": f"""
        {_with(*_TO_FACTS, recursive=True)}
        SELECT report_date AS date, spot_id, product_id, is_heated,
               CAST(sum(CAST(brutto AS DECIMAL(28, 8))) AS DOUBLE) AS amount
        FROM f WHERE brutto <> 0 GROUP BY ALL""",
    "fact_productcost": f"""
        {_with(*_TO_FACTS, recursive=True)} SELECT date, product_id, productcost FROM cost""",
    "productcost_conflicts": f"""
        {_with(*_TO_FACTS, recursive=True)}
        SELECT date, product_id, n AS productcost_unique_count FROM cost WHERE n > 1""",
    "productcost_daily_lookup": f"""
        {_with(*_TO_FACTS, recursive=True)},
        days AS (SELECT CAST(unnest(generate_series(min(CAST(report_date AS TIMESTAMP)), max(CAST(report_date AS TIMESTAMP)),
                 INTERVAL 1 DAY)) AS DATE) AS date FROM r),
        grid AS (SELECT days.date, p.product_id FROM days JOIN
                 (SELECT product_id, min(date) AS since FROM cost GROUP BY product_id) AS p ON days.date >= since)
        SELECT grid.date, grid.product_id, productcost
        FROM grid ASOF JOIN cost ON cost.product_id = grid.product_id AND grid.date >= cost.date""",
    "fact_inventory_movement": f"{_with(*_TO_FACTS, _VALUED, recursive=True)} {_MOVEMENTS}",
    "fact_inventory_movement_by_day": f"{_with(*_TO_FACTS, _VALUED, recursive=True)} {_MOVEMENTS}",
    "movement_cost_issues": f"""
        {_with(*_TO_FACTS, _VALUED, recursive=True)},
        found AS (SELECT CASE WHEN is_receipt AND productcost IS NOT NULL THEN 'receipt_cost_from_unit_cost'
                  WHEN is_receipt THEN 'receipt_without_cost'
                  WHEN productcost IS NULL THEN 'movement_without_unit_cost' END AS issue, * FROM moves WHERE given IS NULL),
        keys AS (SELECT issue, date, product_id, movement_type_id, count(*) AS n FROM found WHERE issue IS NOT NULL GROUP BY ALL),
        placed AS (SELECT *, row_number() OVER (PARTITION BY issue ORDER BY date, product_id, movement_type_id) AS place FROM keys)
        SELECT issue, CAST(sum(n) AS BIGINT) AS n_rows,
               string_agg('{{"date":"' || date || '","product_id":' || product_id || ',"movement_type_id":' || movement_type_id || '}}',
                          ', ' ORDER BY place) FILTER (place <= 20) AS detail
        FROM placed GROUP BY issue""",
    "attach_skewed": """
        SELECT k AS s_suppkey, l_orderkey, l_linenumber, l_partkey, s_name
        FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 7 ELSE l_suppkey END AS k FROM lineitem)
        LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey <> 3) ON s_suppkey = k""",
    "dq_nulls": f"""
        {_with(_ROWS)},
        c AS (SELECT count(*) FILTER (report_date IS NULL) AS "report_date", count(*) FILTER (code IS NULL) AS "product_code_clean",
              count(*) FILTER (recipe IS NULL) AS "recipe_number_clean",
              count(*) FILTER (pct <> 0 OR sold IS NULL) AS "Sprzedaż", count(*) FILTER (suma IS NULL) AS "Suma",
              count(*) FILTER (unit_cost IS NULL) AS "koszt-jednostka" FROM r)
        SELECT 'nulls' AS check_name, 'error' AS severity, 'staging' AS table_name, key, NULL::VARCHAR AS detail, n
        FROM (UNPIVOT c ON COLUMNS(*) INTO NAME key VALUE n) WHERE n > 0""",
    "dq_duplicates": """
        SELECT CAST(l_shipdate AS DATE) AS date, l_partkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING n_rows > 1""",
    "dq_unmatched": """
        WITH m AS (SELECT DISTINCT '{"doc_id":' || doc_id || '}' AS key FROM documents
                   WHERE doc_id NOT IN (SELECT doc_id FROM labels))
        SELECT 'unmatched' AS check_name, 'error' AS severity, 'documents' AS table_name, 'doc_id' AS key,
               (SELECT string_agg(key, ', ' ORDER BY key) FROM (SELECT key FROM m ORDER BY key LIMIT 20)) AS detail,
               count(*) AS n FROM m HAVING count(*) > 0""",
    "dq_invalid": "SELECT DISTINCT props FROM events WHERE props IS NOT NULL",
    "dq_conservation": """
        SELECT 'l_quantity' AS measure, CAST(sum(CAST(l_quantity AS DECIMAL(28, 8))) AS DOUBLE) AS before, before AS after
        FROM lineitem
        UNION ALL SELECT 'l_extendedprice', CAST(sum(CAST(l_extendedprice AS DECIMAL(28, 8))) AS DOUBLE) AS t, t FROM lineitem""",
    "dq_negative": """
        SELECT 'negative' AS check_name, 'warning' AS severity, 'supplier' AS table_name, 's_acctbal' AS key,
               NULL::VARCHAR AS detail, count(*) AS n FROM supplier WHERE s_acctbal < 0 HAVING count(*) > 0""",
    "dq_short_names": f"""
        {_with(_ROWS)},
        h AS (SELECT CASE WHEN recipe IS NOT NULL THEN 'RECIPE_' || recipe
                          ELSE strftime(report_date, '%d_%m_%y') || '_' || CASE WHEN spot_id_raw % 4 = 0 THEN 'SYSTEM' ELSE coalesce(code, 'NO_CODE') END
                     END AS work_key, spot_id_raw % 4 = 0 AS technical,
                     trim(replace(coalesce(CASE WHEN suma IS NULL THEN substr(code_raw, 1, 3 + spot_id_raw % 6) END, code_raw, 'unnamed'), chr(160), ' ')) AS name
              FROM r),
        rolled AS (SELECT work_key, first(name ORDER BY length(name) DESC, name) AS selected FROM h GROUP BY work_key)
        SELECT DISTINCT work_key AS product_work_key, selected AS product_name_selected
        FROM h JOIN rolled USING (work_key) WHERE NOT technical AND length(selected) <= 6""",
    "raw_checks": f"""
        SELECT 'nulls' AS check_name, 'error' AS severity, 'raw' AS table_name, 'report_date_raw' AS key, count(*) AS n
        FROM lineitem WHERE l_tax = 0.07 HAVING count(*) > 0
        UNION ALL SELECT 'missing_column', 'error', 'raw', unnest(['source_sheet', 'load_timestamp']), 1
        UNION ALL SELECT 'empty', 'error', 'raw', NULL, 1 WHERE (SELECT count(*) FROM lineitem WHERE l_suppkey < 0) = 0""",
    "listed_files": """
        SELECT CAST(l_shipdate AS DATE) AS report_date, count(*) AS n_rows, count(DISTINCT l_suppkey) AS n_spots,
               sum(l_quantity) AS quantity
        FROM lineitem WHERE l_linenumber > 1 GROUP BY 1""",
    "snapshots": f"""
        {_with(_ROWS)} SELECT 'observations' AS name, count(*) AS n_rows, count(DISTINCT work_key) AS n_keys FROM r""",
    "watched_facts": f"""
        {_with(*_TO_FACTS, recursive=True)},
        known AS (SELECT f.*, s_nationkey <> 3 AS listed FROM f JOIN supplier ON s_suppkey = spot_id_raw),
        sold AS (SELECT report_date, CASE WHEN listed THEN spot_id_raw END AS spot, product_id, is_heated, sum(sold) AS total,
                        CASE pct WHEN 2 THEN 1 ELSE pct END AS kind
                 FROM known WHERE sold <> 0 GROUP BY ALL),
        earned AS (SELECT report_date, CASE WHEN listed THEN spot_id_raw END AS spot, product_id, is_heated,
                          sum(CAST(brutto AS DECIMAL(28, 8))) AS total
                   FROM known WHERE brutto <> 0 GROUP BY ALL)
        SELECT 'fact_sales_quantity' AS table_name, CAST(sum(total) AS DOUBLE) AS before, CAST(sum(total) AS DOUBLE) AS after,
               count(*) AS n_rows, count(*) FILTER (spot IS NULL) AS n_nulls, count(*) FILTER (total < 0) AS n_negatives FROM sold
        UNION ALL SELECT 'fact_sales_gross', CAST(sum(total) AS DOUBLE), CAST(sum(total) AS DOUBLE), count(*),
               count(*) FILTER (spot IS NULL), count(*) FILTER (total < 0) FROM earned""",
    "fact_sales_shared_column": f"""
        {_with(*_TO_FACTS, recursive=True)}
        SELECT sale_type_id, count(*) AS n_rows, sum(quantity) AS quantity FROM (
          SELECT report_date, spot_id, product_id, is_heated, sum(sold) AS quantity,
                 CASE pct WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE pct END AS sale_type_id
          FROM f WHERE sold <> 0 GROUP BY ALL) GROUP BY ALL""",
    "dq_product_types": f"""
        {_with(*_TO_PRODUCTS, recursive=True)}
        SELECT 'several_product_types' AS check_name, 'warning' AS severity, 'dim_product' AS table_name,
               'product_business_key' AS key, count(*) AS n FROM types WHERE n_groups > 1 HAVING count(*) > 0""",
    "reference_tables": f"{_with(_SPOTS)} SELECT * FROM spots",
    "dq_control_mismatch": f"""
        {_with(_ROWS)} SELECT 'control_mismatch' AS check_name, 'warning' AS severity, 'staging' AS table_name,
               'sales_total_matches_control' AS key, count(*) AS n
        FROM r WHERE coalesce(suma, 0) <> coalesce(sold, 0) AND coalesce(code_raw, '') NOT IN ('CAT01-X-3-4', 'LARGE-7')""",
}


def _warehouse_tables() -> str:
    """Rows and checksums of the tables, each from its own SQL."""
    facts = _with(*_TO_FACTS, recursive=True)
    tables = {
        "dim_date": f"""{_with(_ROWS)} SELECT CAST(day(d) AS INTEGER) AS day FROM (SELECT unnest(generate_series(
            CAST(min(report_date) AS TIMESTAMP), CAST(max(report_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM r)""",
        "dim_spot": f"{_with(_SPOTS)} SELECT * FROM spots",
        "dim_sale_type": f"""{_with(_ROWS)} SELECT unnest(generate_series(1, count(DISTINCT CASE WHEN pct = 2 THEN 1 ELSE pct END)))
            AS sale_type_id FROM r""",
        "dim_movement_type": f"""{_with(_ROWS)} SELECT unnest(generate_series(1, 1 + count(DISTINCT flag)))
            AS movement_type_id FROM r""",
        "dim_product": ORACLE["dim_product"],
        "product_identity": f"{facts} SELECT product_business_key FROM ident",
    }
    tables |= {name: ORACLE[name] for name in CHECKSUMS if name.startswith("fact_")}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(sum({CHECKSUMS[name]}) AS BIGINT) AS checksum FROM ({sql})"
        for name, sql in tables.items()
    )


ORACLE["dq_daily_lookup"] = f"""
    WITH daily AS ({ORACLE["productcost_daily_lookup"]})
    SELECT * FROM (
      SELECT 'nulls' AS check_name, 'error' AS severity, 'productcost_daily_lookup' AS table_name, 'productcost' AS key,
             count(*) AS n FROM daily WHERE productcost < 950
      UNION ALL SELECT 'negative', 'warning', 'productcost_daily_lookup', 'productcost', count(*)
      FROM daily WHERE productcost >= 950
    ) WHERE n > 0"""
ORACLE["daily_lookup_in_order"] = f"""
    SELECT row_number() OVER (ORDER BY product_id, date) AS position, * FROM ({ORACLE["productcost_daily_lookup"]})"""
ORACLE["daily_lookup_by_month"] = f"""
    SELECT strftime(date, '%Y-%m') AS month, count(*) AS n_rows, count(DISTINCT product_id) AS n_products, min(date) AS first_day,
           CAST(sum(CAST(productcost AS DECIMAL(28, 8))) AS DOUBLE) AS productcost
    FROM ({ORACLE["productcost_daily_lookup"]}) GROUP BY month"""
ORACLE["published_tables"] = f"""
    {_with(_SPOTS)} SELECT 'spots' AS name, count(*) AS n_rows, CAST(sum(spot_id) AS DOUBLE) AS total FROM spots WHERE spot_id % 2 = 0
    UNION ALL SELECT 'parts', count(*), CAST(sum(CAST(p_retailprice AS DECIMAL(28, 8))) AS DOUBLE) FROM part"""
ORACLE["warehouse_tables"] = _warehouse_tables()
