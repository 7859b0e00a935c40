"""DuckDB SQL computing what each registered query returns, from the base
tables only (views ``region nation customer supplier part orders lineitem
events documents embeddings pages benchmark labels conversations``).

Column names match the Spark side exactly.  Money sums are taken as
DECIMAL(18,2) on both sides so the totals do not depend on the order of
addition.
"""

from __future__ import annotations

from .registry import (
    B1_LANGUAGE,
    B1_YEAR,
    B2_FIRST,
    B2_LAST,
    B3_COUNTRY,
    B3_FIRST,
    B3_GENRE,
    B3_LAST,
    B4_GENRE,
    B4_YEAR,
    B5_FIRST,
    B5_LAST,
)

# Lineitems with the part and supplier attributes the catalog uses (the
# catalog joins lineitem to part, supplier, nation and region).
_LINES = """
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_quantity,
         p.p_type, p.p_brand, p.p_size, p.p_name, s.s_name, s.s_nationkey,
         n.n_name, r.r_name
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_GENRE_IDS = "SELECT p_type, CAST(min(p_partkey) AS BIGINT) AS genre_id FROM part GROUP BY p_type"

# Region -> language code, as in the catalog.
_REGION_LANG = """(VALUES ('AFRICA', 'sw'), ('AMERICA', 'en'), ('ASIA', 'zh'),
  ('EUROPE', 'de'), ('MIDDLE EAST', 'ar')) AS rl(r_name, lang_code)"""


def _year(col: str, year: int) -> str:
    return f"CAST({col} AS DATE) >= DATE '{year}-01-01' AND CAST({col} AS DATE) < DATE '{year + 1}-01-01'"


def _between(col: str, first: str, last: str) -> str:
    return f"CAST({col} AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'"


_GENDER = "CASE {x} WHEN 1 THEN 'F' WHEN 2 THEN 'M' WHEN 0 THEN 'U' END"

_ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_STAR_COUNTS = f"""
WITH li AS ({_LINES}),
g AS ({_GENRE_IDS})
SELECT 'dim_movies' AS "table", count(*) AS rows FROM orders
UNION ALL SELECT 'fact_movie_sales', count(*) FROM orders
UNION ALL SELECT 'dim_genres', count(DISTINCT p_type) FROM li
UNION ALL SELECT 'movie_genres', count(*) FROM (SELECT DISTINCT l_orderkey, p_type FROM li)
UNION ALL SELECT 'dim_companies', count(DISTINCT p_brand) FROM li
UNION ALL SELECT 'movie_production_companies', count(*) FROM (SELECT DISTINCT l_orderkey, p_brand FROM li)
UNION ALL SELECT 'dim_countries', count(DISTINCT s_nationkey) FROM li
UNION ALL SELECT 'movie_countries', count(*) FROM (SELECT DISTINCT l_orderkey, s_nationkey FROM li)
UNION ALL SELECT 'dim_languages', count(DISTINCT r_name) FROM li
UNION ALL SELECT 'movie_languages', count(*) FROM (SELECT DISTINCT l_orderkey, r_name FROM li)
UNION ALL SELECT 'dim_cast', count(DISTINCT l_suppkey) FROM li
UNION ALL SELECT 'movie_cast', count(*) FROM li
UNION ALL SELECT 'dim_crew', count(DISTINCT l_partkey) FROM li
UNION ALL SELECT 'movie_crew', count(*) FROM li
UNION ALL SELECT 'dim_keywords', count(DISTINCT l.l_partkey) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
UNION ALL SELECT 'movie_keywords', count(*) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
UNION ALL SELECT 'fact_rating', count(DISTINCT l_orderkey) FROM lineitem
"""

_RATING_STATS = """
SELECT CAST(l_orderkey AS BIGINT) AS movie_id,
       CAST(count(*) AS BIGINT) AS ratings_count,
       avg(CAST(ceil(l_quantity / 10) AS FLOAT)) AS ratings_average,
       CAST(min(CAST(ceil(l_quantity / 10) AS FLOAT)) AS DOUBLE) AS min_rate,
       CAST(max(CAST(ceil(l_quantity / 10) AS FLOAT)) AS DOUBLE) AS max_rate
FROM lineitem GROUP BY l_orderkey
"""

_MOVIE_LANGS = f"""
SELECT DISTINCT li.l_orderkey, rl.lang_code FROM ({_LINES}) li JOIN {_REGION_LANG} ON li.r_name = rl.r_name
"""

_GATE_ZERO_ROWS = [
    ("not_null", "dim_movies", "id"),
    ("not_null", "dim_languages", "name"),
    ("some_positive", "fact_movie_sales", "revenue"),
]


# Rows each movie-referencing table holds per movie, from the base tables.
_MOVIE_REFS = {
    "movie_cast": "SELECT l_orderkey AS m FROM li",
    "movie_crew": "SELECT l_orderkey AS m FROM li",
    "movie_genres": "SELECT DISTINCT l_orderkey AS m, p_type FROM li",
    "movie_keywords": "SELECT l.l_orderkey AS m FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey",
    "movie_production_companies": "SELECT DISTINCT l_orderkey AS m, p_brand FROM li",
    "movie_languages": "SELECT DISTINCT l_orderkey AS m, r_name FROM li",
    "movie_countries": "SELECT DISTINCT l_orderkey AS m, s_nationkey FROM li",
    "fact_movie_sales": "SELECT o_orderkey AS m FROM orders",
    "fact_rating": "SELECT DISTINCT l_orderkey AS m FROM lineitem",
}


def _gate_oracle(kept_movies: str | None = None) -> str:
    """Gate report over the derived warehouse.  Keys, nulls and references
    all hold on the full load; with ``kept_movies`` (a predicate on
    ``orders``) only those movies are in ``dim_movies`` and each reference to
    another movie is counted as an orphan."""
    from ..schemas import CREATE_ORDER, TABLES, foreign_keys

    parts = [f"SELECT '{r}' AS rule, '{t}' AS \"table\", '{c}' AS \"column\", CAST(0 AS BIGINT) AS violations" for r, t, c in _GATE_ZERO_ROWS]
    for name in CREATE_ORDER:
        key = ",".join(TABLES[name].primary_key)
        parts += [f"SELECT 'pk_not_null', '{name}', '{key}', CAST(0 AS BIGINT)", f"SELECT 'pk_unique', '{name}', '{key}', CAST(0 AS BIGINT)"]
    for name, fk in foreign_keys():
        if kept_movies and fk.parent == "dim_movies":
            parts.append(
                f"SELECT 'fk_orphans', '{name}', '{fk.column}', count(*) FROM ({_MOVIE_REFS[name]}) r "
                f"WHERE r.m NOT IN (SELECT o_orderkey FROM orders WHERE {kept_movies})"
            )
        else:
            parts.append(f"SELECT 'fk_orphans', '{name}', '{fk.column}', CAST(0 AS BIGINT)")
    return f"WITH li AS ({_LINES}) " + " UNION ALL ".join(parts)


SQL: dict[str, str] = {
    "csv_scan": "SELECT * FROM orders",
    "csv_prefix_union": "SELECT * FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM orders WHERE o_orderstatus <> 'F'",
    "csv_quoted_text": "SELECT doc_id, text FROM documents",
    "sql_view": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment IS NULL AS segment_missing FROM customer WHERE c_acctbal > 0 AND c_name IS NOT NULL",
    "project_rename_audit": "SELECT o_orderkey AS order_id, o_totalprice AS revenue, CAST(o_orderdate AS DATE) AS release_date FROM orders",
    "filter_not_null_fill": """
        SELECT c_custkey, NULLIF(c_nationkey, 0) AS c_nationkey,
               COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS c_acctbal
        FROM customer WHERE NULLIF(c_nationkey, 0) IS NOT NULL""",
    "filter_null_safe_neq": "SELECT doc_id, NULLIF(lang, 'fr') AS lang FROM documents WHERE NULLIF(lang, 'fr') IS DISTINCT FROM 'en'",
    "date_range": f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE {_between('o_orderdate', '1996-03-01', '1998-10-31')}",
    "year_filter": f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE {_year('o_orderdate', 1997)}",
    "json_key_lookup": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "json_bridge": """
        SELECT CAST(l.l_orderkey AS BIGINT) AS movie_id, CAST(l.l_partkey AS BIGINT) AS keyword_id
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "json_dim": f"""
        SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS id, s_name AS name, 'Agent of ' || n_name AS "character",
               {_GENDER.format(x='CAST(floor(s_nationkey / 7) AS INTEGER)')} AS gender
        FROM ({_LINES})""",
    "json_pyliteral": """
        SELECT c_custkey AS id, c_name AS name, NULLIF(c_mktsegment, 'HOUSEHOLD') AS segment,
               CASE WHEN c_acctbal > 5000 THEN 'true' ELSE 'false' END AS vip,
               'Yes, None, maybe' AS note, 'a' || chr(160) || 'b' AS tag
        FROM customer""",
    "movies_staged": f"""
        SELECT CAST(o.o_orderkey AS BIGINT) AS id, 'Order #' || o.o_orderkey AS title,
               'Order "' || o.o_orderkey || '", ' || o.o_orderpriority AS original_title,
               CAST(o.o_orderdate AS DATE) AS release_date, o.o_totalprice AS revenue, o.o_totalprice / 2 AS budget,
               COALESCE(CAST(x.vote_average AS FLOAT), 0) AS vote_average, COALESCE(CAST(x.n AS INTEGER), 0) AS vote_count,
               o.o_orderstatus AS status, o.o_orderstatus = 'P' AS adult, o.o_orderpriority = '1-URGENT' AS video
        FROM orders o LEFT JOIN (
            SELECT l_orderkey, count(*) AS n, CAST(max(l.l_discount) * 100 AS FLOAT) AS vote_average
            FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
            GROUP BY l_orderkey) x ON o.o_orderkey = x.l_orderkey""",
    "fact_sales": """
        SELECT CAST(o.o_orderkey AS BIGINT) AS movie_id, o.o_totalprice AS revenue, o.o_totalprice / 2 AS budget,
               CAST(COALESCE(CAST(x.vote_average AS FLOAT), 0) AS DOUBLE) AS vote_average,
               COALESCE(CAST(x.n AS INTEGER), 0) AS vote_count
        FROM orders o LEFT JOIN (
            SELECT l_orderkey, count(*) AS n, CAST(max(l.l_discount) * 100 AS FLOAT) AS vote_average
            FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
            GROUP BY l_orderkey) x ON o.o_orderkey = x.l_orderkey""",
    "language_dim": f"""
        SELECT DISTINCT rl.lang_code AS iso_code,
               CASE rl.lang_code WHEN 'sw' THEN 'Swahili' WHEN 'en' THEN 'English' WHEN 'zh' THEN 'Chinese'
                    WHEN 'de' THEN 'German' WHEN 'ar' THEN 'Arabic' END AS name,
               CASE rl.lang_code WHEN 'sw' THEN 'Kiswahili' WHEN 'en' THEN 'English' WHEN 'zh' THEN '中文'
                    WHEN 'de' THEN 'Deutsch' WHEN 'ar' THEN 'العربية' END AS original_name
        FROM ({_LINES}) li JOIN {_REGION_LANG} ON li.r_name = rl.r_name""",
    "dedup_ordered": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity,
                 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
          FROM lineitem) WHERE rn = 1""",
    "dedup_latest": """
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
          SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders) WHERE rn = 1""",
    "code_label": f"SELECT c_custkey, {_GENDER.format(x='c_nationkey')} AS label FROM customer",
    "lookup_name": """
        SELECT doc_id, lang, CASE lang WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish'
               WHEN 'fr' THEN 'French' ELSE 'Unknown language [' || lang || ']' END AS language
        FROM documents""",
    "group_stats": """
        SELECT l_partkey, count(l_quantity) AS n, avg(l_quantity) AS avg_qty, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty
        FROM lineitem GROUP BY l_partkey""",
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _ALL_TABLES),
    "profile": " UNION ALL ".join(
        f"SELECT 'customer' AS \"table\", '{c}' AS \"column\", '{t}' AS type, count(*) AS rows, count(*) FILTER (WHERE {e} IS NULL) AS nulls FROM customer"
        for c, t, e in [
            ("c_custkey", "bigint", "c_custkey"),
            ("c_name", "string", "c_name"),
            ("c_nationkey", "int", "c_nationkey"),
            ("c_acctbal", "double", "CASE WHEN c_acctbal >= 0 THEN c_acctbal END"),
            ("c_mktsegment", "string", "c_mktsegment"),
        ]
    ),
    "sorted_orders": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC",
    "top_revenue": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10",
    "surrogate_key": "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey FROM orders",
    "surrogate_key_payload": """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) AS id, l_orderkey, l_linenumber, l_partkey, l_quantity
        FROM lineitem""",
    "shifted_keys": """
        SELECT o_orderkey + 8589934592 AS movie_id, n AS ratings_count
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "distinct_count": "SELECT count(DISTINCT l_partkey) AS parts FROM lineitem",
    "append_read_back": f"""
        WITH pairs AS (SELECT DISTINCT CAST(li.l_orderkey AS BIGINT) AS movie_id, g.genre_id
                       FROM ({_LINES}) li JOIN ({_GENRE_IDS}) g ON li.p_type = g.p_type)
        SELECT * FROM pairs UNION ALL SELECT * FROM pairs""",
    "surrogate_ids_unique": f"""
        SELECT 2 * count(*) AS rows, 2 * count(*) AS ids, CAST(1 AS BIGINT) AS first_id FROM ({_LINES})""",
    "target_reset": _RATING_STATS,
    "pk_violations": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "fk_orphans": f"""
        SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey
                          AND {_between('o.o_orderdate', '1995-01-01', '1999-12-31')})""",
    "orphan_count": f"""
        SELECT 'fk_orphans' AS rule, 'lineitem' AS "table", 'l_orderkey' AS "column", count(*) AS violations
        FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey
                          AND {_between('o.o_orderdate', '1995-01-01', '1999-12-31')})""",
    "null_check": """
        SELECT 'not_null' AS rule, 'dim_movies' AS "table", 'id' AS "column", count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
        UNION ALL SELECT 'not_null', 'dim_languages', 'name', CAST(0 AS BIGINT)
        UNION ALL SELECT 'not_null', 'customer', 'c_acctbal', count(*) FILTER (WHERE c_acctbal < 0) FROM customer""",
    "positive_check": """
        SELECT 'some_positive' AS rule, 'fact_movie_sales' AS "table", 'revenue' AS "column",
               CAST(CASE WHEN count(*) FILTER (WHERE o_totalprice > 0) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM orders
        UNION ALL SELECT 'some_positive', 'customer', 'c_acctbal',
               CAST(CASE WHEN count(*) FILTER (WHERE c_acctbal < 0 AND c_acctbal > 0) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM customer""",
    "quality_gate": _gate_oracle(),
    "quality_gate_defects": _gate_oracle("CAST(o_orderdate AS DATE) < DATE '2000-01-01'"),
    "question_b1": f"""
        SELECT CAST(o.o_orderkey AS BIGINT) AS id, 'Order #' || o.o_orderkey AS title FROM orders o
        WHERE {_year('o.o_orderdate', B1_YEAR)}
          AND EXISTS (SELECT 1 FROM ({_MOVIE_LANGS}) m WHERE m.l_orderkey = o.o_orderkey)
          AND NOT EXISTS (SELECT 1 FROM ({_MOVIE_LANGS}) m WHERE m.l_orderkey = o.o_orderkey AND m.lang_code = '{B1_LANGUAGE}')""",
    "question_b2": f"""
        WITH m AS (SELECT o_orderkey FROM orders WHERE {_between('o_orderdate', B2_FIRST, B2_LAST)}),
        li AS (SELECT * FROM ({_LINES}) x WHERE x.l_orderkey IN (SELECT o_orderkey FROM m)),
        c AS (SELECT DISTINCT l_suppkey AS pid FROM li WHERE CAST(floor(s_nationkey / 7) AS INTEGER) = 1),
        r AS (SELECT DISTINCT l_partkey AS pid FROM li WHERE CAST(floor(p_size / 13) AS INTEGER) = 1)
        SELECT (SELECT count(*) FROM c) AS women_cast, (SELECT count(*) FROM r) AS women_crew,
               (SELECT count(*) FROM (SELECT pid FROM c UNION SELECT pid FROM r)) AS women_total""",
    "question_b3": f"""
        SELECT CAST(COALESCE(sum(CAST(o.o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS revenue, count(*) AS movies
        FROM orders o
        WHERE {_between('o.o_orderdate', B3_FIRST, B3_LAST)}
          AND EXISTS (SELECT 1 FROM ({_LINES}) li WHERE li.l_orderkey = o.o_orderkey
                      AND lpad(CAST(li.s_nationkey AS VARCHAR), 2, '0') = '{B3_COUNTRY}')
          AND EXISTS (SELECT 1 FROM ({_LINES}) li WHERE li.l_orderkey = o.o_orderkey AND li.p_type = '{B3_GENRE}')""",
    "question_b4": f"""
        SELECT CAST(o.o_orderkey AS BIGINT) AS id, 'Order #' || o.o_orderkey AS title, CAST(o.o_orderdate AS DATE) AS release_date
        FROM orders o
        WHERE {_year('o.o_orderdate', B4_YEAR)}
          AND EXISTS (SELECT 1 FROM ({_LINES}) li WHERE li.l_orderkey = o.o_orderkey AND li.p_type = '{B4_GENRE}')""",
    "question_b5": f"""
        WITH m AS (SELECT o_orderkey, o_totalprice FROM orders WHERE {_between('o_orderdate', B5_FIRST, B5_LAST)}),
        pairs AS (SELECT DISTINCT l_orderkey, p_brand FROM ({_LINES}))
        SELECT CAST(substr(p_brand, 7) AS BIGINT) AS company_id, p_brand AS company_name,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS movies
        FROM pairs JOIN m ON pairs.l_orderkey = m.o_orderkey
        GROUP BY p_brand ORDER BY revenue DESC, company_id""",
    "star_load": _STAR_COUNTS,
    "full_load": _STAR_COUNTS,
    "incremental_ingest": _RATING_STATS,
    "incremental_dims": """
        SELECT DISTINCT CAST(p.p_partkey AS BIGINT) AS id, p.p_name AS name
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
}


_LI_G = f"({_LINES}) li JOIN ({_GENRE_IDS}) g ON li.p_type = g.p_type"

SQL.update({
    "conform_lengths": """
        SELECT 'dim_cast' AS "table", count(*) FILTER (WHERE strlen(text) > 255) AS violations,
               CAST(0 AS BIGINT) AS failed_casts FROM documents""",
    "parse_losses": """
        SELECT c_mktsegment AS segment, count(*) AS rows,
               count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS null_or_blank,
               count(*) FILTER (WHERE c_mktsegment = 'FURNITURE') AS empty_list,
               count(*) FILTER (WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')) AS unparsed,
               count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') AS repairable,
               CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY', 'FURNITURE', 'BUILDING') THEN 0 ELSE 2 * count(*) END AS elements
        FROM customer GROUP BY c_mktsegment""",
    "table_dim_movies": """
        SELECT CAST(o_orderkey AS BIGINT) AS id, 'Order #' || o_orderkey AS title,
               'Order "' || o_orderkey || '", ' || o_orderpriority AS original_title,
               'Priority ' || o_orderpriority || ', status ' || o_orderstatus AS overview,
               o_orderstatus AS status, CAST(o_orderdate AS DATE) AS release_date, o_orderpriority = '1-URGENT' AS video
        FROM orders""",
    "table_dim_genres": f"SELECT DISTINCT g.genre_id AS id, li.p_type AS name FROM {_LI_G}",
    "table_movie_genres": f"SELECT DISTINCT CAST(li.l_orderkey AS BIGINT) AS movie_id, g.genre_id FROM {_LI_G}",
    "table_dim_companies": f"SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS id, p_brand AS name FROM ({_LINES})",
    "table_movie_production_companies": f"""
        SELECT DISTINCT CAST(l_orderkey AS BIGINT) AS movie_id, CAST(substr(p_brand, 7) AS BIGINT) AS company_id FROM ({_LINES})""",
    "table_dim_countries": f"SELECT DISTINCT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS iso_code, n_name AS name FROM ({_LINES})",
    "table_movie_countries": f"""
        SELECT DISTINCT CAST(l_orderkey AS BIGINT) AS movie_id, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS country_code FROM ({_LINES})""",
    "table_movie_languages": f"SELECT CAST(l_orderkey AS BIGINT) AS movie_id, lang_code AS language_code FROM ({_MOVIE_LANGS})",
    "table_movie_cast": f"SELECT CAST(l_orderkey AS BIGINT) AS movie_id, CAST(l_suppkey AS BIGINT) AS cast_id FROM ({_LINES})",
    "table_dim_crew": f"""
        SELECT DISTINCT CAST(l_partkey AS BIGINT) AS id, p_name AS name, p_type AS department,
               {_GENDER.format(x='CAST(floor(p_size / 13) AS INTEGER)')} AS gender, p_brand AS job
        FROM ({_LINES})""",
    "table_movie_crew": f"SELECT CAST(l_orderkey AS BIGINT) AS movie_id, CAST(l_partkey AS BIGINT) AS crew_id FROM ({_LINES})",
    "table_dim_keywords": """
        SELECT DISTINCT CAST(p.p_partkey AS BIGINT) AS id, p.p_name AS name
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "table_fact_rating": _RATING_STATS,
})

_HOT = "CAST(CASE WHEN l.l_linenumber <= 2 THEN 0 ELSE l.l_orderkey END AS BIGINT)"

SQL.update({
    "hot_key_bridge": f"""
        SELECT {_HOT} AS movie_id, CAST(l.l_partkey AS BIGINT) AS keyword_id
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "hot_key_ratings": f"""
        SELECT {_HOT} AS movie_id, CAST(count(*) AS BIGINT) AS ratings_count,
               avg(CAST(ceil(l.l_quantity / 10) AS FLOAT)) AS ratings_average,
               CAST(min(CAST(ceil(l.l_quantity / 10) AS FLOAT)) AS DOUBLE) AS min_rate,
               CAST(max(CAST(ceil(l.l_quantity / 10) AS FLOAT)) AS DOUBLE) AS max_rate
        FROM lineitem l GROUP BY 1""",
    "hot_key_semi": f"""
        SELECT CAST(o.o_orderkey AS BIGINT) AS id FROM orders o
        WHERE EXISTS (SELECT 1 FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                      WHERE p.p_type = 'PROMO' AND {_HOT} = o.o_orderkey)""",
})

SQL.update({
    "question_b1_original": f"""
        SELECT CAST(o.o_orderkey AS BIGINT) AS id, 'Order #' || o.o_orderkey AS title FROM orders o
        LEFT JOIN (SELECT l_orderkey, min(lang_code) AS lang FROM ({_MOVIE_LANGS}) GROUP BY l_orderkey) x
          ON x.l_orderkey = o.o_orderkey
        WHERE {_year('o.o_orderdate', B1_YEAR)} AND x.lang IS DISTINCT FROM '{B1_LANGUAGE}'""",
})

SQL["json_python_literal"] = SQL["json_pyliteral"]


def _lengths_sql(kind: str, movie: str, joins: str) -> str:
    return f"""
        SELECT '{kind}' AS kind, count(*) FILTER (WHERE n <= 1000) AS whole, count(*) FILTER (WHERE n > 1000) AS cut,
               CAST(sum(n) AS BIGINT) AS elements, CAST(0 AS BIGINT) AS too_long
        FROM (SELECT {movie} AS m, count(*) AS n FROM lineitem l {joins} GROUP BY 1)"""


_PART, _SUPP = "JOIN part p ON l.l_partkey = p.p_partkey", "JOIN supplier s ON l.l_suppkey = s.s_suppkey"
SQL["list_lengths"] = " UNION ALL ".join([
    _lengths_sql("keywords", "l.l_orderkey", _PART), _lengths_sql("credits", "l.l_orderkey", f"{_PART} {_SUPP}"), _lengths_sql("hot", _HOT, _PART),
])


def _digest_sql() -> str:
    """Rows and digest of the 17 tables: none after the failed try, all after."""
    from ..schemas import CREATE_ORDER, TABLES

    by_other_name = {"movie_keywords": "json_bridge", "dim_cast": "json_dim", "dim_languages": "language_dim", "fact_movie_sales": "fact_sales"}
    parts = []
    for name in CREATE_ORDER:
        t = TABLES[name]
        kept = sorted((c for c in t.columns if c.name not in ("last_updated", t.identity)), key=lambda c: c.name)
        texts = [f'CAST("{c.name}" AS DECIMAL(18,4))' if c.type.simpleString() == "double" else f'"{c.name}"' for c in kept]
        text = " || '|' || ".join(f"coalesce(CAST({x} AS VARCHAR), '~')" for x in texts)
        parts.append(f"""
            SELECT '{name}' AS "table", count(*) AS rows,
                   CAST(coalesce(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest
            FROM ({SQL[by_other_name.get(name, f"table_{name}")]}) x""")
    return f"""
        WITH d AS ({" UNION ALL ".join(parts)})
        SELECT 'failed' AS step, "table", CAST(0 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS digest FROM d
        UNION ALL SELECT 'rerun', * FROM d UNION ALL SELECT 'again', * FROM d"""


SQL.update({
    "load_retry": _digest_sql(),
    "rating_batches": _RATING_STATS,
    "merged_survivors": """
        SELECT step, CAST(p.p_partkey AS BIGINT) AS id,
               min(CASE WHEN l.l_linenumber % 2 = 1 THEN p.p_name WHEN p.p_partkey % 2 = 0 THEN 'A ' || p.p_name ELSE 'zz ' || p.p_name END) AS name
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey, (VALUES ('one'), ('two'), ('reversed')) AS s(step)
        GROUP BY step, p.p_partkey""",
    "merged_movies": f"""
        SELECT step, (SELECT count(*) FROM orders) AS movies, CAST(0 AS BIGINT) AS unlike_one, CAST(0 AS BIGINT) AS mixed,
               (SELECT count(*) FROM ({SQL["table_movie_genres"]}) g) AS genre_rows
        FROM (VALUES ('one'), ('two'), ('reversed')) AS s(step)""",
    "replayed_batch": SQL["json_bridge"],
    "reject_sink": """
        WITH c AS (SELECT c_mktsegment = 'HOUSEHOLD' AS bad_id, c_mktsegment = 'MACHINERY' AND 40 * strlen(c_name) > 256 AS long_name FROM customer),
        n AS (SELECT count(*) AS n, count(*) FILTER (WHERE bad_id) AS ids, count(*) FILTER (WHERE long_name) AS names FROM c)
        SELECT 'report' AS kind, 'dim_keywords' AS "table", '' AS reason, names AS n FROM n
        UNION ALL SELECT 'report', 'movie_keywords', '', ids FROM n
        UNION ALL SELECT 'reject', 'dim_keywords', 'name: over 256 bytes', names FROM n WHERE names > 0
        UNION ALL SELECT 'reject', 'movie_keywords', 'id: not bigint', ids FROM n WHERE ids > 0
        UNION ALL SELECT 'stored', 'dim_keywords', '', n - ids - names FROM n
        UNION ALL SELECT 'stored', 'movie_keywords', '', n - ids FROM n""",
    "load_parse_losses": """
        SELECT 'parse_loss' AS rule, 'keywords' AS "table", 'keywords' AS "column", count(*) FILTER (WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')) AS n FROM customer
        UNION ALL SELECT 'stored', 'movie_keywords', '*', count(*) FILTER (WHERE c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY', 'FURNITURE', 'BUILDING')) FROM customer""",
})
