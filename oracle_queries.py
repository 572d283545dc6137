"""DuckDB twins of the registered queries, written independently of them."""

from __future__ import annotations

# The domain views in DuckDB's dialect.
_BASE = """
base AS (
  SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) * (p_size + 10) // 10 AS cents FROM part
),
catalog_a AS (
  SELECT p_partkey AS _id, p_name || ' ' || p_brand AS nameitem, p_type AS main_category,
    p_type[1] || lower(p_type[2:]) || ' goods' AS sub_category,
    'img/' || p_partkey || '.jpg' AS image, 'shop.example/' || p_partkey AS link,
    CAST(p_size / 10.0 AS VARCHAR) AS user_ratings,
    CASE p_size WHEN 13 THEN 'n/a' WHEN 17 THEN NULL WHEN 19 THEN 'NULL' ELSE
      '₹' || format('{:,}', cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
    END AS reducedprice,
    '₹' || format('{:,}', cents * 6 // 5 // 100) || '.'
      || lpad(CAST(cents * 6 // 5 % 100 AS VARCHAR), 2, '0') AS actualprice
  FROM base
),
catalog_b AS (
  SELECT p_type AS category, upper(p_name) || ' ' || p_type AS name,
    CAST(p_size AS DOUBLE) / 10 AS ratings,
    CAST(cents * 9 // 10 AS DOUBLE) / 100 AS discount_price,
    CAST(cents AS DOUBLE) / 100 AS actual_price,
    p_brand AS seller_name, CAST(p_size AS DOUBLE) / 20 AS seller_rating,
    p_name || ' by ' || p_brand AS description, p_type || ', size ' || p_size AS highlights,
    'img/' || p_partkey || '.jpg' AS image_links
  FROM base
),
profiles AS (
  SELECT c_custkey AS _id, c_name AS user_name,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN 'u' || c_custkey || '@mail.example' END AS email,
    CAST(floor(c_acctbal) AS BIGINT) AS followers, c_nationkey AS posts,
    c_mktsegment AS business_type
  FROM customer
),
partnerships AS (
  SELECT event_id AS _id, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS username,
    'u' || user_id || '@mail.example' AS email,
    CASE event_type WHEN 'click' THEN 'Economy' WHEN 'view' THEN 'small'
      WHEN 'purchase' THEN 'Standard' WHEN 'signup' THEN 'LARGE' ELSE '' END AS business_category,
    split_part(p_name, ' ', 2) || ' ' || p_brand AS company_name, p_name AS product,
    CAST(k AS DOUBLE) / 100 AS profit_in_a_percent, value AS profit_in_b_percent
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
  JOIN part ON k = p_partkey
),
num_a AS (
  SELECT *, try_cast(replace(replace(reducedprice, '₹', ''), ',', '') AS DOUBLE) AS reduced,
    try_cast(replace(replace(actualprice, '₹', ''), ',', '') AS DOUBLE) AS actual
  FROM catalog_a
),
mediated_a AS (
  SELECT nameitem AS name, sub_category AS category, CAST(user_ratings AS DOUBLE) AS ratings,
    CAST(reduced AS DECIMAL(10,2)) AS discount_price, CAST(actual AS DECIMAL(10,2)) AS actual_price,
    'catalog_a' AS source
  FROM num_a WHERE reduced IS NOT NULL AND actual IS NOT NULL
),
mediated_b AS (
  SELECT name, category, ratings, CAST(discount_price AS DECIMAL(10,2)) AS discount_price,
    CAST(actual_price AS DECIMAL(10,2)) AS actual_price, 'catalog_b' AS source
  FROM catalog_b
)"""


def _q(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([_BASE.strip(), *more]) + "\n" + body


def _members(threshold: float) -> tuple[str, ...]:
    """Every name pair scored once, then every pair of their prices."""
    return (
        "ka AS (SELECT DISTINCT lower(name) AS n, CAST(discount_price AS DOUBLE) AS p FROM mediated_a)",
        "kb AS (SELECT DISTINCT lower(name) AS n, CAST(discount_price AS DOUBLE) AS p FROM mediated_b)",
        """sims AS (
          SELECT x.n AS na, y.n AS nb, jaro_winkler_similarity(x.n, y.n) AS s
          FROM (SELECT DISTINCT n FROM ka) x, (SELECT DISTINCT n FROM kb) y)""",
        f"""hits AS (
          SELECT ka.n AS na, ka.p AS pa, kb.n AS nb, kb.p AS pb
          FROM sims JOIN ka ON ka.n = na JOIN kb ON kb.n = nb
          WHERE 0.7 * s + 0.3 * (1 - abs(ka.p - kb.p) / greatest(ka.p, kb.p)) >= {threshold})""",
        """matched AS (
          SELECT DISTINCT * FROM mediated_a
          WHERE (lower(name), CAST(discount_price AS DOUBLE)) IN (SELECT (na, pa) FROM hits)
          UNION ALL
          SELECT DISTINCT * FROM mediated_b
          WHERE (lower(name), CAST(discount_price AS DOUBLE)) IN (SELECT (nb, pb) FROM hits))""",
    )


_DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Fields of catalog A's documents; a null field is absent from its document.
_FIELDS = (
    """fields AS (
      SELECT f, pos FROM (
        SELECT unnest([
          {'f': '_id', 'pos': 0, 'v': true},
          {'f': 'nameitem', 'pos': 1, 'v': main_category <> 'PROMO'},
          {'f': 'nameitems', 'pos': 1, 'v': main_category = 'PROMO'},
          {'f': 'main_category', 'pos': 2, 'v': true}, {'f': 'sub_category', 'pos': 3, 'v': true},
          {'f': 'image', 'pos': 4, 'v': true}, {'f': 'link', 'pos': 5, 'v': true},
          {'f': 'user_ratings', 'pos': 6, 'v': true},
          {'f': 'reducedprice', 'pos': 7, 'v': reducedprice IS NOT NULL},
          {'f': 'actualprice', 'pos': 8, 'v': true}], recursive := true)
        FROM catalog_a) WHERE v)""",
    """cols_b AS (
      SELECT * FROM (VALUES (1, 'category'), (2, 'name'), (3, 'ratings'), (4, 'discount_price'),
        (5, 'actual_price'), (6, 'description'), (7, 'highlights'), (8, 'image_links')) t(bt, b))""",
    "cols_a AS (SELECT DISTINCT f AS a, pos FROM fields WHERE f <> '_id')",
)


def _last_matches(columns_a: str) -> tuple[str, ...]:
    return (
        f"""hits AS (
          SELECT a, pos, b, bt, jaro_winkler_similarity(a, b) AS s FROM {columns_a}, cols_b
          WHERE jaro_winkler_similarity(a, b) > 0.7)""",
        "lasts AS (SELECT a, min(pos) AS pos, max_by(b, bt) AS b, max_by(s, bt) AS s FROM hits GROUP BY a)",
        """wanted AS (
          SELECT unnest(['name', 'category', 'ratings', 'discountprice', 'actualprice',
            'imagelinks']) AS w)""",
        """best_a AS (
          SELECT w, a, row_number() OVER (PARTITION BY w
            ORDER BY jaro_winkler_similarity(a, w) DESC, pos, a) AS r FROM wanted, lasts)""",
        """best_b AS (
          SELECT w, b, row_number() OVER (PARTITION BY w
            ORDER BY jaro_winkler_similarity(b, w) DESC, pos, a) AS r FROM wanted, lasts)""",
        """mapping AS (
          SELECT w AS attribute,
            CASE w WHEN 'discountprice' THEN 'reducedprice' ELSE a END AS column_a,
            CASE w WHEN 'discountprice' THEN 'discount_price' ELSE b END AS column_b
          FROM (SELECT * FROM best_a WHERE r = 1) JOIN (SELECT * FROM best_b WHERE r = 1) USING (w))""",
    )


def _indel(a: str, b: str) -> str:
    """Indel ratio of two short texts: LCS by a bit row over HUGEINT, one step
    per character of ``b``."""
    full = f"((1::HUGEINT << length({a})) - 1)"
    places = (
        f"list_sum(list_transform(range(length({a})), lambda nth_:"
        f" CASE WHEN {a}[nth_ + 1] = char_ THEN 1::HUGEINT << nth_ ELSE 0::HUGEINT END))::HUGEINT"
    )
    masks = f"list_transform(string_split({b}, ''), lambda char_: {places})"
    step = "((row_ + (row_ & mask_)) | (row_ - (row_ & mask_)))"
    final = f"list_reduce({masks}, lambda row_, mask_: {step} & {full}, {full})"
    return f"2.0::DOUBLE * (length({a}) - bit_count({final})) / (length({a}) + length({b}))"


def _aggregates(table: str, keys: str, *extra: str) -> str:
    return f"SELECT {', '.join([keys, *extra])} FROM {table} GROUP BY {keys}"


_MEASURES = (
    "count(*) AS count",
    "sum(l_quantity) AS sum_l_quantity",
    "round(avg(l_discount), 10) AS avg_l_discount",
    "min(l_extendedprice) AS min_l_extendedprice",
    "max(l_extendedprice) AS max_l_extendedprice",
)

_INGESTED = """SELECT CAST(_id AS VARCHAR) AS _id, nameitem, sub_category,
  reduced AS reducedprice, actual AS actualprice FROM num_a"""

_COMMON = """SELECT user_name, p.email, followers, business_type, company_name, product,
  profit_in_a_percent, profit_in_b_percent, s._id AS sale_id, p._id AS profile_id
  FROM profiles p JOIN partnerships s ON p.email IS NOT DISTINCT FROM s.email"""
_ONLY_PROFILES = """SELECT * FROM profiles p WHERE NOT EXISTS (
  SELECT 1 FROM partnerships s WHERE s.email IS NOT DISTINCT FROM p.email)"""
_ONLY_SALES = """SELECT * FROM partnerships s WHERE NOT EXISTS (
  SELECT 1 FROM profiles p WHERE s.email IS NOT DISTINCT FROM p.email)"""

_OVERLAP_VALUES = (
    """vals AS (
      SELECT DISTINCT o, c, v FROM (SELECT unnest([
        {'o': 1, 'c': 'sub_category', 'v': sub_category},
        {'o': 2, 'c': 'image', 'v': image}, {'o': 3, 'c': 'link', 'v': link},
        {'o': 4, 'c': 'user_ratings', 'v': user_ratings},
        {'o': 5, 'c': 'reducedprice', 'v': reducedprice},
        {'o': 6, 'c': 'actualprice', 'v': actualprice}], recursive := true) FROM catalog_a))""",
    """cats AS (
      SELECT DISTINCT business_category AS k FROM partnerships WHERE business_category <> '')""",
    f"scored AS (SELECT o, c, k, v, {_indel('k', 'v')} AS s FROM vals, cats WHERE v <> '')",
)

_TFIDF = (
    "names AS (SELECT DISTINCT nameitem AS name FROM catalog_a)",
    "asked AS (SELECT 'small ring Brand#7' AS name)",
    """docs AS (
      SELECT 0 AS is_query, name, unnest(regexp_extract_all(lower(name), '\\b\\w\\w+\\b')) AS t FROM names
      UNION ALL
      SELECT 1, name, unnest(regexp_extract_all(lower(name), '\\b\\w\\w+\\b')) FROM asked)""",
    "tfs AS (SELECT is_query, name, t, count(*) AS tf FROM docs GROUP BY ALL)",
    """idfs AS (
      SELECT t, ln((2.0::DOUBLE + (SELECT count(*) FROM names)) / (1 + count(*))) + 1 AS idf
      FROM tfs GROUP BY t)""",
    "w AS (SELECT is_query, name, t, tf * idf AS w FROM tfs JOIN idfs USING (t))",
    "norms AS (SELECT is_query, name, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL)",
    """cosines AS (
      SELECT d.name, sum(d.w * q.w) AS dot FROM w d JOIN w q USING (t)
      WHERE d.is_query = 0 AND q.is_query = 1 GROUP BY d.name)""",
    """ranked AS (
      SELECT names.name, coalesce(dot / n.norm / (SELECT norm FROM norms WHERE is_query = 1), 0) AS cosine,
        jaro_winkler_similarity('small ring Brand#7', names.name) AS jaro_winkler
      FROM names LEFT JOIN cosines USING (name)
      LEFT JOIN norms n ON n.name = names.name AND n.is_query = 0)""",
)

_PAIRED = (
    """da AS (
      SELECT lower(name || ' ' || category) AS n, CAST(discount_price AS DOUBLE) AS p, count(*) AS c
      FROM mediated_a GROUP BY ALL)""",
    """db AS (
      SELECT lower(description || ' ' || category || ' goods') AS n, discount_price AS p, count(*) AS c
      FROM catalog_b GROUP BY ALL)""",
    """pairs AS (
      SELECT da.n AS name_a, da.p AS price_a, da.c AS rows_a, db.n AS name_b, db.p AS price_b,
        db.c AS rows_b, 1 - abs(da.p - db.p) / greatest(da.p, db.p) AS ps
      FROM da JOIN db ON 1 - abs(da.p - db.p) / greatest(da.p, db.p) >= 0.8)""",
    "scored AS (SELECT *, jaro_winkler_similarity(name_a, name_b) AS js FROM pairs)",
)

_PARTNERS = """SELECT username, email, business_category, company_name, product, profit_in_a_percent,
           profit_in_b_percent, nameitem, sub_category, image, link, user_ratings, reducedprice,
           actualprice, 'sub_category' AS matched_column
           FROM partnerships JOIN catalog_a ON business_category <> ''
             AND contains(lower(sub_category), lower(business_category))
             AND contains(lower(nameitem), lower(company_name))"""

_SNAPSHOT = f"""
        SELECT 'driver' AS source, table_name AS "table", ordinal_position AS ordinal,
          column_name AS "column",
          CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
            WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
            ELSE lower(data_type) END AS type
        FROM information_schema.columns
        WHERE table_name IN ({", ".join(f"'{t}'" for t in _DRIVER_TABLES)})"""

# The order of a load by all its columns, nulls first.
_FIRST = ", ".join(f"{c} NULLS FIRST" for c in ("name", "category", "ratings", "discount_price", "actual_price"))
_LOADED = ", ".join(
    f"{c} NULLS FIRST"
    for c in ("name", "category", "ratings", "discountprice", "actualprice", "imagelinks", "source")
)

ORACLE: dict[str, str] = {
    # sources
    "scan_relational": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "scan_document": _q(
        """SELECT CAST(_id AS VARCHAR) AS _id,
           CASE WHEN main_category <> 'PROMO' THEN nameitem END AS nameitem,
           CASE WHEN main_category = 'PROMO' THEN nameitem END AS nameitems, reducedprice
           FROM catalog_a"""
    ),
    "scan_drop_id": _q("SELECT nameitem, sub_category, link FROM catalog_a"),
    "scan_id_as_string": _q("SELECT CAST(_id AS VARCHAR) AS _id, nameitem FROM catalog_a"),
    "global_view": _q("SELECT * FROM catalog_b"),
    "global_view_keyed": _q(
        """SELECT row_number() OVER (ORDER BY category, name, image_links) AS primary_key,
           category, name, ratings, discount_price, actual_price, description, highlights,
           image_links FROM catalog_b"""
    ),
    "combined_view": _q("SELECT * EXCLUDE (main_category) FROM catalog_a"),
    "ingest_csv_clean": _q(_INGESTED),
    "ingest_json_clean": _q(_INGESTED),
    "catalog_snapshot": _SNAPSHOT,
    "field_profile": _q(
        """SELECT f AS field, CAST(pos AS INTEGER) AS ordinal, count(*) AS n_docs,
           count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM catalog_a) AS presence
           FROM fields GROUP BY f, pos""",
        *_FIELDS,
    ),
    # sinks
    "sink_overwrite": _q("SELECT * FROM mediated_a"),
    "sink_overwrite_many": _q(
        f"""SELECT 'common' AS output, p.*, s.* EXCLUDE (_id, email)
           FROM profiles p JOIN partnerships s ON p.email = s.email
           UNION ALL BY NAME SELECT 'only_profiles' AS output, * FROM ({_ONLY_PROFILES})
           UNION ALL BY NAME SELECT 'only_sales' AS output, * FROM ({_ONLY_SALES})"""
    ),
    "sink_append": _q("SELECT * FROM mediated_a UNION ALL SELECT * FROM mediated_b"),
    "sink_append_new_only": _q(
        "SELECT * FROM mediated_a UNION SELECT * FROM mediated_b"
    ),
    "surrogate_key": _q(
        """SELECT row_number() OVER (ORDER BY discount_price DESC, name, image_links) AS id,
           discount_price, name, image_links FROM catalog_b"""
    ),
    "coerce_to_contract": _q(
        """SELECT nameitem AS name, sub_category AS category, CAST(user_ratings AS DOUBLE) AS ratings,
           CAST(reduced AS DECIMAL(10,2)) AS discount_price,
           CAST(actual AS DECIMAL(10,2)) AS actual_price, 'catalog_a' AS source FROM num_a"""
    ),
    "append_validated": _q("SELECT * FROM mediated_b"),
    "insert_values": _q(
        """SELECT * FROM catalog_b UNION ALL SELECT 'ECONOMY', 'TIN WATERING CAN', 3.0, 12.75,
           18.5, 'Brand#77', 4.1, 'holds six litres', 'green, with a long spout', 'garden/can.png'"""
    ),
    "write_with_count": _q(
        "SELECT count(*) AS n_reported, count(*) AS n_found FROM mediated_a"
    ),
    # projection and predicates
    "project": _q("SELECT user_name, followers FROM profiles"),
    "project_star": _q("SELECT * FROM profiles"),
    "project_alias": _q(
        "SELECT nameitem AS name, reducedprice AS discount_price FROM catalog_a"
    ),
    "project_available": _q("SELECT nameitem, link FROM catalog_a"),
    "project_mapped": _q(
        """SELECT nameitem AS name, sub_category AS category, user_ratings AS ratings,
           reducedprice AS discount_price, actualprice AS actual_price FROM catalog_a"""
    ),
    "render_text": "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM customer",
    "render_json": """SELECT '{' || concat_ws(',', '"doc_id":' || doc_id, '"quality":' || quality,
        '"toxic":' || toxic) || '}' AS json FROM labels""",
    "source_tag": _q(
        """SELECT name, category, ratings, discount_price, actual_price, 'catalog_b' AS source
           FROM catalog_b"""
    ),
    "like_ci": _q("SELECT name, image_links FROM catalog_b WHERE name ILIKE '%Ring%'"),
    "like_prefix": _q("SELECT name, image_links FROM catalog_b WHERE name ILIKE 'small%'"),
    "like_bare_word": _q("SELECT name, image_links FROM catalog_b WHERE name ILIKE '%gear%'"),
    "regex_ci": "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, 'LICEN[SC]E', 'i')",
    "filter_gt": """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        WHERE l_extendedprice > 90000""",
    "filter_eq": _q(
        """SELECT username, company_name, product FROM partnerships
           WHERE business_category = 'Standard'"""
    ),
    "having_avg": _q(
        """SELECT name, round(avg(discount_price), 9) AS avg_price FROM catalog_b GROUP BY name
           HAVING avg(discount_price) > 2500"""
    ),
    "having_sum": """SELECT l_suppkey, sum(l_quantity) AS sum_quantity, count(*) AS count
        FROM lineitem GROUP BY l_suppkey HAVING sum(l_quantity) > 15000""",
    "drop_null_rows": _q(
        """SELECT _id, nameitem, reducedprice FROM catalog_a
           WHERE reducedprice IS NOT NULL AND reducedprice <> 'NULL'"""
    ),
    "quarantine_bad_price": _q(
        """SELECT CASE WHEN reduced IS NULL OR actual IS NULL THEN 'rejected' ELSE 'loaded' END AS status,
           nameitem AS name, sub_category AS category, CAST(user_ratings AS DOUBLE) AS ratings
           FROM num_a"""
    ),
    # joins
    "lookup_nested": _q(
        """SELECT p._id AS profile_id, user_name, CAST(coalesce(s._id % 64, 0) AS INTEGER) AS chunk,
           CAST(count(s._id) OVER (PARTITION BY p._id, s._id % 64) AS INTEGER) AS n_matched, s.*
           FROM profiles p LEFT JOIN partnerships s ON p.email = s.email"""
    ),
    "common_profiles": _q(f"SELECT * EXCLUDE (sale_id, profile_id) FROM ({_COMMON})"),
    "exclusive_profiles": _q(
        f"SELECT user_name, email, followers, business_type FROM ({_ONLY_PROFILES})"
    ),
    "exclusive_sales": _q(_ONLY_SALES),
    "overlap_split": _q(
        f"""SELECT 'common' AS kind, p.*, s.* EXCLUDE (_id, email)
           FROM profiles p JOIN partnerships s ON p.email = s.email
           UNION ALL BY NAME SELECT 'only_profiles' AS kind, * FROM ({_ONLY_PROFILES})
           UNION ALL BY NAME SELECT 'only_sales' AS kind, * FROM ({_ONLY_SALES})"""
    ),
    "join_inner": _q(
        """SELECT user_name, followers, product, profit_in_a_percent
           FROM profiles JOIN partnerships ON user_name = username"""
    ),
    "entity_match": _q("SELECT * FROM matched", *_members(0.7)),
    "entity_match_strict": _q("SELECT * FROM matched", *_members(0.9)),
    "entity_match_pairs": _q(
        """SELECT name_a, price_a, rows_a, name_b, price_b, rows_b,
           round(js, 6) AS name_similarity, round(ps, 6) AS price_similarity,
           round(0.7 * js + 0.3 * ps, 6) AS score FROM scored WHERE 0.7 * js + 0.3 * ps >= 0.95""",
        *_PAIRED,
    ),
    "column_overlap": _q(
        """SELECT c AS "column", round(s, 6) AS ratio FROM scored ORDER BY s DESC, o LIMIT 1""",
        *_OVERLAP_VALUES,
    ),
    "partner_products": _q(_PARTNERS),
    "schema_match_last": _q(
        "SELECT a AS column_a, b AS column_b, round(s, 6) AS similarity FROM lasts",
        *_FIELDS,
        *_last_matches("cols_a"),
    ),
    "schema_match_best": _q(
        """SELECT a AS column_a, b AS column_b, round(s, 6) AS similarity FROM (
             SELECT a, b, jaro_winkler_similarity(lower(a), lower(b)) AS s,
               row_number() OVER (PARTITION BY a
                 ORDER BY jaro_winkler_similarity(lower(a), lower(b)) DESC, bt) AS r
             FROM cols_a, cols_b) WHERE r = 1 AND s >= 0.85""",
        *_FIELDS,
    ),
    "mediated_mapping": _q("SELECT * FROM mapping", *_FIELDS, *_last_matches("cols_a")),
    # The assignment found there, applied to the combined view.
    "mediated_union": _q(
        """SELECT nameitem AS name, sub_category AS category, user_ratings AS ratings,
           reducedprice AS discountprice, actualprice, image AS imagelinks, 'catalog_a' AS source
           FROM catalog_a
           UNION ALL
           SELECT name, category, CAST(ratings AS VARCHAR), CAST(discount_price AS VARCHAR),
           CAST(actual_price AS VARCHAR), image_links, 'catalog_b' FROM catalog_b"""
    ),
    "tfidf_rank": _q(
        """SELECT name, round(cosine, 6) AS cosine, round(jaro_winkler, 6) AS jaro_winkler,
           round(greatest(cosine, jaro_winkler), 6) AS score FROM ranked""",
        *_TFIDF,
    ),
    # aggregation
    "agg_count": _q(
        """SELECT business_type, count(*) AS count, count(email) AS n_emails FROM profiles
           GROUP BY business_type"""
    ),
    "agg_sum": _aggregates("lineitem", "l_partkey", "sum(l_quantity) AS sum_l_quantity"),
    "agg_avg": _aggregates("lineitem", "l_suppkey", "round(avg(l_quantity), 10) AS avg_l_quantity"),
    "agg_min": _aggregates("orders", "o_custkey", "min(o_totalprice) AS min_o_totalprice"),
    "agg_max": _aggregates("orders", "o_custkey", "max(o_totalprice) AS max_o_totalprice"),
    "agg_global": """SELECT count(*) AS count, sum(l_quantity) AS sum_l_quantity,
        min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice
        FROM lineitem""",
    "agg_count_distinct": _aggregates(
        "lineitem", "l_returnflag", "count(DISTINCT l_partkey) AS n_parts"
    ),
    "group_single": _aggregates("lineitem", "l_returnflag", *_MEASURES),
    "group_multi": _aggregates("lineitem", "l_returnflag, l_linestatus", *_MEASURES),
    "group_nested_key": """SELECT '{"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"'
        || o_orderpriority || '"}' AS _id, count(*) AS count FROM orders
        GROUP BY o_orderstatus, o_orderpriority""",
    "distinct": _q("SELECT DISTINCT business_type FROM profiles"),
    "dedup_rows": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "distinct_values": _q("SELECT DISTINCT email FROM partnerships"),
    "top_rows_report": _q(
        """(SELECT 'most_followed' AS type, CAST(_id AS VARCHAR) AS id, email FROM profiles
            ORDER BY followers DESC, _id LIMIT 1)
           UNION ALL
           (SELECT 'top_a_profit', CAST(_id AS VARCHAR), email FROM partnerships
            ORDER BY profit_in_a_percent DESC, _id LIMIT 1)
           UNION ALL
           (SELECT 'top_b_profit', CAST(_id AS VARCHAR), email FROM partnerships
            ORDER BY profit_in_b_percent DESC, _id LIMIT 1)"""
    ),
    # order and limit
    "order_desc": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY 2 DESC, 1",
    "order_asc": _q(
        "SELECT name, actual_price, image_links FROM catalog_b ORDER BY actual_price, image_links"
    ),
    "order_multi": """SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders
        ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey""",
    "order_price_text": _q(
        """SELECT _id, reducedprice, coalesce(reduced, 0) AS price FROM num_a
           ORDER BY price DESC, _id"""
    ),
    "limit": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5",
    "topk": """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10""",
    "topk_filtered": _q(
        """SELECT _id, username, company_name, product, profit_in_a_percent FROM partnerships
           WHERE profit_in_a_percent > 0.15 ORDER BY profit_in_a_percent DESC, _id LIMIT 5"""
    ),
    "topk_federated": _q(
        """SELECT * FROM (
             (SELECT name, discount_price, image_links FROM catalog_b
              ORDER BY 2 DESC NULLS LAST, 1, 3 LIMIT 20)
             UNION ALL
             (SELECT nameitem, reduced, image FROM num_a ORDER BY 2 DESC NULLS LAST, 1, 3 LIMIT 20))
           ORDER BY 2 DESC NULLS LAST, 1, 3 LIMIT 10"""
    ),
    # set operations
    "union_all": _q(
        """SELECT name, discount_price AS price FROM catalog_b
           UNION ALL SELECT nameitem, reduced FROM num_a"""
    ),
    "union_by_name_complete": _q(
        """SELECT name, highlights AS price_text FROM catalog_b
           UNION ALL SELECT nameitem, reducedprice FROM catalog_a
           WHERE reducedprice IS NOT NULL AND reducedprice <> 'NULL'"""
    ),
    # pipelines
    "pipeline_resolve_entities": _q(
        f"SELECT row_number() OVER (ORDER BY {_FIRST}, source NULLS FIRST) AS id, * FROM matched", *_members(0.7)
    ),
    "pipeline_load_mediated": _q(
        f"""SELECT row_number() OVER (ORDER BY {_LOADED}) AS id, * FROM (
           SELECT nameitem AS name, sub_category AS category, CAST(user_ratings AS DOUBLE) AS ratings,
             reduced AS discountprice, actual AS actualprice, image AS imagelinks, 'catalog_a' AS source
           FROM num_a
           UNION
           SELECT name, category, ratings, discount_price, actual_price, image_links, 'catalog_b'
           FROM catalog_b)"""
    ),
    "pipeline_influencer_overlap": _q(
        f"""SELECT 'common' AS output, p.*, s.* EXCLUDE (_id, email)
           FROM profiles p JOIN partnerships s ON p.email = s.email
           UNION ALL BY NAME SELECT 'only_profiles' AS output, * FROM ({_ONLY_PROFILES})
           UNION ALL BY NAME SELECT 'only_sales' AS output, * FROM ({_ONLY_SALES})
           UNION ALL BY NAME (SELECT 'most_followed' AS output, * FROM profiles
             ORDER BY followers DESC, _id LIMIT 1)
           UNION ALL BY NAME (SELECT 'top_a_profit' AS output, * FROM partnerships
             ORDER BY profit_in_a_percent DESC, _id LIMIT 1)
           UNION ALL BY NAME (SELECT 'top_b_profit' AS output, * FROM partnerships
             ORDER BY profit_in_b_percent DESC, _id LIMIT 1)"""
    ),
    "pipeline_partner_products": _q(_PARTNERS),
    "pipeline_refresh_catalog": _SNAPSHOT.replace("'driver'", "'refreshed'"),
    "metadata_json_sink": _q(
        """SELECT 'described_' || s AS source, t AS "table", CAST(i AS INTEGER) AS ordinal, c AS "column",
           lower(CASE k WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE k END) AS "type" FROM (
           SELECT 'shop_a' AS s, 'items' AS t, unnest(range(1, 10)) AS i, unnest(['_id', 'nameitem',
             'main_category', 'sub_category', 'image', 'link', 'user_ratings', 'reducedprice', 'actualprice']) AS c,
             unnest([typeof(_id), typeof(nameitem), typeof(main_category), typeof(sub_category), typeof(image),
             typeof(link), typeof(user_ratings), typeof(reducedprice), typeof(actualprice)]) AS k
             FROM (SELECT * FROM catalog_a LIMIT 1)
           UNION ALL
           SELECT 'shop_b', 'products', unnest(range(1, 11)), unnest(['category', 'name', 'ratings',
             'discount_price', 'actual_price', 'seller_name', 'seller_rating', 'description', 'highlights', 'image_links']),
             unnest([typeof(category), typeof(name), typeof(ratings), typeof(discount_price), typeof(actual_price),
             typeof(seller_name), typeof(seller_rating), typeof(description), typeof(highlights), typeof(image_links)])
             FROM (SELECT * FROM catalog_b LIMIT 1)
           UNION ALL
           SELECT 'social', 'profiles', unnest(range(1, 7)), unnest(['_id', 'user_name', 'email', 'followers',
             'posts', 'business_type']), unnest([typeof(_id), typeof(user_name), typeof(email), typeof(followers),
             typeof(posts), typeof(business_type)]) FROM (SELECT * FROM profiles LIMIT 1))"""
    ),
    "image_link_match": _q(
        """SELECT DISTINCT nameitem AS name, image AS link FROM catalog_a WHERE EXISTS (
             SELECT 1 FROM catalog_b WHERE jaro_winkler_similarity(lower(image), lower(image_links)) > 0.6)
           UNION ALL
           SELECT DISTINCT name, image_links FROM catalog_b WHERE EXISTS (
             SELECT 1 FROM catalog_a WHERE jaro_winkler_similarity(lower(image), lower(image_links)) > 0.6)"""
    ),
    "partner_products_regex": _q(
        _PARTNERS.replace(
            "contains(lower(sub_category), lower(business_category))",
            "regexp_matches(sub_category, '(?i)^' || business_category || '\\b')",
        ).replace("SELECT username, email, business_category", "SELECT username, email, '^' || business_category || '\\b' AS business_category")
    ),
    "limit_bare": "SELECT count(o_orderkey) AS n_rows FROM (SELECT * FROM orders LIMIT 7)",
    # scalar functions
    "price_to_number": _q("SELECT _id, reduced, actual FROM num_a"),
    "price_similarity": """SELECT l_orderkey, l_linenumber,
        round(1 - abs(l_extendedprice - l_quantity * 1000)
          / greatest(l_extendedprice, l_quantity * 1000), 10) AS similarity FROM lineitem""",
    "jaro_winkler": """SELECT p_partkey, round(jaro_winkler_similarity(
        p_name || ' ' || p_brand, lower(p_name || ' ' || p_type)), 6) AS similarity FROM part""",
    "indel_ratio": f"""SELECT p_partkey, round({_indel('a', 'b')}, 6) AS similarity FROM (
        SELECT p_partkey, p_name || ' ' || p_brand AS a, lower(p_name || ' ' || p_type) AS b
        FROM part)""",
    # SQL surface
    "sql_over_views": _q(
        """SELECT name, round(discount_price, 9) AS discount_price FROM (
             SELECT name, discount_price FROM catalog_b WHERE ratings > 4.5
             UNION ALL SELECT nameitem, reduced FROM num_a WHERE lower(nameitem) LIKE '%ring%'
             UNION ALL SELECT business_type, avg(followers) FROM profiles
             GROUP BY business_type HAVING count(*) > 10)"""
    ),
    "sql_over_mediated": _q(
        """SELECT source, category, count(*) AS count, min(discount_price) AS min_price,
           max(actual_price) AS max_price FROM matched WHERE ratings > 2 GROUP BY source, category""",
        *_members(0.7),
    ),
    "category_compare": _q(
        "SELECT upper(split_part(category, ' ', 1)) AS kind, "
        + ", ".join(
            f"""count(*) FILTER (source = '{s}') AS {s}_products,
            CAST(sum(discount_price) FILTER (source = '{s}') AS DOUBLE) AS {s}_total_price,
            round(avg(ratings) FILTER (source = '{s}'), 10) AS {s}_rating"""
            for s in ("catalog_a", "catalog_b")
        )
        + " FROM matched GROUP BY kind",
        *_members(0.7),
    ),
}
