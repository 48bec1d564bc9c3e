"""Equivalent SQL (DuckDB dialect) for every registered query, over the driver's tables.

Column names and types are aligned with the Spark results: counts are BIGINT, ranks and indexes
INTEGER, scores rounded the same way.
"""

from __future__ import annotations

from citeweave.operators.sampling import cumulative_thresholds
from citeweave.plans import analogues as A
from citeweave.schemas import LICENCE_CANONICAL, LICENCE_SPELLINGS, PARSE_SUFFIXES, RESOURCE_CODES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows, names) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else repr(v) for v in r) + ")"
                     for r in rows)
    return f"(VALUES {body}) AS t({', '.join(names)})"


_STOP = ", ".join(str(p) for p in A.STOP_PARTS)
_UUID_RE = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


def _uuid_sql(expr: str) -> str:
    h = f"md5(CAST({expr} AS VARCHAR))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            f"substr({h},17,4) || '-' || substr({h},21,12))")


_SUPPORT = f"""
  SELECT l_partkey, count(*) AS n
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_partkey NOT IN ({_STOP}))
  GROUP BY l_partkey HAVING count(*) >= {A.MIN_ITEM_SUPPORT}"""

_CO_ITEMS = f"""
  WITH s AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_partkey NOT IN ({_STOP})),
  sup AS (SELECT l_partkey FROM s GROUP BY l_partkey HAVING count(*) >= {A.MIN_ITEM_SUPPORT}),
  f AS (SELECT s.l_orderkey, s.l_partkey FROM s JOIN sup USING (l_partkey))
  SELECT a.l_partkey AS item_a, b.l_partkey AS item_b, count(*) AS n
  FROM f a JOIN f b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
  GROUP BY 1, 2 HAVING count(*) >= {A.MIN_PAIR_SUPPORT}"""

_CUTS = cumulative_thresholds(A.FRACTIONS)
_U = (f"(('0x' || substr(md5('{A.SEED}:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::UBIGINT)"
      f"::DOUBLE / 4294967296.0")
_SAMPLE_CASE = ("CASE " + " ".join(f"WHEN {_U} < {c!r} THEN {i}" for i, c in enumerate(_CUTS))
                + " END")


def _flag(c: str) -> str:
    return f"COALESCE(CASE WHEN {c} = 1 THEN 'true' WHEN {c} IS NOT NULL THEN 'false' END, 'null')"


_JSON_DOCS = f"""
  SELECT props AS j FROM events
  UNION ALL
  SELECT '{{"doc":{{"lang":"' || d.lang || '","source":"' || d.source || '","chars":' ||
         CAST(d.n_chars AS VARCHAR) || '}},"flags":[' || {_flag('l.quality')} || ',' ||
         {_flag('l.toxic')} || '],"ratio":' || printf('%.3f', d.n_chars / 8.0) ||
         ',"mixed":' || CASE WHEN d.doc_id % 2 = 0 THEN CAST(d.n_chars % 7 AS VARCHAR)
                             ELSE '"' || d.lang || '"' END ||
         ',"none":null,"empty":[]}}' AS j
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

_LEAVES = f"""
  leaves AS (
    SELECT regexp_replace(substr(t.fullkey, 2), '\\[[0-9]+\\]', '[]', 'g') AS path,
           CASE WHEN t.type = 'NULL' THEN 'null' WHEN t.type = 'BOOLEAN' THEN 'boolean'
                WHEN t.type = 'VARCHAR' THEN 'string' ELSE 'number' END AS cls,
           CASE WHEN t.type = 'BOOLEAN' THEN CAST(t.atom AS BOOLEAN) END AS b,
           CASE WHEN t.type IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT')
                THEN CAST(t.atom AS DOUBLE) END AS x,
           CASE WHEN t.type = 'VARCHAR' THEN json_extract_string(t.value, '$') END AS s
    FROM ({_JSON_DOCS}) docs, json_tree(docs.j) t
    WHERE t.type NOT IN ('OBJECT', 'ARRAY')),
  vals AS (
    SELECT path, cls, CASE WHEN cls = 'string' THEN s
                           WHEN cls = 'number' AND round(x) = x AND abs(x) < 1e18
                                THEN CAST(CAST(x AS BIGINT) AS VARCHAR)
                           WHEN cls = 'number' THEN CAST(x AS VARCHAR) END AS value
    FROM leaves WHERE cls IN ('string', 'number')),
  hist AS (SELECT path, value, count(*) AS n FROM vals GROUP BY path, value),
  nvals AS (SELECT path, count(*) AS n_values FROM hist GROUP BY path HAVING count(*) <= 20),
  stats AS (
    SELECT path,
           count(DISTINCT CASE WHEN cls <> 'null' THEN cls END) AS n_cls,
           max(CASE WHEN cls <> 'null' THEN cls END) AS one_cls,
           count(*) AS n_leaves,
           count(*) FILTER (WHERE b) AS n_true,
           count(*) FILTER (WHERE NOT b) AS n_false,
           bool_and(round(x) = x) AS integral,
           bool_and(CAST(CAST(x AS FLOAT) AS DOUBLE) = x) AS float32,
           min(x) AS mn, max(x) AS mx
    FROM leaves GROUP BY path),
  prof AS (
    SELECT s.path,
           CASE WHEN n_cls = 0 THEN 'empty' WHEN n_cls > 1 THEN 'conflict' ELSE one_cls END AS kind,
           s.n_leaves, s.n_true, s.n_false, s.integral, s.float32, s.mn, s.mx, v.n_values
    FROM stats s LEFT JOIN nvals v ON v.path = s.path)"""

_NUMBER_TYPE = """
  CASE WHEN integral AND mn < 0 THEN
         CASE WHEN mx <= 127 AND mn >= -128 THEN 'int8'
              WHEN mx <= 32767 AND mn >= -32768 THEN 'int16'
              WHEN mx <= 2147483647 AND mn >= -2147483648 THEN 'int32' ELSE 'int64' END
       WHEN integral THEN
         CASE WHEN mx <= 255 THEN 'uint8' WHEN mx <= 65535 THEN 'uint16'
              WHEN mx <= 4294967295 THEN 'uint32' ELSE 'uint64' END
       WHEN float32 THEN 'float32' ELSE 'float64' END"""


def _resource_names(key: str) -> str:
    parts = [f"CASE WHEN ({key} >> {i}) & 1 = 1 THEN [{_q(n)}] ELSE [] END"
             for i, (n, _) in enumerate(RESOURCE_CODES)]
    return "list_concat(" + ", ".join(parts) + ")"


def _resource_code_lambda(var: str) -> str:
    return ("CASE " + " ".join(f"WHEN {var} = {_q(n)} THEN {c}" for n, c in RESOURCE_CODES)
            + " END")


def _resource_name_lambda(var: str) -> str:
    return ("CASE " + " ".join(f"WHEN {var} = {c} THEN {_q(n)}" for n, c in RESOURCE_CODES)
            + " END")


_SPELLINGS = _values([(i, n, c) for i, (n, c) in enumerate(LICENCE_SPELLINGS)],
                     ["spelling_index", "spelling", "license"])
_CANON = _values([(c, n) for c, n in LICENCE_CANONICAL], ["license", "licence_name"])

_ID_RECORDS = f"""
  WITH p AS (SELECT page_id, url, html, md5(url) AS h FROM pages),
  r AS (
    SELECT page_id,
           substr(h,1,8) || '-' || substr(h,9,4) || '-' || substr(h,13,4) || '-' ||
             substr(h,17,4) || '-' || substr(h,21,12) AS id,
           CASE WHEN page_id % 7 = 0 THEN '00' || CAST(page_id AS VARCHAR)
                ELSE CAST(page_id AS VARCHAR) END AS pmid,
           'PMC' || CAST(page_id + 1000 AS VARCHAR) AS pmcid,
           CASE WHEN page_id % 5 = 0 THEN h || substr(md5(html), 1, 8)
                ELSE upper(h || substr(md5(html), 1, 8)) END AS istexId,
           {_resource_names('page_id')} AS resources,
           CAST(page_id % 24 AS INTEGER) AS spelling_index
    FROM p),
  recs AS (SELECT r.*, t.spelling AS license, t.license AS code
           FROM r JOIN {_SPELLINGS} ON t.spelling_index = r.spelling_index)"""

_FILE_NAMES = (
    "SELECT page_id, CASE WHEN page_id % {n} = {last} THEN 'x' ELSE {uuid} END || "
    "list_extract([{suffixes}], CAST(page_id % {n} AS INTEGER) + 1) AS name FROM pages").format(
    n=len(A.FILE_SUFFIXES), last=len(A.FILE_SUFFIXES) - 1, uuid=_uuid_sql("url"),
    suffixes=", ".join(_q(s) for s in A.FILE_SUFFIXES))


def _classify(name: str) -> str:
    ordered = sorted(PARSE_SUFFIXES, key=lambda p: -len(p[1]))
    whens = " ".join(
        f"WHEN regexp_matches({name}, {_q('^' + _UUID_RE + s.replace('.', chr(92) + '.') + '$')}) "
        f"THEN {_q(t)}" for t, s in ordered)
    return f"CASE {whens} END"


_BUILT = f"""
  WITH d AS (
    SELECT doc_id, text, source, lang, {_uuid_sql('doc_id')} AS uuid,
           string_split(text, chr(10)) AS lines,
           CASE WHEN doc_id % 10 = 0 THEN 0 ELSE 2000 + doc_id % 21 END AS yr
    FROM documents),
  m AS (SELECT doc_id, lines AS ms FROM d),
  papers AS (
    SELECT row_number() OVER (ORDER BY d.uuid) AS paper_id, d.doc_id, d.uuid AS source_uuid,
           nullif(split_part(d.text, chr(10), 1), '') AS title,
           CAST(nullif(d.yr, 0) AS INTEGER) AS published_year,
           CASE WHEN d.yr = 0 THEN NULL
                ELSE CAST(printf('%d-%02d-%02d', d.yr, d.doc_id % 12 + 1, d.doc_id % 28 + 1) AS DATE)
           END AS published_date,
           nullif(d.source, '') AS publication_venue, nullif(d.lang, '') AS publisher_name,
           CASE WHEN d.doc_id % 3 <> 0 THEN '10.1000/' || CAST(d.doc_id AS VARCHAR) ELSE '' END AS doi,
           CAST(NULL AS VARCHAR) AS pmcid, CAST(NULL AS VARCHAR) AS pmid,
           'journal-article' AS genre, CAST(NULL AS VARCHAR) AS license_type,
           len(m.ms) > 0 AS has_mentions, m.ms
    FROM d JOIN m USING (doc_id)),
  mentions_exploded AS (
    SELECT paper_id, doc_id, i - 1 AS mention_index, ms[i] AS line
    FROM (SELECT paper_id, doc_id, ms, unnest(generate_series(1, len(ms))) AS i FROM papers))"""


ORACLE = {
    "distinct_key_count": f"""
        SELECT count(DISTINCT user_id) AS n FROM events WHERE event_type = {_q(A.PURCHASE)}""",
    "yearly_counts_for_item": f"""
        SELECT CAST(year(o.o_orderdate) AS INTEGER) AS order_year, count(*) AS n
        FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = {_q(A.RETURNED)}) l
        JOIN orders o ON o.o_orderkey = l.l_orderkey
        WHERE year(o.o_orderdate) BETWEEN {A.YEARS[0]} AND {A.YEARS[1]}
        GROUP BY 1""",
    "popular_items_by_distinct_owner": f"""
        SELECT p_brand, count(*) AS n FROM (
          SELECT DISTINCT o.o_custkey, p.p_brand
          FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
          JOIN part p ON p.p_partkey = l.l_partkey
          WHERE o.o_orderdate >= TIMESTAMP '{A.RECENT_FROM}' AND l.l_discount > {A.MIN_DISCOUNT})
        GROUP BY p_brand""",
    "item_support": _SUPPORT,
    "item_support_total": f"SELECT count(*) AS n_items FROM ({_SUPPORT})",
    "top_items": f"""
        SELECT * FROM (
          SELECT l_partkey, n, CAST(row_number() OVER (ORDER BY n DESC, l_partkey) - 1 AS INTEGER)
                 AS rank FROM ({_SUPPORT}))
        WHERE rank < {A.TOP_ITEMS}""",
    "co_items": _CO_ITEMS,
    "top_co_items": f"""
        SELECT * FROM (
          SELECT item_a, item_b, n,
                 CAST(row_number() OVER (ORDER BY n DESC, item_a, item_b) - 1 AS INTEGER) AS rank
          FROM ({_CO_ITEMS}))
        WHERE rank < {A.TOP_PAIRS}""",
    "category_counts_zero_filled": """
        SELECT c.c_custkey, c.c_name, count(o.o_orderkey) AS n
        FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
        GROUP BY c.c_custkey, c.c_name""",
    "occurrence_counts": """
        SELECT p.p_name, count(*) AS n FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
        GROUP BY p.p_name""",
    "exploded_children": """
        SELECT printf('%10d.%s.%05d', doc_id, lang, i - 1) AS child_id, doc_id,
               CAST(i - 1 AS INTEGER) AS line_index, nullif(lines[i], '') AS line
        FROM (SELECT doc_id, lang, lines, unnest(generate_series(1, len(lines))) AS i
              FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents))""",
    "six_assessments": " UNION ALL ".join(
        f"SELECT l.l_orderkey, l.l_linenumber, '{scope}' AS scope, '{p}' AS purpose, "
        f"round({src}, 6) AS certainty_score FROM lineitem l JOIN "
        f"(SELECT l_orderkey, avg(l_quantity) AS d_quantity, avg(l_discount) AS d_discount, "
        f"avg(l_tax) AS d_tax FROM lineitem GROUP BY l_orderkey) m ON m.l_orderkey = l.l_orderkey"
        for scope, pre in (("document", "m.d_"), ("local", "l.l_"))
        for p in ("quantity", "discount", "tax")
        for src in [f"{pre}{p}"]),
    "children_exist_flag": """
        SELECT o.o_orderkey,
               EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS has_lines
        FROM orders o""",
    "strict_lookup": """
        SELECT l.l_orderkey AS o_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "lookup_violations": """
        SELECT o.o_orderkey, o.o_custkey FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "clean_rows": """
        SELECT o_orderkey, nullif(o_orderstatus, '') AS order_status,
               nullif(split_part(o_orderpriority, '-', 2), '') AS priority,
               CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS order_date,
               CAST(nullif(year(o_orderdate) - 1995, 0) AS INTEGER) AS year_offset
        FROM orders""",
    "dense_ids": f"""
        SELECT page_id, uuid, row_number() OVER (ORDER BY uuid, page_id) AS paper_id
        FROM (SELECT page_id, {_uuid_sql('url')} AS uuid FROM pages)""",
    "sample_assignment": f"""
        SELECT o_orderkey, sample FROM (
          SELECT o_orderkey, CAST({_SAMPLE_CASE} AS INTEGER) AS sample FROM orders o
          WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
        WHERE sample IS NOT NULL""",
    "sample_sizes": f"""
        SELECT sample, count(*) AS n FROM (
          SELECT CAST({_SAMPLE_CASE} AS INTEGER) AS sample FROM orders o
          WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
        WHERE sample IS NOT NULL GROUP BY sample""",
    "sampled_children": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, sample FROM (
          SELECT l_orderkey, l_linenumber, l_partkey,
                 CAST({_SAMPLE_CASE.replace('o_orderkey', 'l_orderkey')} AS INTEGER) AS sample
          FROM lineitem)
        WHERE sample IS NOT NULL""",
    "json_profile": f"""
        WITH {_LEAVES}
        SELECT path, kind, n_leaves,
               CASE WHEN kind = 'boolean' THEN n_true END AS n_true,
               CASE WHEN kind = 'boolean' THEN n_false END AS n_false,
               CASE WHEN kind = 'number' THEN {_NUMBER_TYPE} END AS number_type,
               CASE WHEN kind = 'number' THEN mn END AS min,
               CASE WHEN kind = 'number' THEN mx END AS max,
               CASE WHEN kind IN ('number', 'string') THEN n_values END AS n_values
        FROM prof""",
    "json_enums": f"""
        WITH {_LEAVES}
        SELECT h.path, h.value, h.n FROM hist h
        JOIN nvals v ON v.path = h.path
        JOIN prof p ON p.path = h.path AND p.kind IN ('string', 'number')""",
    "json_empty_paths": f"""
        WITH {_LEAVES}
        SELECT path, n_leaves FROM prof WHERE kind = 'empty'""",
    "json_type_conflicts": f"""
        WITH {_LEAVES}
        SELECT path, count(DISTINCT cls) AS n_types,
               array_to_string(list_sort(list(DISTINCT cls)), ',') AS types
        FROM leaves WHERE cls <> 'null' GROUP BY path HAVING count(DISTINCT cls) > 1""",
    "typed_ids": f"""
        {_ID_RECORDS}
        SELECT page_id, upper(replace(id, '-', '')) AS id_hex,
               CAST(pmid AS BIGINT) AS pmid,
               CAST(substr(pmcid, 4) AS BIGINT) AS pmcid_id,
               upper(istexId) AS istex_hex,
               array_to_string(list_transform(resources, lambda x: {_resource_code_lambda('x')}), ',')
                 AS resource_codes,
               CAST(code AS INTEGER) AS license
        FROM recs""",
    "id_roundtrip_violations": f"""
        {_ID_RECORDS}
        SELECT page_id, 'pmid' AS field FROM recs
          WHERE pmid <> CAST(CAST(pmid AS BIGINT) AS VARCHAR)
        UNION ALL
        SELECT page_id, 'istexId' AS field FROM recs WHERE istexId <> upper(istexId)""",
    "licence_codes": f"""
        SELECT d.doc_id, t.spelling, CAST(t.license AS INTEGER) AS license, c.licence_name
        FROM documents d JOIN {_SPELLINGS} ON t.spelling_index = d.doc_id % 24
        JOIN {_CANON.replace(' AS t(', ' AS c(')} ON c.license = t.license""",
    "licence_distribution": f"""
        SELECT CAST(c.license AS INTEGER) AS license, c.licence_name, count(d.doc_id) AS n
        FROM {_CANON.replace(' AS t(', ' AS c(')}
        LEFT JOIN (SELECT d.doc_id, t.license FROM documents d
                   JOIN {_SPELLINGS} ON t.spelling_index = d.doc_id % 24) d
          ON d.license = c.license
        GROUP BY c.license, c.licence_name""",
    "resource_codes": f"""
        SELECT doc_id, array_to_string(names, ',') AS resources,
               array_to_string(list_transform(names, lambda x: {_resource_code_lambda('x')}), ',')
                 AS codes,
               array_to_string(list_transform(list_transform(names,
                   lambda x: {_resource_code_lambda('x')}), lambda y: {_resource_name_lambda('y')}), ',')
                 AS names_back
        FROM (SELECT doc_id, {_resource_names('doc_id')} AS names FROM documents)""",
    "file_classes": f"""
        SELECT page_id, name, {_classify('name')} AS parse_type FROM ({_FILE_NAMES})""",
    "residual_files": f"""
        SELECT page_id, name FROM ({_FILE_NAMES}) WHERE {_classify('name')} IS NULL""",
    "bucket_collation": f"""
        SELECT substr(u, 1, 2) AS prefix, count(*) AS n_records,
               CAST(sum(n_chars) AS BIGINT) AS total_chars
        FROM (SELECT lower({_uuid_sql('doc_id')}) AS u, n_chars FROM documents)
        GROUP BY 1""",
    "uuid_order": f"""
        SELECT row_number() OVER (ORDER BY uuid, doc_id) AS position, doc_id, uuid
        FROM (SELECT doc_id, lower({_uuid_sql('doc_id')}) AS uuid FROM documents)""",
    "last_by_key": """
        SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
               arg_max(value, event_id) AS value
        FROM events GROUP BY user_id""",
    "slim_children": f"""
        SELECT upper(replace({_uuid_sql('doc_id')}, '-', '')) AS id_hex,
               CAST(len(lines) AS INTEGER) AS n_items,
               array_to_string(lines, '|') AS names
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)""",
    "slim_name_counts": """
        SELECT normalized_form, count(*) AS n FROM (
          SELECT unnest(string_split(text, chr(10))) AS normalized_form FROM documents)
        GROUP BY normalized_form""",
    "built_papers": f"""
        {_BUILT}
        SELECT paper_id, source_uuid, title, published_year, published_date, publication_venue,
               publisher_name, doi, pmcid, pmid, genre, license_type, has_mentions
        FROM papers""",
    "built_mentions": f"""
        {_BUILT}
        SELECT printf('%10d.%s.%05d', paper_id, 'pdf', mention_index) AS software_mention_id,
               paper_id, 'pdf' AS source_file_type, CAST(mention_index AS INTEGER) AS mention_index,
               split_part(line, ' ', 2) AS software_raw,
               split_part(line, ' ', 1) AS software_normalized,
               CAST(NULL AS VARCHAR) AS version_raw,
               nullif(split_part(line, ' ', 2), '') AS version_normalized,
               CAST(NULL AS VARCHAR) AS publisher_raw, CAST(NULL AS VARCHAR) AS publisher_normalized,
               CAST(NULL AS VARCHAR) AS language_raw, CAST(NULL AS VARCHAR) AS language_normalized,
               CAST(NULL AS VARCHAR) AS url_raw, CAST(NULL AS VARCHAR) AS url_normalized,
               nullif(line, '') AS context_full_text
        FROM mentions_exploded""",
    "built_assessments": f"""
        {_BUILT},
        cells AS (
          SELECT printf('%10d.%s.%05d', paper_id, 'pdf', mention_index) AS software_mention_id,
                 paper_id, CAST(mention_index AS INTEGER) AS mention_index, doc_id,
                 length(line) AS n
          FROM mentions_exploded)
        """ + " UNION ALL ".join(
        f"SELECT software_mention_id, paper_id, 'pdf' AS source_file_type, mention_index, "
        f"'{scope}' AS scope, '{purpose}' AS purpose, {expr} AS certainty_score FROM cells"
        for scope, purpose, expr in (
            ("document", "created", "CASE WHEN doc_id % 2 = 0 THEN (n % 4) / 10.0 ELSE 0.0 END"),
            ("document", "shared", "CASE WHEN doc_id % 2 = 0 THEN (n % 5) / 10.0 ELSE 0.0 END"),
            ("document", "used", "CASE WHEN doc_id % 2 = 0 THEN (n % 6) / 10.0 ELSE 0.0 END"),
            ("local", "created", "(n % 10) / 10.0"),
            ("local", "shared", "(n % 7) / 10.0"),
            ("local", "used", "(n % 3) / 10.0"))),
    "built_papers_mentioning": f"""
        {_BUILT}
        SELECT count(DISTINCT paper_id) AS n FROM mentions_exploded
        WHERE split_part(line, ' ', 1) = {_q(A.BUILT_ITEM)}""",
    "built_yearly_counts": f"""
        {_BUILT}
        SELECT p.published_year, count(*) AS n
        FROM (SELECT DISTINCT paper_id FROM mentions_exploded
              WHERE split_part(line, ' ', 1) = {_q(A.BUILT_ITEM)}) h
        JOIN papers p USING (paper_id)
        WHERE p.published_year BETWEEN 2000 AND 2020
        GROUP BY p.published_year""",
    "built_popular_used_since": f"""
        {_BUILT}
        SELECT software_normalized, count(*) AS n FROM (
          SELECT DISTINCT e.paper_id, split_part(e.line, ' ', 1) AS software_normalized
          FROM mentions_exploded e JOIN papers p USING (paper_id)
          WHERE p.published_year >= {A.BUILT_SINCE} AND e.doc_id % 2 = 0
            AND (length(e.line) % 6) / 10.0 > {A.BUILT_MIN_SCORE})
        GROUP BY software_normalized""",
    "json_report": f"""
        WITH {_LEAVES},
        kinds AS (
          SELECT path, kind, n_true, n_false, mn, mx, n_values,
                 CASE WHEN kind = 'number' THEN {_NUMBER_TYPE} END AS number_type
          FROM prof),
        ent AS (
          SELECT h.path,
                 string_agg(CASE WHEN k.kind = 'number' AND k.number_type LIKE 'float%'
                                 THEN printf('%f', CAST(h.value AS DOUBLE)) ELSE h.value END
                            || ':' || CAST(h.n AS VARCHAR) || ';', ''
                            ORDER BY CASE WHEN k.kind = 'number' THEN CAST(h.value AS DOUBLE) END
                                     NULLS FIRST, h.value) AS entries
          FROM hist h JOIN nvals v ON v.path = h.path JOIN kinds k ON k.path = h.path
          WHERE k.kind IN ('string', 'number')
          GROUP BY h.path)
        SELECT k.path,
               CASE WHEN kind = 'empty' THEN 'empty'
                    WHEN kind = 'boolean' THEN printf('true:%d;false:%d', n_true, n_false)
                    WHEN kind = 'number' THEN
                      (CASE WHEN number_type LIKE 'float%'
                            THEN printf('%s;%f;%f', number_type, mn, mx)
                            ELSE printf('%s;%d;%d', number_type, CAST(mn AS BIGINT),
                                        CAST(mx AS BIGINT)) END)
                      || COALESCE(';' || e.entries, '')
                    WHEN kind = 'string' AND n_values IS NOT NULL
                      THEN printf('enum;%d;', n_values) || COALESCE(e.entries, '')
                    WHEN kind = 'string' THEN 'string;'
                    ELSE kind END AS summary
        FROM kinds k LEFT JOIN ent e ON e.path = k.path""",
}
