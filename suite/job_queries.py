"""The job table. Every customer stands for one control row, good or bad in its own way."""

from __future__ import annotations

from suite.registry import query, rows_of
from tidemark.operators.jobs import active_jobs, mapping_violations, resolve_jobs
from tidemark.sources.connections import Connection

MAPPING = """CASE c_custkey % 11
  WHEN 0 THEN '*' WHEN 1 THEN ' ' WHEN 2 THEN NULL WHEN 3 THEN '["id"]' WHEN 4 THEN '{"id": {"source": "x"}}' WHEN 5 THEN '{"id": '
  WHEN 6 THEN '{"id": 7}'
  WHEN 7 THEN concat('{"c_custkey": "customer", "upper(c_name)": "', lower(c_mktsegment), '", "web.c_phone": "select"}')
  WHEN 8 THEN concat('{"', c_name, '": "label", "c-rank": "standing", "c_comment": "", "c_tag": null, "c_acctbal": "balance%"}')
  WHEN 9 THEN '{"": "x", "c nation": "nation", "c_custkey": "Order"}'
  ELSE '{"c_custkey": "customer", "c_acctbal": "balance", "c_name": "label"}' END"""

JOBS = f"""
SELECT c_custkey AS job_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'nightly' ELSE lower(c_mktsegment) END AS job_name,
       CASE WHEN c_nationkey < 2 THEN NULL WHEN c_nationkey < 12 THEN 'erp' ELSE 'web' END AS src_conn_id,
       CASE WHEN c_nationkey = 3 THEN ' ' ELSE concat(' db', CAST(c_nationkey AS VARCHAR(9)), ' ') END AS src_db_name,
       CASE WHEN c_nationkey = 4 THEN NULL ELSE 'dbo' END AS src_schema_name, c_name AS src_table_name,
       CASE WHEN c_acctbal > 8000 THEN concat('SELECT * FROM ', c_name) WHEN c_acctbal > 7000 THEN '  ' END AS src_rawsql,
       CASE WHEN c_acctbal > 0 THEN ' amount > 0 ' END AS src_where_statement, {MAPPING} AS fields_mapping,
       CASE WHEN c_acctbal > 0 THEN 'updated_at' END AS src_incr_field, ' 2024-01-01 ' AS incr_point,
       CASE c_custkey % 7 WHEN 0 THEN 'full' WHEN 1 THEN 'append' WHEN 2 THEN 'merge' WHEN 3 THEN 'initial' WHEN 4 THEN 'delta'
            WHEN 5 THEN NULL ELSE 'merge' END AS sync_mode,
       CASE WHEN c_nationkey = 5 THEN '' ELSE 'ods' END AS dst_schema_name, c_name AS dst_table_name, 'id' AS dst_pk,
       CASE WHEN c_acctbal < -500 THEN NULL ELSE c_acctbal < 9500 END AS inuse
FROM customer
"""

ACTIVE = f"""
SELECT job_id, job_name, src_conn_id, coalesce(src_db_name, '') AS src_db_name, coalesce(src_schema_name, '') AS src_schema_name,
       coalesce(src_table_name, '') AS src_table_name, coalesce(src_rawsql, '') AS src_rawsql,
       coalesce(src_where_statement, '') AS src_where_statement, coalesce(fields_mapping, '') AS fields_mapping,
       coalesce(src_incr_field, '') AS src_incr_field, coalesce(incr_point, '') AS incr_point, coalesce(sync_mode, '') AS sync_mode,
       coalesce(dst_schema_name, '') AS dst_schema_name, coalesce(dst_table_name, '') AS dst_table_name, coalesce(dst_pk, '') AS dst_pk
FROM ({JOBS}) j WHERE inuse AND sync_mode IN ('full', 'append', 'merge', 'initial')
"""

FLAT = """(CASE WHEN json_valid(raw) THEN json_type(raw) END = 'OBJECT' AND len(list_filter(
  CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT'
       THEN list_transform(json_keys(raw), lambda k: CASE WHEN k = '' THEN 'VARCHAR' ELSE json_type(raw, '$."' || k || '"') END) END,
  lambda ty: ty NOT IN ('VARCHAR', 'NULL'))) = 0)"""


@query("jobs_active", f"{ACTIVE} AND job_name = 'nightly'")
def jobs_active(spark, sf_dir):
    return active_jobs(rows_of(spark, sf_dir, JOBS), "nightly")


CONNECTIONS = (Connection("erp", "sqlserver", id="erp"), Connection("web", "pg", id="web"))


@query(
    "jobs_resolved",
    f"""WITH a AS (SELECT *, trim(src_rawsql) <> '' AS is_sql, src_schema_name <> '' AND src_table_name <> '' AS named,
                          trim(fields_mapping) AS raw FROM ({ACTIVE}) x)
        SELECT job_id, job_name, coalesce(src_conn_id, '') AS conn_id, trim(src_db_name) AS src_db_name,
               CASE WHEN is_sql THEN src_rawsql ELSE '' END AS source_sql,
               CASE WHEN is_sql OR NOT named THEN ''
                    WHEN coalesce(src_conn_id, '') = 'erp' THEN trim(src_db_name) || '.' || src_schema_name || '.' || src_table_name
                    ELSE src_schema_name || '.' || src_table_name END AS source_table,
               trim(src_where_statement) AS source_where, CASE WHEN raw IN ('', '*') THEN '' ELSE raw END AS mapping,
               src_incr_field AS incr_field, trim(incr_point) AS incr_point, sync_mode AS mode,
               dst_schema_name || '.' || dst_table_name AS target_table, dst_pk AS pk,
               CASE WHEN coalesce(src_conn_id, '') = '' THEN 'src_conn_id is empty'
                    WHEN dst_schema_name = '' OR dst_table_name = '' THEN 'dst_schema_name / dst_table_name is empty'
                    WHEN trim(src_db_name) = '' THEN 'src_db_name is empty'
                    WHEN raw NOT IN ('', '*') AND NOT coalesce({FLAT}, false) THEN 'fields_mapping is not a flat object of strings'
                    WHEN NOT is_sql AND NOT named THEN 'src_schema_name / src_table_name is empty and no sql provided'
                    ELSE '' END AS error
        FROM a""",
)
def jobs_resolved(spark, sf_dir):
    return resolve_jobs(active_jobs(rows_of(spark, sf_dir, JOBS)), CONNECTIONS)


@query(
    "mapping_violations",
    f"""WITH c AS (SELECT job_id, trim(fields_mapping) AS raw FROM ({JOBS}) j WHERE trim(fields_mapping) NOT IN ('', '*')),
             f AS (SELECT job_id, raw, coalesce({FLAT}, false) AS ok FROM c),
             k AS (SELECT job_id, raw, unnest(json_keys(raw)) AS source FROM (SELECT * FROM f WHERE ok) o),
             e AS (SELECT job_id, source, CASE WHEN source = '' THEN 'x'
                          ELSE coalesce(json_extract_string(raw, '$."' || source || '"'), '') END AS target FROM k),
             v AS (SELECT *, CASE WHEN source = '' THEN 'empty_source' WHEN target = '' THEN 'empty_target'
                          WHEN NOT regexp_full_match(target, '[A-Za-z0-9_]+') THEN 'bad_target'
                          WHEN lower(target) IN ('select', 'order') THEN 'reserved_target'
                          WHEN NOT regexp_full_match(source, '[A-Za-z0-9_]+') AND NOT regexp_matches(source, '[() ''"+*/%=,-]')
                          THEN 'odd_source' END AS violation FROM e)
        SELECT job_id, source, target, violation, CASE WHEN violation = 'odd_source' THEN 'warning' ELSE 'error' END AS severity
        FROM v WHERE violation IS NOT NULL
        UNION ALL SELECT job_id, '', '', 'bad_json', 'error' FROM f WHERE NOT ok""",
)
def violations(spark, sf_dir):
    return mapping_violations(rows_of(spark, sf_dir, JOBS))
