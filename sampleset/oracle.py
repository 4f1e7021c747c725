"""The registered queries again, written by hand in SQL for another engine.

``TABLES`` holds the layers as common table expressions; a query names the ones
it reads and gets them, with all they depend on, as its WITH clause.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"
TODAY = "DATE '2001-08-02'"

TABLES: dict[str, str] = {}

# --- raw tables ---------------------------------------------------------------

TABLES["b_lines"] = """
SELECT *, (year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS month_number,
       l_partkey % 25 + 1 AS component_id
FROM lineitem"""

TABLES["b_order_lines"] = """
SELECT l_orderkey, count(*) AS lines, min(l_suppkey) AS supplier,
       max(l_shipdate) AS last_shipped, sum(l_quantity) AS quantity,
       list_sort(list(DISTINCT l_returnflag)) AS flags,
       list_sort(list(DISTINCT month_number)) AS months,
       list_sort(list(DISTINCT component_id)) AS components,
       list_sort(list(DISTINCT year(l_shipdate))) AS years
FROM b_lines GROUP BY l_orderkey"""

TABLES["b_issues"] = """
SELECT o_orderkey AS id,
       concat_ws('-', n_name, CAST(o_orderkey AS VARCHAR)) AS key,
       n_name AS project_key,
       'Order ' || o_orderkey AS summary,
       CASE o_orderstatus WHEN 'O' THEN 'To Do' WHEN 'P' THEN 'In Progress' WHEN 'F' THEN 'Done' END AS status,
       substr(o_orderpriority, 1, 1) AS priority_id,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Critical' WHEN '2' THEN 'High'
            WHEN '3' THEN 'Medium' WHEN '4' THEN 'Unspecified' WHEN '5' THEN 'Low' END AS priority,
       CASE o_orderkey % 5 WHEN 0 THEN 'Epic' WHEN 1 THEN 'Bug' WHEN 2 THEN 'Story'
            WHEN 3 THEN 'Task' WHEN 4 THEN 'Sub-task' END AS issue_type,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey - o_orderkey % 5 END AS parent_id,
       o_orderdate AS created,
       greatest(o_orderdate, last_shipped) AS updated,
       CASE WHEN o_orderstatus = 'F' AND last_shipped IS NOT NULL
            THEN greatest(o_orderdate, last_shipped) END AS resolved,
       CASE WHEN o_orderstatus = 'F' AND last_shipped IS NOT NULL THEN
            CASE o_orderkey % 3 WHEN 0 THEN 'Done' WHEN 1 THEN 'Won''t Do' ELSE 'Duplicate' END
       END AS resolution,
       'C' || o_custkey AS reporter,
       'S' || supplier AS assignee,
       CAST(o_orderdate AS DATE) + 45 AS due_date,
       flags AS labels,
       CAST(lines AS DOUBLE) AS story_points,
       CAST(quantity * 600 AS BIGINT) AS time_spent_seconds,
       list_transform(months, lambda m: CAST(c_nationkey AS BIGINT) * 1000 + m) AS sprint_ids,
       components AS component_ids,
       list_transform(years, lambda y: CAST(c_nationkey AS BIGINT) * 10000 + y) AS version_ids
FROM orders
LEFT JOIN b_order_lines ON l_orderkey = o_orderkey
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey"""

TABLES["b_sprint_ids"] = "SELECT DISTINCT unnest(sprint_ids) AS id FROM b_issues"

TABLES["b_sprint_months"] = """
SELECT id, CAST(id // 1000 AS BIGINT) AS project,
       make_timestamp(1995 + (id % 1000 - 1) // 12, (id % 1000 - 1) % 12 + 1, 1, 0, 0, 0) AS start_date
FROM b_sprint_ids"""

TABLES["b_field_values"] = """
SELECT l_orderkey AS issue_id, 'status' AS field_id,
       CAST(l_linenumber % 4 + 1 AS VARCHAR) AS value, l_shipdate AS updated_at
FROM b_lines
UNION ALL
SELECT l_orderkey, 'assignee', 'S' || l_suppkey, l_shipdate FROM b_lines
UNION ALL
SELECT l_orderkey, 'labels', l_returnflag, l_shipdate FROM b_lines
UNION ALL
SELECT l_orderkey, 'components', CAST(component_id AS VARCHAR), l_shipdate FROM b_lines"""

TABLES["b_links"] = """
SELECT l_orderkey AS source_id,
       CASE WHEN l_orderkey % 50 <> 49 THEN l_orderkey + 1 END AS target_id,
       CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS link_type_id,
       CASE l_returnflag WHEN 'A' THEN 'blocks' WHEN 'N' THEN 'relates to'
            WHEN 'R' THEN 'duplicates' END AS relationship,
       CASE l_returnflag WHEN 'A' THEN 'is blocked by' WHEN 'N' THEN 'relates to'
            WHEN 'R' THEN 'is duplicated by' END AS inward
FROM b_lines"""

# --- silver -------------------------------------------------------------------

TABLES["s_issue_comment"] = """
SELECT conv_id || '-' || turn AS id, CAST(conv_id AS VARCHAR) AS issue_id, role AS author_id,
       CAST(NULL AS VARCHAR) AS update_author_id, text AS body,
       CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM conversations"""

TABLES["s_issue_type"] = """
SELECT DISTINCT o_orderkey % 5 AS id,
       CASE o_orderkey % 5 WHEN 0 THEN 'Epic' WHEN 1 THEN 'Bug' WHEN 2 THEN 'Story'
            WHEN 3 THEN 'Task' ELSE 'Sub-task' END AS name,
       CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS icon_url,
       o_orderkey % 5 = 4 AS is_subtask
FROM orders"""

TABLES["s_project"] = """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS project_key,
       'Project ' || n_nationkey AS name, CAST(NULL AS VARCHAR) AS description,
       CAST(n_regionkey AS BIGINT) AS project_category_id,
       CASE WHEN n_nationkey % 2 = 0 THEN 'software' ELSE 'business' END AS project_type_key,
       (SELECT 'S' || min(s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey) AS lead_id,
       CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS style,
       n_nationkey % 10 = 9 AS is_archived
FROM nation"""

TABLES["s_project_category"] = """
SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name,
       (SELECT nullif(count(*), 0) || ' customers' FROM customer JOIN nation ON n_nationkey = c_nationkey
        WHERE n_regionkey = r_regionkey) AS description
FROM region"""

TABLES["s_project_role"] = """
SELECT min(p_partkey) AS id, p_type AS name, 'Works on ' || p_type AS description
FROM part GROUP BY p_type"""

TABLES["s_project_role_actor"] = """
SELECT CAST(s_nationkey AS BIGINT) AS project_id, s_suppkey % 5 AS role_id,
       'S' || s_suppkey AS actor_id, 'user' AS actor_type, s_name AS actor_name
FROM supplier"""

TABLES["s_user"] = """
SELECT 'C' || c_custkey AS account_id, c_name AS display_name,
       lower(c_name) || '@example.com' AS email, c_acctbal >= 0 AS is_active,
       'customer' AS account_type, CAST(NULL AS VARCHAR) AS locale, CAST(NULL AS VARCHAR) AS time_zone
FROM customer
UNION ALL
SELECT 'S' || s_suppkey, s_name, lower(s_name) || '@example.com', s_acctbal >= 0, 'agent', NULL, NULL
FROM supplier"""

TABLES["s_priority"] = """
SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Critical' WHEN '2' THEN 'High'
            WHEN '3' THEN 'Medium' WHEN '4' THEN 'Unspecified' WHEN '5' THEN 'Low' END AS name,
       CAST(NULL AS VARCHAR) AS description,
       CASE WHEN substr(o_orderpriority, 1, 1) <= '2' THEN 'red' ELSE 'gray' END AS color,
       CAST(NULL AS VARCHAR) AS icon_url
FROM orders"""

TABLES["s_resolution"] = """
SELECT DISTINCT o_orderkey % 3 AS id,
       CASE o_orderkey % 3 WHEN 0 THEN 'Done' WHEN 1 THEN 'Won''t Do' ELSE 'Duplicate' END AS name,
       CAST(NULL AS VARCHAR) AS description
FROM orders"""

TABLES["s_field"] = """
SELECT DISTINCT
       CASE l_linenumber % 4 WHEN 0 THEN 'status' WHEN 1 THEN 'assignee'
            WHEN 2 THEN 'labels' ELSE 'components' END AS id,
       CASE l_linenumber % 4 WHEN 0 THEN 'Status' WHEN 1 THEN 'Assignee'
            WHEN 2 THEN 'Labels' ELSE 'Components' END AS name,
       CAST(NULL AS VARCHAR) AS description, FALSE AS is_custom,
       CASE WHEN l_linenumber % 4 >= 2 THEN 'array' ELSE 'string' END AS schema_type,
       CASE WHEN l_linenumber % 4 >= 2 THEN 'string' END AS schema_items
FROM lineitem"""

TABLES["s_issue_worklog"] = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
       CAST(l_orderkey AS VARCHAR) AS issue_id, 'S' || l_suppkey AS author_id,
       CAST(l_quantity * 600 AS BIGINT) AS time_spent_seconds, l_shipdate AS started_at,
       l_shipdate AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at, CAST(NULL AS VARCHAR) AS comment
FROM lineitem"""

TABLES["s_issue_watcher"] = """
SELECT CAST(event_id AS VARCHAR) AS issue_id, 'C' || user_id AS watcher_id FROM events"""

TABLES["s_component"] = """
SELECT p_partkey % 25 + 1 AS id, 'Component ' || (p_partkey % 25 + 1) AS name,
       count(*) || ' parts' AS description, 'S' || (p_partkey % 25 + 1) AS lead_id,
       (p_partkey % 25 + 1) % 25 AS project_id, 'PROJECT_LEAD' AS assignee_type
FROM part GROUP BY p_partkey % 25"""

TABLES["b_version_ids"] = "SELECT DISTINCT unnest(version_ids) AS id FROM b_issues"

TABLES["s_version"] = """
SELECT id, 'Release ' || (id % 10000) AS name, CAST(NULL AS VARCHAR) AS description,
       id % 10000 < 1997 AS is_archived, id % 10000 < 2001 AS is_released,
       make_date(id % 10000, 12, 31) AS release_date, make_date(id % 10000, 1, 1) AS start_date
FROM b_version_ids"""

TABLES["s_board"] = """
SELECT CAST(n_nationkey + 1000 AS BIGINT) AS id, 'Board ' || n_name AS name,
       CASE WHEN n_nationkey % 2 = 0 THEN 'scrum' ELSE 'kanban' END AS board_type,
       CAST(n_nationkey AS BIGINT) AS project_id,
       (SELECT min(c_custkey) FROM customer WHERE c_nationkey = n_nationkey) AS filter_id,
       'project' AS location_type
FROM nation"""

TABLES["s_project_board"] = """
SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS project_id,
       CAST(c_nationkey + 1000 AS BIGINT) AS board_id
FROM customer"""

TABLES["s_sprint"] = f"""
SELECT id, project + 1000 AS board_id, 'Sprint ' || id AS name,
       CASE WHEN start_date + INTERVAL 1 MONTH <= {AS_OF} THEN 'closed'
            WHEN start_date <= {AS_OF} THEN 'active' ELSE 'future' END AS state,
       start_date, start_date + INTERVAL 1 MONTH AS end_date,
       CASE WHEN start_date + INTERVAL 1 MONTH <= {AS_OF}
            THEN start_date + INTERVAL 1 MONTH END AS complete_date,
       'Ship ' || strftime(start_date, '%Y-%m') AS goal
FROM b_sprint_months"""

TABLES["s_user_group"] = """
SELECT 'C' || c_custkey AS account_id, lower(c_mktsegment) AS group_id, c_mktsegment AS group_name
FROM customer
UNION ALL
SELECT 'C' || c_custkey, 'nation-' || c_nationkey, 'NATION ' || c_nationkey
FROM customer WHERE c_custkey % 3 = 0"""

TABLES["s_application_role"] = """
SELECT lower(c_mktsegment) AS application_role_key,
       upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS name,
       CAST(NULL AS VARCHAR) AS description, CAST(count(*) AS INTEGER) AS user_count,
       CAST(count(DISTINCT c_nationkey) AS INTEGER) AS group_count
FROM customer GROUP BY c_mktsegment"""

TABLES["s_permission_scheme"] = """
SELECT min(p_partkey) AS id, 'Permissions ' || p_type AS name, 'Granted for ' || p_type AS description
FROM part GROUP BY p_type"""

TABLES["s_security_scheme"] = """
SELECT min(p_partkey) AS id, p_brand AS name, 'Security of ' || p_brand AS description,
       CAST(min(p_size) AS BIGINT) AS default_security_level_id
FROM part GROUP BY p_brand"""

TABLES["s_security_level"] = """
SELECT min(p_partkey) AS id, p_brand || '/' || p_size AS name, 'Level ' || p_size AS description,
       CAST(p_size AS BIGINT) AS security_scheme_id
FROM part GROUP BY p_brand, p_size"""

TABLES["s_project_permission"] = """
SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS project_id, 'browse' AS permission,
       'group' AS holder_type, lower(c_mktsegment) AS holder_value
FROM customer"""

TABLES["s_group"] = """
SELECT DISTINCT group_id AS id, group_name AS name FROM s_user_group WHERE group_id IS NOT NULL"""

TABLES["s_project_version"] = """
SELECT DISTINCT id // 10000 AS project_id, id AS version_id FROM b_version_ids"""

TABLES["s_issue_link_type"] = """
SELECT DISTINCT CAST(link_type_id AS BIGINT) AS id, relationship AS name,
       inward AS inward_description, relationship AS outward_description
FROM b_links WHERE relationship IS NOT NULL"""

TABLES["s_status_category"] = """
SELECT DISTINCT
       CAST(CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'P' THEN 4 WHEN 'F' THEN 3 END AS BIGINT) AS id,
       CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'P' THEN 'indeterminate' WHEN 'F' THEN 'done' END AS category_key,
       CASE o_orderstatus WHEN 'O' THEN 'To Do' WHEN 'P' THEN 'In Progress' WHEN 'F' THEN 'Done' END AS name,
       CASE o_orderstatus WHEN 'O' THEN 'blue-gray' WHEN 'P' THEN 'yellow' WHEN 'F' THEN 'green' END AS color_name
FROM orders"""

TABLES["s_status"] = """
WITH steps AS (
  SELECT DISTINCT l_linenumber % 4 + 1 AS id FROM lineitem
), named AS (
  SELECT id,
         CASE id WHEN 1 THEN 'To Do' WHEN 2 THEN 'In Progress' WHEN 3 THEN 'In Review' ELSE 'Done' END AS name,
         CASE id WHEN 1 THEN 'To Do' WHEN 4 THEN 'Done' ELSE 'In Progress' END AS category
  FROM steps
)
SELECT CAST(n.id AS BIGINT) AS id, n.name, CAST(NULL AS VARCHAR) AS description,
       c.id AS status_category_id, CAST(NULL AS VARCHAR) AS icon_url
FROM named n LEFT JOIN s_status_category c ON c.name = n.category"""

TABLES["s_issue"] = """
SELECT CAST(i.id AS VARCHAR) AS id, i.key AS issue_key, p.id AS project_id, t.id AS issue_type_id,
       i.summary, CAST(NULL AS VARCHAR) AS description, pr.id AS priority_id, s.id AS status_id,
       r.id AS resolution_id, i.reporter AS reporter_id, i.assignee AS assignee_id,
       i.reporter AS creator_id, CAST(i.parent_id AS VARCHAR) AS parent_id,
       i.created AS created_at, i.updated AS updated_at, i.resolved AS resolved_at, i.due_date,
       CAST(NULL AS VARCHAR) AS environment, i.labels, i.story_points,
       CAST(NULL AS BIGINT) AS original_estimate_seconds,
       CAST(NULL AS BIGINT) AS remaining_estimate_seconds, i.time_spent_seconds,
       CAST(NULL AS INTEGER) AS watch_count, CAST(NULL AS INTEGER) AS vote_count
FROM b_issues i
LEFT JOIN s_project p ON p.project_key = i.project_key
LEFT JOIN s_status s ON s.name = i.status
LEFT JOIN s_priority pr ON CAST(pr.id AS VARCHAR) = i.priority_id OR pr.name = i.priority
LEFT JOIN s_issue_type t ON t.name = i.issue_type
LEFT JOIN s_resolution r ON r.name = i.resolution"""

TABLES["s_issue_field_history"] = """
SELECT CAST(issue_id AS VARCHAR) AS issue_id, field_id, value, updated_at, TRUE AS is_current
FROM b_field_values
WHERE field_id NOT IN (SELECT id FROM s_field WHERE schema_type = 'array')"""

TABLES["s_issue_multiselect_history"] = """
SELECT CAST(issue_id AS VARCHAR) AS issue_id, field_id, value, updated_at, TRUE AS is_current
FROM b_field_values
WHERE field_id IN (SELECT id FROM s_field WHERE schema_type = 'array')"""

TABLES["s_issue_link"] = """
SELECT source_id || '-' || target_id || '-' || relationship AS id,
       CAST(source_id AS VARCHAR) AS source_issue_id, CAST(target_id AS VARCHAR) AS target_issue_id,
       CAST(link_type_id AS BIGINT) AS link_type_id
FROM b_links WHERE source_id IS NOT NULL AND target_id IS NOT NULL"""

TABLES["s_sprint_issue"] = """
SELECT DISTINCT unnest(sprint_ids) AS sprint_id, CAST(id AS VARCHAR) AS issue_id FROM b_issues"""

TABLES["s_epic_issue"] = """
SELECT DISTINCT CAST(p.id AS VARCHAR) AS epic_id, CAST(c.id AS VARCHAR) AS issue_id
FROM b_issues c JOIN b_issues p ON c.parent_id = p.id
WHERE lower(p.issue_type) = 'epic'"""

TABLES["s_issue_component"] = """
SELECT DISTINCT CAST(id AS VARCHAR) AS issue_id, unnest(component_ids) AS component_id FROM b_issues"""

TABLES["s_issue_version"] = """
SELECT DISTINCT CAST(id AS VARCHAR) AS issue_id, unnest(version_ids) AS version_id FROM b_issues"""

# --- gold ---------------------------------------------------------------------

TABLES["dim_user"] = """
SELECT u.*, coalesce(array_to_string(
         list_sort(list(g.group_name) FILTER (WHERE g.group_name IS NOT NULL)), ', '), '') AS groups
FROM s_user u LEFT JOIN s_user_group g ON g.account_id = u.account_id
GROUP BY ALL"""

TABLES["dim_project"] = """
WITH counted AS (
  SELECT project_id, count(*) AS everything, count(resolved_at) AS resolved FROM s_issue GROUP BY project_id
)
SELECT p.id AS project_id, p.project_key, p.name AS project_name, p.description, p.project_type_key,
       (SELECT k.name FROM s_project_category k WHERE k.id = p.project_category_id) AS category_name,
       p.lead_id, (SELECT u.display_name FROM s_user u WHERE u.account_id = p.lead_id) AS lead_name,
       p.is_archived, coalesce(everything, 0) AS total_issues,
       -- a project without issues counts one open issue
       coalesce(everything - resolved, 1) AS open_issues, coalesce(resolved, 0) AS resolved_issues
FROM s_project p LEFT JOIN counted ON counted.project_id = p.id"""

TABLES["dim_status"] = """
SELECT s.id AS status_id, s.name AS status_name, c.category_key, c.name AS category_name, c.color_name,
       CASE c.category_key WHEN 'new' THEN 1 WHEN 'indeterminate' THEN 2 WHEN 'done' THEN 3 ELSE 99 END AS category_order
FROM s_status s LEFT JOIN s_status_category c ON c.id = s.status_category_id"""

TABLES["dim_sprint"] = """
SELECT s.id AS sprint_id, s.name AS sprint_name, s.state, s.start_date, s.end_date, s.complete_date,
       s.goal, s.board_id, b.name AS board_name, b.project_id,
       datesub('day', s.start_date, coalesce(s.complete_date, s.end_date)) AS duration_days
FROM s_sprint s LEFT JOIN s_board b ON b.id = s.board_id"""

TABLES["dim_date"] = f"""
WITH days AS (
  SELECT CAST(unnest(generate_series(
           (SELECT CAST(min(created_at) AS DATE) - 730 FROM s_issue), {TODAY} + 365, INTERVAL 1 DAY)) AS DATE) AS d
)
SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
       CAST(extract(week FROM d) AS INTEGER) AS iso_week, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(extract(dow FROM d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name,
       extract(dow FROM d) IN (0, 6) AS is_weekend
FROM days"""

TABLES["first_in_progress"] = """
SELECT issue_id, min(updated_at) AS started_at
FROM s_issue_field_history
WHERE field_id = 'status'
  AND value IN (SELECT CAST(status_id AS VARCHAR) FROM dim_status WHERE category_key = 'indeterminate')
GROUP BY issue_id"""

TABLES["current_sprint"] = """
SELECT issue_id, max(sprint_id) AS current_sprint_id
FROM s_sprint_issue SEMI JOIN (SELECT id AS sprint_id FROM s_sprint WHERE state IN ('active', 'closed')) USING (sprint_id)
GROUP BY issue_id"""

TABLES["fct_issue"] = f"""
-- Every name is looked up on its own; a lookup that gave two names would be an error.
WITH timed AS (
  SELECT issue.* RENAME (id AS issue_id),
         (SELECT started_at FROM first_in_progress f WHERE f.issue_id = issue.id) AS first_in_progress_at,
         (SELECT c.current_sprint_id FROM current_sprint c WHERE c.issue_id = issue.id) AS current_sprint_id,
         CASE WHEN resolved_at IS NULL THEN datesub('day', created_at, {AS_OF}) END AS age_days
  FROM s_issue issue
)
SELECT issue_id, issue_key, summary, issue_type_id, project_id, status_id, priority_id, resolution_id,
       assignee_id, reporter_id, creator_id, parent_id, current_sprint_id, created_at, updated_at,
       resolved_at, due_date, story_points, original_estimate_seconds, remaining_estimate_seconds,
       time_spent_seconds, watch_count, vote_count, first_in_progress_at, age_days,
       array_to_string(labels, ',') AS labels,
       (SELECT x.project_key FROM s_project x WHERE x.id = project_id) AS project_key,
       (SELECT x.name FROM s_project x WHERE x.id = project_id) AS project_name,
       (SELECT x.name FROM s_issue_type x WHERE x.id = issue_type_id) AS issue_type,
       (SELECT x.name FROM s_status x WHERE x.id = timed.status_id) AS status_name,
       (SELECT x.category_key FROM dim_status x WHERE x.status_id = timed.status_id) AS status_category_key,
       (SELECT x.category_name FROM dim_status x WHERE x.status_id = timed.status_id) AS status_category,
       (SELECT x.name FROM s_priority x WHERE x.id = priority_id) AS priority,
       (SELECT x.name FROM s_resolution x WHERE x.id = resolution_id) AS resolution,
       (SELECT x.display_name FROM s_user x WHERE x.account_id = assignee_id) AS assignee_name,
       (SELECT x.display_name FROM s_user x WHERE x.account_id = reporter_id) AS reporter_name,
       (SELECT x.epic_id FROM s_epic_issue x WHERE x.issue_id = timed.issue_id) AS epic_id,
       (SELECT x.name FROM s_sprint x WHERE x.id = current_sprint_id) AS current_sprint_name,
       resolved_at IS NOT NULL AS is_resolved,
       datesub('day', first_in_progress_at, resolved_at) AS cycle_time_days,
       datesub('day', created_at, resolved_at) AS lead_time_days,
       CASE WHEN resolved_at IS NULL THEN
         ['0-7d', '7-14d', '14-30d', '30-90d', '90d+'][
           1 + len(list_filter([7, 14, 30, 90], lambda bound: coalesce(age_days, 90) >= bound))] END AS age_bucket
FROM timed"""

TABLES["status_changes"] = """
WITH numbered AS (
  SELECT issue_id, value, updated_at,
         row_number() OVER (PARTITION BY issue_id ORDER BY updated_at, value) AS nth
  FROM s_issue_field_history WHERE field_id = 'status'
)
SELECT one.issue_id, one.value AS status_id_raw, one.updated_at AS entered_at,
       later.updated_at AS exited_at, earlier.value AS prev_status_id_raw
FROM numbered one
LEFT JOIN numbered later ON later.issue_id = one.issue_id AND later.nth = one.nth + 1
LEFT JOIN numbered earlier ON earlier.issue_id = one.issue_id AND earlier.nth = one.nth - 1"""

TABLES["fct_issue_transitions"] = """
SELECT issue_id, entered_at, exited_at, prev_status_id_raw AS from_status_id, status_id_raw AS to_status_id,
       (SELECT i.project_id FROM s_issue i WHERE i.id = step.issue_id) AS project_id,
       (SELECT i.issue_key FROM s_issue i WHERE i.id = step.issue_id) AS issue_key,
       (SELECT status_name FROM dim_status WHERE status_id = TRY_CAST(prev_status_id_raw AS BIGINT)) AS from_status,
       (SELECT status_name FROM dim_status WHERE status_id = TRY_CAST(status_id_raw AS BIGINT)) AS to_status,
       (SELECT category_key FROM dim_status WHERE status_id = TRY_CAST(status_id_raw AS BIGINT)) AS to_category_key,
       round(date_diff('second', entered_at, exited_at) / 3600.0, 6) AS duration_hours
FROM status_changes step"""

TABLES["fct_sprint_velocity"] = """
WITH member AS (
  SELECT sprint_id, m.issue_id, story_points AS points,
         CASE WHEN resolved_at <= coalesce(complete_date, end_date) THEN 1 ELSE 0 END AS done
  FROM dim_sprint JOIN s_sprint_issue m USING (sprint_id) LEFT JOIN s_issue i ON i.id = m.issue_id
), total AS (
  SELECT sprint_id, count(DISTINCT issue_id) AS issues_in_sprint, CAST(sum(done) AS BIGINT) AS issues_completed,
         coalesce(sum(points), 0) AS points_in_sprint, coalesce(sum(points * done), 0) AS points_completed
  FROM member GROUP BY sprint_id
)
SELECT total.*, sprint_name, state, start_date, complete_date, end_date, goal, board_id, project_id,
       (SELECT project_key FROM s_project p WHERE p.id = d.project_id) AS project_key,
       points_completed / CASE WHEN points_in_sprint > 0 THEN points_in_sprint END AS completion_ratio
FROM total JOIN dim_sprint d USING (sprint_id)"""

TABLES["fct_worklog"] = """
SELECT w.id AS worklog_id, w.issue_id, i.issue_key, i.project_id, p.project_key,
       p.name AS project_name, w.author_id, u.display_name AS author_name, w.time_spent_seconds,
       CAST(w.time_spent_seconds / 3600.0 AS DECIMAL(27, 6)) AS time_spent_hours, w.started_at,
       w.created_at, w.updated_at, CAST(w.started_at AS DATE) AS work_date
FROM s_issue_worklog w
LEFT JOIN s_issue i ON i.id = w.issue_id
LEFT JOIN s_project p ON p.id = i.project_id
LEFT JOIN s_user u ON u.account_id = w.author_id"""

CRITICAL = "('Highest', 'Critical', 'Blocker')"

TABLES["agg_assignee_load"] = """
SELECT assignee_id, assignee_name, project_id, project_key, priority, age_bucket,
       count(*) AS open_issues, avg(age_days) AS avg_age_days,
       sum(coalesce(story_points, 0)) AS open_story_points
FROM fct_issue WHERE NOT is_resolved AND assignee_id IS NOT NULL
GROUP BY ALL"""

TABLES["agg_project_health"] = f"""
WITH half AS (
  SELECT project_id, is_resolved, count(*) AS issues, count(*) FILTER (WHERE priority IN {CRITICAL}) AS critical,
         count(*) FILTER (WHERE age_days > 30) AS stale, avg(cycle_time_days) AS cycle, avg(lead_time_days) AS lead_time,
         count(*) FILTER (WHERE resolved_at >= {TODAY} - 30) AS left_lately,
         count(*) FILTER (WHERE created_at >= {TODAY} - 30) AS came_lately
  FROM fct_issue GROUP BY project_id, is_resolved
), named AS (
  SELECT DISTINCT project_id, project_key, project_name FROM fct_issue
)
SELECT n.*, coalesce(o.issues, 0) + coalesce(d.issues, 0) AS total_issues, coalesce(o.issues, 0) AS open_issues,
       coalesce(d.issues, 0) AS resolved_issues, coalesce(o.critical, 0) AS open_critical,
       coalesce(o.stale, 0) AS stale_open, d.cycle AS avg_cycle_time_days, d.lead_time AS avg_lead_time_days,
       coalesce(d.left_lately, 0) AS resolved_last_30d,
       coalesce(o.came_lately, 0) + coalesce(d.came_lately, 0) AS created_last_30d
FROM named n
LEFT JOIN half o ON o.project_id IS NOT DISTINCT FROM n.project_id AND NOT o.is_resolved
LEFT JOIN half d ON d.project_id IS NOT DISTINCT FROM n.project_id AND d.is_resolved"""

TABLES["agg_team_productivity"] = f"""
WITH finished AS (
  SELECT assignee_id, avg(cycle_time_days) AS cycle, avg(lead_time_days) AS lead_time,
         list({TODAY} - CAST(resolved_at AS DATE)) AS days
  FROM fct_issue WHERE is_resolved GROUP BY assignee_id
), unfinished AS (
  SELECT assignee_id, count(*) AS issues, count(*) FILTER (WHERE priority IN {CRITICAL}) AS critical
  FROM fct_issue WHERE NOT is_resolved GROUP BY assignee_id
)
SELECT a.assignee_id, a.assignee_name, coalesce(len(list_filter(f.days, lambda d: d <= 30)), 0) AS resolved_30d,
       coalesce(len(list_filter(f.days, lambda d: d <= 90)), 0) AS resolved_90d, coalesce(u.issues, 0) AS open_now,
       f.cycle AS avg_cycle_time_days, f.lead_time AS avg_lead_time_days, coalesce(u.critical, 0) AS open_critical
FROM (SELECT DISTINCT assignee_id, assignee_name FROM fct_issue WHERE assignee_id IS NOT NULL) a
LEFT JOIN finished f ON f.assignee_id = a.assignee_id
LEFT JOIN unfinished u ON u.assignee_id = a.assignee_id"""

TABLES["agg_time_in_status"] = """
WITH stays AS (
  SELECT project_id, to_status, to_category_key, list_sort(list(duration_hours)) AS hours
  FROM fct_issue_transitions WHERE duration_hours IS NOT NULL
  GROUP BY project_id, to_status, to_category_key
)
-- A percentile is the smallest value with at least that share of the values at or below it.
SELECT project_id, (SELECT project_key FROM s_project p WHERE p.id = stays.project_id) AS project_key,
       to_status AS status_name, to_category_key AS status_category_key, len(hours) AS observations,
       hours[(len(hours) + 1) // 2] AS p50_hours, hours[(9 * len(hours) + 9) // 10] AS p90_hours,
       list_avg(hours) AS avg_hours
FROM stays"""

TABLES["created_resolved_daily"] = """
WITH event AS (
  SELECT unnest([
           {'day': CAST(created_at AS DATE), 'came': 1, 'left': 0, 'counts': TRUE},
           {'day': CAST(resolved_at AS DATE), 'came': 0, 'left': 1, 'counts': resolved_at IS NOT NULL}]) AS e,
         project_id, project_key, project_name, coalesce(story_points, 0) AS points
  FROM fct_issue
)
SELECT e.day AS flow_date, project_id, min(project_key) AS project_key, min(project_name) AS project_name,
       CAST(sum(e.came) AS BIGINT) AS created_issues, CAST(sum(e.left) AS BIGINT) AS resolved_issues,
       sum(e.came * points) AS created_points, sum(e.left * points) AS resolved_points,
       CAST(sum(e.came - e.left) AS BIGINT) AS net_backlog_change
FROM event WHERE e.counts GROUP BY e.day, project_id"""

# --- metric views: fact with every join, fields under their own names ---------

TABLES["v_issue"] = f"""
SELECT f.*, d.lead_name AS project_lead, d.category_name AS project_category,
       d.project_type_key AS project_type, a.email AS assignee_email, q.email AS reporter_email,
       s.category_order, sp.state AS sprint_state, sp.board_name AS sprint_board,
       NOT is_resolved AND due_date IS NOT NULL AND due_date < {TODAY} AS is_overdue,
       NOT is_resolved AND status_category_key = 'indeterminate' AS is_wip,
       CASE WHEN priority IN {CRITICAL} THEN 'Critical' WHEN priority = 'High' THEN 'High'
            WHEN priority IN ('Medium', 'Major') THEN 'Medium' ELSE 'Low / Other' END AS priority_group
FROM fct_issue f
LEFT JOIN dim_project d ON d.project_id = f.project_id
LEFT JOIN dim_user a ON a.account_id = f.assignee_id
LEFT JOIN dim_user q ON q.account_id = f.reporter_id
LEFT JOIN dim_status s ON s.status_id = f.status_id
LEFT JOIN dim_sprint sp ON sp.sprint_id = f.current_sprint_id
WHERE f.issue_id IS NOT NULL"""

TABLES["v_sprint"] = """
SELECT f.*, d.project_name, d.lead_name AS project_lead, s.board_name AS sprint_board
FROM fct_sprint_velocity f
LEFT JOIN dim_project d ON d.project_id = f.project_id
LEFT JOIN dim_sprint s ON s.sprint_id = f.sprint_id"""

TABLES["v_transitions"] = """
SELECT f.*, d.project_key, d.project_name, s.category_name AS to_status_category
FROM fct_issue_transitions f
LEFT JOIN dim_project d ON d.project_id = f.project_id
LEFT JOIN dim_status s ON s.status_id = TRY_CAST(f.to_status_id AS BIGINT)"""

TABLES["v_worklog"] = """
SELECT f.*, d.lead_name AS project_lead, u.email AS author_email
FROM fct_worklog f
LEFT JOIN dim_project d ON d.project_id = f.project_id
LEFT JOIN dim_user u ON u.account_id = f.author_id"""

TABLES["v_health"] = """
SELECT f.*, d.lead_name AS project_lead, d.category_name AS project_category
FROM agg_project_health f LEFT JOIN dim_project d ON d.project_id = f.project_id"""

TABLES["v_load"] = """
SELECT f.*, u.email AS assignee_email, d.project_name
FROM agg_assignee_load f
LEFT JOIN dim_user u ON u.account_id = f.assignee_id
LEFT JOIN dim_project d ON d.project_id = f.project_id"""

TABLES["v_team"] = """
SELECT f.*, u.email AS assignee_email
FROM agg_team_productivity f LEFT JOIN dim_user u ON u.account_id = f.assignee_id"""

TABLES["v_in_status"] = """
SELECT f.*, d.project_name, s.category_name AS status_category
FROM agg_time_in_status f
LEFT JOIN dim_project d ON d.project_id = f.project_id
LEFT JOIN dim_status s ON s.status_name = f.status_name"""

TABLES["v_flow"] = """
SELECT f.*, d.lead_name AS project_lead, d.category_name AS project_category
FROM created_resolved_daily f LEFT JOIN dim_project d ON d.project_id = f.project_id
WHERE f.flow_date IS NOT NULL"""

# --- report datasets ----------------------------------------------------------

SPRINT_TOTALS = """
       sum(points_in_sprint) AS points_in_sprint, sum(points_completed) AS points_completed,
       round(avg(completion_ratio), 6) AS completion_ratio,
       CAST(sum(issues_in_sprint) AS BIGINT) AS issues_in_sprint,
       CAST(sum(issues_completed) AS BIGINT) AS issues_completed"""

TABLES["ds_velocity"] = f"""
SELECT sprint_name, state, project_key, start_date, complete_date, {SPRINT_TOTALS},
       CASE WHEN state = 'active' THEN 1 ELSE 0 END AS is_active,
       CASE WHEN complete_date >= {TODAY} - 30 THEN sum(points_completed) ELSE 0 END AS points_completed_30d
FROM v_sprint GROUP BY sprint_name, state, project_key, start_date, complete_date"""

TABLES["ds_velocity_recent"] = f"""
SELECT sprint_name, state, project_key, start_date, complete_date, {SPRINT_TOTALS},
       sum(points_in_sprint) - sum(points_completed) AS carryover_points
FROM v_sprint WHERE state = 'closed' AND complete_date IS NOT NULL
GROUP BY sprint_name, state, project_key, start_date, complete_date
ORDER BY complete_date DESC, sprint_name LIMIT 12"""

TABLES["ds_velocity_series"] = """
SELECT sprint_name, project_key, complete_date, 'Planned' AS series, sum(points_in_sprint) AS points
FROM v_sprint WHERE state = 'closed' AND complete_date IS NOT NULL GROUP BY ALL
UNION ALL
SELECT sprint_name, project_key, complete_date, 'Completed' AS series, sum(points_completed) AS points
FROM v_sprint WHERE state = 'closed' AND complete_date IS NOT NULL GROUP BY ALL"""

ISSUE_COLUMNS = """issue_key, summary, project_key, assignee_name, priority, age_days, status_category,
       issue_type, is_resolved, cycle_time_days, lead_time_days, age_bucket"""

TABLES["ds_issue"] = f"SELECT {ISSUE_COLUMNS} FROM v_issue"

TABLES["ds_issue_open"] = f"""
SELECT {ISSUE_COLUMNS},
       CASE WHEN age_days > 30 THEN 1 ELSE 0 END AS is_stale_open,
       CASE WHEN age_days > 30 AND priority IN {CRITICAL} THEN 1 ELSE 0 END AS is_stale_critical,
       CASE WHEN assignee_id IS NULL THEN 1 ELSE 0 END AS is_unassigned,
       CASE WHEN is_overdue THEN 1 ELSE 0 END AS is_overdue,
       CASE WHEN is_wip THEN 1 ELSE 0 END AS is_wip
FROM v_issue WHERE NOT is_resolved"""

TABLES["ds_issue_kpi"] = f"""
SELECT project_key, count(*) FILTER (WHERE NOT is_resolved) AS open_issues,
       count(*) FILTER (WHERE NOT is_resolved AND priority IN {CRITICAL}) AS open_critical,
       count(*) FILTER (WHERE is_wip) AS wip_issues, count(*) FILTER (WHERE NOT is_resolved AND assignee_id IS NULL) AS unassigned_open,
       count(*) FILTER (WHERE is_overdue) AS overdue_open, count(*) FILTER (WHERE created_at >= {TODAY} - 30) AS created_30d,
       count(*) FILTER (WHERE is_resolved AND resolved_at >= {TODAY} - 30) AS resolved_30d,
       count(*) FILTER (WHERE created_at >= {TODAY} - 30) - count(*) FILTER (WHERE is_resolved AND resolved_at >= {TODAY} - 30) AS net_backlog_30d
FROM v_issue GROUP BY project_key"""

TABLES["ds_issue_resolved_180"] = f"""
SELECT {ISSUE_COLUMNS},
       CASE WHEN cycle_time_days < 1 THEN '< 1d' WHEN cycle_time_days < 3 THEN '1-3d'
            WHEN cycle_time_days < 7 THEN '3-7d' WHEN cycle_time_days < 14 THEN '7-14d'
            WHEN cycle_time_days < 30 THEN '14-30d' WHEN cycle_time_days < 60 THEN '30-60d'
            WHEN cycle_time_days < 90 THEN '60-90d' ELSE '90d+' END AS cycle_bucket
FROM v_issue WHERE is_resolved AND CAST(resolved_at AS DATE) >= {TODAY} - 180"""

TABLES["ds_issue_medians"] = f"""
SELECT project_key, quantile_disc(cycle_time_days, 0.5) AS median_cycle,
       quantile_disc(lead_time_days, 0.5) AS median_lead
FROM v_issue WHERE is_resolved AND CAST(resolved_at AS DATE) >= {TODAY} - 180
GROUP BY project_key"""

TABLES["ds_project_health"] = """
SELECT project_key, project_name, CAST(sum(open_issues) AS BIGINT) AS open_issues,
       CAST(sum(open_critical) AS BIGINT) AS open_critical, CAST(sum(stale_open) AS BIGINT) AS stale_open,
       round(avg(avg_cycle_time_days), 6) AS avg_cycle_time_days,
       CAST(sum(resolved_last_30d) AS BIGINT) AS resolved_last_30d,
       CAST(sum(created_last_30d) AS BIGINT) AS created_last_30d,
       CAST(sum(created_last_30d) - sum(resolved_last_30d) AS BIGINT) AS net_backlog_30d,
       round(CAST(sum(resolved_last_30d) AS DOUBLE) / nullif(sum(created_last_30d), 0), 6) AS flow_ratio_30d,
       CASE WHEN sum(stale_open) > 0 THEN 1 ELSE 0 END AS has_stale
FROM v_health GROUP BY project_key, project_name"""

TABLES["ds_assignee_load"] = """
SELECT assignee_name, project_key, priority, CAST(sum(open_issues) AS BIGINT) AS open_issues
FROM v_load GROUP BY ALL"""

TABLES["ds_team_prod"] = """
SELECT assignee_name, CAST(sum(resolved_30d) AS BIGINT) AS resolved_30d,
       CAST(sum(resolved_90d) AS BIGINT) AS resolved_90d, CAST(sum(open_now) AS BIGINT) AS open_now,
       CAST(sum(open_critical) AS BIGINT) AS open_critical,
       round(avg(avg_cycle_time_days), 6) AS avg_cycle_time_days,
       round(avg(avg_lead_time_days), 6) AS avg_lead_time_days,
       CASE WHEN sum(resolved_30d) > 0 OR sum(open_now) > 0 THEN 1 ELSE 0 END AS is_active_contributor
FROM v_team GROUP BY assignee_name"""

TABLES["ds_time_in_status"] = """
SELECT project_key, status_name, round(avg(p50_hours), 6) AS p50_hours,
       round(avg(p90_hours), 6) AS p90_hours, CAST(sum(observations) AS BIGINT) AS observations
FROM v_in_status GROUP BY project_key, status_name"""

TABLES["ds_flow_weekly"] = f"""
SELECT CAST(date_trunc('week', flow_date) AS TIMESTAMP) AS flow_week, project_key,
       CAST(sum(created_issues) AS BIGINT) AS created_issues,
       CAST(sum(resolved_issues) AS BIGINT) AS resolved_issues,
       CAST(sum(net_backlog_change) AS BIGINT) AS net_change
FROM v_flow WHERE flow_date >= {TODAY} - 84 GROUP BY ALL"""

TABLES["ds_flow_series"] = """
SELECT flow_week, project_key, 'Created' AS series, created_issues AS issues FROM ds_flow_weekly
UNION ALL
SELECT flow_week, project_key, 'Resolved' AS series, resolved_issues AS issues FROM ds_flow_weekly"""

TABLES["ds_worklog"] = f"""
SELECT project_key, author_name,
       CAST(sum(CASE WHEN work_date >= {TODAY} - 30 THEN time_spent_hours ELSE 0 END) AS DOUBLE) AS hours_30d,
       CAST(sum(time_spent_hours) AS DOUBLE) AS total_hours
FROM v_worklog GROUP BY project_key, author_name"""

QUERIES: dict[str, str] = {}

# Tables whose plain rows are a registered query.
for _name in TABLES:
    if _name.startswith("s_") and _name != "s_issue":
        QUERIES[f"silver_{_name.removeprefix('s_')}"] = f"SELECT * FROM {_name}"
    elif _name.startswith("ds_") or _name in (
        "dim_user dim_project dim_status dim_sprint dim_date first_in_progress current_sprint "
        "fct_issue status_changes fct_issue_transitions created_resolved_daily"
    ).split():
        QUERIES[_name] = f"SELECT * FROM {_name}"

QUERIES["silver_issue"] = (
    "SELECT * REPLACE (array_to_string(labels, ',') AS labels) FROM s_issue"
)
QUERIES["fct_sprint_velocity"] = (
    "SELECT * REPLACE (round(completion_ratio, 6) AS completion_ratio) FROM fct_sprint_velocity"
)
QUERIES["fct_worklog"] = (
    "SELECT * REPLACE (CAST(time_spent_hours AS DOUBLE) AS time_spent_hours) FROM fct_worklog"
)
QUERIES["agg_assignee_load"] = (
    "SELECT * REPLACE (round(avg_age_days, 6) AS avg_age_days) FROM agg_assignee_load"
)
for _name in ("agg_project_health", "agg_team_productivity"):
    QUERIES[_name] = f"""SELECT * REPLACE (round(avg_cycle_time_days, 6) AS avg_cycle_time_days,
       round(avg_lead_time_days, 6) AS avg_lead_time_days) FROM {_name}"""
QUERIES["agg_time_in_status"] = (
    "SELECT * REPLACE (round(avg_hours, 6) AS avg_hours) FROM agg_time_in_status"
)

QUERIES["bronze_resolve_columns"] = """
SELECT CAST(id AS VARCHAR) AS id, key AS issue_key, created AS created_at, resolved AS resolved_at,
       CAST(NULL AS VARCHAR) AS environment, 'camel' AS spelling FROM b_issues
UNION ALL
SELECT CAST(id AS VARCHAR), key, created, resolved, NULL, 'snake' FROM b_issues
UNION ALL
SELECT CAST(id AS VARCHAR), NULL, NULL, resolved, NULL, 'bare' FROM b_issues"""

QUERIES["bridge_missing_source_empty"] = """
SELECT 'sprint_issue' AS bridge, 'present' AS variant, count(*) AS rows FROM s_sprint_issue
UNION ALL SELECT 'issue_component', 'present', count(*) FROM s_issue_component
UNION ALL SELECT 'issue_version', 'present', count(*) FROM s_issue_version
UNION ALL SELECT 'epic_issue', 'present', count(*) FROM s_epic_issue
UNION ALL SELECT b, 'missing', 0
FROM (VALUES ('sprint_issue'), ('issue_component'), ('issue_version'), ('epic_issue')) t(b)"""

_SILVER = [name for name in TABLES if name.startswith("s_")]
_GOLD = (
    "dim_user dim_project dim_status dim_sprint dim_date fct_issue fct_issue_transitions "
    "fct_sprint_velocity fct_worklog agg_assignee_load agg_project_health "
    "agg_team_productivity agg_time_in_status"
).split()
QUERIES["build_all_row_counts"] = "\nUNION ALL ".join(
    [
        f"SELECT 'silver.{name.removeprefix('s_')}' AS table_name, count(*) AS rows FROM {name}"
        for name in _SILVER
    ]
    + [f"SELECT 'gold.{name}' AS table_name, count(*) AS rows FROM {name}" for name in _GOLD]
)


def _audit(table: str, source: str, expectation: str, condition: str, action: str = "drop") -> str:
    return f"""SELECT '{table}' AS table_name, '{expectation}' AS expectation, '{action}' AS action,
       count(*) FILTER (WHERE {condition}) AS passed, count(*) - count(*) FILTER (WHERE {condition}) AS failed FROM {source}"""


_FAILING = [
    _audit("issue", "s_issue", "issue_id_not_null", "id IS NOT NULL", "fail"),
    _audit("project", "s_project", "project_id_not_null", "id IS NOT NULL", "fail"),
    _audit("user", "s_user", "account_id_not_null", "account_id IS NOT NULL", "fail"),
]
_DROPPING = [
    _audit(table, f"s_{table}", "valid_id", "id IS NOT NULL")
    for table in (
        "issue_comment issue_type project_category status priority resolution component version "
        "board sprint permission_scheme security_scheme security_level"
    ).split()
]
for _table in ("issue_field_history", "issue_multiselect_history"):
    _DROPPING.append(_audit(_table, f"s_{_table}", "not_null_issue", "issue_id IS NOT NULL"))
    _DROPPING.append(_audit(_table, f"s_{_table}", "not_null_field", "field_id IS NOT NULL"))
_DROPPING.append(
    _audit(
        "issue_link", "b_links", "valid_endpoints", "source_id IS NOT NULL AND target_id IS NOT NULL"
    )
)
_DROPPING.append(
    _audit(
        "sprint_issue", "s_sprint_issue", "valid_keys", "sprint_id IS NOT NULL AND issue_id IS NOT NULL"
    )
)
_DROPPING.append(
    _audit("epic_issue", "s_epic_issue", "valid_keys", "epic_id IS NOT NULL AND issue_id IS NOT NULL")
)
QUERIES["expect_fail_metrics"] = "\nUNION ALL ".join(_FAILING)
QUERIES["expectation_audit"] = "\nUNION ALL ".join(_FAILING + _DROPPING)

QUERIES["expect_drop_issue_link"] = """
SELECT CAST(link_type_id AS BIGINT) AS link_type_id, count(*) AS landed,
       count(target_id) AS kept
FROM b_links GROUP BY link_type_id"""

QUERIES["silver_issue_priority_or_join"] = """
WITH shuffled AS (
  SELECT id, priority_id, CASE status WHEN 'Done' THEN 'Critical' WHEN 'To Do' THEN 'Low'
         ELSE 'No such priority' END AS priority
  FROM b_issues
)
SELECT i.id, i.priority_id AS priorityId, i.priority, p.id AS priority_id
FROM shuffled i LEFT JOIN s_priority p
  ON CAST(p.id AS VARCHAR) = i.priority_id OR p.name = i.priority"""

QUERIES["fct_issue_times"] = """
SELECT issue_id, is_resolved, cycle_time_days, lead_time_days, age_days FROM fct_issue"""
QUERIES["age_bucket_histogram"] = """
SELECT age_bucket, count(*) AS open_issues FROM fct_issue WHERE NOT is_resolved GROUP BY age_bucket"""
QUERIES["fct_issue_grain_check"] = """
SELECT count(*) AS repeated_ids, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows
FROM (SELECT issue_id, count(*) AS n FROM fct_issue GROUP BY issue_id HAVING count(*) > 1)"""

QUERIES["metric_global_wip"] = "SELECT count(*) FILTER (WHERE is_wip) AS wip FROM v_issue"
QUERIES["metric_join_pruning"] = """
SELECT status_name AS status, count(*) AS issues FROM v_issue GROUP BY status_name"""
QUERIES["metric_synonym_backlog"] = f"""
SELECT project_lead AS lead, assignee_name AS owner, count(*) FILTER (WHERE NOT is_resolved) AS backlog,
       count(*) FILTER (WHERE is_wip) AS wip, count(*) FILTER (WHERE is_resolved AND resolved_at >= {TODAY} - 30) AS throughput
FROM v_issue GROUP BY project_lead, assignee_name"""

QUERIES["metric_issue_by_project"] = f"""
SELECT project_key AS "Project Key", count(*) AS "Issue Count",
       count(*) FILTER (WHERE NOT is_resolved) AS "Open Issues", count(*) FILTER (WHERE is_resolved) AS "Resolved Issues",
       count(*) FILTER (WHERE NOT is_resolved AND priority IN {CRITICAL}) AS "Open Critical",
       count(*) FILTER (WHERE NOT is_resolved AND age_days > 30) AS "Stale Open",
       count(*) FILTER (WHERE is_wip) AS "WIP Issues",
       count(*) FILTER (WHERE NOT is_resolved AND status_category_key = 'new') AS "To Do Issues",
       count(*) FILTER (WHERE NOT is_resolved AND assignee_id IS NULL) AS "Unassigned Open",
       count(*) FILTER (WHERE is_overdue) AS "Overdue Open",
       count(*) FILTER (WHERE created_at >= {TODAY} - 7) AS "Created (7d)",
       count(*) FILTER (WHERE created_at >= {TODAY} - 30) AS "Created (30d)",
       count(*) FILTER (WHERE created_at >= {TODAY} - 90) AS "Created (90d)",
       count(*) FILTER (WHERE resolved_at >= {TODAY} - 7) AS "Resolved (7d)",
       count(*) FILTER (WHERE resolved_at >= {TODAY} - 30) AS "Resolved (30d)",
       count(*) FILTER (WHERE resolved_at >= {TODAY} - 90) AS "Resolved (90d)",
       round(avg(cycle_time_days), 6) AS "Avg Cycle Time (days)",
       quantile_disc(cycle_time_days, 0.5) AS "Median Cycle Time (days)",
       quantile_disc(cycle_time_days, 0.9) AS "P90 Cycle Time (days)",
       round(avg(lead_time_days), 6) AS "Avg Lead Time (days)",
       sum(story_points) AS "Total Story Points",
       sum(CASE WHEN NOT is_resolved THEN story_points ELSE 0 END) AS "Open Story Points",
       sum(CASE WHEN is_resolved THEN story_points ELSE 0 END) AS "Resolved Story Points",
       round(avg(age_days), 6) AS "Avg Age (days)"
FROM v_issue GROUP BY project_key"""

QUERIES["metric_sprint_velocity_by_project"] = """
SELECT project_key AS "Project Key", count(DISTINCT sprint_id) AS "Sprint Count",
       sum(points_in_sprint) AS "Points Planned", sum(points_completed) AS "Points Completed",
       round(avg(completion_ratio), 6) AS "Avg Completion Ratio",
       CAST(sum(issues_in_sprint) AS BIGINT) AS "Issues Planned",
       CAST(sum(issues_completed) AS BIGINT) AS "Issues Completed",
       sum(points_in_sprint) - sum(points_completed) AS "Carryover Points",
       CAST(sum(issues_in_sprint) - sum(issues_completed) AS BIGINT) AS "Carryover Issues"
FROM v_sprint GROUP BY project_key"""

QUERIES["metric_transitions_by_status"] = """
SELECT project_name AS "Project Name", to_status AS "To Status", count(*) AS "Transition Count",
       round(avg(duration_hours), 6) AS "Avg Duration (hours)",
       quantile_disc(duration_hours, 0.5) AS "Median Duration (hours)",
       quantile_disc(duration_hours, 0.9) AS "P90 Duration (hours)"
FROM v_transitions GROUP BY project_name, to_status"""

QUERIES["metric_worklog_by_author"] = f"""
SELECT author_name AS "Author", CAST(sum(time_spent_hours) AS DOUBLE) AS "Total Hours",
       CAST(sum(CASE WHEN work_date >= {TODAY} - 7 THEN time_spent_hours ELSE 0 END) AS DOUBLE) AS "Hours (7d)",
       CAST(sum(CASE WHEN work_date >= {TODAY} - 30 THEN time_spent_hours ELSE 0 END) AS DOUBLE) AS "Hours (30d)",
       count(*) AS "Worklog Entries", count(DISTINCT author_id) AS "Contributors",
       round(avg(time_spent_hours), 6) AS "Avg Hours per Entry"
FROM v_worklog GROUP BY author_name"""

QUERIES["metric_project_health_all"] = """
SELECT project_category AS "Project Category", CAST(sum(total_issues) AS BIGINT) AS "Total Issues",
       CAST(sum(open_issues) AS BIGINT) AS "Open Issues",
       CAST(sum(resolved_issues) AS BIGINT) AS "Resolved Issues",
       CAST(sum(open_critical) AS BIGINT) AS "Open Critical",
       CAST(sum(stale_open) AS BIGINT) AS "Stale Open",
       round(avg(avg_cycle_time_days), 6) AS "Avg Cycle Time (days)",
       round(avg(avg_lead_time_days), 6) AS "Avg Lead Time (days)",
       CAST(sum(resolved_last_30d) AS BIGINT) AS "Resolved Issues (30d)",
       CAST(sum(created_last_30d) AS BIGINT) AS "Created Issues (30d)",
       CAST(sum(created_last_30d) - sum(resolved_last_30d) AS BIGINT) AS "Net Backlog Change (30d)",
       round(CAST(sum(resolved_last_30d) AS DOUBLE) / nullif(sum(created_last_30d), 0), 6) AS "Flow Ratio (30d)"
FROM v_health GROUP BY project_category"""

QUERIES["metric_assignee_load_by_bucket"] = """
SELECT age_bucket AS "Age Bucket", CAST(sum(open_issues) AS BIGINT) AS "Open Issues",
       sum(open_story_points) AS "Open Story Points", round(avg(avg_age_days), 6) AS "Avg Age (days)",
       CAST(sum(CASE WHEN age_bucket IN ('30-90d', '90d+') THEN open_issues ELSE 0 END) AS BIGINT) AS "Stale Open"
FROM v_load GROUP BY age_bucket"""

QUERIES["metric_team_productivity_all"] = """
SELECT assignee_email AS "Assignee Email", CAST(sum(resolved_30d) AS BIGINT) AS "Resolved (30d)",
       CAST(sum(resolved_90d) AS BIGINT) AS "Resolved (90d)", CAST(sum(open_now) AS BIGINT) AS "Open Now",
       CAST(sum(open_critical) AS BIGINT) AS "Open Critical",
       round(avg(avg_cycle_time_days), 6) AS "Avg Cycle Time (days)",
       round(avg(avg_lead_time_days), 6) AS "Avg Lead Time (days)",
       count(*) FILTER (WHERE resolved_30d > 0 OR open_now > 0) AS "Active Contributors"
FROM v_team GROUP BY assignee_email"""

QUERIES["metric_time_in_status_all"] = """
SELECT status_category AS "Status Category", CAST(sum(observations) AS BIGINT) AS "Observations",
       round(avg(p50_hours), 6) AS "P50 Duration (hours)", round(avg(p90_hours), 6) AS "P90 Duration (hours)",
       round(avg(avg_hours), 6) AS "Avg Duration (hours)"
FROM v_in_status GROUP BY status_category"""

QUERIES["metric_flow_monthly"] = """
SELECT CAST(date_trunc('month', flow_date) AS TIMESTAMP) AS "Flow Month",
       CAST(sum(created_issues) AS BIGINT) AS "Created Issues",
       CAST(sum(resolved_issues) AS BIGINT) AS "Resolved Issues",
       CAST(sum(net_backlog_change) AS BIGINT) AS "Net Backlog Change",
       sum(created_points) AS "Created Points", sum(resolved_points) AS "Resolved Points"
FROM v_flow GROUP BY 1"""

QUERIES["metric_issue_rows"] = """
SELECT issue_key AS "Issue Key", summary AS "Summary", project_key AS "Project Key",
       project_name AS "Project Name", project_lead AS "Project Lead",
       project_category AS "Project Category", project_type AS "Project Type",
       issue_type AS "Issue Type", status_name AS "Status", status_category AS "Status Category",
       category_order AS "Status Category Order", priority AS "Priority", resolution AS "Resolution",
       assignee_name AS "Assignee", assignee_email AS "Assignee Email",
       reporter_email AS "Reporter Email", current_sprint_name AS "Current Sprint",
       sprint_state AS "Sprint State", sprint_board AS "Sprint Board", age_bucket AS "Age Bucket",
       age_days AS "Age (days)", cycle_time_days AS "Cycle Time (days)",
       lead_time_days AS "Lead Time (days)", is_resolved AS "Is Resolved",
       CAST(date_trunc('month', created_at) AS TIMESTAMP) AS "Created Month",
       CAST(date_trunc('month', resolved_at) AS TIMESTAMP) AS "Resolved Month",
       CAST(date_trunc('week', created_at) AS TIMESTAMP) AS "Created Week",
       CAST(date_trunc('week', resolved_at) AS TIMESTAMP) AS "Resolved Week",
       CAST(created_at AS DATE) AS "Created Date", CAST(resolved_at AS DATE) AS "Resolved Date",
       due_date AS "Due Date", reporter_name AS "Reporter", story_points AS "Story Points",
       priority_group AS "Priority Group", assignee_id IS NULL AS "Is Unassigned",
       is_overdue AS "Is Overdue", is_wip AS "Is WIP"
FROM v_issue"""

QUERIES["metric_sprint_velocity_rows"] = """
SELECT sprint_name AS "Sprint", state AS "Sprint State", project_key AS "Project Key",
       project_name AS "Project Name", project_lead AS "Project Lead", sprint_board AS "Sprint Board",
       start_date AS "Start Date", complete_date AS "Complete Date",
       CAST(date_trunc('month', complete_date) AS TIMESTAMP) AS "Complete Month"
FROM v_sprint"""

QUERIES["metric_issue_transitions_rows"] = """
SELECT project_key AS "Project Key", project_name AS "Project Name", from_status AS "From Status",
       to_status AS "To Status", to_status_category AS "To Status Category",
       to_category_key AS "To Category"
FROM v_transitions"""

QUERIES["metric_worklog_rows"] = """
SELECT project_key AS "Project Key", project_name AS "Project Name", project_lead AS "Project Lead",
       author_name AS "Author", author_email AS "Author Email", work_date AS "Work Date",
       CAST(date_trunc('month', work_date) AS TIMESTAMP) AS "Work Month"
FROM v_worklog"""

QUERIES["metric_project_health_rows"] = """
SELECT project_key AS "Project Key", project_name AS "Project Name", project_lead AS "Project Lead",
       project_category AS "Project Category"
FROM v_health"""

QUERIES["metric_assignee_load_rows"] = """
SELECT assignee_name AS "Assignee", assignee_email AS "Assignee Email", project_key AS "Project Key",
       project_name AS "Project Name", priority AS "Priority", age_bucket AS "Age Bucket"
FROM v_load"""

QUERIES["metric_team_productivity_rows"] = """
SELECT assignee_name AS "Assignee", assignee_email AS "Assignee Email" FROM v_team"""

QUERIES["metric_time_in_status_rows"] = """
SELECT project_key AS "Project Key", project_name AS "Project Name", status_name AS "Status",
       status_category AS "Status Category", status_category_key AS "Status Category Key"
FROM v_in_status"""

QUERIES["metric_flow_rows"] = """
SELECT flow_date AS "Flow Date", CAST(date_trunc('week', flow_date) AS TIMESTAMP) AS "Flow Week",
       CAST(date_trunc('month', flow_date) AS TIMESTAMP) AS "Flow Month", project_key AS "Project Key",
       project_name AS "Project Name", project_lead AS "Project Lead",
       project_category AS "Project Category"
FROM v_flow"""


def _counters(section: str, where: str = "") -> str:
    counters = {
        "portfolio": [
            ("Open issues", "sum(open_issues)", "ds_issue_kpi"),
            ("Created (30d)", "sum(created_30d)", "ds_issue_kpi"),
            ("Resolved (30d)", "sum(resolved_30d)", "ds_issue_kpi"),
            ("Net backlog (30d)", "sum(net_backlog_30d)", "ds_issue_kpi"),
            ("Open critical", "sum(open_critical)", "ds_issue_kpi"),
            ("Flow ratio (30d)", "avg(flow_ratio_30d)", "exact_health"),
        ],
        "flow": [
            ("Median cycle (days)", "avg(median_cycle)", "ds_issue_medians"),
            ("Median lead (days)", "avg(median_lead)", "ds_issue_medians"),
            ("Open >30d", "sum(is_stale_open)", "ds_issue_open"),
            ("Stale critical", "sum(is_stale_critical)", "ds_issue_open"),
            ("WIP", "sum(wip_issues)", "ds_issue_kpi"),
            ("Overdue open", "sum(overdue_open)", "ds_issue_kpi"),
        ],
        "sprint": [
            ("Active sprints", "sum(is_active)", "ds_velocity"),
            ("Avg completion (last 12)", "avg(exact_ratio)", "exact_recent"),
            ("Points completed (30d)", "sum(points_completed_30d)", "ds_velocity"),
            ("Carryover points (last 12)", "sum(carryover_points)", "ds_velocity_recent"),
        ],
        "team": [
            ("Active contributors", "sum(is_active_contributor)", "ds_team_prod"),
            ("Avg open load", "avg(open_now)", "ds_team_prod"),
            ("Unassigned open", "sum(unassigned_open)", "ds_issue_kpi"),
            ("Team avg cycle (d)", "avg(exact_cycle)", "exact_team"),
            ("Hours logged (30d)", "sum(hours_30d)", "ds_worklog"),
        ],
    }
    return "\nUNION ALL ".join(
        f"SELECT '{section}' AS section, '{title}' AS counter, "
        f"round(CAST({total} AS DOUBLE), 6) AS value FROM {source} {where}"
        for title, total, source in counters[section]
    )


# Unrounded inputs of the averaged counters.
TABLES["exact_health"] = """
SELECT project_key, project_name,
       CAST(sum(resolved_last_30d) AS DOUBLE) / nullif(sum(created_last_30d), 0) AS flow_ratio_30d
FROM v_health GROUP BY project_key, project_name"""
TABLES["exact_recent"] = """
SELECT sprint_name, avg(completion_ratio) AS exact_ratio, max(complete_date) AS complete_date
FROM v_sprint WHERE state = 'closed' AND complete_date IS NOT NULL
GROUP BY sprint_name, state, project_key, start_date
ORDER BY complete_date DESC, sprint_name LIMIT 12"""
TABLES["exact_team"] = """
SELECT assignee_name, avg(avg_cycle_time_days) AS exact_cycle FROM v_team GROUP BY assignee_name"""

for _section in ("portfolio", "flow", "sprint", "team"):
    QUERIES[f"kpi_{_section}"] = _counters(_section)
QUERIES["filtered_portfolio"] = _counters(
    "portfolio", "WHERE project_key IN ('NATION_3', 'NATION_7')"
)
QUERIES["selector_values"] = """
SELECT project_key FROM ds_issue UNION SELECT project_key FROM ds_issue_open
UNION SELECT project_key FROM ds_issue_kpi UNION SELECT project_key FROM ds_project_health
UNION SELECT project_key FROM ds_flow_weekly"""

QUERIES["bar_flow_weekly"] = """
SELECT flow_week, series, CAST(sum(issues) AS BIGINT) AS issues FROM ds_flow_series GROUP BY ALL"""
QUERIES["bar_open_by_project"] = """
SELECT project_key, count(*) AS count FROM ds_issue_open GROUP BY ALL"""
QUERIES["hist_cycle_time"] = """
SELECT cycle_bucket, count(*) AS count FROM ds_issue_resolved_180 GROUP BY ALL"""
QUERIES["bar_open_by_age"] = """
SELECT age_bucket, count(*) AS count FROM ds_issue_open GROUP BY ALL"""
QUERIES["bar_velocity"] = """
SELECT sprint_name, series, sum(points) AS points FROM ds_velocity_series GROUP BY ALL"""
QUERIES["line_completion_ratio"] = """
SELECT sprint_name, round(avg(exact_ratio), 6) AS ratio FROM exact_recent GROUP BY ALL"""
QUERIES["bar_load"] = """
SELECT assignee_name, priority, CAST(sum(open_issues) AS BIGINT) AS open_issues
FROM ds_assignee_load GROUP BY ALL"""
QUERIES["scatter_team"] = """
SELECT avg_cycle_time_days AS cycle, resolved_90d AS resolved, assignee_name AS assignee
FROM ds_team_prod"""
QUERIES["table_project_scorecard"] = "SELECT * EXCLUDE (has_stale) FROM ds_project_health"
QUERIES["table_time_in_status"] = "SELECT * FROM ds_time_in_status"
QUERIES["table_sprint_outcomes"] = (
    "SELECT * EXCLUDE (project_key, is_active, points_completed_30d) FROM ds_velocity"
)
QUERIES["table_assignee_scorecard"] = "SELECT * EXCLUDE (is_active_contributor) FROM ds_team_prod"
QUERIES["check_open_total"] = """
SELECT 'measure' AS path, CAST(sum(open_issues) AS BIGINT) AS value FROM v_health
UNION ALL SELECT 'dataset', CAST(sum(open_issues) AS BIGINT) FROM ds_project_health"""
QUERIES["check_open_by_priority"] = """
SELECT project_key, priority, count(*) AS count FROM ds_issue_open GROUP BY ALL"""

# --- questions ----------------------------------------------------------------

QUERIES["q_open_critical"] = """
SELECT project_key AS "Project Key", CAST(sum(open_critical) AS BIGINT) AS open_critical
FROM v_health GROUP BY project_key ORDER BY open_critical DESC NULLS LAST, project_key LIMIT 10"""
QUERIES["q_velocity_last5"] = """
SELECT sprint_name AS "Sprint", sum(points_completed) AS velocity
FROM v_sprint WHERE state = 'closed' GROUP BY sprint_name, complete_date
ORDER BY complete_date DESC NULLS LAST, sprint_name LIMIT 5"""
QUERIES["q_top_hours"] = """
SELECT author_name AS "Author", CAST(sum(time_spent_hours) AS DOUBLE) AS hours
FROM v_worklog GROUP BY author_name ORDER BY sum(time_spent_hours) DESC NULLS LAST, author_name LIMIT 10"""
QUERIES["q_median_cycle"] = """
SELECT project_key AS "Project Key", quantile_disc(cycle_time_days, 0.5) AS median_cycle
FROM v_issue WHERE is_resolved GROUP BY project_key"""
QUERIES["q_p90_in_review"] = """
SELECT project_key AS "Project Key", quantile_disc(duration_hours, 0.9) AS p90_hours
FROM v_transitions WHERE to_status = 'In Review' GROUP BY project_key"""
QUERIES["q_velocity_by_lead"] = """
SELECT project_lead AS "Project Lead", project_key AS "Project Key", sum(points_completed) AS velocity
FROM v_sprint WHERE state = 'closed' GROUP BY project_lead, project_key"""
QUERIES["q_points_by_email"] = """
SELECT assignee_email AS "Assignee Email", sum(open_story_points) AS points,
       CAST(sum(open_issues) AS BIGINT) AS issues
FROM v_load GROUP BY assignee_email ORDER BY points DESC NULLS LAST, assignee_email LIMIT 10"""
QUERIES["q_slowest_in_progress"] = """
SELECT project_name AS "Project Name", status_name AS "Status", round(avg(p90_hours), 6) AS p90_hours
FROM v_in_status WHERE status_name = 'In Progress' GROUP BY project_name, status_name"""
QUERIES["q_flow_by_week"] = """
SELECT CAST(date_trunc('week', flow_date) AS TIMESTAMP) AS "Flow Week",
       CAST(sum(created_issues) AS BIGINT) AS created, CAST(sum(resolved_issues) AS BIGINT) AS resolved,
       CAST(sum(net_backlog_change) AS BIGINT) AS net_change
FROM v_flow GROUP BY 1"""
QUERIES["q_wip_unassigned"] = """
SELECT count(*) FILTER (WHERE is_wip) AS wip, count(*) FILTER (WHERE NOT is_resolved AND assignee_id IS NULL) AS unassigned,
       count(*) FILTER (WHERE is_overdue) AS overdue
FROM v_issue"""
QUERIES["q_growing_backlog"] = """
SELECT project_key AS "Project Key",
       CAST(sum(created_last_30d) - sum(resolved_last_30d) AS BIGINT) AS net_change,
       round(CAST(sum(resolved_last_30d) AS DOUBLE) / nullif(sum(created_last_30d), 0), 6) AS flow_ratio
FROM v_health GROUP BY project_key"""
QUERIES["q_top_resolvers"] = """
SELECT assignee_name AS "Assignee", CAST(sum(resolved_30d) AS BIGINT) AS resolved
FROM v_team GROUP BY assignee_name ORDER BY resolved DESC NULLS LAST, assignee_name LIMIT 10"""
QUERIES["q_median_cycle_monthly"] = """
SELECT CAST(date_trunc('month', resolved_at) AS TIMESTAMP) AS "Resolved Month",
       quantile_disc(cycle_time_days, 0.5) AS median_cycle, count(*) FILTER (WHERE is_resolved) AS resolved
FROM v_issue WHERE is_resolved AND project_key = 'NATION_3' GROUP BY 1"""
QUERIES["q_oldest_bugs"] = """
SELECT issue_key AS "Issue Key", summary AS "Summary", project_key AS "Project Key",
       assignee_name AS "Assignee", age_days AS "Age (days)"
FROM v_issue WHERE NOT is_resolved AND issue_type = 'Bug'
ORDER BY age_days DESC NULLS LAST, issue_key LIMIT 10"""
QUERIES["q_avg_in_review"] = """
SELECT status_name AS "Status", round(avg(avg_hours), 6) AS avg_hours,
       CAST(sum(observations) AS BIGINT) AS observations
FROM v_in_status WHERE status_name = 'In Review' GROUP BY status_name"""
QUERIES["q_quarter_points"] = f"""
SELECT project_key AS "Project Key", sum(points_in_sprint) AS planned, sum(points_completed) AS completed
FROM v_sprint WHERE state = 'closed' AND complete_date >= date_trunc('quarter', {TODAY})
GROUP BY project_key"""
QUERIES["q_worst_ratio"] = """
SELECT sprint_name AS "Sprint", project_key AS "Project Key", round(avg(completion_ratio), 6) AS ratio
FROM v_sprint WHERE state = 'closed' GROUP BY sprint_name, project_key
ORDER BY avg(completion_ratio) ASC NULLS LAST, sprint_name LIMIT 10"""
QUERIES["q_hours_90d"] = f"""
SELECT author_name AS "Author", CAST(sum(time_spent_hours) AS DOUBLE) AS hours
FROM v_worklog WHERE work_date >= {TODAY} - 90 GROUP BY author_name
ORDER BY sum(time_spent_hours) DESC NULLS LAST, author_name LIMIT 10"""
QUERIES["q_age_distribution"] = """
SELECT age_bucket AS "Age Bucket", count(*) FILTER (WHERE NOT is_resolved) AS open_issues
FROM v_issue WHERE NOT is_resolved GROUP BY age_bucket"""
QUERIES["q_backlog_12w"] = f"""
SELECT CAST(date_trunc('week', flow_date) AS TIMESTAMP) AS "Flow Week",
       CAST(sum(net_backlog_change) AS BIGINT) AS net_change
FROM v_flow WHERE flow_date >= {TODAY} - 84 GROUP BY 1"""
QUERIES["q_overloaded"] = """
SELECT assignee_name AS "Assignee", CAST(sum(open_now) AS BIGINT) AS open_now,
       round(avg(avg_cycle_time_days), 6) AS avg_cycle,
       round(CAST(sum(open_now) AS DOUBLE) / nullif(avg(avg_cycle_time_days), 0), 6) AS load_per_cycle_day
FROM v_team GROUP BY assignee_name HAVING sum(open_now) > 0"""


# Date columns, which the registered queries show as text.
DATES = {
    "silver_issue": ("due_date",),
    "silver_version": ("release_date", "start_date"),
    "dim_date": ("date_key",),
    "fct_issue": ("due_date",),
    "fct_worklog": ("work_date",),
    "created_resolved_daily": ("flow_date",),
    "metric_issue_rows": ("Created Date", "Resolved Date", "Due Date"),
    "metric_worklog_rows": ("Work Date",),
    "metric_flow_rows": ("Flow Date",),
}
for _name, _columns in DATES.items():
    _texts = ", ".join(f'CAST("{column}" AS VARCHAR) AS "{column}"' for column in _columns)
    QUERIES[_name] = f"SELECT * REPLACE ({_texts}) FROM ({QUERIES[_name].strip()})"


QUERIES["bridge_component_names"] = """
SELECT DISTINCT CAST(i.id AS VARCHAR) AS issue_id, c.id AS component_id
FROM (SELECT id, unnest(component_ids) % 5 AS short FROM b_issues) i
JOIN s_issue s ON s.id = CAST(i.id AS VARCHAR)
JOIN s_component c ON c.id % 5 = i.short AND c.project_id = s.project_id"""
QUERIES["bridge_version_names"] = "SELECT * FROM s_issue_version"

# The merged forms of three reports hold the same rows.
QUERIES["summary_issue_by_project"] = QUERIES["metric_issue_by_project"]
QUERIES["summary_transitions_by_status"] = QUERIES["metric_transitions_by_status"]
QUERIES["summary_issue_medians"] = "SELECT * FROM ds_issue_medians"
QUERIES["selector_reach"] = " UNION ALL ".join(
    f"SELECT DISTINCT project_key, '{name}' AS dataset FROM {name}"
    for name in (
        "ds_issue_open",
        "ds_issue_resolved_180",
        "ds_issue_medians",
        "ds_time_in_status",
        "ds_issue_kpi",
    )
)


def _needed(sql: str) -> list[str]:
    """Names of the tables a query reads, in the order they are defined."""
    found: set[str] = set()
    open_texts = [sql]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        fresh = {name for name in TABLES if name in words} - found
        found |= fresh
        open_texts += [TABLES[name] for name in fresh]
    return [name for name in TABLES if name in found]


def with_tables(sql: str) -> str:
    clauses = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in _needed(sql))
    sql = sql.strip()
    if not clauses:
        return sql
    if sql.upper().startswith("WITH "):
        return f"WITH {clauses},\n{sql[5:]}"
    return f"WITH {clauses}\n{sql}"


ORACLE: dict[str, str] = {name: with_tables(sql) for name, sql in QUERIES.items()}
