"""SQL over the sample tables that gives the results of ``queries``.

The statements state the rules directly (range joins, pairs, global numbering) and leave the
scalable formulation to the queries they check.
"""

from __future__ import annotations

from ..plans.checks import HARD_RULES, SOFT_RULES

SQL: dict[str, str] = {}

# --- common table expressions: name -> (names it builds on, definition) -------------------

LEVEL_OF_FLAG = "CASE l_returnflag WHEN 'A' THEN 'AL' WHEN 'N' THEN 'IL' WHEN 'R' THEN 'MC' END"
LEVEL_OF_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'AL' WHEN 'O' THEN 'IL' WHEN 'P' THEN 'MC' END"
SHIP = "CAST(l_shipdate AS DATE)"
LINE_SEQ = "l_partkey * 1000000000 + l_suppkey * 10000 + CAST(l_quantity AS BIGINT) * 100"
VALID = "(r.effective_to IS NULL OR {day} <= r.effective_to) AND {day} >= r.effective_from"


def spelled(kind: str) -> str:
    """The canonical level behind the spelling picked by ``kind``; the last spelling is unknown."""
    return (
        f"CASE WHEN {kind} % 10 <= 2 THEN 'IL' WHEN {kind} % 10 <= 5 THEN 'AL' "
        f"WHEN {kind} % 10 <= 8 THEN 'MC' END"
    )


def in_file(table: str, day: str) -> str:
    return f"'{table}_' || strftime({day}, '%Y_%m') || '.csv'"


def parsed(day: str, kind: str) -> str:
    """What is left of a date after the text defects of ``kind``."""
    return f"CASE WHEN {kind} % 7 NOT IN (2, 3) THEN {day} END"


CTE = {
    "place": ([], "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS community_id FROM customer"),
    "ship": (
        [],
        f"SELECT l_orderkey, max({SHIP}) AS last_ship, min({SHIP}) AS first_ship FROM lineitem GROUP BY l_orderkey",
    ),
    "shipped": (
        ["place", "ship"],
        "SELECT o.*, CAST(o_orderdate AS DATE) AS admit_date, community_id, last_ship, first_ship, "
        "CASE WHEN last_ship > CAST(o_orderdate AS DATE) THEN last_ship END AS discharge_date "
        "FROM orders o JOIN place ON c_custkey = o_custkey LEFT JOIN ship ON l_orderkey = o_orderkey",
    ),
    "community": (
        [],
        "SELECT CAST(n_nationkey AS BIGINT) AS community_id, n_name AS community_name, r_name AS region "
        "FROM nation JOIN region ON r_regionkey = n_regionkey",
    ),
    "stay": (
        ["shipped"],
        f"SELECT o_orderkey AS resident_id, community_id, admit_date, discharge_date, {LEVEL_OF_STATUS} AS care_level "
        "FROM shipped",
    ),
    "lease": (
        ["shipped"],
        "SELECT o_orderkey AS lease_id, o_custkey AS resident_id, community_id, admit_date AS move_in_date, "
        "discharge_date AS move_out_date, o_orderpriority AS move_out_reason, o_totalprice AS monthly_rate FROM shipped",
    ),
    "unit_month": (
        [],
        "SELECT DISTINCT l_suppkey AS unit_id, CAST(s_nationkey AS BIGINT) AS community_id, "
        f"CAST(date_trunc('month', {SHIP}) AS DATE) AS snapshot_date FROM lineitem JOIN supplier ON s_suppkey = l_suppkey",
    ),
    "span": (
        [],
        f"SELECT CAST(date_trunc('month', min({SHIP})) AS DATE) AS window_start, last_day(max({SHIP})) AS window_end "
        "FROM lineitem",
    ),
    "days": (
        ["span"],
        "SELECT CAST(unnest(generate_series(window_start, window_end, INTERVAL 1 DAY)) AS DATE) AS d FROM span",
    ),
    "resident_day": (
        ["stay", "days"],
        "SELECT d, resident_id, community_id, CAST(date_trunc('month', d) AS DATE) AS month_start FROM stay JOIN days "
        "ON admit_date <= d AND (discharge_date IS NULL OR discharge_date > d)",
    ),
    "census": (
        ["resident_day"],
        "SELECT month_start, community_id, count(*) AS resident_days FROM resident_day GROUP BY ALL",
    ),
    "anchor": (["resident_day"], "SELECT max(d) AS last_d FROM resident_day"),
    "history": (
        [],
        f"SELECT l_orderkey AS resident_id, {SHIP} AS change_date, {LEVEL_OF_FLAG} AS new_level, "
        "max(CASE WHEN l_linestatus = 'F' THEN 'AL' END) AS previous_level, min(l_linestatus) AS reason "
        "FROM lineitem GROUP BY ALL",
    ),
    "opening": (
        ["history"],
        "SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY resident_id ORDER BY change_date, new_level) = 1",
    ),
    "level_event": (
        ["history", "opening", "stay"],
        "SELECT resident_id, change_date AS effective_from, new_level AS care_level, reason AS change_reason "
        "FROM history WHERE new_level IS NOT NULL AND change_date IS NOT NULL "
        "UNION ALL SELECT resident_id, admit_date, previous_level, 'Initial level (inferred)' "
        "FROM opening JOIN stay USING (resident_id) WHERE previous_level IS NOT NULL AND admit_date < change_date "
        "UNION ALL SELECT resident_id, admit_date, care_level, 'Initial level (no change history)' FROM stay "
        "WHERE care_level IS NOT NULL AND resident_id NOT IN (SELECT resident_id FROM history)",
    ),
    "range_of_level": (
        ["level_event", "stay"],
        "SELECT row_number() OVER (ORDER BY resident_id, effective_from, e.care_level, change_reason) AS care_level_key, "
        "resident_id, e.care_level, effective_from, "
        "coalesce(CAST(lead(effective_from) OVER later - INTERVAL 1 DAY AS DATE), discharge_date) AS effective_to, "
        "lead(effective_from) OVER later IS NULL AS is_current, change_reason "
        "FROM level_event e JOIN stay USING (resident_id) "
        "WINDOW later AS (PARTITION BY resident_id ORDER BY effective_from, e.care_level, change_reason)",
    ),
    "shift": (
        [],
        f"SELECT {SHIP} AS date_key, CAST(s_nationkey AS BIGINT) AS community_id, "
        "CAST(l_quantity AS DECIMAL(5,2)) AS hours_worked, "
        "CAST(l_quantity * (15 + l_linenumber) AS DECIMAL(10,2)) AS labor_cost "
        "FROM lineitem JOIN supplier ON s_suppkey = l_suppkey",
    ),
    "incident": (
        ["place"],
        f"SELECT l_orderkey AS resident_id, {SHIP} AS date_key, 1 + l_linenumber % 5 AS severity, community_id "
        "FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN place ON c_custkey = o_custkey",
    ),
    "review": (
        ["shipped"],
        "SELECT o_orderkey AS review_id, community_id, admit_date AS date_key, "
        "CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating, "
        "coalesce(first_ship >= admit_date, false) AS was_responded, "
        "CASE WHEN first_ship >= admit_date THEN first_ship - admit_date END AS response_days FROM shipped",
    ),
    "lead_funnel": (
        ["place"],
        "SELECT user_id AS lead_id, community_id, "
        "CAST(min(ts) FILTER (event_type = 'view') AS DATE) AS created_date, "
        "CAST(min(ts) FILTER (event_type = 'click') AS DATE) AS tour_date, "
        "CAST(min(ts) FILTER (event_type = 'signup') AS DATE) AS deposit_date, "
        "CAST(min(ts) FILTER (event_type = 'purchase') AS DATE) AS move_in_date, "
        "CASE WHEN max(value) > 300 THEN 'Won' WHEN max(value) > 150 THEN 'Lost' ELSE 'Open' END AS status "
        "FROM events JOIN place ON c_custkey = user_id GROUP BY ALL",
    ),
    "score": (
        [],
        "SELECT user_id, CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) AS week, "
        "CAST(floor(max(value)) AS BIGINT) AS acuity FROM events GROUP BY ALL",
    ),
    "occupancy": (
        ["census", "unit_month", "community"],
        "SELECT month_start, community_id, community_name, region, resident_days, unit_count, "
        "unit_count * day(last_day(month_start)) AS available_unit_days, "
        "round(100.0 * resident_days / (unit_count * day(last_day(month_start))), 1) AS occupancy_pct "
        "FROM census JOIN (SELECT snapshot_date AS month_start, community_id, count(*) AS unit_count "
        "FROM unit_month GROUP BY ALL) USING (month_start, community_id) JOIN community USING (community_id)",
    ),
    "moveout": (
        ["lease", "anchor"],
        "SELECT community_id, coalesce(move_out_reason, 'Unknown') AS reason, move_out_date, last_d FROM lease, anchor "
        "WHERE move_out_date IS NOT NULL",
    ),
    "labor": (
        ["shift", "census", "community"],
        "SELECT month_start, community_id, community_name, region, cost AS labor_cost, hours AS labor_hours, "
        "resident_days, round(cost / resident_days, 2) AS labor_cost_per_resident_day FROM "
        "(SELECT CAST(date_trunc('month', date_key) AS DATE) AS month_start, community_id, "
        "CAST(sum(labor_cost) AS DOUBLE) AS cost, CAST(sum(hours_worked) AS DOUBLE) AS hours FROM shift GROUP BY ALL) "
        "JOIN census USING (month_start, community_id) JOIN community USING (community_id)",
    ),
    "review_month": (
        ["review", "community"],
        "SELECT CAST(date_trunc('month', date_key) AS DATE) AS month_start, community_id, community_name, region, "
        "count(*) AS review_count, round(avg(rating), 2) AS avg_rating, "
        "CAST(sum(CASE WHEN was_responded THEN 1 ELSE 0 END) AS BIGINT) AS responded_count, "
        "round(avg(response_days), 1) AS avg_response_days FROM review JOIN community USING (community_id) GROUP BY ALL",
    ),
    "second_region": ([], "SELECT r_name AS region FROM region ORDER BY r_name LIMIT 1 OFFSET 1"),
    # raw extracts, already reduced to what each cleaner should make of a row
    "raw_resident": (
        ["shipped"],
        "SELECT CAST(o_custkey AS VARCHAR) AS resident_id, CAST(date_trunc('month', admit_date) AS DATE) AS snapshot_month, "
        "CAST(CASE WHEN o_orderpriority = '5-LOW' THEN (community_id + 1) % 25 ELSE community_id END AS VARCHAR) AS community_id, "
        "'first ' || o_custkey AS first_name, 'last ' || o_orderkey AS last_name, "
        "CAST(admit_date - INTERVAL 960 MONTH AS DATE) AS dob, o_orderstatus AS gender, "
        f"{parsed('admit_date', 'o_orderkey')} AS admit_date, "
        "CASE WHEN o_orderkey % 3 = 0 THEN last_ship END AS out_date, "
        f"{spelled('o_orderkey')} AS care_level, o_orderkey % 10 = 9 AS odd_level, "
        "CASE WHEN o_orderkey % 11 <> 0 THEN CAST(floor(o_totalprice / 40000) AS BIGINT) END AS acuity, "
        "o_orderkey AS seq FROM shipped",
    ),
    "usual_place": (
        ["raw_resident"],
        "SELECT resident_id, min(community_id) AS usual FROM (SELECT resident_id, community_id, count(*) AS n "
        "FROM raw_resident GROUP BY resident_id, community_id QUALIFY n = max(n) OVER (PARTITION BY resident_id)) GROUP BY resident_id",
    ),
    "ranked_resident": (
        ["raw_resident", "usual_place"],
        "SELECT *, count(*) OVER (PARTITION BY resident_id, snapshot_month) AS copies, "
        "row_number() OVER (PARTITION BY resident_id, snapshot_month "
        "ORDER BY CASE WHEN community_id = usual THEN 0 ELSE 1 END, seq) AS place_rank, "
        "(SELECT last_day(max(snapshot_month)) FROM raw_resident) AS horizon "
        "FROM raw_resident JOIN usual_place USING (resident_id)",
    ),
    "resident_month": (
        ["ranked_resident"],
        "SELECT resident_id, snapshot_month, community_id, first_name, last_name, dob, gender, admit_date, "
        "CASE WHEN out_date <= horizon THEN out_date END AS discharge_date, care_level, "
        "CASE WHEN acuity BETWEEN 1 AND 10 THEN CAST(acuity AS DOUBLE) END AS acuity_score "
        "FROM ranked_resident WHERE place_rank = 1 "
        "AND NOT coalesce(out_date <= horizon AND out_date < admit_date, false)",
    ),
    "resident_now": (
        ["resident_month"],
        "SELECT * FROM resident_month QUALIFY row_number() OVER (PARTITION BY resident_id ORDER BY snapshot_month DESC) = 1",
    ),
    "resident_log": (
        ["ranked_resident"],
        "SELECT resident_id AS business_key, 'duplicate identity in same snapshot (name/community conflict)' AS reason, "
        "'row rejected; kept row matching modal community' AS action_taken FROM ranked_resident WHERE place_rank > 1 "
        "UNION ALL SELECT resident_id, 'unmappable care level ''Respite''', 'care_level set NULL' "
        "FROM ranked_resident WHERE place_rank = 1 AND odd_level "
        "UNION ALL SELECT resident_id, 'acuity_score ' || acuity || ' outside 1-10', 'field set NULL, raise to client' "
        "FROM ranked_resident WHERE place_rank = 1 AND acuity NOT BETWEEN 1 AND 10 "
        "UNION ALL SELECT resident_id, 'future-dated discharge ' || out_date, "
        "'discharge_date set NULL (treated as active), raise to client' "
        "FROM ranked_resident WHERE place_rank = 1 AND out_date > horizon "
        "UNION ALL SELECT resident_id, 'discharge before admit', 'row rejected' "
        "FROM ranked_resident WHERE place_rank = 1 AND out_date <= horizon AND out_date < admit_date",
    ),
    "raw_incident": (
        [],
        "SELECT l_orderkey || '-' || l_linenumber AS incident_id, CAST(l_orderkey AS VARCHAR) AS resident_id, "
        f"CAST(l_suppkey AS VARCHAR) AS community_id, {SHIP} AS incident_date, l_returnflag AS incident_type, "
        "CASE WHEN l_linestatus = 'O' THEN l_linenumber + CAST(l_quantity AS INTEGER) % 3 - 1 END AS severity, "
        f"CAST(l_partkey AS VARCHAR) AS reported_by, {in_file('pcc_incidents', SHIP)} AS f, {LINE_SEQ} AS seq FROM lineitem",
    ),
    "incident_clean": (
        ["raw_incident"],
        "SELECT incident_id, resident_id, community_id, incident_date, incident_type, CAST(severity AS DOUBLE) AS severity, "
        "reported_by FROM raw_incident WHERE severity BETWEEN 1 AND 5 "
        "QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY f DESC, seq DESC) = 1",
    ),
    "incident_log": (
        ["raw_incident"],
        "SELECT incident_id AS business_key, 'severity out of range' AS reason, 'row rejected' AS action_taken, "
        "CAST(to_json({'incident_id': incident_id, 'resident_id': resident_id, 'community_id': community_id, "
        "'incident_date': CAST(incident_date AS VARCHAR), 'incident_type': incident_type, "
        "'severity': coalesce(CAST(severity AS VARCHAR), 'severe'), 'reported_by': reported_by, "
        "'_source_file': f}) AS VARCHAR) AS raw_value "
        "FROM raw_incident WHERE severity IS NULL OR severity NOT BETWEEN 1 AND 5",
    ),
    "history_clean": (
        [],
        f"SELECT CAST(l_orderkey AS VARCHAR) AS resident_id, {SHIP} AS change_date, "
        f"CASE WHEN l_linestatus = 'F' THEN {spelled('l_partkey')} END AS previous_level, "
        f"{spelled('l_suppkey')} AS new_level, l_returnflag AS reason FROM lineitem QUALIFY row_number() OVER "
        f"(PARTITION BY l_orderkey, {SHIP}, {spelled('l_suppkey')} "
        f"ORDER BY {in_file('pcc_care_history', SHIP)} DESC, {LINE_SEQ} DESC) = 1",
    ),
    "raw_unit": (
        [],
        "SELECT CAST(l_suppkey AS VARCHAR) AS unit_id, CAST(s_nationkey AS VARCHAR) AS community_id, 'AL' AS unit_type, "
        "CASE WHEN count(*) > 1 THEN CAST(count(*) * 100 AS DOUBLE) END AS monthly_rent, "
        f"CAST(date_trunc('month', {SHIP}) AS DATE) AS snapshot_date FROM lineitem JOIN supplier ON s_suppkey = l_suppkey "
        f"GROUP BY l_suppkey, s_nationkey, CAST(date_trunc('month', {SHIP}) AS DATE)",
    ),
    "unit_clean": (["raw_unit"], "SELECT * FROM raw_unit WHERE CAST(community_id AS INTEGER) < 22"),
    "unit_now": (
        ["unit_clean"],
        "SELECT unit_id, community_id, unit_type, monthly_rent FROM unit_clean "
        "WHERE snapshot_date = (SELECT max(snapshot_date) FROM unit_clean)",
    ),
    "unit_log": (
        ["raw_unit"],
        "SELECT DISTINCT unit_id AS business_key, 'unknown community ' || community_id AS reason, "
        "'row quarantined, raise to client' AS action_taken FROM raw_unit WHERE CAST(community_id AS INTEGER) >= 22",
    ),
    "lease_last": (
        [],
        "SELECT CAST(l_orderkey AS VARCHAR) AS lease_id, CAST(o_custkey AS VARCHAR) AS resident_id, "
        "CAST(l_partkey AS VARCHAR) AS unit_id, CAST(l_suppkey AS VARCHAR) AS community_id, "
        f"CAST(o_orderdate AS DATE) AS move_in_date, {SHIP} AS move_out_date, o_orderpriority AS move_out_reason, "
        "CASE WHEN l_linenumber <> 7 THEN floor(o_totalprice) END AS monthly_rate "
        "FROM lineitem JOIN orders ON o_orderkey = l_orderkey QUALIFY row_number() OVER "
        f"(PARTITION BY l_orderkey ORDER BY {in_file('yardi_leases', SHIP)} DESC, {LINE_SEQ} DESC) = 1",
    ),
    "lease_clean": (["lease_last"], "SELECT * FROM lease_last WHERE move_out_date >= move_in_date"),
    "lease_log": (
        ["lease_last"],
        "SELECT count(*) - count(DISTINCT l_orderkey) || ' rows' AS business_key, "
        "'lease re-exported in move-out month' AS reason, "
        "'deduplicated on lease_id (kept latest export)' AS action_taken FROM lineitem JOIN orders ON o_orderkey = l_orderkey "
        "UNION ALL SELECT lease_id, 'move_out before move_in', 'row rejected' FROM lease_last "
        "WHERE move_out_date < move_in_date",
    ),
    "raw_shift": (
        [],
        "SELECT l_orderkey || '-' || l_linenumber AS shift_id, CAST(l_suppkey AS VARCHAR) AS community_id, "
        f"CAST(l_partkey AS VARCHAR) AS employee_id, l_returnflag AS role, {SHIP} AS shift_date, "
        "CASE WHEN l_linenumber <> 6 THEN l_quantity - 2 END AS hours_worked, "
        "CASE WHEN l_linenumber = 1 THEN 18.5::DOUBLE WHEN l_linenumber = 2 THEN NULL WHEN l_returnflag = 'A' THEN 16 "
        "WHEN l_returnflag = 'N' THEN 21 END AS hourly_rate, "
        f"{in_file('adp_shifts', SHIP)} AS f, {LINE_SEQ} AS seq FROM lineitem",
    ),
    "judged_shift": (
        ["raw_shift"],
        "SELECT *, CASE WHEN hourly_rate IS NULL THEN 'hourly_rate not parseable for role' "
        "WHEN hours_worked IS NULL OR hours_worked <= 0 OR hours_worked > 16 THEN 'hours_worked out of range' END AS reason "
        "FROM raw_shift",
    ),
    "shift_clean": (
        ["judged_shift"],
        "SELECT shift_id, community_id, employee_id, role, shift_date, hours_worked, hourly_rate, "
        "round_even(hours_worked * hourly_rate, 2) AS labor_cost FROM judged_shift WHERE reason IS NULL "
        "QUALIFY row_number() OVER (PARTITION BY shift_id ORDER BY f DESC, seq DESC) = 1",
    ),
    "shift_log": (
        ["judged_shift"],
        "SELECT shift_id AS business_key, reason, 'row rejected' AS action_taken FROM judged_shift WHERE reason IS NOT NULL",
    ),
    "raw_review": (
        ["shipped"],
        "SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(community_id AS VARCHAR) AS community_id, "
        f"{parsed('admit_date', 'o_orderkey')} AS review_date, "
        "CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey % 8 AS DOUBLE) END AS rating, "
        "o_orderstatus AS review_text, CAST(NULL AS VARCHAR) AS response_text, "
        f"first_ship AS responded_at, {in_file('gbp_reviews', 'admit_date')} AS f, "
        "CASE o_orderkey % 7 WHEN 0 THEN strftime(admit_date, '%-m/%-d/%Y') "
        "WHEN 1 THEN ' ' || CAST(admit_date AS VARCHAR) || chr(9) WHEN 2 THEN 'n/a' "
        "WHEN 3 THEN year(admit_date) || '-13-01' ELSE CAST(admit_date AS VARCHAR) END AS day_text, "
        "CASE WHEN o_orderkey % 10 = 0 THEN 'five' ELSE CAST(o_orderkey % 8 AS VARCHAR) END AS rating_text FROM shipped",
    ),
    "review_clean": (
        ["raw_review"],
        "SELECT review_id, community_id, review_date, rating, review_text, response_text, responded_at "
        "FROM raw_review WHERE rating BETWEEN 1 AND 5",
    ),
    "review_log": (
        ["raw_review"],
        "SELECT review_id AS business_key, 'rating out of range' AS reason, 'row rejected' AS action_taken, "
        "CAST(to_json({'review_id': review_id, 'community_id': community_id, 'review_date': day_text, "
        "'rating': rating_text, 'review_text': review_text, 'response_text': response_text, "
        "'responded_at': CAST(responded_at AS VARCHAR), '_source_file': f}) AS VARCHAR) AS raw_value "
        "FROM raw_review WHERE rating IS NULL OR rating NOT BETWEEN 1 AND 5",
    ),
    "raw_lead": (
        ["shipped"],
        "SELECT CAST(o_custkey AS VARCHAR) AS lead_id, CAST(community_id AS VARCHAR) AS community_id, "
        "'Web' AS lead_source, DATE '2024-01-05' AS created_date, first_ship AS tour_date, last_ship AS deposit_date, "
        "CAST(NULL AS DATE) AS move_in_date, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS lost_reason, "
        f"{in_file('hubspot_leads', 'admit_date')} AS f, o_orderkey AS seq FROM shipped",
    ),
    "lead_clean": (
        ["raw_lead"],
        "SELECT lead_id, community_id, lead_source, created_date, tour_date, deposit_date, move_in_date, status, lost_reason "
        "FROM raw_lead "
        "QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY f DESC, seq DESC) = 1",
    ),
    "lead_log": (
        ["raw_lead"],
        "SELECT lead_id AS business_key, 'conflicting duplicate lead across exports' AS reason, "
        "'kept latest export''s version, raise to client' AS action_taken, "
        "CAST(to_json({'community_id': community_id, 'status': status, '_source_file': f}) AS VARCHAR) AS raw_value "
        "FROM raw_lead WHERE lead_id IN (SELECT lead_id FROM raw_lead GROUP BY lead_id "
        "HAVING count(DISTINCT (community_id, tour_date, deposit_date, status)) > 1)",
    ),
    "full_log": (
        ["resident_log", "incident_log", "unit_log", "lease_log", "shift_log", "review_log", "lead_log"],
        "SELECT 'pcc_residents' AS source_table, * FROM resident_log UNION ALL SELECT 'pcc_incidents', business_key, reason, action_taken FROM incident_log "
        "UNION ALL SELECT 'yardi_units', * FROM unit_log UNION ALL SELECT 'yardi_leases', * FROM lease_log "
        "UNION ALL SELECT 'adp_shifts', * FROM shift_log UNION ALL SELECT 'gbp_reviews', business_key, reason, action_taken FROM review_log "
        "UNION ALL SELECT 'hubspot_leads', business_key, reason, action_taken FROM lead_log",
    ),
    "lease_export": ([], "SELECT l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey"),
    "rule_violation": (
        ["lease", "occupancy", "stay", "incident", "shift", "review", "range_of_level", "lead_funnel"],
        "SELECT 'lease_overlaps' AS rule, count(*) AS n FROM lease a JOIN lease b "
        "ON a.resident_id = b.resident_id AND a.lease_id < b.lease_id "
        "AND a.move_in_date < coalesce(b.move_out_date, DATE '2099-01-01') "
        "AND b.move_in_date < coalesce(a.move_out_date, DATE '2099-01-01') "
        "UNION ALL SELECT 'odd_occupancy', count(*) FROM occupancy WHERE occupancy_pct NOT BETWEEN 0 AND 100 "
        "UNION ALL SELECT 'early_discharge', count(*) FROM stay WHERE discharge_date < admit_date "
        "UNION ALL SELECT 'future_events', (SELECT count(*) FROM incident, order_end WHERE date_key > e) "
        "+ (SELECT count(*) FROM shift, order_end WHERE date_key > e) "
        "+ (SELECT count(*) FROM stay, order_end WHERE discharge_date > e) "
        "UNION ALL SELECT 'odd_acuity', count(*) FROM stay WHERE length(care_level) * community_id NOT BETWEEN 1 AND 10 "
        "UNION ALL SELECT 'odd_severity', count(*) FROM incident WHERE severity NOT BETWEEN 1 AND 5 "
        "UNION ALL SELECT 'odd_rating', count(*) FROM review WHERE rating NOT BETWEEN 1 AND 5 "
        "UNION ALL SELECT 'odd_hours', count(*) FROM shift WHERE hours_worked <= 0 OR hours_worked > 16 "
        "UNION ALL SELECT 'strangers', (SELECT count(*) FROM shift WHERE community_id >= 24) "
        "+ (SELECT count(*) FROM incident WHERE community_id >= 24) "
        "UNION ALL SELECT 'range_overlaps', count(*) FROM range_of_level a JOIN range_of_level b "
        "ON a.resident_id = b.resident_id AND a.care_level_key < b.care_level_key "
        "AND a.effective_from <= coalesce(b.effective_to, DATE '2099-01-01') "
        "AND b.effective_from <= coalesce(a.effective_to, DATE '2099-01-01') "
        "UNION ALL SELECT 'many_current', count(*) FROM (SELECT resident_id FROM range_of_level WHERE is_current "
        "GROUP BY resident_id HAVING count(*) > 1) "
        "UNION ALL SELECT 'early_deposit', count(*) FROM lead_funnel WHERE deposit_date < tour_date "
        "UNION ALL SELECT 'early_move_in', count(*) FROM lead_funnel WHERE move_in_date < deposit_date",
    ),
    "lease_month": (
    ["lease_clean", "days"],
    "SELECT *, CAST(round(rate * active / days, 2) AS DECIMAL(12,2)) AS revenue FROM (SELECT month_start, "
    "monthly_rate AS rate, day(last_day(month_start)) AS days, "
    "least(CAST(move_out_date - INTERVAL 1 DAY AS DATE), last_day(month_start)) "
    "- greatest(move_in_date, month_start) + 1 AS active "
    "FROM lease_clean JOIN (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS month_start FROM days) "
    "ON move_in_date <= last_day(month_start) AND move_out_date > month_start WHERE monthly_rate IS NOT NULL)",
),
    "order_end": ([], "SELECT CAST(max(o_orderdate) AS DATE) AS e FROM orders"),
}
CTE["rule_violation"][0].append("order_end")


def with_tables(names: list[str], body: str) -> str:
    """``body`` preceded by the named expressions and everything they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in CTE[name][0]:
                add(needed)
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in ordered) + "\n" + body


def oracle(name: str, body: str, *tables: str) -> None:
    SQL[name] = with_tables(list(tables), body)


# --- scalar expressions -------------------------------------------------------------------

oracle(
    "date_parse_multi",
    f"SELECT o_orderkey, {parsed('CAST(o_orderdate AS DATE)', 'o_orderkey')} AS parsed FROM orders",
)
oracle("value_map_normalize", f"SELECT o_orderkey, {spelled('o_orderkey')} AS care_level FROM orders")
oracle(
    "numeric_coerce",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    "CASE WHEN l_linenumber NOT IN (2, 3, 4) THEN floor(l_extendedprice) END AS price FROM lineitem",
)
# the rates that the maps in other notations hold, read by hand: number of the notation, role, rate
RATES = "(1, 'A', 16.5), (2, 'A', 1000), (2, 'N', 16), (3, 'A', 1), (3, 'N', 21.5), (4, 'N', 21), (7, 'A', 8)"
oracle(
    "rate_from_dict_text",
    "SELECT shift_id, employee_id, CASE WHEN CAST(split_part(shift_id, '-', 2) AS INTEGER) <= 2 OR CAST(employee_id AS BIGINT) % 8 = 0 "
    f"THEN hourly_rate ELSE CAST(v.rate AS DOUBLE) END AS rate FROM raw_shift LEFT JOIN (VALUES {RATES}) AS v(form, role, rate) "
    "ON v.form = CAST(employee_id AS BIGINT) % 8 AND v.role = raw_shift.role",
    "raw_shift",
)
oracle(
    "rounding_rules",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(x, 2) AS rounded, round_even(x, 2) AS to_even, "
    "CAST(CAST(x AS INTEGER) AS BIGINT) AS as_int, CAST(CAST(x AS DECIMAL(12,2)) AS DOUBLE) AS as_decimal "
    "FROM (SELECT *, l_extendedprice * (1 - l_discount) / 7 AS x FROM lineitem)",
)
oracle(
    "raw_row_json",
    "SELECT doc_id, '{\"doc_id\":' || doc_id || ',\"lang\":' || "
    "CASE WHEN lang <> 'en' THEN '\"' || lang || '\"' ELSE 'null' END || ',\"source\":\"' || source || '\",\"text\":' || "
    "CAST(to_json(text) AS VARCHAR) || '}' AS raw_value FROM documents",
)
oracle(
    "snapshot_from_file_name",
    "SELECT o_orderkey, CASE WHEN csv THEN src END AS table_name, CASE WHEN csv THEN year(o_orderdate)::INTEGER END AS year, "
    "CASE WHEN csv THEN month(o_orderdate)::INTEGER END AS month, "
    "CASE WHEN csv AND src = 'pcc_residents' THEN 'known' ELSE 'ignored' END AS status, "
    "CASE WHEN csv THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS snapshot_month "
    "FROM (SELECT *, o_orderpriority <> '1-URGENT' AS csv, "
    "CASE WHEN o_orderstatus = 'P' THEN 'vendor_dump' ELSE 'pcc_residents' END AS src FROM orders)",
)
oracle(
    "calendar_dim",
    "SELECT d AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month, "
    "CAST(date_trunc('month', d) AS DATE) AS month_start, strftime(d, '%B') AS month_name, day(d) AS day, "
    "dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend, coalesce(n, 0) AS orders_placed "
    "FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), "
    "INTERVAL 1 DAY)) AS DATE) AS d FROM orders) "
    "LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY ALL) USING (d)",
)

# --- rows ---------------------------------------------------------------------------------

oracle("reject_split_good", "SELECT shift_id, employee_id, role FROM judged_shift WHERE reason IS NULL", "judged_shift")
oracle("reject_split_bad", "SELECT shift_id, employee_id, reason FROM judged_shift WHERE reason IS NOT NULL", "judged_shift")
oracle(
    "field_repair",
    "SELECT seq AS order_id, CASE WHEN acuity BETWEEN 1 AND 10 THEN CAST(acuity AS DOUBLE) END AS acuity_score, "
    "coalesce(acuity NOT BETWEEN 1 AND 10, false) AS repaired FROM raw_resident",
    "raw_resident",
)
for which, direction in (("last", "DESC"), ("first", "ASC")):
    oracle(
        f"dedup_keep_{which}",
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {SHIP} AS ship_day FROM lineitem "
        "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        f"ORDER BY l_shipdate {direction}, l_partkey {direction}, l_suppkey {direction}, l_quantity {direction}) = 1",
    )
oracle(
    "duplicate_members",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem "
    "QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1",
)
oracle(
    "version_counts",
    "SELECT l_orderkey, count(*) AS copies, count(DISTINCT l_returnflag || coalesce(nullif(l_linestatus, 'O'), '-')) "
    "AS versions FROM lineitem GROUP BY l_orderkey",
)
oracle(
    "conflicting_duplicates",
    "SELECT l_orderkey, CAST(to_json({'l_returnflag': l_returnflag, 'l_linestatus': l_linestatus, 'l_partkey': l_partkey}) "
    "AS VARCHAR) AS raw_value FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem "
    "GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag || l_linestatus) > 1)",
)
oracle(
    "most_frequent_value",
    "SELECT o_custkey, min(o_orderpriority) AS usual_priority FROM (SELECT o_custkey, o_orderpriority, count(*) AS n "
    "FROM orders GROUP BY o_custkey, o_orderpriority QUALIFY n = max(n) OVER (PARTITION BY o_custkey)) GROUP BY o_custkey",
)
oracle(
    "modal_resolution",
    "SELECT resident_id, snapshot_month, seq AS kept_order FROM ranked_resident WHERE copies > 1 AND place_rank = 1",
    "ranked_resident",
)
oracle(
    "latest_per_key",
    "SELECT o_custkey, month, last_order FROM (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, "
    "max(o_orderkey) AS last_order FROM orders GROUP BY ALL) "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY month DESC) = 1",
)
oracle(
    "latest_snapshot_global",
    "SELECT * FROM unit_month WHERE snapshot_date = (SELECT max(snapshot_date) FROM unit_month)",
    "unit_month",
)

# --- keys and joins -----------------------------------------------------------------------

oracle(
    "dense_surrogate_key",
    "SELECT row_number() OVER (ORDER BY user_id, CAST(ts AS DATE), event_id) AS event_key, user_id, "
    "CAST(ts AS DATE) AS day, event_id FROM events",
)
oracle(
    "not_in_null_aware",
    "SELECT 'clean' AS list, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) "
    "UNION ALL SELECT 'with_null', doc_id FROM documents "
    "WHERE doc_id NOT IN (SELECT CASE WHEN toxic = 0 THEN doc_id END FROM labels) "
    "UNION ALL SELECT 'empty', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality > 1)",
)
oracle(
    "orphan_rows",
    "SELECT user_id, count(*) AS n FROM events LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') "
    "ON c_custkey = user_id WHERE c_custkey IS NULL GROUP BY user_id",
)
oracle(
    "missing_references",
    "SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'view' "
    "AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_acctbal > 0) GROUP BY user_id",
)
oracle(
    "pk_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
oracle(
    "null_violations",
    "SELECT 'resident_id' AS column_name, count(*) - count(resident_id) AS n FROM stay "
    "UNION ALL SELECT 'community_id', count(*) - count(community_id) FROM stay "
    "UNION ALL SELECT 'admit_date', count(*) - count(admit_date) FROM stay "
    "UNION ALL SELECT 'discharge_date', count(*) - count(discharge_date) FROM stay",
    "stay",
)
oracle(
    "decimal_misfits",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL",
)
oracle(
    "drift_union",
    "SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer",
)
oracle(
    "incremental_skip",
    "SELECT d.doc_id AS file_name, md5(text) AS file_hash, "
    "CASE WHEN quality <> 0 THEN 'skip' ELSE 'load' END AS status FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
)

# --- stays, ranges, leases ----------------------------------------------------------------

oracle("analysis_window", "SELECT window_start, window_end FROM span", "span")
oracle("scd2_build", "SELECT * FROM range_of_level", "range_of_level")
oracle(
    "scd2_point_in_time",
    "SELECT i.resident_id, date_key, CAST(severity AS BIGINT) AS severity, r.care_level FROM incident i "
    f"LEFT JOIN range_of_level r ON r.resident_id = i.resident_id AND {VALID.format(day='date_key')}",
    "incident",
    "range_of_level",
)
oracle(
    "census_days",
    "SELECT d AS date_key, community_id, count(*) AS resident_days, count(care_level_key) AS with_level, "
    "CAST(sum(care_level_key) AS BIGINT) AS key_sum FROM resident_day x "
    f"LEFT JOIN range_of_level r ON r.resident_id = x.resident_id AND {VALID.format(day='d')} GROUP BY ALL",
    "resident_day",
    "range_of_level",
)
oracle("census_closed_form", "SELECT count(*) AS resident_days FROM resident_day", "resident_day")
oracle("census_monthly", "SELECT * FROM census", "census")
LEASE_MONTHS = (
    "SELECT month_start, lease_id, community_id, active, CAST(round(rate * active / days, 2) AS DECIMAL(12,2)) AS revenue "
    "FROM (SELECT month_start, lease_id, community_id, "
    "CAST(CAST(monthly_rate AS DECIMAL(10,2)) AS DOUBLE) AS rate, day(last_day(month_start)) AS days, "
    "least(coalesce(CAST(move_out_date - INTERVAL 1 DAY AS DATE), last_day(month_start)), last_day(month_start)) "
    "- greatest(move_in_date, month_start) + 1 AS active "
    "FROM lease JOIN (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS month_start FROM days) "
    "ON move_in_date <= last_day(month_start) AND (move_out_date IS NULL OR move_out_date > month_start))"
)
oracle(
    "lease_month_rows",
    "SELECT CAST(lease_id AS VARCHAR) AS lease_id, CAST(community_id AS VARCHAR) AS community_id, "
    "string_agg(strftime(month_start, '%Y-%m') || ':' || active || ':' || CAST(revenue * 100 AS BIGINT), ' ' ORDER BY month_start) "
    f"AS months FROM ({LEASE_MONTHS}) GROUP BY ALL",
    "lease",
    "days",
)
oracle(
    "resident_day_digest",
    "SELECT x.resident_id, community_id, count(*) AS days, min(d) AS first_day, max(d) AS last_day, CAST(sum("
    "(d - DATE '1970-01-01')::HUGEINT * (d - DATE '1970-01-01') * (coalesce(care_level_key, 0) + 1)) AS DOUBLE) AS weighed "
    "FROM resident_day x "
    f"LEFT JOIN range_of_level r ON r.resident_id = x.resident_id AND {VALID.format(day='d')} GROUP BY ALL",
    "resident_day",
    "range_of_level",
)
oracle(
    "care_level_candidates",
    "SELECT user_id AS resident_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, "
    "c_nationkey::BIGINT AS community_id, community_name, c_mktsegment AS current_care_level, from_month, from_acuity, to_month, "
    "to_acuity, acuity_increase FROM (SELECT a.user_id, a.week AS from_month, a.acuity AS from_acuity, b.week AS to_month, "
    "b.acuity AS to_acuity, b.acuity - a.acuity AS acuity_increase FROM score a JOIN score b ON a.user_id = b.user_id "
    "AND b.week > a.week AND b.week <= a.week + INTERVAL 90 DAY WHERE b.acuity - a.acuity >= 2 QUALIFY row_number() OVER "
    "(PARTITION BY a.user_id ORDER BY b.acuity - a.acuity DESC, b.week, a.week) = 1) "
    "JOIN customer ON c_custkey = user_id JOIN community c ON c.community_id = c_nationkey",
    "score",
    "community",
)
oracle(
    "prorated_revenue",
    "SELECT month_start, CAST(community_id AS VARCHAR) AS community_id, count(*) AS lease_months, "
    "CAST(sum(active) AS BIGINT) AS active_days, CAST(sum(CAST(round(rate * active / days, 2) AS DECIMAL(12,2))) AS DOUBLE) "
    "AS revenue FROM (SELECT month_start, community_id, "
    "CAST(CAST(monthly_rate AS DECIMAL(10,2)) AS DOUBLE) AS rate, day(last_day(month_start)) AS days, "
    "least(coalesce(CAST(move_out_date - INTERVAL 1 DAY AS DATE), last_day(month_start)), last_day(month_start)) "
    "- greatest(move_in_date, month_start) + 1 AS active "
    "FROM lease JOIN (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS month_start FROM days) "
    "ON move_in_date <= last_day(month_start) AND (move_out_date IS NULL OR move_out_date > month_start)) GROUP BY ALL",
    "lease",
    "days",
)
oracle(
    "lease_overlap_pairs",
    "SELECT a.resident_id, count(*) AS pairs FROM lease a JOIN lease b ON a.resident_id = b.resident_id "
    "AND a.lease_id < b.lease_id AND a.move_in_date < coalesce(b.move_out_date, DATE '2099-01-01') "
    "AND b.move_in_date < coalesce(a.move_out_date, DATE '2099-01-01') GROUP BY a.resident_id",
    "lease",
)
LEASE_SPANS = "SELECT resident_id, lease_id, move_in_date AS s, coalesce(move_out_date, DATE '2099-01-01') AS e FROM lease"
oracle(
    "lease_overlap_witnesses",
    "SELECT a.resident_id, a.lease_id, arg_max(b.lease_id, {'e': b.e, 'i': b.lease_id}) AS earlier_lease_id "
    f"FROM ({LEASE_SPANS}) a JOIN ({LEASE_SPANS}) b "
    "ON a.resident_id = b.resident_id AND a.lease_id <> b.lease_id AND (b.s, b.e, b.lease_id) < (a.s, a.e, a.lease_id) "
    "AND a.s < b.e AND b.s < a.e AND a.s < a.e AND b.s < b.e GROUP BY ALL",
    "lease",
)
oracle(
    "repeated_resident_days",
    "SELECT resident_id, count(*) AS days FROM (SELECT resident_id, d FROM lease, "
    "generate_series(move_in_date, coalesce(move_out_date, DATE '2099-01-01'), INTERVAL 1 DAY) AS x(d) GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL",
    "lease",
)
oracle(
    "events_in_force",
    "WITH f AS (SELECT user_id, CAST(ts AS DATE) AS d, max(event_type) AS held FROM events GROUP BY ALL) "
    "SELECT event_id, e.user_id, f.held FROM events e LEFT JOIN f ON f.user_id = e.user_id AND f.d = "
    "(SELECT max(g.d) FROM f g WHERE g.user_id = e.user_id AND g.d < CAST(e.ts AS DATE))",
)
oracle(
    "closed_overlap_pairs",
    "SELECT a.resident_id, count(*) AS pairs FROM lease a JOIN lease b ON a.resident_id = b.resident_id "
    "AND a.lease_id < b.lease_id AND a.move_in_date <= coalesce(b.move_out_date, DATE '2099-01-01') "
    "AND b.move_in_date <= coalesce(a.move_out_date, DATE '2099-01-01') GROUP BY a.resident_id",
    "lease",
)
oracle(
    "scd2_overlap_pairs",
    "SELECT (SELECT count(*) FROM range_of_level) AS ranges, count(*) AS overlaps FROM range_of_level a "
    "JOIN range_of_level b ON a.resident_id = b.resident_id AND a.care_level_key < b.care_level_key "
    "AND a.effective_from <= coalesce(b.effective_to, DATE '2099-01-01') "
    "AND b.effective_from <= coalesce(a.effective_to, DATE '2099-01-01')",
    "range_of_level",
)
oracle(
    "multi_current",
    "SELECT resident_id, count(*) AS n FROM lease WHERE move_out_date IS NULL GROUP BY resident_id HAVING count(*) > 1",
    "lease",
)
oracle(
    "trailing_window_filter",
    "SELECT lease_id, move_out_date FROM lease, anchor WHERE move_out_date > last_d - INTERVAL 6 MONTH",
    "lease",
    "anchor",
)
oracle(
    "month_bucket_filter",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders "
    "WHERE date_trunc('month', o_orderdate) BETWEEN date_trunc('month', DATE '1998-02-10') AND DATE '1998-07-04'",
)
oracle("response_lag", "SELECT review_id, date_key, was_responded, response_days FROM review", "review")
oracle(
    "accumulating_snapshot_flags",
    "SELECT lead_id, community_id, status, tour_date IS NOT NULL AS toured, deposit_date IS NOT NULL AS deposited, "
    "status = 'Won' AS converted FROM lead_funnel",
    "lead_funnel",
)
oracle(
    "funnel_chronology",
    "SELECT count(*) FILTER (deposit_date < tour_date) AS early_deposit, "
    "count(*) FILTER (move_in_date < deposit_date) AS early_move_in FROM lead_funnel",
    "lead_funnel",
)

# --- KPIs and metrics ---------------------------------------------------------------------

oracle("occupancy_monthly", "SELECT * FROM occupancy", "occupancy")
oracle(
    "los_by_level",
    "SELECT coalesce(r.care_level, s.care_level) AS care_level, count(*) AS discharged_residents, "
    "round(avg(discharge_date - admit_date), 1) AS avg_length_of_stay_days, "
    "round(median(discharge_date - admit_date), 1) AS median_length_of_stay_days FROM stay s JOIN anchor "
    "ON discharge_date > last_d - INTERVAL 12 MONTH LEFT JOIN range_of_level r ON r.resident_id = s.resident_id "
    f"AND {VALID.format(day='(discharge_date - 1)')} GROUP BY ALL",
    "stay",
    "anchor",
    "range_of_level",
)
oracle(
    "top_reasons",
    "SELECT community_id, community_name, rank, reason AS move_out_reason, n AS reason_count, total AS total_moveouts, "
    "round(100.0 * n / total, 1) AS pct_of_moveouts FROM (SELECT community_id, reason, count(*) AS n, "
    "CAST(sum(count(*)) OVER (PARTITION BY community_id) AS BIGINT) AS total, "
    "row_number() OVER (PARTITION BY community_id ORDER BY count(*) DESC, reason) AS rank FROM moveout "
    "WHERE move_out_date > last_d - INTERVAL 12 MONTH GROUP BY community_id, reason) "
    "JOIN community USING (community_id) WHERE rank <= 3",
    "moveout",
    "community",
)
oracle("labor_cost_per_day", "SELECT * FROM labor", "labor")
oracle(
    "incident_rate_community",
    "SELECT month_start, community_id, community_name, region, coalesce(n, 0) AS incident_count, resident_days, "
    "round(100.0 * coalesce(n, 0) / resident_days, 2) AS incidents_per_100_resident_days FROM census "
    "LEFT JOIN (SELECT CAST(date_trunc('month', date_key) AS DATE) AS month_start, community_id, count(*) AS n "
    "FROM incident GROUP BY ALL) USING (month_start, community_id) JOIN community USING (community_id)",
    "census",
    "incident",
    "community",
)
oracle(
    "incident_rate_level",
    "SELECT care_level, CAST(coalesce(n, 0) AS BIGINT) AS incident_count, resident_days, "
    "round(100.0 * coalesce(n, 0) / resident_days, 2) AS incidents_per_100_resident_days "
    "FROM (SELECT coalesce(care_level, 'Unknown') AS care_level, count(*) AS resident_days FROM resident_day x "
    f"LEFT JOIN range_of_level r ON r.resident_id = x.resident_id AND {VALID.format(day='d')} GROUP BY ALL) "
    "LEFT JOIN (SELECT coalesce(care_level, 'Unknown') AS care_level, count(*) AS n FROM incident i "
    f"LEFT JOIN range_of_level r ON r.resident_id = i.resident_id AND {VALID.format(day='date_key')} GROUP BY ALL) "
    "USING (care_level)",
    "resident_day",
    "range_of_level",
    "incident",
)
oracle(
    "review_candidates",
    "SELECT a.user_id, a.week AS from_month, a.acuity AS from_acuity, b.week AS to_month, b.acuity AS to_acuity, "
    "b.acuity - a.acuity AS acuity_increase FROM score a JOIN score b ON a.user_id = b.user_id AND b.week > a.week "
    "AND b.week <= a.week + INTERVAL 90 DAY WHERE b.acuity - a.acuity >= 2 QUALIFY row_number() OVER "
    "(PARTITION BY a.user_id ORDER BY b.acuity - a.acuity DESC, b.week, a.week) = 1",
    "score",
)
oracle("reviews_summary", "SELECT * FROM review_month", "review_month")
MONTHS = "month_start BETWEEN date_trunc('month', DATE '1998-02-10') AND DATE '1999-05-20'"
oracle(
    "scope_by_role",
    "SELECT 'admin' AS user, 'corporate_admin' AS role, community_id FROM community "
    "UNION ALL SELECT 'regional', 'regional_director', community_id FROM community JOIN second_region USING (region) "
    "UNION ALL SELECT 'executive', 'executive_director', community_id FROM community WHERE community_id = 7",
    "community",
    "second_region",
)
oracle("scope_region_intersection", "SELECT community_id FROM community JOIN second_region USING (region)", "community", "second_region")
oracle(
    "metric_occupancy_scoped",
    "SELECT month_start, community_id, community_name, region, resident_days, unit_count, occupancy_pct FROM occupancy "
    f"WHERE region = (SELECT region FROM second_region) AND {MONTHS}",
    "occupancy",
    "second_region",
)
for months in (3, 6, 12):
    oracle(
        f"metric_moveout_{months}m",
        "SELECT community_id, reason, count(*) AS move_outs, "
        "round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY community_id), 1) AS pct_of_moveouts FROM moveout "
        f"WHERE move_out_date > last_d - INTERVAL {months} MONTH GROUP BY community_id, reason",
        "moveout",
    )
oracle(
    "metric_incidents_region",
    "SELECT community_id, community_name, region, coalesce(n, 0) AS incidents, avg_severity, "
    "CAST(coalesce(severe, 0) AS BIGINT) AS severe_incidents, resident_days, "
    "round(100.0 * coalesce(n, 0) / resident_days, 2) AS incidents_per_100_resident_days "
    "FROM (SELECT community_id, count(*) AS resident_days FROM resident_day "
    "WHERE d BETWEEN DATE '1998-02-10' AND DATE '1999-05-20' GROUP BY ALL) "
    "LEFT JOIN (SELECT community_id, count(*) AS n, round(avg(severity), 2) AS avg_severity, "
    "sum(CASE WHEN severity >= 4 THEN 1 ELSE 0 END) AS severe FROM incident "
    "WHERE date_key BETWEEN DATE '1998-02-10' AND DATE '1999-05-20' GROUP BY ALL) USING (community_id) "
    "JOIN community USING (community_id) WHERE region = (SELECT region FROM second_region)",
    "resident_day",
    "incident",
    "community",
    "second_region",
)
SQL["metric_incidents_daily"] = SQL["metric_incidents_region"]
oracle(
    "metric_labor_scoped",
    f"SELECT * FROM labor WHERE region = (SELECT region FROM second_region) AND {MONTHS}",
    "labor",
    "second_region",
)
oracle("metric_reviews_scoped", f"SELECT * FROM review_month WHERE community_id = 7 AND {MONTHS}", "review_month")

# --- cleaners and star schema -------------------------------------------------------------

oracle("clean_residents", "SELECT *, CAST(NULL AS VARCHAR) AS mobility_status FROM resident_month", "resident_month")
oracle(
    "clean_residents_current",
    "SELECT * EXCLUDE (snapshot_month), CAST(NULL AS VARCHAR) AS mobility_status FROM resident_now",
    "resident_now",
)
oracle("clean_residents_log", "SELECT * FROM resident_log", "resident_log")
oracle("clean_incidents", "SELECT * FROM incident_clean", "incident_clean")
oracle("clean_incidents_log", "SELECT * FROM incident_log", "incident_log")
oracle("clean_care_history", "SELECT * FROM history_clean", "history_clean")
oracle("clean_units", "SELECT * FROM unit_clean", "unit_clean")
oracle("clean_units_current", "SELECT * FROM unit_now", "unit_now")
oracle("clean_units_log", "SELECT * FROM unit_log", "unit_log")
oracle("clean_leases", "SELECT * FROM lease_clean", "lease_clean")
oracle("clean_leases_log", "SELECT * FROM lease_log", "lease_log")
oracle("clean_shifts", "SELECT * FROM shift_clean", "shift_clean")
oracle("clean_shifts_log", "SELECT * FROM shift_log", "shift_log")
oracle("clean_reviews", "SELECT * FROM review_clean", "review_clean")
oracle("clean_reviews_log", "SELECT * FROM review_log", "review_log")
oracle("clean_leads", "SELECT * FROM lead_clean", "lead_clean")
oracle("clean_leads_log", "SELECT * FROM lead_log", "lead_log")
oracle(
    "quarantine_summary",
    "SELECT source_table, reason, action_taken, count(*) AS rows_affected FROM full_log GROUP BY ALL",
    "full_log",
)
oracle("dim_unit", "SELECT unit_id, community_id, unit_type, monthly_rent AS list_rent FROM unit_now", "unit_now")
oracle(
    "star_misfits",
    "SELECT 'dim_unit' AS table_name, 'list_rent fits decimal(10,2)' AS rule, count(*) AS n FROM unit_now",
    "unit_now",
)
oracle(
    "dim_resident",
    "SELECT resident_id, community_id, first_name, last_name, dob, gender, admit_date, discharge_date, "
    "care_level AS current_care_level, CAST(acuity_score AS BIGINT) AS current_acuity FROM resident_now",
    "resident_now",
)
oracle(
    "fact_shift",
    "SELECT shift_id, shift_date AS date_key, community_id, employee_id, role, hours_worked, hourly_rate, labor_cost "
    "FROM shift_clean WHERE shift_date IS NOT NULL",
    "shift_clean",
)
oracle(
    "fact_incident",
    "SELECT incident_id, incident_date AS date_key, resident_id, community_id, incident_type, "
    "CAST(severity AS BIGINT) AS severity, reported_by FROM incident_clean",
    "incident_clean",
)
oracle("fact_lease", "SELECT * FROM lease_clean", "lease_clean")
oracle(
    "fact_review",
    "SELECT review_id, review_date AS date_key, community_id, CAST(rating AS BIGINT) AS rating, "
    "responded_at IS NOT NULL AS was_responded, responded_at - review_date AS response_days FROM review_clean "
    "WHERE review_date IS NOT NULL",
    "review_clean",
)
oracle(
    "fact_lead",
    "SELECT *, tour_date IS NOT NULL AS toured, "
    "deposit_date IS NOT NULL AS deposited, status = 'Won' AS converted FROM lead_clean",
    "lead_clean",
)

# --- reconciliation -----------------------------------------------------------------------

# landed table -> (rows as landed, cleaned table, rows as cleaned, rows of the fact)
COUNTED = {
    "pcc_residents": ("shipped", "residents_monthly", "resident_month"),
    "pcc_incidents": ("lineitem", "incidents", "incident_clean"),
    "pcc_care_history": ("lineitem", "care_history", "history_clean"),
    "yardi_units": ("raw_unit", "units_monthly", "unit_clean"),
    "yardi_leases": ("lease_export", "leases", "lease_clean"),
    "adp_shifts": ("lineitem", "shifts", "shift_clean"),
    "gbp_reviews": ("shipped", "reviews", "review_clean"),
    "hubspot_leads": ("shipped", "leads", "lead_clean"),
}
ALL_CLEAN = [c for _, _, c in COUNTED.values()] + ["lease_export", "raw_unit", "full_log"]
oracle(
    "run_metrics",
    " UNION ALL ".join(
        f"SELECT 'bronze {t}' AS object, count(*) AS row_count FROM {raw} "
        f"UNION ALL SELECT 'silver {name}', count(*) FROM {clean}"
        for t, (raw, name, clean) in COUNTED.items()
    )
    + " UNION ALL SELECT 'silver quarantine', count(*) FROM full_log",
    *ALL_CLEAN,
)


def check(section: str, name: str, ok: str, detail: str, source: str, severity="CRITICAL", action="fix in pipeline", bad="FAIL"):
    return (
        f"SELECT '{section}' AS section, {name} AS \"check\", CASE WHEN {ok} THEN 'PASS' ELSE '{bad}' END AS status, "
        f"CASE WHEN {ok} THEN 'INFO' ELSE '{severity}' END AS severity, {detail} AS detail, "
        f"CASE WHEN NOT ({ok}) THEN '{action}' END AS recommended_action FROM {source}"
    )


def landed_check(table: str, raw: str) -> str:
    lost = "0"
    if table == "gbp_reviews":
        lost = "count(DISTINCT date_trunc('month', admit_date)) FILTER (year(admit_date) = 1998)"
    return check(
        "Row reconciliation",
        f"'source -> bronze: {table}'",
        "n = kept",
        "'source files ' || n || ' rows, bronze ' || kept || ' rows'",
        f"(SELECT count(*) + {lost} AS n, count(*) AS kept FROM {raw})",
    )


oracle(
    "reconcile_landed",
    " UNION ALL ".join(landed_check(t, raw) for t, (raw, _, _) in COUNTED.items()),
    "shipped",
    "raw_unit",
    "lease_export",
)


def shrink_check(table: str) -> str:
    raw, _, clean = COUNTED[table]
    return check(
        "Row reconciliation",
        f"'bronze -> silver: {table}'",
        "b >= s",
        "'bronze ' || b || ', silver ' || s || ', dropped ' || (b - s) || ' (' || q || "
        "' quarantine entries explain rejections/dedup)'",
        f"(SELECT (SELECT count(*) FROM {raw}) AS b, (SELECT count(*) FROM {clean}) AS s, "
        f"(SELECT count(*) FROM full_log WHERE source_table = '{table}') AS q)",
    )


def load_check(name: str, fact: str, clean: str, dated: str = "true") -> str:
    return check(
        "Row reconciliation",
        f"'silver -> gold: {name} -> {fact}'",
        "abs(s - g) <= greatest(1, s * 0.01)",
        "'silver ' || s || ', gold ' || g",
        f"(SELECT count(*) AS s, count(*) FILTER ({dated}) AS g FROM {clean})",
    )


oracle(
    "reconcile_counts",
    " UNION ALL ".join(
        [shrink_check(t) for t in COUNTED if t not in ("pcc_care_history", "hubspot_leads")]
        + [
            load_check("incidents", "fact_incident", "incident_clean"),
            load_check("leases", "fact_lease", "lease_clean"),
            load_check("leads", "fact_lead", "lead_clean"),
            load_check("reviews", "fact_review", "review_clean", "review_date IS NOT NULL"),
            load_check("shifts", "fact_shift", "shift_clean"),
        ]
    ),
    *ALL_CLEAN,
)

AGG = "Aggregate reconciliation"


def same(name: str, unit: str, value: str, source: str) -> str:
    """A total that has to be equal in both layers."""
    shown = f"format('{{:,.2f}}', CAST(v AS DOUBLE)) || '{unit}'"
    return check(
        AGG,
        f"'{name}'",
        "true",
        f"'silver ' || {shown} || ' vs gold ' || {shown} || ' (diff 0.000%, tolerance 0.5%)'",
        f"(SELECT {value} AS v FROM {source})",
    )


oracle(
    "reconcile_aggregates",
    " UNION ALL ".join(
        [
            same("total labor hours", " h", "sum(hours_worked)", "shift_clean"),
            same("total labor cost", " $", "sum(labor_cost)", "shift_clean"),
            same("distinct residents", "", "count(*)", "resident_now"),
            same("total incidents", "", "count(*)", "incident_clean"),
            same(
                "total resident-days (independent recompute)",
                "",
                "count(*)",
                "resident_now JOIN days ON admit_date <= d AND (discharge_date IS NULL OR discharge_date > d)",
            ),
            check(
                AGG,
                "'total prorated revenue (6 months)'",
                "true",
                "'gold total $' || format('{:,.0f}', CAST(v AS DOUBLE)) || "
                "' — proration verified row-level by active_days/days_in_month bounds check below'",
                "(SELECT sum(revenue) AS v FROM lease_month)",
            ),
            check(
                AGG,
                "'revenue proration bounds'",
                "v = 0",
                "v || ' rows violate 1 <= active_days <= days_in_month or revenue bounds'",
                "(SELECT count(*) AS v FROM lease_month WHERE active < 1 OR active > days OR revenue < 0 "
                "OR revenue > rate * 1.01)",
            ),
        ]
    ),
    "shift_clean",
    "resident_now",
    "incident_clean",
    "days",
    "lease_month",
)

oracle("business_rules", "SELECT * FROM rule_violation", "rule_violation")

def rule_check(rule: str, title: str, severity: str, action: str, bad: str, told: str) -> str:
    source = f"(SELECT n FROM rule_violation WHERE rule = '{rule}')"
    return check("Business rules", f"'{title}'", "n = 0", f"n || '{told}'", source, severity, action, bad)


REPORT = " UNION ALL ".join(
    [rule_check(*r, "FAIL", " violating rows") for r in HARD_RULES]
    + [
        rule_check(
            rule,
            title,
            "MEDIUM",
            "raise to client",
            "WARN",
            " leads out of order — possibly process reality (deposits without tours), possibly CRM data entry",
        )
        for rule, title in SOFT_RULES
    ]
)
oracle("business_rule_report", REPORT, "rule_violation")
oracle(
    "check_summary",
    "SELECT count(*) AS checks_run, count(*) FILTER (status = 'PASS') AS passed, "
    f"count(*) FILTER (status = 'WARN') AS warnings, count(*) FILTER (status = 'FAIL') AS failures FROM ({REPORT})",
    "rule_violation",
)

# --- files --------------------------------------------------------------------------------

oracle(
    "replace_by_file",
    "SELECT f AS source_file, CASE WHEN f LIKE '%\\_1997\\_%' ESCAPE '\\' THEN 'second' ELSE 'first' END AS batch_id, "
    "count(*) AS n, count(*) FILTER (rating = 1 OR f LIKE '%\\_1997\\_%' ESCAPE '\\') AS ones FROM raw_review GROUP BY ALL",
    "raw_review",
)
oracle(
    "saved_tables",
    "SELECT object, layer, n AS row_count, 'written' AS status, n AS stored FROM (SELECT 'orders' AS object, 'silver' AS layer, "
    "count(*) AS n FROM orders UNION ALL SELECT 'lineitem', 'gold', count(*) FROM lineitem)",
)
oracle("views_by_sql", "SELECT region, CAST(sum(review_count) AS BIGINT) AS reviews FROM review_month GROUP BY region", "review_month")
oracle(
    "export_csv",
    "SELECT doc_id, ' \"' || text || '\"' || chr(10) AS text, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN lang END AS lang, "
    "source, n_chars FROM documents",
)


def landed(extra: str) -> str:
    return (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CASE o_orderstatus WHEN 'F' THEN o_orderpriority "
        "WHEN 'O' THEN o_orderpriority || ',' || chr(10) || '\"x\"' END AS o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate, "
        f"CASE o_orderstatus WHEN 'P' THEN '{extra}' END AS extra, 'hubspot_leads_2025_0' || "
        "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END || '.csv' AS source_file, "
        "'hubspot' AS source_system FROM orders"
    )


oracle("landing_rows", landed("newer"))
oracle("stream_landing", landed("new"))
oracle(
    "landing_registry",
    "WITH f AS (SELECT * FROM (VALUES ('hubspot_leads_2025_01.csv', 'F', "
    "'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority'), ('hubspot_leads_2025_02.csv', 'O', "
    "'o_totalprice,o_orderkey,o_orderpriority,o_orderdate,o_orderstatus,o_custkey'), ('hubspot_leads_2025_03.csv', 'P', "
    "'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,extra'), ('notes_2025_01.csv', NULL, NULL)) AS v(file_name, st, columns)) "
    "SELECT CAST(run AS INTEGER) AS run, file_name, CASE WHEN st IS NULL THEN 'ignored' WHEN run = 0 OR (run = 2 AND st = 'F') "
    "THEN 'loaded' ELSE 'skipped' END AS status, CASE WHEN st IS NOT NULL THEN (SELECT count(*) FROM orders WHERE o_orderstatus = st) END "
    "AS row_count, columns, (SELECT count(*) FROM orders) AS table_rows, CAST(CASE run WHEN 0 THEN 3 WHEN 1 THEN 0 ELSE 1 END AS BIGINT) "
    "AS files_read, run <> 1 AS read_any FROM f, (VALUES (0), (1), (2)) AS r(run)",
)
