"""Shared parts of the oracle SQL: what the cleaned tables must contain.

Written straight from the driver's tables, without the raw JSON and untidy text
that the Spark side has to clean first.
"""

PARTS = {
    "fx_nation": """
        SELECT CAST(n_nationkey AS BIGINT) AS n, n_name, upper(n_name[1:1]) || lower(n_name[2:]) AS pretty FROM nation""",
    "fx_member": """
        SELECT c_custkey AS community_member_id,
               'Member' || (c_custkey % 100) AS first_name,
               pretty AS last_name,
               'Member' || (c_custkey % 100) || ' ' || pretty AS full_name,
               lower(c_name) || '@example.com' AS email,
               CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal) AS BIGINT) % 50 ELSE 0 END AS posts_count,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey % 7 ELSE 0 END AS comments_count,
               TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER)) AS joined_at,
               n AS nation_id,
               (c_custkey % 10 = 0 AND n < 22) AS is_manager
        FROM customer JOIN fx_nation ON c_nationkey = n""",
    "fx_member_tag": """
        SELECT community_member_id, email, is_manager, nation_id AS tag_id FROM fx_member
        UNION ALL SELECT community_member_id, email, is_manager, 100 FROM fx_member
        UNION ALL SELECT community_member_id, email, is_manager, 101 FROM fx_member WHERE is_manager
        UNION ALL SELECT community_member_id, email, is_manager, (nation_id + 1) % 22 FROM fx_member
                  WHERE is_manager AND community_member_id % 20 = 0
        UNION ALL SELECT community_member_id, email, is_manager, (nation_id + 1) % 25 FROM fx_member
                  WHERE community_member_id % 15 = 7""",
    "fx_tag": """
        SELECT n AS tag_id, n_name AS tag_name, n AS age, (n % 2 = 0) AS on_profile FROM fx_nation
        UNION ALL SELECT 100, 'Business', 30, FALSE
        UNION ALL SELECT 101, 'Manager', 30, FALSE
        UNION ALL SELECT 102, 'Pro', 30, FALSE
        UNION ALL SELECT r_regionkey + 200, 'Completed - ' || r_name, r_regionkey, TRUE FROM region""",
    "fx_activity": """
        SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(date_trunc('week', ts) AS DATE) AS wk
        FROM events""",
    "fx_metric": """
        SELECT user_id AS m, wk, 'classes_attended' AS metric, k AS item FROM fx_activity WHERE event_type = 'view' AND k % 4 <> 0
        UNION ALL SELECT user_id, wk, 'lessons_completed', k FROM fx_activity WHERE event_type = 'click'
        UNION ALL SELECT user_id, wk, 'likes_received', event_id FROM fx_activity WHERE event_type = 'purchase'
        UNION ALL SELECT user_id, wk, 'comments_received', event_id FROM fx_activity WHERE event_type = 'signup'
        UNION ALL SELECT user_id, wk, 'comments_made', event_id FROM fx_activity WHERE event_type = 'error'""",
    "fx_weekly": """
        SELECT m, wk, metric, COUNT(DISTINCT item) AS n FROM fx_metric GROUP BY m, wk, metric""",
    "fx_wide": """
        SELECT m, wk,
               CAST(SUM(CASE WHEN metric = 'classes_attended' THEN n ELSE 0 END) AS BIGINT) AS classes_attended,
               CAST(SUM(CASE WHEN metric = 'lessons_completed' THEN n ELSE 0 END) AS BIGINT) AS lessons_completed,
               CAST(SUM(CASE WHEN metric = 'likes_received' THEN n ELSE 0 END) AS BIGINT) AS likes_received,
               CAST(SUM(CASE WHEN metric = 'comments_received' THEN n ELSE 0 END) AS BIGINT) AS comments_received,
               CAST(SUM(CASE WHEN metric = 'comments_made' THEN n ELSE 0 END) AS BIGINT) AS comments_made
        FROM fx_weekly GROUP BY m, wk""",
    "fx_grid": """
        SELECT p.community_member_id, p.email, p.first_name, p.last_name, w.wk AS week_start_date
        FROM fx_member p, (SELECT DISTINCT wk FROM fx_weekly) w
        WHERE w.wk >= CAST(date_trunc('week', p.joined_at) AS DATE)""",
    "fx_engagement": """
        SELECT g.*, CAST(g.week_start_date + 6 AS DATE) AS week_end_date,
               COALESCE(x.classes_attended, 0) AS classes_attended, COALESCE(x.lessons_completed, 0) AS lessons_completed,
               COALESCE(x.likes_received, 0) AS likes_received, COALESCE(x.comments_received, 0) AS comments_received,
               COALESCE(x.comments_made, 0) AS comments_made, x.m IS NOT NULL AS has_activity
        FROM fx_grid g LEFT JOIN fx_wide x ON x.m = g.community_member_id AND x.wk = g.week_start_date""",
    "fx_business": """
        SELECT t.tag_id, t.tag_name AS business_name, c.members, t.on_profile, t.age,
               CASE WHEN t.on_profile AND c.members >= 2 THEN 'high' WHEN t.on_profile THEN 'medium' ELSE 'low' END AS confidence,
               CASE WHEN c.members >= 20 THEN 'large' WHEN c.members >= 10 THEN 'medium' WHEN c.members >= 5 THEN 'small'
                    WHEN c.members >= 2 THEN 'micro' ELSE 'single' END AS size
        FROM fx_tag t
        JOIN (SELECT tag_id, COUNT(DISTINCT email) AS members FROM fx_member_tag GROUP BY tag_id) c USING (tag_id)
        WHERE t.tag_id < 100""",
    "fx_invited": """
        SELECT s_suppkey AS s, CASE WHEN s_suppkey % 9 <> 4 THEN s_suppkey END AS manager_id,
               'Sup' || s_suppkey AS first_name,
               CASE WHEN s_suppkey % 5 <> 0 THEN 'O''hara-Lee' END AS last_name,
               'Sup' || s_suppkey || CASE WHEN s_suppkey % 5 <> 0 THEN ' O''hara-Lee' ELSE '' END AS full_name,
               lower(s_name) || '@example.com' AS email,
               CASE WHEN s_suppkey % 3 = 0 THEN TIMESTAMP '2024-01-02 03:04:05' END AS join_date,
               CASE WHEN s_suppkey % 3 = 0 THEN TRUE WHEN s_suppkey % 3 = 1 THEN FALSE END AS in_community,
               CASE WHEN s_suppkey % 4 <> 0 THEN 'sent' END AS invitation_status,
               TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey % 20 AS INTEGER)) AS invitation_date,
               CASE WHEN n < 23 THEN lower(n_name) END AS business, n
        FROM supplier JOIN fx_nation ON s_nationkey = n""",
    "fx_assignment": """
        SELECT b.tag_id, p.community_member_id AS manager_id, p.first_name, p.last_name, p.full_name, p.email,
               'community' AS source, TRUE AS in_community, CAST(NULL AS VARCHAR) AS invitation_status,
               CAST(NULL AS TIMESTAMP) AS invitation_date, CAST(NULL AS TIMESTAMP) AS join_date
        FROM fx_member p JOIN fx_member_tag t ON t.community_member_id = p.community_member_id
        JOIN fx_business b ON b.tag_id = t.tag_id
        WHERE p.is_manager
        UNION ALL
        SELECT b.tag_id, i.manager_id, i.first_name, i.last_name, i.full_name, i.email, 'invited_csv',
               COALESCE(i.in_community, FALSE), i.invitation_status, i.invitation_date, i.join_date
        FROM fx_invited i JOIN fx_business b ON lower(b.business_name) = i.business""",
    "fx_mapping": """
        SELECT a.*, b.business_name, b.members AS business_total_members, b.size AS business_size,
               b.confidence AS business_confidence, GREATEST(b.members - COALESCE(c.managers, 0), 0) AS team_size
        FROM fx_assignment a JOIN fx_business b ON b.tag_id = a.tag_id
        LEFT JOIN (SELECT tag_id, COUNT(DISTINCT manager_id) AS managers FROM fx_assignment WHERE in_community GROUP BY tag_id) c
               ON c.tag_id = a.tag_id""",
    "fx_relation": """
        SELECT g.business_name, g.tag_id AS business_tag_id, g.business_total_members, g.team_size, g.business_size,
               g.business_confidence, g.manager_id AS manager_community_id, g.first_name AS manager_first_name,
               g.last_name AS manager_last_name, g.full_name AS manager_full_name, g.email AS manager_email,
               g.source AS manager_source, g.in_community AS manager_in_community, g.invitation_status,
               g.invitation_date, g.join_date, p.community_member_id AS member_community_id,
               p.first_name AS member_first_name, p.last_name AS member_last_name, p.full_name AS member_full_name,
               p.email AS member_email
        FROM fx_mapping g
        LEFT JOIN (fx_member_tag t JOIN fx_member p ON p.community_member_id = t.community_member_id AND NOT p.is_manager)
               ON t.tag_id = g.tag_id""",
    "fx_team": """
        SELECT r.business_name, r.business_tag_id, r.business_total_members, r.business_size, r.business_confidence,
               r.manager_community_id, r.manager_email, r.manager_first_name, r.manager_last_name, r.manager_full_name,
               r.member_community_id, r.member_email, r.member_first_name, r.member_last_name, r.team_size,
               d.week_start_date, CAST(d.week_start_date + 6 AS DATE) AS week_end_date,
               COALESCE(e.classes_attended, 0) AS classes_attended, COALESCE(e.lessons_completed, 0) AS lessons_completed,
               COALESCE(e.likes_received, 0) AS likes_received, COALESCE(e.comments_received, 0) AS comments_received,
               COALESCE(e.comments_made, 0) AS comments_made, COALESCE(e.has_activity, FALSE) AS has_activity
        FROM fx_relation r
        CROSS JOIN (SELECT DATE '2024-01-22' AS week_start_date UNION ALL SELECT DATE '2024-01-15') d
        LEFT JOIN fx_engagement e ON e.community_member_id = r.member_community_id AND e.week_start_date = d.week_start_date""",
    "fx_scored": """
        SELECT *, trim(COALESCE(member_first_name, '') || ' ' || COALESCE(member_last_name, '')) AS member_full_name,
               classes_attended * 5 + lessons_completed + likes_received + comments_received + comments_made AS total_points,
               classes_attended + lessons_completed + likes_received + comments_received + comments_made AS total_events
        FROM fx_team""",
    "fx_compared": """
        SELECT a.*, COALESCE(b.total_points, 0) AS previous_week_points, COALESCE(b.total_events, 0) AS previous_events,
               COALESCE(b.classes_attended, 0) AS p_classes, COALESCE(b.lessons_completed, 0) AS p_lessons,
               COALESCE(b.likes_received, 0) AS p_likes, COALESCE(b.comments_received, 0) AS p_received,
               COALESCE(b.comments_made, 0) AS p_made,
               a.total_points - COALESCE(b.total_points, 0) AS points_change
        FROM (SELECT * FROM fx_scored WHERE week_start_date = DATE '2024-01-22') a
        LEFT JOIN (SELECT * FROM fx_scored WHERE week_start_date = DATE '2024-01-15') b
               ON a.manager_email = b.manager_email AND a.business_name = b.business_name
              AND a.member_community_id = b.member_community_id""",
    "fx_ranked": """
        SELECT *,
               row_number() OVER (PARTITION BY manager_email ORDER BY total_points DESC, member_full_name, member_community_id NULLS FIRST, business_name) AS performance_rank,
               row_number() OVER (PARTITION BY manager_email ORDER BY points_change DESC, member_full_name, member_community_id NULLS FIRST, business_name) AS mover_rank,
               row_number() OVER (PARTITION BY manager_email ORDER BY (CASE WHEN total_points = 0 THEN 1 ELSE 2 END), previous_week_points DESC, member_full_name, member_community_id NULLS FIRST, business_name) AS inactive_rank,
               percent_rank() OVER (PARTITION BY manager_email ORDER BY total_points) AS performance_percentile
        FROM fx_compared""",
    "fx_labelled": """
        SELECT *, performance_rank <= 3 AND total_points > 0 AS is_top_performer,
               mover_rank <= 3 AND points_change > 0 AS is_top_mover,
               total_points = 0 AS needs_reengagement,
               CASE WHEN total_points = 0 THEN 'no_activity' WHEN performance_rank <= 3 THEN 'top_performer'
                    WHEN performance_percentile >= 0.7 THEN 'high_performer'
                    WHEN performance_percentile >= 0.3 THEN 'average_performer' ELSE 'low_performer' END AS performance_category,
               CASE WHEN mover_rank <= 3 AND points_change > 0 THEN 'top_mover' WHEN points_change >= 5 THEN 'improving'
                    WHEN points_change <= -5 THEN 'declining' ELSE 'stable' END AS momentum_category,
               CASE WHEN performance_rank <= 3 AND total_points > 0
                      THEN '🏆 Celebrate ' || member_first_name || ' for leading the team with ' || total_points || ' points'
                    WHEN mover_rank <= 3 AND points_change > 0
                      THEN '📈 Encourage ' || member_first_name || ' to keep up the momentum (+' || points_change || ' pts this week)'
                    WHEN total_points = 0 AND inactive_rank <= 3 AND previous_week_points > 0
                      THEN '⚠️ Re-engage ' || member_first_name || ' with a lesson or live class invite (was active last week)'
                    WHEN total_points = 0 AND inactive_rank <= 3
                      THEN '💬 Re-engage ' || member_first_name || ' with a personalized message or invitation' END AS suggested_action
        FROM fx_ranked""",
    "fx_stats": """
        SELECT manager_email, business_name, MAX(team_size) AS team_size, MAX(business_total_members) AS business_total_members
        FROM fx_relation GROUP BY manager_email, business_name""",
    "fx_summary": """
        SELECT l.manager_email, l.business_name AS summary_business,
               COALESCE(MAX(s.team_size), COUNT(*)) AS team_size,
               COALESCE(MAX(s.business_total_members), COUNT(*)) AS business_total_members,
               COUNT(*) FILTER (WHERE has_activity) AS active_members, COUNT(*) FILTER (WHERE total_points = 0) AS inactive_members,
               CAST(SUM(total_points) AS BIGINT) AS team_total_points, round(AVG(total_points), 1) AS team_avg_points,
               MAX(total_points) AS team_max_points, CAST(SUM(points_change) AS BIGINT) AS team_points_change,
               round(AVG(points_change), 1) AS team_avg_points_change,
               CAST(SUM(classes_attended) AS BIGINT) AS team_classes_attended,
               CAST(SUM(lessons_completed) AS BIGINT) AS team_lessons_completed,
               CAST(SUM(likes_received) AS BIGINT) AS team_likes_received,
               CAST(SUM(comments_received) AS BIGINT) AS team_comments_received,
               CAST(SUM(comments_made) AS BIGINT) AS team_comments_made
        FROM fx_compared l LEFT JOIN fx_stats s USING (manager_email, business_name)
        GROUP BY l.manager_email, l.business_name""",
    "fx_ranking": """
        SELECT l.manager_email, l.manager_full_name, l.manager_first_name, l.manager_last_name, l.business_name,
               l.week_start_date, l.week_end_date, strftime(l.week_start_date, '%B %d, %Y') AS week_start_formatted,
               strftime(l.week_end_date, '%B %d, %Y') AS week_end_formatted, l.member_community_id, l.member_email,
               l.member_first_name, l.member_last_name, l.member_full_name, l.classes_attended, l.lessons_completed,
               l.likes_received, l.comments_received, l.comments_made, l.classes_attended * 5 AS points_from_classes,
               l.lessons_completed AS points_from_lessons, l.likes_received AS points_from_likes_received,
               l.comments_received AS points_from_comments_received, l.comments_made AS points_from_comments_made,
               l.total_points, l.previous_week_points, l.points_change, l.performance_rank, l.mover_rank,
               l.performance_category, l.momentum_category, l.suggested_action, l.is_top_performer, l.is_top_mover,
               l.needs_reengagement, s.* EXCLUDE (manager_email, summary_business)
        FROM fx_labelled l JOIN fx_summary s ON s.manager_email = l.manager_email""",
    "fx_detail": """
        SELECT c.manager_email, c.manager_full_name, c.manager_first_name, c.manager_last_name, c.business_name,
               c.week_start_date, c.week_end_date, strftime(c.week_start_date, '%B %d, %Y') AS week_start_formatted,
               strftime(c.week_end_date, '%B %d, %Y') AS week_end_formatted, c.member_community_id, c.member_email,
               c.member_first_name, c.member_last_name, c.member_full_name AS team_member,
               c.classes_attended AS live_classes_attended, c.lessons_completed, c.likes_received, c.comments_received,
               c.comments_made, c.total_events AS week_total_engagement,
               c.p_classes AS prev_live_classes_attended, c.p_lessons AS prev_lessons_completed,
               c.p_likes AS prev_likes_received, c.p_received AS prev_comments_received, c.p_made AS prev_comments_made,
               c.previous_events AS previous_week_engagement,
               c.classes_attended - c.p_classes AS classes_change, c.lessons_completed - c.p_lessons AS lessons_change,
               c.likes_received - c.p_likes AS likes_received_change,
               c.comments_received - c.p_received AS comments_received_change,
               c.comments_made - c.p_made AS comments_made_change,
               c.total_events - c.previous_events AS total_engagement_change,
               c.has_activity, CASE WHEN c.has_activity THEN 'Active' ELSE 'Inactive' END AS activity_status,
               t.* EXCLUDE (manager_email)
        FROM fx_compared c JOIN (
            SELECT manager_email, COUNT(*) AS total_team_members, COUNT(*) FILTER (WHERE has_activity) AS active_members,
                   COUNT(*) FILTER (WHERE NOT has_activity) AS inactive_members,
                   CAST(SUM(classes_attended) AS BIGINT) AS team_classes_attended,
                   CAST(SUM(lessons_completed) AS BIGINT) AS team_lessons_completed,
                   CAST(SUM(likes_received) AS BIGINT) AS team_likes_received,
                   CAST(SUM(comments_received) AS BIGINT) AS team_comments_received,
                   CAST(SUM(comments_made) AS BIGINT) AS team_comments_made,
                   CAST(SUM(total_events) AS BIGINT) AS team_total_engagement,
                   CAST(SUM(previous_events) AS BIGINT) AS team_previous_engagement,
                   round(AVG(total_events), 1) AS avg_engagement_per_member,
                   round(AVG(previous_events), 1) AS avg_previous_engagement,
                   MAX(total_events) AS highest_individual_engagement
            FROM fx_compared GROUP BY manager_email) t ON t.manager_email = c.manager_email""",
    "fx_course": """
        SELECT 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@example.com' AS initiator_email,
               o_custkey AS member, o_orderpriority AS course_id, o_orderdate AS created_at, 'o' || o_orderkey AS record_id,
               array_to_string(list_transform(regexp_extract_all(lower(o_orderpriority), '[ -]+|[^ -]+'), lambda w: upper(w[1:1]) || w[2:]), '') AS course_name,
               row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, 'o' || o_orderkey) AS pick
        FROM orders""",
    "fx_first_course": "SELECT * EXCLUDE (pick) FROM fx_course WHERE pick = 1",
}
