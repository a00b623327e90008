-- The place of each row in the table's declared order.
SELECT merchandise_division, assigned_to, dense_rank() OVER (ORDER BY merchandise_division ASC NULLS FIRST) AS place FROM ({{q:division_problem_summary}}) AS x
