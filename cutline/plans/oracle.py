"""The registered queries as DuckDB SQL over the same tables.

Written independently of the Spark plans: the shared CTEs below spell the projection, the cleaning
and the marts out in SQL. Patterns, codes, labels and thresholds in them are fixed values: results depend on
them, and they are those of `fixed_values.py`, written down once more so that a slip in either place shows.
"""

ALLOT = r"""
allot AS (
  SELECT CASE l_linenumber WHEN 1 THEN 'CAP-I' WHEN 2 THEN 'CAP-II' WHEN 3 THEN 'CAP-III'
              WHEN 4 THEN 'CAP-IV' ELSE 'CAP-V' END AS cap_round,
         lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS institute_code,
         n_name AS institute_name,
         CASE WHEN p_size = 1 THEN NULL ELSE p_type END AS branch_name,
         l_tax = 0.0 AS is_ews,
         l_tax = 0.01 AS is_tfws,
         l_linenumber AS sr_no,
         CAST(l_partkey AS INTEGER) AS merit_no,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL
              ELSE ((l_orderkey * 7 + l_linenumber * 13) % 10000) / CAST(100 AS DOUBLE) END AS mhtcet_score,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'VACANT'
              WHEN l_quantity = 1 THEN 'X' || CAST(l_orderkey AS VARCHAR)
              ELSE 'EN' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') END AS application_id,
         'CANDIDATE ' || CAST(l_partkey AS VARCHAR) AS candidate_name,
         CASE WHEN l_discount = 0.0 THEN NULL WHEN l_discount > 0.05 THEN 'F' ELSE 'M' END AS gender,
         CASE (l_orderkey + 3 * l_linenumber) % 16
              WHEN 0 THEN 'OPEN ^ GOPENH' WHEN 1 THEN 'OBC GOBCH' WHEN 2 THEN 'SC ^ GSCO'
              WHEN 3 THEN 'OBC ^ MI-MH' WHEN 4 THEN 'NT 2 (NT-C)/PH1 ^ PWDRNT2S' WHEN 5 THEN 'EWS'
              WHEN 6 THEN 'OBC$#' WHEN 7 THEN 'SC/DEF1' WHEN 8 THEN 'VJ/DT' WHEN 9 THEN 'TFWS'
              WHEN 11 THEN 'NT 1 (NT-B)' WHEN 12 THEN 'SEBC' WHEN 13 THEN 'OPEN' WHEN 14 THEN 'ST'
              WHEN 15 THEN 'OPEN' END AS candidate_category,
         CASE (l_orderkey + 3 * l_linenumber) % 16
              WHEN 5 THEN 'GOPENS' WHEN 6 THEN 'LOBCS' WHEN 7 THEN 'DEFSCS' WHEN 8 THEN 'GVJS'
              WHEN 12 THEN 'EWS' WHEN 13 THEN 'LOPENS' WHEN 14 THEN 'AI' WHEN 15 THEN 'MI' END AS seat_type,
         CAST(NULL AS VARCHAR) AS seat_marker,
         l_returnflag = 'N' AND l_linestatus = 'F' AS is_vacant,
         concat_ws('|', CASE WHEN l_orderkey % 97 = 0 THEN 'missing_score' END,
                        CASE WHEN l_discount = 0.0 THEN 'missing_gender' END,
                        CASE WHEN (l_orderkey + 3 * l_linenumber) % 16 IN (0,1,2,3,4,9,10,11)
                             THEN 'missing_seat_type' END) AS _validation_warnings,
         (CASE l_linenumber WHEN 1 THEN 'CAP-I' WHEN 2 THEN 'CAP-II' WHEN 3 THEN 'CAP-III'
               WHEN 4 THEN 'CAP-IV' ELSE 'CAP-V' END)
           || '/' || lpad(CAST(s_nationkey AS VARCHAR), 5, '0') || '.csv' AS _source_file
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

VALID = r""",
valid AS (
  SELECT * FROM allot
  WHERE is_vacant = false AND application_id IS NOT NULL AND application_id <> 'VACANT'
    AND regexp_matches(application_id, '^EN\d{8}$') AND mhtcet_score IS NOT NULL
)"""

SEAT = (
    r"([GL](?:OPEN|OBC|SC|ST|SEBC|EWS|VJ|NT[123])[HOS]"
    r"|(?:PWD|DEF)R?(?:OPEN|OBC|SC|ST|SEBC|NT[123]|VJ)?[HOS]?|MI-MH|MI|EWS|TFWS|ORPHAN|AI)\s*$"
)
MARKED = r"([~^*@&])\s+" + SEAT


def _embedded(untouched):
    return rf""",
found AS (
  SELECT *, coalesce(seat_type, '') = '' AS no_seat,
         regexp_extract(candidate_category, '{MARKED}', 1) AS mark,
         regexp_extract(candidate_category, '{MARKED}', 2) AS marked_code,
         regexp_extract(candidate_category, '{SEAT}', 1) AS bare_code
  FROM valid
),
picked AS (
  SELECT *, CASE WHEN no_seat AND marked_code <> '' THEN marked_code
                 WHEN no_seat AND bare_code <> '' THEN bare_code END AS code
  FROM found
),
separated AS (
  SELECT * EXCLUDE (no_seat, mark, marked_code, bare_code, code) REPLACE (
    nullif(coalesce(code, seat_type), '') AS seat_type,
    CASE WHEN no_seat AND mark <> '' THEN mark ELSE trim(nullif(seat_marker, '')) END AS seat_marker,
    trim(CASE WHEN code IS NOT NULL THEN regexp_replace(candidate_category, '{MARKED}', '')
              ELSE {untouched} END) AS candidate_category)
  FROM picked
)"""


SEPARATED = _embedded(f"regexp_replace(candidate_category, '{SEAT}', '')")
SEPARATED_FIXED = _embedded("candidate_category")

CLEANED = r""",
tidied AS (
  SELECT * REPLACE (trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      candidate_category, '/(?:DEF|PH)\d+', '', 'g'), '\s*\(NT-[ABCD]\)', '', 'g'),
      '[$#@]+', '', 'g'), '\s+', ' ', 'g')) AS candidate_category)
  FROM separated
),
cleaned AS (
  SELECT *, CASE
      WHEN regexp_matches(candidate_category, '(?i)^OPEN') THEN 'OPEN'
      WHEN regexp_matches(candidate_category, '(?i)^EWS') THEN 'EWS'
      WHEN regexp_matches(candidate_category, '(?i)^SBC') THEN 'SBC'
      WHEN regexp_matches(candidate_category, '(?i)^SEBC') THEN 'SEBC'
      WHEN regexp_matches(candidate_category, '(?i)^OBC') THEN 'OBC'
      WHEN regexp_matches(candidate_category, '(?i)^SC') THEN 'SC'
      WHEN regexp_matches(candidate_category, '(?i)^ST') THEN 'ST'
      WHEN regexp_matches(candidate_category, '(?i)^DT|^VJ') THEN 'VJ/DT'
      WHEN regexp_matches(candidate_category, '(?i)NT\s*1|NT\s*A') THEN 'NT1'
      WHEN regexp_matches(candidate_category, '(?i)NT\s*2|NT\s*B|NT\s*C') THEN 'NT2'
      WHEN regexp_matches(candidate_category, '(?i)NT\s*3|NT\s*D') THEN 'NT3'
      WHEN regexp_matches(candidate_category, '(?i)PWD') THEN 'PWD'
      WHEN regexp_matches(candidate_category, '(?i)DEF') THEN 'DEFENCE'
      ELSE candidate_category END AS clean_category
  FROM tidied
)"""

ATTRIBUTED = r""",
silver AS (
  SELECT *,
    CASE WHEN seat_type LIKE 'L%' THEN 'F' WHEN seat_type LIKE 'G%' THEN 'M'
         WHEN seat_type IN ('AI','MI','MI-MH','EWS','TFWS','ORPHAN') THEN 'ANY' ELSE 'M' END AS seat_gender,
    CASE WHEN seat_type LIKE '%S' THEN 'State' WHEN seat_type LIKE '%H' THEN 'HomeUniv'
         WHEN seat_type LIKE '%O' THEN 'Other' WHEN seat_type = 'AI' THEN 'AllIndia'
         WHEN seat_type IN ('MI','MI-MH') THEN 'Minority' WHEN seat_type = 'TFWS' THEN 'TFWS'
         WHEN seat_type = 'EWS' THEN 'EWS' WHEN seat_type = 'ORPHAN' THEN 'Orphan'
         WHEN seat_type LIKE 'PWD%' THEN 'PWD' WHEN seat_type LIKE 'DEF%' THEN 'Defence'
         ELSE 'Other' END AS seat_pool,
    CASE cap_round WHEN 'CAP-I' THEN 1 WHEN 'CAP-II' THEN 2 WHEN 'CAP-III' THEN 3
                   WHEN 'CAP-IV' THEN 4 END AS cap_round_num
  FROM cleaned
)"""

SILVER = ALLOT + VALID + SEPARATED + CLEANED + ATTRIBUTED

SILVER_V1 = ALLOT + VALID + r""",
silver_v1 AS (
  SELECT *,
    CASE
      WHEN regexp_matches(candidate_category, '(?i)OPEN') THEN 'OPEN'
      WHEN regexp_matches(candidate_category, '(?i)EWS') THEN 'EWS'
      WHEN regexp_matches(candidate_category, '(?i)SBC|SEBC') THEN 'SBC'
      WHEN regexp_matches(candidate_category, '(?i)OBC') THEN 'OBC'
      WHEN regexp_matches(candidate_category, '(?i)SC') THEN 'SC'
      WHEN regexp_matches(candidate_category, '(?i)ST') THEN 'ST'
      WHEN regexp_matches(candidate_category, '(?i)VJ|DT') THEN 'VJ/DT'
      WHEN regexp_matches(candidate_category, '(?i)NT.?1|NT.?A') THEN 'NT1'
      WHEN regexp_matches(candidate_category, '(?i)NT.?2|NT.?B|NT.?C') THEN 'NT2'
      WHEN regexp_matches(candidate_category, '(?i)NT.?3|NT.?D') THEN 'NT3'
      WHEN regexp_matches(candidate_category, '(?i)PWD') THEN 'PWD'
      WHEN regexp_matches(candidate_category, '(?i)DEF') THEN 'DEFENCE'
      ELSE regexp_replace(candidate_category, '[$#@()/0-9]', '', 'g') END AS clean_category,
    CASE WHEN seat_type LIKE 'L%' THEN 'F' WHEN seat_type LIKE 'G%' THEN 'M'
         WHEN seat_type = 'AI' THEN 'AI' WHEN seat_type = 'MI' THEN 'MI' ELSE 'M' END AS seat_gender,
    CASE cap_round WHEN 'CAP-I' THEN 1 WHEN 'CAP-II' THEN 2 WHEN 'CAP-III' THEN 3
                   WHEN 'CAP-IV' THEN 4 END AS cap_round_num
  FROM valid
)"""


def _cutoffs():
    return ", ".join(
        f"round(min(mhtcet_score) FILTER (WHERE cap_round_num = {n}), 4) AS cap{n}_cutoff" for n in range(1, 5)
    )


def _tops(rounds):
    return ", ".join(
        f"round(max(mhtcet_score) FILTER (WHERE cap_round_num = {n}), 4) AS cap{n}_max" for n in rounds
    )


def _seats():
    return "count(*) AS total_seats_filled, " + ", ".join(
        f"count(*) FILTER (WHERE cap_round_num = {n}) AS cap{n}_seats" for n in range(1, 5)
    )


GOLD = SILVER + f""",
gold AS (
  SELECT institute_code, institute_name, branch_name, clean_category, seat_gender, is_ews, is_tfws,
         {_cutoffs()}, {_tops(range(1, 5))}, {_seats()},
         string_agg(DISTINCT seat_pool, ',' ORDER BY seat_pool) AS seat_pools_available
  FROM silver WHERE seat_pool NOT IN ('AllIndia', 'Minority', 'Orphan')
  GROUP BY ALL HAVING cap4_cutoff IS NOT NULL
)"""

GOLD_V1 = SILVER_V1 + f""",
gold_v1 AS (
  SELECT institute_code, institute_name, branch_name, clean_category, seat_gender,
         {_cutoffs()}, {_tops((1, 4))}, {_seats()}
  FROM silver_v1 GROUP BY ALL HAVING cap4_cutoff IS NOT NULL
)"""

CATEGORY, BRANCH, GENDER, SCORE = "OBC", "ECONOMY", "M", 85.5

LIKELY = f"""CASE WHEN cap1_cutoff <= {SCORE} THEN 'CAP-I' WHEN cap2_cutoff <= {SCORE} THEN 'CAP-II'
     WHEN cap3_cutoff <= {SCORE} THEN 'CAP-III' WHEN cap4_cutoff <= {SCORE} THEN 'CAP-IV'
     ELSE 'Unlikely' END"""

APP = GOLD + f""",
app AS (
  SELECT institute_name, round(cap1_cutoff, 2) AS cap1_cutoff, round(cap2_cutoff, 2) AS cap2_cutoff,
         round(cap3_cutoff, 2) AS cap3_cutoff, round(cap4_cutoff, 2) AS cap4_cutoff,
         {LIKELY} AS likely_round, total_seats_filled
  FROM gold
  WHERE clean_category = '{CATEGORY}' AND branch_name = '{BRANCH}'
    AND seat_gender IN ('{GENDER}', 'ANY') AND cap4_cutoff <= {SCORE}
)"""


STUDENTS = """,
students AS (
  SELECT application_id || ':' || cap_round || ':' || institute_code || ':' || CAST(merit_no AS VARCHAR) AS student_id,
         clean_category AS category, branch_name AS branch, gender, mhtcet_score AS score FROM silver
)"""

LIKELY_FOR_STUDENT = LIKELY.replace(f"{SCORE}", "score")

# One seat per candidate and round, and the lowest score that any round took per institute and branch.
MOVES = """,
held AS (
  SELECT application_id, cap_round_num, institute_code, branch_name FROM silver WHERE cap_round_num IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY application_id, cap_round_num
    ORDER BY mhtcet_score DESC, institute_code DESC, branch_name DESC NULLS LAST) = 1
),
standings AS (
  SELECT institute_code, branch_name, min(mhtcet_score) AS standing FROM silver GROUP BY ALL
),
placed AS (
  SELECT h.*, s.standing, lag(h.cap_round_num) OVER w AS previous_round, lag(h.institute_code) OVER w AS old_institute,
         lag(h.branch_name) OVER w AS old_branch, lag(s.standing) OVER w AS old_standing,
         lead(h.cap_round_num) OVER w AS later
  FROM held h JOIN standings s ON h.institute_code = s.institute_code AND h.branch_name IS NOT DISTINCT FROM s.branch_name
  WINDOW w AS (PARTITION BY h.application_id ORDER BY h.cap_round_num)
),
moves AS (
  SELECT application_id, cap_round_num, institute_code, branch_name, previous_round,
         CASE WHEN previous_round IS NULL THEN 'first'
              WHEN institute_code = old_institute AND branch_name IS NOT DISTINCT FROM old_branch THEN 'same'
              WHEN standing > old_standing THEN 'better' WHEN standing < old_standing THEN 'worse' ELSE 'level' END AS change,
         later IS NULL AND cap_round_num < (SELECT max(cap_round_num) FROM silver) AS "left"
  FROM placed
)"""


def _display(column):
    return f"coalesce(format('{{:.2f}}', {column}), '—')"


SILVER_COLUMNS = (
    "cap_round, institute_code, institute_name, branch_name, is_ews, is_tfws, sr_no, merit_no, mhtcet_score, "
    "application_id, candidate_name, gender, candidate_category, seat_type, seat_marker, is_vacant, "
    "_validation_warnings, _source_file, clean_category, seat_gender, seat_pool, cap_round_num"
)

COMPLETENESS = (
    ("mhtcet_score", 0, 1, "mhtcet_score IS NULL"),
    ("seat_type", 5, 10, "seat_type IS NULL OR seat_type = ''"),
    ("seat_gender", 0, 1, "seat_gender IS NULL OR seat_gender = ''"),
    ("seat_pool", 0, 1, "seat_pool IS NULL OR seat_pool = ''"),
    ("clean_category", 0, 1, "clean_category IS NULL OR clean_category = ''"),
    ("institute_name", 0, 1, "institute_name IS NULL OR institute_name = ''"),
    ("branch_name", 2, 5, "branch_name IS NULL OR branch_name = ''"),
    ("cap_round_num", 0, 1, "cap_round_num IS NULL"),
)

COMPLETENESS_ROWS = " UNION ALL ".join(
    f"SELECT 'silver' AS layer, 'not_null.{name}' AS rule_name, count(*) AS rows_checked, "
    f"count(*) FILTER (WHERE {test}) AS rows_failed, CAST({warn} AS DOUBLE) AS warn_pct, "
    f"CAST({fail} AS DOUBLE) AS fail_pct FROM silver"
    for name, warn, fail, test in COMPLETENESS
)
RECONCILE_ROW = """SELECT 'bronze_to_silver' AS layer, 'row_count_reconciliation' AS rule_name,
   (SELECT count(*) FROM allot) AS rows_checked,
   (SELECT count(*) FROM allot) - (SELECT count(*) FROM silver) AS rows_failed,
   CAST(16 AS DOUBLE) AS warn_pct, CAST(20 AS DOUBLE) AS fail_pct"""
NONEMPTY_ROW = """SELECT 'gold' AS layer, 'not_empty' AS rule_name, CAST(1 AS BIGINT) AS rows_checked,
   CASE WHEN count(*) > 0 THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS rows_failed,
   CAST(0 AS DOUBLE) AS warn_pct, CAST(0 AS DOUBLE) AS fail_pct FROM gold"""
GRAIN_ROW = """SELECT 'gold' AS layer, 'unique_grain' AS rule_name, (SELECT count(*) FROM gold) AS rows_checked,
   (SELECT count(*) FROM (SELECT 1 FROM gold GROUP BY institute_code, branch_name, clean_category, seat_gender,
      is_ews, is_tfws HAVING count(*) > 1)) AS rows_failed,
   CAST(0 AS DOUBLE) AS warn_pct, CAST(0 AS DOUBLE) AS fail_pct"""
ALL_NULL_ROW = """SELECT 'gold' AS layer, 'not_all_cutoffs_null' AS rule_name, count(*) AS rows_checked,
   count(*) FILTER (WHERE cap1_cutoff IS NULL AND cap2_cutoff IS NULL AND cap3_cutoff IS NULL
                    AND cap4_cutoff IS NULL) AS rows_failed,
   CAST(0 AS DOUBLE) AS warn_pct, CAST(1 AS DOUBLE) AS fail_pct FROM gold"""
WELL_FORMED_ROW = """SELECT 'bronze' AS layer, 'well_formed_rows' AS rule_name, count(*) AS rows_checked,
   CAST(0 AS BIGINT) AS rows_failed, CAST(0 AS DOUBLE) AS warn_pct, CAST(1 AS DOUBLE) AS fail_pct FROM allot"""
RULE_ROWS = " UNION ALL ".join(
    (COMPLETENESS_ROWS, RECONCILE_ROW, NONEMPTY_ROW, GRAIN_ROW, ALL_NULL_ROW, WELL_FORMED_ROW))
GRADED = """graded AS (
  SELECT *, CASE WHEN rows_checked > 0 THEN round(100.0 * rows_failed / rows_checked, 2) ELSE 0.0 END AS pct_failed
  FROM rules
),
metrics AS (
  SELECT layer, rule_name, rows_checked, rows_failed, CAST(pct_failed AS DOUBLE) AS pct_failed,
         CASE WHEN pct_failed > fail_pct THEN 'FAIL' WHEN pct_failed > warn_pct THEN 'WARN' ELSE 'PASS' END AS status
  FROM graded
)"""
METRICS = GOLD + ", rules AS (" + RULE_ROWS + "), " + GRADED

DISTRIBUTION_COLUMNS = ("clean_category", "seat_pool", "seat_gender", "cap_round")

MASKED_COLUMNS = (
    "cap_round, institute_code, branch_name, seat_type, mhtcet_score, "
    "{}"
)


def clean_queries():
    cut = "WITH "
    return {
        "valid_rows": cut + ALLOT + VALID
        + " SELECT cap_round, institute_code, branch_name, application_id, mhtcet_score, candidate_category, seat_type FROM valid",
        "embedded_code": cut + ALLOT + VALID + SEPARATED
        + " SELECT application_id, cap_round, candidate_category, seat_type, seat_marker FROM separated",
        "embedded_code_fixed": cut + ALLOT + VALID + SEPARATED_FIXED
        + " SELECT application_id, cap_round, candidate_category, seat_type, seat_marker FROM separated",
        "clean_category": cut + ALLOT + VALID + SEPARATED + CLEANED
        + " SELECT candidate_category, clean_category, count(*) AS n FROM cleaned GROUP BY ALL",
        "categorise_v1": cut + SILVER_V1
        + " SELECT candidate_category, clean_category, count(*) AS n FROM silver_v1 GROUP BY ALL",
        "marker_trim": ("WITH " + SILVER).replace("CAST(NULL AS VARCHAR) AS seat_marker", """
           CASE l_linenumber % 3 WHEN 0 THEN ' ^ ' WHEN 1 THEN '' END AS seat_marker""") + """
          SELECT seat_marker, seat_type, count(*) AS n FROM silver GROUP BY ALL""",
        "seat_gender_pool": cut + SILVER
        + " SELECT seat_type, seat_gender, seat_pool, count(*) AS n FROM silver GROUP BY ALL",
        "seat_gender_v1": cut + SILVER_V1
        + " SELECT seat_type, seat_gender, count(*) AS n FROM silver_v1 GROUP BY ALL",
        "silver_full": cut + SILVER + f" SELECT {SILVER_COLUMNS} FROM silver",
    }


def mart_queries():
    cut = "WITH "
    return {
        "predict_colleges": cut + GOLD + f"""
          SELECT institute_name, branch_name, clean_category, cap1_cutoff, cap2_cutoff, cap3_cutoff, cap4_cutoff,
                 {LIKELY} AS likely_round, round({SCORE} - cap1_cutoff, 2) AS score_gap, total_seats_filled
          FROM gold WHERE clean_category = '{CATEGORY}' AND branch_name = '{BRANCH}'
            AND seat_gender IN ('{GENDER}', 'ANY') AND cap4_cutoff <= {SCORE}
          ORDER BY cap1_cutoff DESC NULLS LAST, institute_name""",
        "predict_v1": cut + GOLD_V1 + f"""
          SELECT institute_name, branch_name, clean_category, cap1_cutoff, cap2_cutoff, cap3_cutoff, cap4_cutoff,
                 {LIKELY} AS likely_round, total_seats_filled
          FROM gold_v1 WHERE clean_category = '{CATEGORY}' AND branch_name = '{BRANCH}'
            AND seat_gender = '{GENDER}' AND cap4_cutoff <= {SCORE}""",
        "outlook_all": cut + GOLD + f"""
          SELECT institute_code, branch_name, clean_category, seat_gender, is_ews, is_tfws,
                 {LIKELY} AS likely_round, round({SCORE} - cap1_cutoff, 2) AS score_gap FROM gold""",
        "app_results": cut + APP + " SELECT * FROM app",
        "display_results": cut + APP + f"""
          SELECT institute_name AS "College", {_display('cap1_cutoff')} AS "CAP-I Cutoff",
                 {_display('cap2_cutoff')} AS "CAP-II Cutoff", {_display('cap3_cutoff')} AS "CAP-III Cutoff",
                 {_display('cap4_cutoff')} AS "CAP-IV Cutoff",
                 CASE likely_round WHEN 'CAP-I' THEN '🟢 CAP-I' WHEN 'CAP-II' THEN '🟡 CAP-II'
                      WHEN 'CAP-III' THEN '🟠 CAP-III' WHEN 'CAP-IV' THEN '🔴 CAP-IV'
                      WHEN 'Unlikely' THEN '⚫ Unlikely' END AS "Likely Round",
                 total_seats_filled AS "Seats Filled" FROM app""",
        "lookup_batch": "WITH " + GOLD + STUDENTS + f""",
          reached AS (
            SELECT student_id, cap1_cutoff, {LIKELY_FOR_STUDENT} AS likely_round, round(score - cap1_cutoff, 2) AS score_gap
            FROM students JOIN gold ON category = clean_category AND branch = branch_name
             AND (seat_gender = gender OR seat_gender = 'ANY') AND cap4_cutoff <= score
          )
          SELECT student_id, count(*) AS colleges_found, count(*) FILTER (WHERE likely_round = 'CAP-I') AS likely_cap1,
                 count(*) FILTER (WHERE likely_round = 'CAP-II') AS likely_cap2,
                 count(*) FILTER (WHERE likely_round IN ('CAP-III', 'CAP-IV')) AS likely_cap3_or_4,
                 max(cap1_cutoff) AS highest_cutoff, min(abs(score_gap)) AS least_gap
          FROM reached GROUP BY student_id""",
        "candidate_moves": "WITH " + SILVER + MOVES + " SELECT * FROM moves",
        "candidate_move_totals": "WITH " + SILVER + MOVES + """
          SELECT cap_round_num, previous_round, change, count(*) AS candidates, count(*) FILTER (WHERE "left") AS "left"
          FROM moves GROUP BY ALL""",
        "result_metrics": cut + APP + """
          SELECT count(*) AS colleges_found, count(*) FILTER (WHERE likely_round = 'CAP-I') AS likely_cap1,
                 count(*) FILTER (WHERE likely_round = 'CAP-II') AS likely_cap2,
                 count(*) FILTER (WHERE likely_round IN ('CAP-III', 'CAP-IV')) AS likely_cap3_or_4 FROM app""",
        "mart_main": cut + GOLD + " SELECT * FROM gold",
        "mart_by_pool": cut + SILVER + f"""
          SELECT institute_code, institute_name, branch_name, clean_category, seat_gender, seat_pool,
                 {_cutoffs()}, count(*) AS total_seats_filled
          FROM silver GROUP BY ALL HAVING cap4_cutoff IS NOT NULL""",
        "mart_v1": cut + GOLD_V1 + " SELECT * FROM gold_v1",
        "distributions": cut + SILVER + " " + " UNION ALL ".join(
            f"SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value, count(*) AS \"count\" FROM silver GROUP BY ALL"
            for c in DISTRIBUTION_COLUMNS
        ),
        "pool_gender_distribution": cut + SILVER
        + ' SELECT seat_pool, seat_gender, count(*) AS "count" FROM silver GROUP BY ALL',
        "rows_per_round": cut + SILVER
        + ' SELECT cap_round, cap_round_num, count(*) AS "count" FROM silver GROUP BY ALL',
        "score_range": cut + SILVER
        + " SELECT min(mhtcet_score) AS min_score, max(mhtcet_score) AS max_score FROM silver",
        "verify_layer": cut + SILVER + """
          SELECT cap_round, cap_round_num, seat_pool, seat_gender, clean_category, count(*) AS rows,
                 round(min(mhtcet_score), 2) AS min_score, round(max(mhtcet_score), 2) AS max_score
          FROM silver GROUP BY cap_round, cap_round_num, seat_pool, seat_gender, clean_category""",
        "verify_layer_v1": cut + SILVER_V1 + """
          SELECT cap_round, cap_round_num, seat_gender, clean_category, count(*) AS rows,
                 round(min(mhtcet_score), 2) AS min_score, round(max(mhtcet_score), 2) AS max_score
          FROM silver_v1 GROUP BY cap_round, cap_round_num, seat_gender, clean_category""",
        "ingest_verify": cut + ALLOT
        + " SELECT cap_round, count(*) AS rows, count(DISTINCT _source_file) AS files FROM allot GROUP BY cap_round",
        "baseline_compare": cut + ALLOT + """
          SELECT count(*) AS rows, CAST(735136 AS BIGINT) AS expected_rows, count(*) = 735136 AS rows_match,
                 count(DISTINCT _source_file) AS files, CAST(1480 AS BIGINT) AS expected_files,
                 count(DISTINCT _source_file) = 1480 AS files_match FROM allot""",
        "filter_values": cut + GOLD + """
          SELECT 'branch_name' AS field, branch_name AS value, count(*) AS rows FROM gold GROUP BY ALL
          UNION ALL
          SELECT 'clean_category', clean_category, count(*) FROM gold GROUP BY ALL""",
        "warning_summary": cut + SILVER + """
          SELECT _validation_warnings, count(*) AS "count" FROM silver WHERE _validation_warnings <> ''
          GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "warned_total": cut + ALLOT + """
          SELECT count(*) AS rows, count(*) FILTER (WHERE coalesce(_validation_warnings, '') <> '') AS flagged_rows FROM allot""",
        "cast_drops": cut + ALLOT + r"""
          , scored AS (SELECT is_ews, mhtcet_score FROM allot WHERE NOT is_vacant AND regexp_matches(application_id, '^EN\d{8}$'))
          SELECT count(*) AS valid_rows, count(*) FILTER (WHERE is_ews OR mhtcet_score IS NOT NULL) AS with_score,
                 count(*) FILTER (WHERE NOT is_ews AND mhtcet_score IS NOT NULL) AS readable_rows,
                 count(*) FILTER (WHERE is_ews) AS dropped_after_cast FROM scored""",
        "load_stamp": cut + SILVER + """
          SELECT cap_round, count(*) AS rows, count(*) AS stamped_rows FROM silver GROUP BY cap_round""",
        "warning_flags": cut + ALLOT + """
          SELECT flag, count(*) AS "count"
          FROM (SELECT unnest(string_split(_validation_warnings, '|')) AS flag FROM allot)
          WHERE flag <> '' GROUP BY 1""",
        "step_counts": cut + ALLOT + r"""
          , flagged AS (SELECT coalesce(NOT is_vacant AND regexp_matches(application_id, '^EN\d{8}$'), false) AS ok,
                               mhtcet_score IS NOT NULL AS scored FROM allot)
          SELECT count(*) AS raw_rows, count(*) FILTER (WHERE ok) AS valid_rows,
                 count(*) FILTER (WHERE ok AND scored) AS scored_rows,
                 count(*) - count(*) FILTER (WHERE ok AND scored) AS removed_rows FROM flagged""",
        "seat_counts": cut + SILVER + """
          SELECT count(*) FILTER (WHERE seat_type IS NULL) AS missing_seat_type,
                 count(seat_type) AS with_seat_type FROM silver""",
    }


def quality_queries():
    cut = "WITH "
    return {
        "dq_completeness": cut + SILVER + " " + COMPLETENESS_ROWS,
        "dq_grading": cut + SILVER + ", rules AS (" + COMPLETENESS_ROWS + "), " + GRADED + """
          SELECT *, CASE WHEN pct_failed = 0 THEN '✅' WHEN pct_failed < 1 THEN '⚠️' ELSE '❌' END AS icon FROM metrics""",
        "dq_reconcile": cut + SILVER + f""" , r AS ({RECONCILE_ROW})
          SELECT *, format('{{:,}}', rows_failed) || ' of ' || format('{{:,}}', rows_checked) || ' raw rows left out ('
            || format('{{:.2f}}', round(100.0 * rows_failed / rows_checked, 2)) || ' %), '
            || format('{{:,}}', rows_checked - rows_failed) || ' cleaned' AS notes FROM r""",
        "dq_report_v1": cut + SILVER_V1 + ", counted AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL{empty}) AS missing, count(*) AS n FROM silver_v1"
            for c, empty in (("mhtcet_score", ""), *((t, f" OR {t} = ''") for t in (
                "gender", "seat_type", "clean_category", "institute_name", "branch_name")))) + """)
          SELECT field, missing, round(100.0 * missing / n, 2) AS pct, CASE missing WHEN 0 THEN '✅' ELSE '⚠️' END AS icon
          FROM counted""",
        "dq_trend_limit": cut + METRICS + """
          SELECT run, layer, rule_name, rows_checked, rows_failed, pct_failed, status
          FROM metrics, range(1, 6) AS runs(run) ORDER BY run DESC, layer, rule_name LIMIT 50""",
        "dq_nonempty": cut + GOLD + " " + NONEMPTY_ROW,
        "dq_unique_grain": cut + GOLD + " " + GRAIN_ROW,
        "dq_all_null": cut + GOLD + " " + ALL_NULL_ROW,
        "dq_metrics": cut + METRICS + " SELECT * FROM metrics",
        "dq_tally": cut + METRICS + " SELECT status, count(*) AS rules FROM metrics GROUP BY 1",
        "dq_trend": cut + METRICS + """
          SELECT run, layer, rule_name, rows_checked, rows_failed, pct_failed, status
          FROM metrics, (VALUES ('first'), ('second')) AS runs(run)
          ORDER BY run DESC, layer, rule_name LIMIT 50""",
    }


def privacy_queries():
    columns = "cap_round, institute_code, branch_name, mhtcet_score"
    hidden = "'***' AS candidate_name, '***' AS application_id, '***' AS gender"
    cut = "WITH " + SILVER
    return {
        "mask_reader": cut + f" SELECT {columns}, {hidden} FROM silver",
        "mask_admin": cut + f" SELECT {columns}, candidate_name, application_id, gender FROM silver",
        "mask_function": cut + f" SELECT {columns}, {hidden} FROM silver",
        "mask_sample": cut + f""" SELECT {hidden}, seat_gender, mhtcet_score, institute_name FROM silver
          ORDER BY institute_name, mhtcet_score, seat_gender LIMIT 10""",
        "leak_check": "WITH " + GOLD + """
          SELECT 'main_mart' AS output, 0 AS leaked_columns, CAST(0 AS BIGINT) AS leaked_rows, count(*) AS rows FROM gold
          UNION ALL SELECT 'silver', 3, count(*), count(*) FROM silver""",
    }


RENDERED = ALLOT + r""",
placed AS (
  SELECT *, cap_round || '/' || institute_code || '.txt' AS file, coalesce(branch_name, '') AS block,
         CASE WHEN branch_name IS NULL THEN 0 WHEN is_ews THEN 1 WHEN is_tfws THEN 2 ELSE 0 END AS flag
  FROM allot
),
blocks AS (
  SELECT DISTINCT file, institute_name, block, flag FROM placed
  UNION SELECT DISTINCT file, institute_name, '', 0 FROM placed
),
headed AS (
  SELECT file, block, flag,
    CASE WHEN block = '' THEN 'Government' WHEN flag = 1 THEN 'Un-Aided' WHEN flag = 0 THEN 'Government Autonomous' END AS st,
    CASE WHEN block = '' THEN 'University of ' || institute_name WHEN flag = 1 THEN ''
         WHEN flag = 0 THEN 'Example University' END AS hu,
    CASE WHEN block = '' THEN 4 WHEN flag = 1 THEN 2 END AS ai
  FROM blocks
),
context AS (
  SELECT file, block, flag,
         last_value(st IGNORE NULLS) OVER w AS institute_status,
         last_value(hu IGNORE NULLS) OVER w AS home_university,
         last_value(ai IGNORE NULLS) OVER w AS ai_seats
  FROM headed
  WINDOW w AS (PARTITION BY file ORDER BY block, flag ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
read_lines AS (
  SELECT p.*, institute_status, home_university, ai_seats,
         CASE WHEN NOT is_vacant AND candidate_category = 'TFWS' AND seat_type IS NULL THEN 'TFWS'
              ELSE coalesce(seat_type, '') END AS seat,
         CASE WHEN candidate_category = 'TFWS' AND seat_type IS NULL THEN '' ELSE coalesce(candidate_category, '') END AS category
  FROM placed p JOIN context c ON p.file = c.file AND p.block = c.block AND p.flag = c.flag
  WHERE is_vacant OR application_id LIKE 'EN%'
),
parsed AS (
  SELECT file, cap_round, institute_code, institute_name,
    CASE WHEN block = '' THEN '' ELSE institute_code || lpad(CAST(ascii(block) * 100 + length(block) AS VARCHAR), 5, '0') END AS branch_code,
    block AS branch_name, flag = 1 AS is_ews, flag = 2 AS is_tfws, institute_status, home_university,
    CAST(institute_code AS INTEGER) + 60 AS sanction_intake, CAST(institute_code AS INTEGER) + 50 AS cap_seats,
    50 AS ms_seats, 3 AS minority_seats, ai_seats, sr_no,
    CASE WHEN NOT is_vacant THEN merit_no END AS merit_no,
    CASE WHEN NOT is_vacant THEN mhtcet_score END AS mhtcet_score,
    application_id,
    CASE WHEN is_vacant THEN 'VACANT' WHEN gender IS NULL THEN trim(candidate_name || ' ' || category)
         ELSE candidate_name END AS candidate_name,
    CASE WHEN is_vacant THEN '' ELSE coalesce(gender, '') END AS gender,
    CASE WHEN is_vacant OR gender IS NULL THEN '' ELSE category END AS candidate_category,
    seat AS seat_type,
    CASE WHEN is_vacant AND seat_type IS NOT NULL THEN '^' ELSE '' END AS seat_marker,
    is_vacant,
    CASE WHEN is_vacant THEN '' ELSE concat_ws('|', CASE WHEN mhtcet_score IS NULL THEN 'missing_score' END,
      CASE WHEN gender IS NULL THEN 'missing_gender' END,
      CASE WHEN seat = '' THEN 'missing_seat_type' END) END AS _validation_warnings
  FROM read_lines
)"""

CONTEXT_COLUMNS = (
    "file, institute_code, institute_name, branch_code, branch_name, is_ews, is_tfws, institute_status, "
    "home_university, sanction_intake, cap_seats, ms_seats, minority_seats, ai_seats"
)

BOILERPLATE = "|".join(f"(?:{pattern})" for pattern in (
    r"^Government of Maharashtra", r"^State Common Entrance Test Cell", r"Provisional Allotment List",
    r"Degree Courses", r"Integrated 5 Years", r"^(P\s+)?Meri\s+Sr\.", r"^No\.\s+No\.", r"^State Level Seats",
    r"^All India Seats", r"Legends for SeatType", r"Legends for ChoiceCode", r"^Seat Type\s*:",
    r"Red Color|Black Color|Green Color|Blue Color|Gray Color", r"^MI-Minority", r"^PWDR\s*:", r"^DEFR\s*:",
    r"^Merit No\s*:", r"^Page \d+ of \d+", r"^Master of Engineering", r"for the Year 20", r"for the Admission",
))

TEXT_LINES = rf""",
text_lines AS (
  SELECT doc_id, source, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)) AS line
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw FROM documents)
),
content AS (SELECT * FROM text_lines WHERE line <> '' AND NOT regexp_matches(line, '{BOILERPLATE}'))"""

OUTCOMES = RENDERED + TEXT_LINES + r""",
outcome_rows AS (
  SELECT file, cap_round AS round, count(*) AS n, count(*) FILTER (WHERE _validation_warnings <> '') AS w
  FROM parsed GROUP BY ALL
  UNION ALL
  SELECT 'text/' || CAST(doc_id AS VARCHAR), source,
         count(*) FILTER (WHERE regexp_matches(line, 'EN\d{8}') OR contains(line, 'VACANT')),
         count(*) FILTER (WHERE regexp_matches(line, 'EN\d{8}') AND NOT contains(line, 'VACANT'))
  FROM content GROUP BY ALL
),
files AS (
  SELECT DISTINCT cap_round || '/' || institute_code || '.txt' AS file, cap_round AS round FROM allot
  UNION ALL SELECT 'text/' || CAST(doc_id AS VARCHAR), source FROM documents
),
outcomes AS (
  SELECT f.file, f.round, CAST(coalesce(n, 0) AS INTEGER) AS rows,
         CASE WHEN coalesce(n, 0) > 0 THEN CAST(w AS INTEGER) END AS warnings,
         CASE WHEN coalesce(n, 0) > 0 THEN 'ok' ELSE 'failed' END AS status
  FROM files f LEFT JOIN outcome_rows o ON f.file = o.file AND f.round = o.round
)"""

# The converter's own log over rendered lists, one document each, and the texts, one document per source.
CONVERTED = RENDERED + r""",
converted AS (
  SELECT 'round=' || cap_round || '/' || institute_code AS document, 'round=' || cap_round AS round, 'ok' AS status,
         CAST(count(*) AS INTEGER) AS rows, CAST(count(*) FILTER (WHERE _validation_warnings <> '') AS INTEGER) AS warnings
  FROM parsed GROUP BY cap_round, institute_code
  UNION ALL SELECT 'round=texts/' || source, 'round=texts', 'failed', 0, NULL FROM documents GROUP BY source
)"""

LOG = r"""
log AS (
  SELECT CASE WHEN n_chars >= 300 THEN 'ok' ELSE 'failed' END AS status,
         CAST(doc_id AS VARCHAR) || '.txt' AS file, source AS round,
         CASE WHEN n_chars >= 300 THEN CAST(n_chars // 50 AS INTEGER) ELSE 0 END AS rows,
         CASE WHEN n_chars >= 300 THEN CAST(n_chars % 7 AS INTEGER) END AS warnings,
         CASE WHEN n_chars >= 300 THEN CASE WHEN lang = 'en' THEN 'primary' ELSE 'fallback' END END AS method,
         n_chars / 1000.0 AS elapsed_s,
         CASE WHEN lang = 'en' THEN '2025-07-02' ELSE '2025-07-01' END AS ts,
         CASE WHEN n_chars < 300 THEN 'parser returned 0 rows' END AS error
  FROM documents
)"""


def _layer_counts(after, where):
    """Rows of each published layer over a part of the raw rows."""
    part = f"(SELECT * FROM silver WHERE {where})"
    mart = "SELECT 1 FROM {} GROUP BY {} HAVING min(CASE WHEN cap_round_num = 4 THEN mhtcet_score END) IS NOT NULL"
    main = "institute_code, institute_name, branch_name, clean_category, seat_gender, is_ews, is_tfws"
    pool = "institute_code, institute_name, branch_name, clean_category, seat_gender, seat_pool"
    open_pools = f"(SELECT * FROM {part} WHERE seat_pool NOT IN ('AllIndia', 'Minority', 'Orphan'))"
    counts = {
        "bronze": f"SELECT 1 FROM allot WHERE {where}", "silver": f"SELECT 1 FROM {part}",
        "facts": f"SELECT DISTINCT {main}, seat_pool, cap_round_num FROM {part}",
        "gold_main": mart.format(open_pools, main), "gold_pool": mart.format(part, pool),
    }
    return " UNION ALL ".join(
        f"SELECT '{after}' AS after, '{layer}' AS layer, count(*) AS rows FROM ({rows})" for layer, rows in counts.items())


def file_queries():
    cut = "WITH "
    first = "(cap_round <> 'CAP-IV' OR institute_code < '00010')"
    whole = _layer_counts("", "true").replace("SELECT '' AS after, ", "SELECT ")
    return {
        "delete_touched_rounds": cut + ALLOT + """
          SELECT cap_round, count(*) AS rows, count(DISTINCT _source_file) AS files, cap_round = 'CAP-II' AS rewritten FROM allot
          WHERE _source_file NOT LIKE 'CAP-II/00003%' AND _source_file NOT LIKE 'CAP-V/%' GROUP BY cap_round""",
        "published_layers": cut + SILVER + " " + " UNION ALL ".join(
            [_layer_counts("run-1", first), _layer_counts("broken", first), _layer_counts("run-2", "true")]),
        "pipeline_tables": cut + SILVER + f""", layers AS ({whole})
          SELECT CASE WHEN layer IN ('bronze', 'facts') THEN 'own' ELSE 'open' END AS space, layer, rows,
                 CASE layer WHEN 'bronze' THEN rows WHEN 'silver' THEN 0 END AS unmasked FROM layers
          UNION ALL SELECT 'open', 'dq_metrics', 13, NULL""",
        "csv_roundtrip": cut + ALLOT + """
          SELECT cap_round, institute_code, institute_name, branch_name, is_ews, is_tfws, sr_no, merit_no, mhtcet_score,
                 application_id, candidate_name, gender, candidate_category, seat_type, is_vacant FROM allot""",
        "provenance": cut + ALLOT + """
          SELECT cap_round, count(*) AS rows, CAST(1 AS BIGINT) AS batches, count(*) AS stamped_rows,
                 true AS all_files_read FROM allot GROUP BY cap_round""",
        "overwrite_twice": cut + ALLOT + """
          SELECT cap_round, count(*) AS rows, round(sum(mhtcet_score), 2) AS total_score, true AS has_new_column
          FROM allot GROUP BY cap_round""",
        "json_metadata": cut + GOLD + """
          SELECT DISTINCT 'branch' AS field, branch_name AS value FROM gold WHERE branch_name IS NOT NULL
          UNION ALL
          SELECT DISTINCT 'category', clean_category FROM gold WHERE clean_category IS NOT NULL""",
        "csv_export": cut + APP + " SELECT * FROM app",
        "partitioned_csv": cut + ALLOT
        + " SELECT cap_round AS folder, count(*) AS rows, count(*) AS rows_of_round FROM allot GROUP BY cap_round",
        "json_log": cut + LOG + " SELECT * FROM log",
        "run_ledger": cut + SILVER + """
          SELECT layer, CAST(version AS BIGINT) AS version, 'overwrite' AS operation, rows,
                 CASE version WHEN 0 THEN 'run-1' ELSE 'run-2' END AS run_id
          FROM (SELECT 'bronze' AS layer, count(*) AS rows FROM allot
                UNION ALL SELECT 'silver', count(*) FROM silver), (VALUES (0), (1)) AS v(version)""",
        "delete_by_file": cut + ALLOT + """
          SELECT _source_file, count(*) AS rows FROM allot WHERE _source_file NOT LIKE '%/00003.csv' GROUP BY 1""",
        "incremental_three_runs": """
          SELECT 'run-1' AS run, count(*) FILTER (WHERE event_type IS DISTINCT FROM 'error') AS new_rows,
                 true AS took_all_new_files FROM events
          UNION ALL SELECT 'run-2', CAST(0 AS BIGINT), true
          UNION ALL SELECT 'run-3', count(*) FILTER (WHERE event_type = 'error'), true FROM events""",
        "schema_widening": """
          SELECT event_type, count(*) AS rows,
                 count(user_id) FILTER (WHERE event_type = 'error') AS rows_with_user,
                 CAST(0 AS BIGINT) AS malformed, 1 AS schema_version
          FROM events GROUP BY event_type""",
        "incremental_reordered_columns": """
          SELECT event_type, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids, CAST(sum(user_id) AS BIGINT) AS users,
                 count(value) AS "values", CAST(0 AS BIGINT) AS malformed FROM events GROUP BY event_type""",
        "schema_discovered": """
          SELECT event_type, count(*) AS rows, CAST(sum(user_id) FILTER (WHERE event_type = 'error') AS BIGINT) AS users,
                 CAST(0 AS BIGINT) AS malformed, 1 AS schema_version FROM events GROUP BY event_type""",
        "schema_widened_types": """
          SELECT event_type, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids,
                 round(sum(CASE WHEN event_type = 'error' THEN value ELSE floor(value) END), 2) AS total,
                 CAST(0 AS BIGINT) AS malformed, 'struct<event_id:bigint,event_type:string,value:double>' AS types,
                 1 AS schema_version FROM events GROUP BY event_type""",
        "ingest_rejects": """
          SELECT 'loaded' AS outcome, event_type AS what, 'run-1' AS _batch_id, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids
          FROM events WHERE coalesce(event_type, '') NOT IN ('error', 'view') GROUP BY event_type
          UNION ALL SELECT 'rejected', CASE event_type WHEN 'error' THEN 'no known column' ELSE 'repeated column name' END, 'run-1',
                 count(*), CAST(sum(event_id) AS BIGINT) FROM events WHERE event_type IN ('error', 'view') GROUP BY event_type""",
        "delete_streamed_file": """
          SELECT event_type, 'run-1' AS _batch_id, count(*) AS rows FROM events
          WHERE event_type IS DISTINCT FROM 'error' GROUP BY event_type""",
        "run_rows": cut + ALLOT
        + " SELECT 'batch-2' AS _batch_id, cap_round, count(*) AS rows FROM allot GROUP BY cap_round",
    }


def document_queries():
    cut = "WITH "
    return {
        "line_explode": cut + TEXT_LINES.lstrip(",") + """
          SELECT 'text/' || CAST(doc_id AS VARCHAR) AS file, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars
          FROM content GROUP BY doc_id""",
        "document_listing": """
          SELECT source AS cap_round, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars, true AS all_files_read
          FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY source""",
        "headers_ffill": cut + RENDERED
        + f" SELECT {CONTEXT_COLUMNS}, count(*) AS candidates FROM parsed GROUP BY ALL",
        "parse_documents": cut + RENDERED + " SELECT * FROM parsed",
        "convert_tree": cut + RENDERED + """
          SELECT cap_round, 2 * count(*) AS rows, 2 * count(mhtcet_score) AS scored, CAST(2 AS BIGINT) AS documents,
                 CAST(2 AS BIGINT) AS timed, 2 * count(*) AS logged_rows, 100.0 AS pct
          FROM parsed GROUP BY cap_round""",
        "convert_pending_only": cut + RENDERED + """
          SELECT CASE cap_round WHEN 'CAP-II' THEN 2 ELSE 1 END AS run, cap_round, CAST(2 AS BIGINT) AS documents,
                 2 * count(*) AS rows, CAST(2 AS BIGINT) AS staged FROM parsed GROUP BY cap_round""",
        "convert_retry": cut + RENDERED + """
          SELECT cap_round, 2 * count(*) AS rows, CAST(NULL AS BIGINT) AS recovered, CAST(NULL AS BIGINT) AS still_failing
          FROM parsed GROUP BY cap_round UNION ALL SELECT NULL, NULL, 2, 0""",
        "convert_tree_ordered": cut + RENDERED + """
          SELECT cap_round, institute_code, year, count(*) AS rows, md5(string_agg(
                   branch_name || ':' || CAST(is_ews AS VARCHAR) || ':' || CAST(is_tfws AS VARCHAR), chr(10)
                   ORDER BY branch_name, CASE WHEN is_ews THEN 1 WHEN is_tfws THEN 2 ELSE 0 END)) AS in_order
          FROM parsed, (VALUES ('2024'), ('2025')) AS years(year) GROUP BY cap_round, institute_code, year""",
        "marked_lines": cut + ALLOT + """
          SELECT seat_type, '^' AS seat_marker, candidate_category, CASE WHEN merit_no % 11 = 0 THEN 'missing_name' ELSE '' END
                   AS _validation_warnings, count(*) AS rows,
                 count(*) FILTER (WHERE merit_no % 11 <> 0) AS named, CAST(sum(merit_no) AS BIGINT) AS merits
          FROM allot WHERE NOT is_vacant AND gender IS NOT NULL AND seat_type IS NOT NULL AND mhtcet_score IS NOT NULL
            AND application_id LIKE 'EN%' GROUP BY ALL""",
        "converter_log_summary": cut + CONVERTED + """
          SELECT round, status, count(*) AS files, CAST(sum(rows) AS BIGINT) AS total_rows, round(avg(rows), 2) AS avg_rows,
                 count(*) AS timed FROM converted GROUP BY round, status""",
        "converter_top_warned": cut + CONVERTED + """
          SELECT document, round, rows, warnings FROM converted WHERE status = 'ok' AND warnings > 0
          ORDER BY warnings DESC, document LIMIT 20""",
        "converter_failed": cut + CONVERTED + """
          SELECT document, round, 'parser returned 0 rows' AS error FROM converted WHERE status = 'failed'""",
        "row_flags": cut + RENDERED
        + " SELECT _validation_warnings, is_vacant, count(*) AS rows FROM parsed GROUP BY ALL",
        "coerce_types": cut + ALLOT + """
          SELECT application_id, sr_no, CASE WHEN candidate_category IS NULL THEN merit_no END AS merit_no,
                 CASE WHEN NOT is_ews THEN mhtcet_score END AS mhtcet_score, is_vacant FROM allot""",
        "file_outcomes": cut + OUTCOMES + """
          SELECT status, file, round, rows, warnings, CASE WHEN status = 'ok' THEN 'text' END AS method,
                 CASE WHEN status = 'failed' THEN 'parser returned 0 rows' END AS error FROM outcomes""",
        "resume_pending": """
          SELECT CAST(doc_id AS VARCHAR) || '.txt' AS file, source AS cap_round FROM documents
          WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "retry_queue": cut + LOG + """
          SELECT file, round, ts FROM log
          WHERE status = 'failed' AND ts = (SELECT max(ts) FROM log)
            AND file IN (SELECT CAST(doc_id AS VARCHAR) || '.txt' FROM labels)""",
        "retry_outcome": cut + OUTCOMES + """
          SELECT count(*) FILTER (WHERE status = 'ok') AS recovered,
                 count(*) FILTER (WHERE status <> 'ok') AS still_failing
          FROM outcomes WHERE status = 'failed' OR round = 'CAP-II'""",
        "conversion_report": cut + LOG + """
          SELECT round, status, count(file) AS files, CAST(sum(rows) AS BIGINT) AS total_rows,
                 round(avg(rows), 2) AS avg_rows, round(avg(elapsed_s), 2) AS avg_time_s FROM log GROUP BY round, status""",
        "method_frequency": cut + LOG + """
          SELECT method, count(*) AS "count" FROM log WHERE status = 'ok' AND method IS NOT NULL GROUP BY method""",
        "top_warned": cut + LOG + """
          SELECT file, round, rows, warnings FROM log WHERE status = 'ok' AND warnings > 0
          ORDER BY warnings DESC, file LIMIT 20""",
        "failed_files": cut + LOG + " SELECT file, round, error FROM log WHERE status = 'failed'",
        "conversion_totals": cut + LOG + """
          SELECT count(*) AS files, count(*) FILTER (WHERE status = 'ok') AS succeeded,
                 count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(rows) AS BIGINT) AS total_rows,
                 round(avg(elapsed_s), 2) AS avg_time_s, round(sum(elapsed_s) / 60, 1) AS total_time_min FROM log""",
        "coverage": """
          SELECT source AS cap_round, count(l.doc_id) AS outputs, count(*) AS inputs,
                 round(count(l.doc_id) / count(*) * 100, 1) AS pct
          FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY source""",
        "parse_profile": cut + RENDERED + """
          SELECT file, count(*) AS rows, count(*) FILTER (WHERE is_vacant) AS vacant,
                 count(*) FILTER (WHERE NOT is_vacant AND seat_type = '') AS no_seat,
                 coalesce(string_agg(DISTINCT seat_marker, ',' ORDER BY seat_marker) FILTER (WHERE seat_marker <> ''), '') AS markers,
                 count(*) > 0 AND count(*) FILTER (WHERE NOT is_vacant AND seat_type = '') < 10 AS looks_ok
          FROM parsed GROUP BY file""",
    }


def all_sql():
    return {
        **clean_queries(), **mart_queries(), **quality_queries(), **privacy_queries(),
        **file_queries(), **document_queries(),
    }
