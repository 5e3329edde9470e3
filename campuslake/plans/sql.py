"""The same inputs and queries as SQL, for checking results."""

from __future__ import annotations

from ..operators.cost import LIVING_TIERS, TUITION_TIERS
from ..operators.gpa import SCALES
from ..operators.matching import SHORTLIST
from ..operators.replay import COST_FORM, TIMELINE_FORM
from ..sources import catalogs as cat
from . import inputs as i


def pick(options: list, index: str) -> str:
    return f"({cat.literal(list(options))})[CAST({index} AS INT) + 1]"


TRANSCRIPTS = "transcripts AS (SELECT l_orderkey AS student_id, (CAST(l_quantity AS INT) % 9) / 2.0::DOUBLE AS credits, CAST((l_partkey * 7 + l_linenumber * 13) % 106 AS DOUBLE) AS score FROM lineitem)"
_GPA = "((o_orderkey * 37) % 430 - 10) / 100.0::DOUBLE"
APPLICANTS = f"""applicants AS (SELECT o_orderkey AS applicant_id,
  CASE WHEN o_orderkey % 50 = 0 THEN '' WHEN o_orderkey % 50 = 1 THEN 'abc' WHEN o_orderkey % 50 = 2 THEN CAST({_GPA} AS VARCHAR) || 'abc' ELSE CAST({_GPA} AS VARCHAR) END AS gpa_text,
  {pick(i.BG_CODES, "o_custkey % 21")} AS school_bg, o_orderkey % 8 AS mask, o_orderkey % 6 AS n_highlights FROM orders),
validated AS (SELECT *, CASE WHEN o % 50 IN (0, 1) THEN NULL ELSE g END AS gpa,
  CASE WHEN o % 50 = 0 THEN 'required' WHEN o % 50 = 1 OR g < 0 OR g > 4.0 THEN 'range' END AS gpa_error
  FROM (SELECT *, applicant_id AS o, ((applicant_id * 37) % 430 - 10) / 100.0::DOUBLE AS g FROM applicants))"""
MATCHES = f"""{cat.values("bg", "bg_code, gpa_adj", cat.BACKGROUNDS)},
{cat.values("schools", "pos, school_id, country, ranking, req_gpa", [(r[0], r[1], r[4], r[5], r[6]) for r in cat.school_rows()])},
pairs AS (SELECT applicant_id, pos, school_id, country, ranking, req_gpa, (gpa + coalesce(gpa_adj, 0::DOUBLE)) - req_gpa AS diff,
  -0.4::DOUBLE - least(n_highlights * 0.05::DOUBLE, 0.15::DOUBLE) AS lower
  FROM validated LEFT JOIN bg ON bg_code = school_bg, schools
  WHERE gpa_error IS NULL AND (mask = 0 OR (country = 'US' AND mask % 2 = 1) OR (country = 'UK' AND mask // 2 % 2 = 1) OR (country = 'HK' AND mask // 4 % 2 = 1))),
matches AS (SELECT applicant_id, pos, school_id, country, ranking, req_gpa,
  CASE WHEN diff >= 0.2::DOUBLE THEN 'safety' WHEN diff >= -0.15::DOUBLE THEN 'match' ELSE 'reach' END AS match_level, diff AS match_score
  FROM pairs WHERE diff >= -0.15::DOUBLE OR diff >= lower),
ranked AS (SELECT *, row_number() OVER (PARTITION BY applicant_id, match_level ORDER BY CASE WHEN match_level = 'match' THEN abs(match_score) ELSE -req_gpa END, pos) AS rn FROM matches)"""


def _points(bands: list) -> str:
    return "CASE " + " ".join(f"WHEN score >= {float(b)}::DOUBLE THEN {p}" for b, p in bands) + " ELSE 0 END"


_OK = "credits > 0 AND score > 0"
_BANDS = cat.values("bands", "scale_id, scale_name, max_gpa_x10, lower_bound, points_x10", cat.band_rows())
GPA = (
    "sums AS (SELECT student_id, CAST(sum(CASE WHEN " + _OK + " THEN CAST(round(credits * 1000000) AS BIGINT) ELSE 0 END) AS BIGINT) AS c, "
    + ", ".join(f"CAST(sum(CASE WHEN {_OK} THEN {_points(b)} * CAST(round(credits * 1000000) AS BIGINT) ELSE 0 END) AS BIGINT) AS p{n}" for n, (_, b) in enumerate(SCALES.values()))
    + " FROM transcripts GROUP BY student_id), gpas AS ("
    + " UNION ALL ".join(f"SELECT student_id, '{k}' AS scale_id, {n} AS scale_no, {top} AS max_gpa_x10, CASE WHEN c > 0 THEN (20 * p{n} + c) // (2 * c) ELSE 0 END AS gpa_cents, c FROM sums" for n, (k, (top, _)) in enumerate(SCALES.items()))
    + "), gpa AS (SELECT *, gpa_cents / 100.0::DOUBLE AS gpa, c / 1000000.0::DOUBLE AS total_credits FROM gpas)"
)
REQUESTS = f"""requests AS (SELECT o_orderkey AS request_id, {pick(i.COST_COUNTRIES, "o_custkey % 5")} AS country, {pick(i.COST_CITIES, "o_orderkey % 8")} AS city,
  {pick(i.COST_DEGREES, "o_orderkey % 5")} AS degree, {pick(i.SCHOOL_TYPES, "o_orderkey % 3")} AS school_type, (1 + o_orderkey % 10) / 2.0::DOUBLE AS duration,
  {pick(i.STAYS, "o_orderkey % 4")} AS accommodation FROM orders)"""
COST_DIMS = ", ".join([
    cat.values("countries", "country, country_name, flag, currency, rate, application_fee, hidden_fee", cat.COUNTRIES), cat.values("cities", "country, pos, city, city_name, living_mult, accom_base", cat.CITIES),
    cat.values("degrees", "country, degree, pub, pri, years", cat.DEGREES), cat.values("stays", "accommodation, accommodation_name, mult", cat.ACCOMMODATIONS),
])
_half = lambda x: f"CAST(floor({x} + 0.5::DOUBLE) AS BIGINT)"
COSTS = f"""{COST_DIMS}, dims AS (
  SELECT r.*, k.rate, k.application_fee, k.hidden_fee, coalesce(c.living_mult, f.living_mult) AS lm, coalesce(c.accom_base, f.accom_base) AS ab,
    coalesce(d.pub, b.pub) AS pub, coalesce(d.pri, b.pri) AS pri, coalesce(s.mult, 1.0::DOUBLE) AS am
  FROM requests AS r LEFT JOIN countries AS k USING (country) LEFT JOIN cities AS c ON c.country = r.country AND c.city = r.city
  LEFT JOIN cities AS f ON f.country = r.country AND f.pos = 0 LEFT JOIN degrees AS d ON d.country = r.country AND d.degree = r.degree
  LEFT JOIN degrees AS b ON b.country = r.country AND b.degree = 'bachelor' LEFT JOIN stays AS s ON s.accommodation = r.accommodation
), bases AS (
  SELECT *, CASE school_type WHEN 'public' THEN pub WHEN 'private' THEN pri ELSE (pub + pri) / 2.0::DOUBLE END * duration * rate AS tb,
    (ab * am + 600.0::DOUBLE * lm) * 12.0::DOUBLE * duration * rate AS lb FROM dims
), costs AS (
  SELECT request_id, country, city, degree, school_type, duration, accommodation,
    {", ".join(f"coalesce({_half(f'tb * {m}::DOUBLE')}, 0) AS tuition_{k}" for k, m in TUITION_TIERS.items())},
    {", ".join(f"coalesce({_half(f'lb * {m}::DOUBLE')}, 0) AS living_{k}" for k, m in LIVING_TIERS.items())},
    CAST(coalesce(application_fee, 0) AS BIGINT) AS application, CAST(coalesce(hidden_fee, 0) AS BIGINT) AS hidden FROM bases
), totals AS (SELECT *, {", ".join(f"tuition_{k} + living_{k} + application + hidden AS total_{k}" for k in TUITION_TIERS)} FROM costs)"""
ITEMS = cat.values("items", "country_id, visa_id, section_no, item_no, item_id, name, required, prep_time, notes, needs_translation", cat.flat_visa_rows())
_ITEM_COLUMNS = f"{pick(cat.SECTIONS, 'section_no')} AS section"
VISA_REQUESTS = f"visa_requests AS (SELECT c_custkey AS request_id, c_custkey % 100 AS user_id, split_part({pick(i.VISA_IDS, 'c_custkey % 5')}, '-', 1) AS country_id, {pick(i.VISA_IDS, 'c_custkey % 5')} AS visa_id FROM customer WHERE c_custkey % 7 <> 0)"
TOGGLES = f"toggles AS (SELECT user_id, {pick([r[4] for r in cat.flat_visa_rows()], 'event_id % 46')} AS item_id FROM events), state AS (SELECT user_id, item_id, count(*) % 2 = 1 AS checked FROM toggles GROUP BY user_id, item_id)"
_sizes = {t: sum(r[0] == t for r in cat.TIMELINES) for t, *_ in cat.TIMELINES}
STAGES = cat.values("stages", "template_id, idx, stage_id, stage_name, time_range, core_tasks, bg_enhancement, deadline, risk_warning, is_locked", [(*r, r[1] >= int(_sizes[r[0]] * 0.6)) for r in cat.stage_rows()])
TIMELINE = f"""{STAGES}, t_requests AS (SELECT c_custkey AS request_id, {pick(i.TIMELINE_COUNTRIES, "c_custkey % 4")} AS country, {pick(i.TIMELINE_LEVELS, "c_custkey % 3")} AS level
  FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0),
timeline AS (SELECT request_id, country, level, s.* FROM t_requests JOIN stages AS s ON s.template_id =
  CASE WHEN country = '美国' AND level = '本科' THEN 'US-undergrad' WHEN country = '美国' THEN 'US-master' WHEN country = '中国香港' THEN 'HK-master' ELSE 'US-undergrad' END)"""
_SITES = len(cat.EVENT_SITES)
_name = pick([s[0] for s in cat.EVENT_SITES], f"event_id % {_SITES}")
_label = f"CASE event_id % {_SITES} " + " ".join(f"WHEN {k} THEN {pick(o, f'event_id // {_SITES} % {len(o)}')}" for k, o in i.CHOICES.items()) + f" ELSE {pick([s[2] or '' for s in cat.EVENT_SITES], f'event_id % {_SITES}')} END"
INTERACTIONS = f"""raw AS (SELECT event_id, ts, user_id, {_name} AS name, {_label} AS event_label, value FROM events),
interactions AS (SELECT event_id, ts, user_id, name, CASE WHEN name = 'copy_wechat_id' THEN 'Conversion' ELSE 'Engagement' END AS event_category, event_label,
  CASE WHEN name IN ('generate_pdf_report', 'click_cta_button', 'generate_cost_saving_plan') THEN value END AS value FROM raw)"""

_COST_VALUE = f"""CASE event_id % 6 WHEN 0 THEN {pick(i.COST_COUNTRIES, "event_id // 7 % 5")} WHEN 1 THEN {pick(i.COST_DEGREES, "event_id // 7 % 5")} WHEN 2 THEN {pick(i.COST_CITIES, "event_id // 7 % 8")}
  WHEN 3 THEN {pick(["2", "0", "3.5 years", "none", "4"], "event_id // 7 % 5")} WHEN 4 THEN {pick(i.SCHOOL_TYPES, "event_id // 7 % 3")} ELSE {pick(i.STAYS, "event_id // 7 % 4")} END"""
_last = lambda e: f"max_by({e}, seq) FILTER (WHERE {e} IS NOT NULL)"
COST_REPLAY = f"""WITH {COST_DIMS}, log AS (SELECT user_id AS session_id, event_id AS seq, {pick(["country", "degree", "city", "duration", "school_type", "accommodation"], "event_id % 6")} AS field, {_COST_VALUE} AS value FROM events),
run AS (SELECT *, coalesce(last_value(CASE WHEN field = 'country' THEN value END IGNORE NULLS) OVER w, '{COST_FORM["country"]}') AS nc,
  coalesce(last_value(CASE WHEN field = 'degree' THEN value END IGNORE NULLS) OVER w, '{COST_FORM["degree"]}') AS nd FROM log
  WINDOW w AS (PARTITION BY session_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
e AS (SELECT session_id, seq, CASE WHEN field = 'city' THEN value WHEN field = 'country' AND f.city IS NOT NULL THEN f.city END AS city,
  CASE WHEN field = 'duration' THEN CASE value WHEN '2' THEN 2.0 WHEN '3.5 years' THEN 3.5 WHEN '4' THEN 4.0 ELSE 1.0 END
       WHEN field IN ('country', 'degree') AND f.city IS NOT NULL THEN coalesce(d.years, 1.0) END::DOUBLE AS duration,
  {", ".join(f"CASE WHEN field = '{c}' THEN value END AS {c}" for c in ("country", "degree", "school_type", "accommodation"))}
  FROM run LEFT JOIN cities AS f ON f.country = nc AND f.pos = 0 LEFT JOIN degrees AS d ON d.country = nc AND d.degree = nd)
SELECT session_id, {", ".join(f"coalesce({_last(c)}, {cat.literal(float(v) if c == 'duration' else v)}) AS {c}" for c, v in COST_FORM.items())} FROM e GROUP BY session_id"""

_OP = "CASE WHEN event_id % 97 = 0 THEN 'clear' WHEN event_id % 89 = 0 THEN 'fill' WHEN event_id % 5 = 0 THEN 'add' WHEN event_id % 5 = 4 THEN 'remove' ELSE 'update' END"
COURSE_REPLAY = f"""WITH l0 AS (SELECT user_id AS session_id, event_id AS seq, {_OP} AS op, event_id FROM events),
log AS (SELECT session_id, seq, op,
  CASE WHEN event_id % 89 < 9 THEN 'example-' || (event_id % 3) ELSE 'c-' || CASE WHEN op = 'add' THEN event_id ELSE greatest(0, event_id // 5 * 5 - 5 * (event_id % 400)) END END AS id,
  {pick(["name", "credits", "score"], "event_id % 3")} AS field,
  CASE event_id % 3 WHEN 0 THEN 'course ' || event_id WHEN 1 THEN {pick(["3", "2.5", "x"], "event_id % 7 % 3")} ELSE CAST(event_id % 101 AS VARCHAR) END AS value FROM l0),
heads AS (SELECT session_id, max(seq) FILTER (WHERE op IN ('clear', 'fill')) AS reset, max_by(op, seq) FILTER (WHERE op IN ('clear', 'fill')) AS how FROM log GROUP BY session_id),
{cat.values("example", "id, name, credits, score", [(f"example-{n}", *r) for n, r in enumerate(cat.EXAMPLE_COURSES)])},
courses AS (
  SELECT session_id, coalesce(reset, -1) AS born, example.* FROM heads, example WHERE how = 'fill'
  UNION ALL SELECT session_id, coalesce(reset, -1), 'blank-' || coalesce(reset, 0), '', 0.0, 0.0 FROM heads WHERE how IS DISTINCT FROM 'fill'
  UNION ALL SELECT session_id, min(seq), id, '', 0.0, 0.0 FROM log JOIN heads USING (session_id) WHERE op = 'add' AND seq > coalesce(reset, -1) GROUP BY session_id, id),
out AS (SELECT c.session_id, c.id AS course_id, c.name, c.credits, c.score, coalesce(bool_or(op = 'remove'), FALSE) AS removed,
  {", ".join(f"max_by(value, seq) FILTER (WHERE op = 'update' AND field = '{f}') AS n_{f}" for f in ("name", "credits", "score"))}
  FROM courses AS c LEFT JOIN log AS l ON l.session_id = c.session_id AND l.id = c.id AND l.op IN ('update', 'remove') AND l.seq > c.born GROUP BY ALL)
SELECT session_id, course_id, coalesce(n_name, name) AS name, CASE WHEN n_credits IS NULL THEN credits ELSE coalesce(TRY_CAST(n_credits AS DOUBLE), 0) END AS credits,
  CASE WHEN n_score IS NULL THEN score ELSE coalesce(TRY_CAST(n_score AS DOUBLE), 0) END AS score FROM out WHERE NOT removed"""

_emit = {c: f"CASE WHEN op = 'reset' THEN '' WHEN field = '{c}' THEN value END" for c in TIMELINE_FORM} | {c: f"CASE WHEN op = 'reset' OR field = 'level' THEN '' WHEN field = '{c}' THEN value END" for c in ("grade", "round")}
TIMELINE_REPLAY = f"""WITH log AS (SELECT user_id AS session_id, event_id AS seq, CASE WHEN event_id % 61 = 0 THEN 'reset' ELSE 'set' END AS op, {pick(TIMELINE_FORM, "event_id % 6")} AS field,
  CASE event_id % 6 WHEN 0 THEN {pick(i.TIMELINE_COUNTRIES, "event_id % 4")} WHEN 1 THEN {pick(i.TIMELINE_LEVELS, "event_id // 6 % 3")} ELSE 'v' || (event_id % 10) END AS value FROM events),
e AS (SELECT session_id, seq, {", ".join(f"{x} AS {c}" for c, x in _emit.items())} FROM log)
SELECT session_id, {", ".join(f"coalesce({_last(c)}, '') AS {c}" for c in TIMELINE_FORM)} FROM e GROUP BY session_id"""

_limits = " OR ".join(f"(match_level = '{k}' AND rn <= {n})" for k, (n, _) in SHORTLIST.items())
_open = "CASE match_level " + " ".join(f"WHEN '{k}' THEN {n}" for k, (_, n) in SHORTLIST.items()) + " END"

_CHOSEN = "CASE scale_id " + " ".join(f"WHEN '{k}' THEN {_points(b)}" for k, (_, b) in {**SCALES, "honours50": (50, [(90, 50), (75, 40), (60, 25)])}.items()) + " END"
ARRIVALS = f"""{INTERACTIONS}, weeks AS (SELECT *, least(3, (day(ts) - 1) // 8) AS week FROM interactions),
arrived AS (SELECT *, CASE WHEN event_id % 20 = 7 THEN least(3, week + 1 + event_id % 3) ELSE week END AS run, date_trunc('day', ts) + INTERVAL 1 DAY AS closes FROM weeks),
marks AS (SELECT r.run, (SELECT max(ts) FROM arrived AS a WHERE a.run < r.run) - INTERVAL 1 HOUR AS mark, (SELECT max(ts) FROM arrived AS a WHERE a.run <= r.run) - INTERVAL 1 HOUR AS after FROM (VALUES (0), (1), (2), (3)) AS r(run)),
judged AS (SELECT a.*, coalesce(closes <= mark, FALSE) AS is_late FROM arrived AS a JOIN marks USING (run))"""

SQL = {
    "gpa_chosen_scale": f"""WITH {TRANSCRIPTS}, c AS (SELECT *, {pick(i.CHOSEN_SCALES, f"student_id % {len(i.CHOSEN_SCALES)}")} AS scale_id FROM transcripts),
      s AS (SELECT student_id, scale_id, CAST(sum(CASE WHEN {_OK} THEN credits * 2 ELSE 0 END) AS BIGINT) AS c, CAST(sum(CASE WHEN {_OK} THEN credits * 2 * ({_CHOSEN}) ELSE 0 END) AS BIGINT) AS p FROM c GROUP BY ALL)
      SELECT student_id, scale_id, CASE WHEN scale_id = 'none-such' THEN NULL WHEN c > 0 THEN (20 * p + c) // (2 * c) ELSE 0 END / 100.0::DOUBLE AS gpa, c / 2.0::DOUBLE AS total_credits FROM s""",
    "event_rollup_weekly": f"WITH {INTERACTIONS} SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_category, event_label, count(*) AS n_events, CAST(sum(CAST(coalesce(value, 0) AS DECIMAL(18, 2))) AS DOUBLE) AS value_sum, count(DISTINCT user_id) AS n_users, count(*) FILTER (WHERE event_category = 'Conversion') AS conversions FROM interactions GROUP BY ALL",
    "facts_checked": """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS course_id, CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey END AS student_id, CAST(NULL AS VARCHAR) AS name,
      CASE WHEN l_linenumber NOT IN (2, 3) THEN CAST(CAST(l_quantity AS INT) % 9 AS DOUBLE) END AS credits, CAST(l_partkey % 106 AS DOUBLE) AS score,
      nullif(concat_ws('; ', CASE WHEN l_orderkey % 50 = 0 THEN 'null: student_id' END, CASE WHEN l_linenumber = 2 THEN 'type: credits' END), '') AS reason FROM lineitem""",
    "stored_state_read": f"SELECT event_id, {pick([float(n) for n, _ in i.STORED.values()], f'event_id % {len(i.STORED)}')}::BIGINT AS n_read, {pick([float(n) for _, n in i.STORED.values()], f'event_id % {len(i.STORED)}')}::BIGINT AS n_checked FROM events",
    "stream_checklists": f"""WITH t AS (SELECT user_id, event_id % 46 AS no, {pick([r[4] for r in cat.flat_visa_rows()], "event_id % 46")} AS item_id, count(*) % 2 = 1 AS is_on FROM events GROUP BY ALL)
      SELECT user_id, CAST(coalesce(sum(1 << CAST(no AS BIGINT)) FILTER (WHERE is_on), 0) AS BIGINT) AS mask, '{{' || coalesce(string_agg('"' || item_id || '":true', ',' ORDER BY no) FILTER (WHERE is_on), '') || '}}' AS json, count(*) FILTER (WHERE is_on) AS n_checked FROM t GROUP BY user_id""",
    "stream_late_events": f"""WITH {ARRIVALS} SELECT 'window' AS kind, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS at, event_category, event_label, count(*) AS n FROM judged WHERE NOT is_late AND closes <= (SELECT max(after) FROM marks) GROUP BY ALL
      UNION ALL SELECT 'late', 'run ' || run, NULL, NULL, count(*) FILTER (WHERE is_late) FROM judged GROUP BY run""",
    "gpa_standard40": f"WITH {TRANSCRIPTS}, {GPA} SELECT student_id, gpa, total_credits FROM gpa WHERE scale_id = 'standard40'",
    "gpa_all_scales": f"WITH {TRANSCRIPTS}, {GPA} SELECT student_id, scale_id, gpa, total_credits FROM gpa",
    "gpa_best_scale": f"WITH {TRANSCRIPTS}, {GPA} SELECT student_id, scale_id, gpa FROM gpa QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY gpa_cents * (1720 // max_gpa_x10) DESC, scale_no) = 1",
    "gpa_cta_tier": f"WITH {TRANSCRIPTS}, {GPA} SELECT student_id, gpa, CASE WHEN gpa >= 3.8::DOUBLE THEN 'top' WHEN gpa >= 3.3::DOUBLE THEN 'good' WHEN gpa > 0 THEN 'low' ELSE 'none' END AS cta_tier FROM gpa WHERE scale_id = 'pku40'",
    "gpa_score_flags": f"WITH {TRANSCRIPTS} SELECT student_id, credits, score, score > 100 OR score < 0 AS score_out_of_range FROM transcripts",
    "gpa_points": f"WITH {TRANSCRIPTS} " + " UNION ALL ".join(f"SELECT student_id, score, '{k}' AS scale_id, {_points(b)} AS points_x10 FROM transcripts WHERE {_OK}" for k, (_, b) in SCALES.items()),
    "course_numbers": "SELECT l_orderkey AS student_id, coalesce(CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE CAST(CAST(l_quantity AS INT) AS DOUBLE) END, 0) AS credits, CAST((l_partkey * 7) % 106 AS DOUBLE) AS score FROM lineitem",
    "cost_estimate": f"WITH {REQUESTS}, {COSTS} SELECT * FROM totals",
    "cost_labels": "WITH " + REQUESTS + ", " + COST_DIMS + ", " + cat.values("degree_types", "degree, degree_name", cat.DEGREE_TYPES) + ", " + cat.values("school_types", "school_type, school_type_name", cat.SCHOOL_TYPES)
    + """ SELECT request_id, country, city, degree, school_type, accommodation, country_name, flag, city_name, degree_name, school_type_name, accommodation_name
      FROM requests LEFT JOIN countries USING (country) LEFT JOIN cities USING (country, city) LEFT JOIN degree_types USING (degree) LEFT JOIN school_types USING (school_type) LEFT JOIN stays USING (accommodation)""",
    "gpa_band_lookup": f"WITH {TRANSCRIPTS}, {_BANDS} SELECT student_id, score, coalesce((SELECT max(points_x10) FROM bands WHERE scale_id = 'ustc43' AND lower_bound <= score), 0) AS points_x10 FROM transcripts WHERE {_OK}",
    "gpa_registered_scale": f"""WITH {TRANSCRIPTS}, s AS (SELECT student_id, sum(CASE WHEN {_OK} THEN credits ELSE 0 END) AS c,
      sum(CASE WHEN {_OK} THEN credits * CASE WHEN score >= 90 THEN 50 WHEN score >= 75 THEN 40 WHEN score >= 60 THEN 25 ELSE 0 END ELSE 0 END) AS p FROM transcripts GROUP BY student_id)
      SELECT student_id, CASE WHEN c > 0 THEN (CAST(40 * p AS BIGINT) + CAST(2 * c AS BIGINT)) // CAST(4 * c AS BIGINT) ELSE 0 END / 100.0::DOUBLE AS gpa, c AS total_credits FROM s""",
    "gpa_scale_summary": f"""WITH {TRANSCRIPTS}, {GPA}, {_BANDS}, n AS (SELECT DISTINCT scale_id, scale_name, max_gpa_x10 FROM bands),
      f AS (SELECT scale_id, count(*) AS n_students, CAST(floor(sum(gpa_cents) / count(*)) AS BIGINT) AS mean_cents, count(*) FILTER (WHERE gpa_cents = max_gpa_x10 * 10) AS n_at_max FROM gpa WHERE c > 0 GROUP BY scale_id)
      SELECT scale_id, scale_name, max_gpa_x10, coalesce(n_students, 0) AS n_students, coalesce(mean_cents, 0) AS mean_cents, coalesce(n_at_max, 0) AS n_at_max FROM n LEFT JOIN f USING (scale_id)""",
    "school_demand": f"WITH {APPLICANTS}, {MATCHES}, " + cat.values("details", "pos, school_id, name, en_name, country, ranking, req_gpa, req_toefl, req_ielts, tags", [(*r[:-1], ",".join(r[-1])) for r in cat.school_rows()])
    + " SELECT d.*, " + ", ".join(f"count(*) FILTER (WHERE match_level = '{k}') AS {k}" for k in SHORTLIST) + " FROM details AS d LEFT JOIN matches AS m ON m.school_id = d.school_id GROUP BY ALL",
    "visa_fees": "WITH " + cat.values("fees", "country_id, visa_id, visa_fee_cny, sevis_fee_cny, ihs_fee_cny", [(v[0], v[2], *(f and f[2] for f in v[7:])) for v in cat.VISAS])
    + f", {VISA_REQUESTS} SELECT f.*, visa_fee_cny + coalesce(sevis_fee_cny, 0) + coalesce(ihs_fee_cny, 0) AS total_cny, count(*) AS n_requests, CAST(sum(visa_fee_cny + coalesce(sevis_fee_cny, 0) + coalesce(ihs_fee_cny, 0)) AS BIGINT) AS sum_cny FROM fees AS f JOIN visa_requests AS r USING (visa_id) GROUP BY ALL",
    "event_sites": f"WITH {INTERACTIONS} SELECT name, event_category, count(*) AS n_events, count(DISTINCT event_label) AS n_labels FROM interactions GROUP BY ALL",
    "cost_default_duration": f"WITH {REQUESTS}, {COST_DIMS} SELECT request_id, country, degree, coalesce(nullif(years, 0), 1.0::DOUBLE) AS default_duration FROM requests LEFT JOIN degrees USING (country, degree)",
    "cost_cta": f"WITH {REQUESTS}, {COSTS} SELECT request_id, total_budget, total_medium, CASE WHEN total_budget > 500000 THEN 'plan' ELSE 'guide' END AS cta_tier FROM totals",
    "cost_form_replay": COST_REPLAY,
    "gpa_validation": f"WITH {APPLICANTS} SELECT applicant_id, gpa_text, gpa, gpa_error FROM validated",
    "school_match": f"WITH {APPLICANTS}, {MATCHES} SELECT * FROM matches",
    "school_rank": f"WITH {APPLICANTS}, {MATCHES} SELECT applicant_id, school_id, match_level, CAST(rn AS INT) AS rn FROM ranked",
    "school_shortlist": f"WITH {APPLICANTS}, {MATCHES} SELECT applicant_id, school_id, match_level, CAST(rn AS INT) AS rn, rn > {_open} AS is_locked FROM ranked WHERE {_limits}",
    "school_summary": f"WITH {APPLICANTS}, {MATCHES} SELECT v.applicant_id, " + ", ".join(f"count(*) FILTER (WHERE match_level = '{k}') AS {k}" for k in SHORTLIST) + " FROM validated AS v LEFT JOIN matches AS m USING (applicant_id) WHERE gpa_error IS NULL GROUP BY v.applicant_id",
    "selection_replay": "WITH t AS (SELECT user_id, " + pick(["US", "UK", "HK", "SG", "AU", "CA"], "(event_id * 7 + event_id // 11) % 6") + " AS item, count(*) % 2 = 1 AS is_on FROM events GROUP BY ALL) SELECT user_id, coalesce(string_agg(item, ',' ORDER BY item) FILTER (WHERE is_on), '') AS selected FROM t GROUP BY user_id",
    "visa_items": f"WITH {ITEMS}, {VISA_REQUESTS} SELECT i.country_id, i.visa_id, section_no, {_ITEM_COLUMNS}, item_no, item_id, name, required, prep_time, notes, needs_translation, (SELECT count(*) FROM visa_requests AS r WHERE r.visa_id = i.visa_id) AS n_requests FROM items AS i",
    "visa_checklist": f"WITH {ITEMS}, {VISA_REQUESTS} SELECT request_id, user_id, i.country_id, i.visa_id, section_no, item_no, item_id, name, required, needs_translation FROM visa_requests JOIN items AS i USING (country_id, visa_id)",
    "visa_summary": "WITH " + cat.values("visas", "country_id, country_name, visa_id, type_name, description, fee_amount, fee_currency, fee_cny, processing_time", [(v[0], v[1], v[2], v[4], v[5], *v[7], v[6]) for v in cat.VISAS]) + f", {VISA_REQUESTS} SELECT request_id, v.* FROM visa_requests AS r JOIN visas AS v ON v.visa_id = r.visa_id",
    "visa_tips": "WITH " + cat.values("tips", "visa_id, tip_no, tip", [(v, n, t) for v, ts in cat.VISA_TIPS.items() for n, t in enumerate(ts)]) + f", {VISA_REQUESTS} SELECT request_id, visa_id, tip_no, tip FROM visa_requests JOIN tips USING (visa_id)",
    "visa_progress": f"WITH {ITEMS}, {VISA_REQUESTS}, {TOGGLES} SELECT *, CAST(floor(done * 100.0::DOUBLE / total + 0.5::DOUBLE) AS BIGINT) AS percent FROM (SELECT request_id, r.user_id, country_id, visa_id, count(*) AS total, CAST(sum(CASE WHEN coalesce(checked, FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS done FROM visa_requests AS r JOIN items USING (country_id, visa_id) LEFT JOIN state AS s ON s.user_id = r.user_id AND s.item_id = items.item_id GROUP BY ALL)",
    "checked_state_json": f"WITH {TOGGLES} SELECT user_id, '{{' || string_agg('\"' || item_id || '\":' || CASE WHEN checked THEN 'true' ELSE 'false' END, ',' ORDER BY item_id) || '}}' AS json, count(*) AS n_read FROM state GROUP BY user_id",
    "timeline_stages": f"WITH {TIMELINE} SELECT request_id, country, level, template_id, idx, stage_id, stage_name, time_range, array_to_string(core_tasks, ';') AS core_tasks, bg_enhancement, deadline, risk_warning, is_locked FROM timeline",
    "timeline_masked": f"WITH {TIMELINE} SELECT request_id, template_id, idx, time_range, is_locked, " + ", ".join(f"CASE WHEN NOT is_locked THEN {c} END AS {c}" for c in ("stage_id", "stage_name", "bg_enhancement", "deadline", "risk_warning")) + ", CASE WHEN NOT is_locked THEN array_to_string(core_tasks, ';') END AS core_tasks FROM timeline",
    "timeline_first_locked": f"WITH {TIMELINE} SELECT request_id, coalesce(min(idx) FILTER (WHERE is_locked), -1) AS first_locked FROM timeline GROUP BY request_id",
    "timeline_form_replay": TIMELINE_REPLAY,
    "course_log_replay": COURSE_REPLAY,
    "event_envelope": f"WITH {INTERACTIONS} SELECT event_id, user_id, name, event_category, event_label, value FROM interactions",
    "event_rollup": f"WITH {INTERACTIONS} SELECT event_category, event_label, count(*) AS n_events, CAST(sum(CAST(coalesce(value, 0) AS DECIMAL(18, 2))) AS DOUBLE) AS value_sum, count(DISTINCT user_id) AS n_users, count(*) FILTER (WHERE event_category = 'Conversion') AS conversions FROM interactions GROUP BY ALL",
    "stream_progress": f"WITH {TOGGLES} SELECT user_id, item_id, checked FROM state",
    "stream_event_counts": f"WITH {INTERACTIONS} SELECT date_trunc('day', ts) AS window_start, event_category, event_label, count(*) AS n FROM interactions WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL",
}
