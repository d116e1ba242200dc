"""The same queries as ANSI SQL, for a second engine to run on the same tables."""

from __future__ import annotations

from casemill.functions.text import STOP_WORDS
from casemill.operators import evaluate, recommend, taxonomy
from casemill.plans.registry import CLASSES, ISSUE_NAMES, P, STEP_ORDER

TIMELY, RESPONSE = "Timely response?", "Company response to consumer"
ROWS = 'CAST(count(*) AS BIGINT)'


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


CASES = """WITH cases AS (
SELECT l_orderkey * 10 + l_linenumber AS "Complaint ID", o_orderdate, l_shipdate,
  CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month",
  CAST(quarter(o_orderdate) AS INTEGER) AS "Quarter", CAST(day(o_orderdate) AS INTEGER) AS "Day",
  dayname(o_orderdate) AS "Day_Name",
  CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0) AS INTEGER) AS "Resolution_Delay",
  CASE l_linestatus WHEN 'O' THEN 'Yes' WHEN 'F' THEN 'No' END AS "Timely response?",
  l_returnflag AS "Company response to consumer", o_orderpriority AS "Submitted via",
  p_type AS "Product", p_brand AS "Issue", p_name AS "Sub-issue", s_name AS "Company", n_name AS "State",
  c_mktsegment AS "Tags",
  CASE c_mktsegment WHEN 'Older American, Servicemember' THEN 'Older American + Servicemember' ELSE c_mktsegment END
    AS "Consumer_Group",
  CAST(CASE WHEN d.doc_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS "Has_Narrative",
  coalesce(n_words, 0) AS "Narrative_Word_Count"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS INTEGER) AS n_words FROM documents) d
  ON l_orderkey = d.doc_id
)"""


def value_counts(key: str, out: str | None = None, k: int | None = None) -> str:
    cut = f" LIMIT {k}" if k else ""
    return (f'{CASES} SELECT "{key}" AS "{out or key}", {ROWS} AS "Count" FROM cases WHERE "{key}" IS NOT NULL '
            f'GROUP BY 1 ORDER BY 2 DESC, 1{cut}')


def top(key: str, k: int) -> str:
    return (f'"{key}" IN (SELECT "{key}" FROM cases WHERE "{key}" IS NOT NULL GROUP BY 1 '
            f'ORDER BY count(*) DESC, 1 LIMIT {k})')


def cross(a: str, b: str, count: str = "Count", where: str = "true") -> str:
    return (f'{CASES} SELECT "{a}", "{b}", {ROWS} AS "{count}" FROM cases '
            f'WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL AND {where} GROUP BY 1, 2')


def share(key: str, k: int | None, rounding: str = "round({}, 6)") -> str:
    pct = rounding.format("n / sum(n) OVER () * 100")
    cut = f" LIMIT {k}" if k else ""
    return (f'{CASES}, c AS (SELECT "{key}", count(*) AS n FROM cases WHERE "{key}" IS NOT NULL GROUP BY 1) '
            f'SELECT "{key}", {pct} AS "Share_Pct" FROM c ORDER BY n DESC, 1{cut}')


def mode(key: str) -> str:
    return (f'(SELECT "{key}" FROM cases WHERE "{key}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)')


def pivot(index: str, column: str, values: list, where: str = "true") -> str:
    cells = ", ".join(f'CAST(count(*) FILTER (WHERE "{column}" = {v}) AS BIGINT) AS "{str(v).strip(chr(39))}"'
                      for v in values)
    return f'{CASES} SELECT "{index}", {cells} FROM cases WHERE {where} GROUP BY 1'


def dominant(key: str, partner: str, name: str, count: str) -> str:
    return (f'{CASES}, c AS (SELECT "{key}" AS k, "{partner}" AS v, count(*) AS n FROM cases GROUP BY 1, 2), '
            f'r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) AS rn FROM c) '
            f'SELECT k AS "{key}", v AS "{name}", CAST(n AS BIGINT) AS "{count}" FROM r WHERE rn = 1')


def histogram(column: str, where: str) -> str:
    return f"""{CASES}, v AS (SELECT "{column}" AS v FROM cases WHERE {where}),
b AS (SELECT CAST(min(v) AS DOUBLE) AS lo, CAST(max(v) AS DOUBLE) AS hi FROM v)
SELECT CAST(CASE WHEN hi > lo THEN least(floor((v - lo) * 50 / (hi - lo)) + 1, 50) ELSE 1 END AS INTEGER) AS "Bin",
  {ROWS} AS "Count", min(v) AS "Low", max(v) AS "High" FROM v, b GROUP BY 1"""


def mean_words(key: str) -> str:
    return (f'{CASES} SELECT "{key}", round(avg("Narrative_Word_Count"), 6) AS "Avg_Word_Count" FROM cases '
            f'WHERE "Has_Narrative" = 1 GROUP BY 1')


RISK = CASES + f""", g AS (SELECT "Company", {ROWS} AS n,
    avg(CASE "Timely response?" WHEN 'No' THEN 1.0 WHEN 'Yes' THEN 0.0 END) * 100 AS u,
    greatest(coalesce(avg("Resolution_Delay"), 0), 0) AS d FROM cases GROUP BY 1 HAVING count(*) >= 100),
b AS (SELECT min(n) n0, max(n) n1, min(u) u0, max(u) u1, min(d) d0, max(d) d1 FROM g),
s AS (SELECT g.*, CASE WHEN n1 > n0 THEN (n - n0) / (n1 - n0) ELSE 0.0 END AS cs,
    CASE WHEN u1 > u0 THEN (u - u0) / (u1 - u0) ELSE 0.0 END AS us,
    CASE WHEN d1 > d0 THEN (d - d0) / (d1 - d0) ELSE 0.0 END AS ds FROM g, b),
risk0 AS (SELECT *, (cs * CAST(0.5 AS DOUBLE) + us * CAST(0.3 AS DOUBLE) + ds * CAST(0.2 AS DOUBLE)) * 100 AS score FROM s),
risk AS (SELECT "Company", n, u, d, cs, us, ds, score,
    CASE WHEN score >= 70 THEN 'High' WHEN score >= 40 THEN 'Medium' ELSE 'Low' END AS lvl FROM risk0)"""
RISK_OUT = """SELECT "Company", n AS "Complaint_Count", round(u, 6) AS "Untimely_Response_Pct",
  round(d, 6) AS "Avg_Resolution_Delay", round(cs, 6) AS "Complaint_Score", round(us, 6) AS "Untimely_Score",
  round(ds, 6) AS "Delay_Score", round(score, 6) AS "Risk_Score", lvl AS "Risk_Level" FROM risk"""

DRIVERS_CTE = f""", dg AS (SELECT "Product" AS p, "Issue" AS i, "Sub-issue" AS s, {ROWS} AS n FROM cases GROUP BY 1, 2, 3),
dr AS (SELECT *, CAST(sum(n) OVER (PARTITION BY p) AS BIGINT) AS total FROM dg)"""
DRIVERS = CASES + DRIVERS_CTE
DRIVER_OUT = """p AS "Product", i AS "Issue", s AS "Sub-issue", n AS "Complaint_Count", total AS "Product_Total_Complaints",
round(n / total * 100, 6) AS "Driver_Contribution_Pct\""""


def growth_cte(key: str, floor: int, name: str) -> str:
    return f""", {name}_y AS (SELECT DISTINCT "Year" AS y FROM cases),
{name}_r AS (SELECT y, row_number() OVER (ORDER BY y DESC) AS rn FROM {name}_y),
{name}_t AS (SELECT {key} AS k,
    CAST(count(*) FILTER (WHERE "Year" = (SELECT y FROM {name}_r WHERE rn = 3)) AS BIGINT) AS prev,
    CAST(count(*) FILTER (WHERE "Year" = (SELECT y FROM {name}_r WHERE rn = 2)) AS BIGINT) AS cur FROM cases GROUP BY 1),
{name}_g AS (SELECT *, CASE WHEN prev = 0 THEN CASE WHEN cur > 0 THEN 999.0 ELSE 0.0 END
    ELSE (cur - prev) / prev * 100 END AS g FROM {name}_t WHERE cur >= {floor}),
{name} AS (SELECT *, CASE WHEN g = 999.0 THEN 'New / Emerging' WHEN g >= 25 THEN 'Rising Fast' WHEN g >= 5 THEN 'Rising'
    WHEN g <= -25 THEN 'Declining Fast' WHEN g <= -5 THEN 'Declining' ELSE 'Stable' END AS lbl,
    (SELECT y FROM {name}_r WHERE rn = 3) AS py, (SELECT y FROM {name}_r WHERE rn = 2) AS cy FROM {name}_g)"""


def growth_out(name: str, out: str, where: str = "true") -> str:
    return (f'SELECT k AS "{out}", prev AS "Previous_Year_Complaints", cur AS "Current_Year_Complaints", '
            f'py AS "Previous_Year", cy AS "Current_Year", round(g, 6) AS "YoY_Growth_Pct", lbl AS "Growth_Label" '
            f'FROM {name} WHERE {where}')


MONTHLY_OUT = f"""SELECT "Year", "Month", {ROWS} AS "Complaints", printf('%d-%02d', "Year", "Month") AS "Period"
FROM cases GROUP BY 1, 2"""


def fit_cte(series: str = "'all'") -> str:
    """Training months with the full and the hold-out fit, as table ``fit``."""
    steps = f""", m0 AS (SELECT {series} AS s, "Year" AS y, "Month" AS m, count(*) AS c FROM cases GROUP BY 1, 2, 3),
m1 AS (SELECT *, max(y) OVER (PARTITION BY s) AS part_y FROM m0),
m2 AS (SELECT *, max(y) OVER (PARTITION BY s) AS last_y FROM m1 WHERE y < part_y),
m3 AS (SELECT *, count(*) OVER (PARTITION BY s) AS months FROM m2 WHERE y > last_y - 4),
m4 AS (SELECT *, CAST(y * 12 + m - min(y * 12 + m) OVER (PARTITION BY s) AS DOUBLE) AS t,
    row_number() OVER (PARTITION BY s ORDER BY y * 12 + m DESC) AS back FROM m3 WHERE months >= 12)"""
    last = "m4"
    for name, fit in (("f", "CAST(c AS DOUBLE)"), ("h", "CASE WHEN back > 6 THEN CAST(c AS DOUBLE) END")):
        steps += f""",
{name}1 AS (SELECT *, {fit} AS {name}c FROM {last}),
{name}2 AS (SELECT *, coalesce(regr_slope({name}c, t) OVER (PARTITION BY s), 0.0) AS {name}slope,
    avg({name}c) OVER (PARTITION BY s) AS {name}my,
    avg(CASE WHEN {name}c IS NOT NULL THEN t END) OVER (PARTITION BY s) AS {name}mt FROM {name}1),
{name}3 AS (SELECT *, {name}my - {name}slope * {name}mt + {name}slope * t AS {name}trend FROM {name}2),
{name}4 AS (SELECT *, coalesce(avg({name}c - {name}trend) OVER (PARTITION BY s, m), 0.0) AS {name}season FROM {name}3),
{name}5 AS (SELECT *, {name}trend + {name}season AS {name}hat FROM {name}4)"""
        last = f"{name}5"
    return steps + f""",
fit AS (SELECT *, coalesce(stddev_samp(c - fhat) OVER (PARTITION BY s), 0.0) AS sigma FROM {last}),
fut AS (SELECT s, m AS bm, y AS ly, fslope, fmy - fslope * fmt AS icpt, t, sigma, step FROM fit, range(1, 7) r(step)
    WHERE back = 1),
fut2 AS (SELECT fut.*, CAST(make_date(ly, bm, 1) + to_months(CAST(step AS INTEGER)) AS DATE) AS dt FROM fut),
seas AS (SELECT s, m, max(fseason) AS season FROM fit GROUP BY 1, 2),
fut3 AS (SELECT fut2.*, icpt + fslope * (t + step) + coalesce(season, 0.0) AS yhat
    FROM fut2 LEFT JOIN seas ON fut2.s = seas.s AND seas.m = month(dt)),
fut4 AS (SELECT *, CAST(round_even(greatest(yhat, 0.0), 0) AS BIGINT) AS val FROM fut3),
val0 AS (SELECT s, months, c, greatest(hhat, 0.0) AS hp FROM fit WHERE back <= 6),
val AS (SELECT s, CASE WHEN max(months) >= 18 THEN avg(abs(c - hp)) ELSE 0.0 END AS mae,
    CASE WHEN max(months) >= 18 THEN coalesce(avg(CASE WHEN c <> 0 THEN abs(c - hp) / c END) * 100, 0.0) ELSE 0.0 END AS mape
    FROM val0 GROUP BY 1)"""


def whole(x: str) -> str:
    return f"CAST(round_even(greatest({x}, 0.0), 0) AS BIGINT)"


def forecast_out(series: str = "") -> str:
    key = f's AS "{series}", ' if series else ""
    return f"""SELECT {key}make_date(y, m, 1) AS "Date", CAST(c AS BIGINT) AS "Complaints",
  {whole('fhat - sigma * 1.2816')} AS "Lower_Bound", {whole('fhat + sigma * 1.2816')} AS "Upper_Bound",
  'Actual' AS "Type", strftime(make_date(y, m, 1), '%Y-%m') AS "Period" FROM fit
UNION ALL SELECT {key}dt, val, {whole('yhat - sigma * 1.2816')}, {whole('yhat + sigma * 1.2816')}, 'Forecast',
  strftime(dt, '%Y-%m') FROM fut4"""


FSUM_CTE = """, fs0 AS (SELECT s, sum(val) FILTER (WHERE step <= 1) AS n1, sum(val) FILTER (WHERE step <= 3) AS n3,
    sum(val) AS n6 FROM fut4 GROUP BY 1),
fs1 AS (SELECT s, max(last_y) AS ey, max(part_y) AS py, max(c) FILTER (WHERE back = 1) AS latest FROM fit GROUP BY 1),
fs2 AS (SELECT fs1.*, n1, n3, n6, mae, mape, CASE WHEN latest <> 0 THEN (n1 - latest) / latest * 100 ELSE 0.0 END AS chg
    FROM fs1 JOIN fs0 ON fs0.s = fs1.s JOIN val ON val.s = fs1.s),
fsum AS (SELECT *, CASE WHEN chg >= 5 THEN 'Increasing' WHEN chg <= -5 THEN 'Decreasing' ELSE 'Stable' END AS trend FROM fs2)"""


def fsum_out(series: str = "") -> str:
    key = f's AS "{series}", ' if series else ""
    return f"""SELECT {key}'Seasonal trend' AS "Model", CAST(ey - 3 AS INTEGER) AS "Training_Start_Year", ey AS "Training_End_Year",
  py AS "Excluded_Partial_Year", CAST(latest AS BIGINT) AS "Latest_Actual_Complaints",
  CAST(n1 AS BIGINT) AS "Next_Month_Forecast", CAST(n3 AS BIGINT) AS "Next_3_Month_Forecast",
  CAST(n6 AS BIGINT) AS "Next_6_Month_Forecast", round(chg, 6) AS "Expected_Change_Pct", trend AS "Forecast_Trend",
  round(mae, 6) AS "Validation_MAE", round(mape, 6) AS "Validation_MAPE" FROM fsum"""


def advice(column: str, rules, default: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({column}), {text(k)})" for k in keys) + f" THEN {text(answer)}"
        for keys, answer in rules
    )
    return f"CASE {cases} ELSE {text(default)} END"


def _recommendations() -> str:
    inc, dec, flat = recommend.FORECAST_ADVICE["Increasing"], recommend.FORECAST_ADVICE["Decreasing"], recommend.FORECAST_DEFAULT
    return f"""{RISK}{DRIVERS_CTE}{growth_cte('"Product"', P.growth_floor, 'pg')}{growth_cte('"Issue"', P.growth_floor, 'ig')}{fit_cte()}{FSUM_CTE},
top25 AS (SELECT * FROM dr ORDER BY n DESC, p, i, s LIMIT 25),
drv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p, i ORDER BY n DESC, s) AS rn FROM top25) WHERE rn = 1),
rec AS (
SELECT 'Forecast' AS category, CASE trend WHEN 'Increasing' THEN '{inc[0]}' WHEN 'Decreasing' THEN '{dec[0]}' ELSE '{flat[0]}' END AS priority,
  {text(recommend.FORECAST_ENTITY)} AS entity,
  trend || ' | Expected Change: ' || printf('%.2f', chg) || '% | Validation MAPE: ' || printf('%.2f', mape) || '%' AS signal,
  CASE trend WHEN 'Increasing' THEN {text(inc[1])} WHEN 'Decreasing' THEN {text(dec[1])} ELSE {text(flat[1])} END AS recommendation,
  1 AS seq FROM fsum
UNION ALL SELECT 'Company Risk', 'High', "Company", 'Risk Score: ' || printf('%.2f', score) || ' | Complaints: ' || n ||
  ' | Untimely Response: ' || printf('%.2f', u) || '%', {text(recommend.RISK_ADVICE)},
  row_number() OVER (ORDER BY score DESC, "Company") FROM risk WHERE lvl = 'High' QUALIFY row_number() OVER (ORDER BY score DESC, "Company") <= 5
UNION ALL SELECT 'Complaint Driver', 'High', p || ' → ' || i, 'Complaints: ' || n,
  {advice('i', recommend.ISSUE_ADVICE, recommend.ISSUE_DEFAULT)} || {text(recommend.DRIVER_SUFFIX)},
  row_number() OVER (ORDER BY n DESC, p, i) FROM drv QUALIFY row_number() OVER (ORDER BY n DESC, p, i) <= 5
UNION ALL SELECT 'Product Growth', 'Medium', k, 'YoY Growth: ' || printf('%.2f', g) || '% | Current Complaints: ' || cur,
  {advice('k', recommend.PRODUCT_ADVICE, recommend.PRODUCT_DEFAULT)},
  row_number() OVER (ORDER BY g DESC, k) FROM pg QUALIFY row_number() OVER (ORDER BY g DESC, k) <= 5
UNION ALL SELECT 'Issue Growth', 'High', k, 'YoY Growth: ' || printf('%.2f', g) || '% | Current Complaints: ' || cur,
  {advice('k', recommend.ISSUE_ADVICE, recommend.ISSUE_DEFAULT)},
  row_number() OVER (ORDER BY g DESC, k) FROM ig QUALIFY row_number() OVER (ORDER BY g DESC, k) <= 7)"""


RECS = _recommendations()
REC_OUT = ('SELECT category AS "Category", priority AS "Priority", entity AS "Entity", signal AS "Signal", '
           'recommendation AS "Recommendation" FROM rec')

PREPROCESS = f"""{CASES}, raw AS (SELECT *, "Complaint ID" % 10 AS ln FROM cases),
pre AS (SELECT
  CASE WHEN ln = 7 THEN NULL ELSE o_orderdate END AS received, l_shipdate AS sent, "Product",
  CASE WHEN "Product" = 'PROMO' THEN 'Unknown' ELSE "Product" END AS "Sub-product",
  CASE WHEN "Issue" = 'Brand#1' THEN 'Unknown' ELSE "Issue" END AS "Issue",
  CASE WHEN "Sub-issue" = 'red widget' THEN 'Unknown' ELSE "Sub-issue" END AS "Sub-issue",
  CASE {{r}} WHEN 'R' THEN '' WHEN 'N' THEN "Sub-issue" || '  ' || "Company" END AS narrative,
  'No public response' AS "Company public response", "Company",
  CASE WHEN "State" = 'NATION_1' THEN 'Unknown' ELSE "State" END AS "State", 'Unknown' AS "ZIP code",
  CASE "Tags" WHEN 'BUILDING' THEN 'Older American, Servicemember' WHEN 'MACHINERY' THEN 'Normal Consumer' ELSE "Tags" END AS "Tags",
  "Submitted via", CASE {{r}} WHEN 'A' THEN 'Unknown' ELSE {{r}} END AS "Company response to consumer", "Timely response?",
  CAST("Complaint ID" AS VARCHAR) AS "Complaint ID" FROM raw)""".format(r='"Company response to consumer"')

NAMED = f"""WITH named AS (SELECT coalesce([{', '.join(text(n) for n in taxonomy.raw_labels('Product'))}][p_size], p_type) AS "Product",
coalesce([{', '.join(text(n) for n in taxonomy.raw_labels('Issue'))}][p_size], p_brand) AS "Issue"
FROM lineitem JOIN part ON l_partkey = p_partkey),
tax AS (SELECT * FROM (VALUES {', '.join(f"({text(f)}, {text(raw)}, {text(name)}, {text(conf)}, {text(why)})"
                                         for f, groups in taxonomy.TAXONOMIES.items()
                                         for name, raws, conf, why in groups for raw in raws)})
  v(field, raw_label, canonical, confidence, rationale))"""


def canonical(column: str, field: str) -> str:
    return f"coalesce((SELECT canonical FROM tax WHERE field = '{field}' AND raw_label = {column}), {column})"


def audit(field: str) -> str:
    return f"""{NAMED}, sup AS (SELECT "{field}" AS label, count(*) AS n FROM named GROUP BY 1),
c0 AS (SELECT label, n, coalesce(t.canonical, label) AS c FROM sup LEFT JOIN tax t ON field = '{field}' AND raw_label = label),
c1 AS (SELECT c, sum(n) AS n, count(*) AS raw, count(*) FILTER (WHERE n < 50) AS rare FROM c0 GROUP BY 1)
SELECT CAST(sum(raw) AS BIGINT) AS raw_class_count, {ROWS} AS canonical_class_count,
  CAST(sum(raw) - count(*) AS BIGINT) AS classes_removed, CAST(sum(rare) AS BIGINT) AS rare_classes_before,
  CAST(count(*) FILTER (WHERE n < 50) AS BIGINT) AS rare_classes_after,
  CAST(count(*) FILTER (WHERE raw > 1) AS BIGINT) AS merged_groups FROM c1"""


PAIRS = f"""WITH pred AS (SELECT p_name AS y_true, CASE WHEN l_discount >= 0.05 THEN p_name
  WHEN l_tax >= 0.04 THEN split_part(p_name, ' ', 1) || ' widget' ELSE 'large ' || p_name END AS y_pred,
  p_type AS type, CASE WHEN l_discount >= 0.05 THEN p_type ELSE 'STANDARD' END AS type_pred
  FROM lineitem JOIN part ON l_partkey = p_partkey),
pairs AS (SELECT y_true, y_pred, {ROWS} AS n FROM pred GROUP BY 1, 2),
lab AS (SELECT y_true AS label FROM pairs UNION SELECT y_pred FROM pairs),
t AS (SELECT y_true AS label, sum(n) AS support FROM pairs GROUP BY 1),
p AS (SELECT y_pred AS label, sum(n) AS predicted FROM pairs GROUP BY 1),
h AS (SELECT y_true AS label, sum(n) AS hits FROM pairs WHERE y_true = y_pred GROUP BY 1),
pc AS (SELECT lab.label, coalesce(hits / predicted, 0.0) AS pr, coalesce(hits / support, 0.0) AS rc,
  coalesce(2 * hits / (coalesce(support, 0) + coalesce(predicted, 0)), 0.0) AS f1, coalesce(support, 0) AS support
  FROM lab LEFT JOIN t ON t.label = lab.label LEFT JOIN p ON p.label = lab.label LEFT JOIN h ON h.label = lab.label)"""
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

PROBS = f"""WITH cls AS (SELECT * FROM (VALUES {', '.join(f"({i}, {text(c)}, {text(ISSUE_NAMES.get(c, c))})" for i, c in enumerate(CLASSES))})
  v(idx, raw, canonical)),
w AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE) * CAST(x AS DOUBLE) *
  CAST(x AS DOUBLE) * CAST(x AS DOUBLE) * CAST(x AS DOUBLE) * CAST(x AS DOUBLE) * CAST(x AS DOUBLE)) AS w FROM embeddings),
e AS (SELECT vec_id, label, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS idx FROM w),
probs AS (SELECT vec_id, label, idx, x / sum(x) OVER (PARTITION BY vec_id) AS p FROM e),
can AS (SELECT vec_id, canonical AS label, sum(p) AS conf FROM probs JOIN cls USING (idx) GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY conf DESC, label) AS rn,
  max(conf) OVER (PARTITION BY vec_id) AS best FROM can),
am AS (SELECT vec_id, label, idx, p FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, idx) AS rn FROM probs) WHERE rn = 1)"""


def prevalence(name: str, where: str) -> str:
    return (f", {name} AS (SELECT r.t AS topic_id, count(am.vec_id) / (SELECT count(*) FROM am WHERE {where}) AS share "
            f"FROM range(64) r(t) LEFT JOIN (SELECT * FROM am WHERE {where}) am ON am.idx = r.t GROUP BY 1)")


STOP = ", ".join(text(w) for w in STOP_WORDS)
CLEAN = "trim(regexp_replace(regexp_replace(lower(text), '\\bxx+\\b', ' ', 'g'), '[^a-z]+', ' ', 'g'))"
TOKENS = f"list_filter(string_split({CLEAN}, ' '), lambda w: length(w) >= 2 AND w NOT IN ({STOP}))"


def ngrams(n: int) -> str:
    gram = " || ' ' || ".join(f"tok[i + {j}]" if j else "tok[i]" for j in range(n))
    return f"""WITH d AS (SELECT {TOKENS} AS tok FROM documents),
g AS (SELECT unnest(list_transform(range(1, len(tok) - {n - 2}), lambda i: {gram})) AS "Phrase" FROM d)
SELECT "Phrase", {ROWS} AS "Count" FROM g GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""


SIMILAR = f"""WITH d0 AS (SELECT doc_id AS id, {TOKENS} AS tok FROM documents), q0 AS (SELECT item_id AS id, {TOKENS} AS tok FROM benchmark),
d1 AS (SELECT id, unnest(tok || list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])) AS term FROM d0),
q1 AS (SELECT id, unnest(tok || list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])) AS term FROM q0),
df AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(DISTINCT id))) + 1 AS idf FROM d1 GROUP BY 1
  HAVING count(DISTINCT id) >= 3),
d2 AS (SELECT id, term, count(*) * any_value(idf) AS w FROM d1 JOIN df USING (term) GROUP BY 1, 2),
q2 AS (SELECT id, term, count(*) * any_value(idf) AS w FROM q1 JOIN df USING (term) GROUP BY 1, 2),
dn AS (SELECT id, sqrt(sum(w * w)) AS n FROM d2 GROUP BY 1), qn AS (SELECT id, sqrt(sum(w * w)) AS n FROM q2 GROUP BY 1),
dots AS (SELECT q2.id AS q, d2.id AS d, sum(q2.w * d2.w) AS dot FROM q2 JOIN d2 USING (term) GROUP BY 1, 2),
allp AS (SELECT q0.id AS q, d0.id AS d, round(coalesce(dot / (qn.n * dn.n), 0.0), 9) AS sim FROM q0 CROSS JOIN d0
  LEFT JOIN dots ON dots.q = q0.id AND dots.d = d0.id LEFT JOIN dn ON dn.id = d0.id LEFT JOIN qn ON qn.id = q0.id),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, d) AS rn FROM allp)
SELECT q AS query_id, d AS doc_id, CAST(rn AS INTEGER) AS rank, round(sim, 6) AS similarity FROM r WHERE rn <= 5"""

DOCS_LABELS = "documents LEFT JOIN labels USING (doc_id)"
NULL_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")

FEATURES_PRE = """strftime(received, '%Y-%m-%d %H:%M:%S') AS "Date received", strftime(sent, '%Y-%m-%d %H:%M:%S') AS "Date sent to company",
CAST(year(received) AS INTEGER) AS "Year", CAST(month(received) AS INTEGER) AS "Month", CAST(quarter(received) AS INTEGER) AS "Quarter",
CAST(day(received) AS INTEGER) AS "Day", dayname(received) AS "Day_Name",
CAST(floor((epoch_us(sent) - epoch_us(received)) / 86400000000.0) AS INTEGER) AS "Resolution_Delay",
CAST(narrative IS NOT NULL AS INTEGER) AS "Has_Narrative", CAST(length(coalesce(narrative, '')) AS INTEGER) AS "Narrative_Length",
CAST(len(regexp_extract_all(coalesce(narrative, ''), '\\S+')) AS INTEGER) AS "Narrative_Word_Count",
CASE "Tags" WHEN 'Older American, Servicemember' THEN 'Older American + Servicemember' ELSE "Tags" END AS "Consumer_Group\""""

ORACLE: dict[str, str] = {
    "kpis": f"""{CASES} SELECT {ROWS} AS total_complaints, CAST(count(DISTINCT "Company") AS BIGINT) AS total_companies,
  CAST(count(DISTINCT "Product") AS BIGINT) AS total_products, CAST(count(DISTINCT "State") AS BIGINT) AS total_states,
  round(avg(CASE "Timely response?" WHEN 'Yes' THEN 1.0 WHEN 'No' THEN 0.0 END) * 100, 6) AS timely_response_pct,
  round(avg("Resolution_Delay"), 6) AS avg_resolution_delay, round(avg("Has_Narrative") * 100, 6) AS narrative_availability_pct,
  {mode('Product')} AS top_product, {mode('Company')} AS top_company, {mode('Issue')} AS top_issue,
  {mode('Submitted via')} AS top_channel, {mode('Year')} AS peak_year,
  (SELECT CAST(max(n) AS BIGINT) FROM (SELECT count(*) AS n FROM cases GROUP BY "Year")) AS peak_year_complaints FROM cases""",
    "mode_value": f'{CASES} SELECT {mode("Sub-issue")} AS "Value"',
    "yearly_trend": f'{CASES} SELECT "Year", {ROWS} AS "Complaints" FROM cases GROUP BY 1',
    "timely_response": value_counts(TIMELY, "Timely Response"),
    "submitted_via": value_counts("Submitted via", "Channel"),
    "consumer_group": value_counts("Consumer_Group", "Consumer Group"),
    "resolution_summary": value_counts(RESPONSE, "Resolution Type"),
    "narrative_availability": value_counts("Has_Narrative", "Has Narrative"),
    "state_map": value_counts("State"),
    "top_products": value_counts("Product", k=15),
    "top_issues": value_counts("Issue", k=15),
    "top_sub_issues": value_counts("Sub-issue", "Sub Issue", 15),
    "top_companies": value_counts("Company", k=15),
    "top_states": value_counts("State", k=15),
    "product_share": share("Product", 10),
    "company_share": share("Company", 10),
    "value_share": share("Issue", None, "round_even({}, 2)"),
    "year_product_trend": cross("Year", "Product", "Complaints"),
    "issue_trend": cross("Year", "Issue", "Complaints", top("Issue", 10)),
    "top_five_product_trend": cross("Year", "Product", "Complaints", top("Product", 5)),
    "issue_product_heatmap": cross("Issue", "Product", "Count", top("Issue", 10) + " AND " + top("Product", 10)),
    "heatmap_pivot": pivot("Issue", "Product", [f"'{t}'" for t in TYPES], top("Issue", 10) + " AND " + top("Product", 10)),
    "company_timely_response": cross("Company", TIMELY, "Count", top("Company", 10)),
    "company_resolution": cross("Company", RESPONSE, "Count", top("Company", 10)),
    "regex_company_summary": f"""{CASES} SELECT "Company", CAST(count("Timely response?") AS BIGINT) AS "Total_Complaints",
  round(count(*) FILTER (WHERE "Timely response?" = 'Yes') / count("Timely response?") * 100, 6) AS "Timely_Response_Pct"
  FROM cases WHERE regexp_matches("Company", '(?i)supplier#0+1|SUPPLIER#0+2') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "resolution_by_year": cross("Year", RESPONSE),
    "crosstab": cross("Consumer_Group", "Product"),
    "year_pivot": pivot("Product", "Year", list(range(1995, 2002))),
    "dominant_partner": dominant("State", "Product", "Top_Product", "Complaint_Count"),
    "dominant_company": dominant("Issue", "Company", "Top_Company", "Count"),
    **{f"count_by_{c.lower()}": value_counts(c) for c in ("Month", "Quarter", "Day_Name")},
    "delay_distribution": f'{CASES} SELECT "Resolution_Delay" FROM cases WHERE "Resolution_Delay" BETWEEN 0 AND 365',
    "delay_histogram": histogram("Resolution_Delay", '"Resolution_Delay" BETWEEN 0 AND 365'),
    "words_histogram": histogram("Narrative_Word_Count", '"Narrative_Word_Count" <= 1000'),
    "narrative_word_count": f'{CASES} SELECT "Narrative_Word_Count" FROM cases WHERE "Narrative_Word_Count" <= 1000',
    "narrative_length_trend": mean_words("Year"),
    "narrative_complexity": f"""{CASES} SELECT CASE WHEN "Narrative_Word_Count" <= 50 THEN 'Low'
  WHEN "Narrative_Word_Count" <= 150 THEN 'Medium' ELSE 'High' END AS "Complexity", {ROWS} AS "Count"
  FROM cases WHERE "Has_Narrative" = 1 GROUP BY 1""",
    "narrative_product_length": mean_words("Product") + " ORDER BY 2 DESC, 1 LIMIT 15",
    "narrative_product_availability": f"""{CASES} SELECT "Product", round(avg("Has_Narrative") * 100, 6)
  AS "Narrative_Availability_Pct" FROM cases GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
    "top_narrative_words": f"""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM documents)
SELECT w AS "Word", {ROWS} AS "Count" FROM w WHERE regexp_full_match(w, '[a-z]{{3,}}') AND w NOT IN ({STOP})
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""",
    "top_words": ngrams(1),
    "top_bigrams": ngrams(2),
    "top_trigrams": ngrams(3),
    "company_risk_score": f"{RISK} {RISK_OUT}",
    "top_risk_companies": f'{RISK} {RISK_OUT} ORDER BY score DESC, "Company" LIMIT 20',
    "risk_level_counts": f'{RISK} SELECT lvl AS "Risk_Level", {ROWS} AS "Count" FROM risk GROUP BY 1',
    "risk_breakdown_unpivot": f"""{RISK} SELECT "Company", 'Complaint_Score' AS "Factor", round(cs, 6) AS "Score" FROM risk
UNION ALL SELECT "Company", 'Untimely_Score', round(us, 6) FROM risk UNION ALL SELECT "Company", 'Delay_Score', round(ds, 6) FROM risk""",
    "driver_analysis": f"""{DRIVERS} SELECT {DRIVER_OUT} FROM dr
  WHERE p IN (SELECT p FROM dr GROUP BY 1 ORDER BY sum(n) DESC, 1 LIMIT 10)""",
    "top_complaint_drivers": f"{DRIVERS} SELECT {DRIVER_OUT} FROM dr ORDER BY n DESC, p, i, s LIMIT 25",
    "product_driver_summary": f"""{DRIVERS}, r AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY n DESC, i, s) AS rn FROM dr)
SELECT {DRIVER_OUT} FROM r WHERE rn <= 3""",
    "driver_rollup": f"""{CASES} SELECT "Product", "Issue", "Sub-issue", {ROWS} AS "Complaints",
  CAST(grouping("Product", "Issue", "Sub-issue") AS BIGINT) AS "Level" FROM cases GROUP BY ROLLUP ("Product", "Issue", "Sub-issue")""",
    "product_growth": CASES + growth_cte('"Product"', P.growth_floor, "pg") + growth_out("pg", "Product"),
    "issue_growth": CASES + growth_cte('"Issue"', P.growth_floor, "ig") + growth_out("ig", "Issue"),
    "emerging_keys": CASES + growth_cte("""concat_ws(' / ', "Company", "Submitted via", "Issue")""", 1, "eg")
    + growth_out("eg", "Route", "lbl = 'New / Emerging'"),
    "monthly_trend": f"{CASES} {MONTHLY_OUT}",
    "last_n_months": f"{CASES} {MONTHLY_OUT} ORDER BY 1 DESC, 2 DESC LIMIT 60",
    "complaint_forecast": f"{CASES}{fit_cte()} {forecast_out()}",
    "forecast_by_company": f"""{CASES}{fit_cte('"Company"')} {forecast_out('Company')}""",
    "forecast_validation": f"""{CASES}{fit_cte()} SELECT round(mae, 6) AS "Validation_MAE", round(mape, 6) AS "Validation_MAPE",
  CASE WHEN mape < 10 THEN 'Excellent' WHEN mape < 20 THEN 'Good' WHEN mape < 30 THEN 'Acceptable' ELSE 'Poor' END
  AS "Forecast_Quality" FROM val""",
    "forecast_summary": f"{CASES}{fit_cte()}{FSUM_CTE} {fsum_out()}",
    "forecast_summary_by_product": f"""{CASES}{fit_cte('"Product"')}{FSUM_CTE} {fsum_out('Product')}""",
    "recommendations": f"{RECS} {REC_OUT}",
    "high_priority": f"{RECS} {REC_OUT} WHERE priority = 'High'",
    "action_plan": f"""{RECS}, plan AS (SELECT rec.*, CASE category WHEN 'Forecast' THEN 1 WHEN 'Company Risk' THEN 2
  WHEN 'Complaint Driver' THEN 3 WHEN 'Issue Growth' THEN 4 WHEN 'Product Growth' THEN 5 END AS ord FROM rec WHERE seq = 1)
SELECT CAST(row_number() OVER (ORDER BY ord) AS INTEGER) AS "Action_Rank", category AS "Focus_Area", entity AS "Target",
  signal AS "Why_It_Matters", recommendation AS "Recommended_Action" FROM plan""",
    "recommendation_summary": f"""{RECS} SELECT {ROWS} AS "Total_Recommendations",
  CAST(count(*) FILTER (WHERE priority = 'High') AS BIGINT) AS "High_Priority",
  CAST(count(DISTINCT category) AS BIGINT) AS "Categories" FROM rec""",
    "executive_rollup": f"""{RECS} SELECT
  (SELECT "Company" FROM risk ORDER BY score DESC, 1 LIMIT 1) AS "Top_Risk_Company",
  (SELECT round(score, 6) FROM risk ORDER BY score DESC, "Company" LIMIT 1) AS "Top_Risk_Score",
  (SELECT p FROM dr ORDER BY n DESC, p, i, s LIMIT 1) AS "Top_Driver_Product",
  (SELECT i FROM dr ORDER BY n DESC, p, i, s LIMIT 1) AS "Top_Driver_Issue",
  (SELECT n FROM dr ORDER BY n DESC, p, i, s LIMIT 1) AS "Top_Driver_Complaints",
  (SELECT k FROM pg ORDER BY g DESC, k LIMIT 1) AS "Fastest_Product",
  (SELECT round(g, 6) FROM pg ORDER BY g DESC, k LIMIT 1) AS "Fastest_Product_Growth",
  (SELECT k FROM ig ORDER BY g DESC, k LIMIT 1) AS "Fastest_Issue",
  (SELECT round(g, 6) FROM ig ORDER BY g DESC, k LIMIT 1) AS "Fastest_Issue_Growth",
  trend AS "Forecast_Trend", CAST(n1 AS BIGINT) AS "Next_Month_Forecast", round(chg, 6) AS "Expected_Change_Pct" FROM fsum""",
    "preprocess": f"""{PREPROCESS} SELECT "Product", "Sub-product", "Issue", "Sub-issue", narrative AS "Consumer complaint narrative",
  "Company public response", "Company", "State", "ZIP code", "Tags", "Submitted via", "Company response to consumer",
  "Timely response?", "Complaint ID", {FEATURES_PRE} FROM pre""",
    "trim_fill": f'{PREPROCESS} SELECT "Product", "Issue", "Sub-issue", "State", "Tags", {ROWS} AS "Count" FROM pre GROUP BY 1, 2, 3, 4, 5',
    "date_parts": f'{CASES} SELECT "Complaint ID", "Year", "Month", "Quarter", "Day", "Day_Name" FROM cases',
    "resolution_delay": f'{CASES} SELECT "Complaint ID", "Resolution_Delay" FROM cases',
    "text_features": """WITH f AS (SELECT doc_id, text, CAST(len(regexp_extract_all(text, '\\S+')) AS INTEGER) AS n FROM documents)
SELECT doc_id, CAST(text IS NOT NULL AS INTEGER) AS "Has_Narrative", CAST(length(text) AS INTEGER) AS "Narrative_Length",
  n AS "Narrative_Word_Count", CASE WHEN n <= 50 THEN 'Low' WHEN n <= 150 THEN 'Medium' ELSE 'High' END AS "Complexity" FROM f""",
    "value_replace": f"""{CASES} SELECT "Complaint ID", CASE "Tags" WHEN 'BUILDING' THEN 'Builders' WHEN 'MACHINERY' THEN 'Machine makers'
  ELSE "Tags" END AS "Consumer_Group" FROM cases""",
    "dedupe_first": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
  l_returnflag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_returnflag) = 1""",
    "clean_text": f"SELECT * FROM (SELECT doc_id, {CLEAN} AS clean_text FROM documents) WHERE length(clean_text) > 0",
    "null_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS "Column", CAST(count(*) - count({c}) AS BIGINT) AS "Missing_Count",
  round_even((count(*) - count({c})) / count(*) * 100, 2) AS "Missing_Percentage" FROM {DOCS_LABELS}""" for c in NULL_COLUMNS),
    "duplicate_rows": f"""SELECT {ROWS} AS "Rows", CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents))
  AS BIGINT) AS "Duplicate_Rows" FROM documents""",
    "distinct_and_nulls": " UNION ALL ".join(
        f"""SELECT '{c}' AS "Column", CAST(count(DISTINCT {c}) AS BIGINT) AS "Distinct_Values",
  round((count(*) - count({c})) / count(*), 6) AS "Null_Share" FROM {DOCS_LABELS}""" for c in ("lang", "source", "quality", "toxic")),
    "counts_with_nulls": f'SELECT quality, {ROWS} AS "Count" FROM {DOCS_LABELS} GROUP BY 1',
    **{name: f"""{head} SELECT CAST(count(v) AS BIGINT) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
  round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max FROM x"""
       for name, head in (
           ("describe_delay", CASES + ', x AS (SELECT "Resolution_Delay" AS v FROM cases)'),
           ("describe_price", "WITH x AS (SELECT l_extendedprice AS v FROM lineitem)"),
           ("describe_text_length", "WITH x AS (SELECT CAST(length(text) AS INTEGER) AS v FROM documents)"))},
    "date_range": f"""{PREPROCESS} SELECT strftime(min(received), '%Y-%m-%d %H:%M:%S') AS "First",
  strftime(max(received), '%Y-%m-%d %H:%M:%S') AS "Last", CAST(count(*) - count(received) AS BIGINT) AS "Unparsed" FROM pre""",
    "canonicalize": f"""{NAMED}, c AS (SELECT "Product", "Issue", count(*) AS n FROM named GROUP BY 1, 2)
SELECT "Product", "Issue", coalesce(p.canonical, "Product") AS "Product_canonical", coalesce(i.canonical, "Issue") AS "Issue_canonical",
  CAST(n AS BIGINT) AS "Count" FROM c LEFT JOIN tax p ON p.field = 'Product' AND p.raw_label = "Product"
  LEFT JOIN tax i ON i.field = 'Issue' AND i.raw_label = "Issue\"""",
    "canonicalize_by_table": f"""{NAMED} SELECT coalesce(canonical, "Issue") AS "Issue_canonical", {ROWS} AS "Count" FROM named
  LEFT JOIN tax ON field = 'Issue' AND raw_label = "Issue" GROUP BY 1""",
    "product_taxonomy_audit": audit("Product"),
    "taxonomy_audit": audit("Issue"),
    "taxonomy_merged_groups": f"""{NAMED}, sup AS (SELECT "Issue" AS label, {ROWS} AS support, any_value(coalesce(canonical, "Issue")) AS c
  FROM named LEFT JOIN tax ON field = 'Issue' AND raw_label = "Issue" GROUP BY 1),
a AS (SELECT *, sum(support) OVER (PARTITION BY c) AS total, count(*) OVER (PARTITION BY c) AS k FROM sup)
SELECT c AS canonical_label, label, support, CAST(total AS BIGINT) AS combined_support FROM a WHERE k > 1""",
    "taxonomy_report": f"""{NAMED}, t AS (SELECT * FROM tax WHERE field = 'Issue'),
s AS (SELECT coalesce(canonical, "Issue") AS c, count(*) AS n FROM named LEFT JOIN t ON raw_label = "Issue" GROUP BY 1)
SELECT canonical AS canonical_label, string_agg(raw_label, '; ' ORDER BY raw_label) AS raw_labels, {ROWS} AS raw_label_count,
  any_value(confidence) AS confidence, any_value(rationale) AS rationale, CAST(coalesce(any_value(n), 0) AS BIGINT) AS support
  FROM t LEFT JOIN s ON c = canonical GROUP BY canonical""",
    "confusion_pairs": f"{PAIRS} SELECT y_true AS true_label, y_pred AS predicted_label, n FROM pairs",
    "confusion_matrix": f"""{PAIRS}, labs AS (SELECT type AS l FROM pred UNION SELECT type_pred FROM pred) SELECT l AS true_label, {', '.join(
        f"CAST(count(type) FILTER (WHERE type_pred = '{t}') AS BIGINT) AS " + chr(34) + t + chr(34) for t in TYPES)}
  FROM labs LEFT JOIN pred ON type = l GROUP BY 1""",
    "accuracy": f"{PAIRS} SELECT round(sum(n) FILTER (WHERE y_true = y_pred) / sum(n), 6) AS accuracy FROM pairs",
    "per_class_report": f"""{PAIRS} SELECT label, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1_score,
  CAST(support AS BIGINT) AS support FROM pc""",
    "macro_weighted": f"""{PAIRS} SELECT (SELECT round(sum(n) FILTER (WHERE y_true = y_pred) / sum(n), 6) FROM pairs) AS accuracy,
  round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1, round(avg(pr), 6) AS macro_precision,
  round(avg(rc), 6) AS macro_recall FROM pc""",
    "confused_pairs": f"""{PAIRS}, top AS (SELECT * FROM pairs WHERE y_true <> y_pred ORDER BY n DESC, y_true, y_pred LIMIT 10),
w AS (SELECT *, list_sort(list_distinct(list_intersect(string_split(lower(y_true), ' '), string_split(lower(y_pred), ' ')))) AS sh,
  len(list_distinct(string_split(lower(y_true), ' ') || string_split(lower(y_pred), ' '))) AS u FROM top)
SELECT y_true AS true_label, y_pred AS predicted_label, n AS count, 'Model struggles to distinguish ''' || y_true || ''' from ''' || y_pred ||
  CASE WHEN len(sh) / u >= 0.5 THEN {text(evaluate.SAME_WORDING[0])} || array_to_string(sh, ', ') || {text(evaluate.SAME_WORDING[1])}
  ELSE {text(evaluate.OTHER_WORDING)} END AS explanation FROM w""",
    "top_k_accuracy": f"""{PROBS}, tr AS (SELECT vec_id, p, idx FROM probs WHERE idx = label),
rank AS (SELECT tr.vec_id, 1 + count(*) FILTER (WHERE probs.p > tr.p OR (probs.p = tr.p AND probs.idx > tr.idx)) AS r
  FROM tr JOIN probs ON probs.vec_id = tr.vec_id GROUP BY 1)
SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN r <= k THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM rank, (VALUES (1), (3), (5)) v(k) GROUP BY 1""",
    "canonical_probabilities": f"{PROBS} SELECT vec_id, label, round(conf, 6) AS confidence FROM can",
    "confidence_decision": f"""{PROBS} SELECT a.vec_id, a.label, round_even(a.conf, 4) AS confidence, raw AS raw_label,
  CASE WHEN a.conf >= 0.55 THEN 'AUTO_ACCEPT' ELSE 'HUMAN_REVIEW' END AS decision, b.label AS alternative_1_label,
  round_even(b.conf, 4) AS alternative_1_confidence, c.label AS alternative_2_label, round_even(c.conf, 4) AS alternative_2_confidence
  FROM rk a JOIN rk b ON b.vec_id = a.vec_id AND b.rn = 2 JOIN rk c ON c.vec_id = a.vec_id AND c.rn = 3
  JOIN am ON am.vec_id = a.vec_id JOIN cls ON cls.idx = am.idx WHERE a.rn = 1""",
    "decision_counts": f"""{PROBS} SELECT CASE WHEN conf >= 0.55 THEN 'AUTO_ACCEPT' ELSE 'HUMAN_REVIEW' END AS "Decision", {ROWS} AS "Count"
  FROM rk WHERE rn = 1 GROUP BY 1""",
    "multi_issue_candidates": f"""{PROBS} SELECT vec_id, CAST(rn AS INTEGER) AS position, label, round_even(conf, 4) AS confidence,
  true AS is_heuristic FROM rk WHERE conf / best >= 0.35 AND rn <= 3""",
    "document_topic": f"{PROBS} SELECT vec_id, CAST(idx AS INTEGER) AS topic_id, round(p, 6) AS confidence FROM am",
    "topic_prevalence": f"{PROBS}{prevalence('pv', 'true')} SELECT CAST(topic_id AS INTEGER) AS topic_id, round(share, 6) AS share FROM pv",
    "recurring_themes": f"""{PROBS}{prevalence('pv', 'true')} SELECT CAST(topic_id AS INTEGER) AS topic_id, round_even(share, 4) AS share,
  'Topic ' || topic_id AS label FROM pv""",
    "emerging_topics": f"""{PROBS}{prevalence('cu', 'NOT label < 5')}{prevalence('ba', 'label < 5')}
SELECT CAST(topic_id AS INTEGER) AS topic_id, round_even(cu.share, 4) AS current_share, round_even(ba.share, 4) AS baseline_share,
  round_even(cu.share - ba.share, 4) AS absolute_growth, 'Topic ' || topic_id AS label FROM cu JOIN ba USING (topic_id)
  WHERE cu.share - ba.share >= {P.emerging_growth}""",
    "seeded_sample": "SELECT doc_id, lang AS \"Product\" FROM documents ORDER BY md5('42:' || doc_id) LIMIT 300",
    "stratified_split": """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id)) AS rn,
  round_even(count(*) OVER (PARTITION BY lang) * 0.2, 0) AS q FROM documents)
SELECT doc_id, lang AS "Product", CASE WHEN rn <= q THEN 'test' ELSE 'train' END AS part FROM r""",
    "rare_class_filter": """SELECT doc_id, lang AS "Product" FROM documents
  WHERE lang IN (SELECT lang FROM documents GROUP BY 1 HAVING count(*) >= 100)""",
    "similar_topn": SIMILAR,
    "tfidf_weights": f"""WITH d0 AS (SELECT doc_id, {TOKENS} AS tok FROM documents),
d1 AS (SELECT doc_id, unnest(tok || list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])) AS term FROM d0),
c AS (SELECT doc_id, term, count(*) AS n FROM d1 GROUP BY 1, 2),
v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM c GROUP BY 1 HAVING count(*) >= 3
  QUALIFY row_number() OVER (ORDER BY sum(n) DESC, term) <= 2000),
w AS (SELECT doc_id, term, n * idf AS w FROM c JOIN v USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
    "narrative_issue_length": mean_words("Issue") + " ORDER BY 2 DESC, 1 LIMIT 15",
    "column_fallback": """SELECT p_type AS "Product", round(avg(length(text)), 6) AS "Avg_Word_Count"
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN documents ON l_orderkey = doc_id GROUP BY 1""",
    "narrative_extract": """SELECT doc_id, lang AS "Product", source AS "Issue" FROM documents JOIN labels USING (doc_id)
  WHERE quality IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL""",
    "report_rows": f"""{PAIRS} SELECT label, round(pr, 2) AS precision, round(rc, 2) AS recall, round(f1, 2) AS f1_score,
  CAST(support AS BIGINT) AS support FROM pc""",
    "report_headlines": f"""{PAIRS} SELECT 'new' AS format, round((SELECT sum(n) FILTER (WHERE y_true = y_pred) / sum(n) FROM pairs), 4) AS accuracy,
  round(sum(f1 * support) / sum(support), 4) AS weighted_f1, round(avg(f1), 4) AS macro_f1, round(avg(pr), 4) AS macro_precision,
  round(avg(rc), 4) AS macro_recall FROM pc""",
    "training_class_counts": f"""{NAMED} SELECT CAST(count(DISTINCT "Issue") AS BIGINT) AS raw_classes,
  CAST(count(DISTINCT {canonical('"Issue"', 'Issue')}) AS BIGINT) AS canonical_classes FROM named""",
    "class_balance": f"""WITH c AS (SELECT lang AS label, {ROWS} AS n FROM documents GROUP BY 1)
SELECT label, n, round((SELECT avg(n) FROM c) / n, 6) AS weight FROM c""",
}


SHORT_LINES = """both_kinds AS (SELECT * FROM pre UNION ALL SELECT DATE '2021-05-01', NULL, n_name, 'Unknown', 'Unknown', 'Unknown', NULL,
  'No public response', NULL, 'Unknown', 'Unknown', 'Normal Consumer', NULL, 'Unknown', NULL, NULL FROM nation)"""
ORACLE["csv_ingest"] = f"{PREPROCESS}, {SHORT_LINES}" + ORACLE["preprocess"].removeprefix(PREPROCESS).replace("FROM pre", "FROM both_kinds")


def first_of_each_id(sql: str) -> str:
    """A statement over ``cases`` with only the first row of each id."""
    assert sql.startswith(CASES)
    order = ", ".join(f'"{c}" NULLS FIRST' for c in STEP_ORDER)
    return (CASES.replace("WITH cases AS", "WITH deliveries AS") + f""", cases AS (SELECT * FROM deliveries
  QUALIFY row_number() OVER (PARTITION BY "Complaint ID" ORDER BY {order}) = 1)""" + sql[len(CASES):])


ORACLE |= {f"stepwise_{name}": first_of_each_id(ORACLE[query]) for name, query in {
    "kpis": "kpis", "company_risk": "company_risk_score", "product_growth": "product_growth", "recommendations": "recommendations"}.items()}
