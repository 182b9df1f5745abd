"""SQL of the episode engine for DuckDB: the state machine goes step by step in a recursive query, unlike the engine, which goes by cuts."""

from __future__ import annotations

from flowmark.plans.measurement import _J, _PERIOD, _W

_HOURS = "CASE {p} WHEN 'AM' THEN 3.0 WHEN 'MD' THEN 6.0 WHEN 'PM' THEN 4.0 ELSE 11.0 END"

#: Daily series (weekdays) with free-flow speed, flow on the S3 curve and capacity.
DAILY = f"""{_J}, ser AS (SELECT tmc_code, slot_s // 86400 AS day, CAST(slot_s % 86400 // 60 AS BIGINT) AS t_min, speed, vf, 2000.0 AS cap,
  least(least(speed, vf * 0.99) * (2000.0 / (vf * 0.7)) * pow(greatest(pow(greatest(vf / greatest(least(speed, vf * 0.99), 1), 1.00001), 1.95) - 1, 1e-8), 1 / 3.9), 2000.0) AS flow
  FROM s JOIN v USING (tmc_code) WHERE (slot_s // 86400 + 3) % 7 < 5)"""

#: The average weekday; no flow and no capacity.
WEEKDAY = f"""{_W}, v AS (SELECT tmc_code, least(greatest(quantile_cont(speed, 0.85), 35), 85) AS vf FROM s GROUP BY tmc_code),
ser AS (SELECT tmc_code, CAST(0 AS BIGINT) AS day, CAST(t_min AS BIGINT) AS t_min, speed, vf, NULL::DOUBLE AS cap, NULL::DOUBLE AS flow FROM p JOIN v USING (tmc_code))"""


def episodes(series: str) -> str:
    """CTEs that end in `ep`, one row per episode of the series `ser`."""
    return f"""{series},
ends AS (SELECT tmc_code, day, min(t_min) AS a, max(t_min) AS b, any_value(vf) AS vf FROM ser GROUP BY tmc_code, day),
steps AS (SELECT tmc_code, day, vf, vf * 0.7 AS lim, a, (b - a) // 15 + 1 AS n, unnest(range(0, (b - a) // 15 + 1)) AS i FROM ends),
x AS (SELECT steps.tmc_code, steps.day, steps.vf, lim, n, i, a + i * 15 AS t, speed AS v, flow AS q, cap FROM steps LEFT JOIN ser ON ser.tmc_code = steps.tmc_code AND ser.day = steps.day AND ser.t_min = a + i * 15),
y AS (SELECT *, lag(v) OVER o AS v0, lead(v) OVER o AS v1 FROM x WINDOW o AS (PARTITION BY tmc_code, day ORDER BY i)),
z AS (SELECT *, CASE WHEN v > lim AND v1 <= lim THEN 'B' WHEN v > lim AND v - v0 <= -10 THEN 'B' WHEN v > lim AND v - v0 >= 8 THEN 'R' WHEN v <= 0.5 * lim THEN 'S' WHEN v <= lim THEN 'C' WHEN v >= 0.85 * vf THEN 'F' ELSE 'N' END AS state,
        coalesce(v1 < lim, false) AS opens, CASE WHEN v IS NULL THEN v0 WHEN v0 IS NULL THEN v ELSE (v + v0) / 2 END AS recent FROM y),
machine AS (
  SELECT tmc_code, day, n, i, CASE WHEN state IN ('C', 'S', 'B') AND opens THEN i END AS start, state IN ('C', 'S', 'B') AND NOT opens AS seen, i AS last, 0 AS quiet, NULL::BIGINT AS from_i, NULL::BIGINT AS to_i FROM z WHERE i = 0
  UNION ALL
  SELECT m.tmc_code, m.day, m.n, z.i,
    CASE WHEN m.start IS NULL THEN CASE WHEN (m.seen OR state IN ('C', 'S', 'B')) AND opens THEN z.i END WHEN over THEN NULL ELSE m.start END,
    CASE WHEN m.start IS NULL THEN (m.seen OR state IN ('C', 'S', 'B')) AND NOT opens WHEN over THEN state IN ('C', 'S', 'B') ELSE false END,
    CASE WHEN m.start IS NULL OR NOT over THEN z.i ELSE m.last END,
    CASE WHEN m.start IS NULL OR state IN ('C', 'S', 'B', 'R') THEN 0 ELSE m.quiet + 1 END,
    CASE WHEN m.start IS NOT NULL AND over THEN m.start END, CASE WHEN m.start IS NOT NULL AND over THEN greatest(m.start, z.i - m.quiet) END
  FROM machine m JOIN z ON z.tmc_code = m.tmc_code AND z.day = m.day AND z.i = m.i + 1,
  LATERAL (SELECT state NOT IN ('C', 'S', 'B', 'R') AND m.quiet + 1 > 1 AND NOT coalesce(recent <= lim, false) AS over)),
raw AS (SELECT tmc_code, day, from_i AS a, to_i AS b FROM machine WHERE from_i IS NOT NULL UNION ALL SELECT tmc_code, day, start, last FROM machine WHERE start IS NOT NULL AND i = n - 1),
isl AS (SELECT *, sum(CASE WHEN b0 IS NULL OR a - b0 - 1 > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY tmc_code, day ORDER BY a) AS g FROM (SELECT *, max(b) OVER (PARTITION BY tmc_code, day ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b0 FROM raw)),
bnd AS (SELECT tmc_code, day, min(a) AS a, max(b) AS b FROM isl GROUP BY tmc_code, day, g HAVING (max(b) - min(a) + 1) * 15 >= 30),
low AS (SELECT b.tmc_code, b.day, b.a, b.b, arg_min(z.i, (z.v, z.i)) FILTER (z.v IS NOT NULL) AS t2, min(z.v) AS lowest, any_value(z.vf) AS vf, any_value(z.lim) AS lim, any_value(z.n) AS n
        FROM bnd b JOIN z ON z.tmc_code = b.tmc_code AND z.day = b.day AND z.i BETWEEN b.a AND b.b GROUP BY ALL HAVING count(z.v) > 0),
near AS (SELECT l.*, list(v ORDER BY i) FILTER (i <= a) AS va, list(v ORDER BY i) FILTER (i >= b) AS vb FROM low l JOIN z ON z.tmc_code = l.tmc_code AND z.day = l.day AND (z.i BETWEEN l.a - 2 AND l.a OR z.i BETWEEN l.b AND l.b + 2) GROUP BY ALL),
rep AS (SELECT *, least(1.25 * vf, 90) AS top, va[-1] AS p0, va[-2] AS p1, va[-3] AS p2, vb[1] AS q0, vb[2] AS q1, vb[3] AS q2 FROM near),
edge AS (SELECT *, CASE WHEN p0 BETWEEN 0 AND top THEN 0 WHEN p1 BETWEEN lim AND top AND p1 >= 0 THEN 1 WHEN p2 BETWEEN lim AND top AND p2 >= 0 THEN 2 END AS k0,
        CASE WHEN q0 BETWEEN 0 AND top THEN 0 WHEN q1 BETWEEN greatest(lim, lowest) AND top THEN 1 WHEN q2 BETWEEN greatest(lim, lowest) AND top THEN 2 END AS k3 FROM rep),
e3 AS (SELECT *, a - coalesce(k0, 0) AS s0, b + coalesce(k3, 0) AS s3, CASE k3 WHEN 0 THEN q0 WHEN 1 THEN q1 WHEN 2 THEN q2 END AS v3,
        CASE WHEN k0 = 0 THEN 'post_qc' WHEN k0 > 0 THEN 'shifted_post_qc' ELSE 'missing' END AS src0, CASE WHEN k3 = 0 THEN 'post_qc' WHEN k3 > 0 THEN 'shifted_post_qc' ELSE 'missing' END AS src3 FROM edge),
part AS (SELECT e.tmc_code, e.day, e.a, min(z.v) AS low_v, sum(greatest(0, e.lim - z.v)) * 15 AS severity, max(z.i) FILTER (state = 'S') - min(z.i) FILTER (state = 'S') + 1 AS sev, sum(z.q) * 0.25 AS demand, median(z.cap) AS lane,
        min(z.t) FILTER (z.i = e.s0) AS t0, min(z.t) FILTER (z.i = e.t2) AS tt2, min(z.t) FILTER (z.i = e.s3) AS t3,
        count(*) FILTER (z.i > e.t2 AND z.v < e.lim) AS n_dis, median(z.q) FILTER (z.i > e.t2 AND z.v < e.lim) AS mu, list(z.q ORDER BY z.i) FILTER (z.i > e.t2 AND z.v < e.lim AND z.q IS NOT NULL) AS qs
        FROM e3 e JOIN z ON z.tmc_code = e.tmc_code AND z.day = e.day AND z.i BETWEEN e.s0 AND e.s3 GROUP BY ALL),
w2 AS (SELECT e3.*, p.* EXCLUDE (tmc_code, day, a), {_PERIOD.format(m='tt2')} AS period, (e3.s3 - e3.s0 + 1) * 15.0 AS minutes FROM e3 JOIN part p ON p.tmc_code = e3.tmc_code AND p.day = e3.day AND p.a = e3.a),
w3 AS (SELECT *, lane * {_HOURS.format(p='period')} AS volume, len(qs) AS nq, CASE WHEN len(qs) > 1 THEN list_avg([CASE WHEN qs[j + 1] >= qs[j] THEN 1.0 ELSE 0.0 END FOR j IN range(1, len(qs))]) END AS rising FROM w2),
ep AS (SELECT tmc_code, CAST(day AS BIGINT) AS day, t0 AS t0_min, tt2 AS t2_min, t3 AS t3_min, minutes, low_v AS min_speed, severity, coalesce(sev, 0) * 15.0 AS severe_min, vf, lim AS "limit", period, demand, volume AS capacity,
        CASE WHEN volume > 0 THEN demand / volume END AS doc, mu, n_dis * 15.0 AS discharge_min,
        coalesce(minutes >= 30 AND low_v < lim AND n_dis * 15 >= 30 AND nq > 1 AND (rising >= 0.6 OR qs[nq] >= qs[1]) AND v3 - lowest >= 0, false) AS valid_for_mu,
        src0 AS t0_source, s0 - a AS t0_shift, src3 AS t3_source, s3 - b AS t3_shift, v3 AS t3_speed FROM w3)"""


COLUMNS = """SELECT tmc_code, day, t0_min, t2_min, t3_min, round(minutes, 8) AS minutes, round(min_speed, 8) AS min_speed, round(severity, 8) AS severity, severe_min, round(vf, 8) AS vf, round("limit", 8) AS "limit", period,
round(demand, 6) AS demand, capacity, round(doc, 8) AS doc, round(mu, 8) AS mu, discharge_min, valid_for_mu, t0_source, t0_shift, t3_source, t3_shift, round(t3_speed, 8) AS t3_speed FROM ep"""

DETECT = f"WITH RECURSIVE {episodes(DAILY)} {COLUMNS}"
DETECT_WEEKDAY = f"WITH RECURSIVE {episodes(WEEKDAY)} {COLUMNS}"

#: Physical rules, robust scores and regimes of the daily episodes, without the rules that need fitted lines.
RULES = f"""WITH RECURSIVE {episodes(DAILY)},
m1 AS (SELECT period, median(minutes) AS mm, median(doc) AS md, count(*) AS n, count(doc) AS nd FROM ep WHERE valid_for_mu GROUP BY period),
m2 AS (SELECT ep.period, median(abs(minutes - mm)) * 1.4826 AS sm, median(abs(doc - md)) * 1.4826 AS sd FROM ep JOIN m1 ON m1.period = ep.period WHERE valid_for_mu GROUP BY ep.period),
sc AS (SELECT ep.*, CASE WHEN n >= 10 AND sm > 0 THEN (minutes - mm) / sm END AS zm, CASE WHEN nd >= 10 AND sd > 0 THEN (doc - md) / sd END AS zd FROM ep LEFT JOIN m1 ON m1.period = ep.period LEFT JOIN m2 ON m2.period = ep.period),
ru AS (SELECT *, concat_ws(';', CASE WHEN minutes IS NULL OR doc IS NULL OR min_speed IS NULL THEN 'state_nonfinite' END, CASE WHEN minutes > 1440 THEN 'duration_exceeds_day' END, CASE WHEN doc > 8 THEN 'doc_above_physical' END,
  CASE WHEN min_speed < 0 OR min_speed > 90 THEN 'speed_out_of_range' END, CASE WHEN mu <= 0 THEN 'mu_nonpositive' END, CASE WHEN doc > 1 AND minutes < 15 THEN 'doc_high_P_zero' END, CASE WHEN mu > 2100 THEN 'mu_above_capacity' END,
  CASE WHEN doc > 1.5 AND mu < 600 THEN 'mu_starved' END, CASE WHEN min_speed >= "limit" THEN 'vt2_above_threshold' END, CASE WHEN min_speed < 5 THEN 'vt2_too_low' END) AS hard,
  concat_ws(';', CASE WHEN doc < 0.5 AND minutes > 60 THEN 'low_doc_long' END, CASE WHEN zm > 3.5 THEN 'duration_outlier' END, CASE WHEN zd > 3.5 THEN 'doc_outlier' END) AS soft,
  coalesce(doc < 0.5 AND minutes > 60, false)::INT + coalesce(zm > 3.5, false)::INT + coalesce(zd > 3.5, false)::INT AS n_soft FROM sc)
SELECT tmc_code, day, t0_min, hard, soft, hard <> '' OR n_soft >= 2 AS excluded, valid_for_mu AND NOT (hard <> '' OR n_soft >= 2) AS clean, round(zm, 8) AS z_minutes,
CASE WHEN minutes < 30 OR min_speed >= "limit" THEN 'uncongested' WHEN abs(zm) > 2.5 THEN 'event' WHEN minutes >= 120 AND min_speed < 0.5 * "limit" THEN 'severe' WHEN minutes >= 60 THEN 'recurring' ELSE 'mild' END AS regime FROM ru"""

#: Greedy choice: intervals in order of priority, the accepted ones carried along as a list.
SELECTION = """WITH RECURSIVE o AS (SELECT t2_id AS id, link_id, period, t0_hour AS t0, t3_hour AS t3, row_number() OVER (PARTITION BY link_id, period ORDER BY min_speed_mph ASC NULLS LAST, p_hr DESC NULLS LAST, t2_hour ASC NULLS LAST, t2_id) AS k
  FROM link_t2 WHERE link_id IS NOT NULL),
c(link_id, period, k, id, selected, reason, taken) AS (
  SELECT link_id, period, 0::BIGINT, NULL::BIGINT, NULL::BOOLEAN, NULL::VARCHAR, []::STRUCT(a DOUBLE, z DOUBLE, i BIGINT)[] FROM (SELECT DISTINCT link_id, period FROM o)
  UNION ALL
  SELECT c.link_id, c.period, o.k, o.id, ok AND clash IS NULL, CASE WHEN NOT ok THEN 'invalid_bounds' WHEN clash IS NULL THEN 'accepted' ELSE 'overlaps:' || clash.i END,
    CASE WHEN ok AND clash IS NULL THEN list_append(c.taken, {'a': o.t0, 'z': o.t3, 'i': o.id}) ELSE c.taken END
  FROM c JOIN o ON o.link_id = c.link_id AND o.period IS NOT DISTINCT FROM c.period AND o.k = c.k + 1,
  LATERAL (SELECT coalesce(o.t3 > o.t0, false) AS ok, list_sort(list_filter(c.taken, lambda x: o.t0 < x.z AND o.t3 > x.a))[1] AS clash))
SELECT id, selected, reason FROM c WHERE k > 0"""


def line(name: str, source: str, low: str = "-infinity", high: str = "infinity", scale: float | None = None, least: int = 3) -> str:
    """CTEs that end in `name` (g, n, a, b, mad): a robust line per group g of source (g, x, y), reweighted step by step in a recursive query.

    With a scale the loss is soft L1, without one it is Huber's on the running median deviation.
    """
    clip = lambda e: f"least(greatest({e}, '{low}'::DOUBLE), '{high}'::DOUBLE)"
    middle = lambda value, rows: f"SELECT g, min(v) FILTER (cum >= tot / 2.0) AS m FROM (SELECT g, v, sum(w) OVER (PARTITION BY g ORDER BY v ROWS UNBOUNDED PRECEDING) AS cum, sum(w) OVER (PARTITION BY g) AS tot FROM (SELECT g, {value} AS v, w FROM {rows})) GROUP BY g"
    step = f"FROM {name}_r r JOIN {name}_c c ON c.g = r.g WHERE NOT r.done AND r.it < 100"
    if scale is None:
        weighed = f"""SELECT *, w * least(1, 1.35 * greatest(1.4826 * min(CASE WHEN cum >= tot / 2.0 THEN e END) OVER (PARTITION BY g), 1e-9) / greatest(e, 1e-12)) AS k FROM (
      SELECT *, sum(w) OVER (PARTITION BY g ORDER BY e ROWS UNBOUNDED PRECEDING) AS cum, sum(w) OVER (PARTITION BY g) AS tot FROM (SELECT r.g, r.a, r.b, r.it, x, y, w, abs(y - r.a - r.b * x) AS e {step}))"""
    else:
        weighed = f"SELECT r.g, r.a, r.b, r.it, x, y, w / sqrt(1 + ((y - r.a - r.b * x) / {scale}) ** 2) AS k {step}"
    return f"""{name}_c AS (SELECT g, avg(x) AS x, avg(y) AS y, count(*)::DOUBLE AS w FROM {source} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY g, round(x / 0.01), round(y / 0.01)),
{name}_m AS (SELECT g, sum(w * x) / sum(w) AS xm, sum(w * y) / sum(w) AS ym, sum(w) AS n FROM {name}_c GROUP BY g HAVING sum(w) >= {least}),
{name}_s AS (SELECT c.g, any_value(n) AS n, CASE WHEN sum(w * (x - xm) ** 2) > 0 THEN {clip('sum(w * (x - xm) * (y - ym)) / sum(w * (x - xm) ** 2)')} ELSE {clip('1.0')} END AS b FROM {name}_c c JOIN {name}_m m ON c.g = m.g GROUP BY c.g),
{name}_i AS ({middle('y - b * x', f'{name}_c JOIN {name}_s USING (g)')}),
{name}_r AS (SELECT s.g, i.m AS a, s.b AS b, 0 AS it, false AS done FROM {name}_s s JOIN {name}_i i ON s.g = i.g
 UNION ALL SELECT g, ym - b2 * xm, b2, it + 1, abs(ym - b2 * xm - a) + abs(b2 - b) < 1e-10 FROM (
  SELECT g, any_value(a) AS a, any_value(b) AS b, any_value(it) AS it, any_value(xm) AS xm, any_value(ym) AS ym, CASE WHEN sum(k * (x - xm) ** 2) > 0 THEN {clip('sum(k * (x - xm) * (y - ym)) / sum(k * (x - xm) ** 2)')} ELSE any_value(b) END AS b2 FROM (
   SELECT *, sum(k * x) OVER (PARTITION BY g) / sum(k) OVER (PARTITION BY g) AS xm, sum(k * y) OVER (PARTITION BY g) / sum(k) OVER (PARTITION BY g) AS ym FROM ({weighed})) GROUP BY g)),
{name}_e AS (SELECT r.g, s.n, arg_max(r.a, r.it) AS a, arg_max(r.b, r.it) AS b FROM {name}_r r JOIN {name}_s s ON r.g = s.g GROUP BY r.g, s.n),
{name}_d AS ({middle('y - a - b * x', f'{name}_c JOIN {name}_e USING (g)')}),
{name}_q AS (SELECT g, m * 1.4826 AS mad FROM ({middle('abs(y - a - b * x - d.m)', f'{name}_c JOIN {name}_e USING (g) JOIN {name}_d d USING (g)')})),
{name} AS (SELECT e.g, e.n, e.a, e.b, q.mad FROM {name}_e e JOIN {name}_q q ON e.g = q.g)"""


def qvdf(name: str, rows: str, key: str, least: int) -> str:
    """CTEs that end in `name` (g, f_d, n_exp, f_p, s, alpha, beta): both fits of rows (doc, p_hr, min_speed, lim) per key."""
    return f"""{name}_x AS (SELECT {key} AS g, ln(doc) AS ld, ln(p_hr) AS lp, CASE WHEN lim / greatest(min_speed, 1e-6) - 1 > 1e-6 THEN ln(lim / greatest(min_speed, 1e-6) - 1) END AS lr FROM {rows} WHERE doc > 0 AND p_hr > 0),
{name}_x1 AS (SELECT g, ld AS x, lp AS y FROM {name}_x), {name}_x2 AS (SELECT g, lp AS x, lr AS y FROM {name}_x),
{line(f'{name}_1', f'{name}_x1', '1.0', '5.0', 0.20, least)}, {line(f'{name}_2', f'{name}_x2', '0.05', '4.0', 0.25, least)},
{name} AS (SELECT u.g, exp(u.a) AS f_d, u.b AS n_exp, exp(v.a) AS f_p, v.b AS s, 8 / 15 * exp(v.a) * pow(exp(u.a), v.b) AS alpha, u.b * v.b AS beta FROM {name}_1 u JOIN {name}_2 v ON u.g = v.g)"""


_PICK = ", ".join(f"round(coalesce(f.{c}, k.{c}), 5) AS {c}" for c in ("f_d", "n_exp", "f_p", "s", "alpha", "beta"))

CALIBRATION = f"""WITH RECURSIVE {episodes(DAILY)}, er AS (SELECT tmc_code, period, doc, minutes / 60 AS p_hr, min_speed, "limit" AS lim FROM ep), {qvdf('fine', 'er', "tmc_code || '|' || period", 5)}, {qvdf('rough', 'er', 'period', 3)}
SELECT t.tmc_code, t.period, {_PICK}, CASE WHEN f.f_d IS NOT NULL THEN 'sensor_period' WHEN k.f_d IS NOT NULL THEN 'corridor_period' ELSE 'none' END AS scope FROM (SELECT DISTINCT tmc_code, period FROM er) t LEFT JOIN fine f ON f.g = t.tmc_code || '|' || t.period LEFT JOIN rough k ON k.g = t.period"""


def class_calibration(links: str) -> str:
    return f"""WITH RECURSIVE {links}, er AS (SELECT link_type, period, p_hr / 2 AS doc, p_hr, min_speed_mph AS min_speed, 45.0 AS lim FROM link_t2 JOIN lk USING (link_id) WHERE p_hr > 0 AND min_speed_mph > 0 AND link_type IS NOT NULL), {qvdf('fine', 'er', "link_type || '|' || period", 10)}, {qvdf('rough', 'er', 'period', 10)}
SELECT t.link_type AS link_class, t.period, {_PICK}, CASE WHEN f.f_d IS NOT NULL THEN 'class' WHEN k.f_d IS NOT NULL THEN 'all' ELSE 'none' END AS source FROM (SELECT DISTINCT link_type, p.period FROM lk, (VALUES ('AM'), ('MD'), ('PM'), ('NT')) p(period) WHERE link_type IS NOT NULL) t LEFT JOIN fine f ON f.g = t.link_type || '|' || t.period LEFT JOIN rough k ON k.g = t.period"""


_HUBER = {"huber_doc_duration": ("ln(doc)", "ln(minutes)", "doc > 0", "minutes > 0"), "huber_doc_mu": ("ln(doc)", "mu", "doc > 0", "true"), "huber_duration_speed": ("ln(minutes)", "min_speed", "minutes > 0", "true")}
_LINES = ", ".join(f"h{i}_x AS (SELECT period AS g, CASE WHEN {p} THEN {x} END AS x, CASE WHEN {q} THEN {y} END AS y FROM ep), {line(f'h{i}', f'h{i}_x', least=8)}" for i, (x, y, p, q) in enumerate(_HUBER.values()))
_FLAGS = ", ".join(f"coalesce(h{i}.mad > 0 AND abs(CASE WHEN {q} THEN {y} END - h{i}.a - h{i}.b * CASE WHEN {p} THEN {x} END) > 3 * h{i}.mad, false) AS r{i}" for i, (x, y, p, q) in enumerate(_HUBER.values()))
_RULED = RULES[RULES.index("m1 AS") : RULES.rindex("SELECT tmc_code, day")].rstrip()
_HELD = f"hf AS (SELECT ep.*, {_FLAGS} FROM ep " + " ".join(f"LEFT JOIN h{i} ON h{i}.g = ep.period" for i in range(3)) + ")"
_NAMES = ", ".join(f"CASE WHEN r{i} THEN '{n}' END" for i, n in enumerate(_HUBER))

#: All rules, those of fitted lines too.
SCREENED = f"""WITH RECURSIVE {episodes(DAILY)}, {_LINES}, {_HELD}, {_RULED.replace("sc AS (SELECT ep.*,", "sc AS (SELECT hf.*,").replace("FROM ep LEFT JOIN m1 ON m1.period = ep.period LEFT JOIN m2 ON m2.period = ep.period", "FROM hf LEFT JOIN m1 ON m1.period = hf.period LEFT JOIN m2 ON m2.period = hf.period").replace("THEN 'doc_outlier' END) AS soft", f"THEN 'doc_outlier' END, {_NAMES}) AS soft").replace("AS n_soft", "+ r0::INT + r1::INT + r2::INT AS n_soft")}
SELECT tmc_code, day, t0_min, hard, soft, hard <> '' OR n_soft >= 2 AS excluded, valid_for_mu AND NOT (hard <> '' OR n_soft >= 2) AS clean,
CASE WHEN minutes < 30 OR min_speed >= "limit" THEN 'uncongested' WHEN abs(zm) > 2.5 THEN 'event' WHEN minutes >= 120 AND min_speed < 0.5 * "limit" THEN 'severe' WHEN minutes >= 60 THEN 'recurring' ELSE 'mild' END AS regime FROM ru"""

#: A shift that keeps every flow within capacity carries exactly the demand.
CONSERVED = f"""WITH {DAILY}, n AS (SELECT tmc_code, count(DISTINCT t_min) AS n FROM ser WHERE flow IS NOT NULL GROUP BY tmc_code) SELECT tmc_code, CAST(n AS INT) AS n, n * 1800.0 AS demand, n * 1800.0 AS achieved, true AS conserved FROM n"""

_M0, _D0, _D1 = "((y1 - y0) / 25.0)", "((y0 - ya) / 5.0)", "((yb - y1) / 5.0)"
_LIMITED = lambda d: f"(CASE WHEN {_M0} = 0 OR {d} * {_M0} < 0 THEN 0.0 ELSE sign({_M0}) * least(abs({d}), 3 * abs({_M0})) END)"

#: Monotone cubics across the period edges.
EDGES = f"""WITH {DAILY.split(', s AS')[0]}, b AS (SELECT tmc_code AS k, CAST(us // 300000000 * 300 % 86400 // 60 AS BIGINT) AS t_min, avg(speed) AS v FROM r WHERE speed BETWEEN 1 AND 150 AND (us // 300000000 * 300 // 86400 + 3) % 7 < 5 GROUP BY ALL),
w AS (SELECT *, row_number() OVER q AS i, count(*) OVER (PARTITION BY k) AS n, lag(v) OVER q AS va, lead(v) OVER q AS vb FROM b WINDOW q AS (PARTITION BY k ORDER BY t_min)),
e AS (SELECT unnest([360, 540, 900, 1140]) AS e), f AS (SELECT k, e, min(i) FILTER (t_min >= e - 15) AS a, min(i) FILTER (t_min >= e + 10) AS z, any_value(n) AS n FROM w, e GROUP BY k, e),
g AS (SELECT f.k, f.e, p.t_min AS t0, p.v AS y0, p.va AS ya, q.t_min AS t1, q.v AS y1, q.vb AS yb FROM f JOIN w p ON p.k = f.k AND p.i = f.a JOIN w q ON q.k = f.k AND q.i = f.z WHERE f.a >= 2 AND f.z < f.n AND q.t_min - p.t_min = 25),
h AS (SELECT w.k, w.t_min, w.v, (w.t_min - t0) / 25.0 AS u, y0, y1, {_LIMITED(_D0)} AS d0, {_LIMITED(_D1)} AS d1 FROM w LEFT JOIN g ON g.k = w.k AND w.t_min > g.t0 AND w.t_min < g.t1)
SELECT k AS tmc_code, t_min, round(v, 8) AS target, round(CASE WHEN u IS NULL THEN v ELSE (2 * u ** 3 - 3 * u ** 2 + 1) * y0 + (u ** 3 - 2 * u ** 2 + u) * 25 * d0 + (-2 * u ** 3 + 3 * u ** 2) * y1 + (u ** 3 - u ** 2) * 25 * d1 END, 8) AS speed FROM h"""


def _calm(d: str) -> str:
    return f"(sign({d}) * greatest(abs({d}) - 4.0, 0.0))"


def _lasting(d: str) -> str:
    """Whether a change keeps the mean over three steps within 4 mph if it dies down as fast as it may."""
    c, cc = _calm(d), _calm(_calm(d))
    return f"(abs(d2) + abs(d1) + abs({d}) <= 12.000000000001 AND abs(d1) + abs({d}) + abs({c}) <= 12.000000000001 AND abs({d}) + abs({c}) + abs({cc}) <= 12.000000000001)"


_TRIED = "(safe + (want - safe) * ((acc.lo + acc.hi) / 2))"

#: Limited profiles step by step, the share of a change that lasts found by halving; then their greatest changes.
LIMITED = f"""WITH RECURSIVE {DAILY.split(', s AS')[0]}, b AS (SELECT tmc_code AS k, CAST(us // 300000000 * 300 % 86400 // 60 AS BIGINT) AS t_min, avg(speed) AS v FROM r WHERE speed BETWEEN 1 AND 150 AND (us // 300000000 * 300 // 86400 + 3) % 7 < 5 GROUP BY ALL),
w AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY t_min) AS i FROM b),
z(k, i, pos, d1, d2) AS (SELECT k, i, v, 0.0::DOUBLE, 0.0::DOUBLE FROM w WHERE i = 1
 UNION ALL SELECT k, i, pos + d, d, d1 FROM (SELECT k, i, pos, d1, CASE WHEN {_lasting('want')} THEN want ELSE safe + (want - safe) *
   (list_reduce(list_transform(range(0, 31), lambda x: {{'lo': 0.0::DOUBLE, 'hi': 1.0::DOUBLE}}), lambda acc, x: CASE WHEN {_lasting(_TRIED)} THEN {{'lo': (acc.lo + acc.hi) / 2, 'hi': acc.hi}} ELSE {{'lo': acc.lo, 'hi': (acc.lo + acc.hi) / 2}} END)).lo END AS d
  FROM (SELECT z.k, w.i, z.pos, z.d1, z.d2, {_calm('z.d1')} AS safe, least(greatest(w.v - z.pos, z.d1 - 4.0, -8.0), z.d1 + 4.0, 8.0) AS want FROM z JOIN w ON w.k = z.k AND w.i = z.i + 1))),
c AS (SELECT k, i, pos - lag(pos) OVER q AS d FROM z WINDOW q AS (PARTITION BY k ORDER BY i)), e AS (SELECT k, d, avg(abs(d)) OVER (q ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS m, count(d) OVER (q ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n, (d - lag(d) OVER q) * 144 AS a FROM c WINDOW q AS (PARTITION BY k ORDER BY i))
SELECT k AS tmc_code, round(max(abs(d)), 6) AS most_change, round(max(m) FILTER (n = 3), 6) AS most_mean_change, round(max(abs(a)), 4) AS most_acceleration FROM e GROUP BY k"""
