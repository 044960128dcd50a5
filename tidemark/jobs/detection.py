"""Queries over sequence patterns and detection jobs.

On the event table ``signup`` stands for create or login success, ``purchase``
for pay, ``error`` for a failed login or an offline message.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import DAY, EVENTS, HOUR, events, query
from tidemark.operators import automaton
from tidemark.operators import detection as d
from tidemark.operators import patterns as p
from tidemark.operators import windows as w
from tidemark.plans.ordered import running
from tidemark.plans.timing import instant, plain

ORDER = ["pos", "event_id"]


def is_type(kind: str):
    return F.col("event_type") == kind


def slim(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", "event_id", "event_type", "pos")


NEXT_SQL = """
n AS (SELECT *, lead(event_type) OVER w AS nt, lead(pos) OVER w AS np, lead(event_id) OVER w AS nid
      FROM ev {where} WINDOW w AS (PARTITION BY user_id ORDER BY pos, event_id))"""
NEXT_ALL = NEXT_SQL.format(where="")
ORDERS_ONLY = "WHERE event_type IN ('signup', 'purchase')"


@query("pattern_next_within", f"""
WITH {EVENTS}, {NEXT_SQL.format(where=ORDERS_ONLY)}
SELECT user_id, event_id,
       CASE WHEN np IS NULL OR np - pos >= {10 * HOUR} THEN 'timeout' WHEN nt = 'purchase' THEN 'matched' ELSE 'broken' END AS status,
       CASE WHEN np - pos < {10 * HOUR} AND nt = 'purchase' THEN nid END AS next_event_id
FROM n WHERE event_type = 'signup'""")
def pattern_next_within(spark, sf_dir):
    orders = slim(spark, sf_dir).filter("event_type IN ('signup', 'purchase')")
    out = p.next_within(orders, ["user_id"], ORDER, is_type("signup"), is_type("purchase"),
                        "10 hours", ["event_id"])
    return out.select("user_id", "event_id", "status", "next_event_id")


@query("pattern_timeout", f"""
WITH {EVENTS}, {NEXT_ALL}
SELECT user_id, event_id, make_timestamp(pos + {HOUR}) AS timeout_at
FROM n WHERE event_type = 'signup' AND (np IS NULL OR np - pos >= {HOUR})""")
def pattern_timeout(spark, sf_dir):
    ended = F.col("event_type").isin("purchase", "view")
    out = p.next_within(slim(spark, sf_dir), ["user_id"], ORDER, is_type("signup"), ended, "1 hour", [])
    return out.filter(F.col("status") == p.TIMEOUT).select(
        "user_id", "event_id", plain(instant(F.col("pos") + F.lit(HOUR))).alias("timeout_at"))


@query("pattern_followed_by", f"""
WITH {EVENTS},
f AS (SELECT s.user_id, s.event_id, s.pos, arg_min(b.event_id, (b.pos, b.event_id)) AS nid
      FROM ev s LEFT JOIN ev b ON b.user_id = s.user_id AND b.event_type = 'purchase'
           AND (b.pos, b.event_id) > (s.pos, s.event_id) AND b.pos - s.pos < {15 * HOUR}
      WHERE s.event_type = 'signup' GROUP BY ALL)
SELECT user_id, event_id, CASE WHEN nid IS NULL THEN 'timeout' ELSE 'matched' END AS status, nid AS next_event_id FROM f""")
def pattern_followed_by(spark, sf_dir):
    out = p.followed_by(slim(spark, sf_dir), ["user_id"], ORDER, is_type("signup"), is_type("purchase"),
                        "15 hours", ["event_id"])
    return out.select("user_id", "event_id", "status", "next_event_id")


@query("pattern_followed_by_any", f"""
WITH {EVENTS}
SELECT s.user_id, s.event_id AS create_id, b.event_id AS pay_id
FROM ev s JOIN ev b ON b.user_id = s.user_id AND b.pos > s.pos AND b.pos - s.pos < {15 * HOUR}
WHERE s.event_type = 'signup' AND b.event_type = 'purchase'""")
def pattern_followed_by_any(spark, sf_dir):
    from tidemark.jobs.joins import of_type

    out = p.followed_by_any(of_type(spark, sf_dir, "signup", "create"), of_type(spark, sf_dir, "purchase", "pay"),
                            ["user_id"], "create_ts", "pay_ts", "15 hours")
    return out.select("user_id", "create_id", "pay_id")


LOGINS_ONLY = "WHERE event_type IN ('signup', 'error')"


def login_pairs(spark, sf_dir):
    logins = slim(spark, sf_dir).filter("event_type IN ('signup', 'error')")
    out = p.next_within(logins, ["user_id"], ORDER, is_type("error"), is_type("error"),
                        "3 hours", ["event_id", "pos"])
    return out.filter(F.col("status") == p.MATCHED)


@query("login_fail_cep", f"""
WITH {EVENTS}, {NEXT_SQL.format(where=LOGINS_ONLY)}
SELECT user_id, make_timestamp(pos) AS first_fail, make_timestamp(np) AS second_fail
FROM n WHERE event_type = 'error' AND nt = 'error' AND np - pos < {3 * HOUR}""")
def login_fail_cep(spark, sf_dir):
    return login_pairs(spark, sf_dir).select(
        "user_id", plain(instant("pos")).alias("first_fail"), plain(instant("next_pos")).alias("second_fail"))


@query("login_fail_cep_flat", f"""
WITH {EVENTS}, {NEXT_SQL.format(where=LOGINS_ONLY)},
m AS (SELECT * FROM n WHERE event_type = 'error' AND nt = 'error' AND np - pos < {3 * HOUR})
SELECT user_id, 'first' AS step, event_id FROM m UNION ALL SELECT user_id, 'second', nid FROM m""")
def login_fail_cep_flat(spark, sf_dir):
    step = lambda name, col: F.struct("user_id", F.lit(name).alias("step"), F.col(col).alias("event_id"))
    return p.flat(login_pairs(spark, sf_dir), step("first", "event_id"), step("second", "next_event_id"))


@query("pattern_fail_then_success", f"""
WITH {EVENTS}, {NEXT_ALL}
SELECT user_id, event_id, nid AS next_event_id
FROM n WHERE event_type = 'error' AND nt = 'signup' AND np - pos < {10 * HOUR}""")
def pattern_fail_then_success(spark, sf_dir):
    out = p.next_within(slim(spark, sf_dir), ["user_id"], ORDER, is_type("error"), is_type("signup"),
                        "10 hours", ["event_id"])
    return out.filter(F.col("status") == p.MATCHED).select("user_id", "event_id", "next_event_id")


TIMES_SQL = f"""
WITH {EVENTS},
s AS (SELECT user_id, event_id, pos, CASE event_type WHEN 'view' THEN 'a' WHEN 'purchase' THEN 'b' ELSE 'x' END AS part FROM ev),
o AS (SELECT *, lag(event_id) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS before_id,
             lag(event_id, 1) OVER r AS p1, lag(event_id, 2) OVER r AS p2, lag(pos, 1) OVER r AS q1, lag(pos, 2) OVER r AS q2,
             lead(event_id) OVER r AS f1, lead(pos) OVER r AS g1
      FROM s WINDOW r AS (PARTITION BY user_id, part ORDER BY pos, event_id)),
h AS (SELECT b.user_id, b.event_id AS bid, b.pos AS bpos, b.f1, b.g1, a.event_id AS aid, a.p1, a.p2, a.q1, a.q2
      FROM o b JOIN o a ON a.event_id = b.before_id WHERE b.part = 'b' AND a.part = 'a'),
x AS (SELECT user_id, p1 || ',' || aid AS first_ids, q1 AS start, bid, bpos, f1, g1 FROM h WHERE p1 IS NOT NULL
      UNION ALL SELECT user_id, p2 || ',' || p1 || ',' || aid, q2, bid, bpos, f1, g1 FROM h WHERE p2 IS NOT NULL),
y AS (SELECT user_id, first_ids, start, CAST(bid AS VARCHAR) AS second_ids, bpos AS stop FROM x
      UNION ALL SELECT user_id, first_ids, start, bid || ',' || f1, g1 FROM x WHERE f1 IS NOT NULL)
SELECT user_id, first_ids, second_ids FROM y WHERE stop - start < {5 * DAY}"""


@query("pattern_times", TIMES_SQL)
def pattern_times(spark, sf_dir):
    return p.times_then_times(
        slim(spark, sf_dir), ["user_id"], ORDER, "event_id", is_type("view"), (2, 3),
        is_type("purchase"), (1, 2), "5 days")


def parts_sql(within: str = "") -> str:
    """View x(2..3), at once purchase or signup x(1..2), at once click x(1..2), by ranks within each part."""
    return f"""
WITH {EVENTS},
n AS (SELECT user_id, event_id, pos, CASE event_type WHEN 'view' THEN 'a' WHEN 'click' THEN 'c' WHEN 'error' THEN 'x' ELSE 'b' END AS part,
             row_number() OVER (PARTITION BY user_id ORDER BY pos, event_id) AS rn FROM ev),
o AS (SELECT *, list(struct_pack(rn := rn, id := event_id, pos := pos)) OVER (
             PARTITION BY user_id, part ORDER BY pos, event_id ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS run FROM n),
a AS (SELECT user_id, pos AS first_pos, run[1:k] AS used FROM (SELECT *, unnest([2, 3]) AS k FROM o WHERE part = 'a') WHERE len(run) >= k),
b AS (SELECT a.user_id, first_pos, a.used AS used_a, o.run[1:k] AS used
      FROM a JOIN (SELECT *, unnest([1, 2]) AS k FROM o WHERE part = 'b') o
        ON o.user_id = a.user_id AND o.rn = a.used[-1].rn + 1 AND len(o.run) >= k),
c AS (SELECT b.user_id, first_pos, used_a, b.used AS used_b, o.run[1:k] AS used
      FROM b JOIN (SELECT *, unnest([1, 2]) AS k FROM o WHERE part = 'c') o
        ON o.user_id = b.user_id AND o.rn = b.used[-1].rn + 1 AND len(o.run) >= k)
SELECT user_id, array_to_string([x.id for x in used_a], ',') AS ids_1, array_to_string([x.id for x in used_b], ',') AS ids_2,
       array_to_string([x.id for x in used], ',') AS ids_3, make_timestamp(first_pos) AS first_at, make_timestamp(used[-1].pos) AS last_at
FROM c {within}"""


def three_parts(spark, sf_dir, within=None):
    """Three parts with counts; the second one takes either of two kinds."""
    out = p.part_after_part(
        slim(spark, sf_dir), ["user_id"], ORDER, "event_id",
        [(is_type("view"), 2, 3), (is_type("purchase") | is_type("signup"), 1, 2), (is_type("click"), 1, 2)], within)
    return out.select("user_id", "ids_1", "ids_2", "ids_3", plain(instant("first_pos")).alias("first_at"),
                      plain(instant("last_pos")).alias("last_at"))


@query("pattern_parts_unbounded", parts_sql())
def pattern_parts_unbounded(spark, sf_dir):
    return three_parts(spark, sf_dir)


@query("pattern_parts_within", parts_sql(f"WHERE used[-1].pos - first_pos < {2 * DAY}"))
def pattern_parts_within(spark, sf_dir):
    return three_parts(spark, sf_dir, "2 days")


@query("escalation_alarm", f"""
WITH {EVENTS},
n AS (SELECT *, lead(cents) OVER k AS nc, lead(pos) OVER k AS np FROM ev WINDOW k AS (PARTITION BY user_id ORDER BY pos, event_id)),
wn AS (SELECT user_id, event_id, np AS warned, pos FROM n WHERE cents > 1500 AND nc > 1500 AND np - pos < {10 * HOUR}),
al AS (SELECT *, lead(warned) OVER k AS nw, lead(event_id) OVER k AS nid FROM wn WINDOW k AS (PARTITION BY user_id ORDER BY warned, pos, event_id))
SELECT user_id, event_id, nid AS next_event_id, make_timestamp(nw) AS alarm_at FROM al WHERE nw - warned < {30 * HOUR}""")
def escalation_alarm(spark, sf_dir):
    readings = events(spark, sf_dir).select("user_id", "event_id", "pos", "cents")
    out = p.escalation(readings, ["user_id"], ORDER, F.col("cents") > 1500, "10 hours", "30 hours")
    return out.select("user_id", "event_id", "next_event_id", plain(instant("next_warned")).alias("alarm_at"))


@query("order_pay_outcome", f"""
WITH {EVENTS},
k AS (SELECT user_id, item, min(pos) FILTER (event_type = 'signup') AS created, min(pos) FILTER (event_type = 'purchase') AS paid
      FROM ev GROUP BY ALL)
SELECT user_id, item, make_timestamp(created) AS created, make_timestamp(paid) AS paid,
       CASE WHEN created IS NULL THEN 'already payed but not found create log' WHEN paid IS NULL THEN 'order timeout'
            WHEN paid < created + {10 * DAY} THEN 'payed successfully' ELSE 'payed but already timeout' END AS outcome
FROM k WHERE created IS NOT NULL OR paid IS NOT NULL""")
def order_pay_outcome(spark, sf_dir):
    out = d.order_outcomes(events(spark, sf_dir), ["user_id", "item"], "pos", is_type("signup"), is_type("purchase"), "10 days")
    return out.withColumn("created", plain(instant("created"))).withColumn("paid", plain(instant("paid")))


@query("login_fail_timer", f"""
WITH {EVENTS},
f AS (SELECT *, lag(pos) OVER (PARTITION BY user_id ORDER BY pos, event_id) + {6 * HOUR} AS fired FROM ev WHERE event_type = 'error'),
c AS (SELECT f.user_id, f.event_id, f.pos, f.fired,
             (SELECT max(s.pos) FROM ev s WHERE s.user_id = f.user_id AND s.event_type = 'signup' AND s.pos <= f.pos + {6 * HOUR}) AS cleared
      FROM f),
n AS (SELECT c.user_id, c.event_id, c.pos, count(e.event_id) AS fails
      FROM c JOIN ev e ON e.user_id = c.user_id AND e.event_type = 'error' AND e.pos >= c.pos AND e.pos <= c.pos + {6 * HOUR}
           AND e.pos > coalesce(c.fired, -1) AND e.pos > coalesce(c.cleared, -1)
      GROUP BY ALL)
SELECT user_id, event_id, fails, make_timestamp(pos + {6 * HOUR}) AS alert_at FROM n WHERE fails >= 2""")
def login_fail_timer(spark, sf_dir):
    logins = slim(spark, sf_dir).filter("event_type IN ('error', 'signup')")
    out = d.fails_at_timer(logins, ["user_id"], "pos", is_type("error"), is_type("signup"), "6 hours",
                           ties=["event_id"])
    return out.select("user_id", "event_id", "fails", plain("alert_at").alias("alert_at"))


CLICKS_SQL = f"""
WITH {EVENTS},
c AS (SELECT *, item // 50 AS ad, date_trunc('day', ts) AS day,
             row_number() OVER (PARTITION BY user_id, item // 50, date_trunc('day', ts) ORDER BY pos, event_id) AS rn
      FROM ev WHERE event_type = 'click')"""


def ad_clicks(spark, sf_dir):
    """Clicks on two ad campaigns, one click per user, campaign and day being allowed."""
    clicks = events(spark, sf_dir).filter("event_type = 'click'").withColumn("ad", F.expr("item div 50"))
    return d.blacklist(clicks.select("user_id", "ad", "event_id", "ts", "pos"), "ts", ["user_id", "ad"], ORDER, 1)


@query("blacklist_filter", f"{CLICKS_SQL} SELECT user_id, ad, event_id FROM c WHERE rn <= 1")
def blacklist_filter(spark, sf_dir):
    return ad_clicks(spark, sf_dir).filter("verdict = 'pass'").select("user_id", "ad", "event_id")


@query("blacklist_warnings", f"{CLICKS_SQL} SELECT user_id, ad, event_id, day FROM c WHERE rn = 2")
def blacklist_warnings(spark, sf_dir):
    return ad_clicks(spark, sf_dir).filter("verdict = 'warn'").select("user_id", "ad", "event_id", plain("day").alias("day"))


@query("blacklist_then_count", f"""
{CLICKS_SQL}
SELECT make_timestamp(pos // {HOUR} * {HOUR}) AS window_start, make_timestamp((pos // {HOUR} + 1) * {HOUR}) AS window_end, ad, count(*) AS clicks
FROM c WHERE rn <= 1 GROUP BY ALL""")
def blacklist_then_count(spark, sf_dir):
    kept = ad_clicks(spark, sf_dir).filter("verdict = 'pass'")
    return w.flatten_window(w.tumbling(kept, "ts", "1 hour", ["ad"], clicks=F.count(F.lit(1))))


@query("offline_alerts", f"""
WITH {EVENTS},
n AS (SELECT *, lead(pos) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS np, (SELECT max(pos) FROM ev) AS fin FROM ev),
s AS (SELECT user_id, pos, event_id, unnest(generate_series(pos + {5 * HOUR}, coalesce(np - 1, fin), {5 * HOUR})) AS fire
      FROM n WHERE event_type = 'error')
SELECT user_id, event_id, (fire - pos) // {5 * HOUR} AS alert_no, make_timestamp(fire) AS alert_at FROM s""")
def offline_alerts(spark, sf_dir):
    out = d.offline_alerts(slim(spark, sf_dir), ["user_id"], ORDER, is_type("error"), "5 hours")
    return out.select("user_id", "event_id", "alert_no", plain("alert_at").alias("alert_at"))


@query("rising_trend_alert", f"""
WITH RECURSIVE {EVENTS},
l AS (SELECT user_id, event_id, pos, cents, lag(cents) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS pv FROM ev),
g AS (SELECT *, CASE WHEN pv IS NULL OR pv > cents OR pv = 0 THEN 1 ELSE 0 END AS reset FROM l),
s AS (SELECT *, sum(reset) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS seg FROM g),
u AS (SELECT user_id, seg, coalesce(lead(min(pos)) OVER (PARTITION BY user_id ORDER BY seg), (SELECT max(pos) + 1 FROM ev)) AS until
      FROM s GROUP BY user_id, seg),
r AS (SELECT user_id, seg, pos FROM s WHERE reset = 0 AND pv < cents),
t AS (SELECT user_id, seg, min(pos) AS pos FROM r GROUP BY user_id, seg
      UNION ALL
      SELECT user_id, seg, pos FROM (
        SELECT t.user_id, t.seg, min(r.pos) AS pos FROM t JOIN r ON r.user_id = t.user_id AND r.seg = t.seg AND r.pos > t.pos + {4 * HOUR}
        GROUP BY t.user_id, t.seg))
SELECT t.user_id, make_timestamp(t.pos) AS rise_at, make_timestamp(t.pos + {4 * HOUR}) AS alert_at
FROM t JOIN u ON u.user_id = t.user_id AND u.seg = t.seg WHERE t.pos + {4 * HOUR} < u.until""")
def rising_trend_alert(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "pos", "cents")
    out = d.rising_trends(rows, ["user_id"], ORDER, "cents", "4 hours")
    return out.select("user_id", plain(instant("pos")).alias("rise_at"), plain("alert_at").alias("alert_at"))


@query("delta_trigger_max", f"""
WITH RECURSIVE {EVENTS},
c AS (SELECT *, sum(cents) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS dist,
             row_number() OVER (PARTITION BY user_id ORDER BY pos, event_id) AS rn FROM ev),
t AS (SELECT user_id, rn, dist FROM c WHERE rn = 1
      UNION ALL
      SELECT x.user_id, x.rn, c.dist FROM (
        SELECT t.user_id, min(c.rn) AS rn FROM t JOIN c ON c.user_id = t.user_id AND c.dist > t.dist + 8000 GROUP BY t.user_id) x
      JOIN c ON c.user_id = x.user_id AND c.rn = x.rn),
f AS (SELECT c.* FROM t JOIN c ON c.user_id = t.user_id AND c.rn = t.rn WHERE t.rn > 1)
SELECT f.user_id, f.event_id, f.dist::BIGINT AS distance,
       arg_max(e.event_id, (e.cents, -e.pos, -e.event_id)) AS best_event_id, max(e.cents) AS best_cents
FROM f JOIN ev e ON e.user_id = f.user_id AND (e.pos, e.event_id) <= (f.pos, f.event_id) AND e.pos > f.pos - {DAY}
GROUP BY f.user_id, f.event_id, f.dist""")
def delta_trigger_max(spark, sf_dir):
    """Each further 80 units of a user's accumulated value: the largest event of the last day."""
    rows = events(spark, sf_dir).select("user_id", "event_id", "pos", "cents")
    moved = running(rows, ["user_id"], ORDER, {"distance": ("cents", "sum")})
    out = d.delta_trigger(moved, ["user_id"], ORDER, "distance", 8000, "cents", "1 day")
    return out.select("user_id", "event_id", "distance", "best_event_id", "best_cents")


SYMBOL_SQL = """CASE event_type WHEN 'signup' THEN 'a' WHEN 'view' THEN 'b' WHEN 'click' THEN 'c'
                               WHEN 'purchase' THEN 'e' ELSE 'g' END"""


def with_symbols(df):
    """Event types as state-machine events."""
    symbol = F.create_map(*[F.lit(x) for pair in (
        ("signup", "a"), ("view", "b"), ("click", "c"), ("purchase", "e"), ("error", "g")) for x in pair])
    return df.withColumn("event", F.element_at(symbol, F.col("event_type")))


TRANSITION_ROWS = ", ".join(f"('{s}', '{e}', '{'Initial' if t == automaton.TERMINAL else t}')"
                            for (s, e), t in automaton.TRANSITIONS.items())


MACHINE_SQL = f"""
WITH RECURSIVE {EVENTS},
tr(s, e, t) AS (VALUES {TRANSITION_ROWS}),
o AS (SELECT user_id, event_id, {SYMBOL_SQL} AS event, row_number() OVER (PARTITION BY user_id ORDER BY pos, event_id) AS rn FROM ev),
m AS (SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS event,
             CAST('Initial' AS VARCHAR) AS was, CAST('Initial' AS VARCHAR) AS state, TRUE AS legal
      FROM (SELECT DISTINCT user_id FROM o)
      UNION ALL
      SELECT o.user_id, o.rn, o.event_id, o.event, m.state, coalesce(tr.t, m.state), tr.t IS NOT NULL
      FROM m JOIN o ON o.user_id = m.user_id AND o.rn = m.rn + 1 LEFT JOIN tr ON tr.s = m.state AND tr.e = o.event)
SELECT user_id, event_id, event, was AS state FROM m WHERE NOT legal"""


@query("state_machine_alerts", MACHINE_SQL)
def state_machine_alerts(spark, sf_dir):
    rows = with_symbols(slim(spark, sf_dir))
    out = automaton.alerts(rows, ["user_id"], ORDER, "event")
    return out.select("user_id", "event_id", "event", "state")


@query("state_machine_alerts_chunked", MACHINE_SQL)
def state_machine_alerts_chunked(spark, sf_dir):
    """The same alerts with sequences cut into chunks of four, so that state maps are scanned over three levels."""
    rows = with_symbols(slim(spark, sf_dir))
    out = automaton.alerts(rows, ["user_id"], ORDER, "event", chunk=4)
    return out.select("user_id", "event_id", "event", "state")
