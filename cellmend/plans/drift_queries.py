"""Deviation over batches, patterns and neighbouring columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cellmend.operators import deviation as D
from cellmend.operators.drift_state import DriftState
from cellmend.operators.ordering import scratch_path
from cellmend.plans.catalog import (
    CATALOG, dirty_date, dirty_email, dirty_money, dirty_phone, dirty_zip, query, table)
from cellmend.plans.cell_queries import STRIP, _PATTERN_TEST
from cellmend.plans.integrity_queries import _NULLISH_SQL, clean_sql, type_sql

_EVENTS = {
    "quantity": "CASE WHEN user_id % 11 = 0 THEN 'x' WHEN user_id % 5 = 0 THEN '1.5' "
                "WHEN user_id % 13 = 0 THEN 'n/a' ELSE CAST(user_id AS STRING) END",
    "kind": "CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END",
}
_DAY = "CAST(CAST(ts AS DATE) AS STRING) AS day"
_SELECT = f"{_DAY}, " + ", ".join(f"{sql} AS {c}" for c, sql in _EVENTS.items())
_CELLS = (f"d AS (SELECT {_SELECT} FROM events), c AS (" + " UNION ALL ".join(
    f"SELECT day, '{c}' AS column_name, lower(trim({c})) AS v, {type_sql(c)} AS t FROM d"
    for c in _EVENTS) + ")")


def _daily(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        _DAY, *[f"{sql} AS {c}" for c, sql in _EVENTS.items()])


@query("type_ratio_drift", f"""
    WITH {_CELLS},
    types AS (SELECT unnest(['null', 'int', 'float', 'string']) AS cell_type),
    shares AS (SELECT day, column_name, cell_type,
                      count(*) FILTER (WHERE t = cell_type) / count(*) AS share
               FROM c, types GROUP BY ALL),
    base AS (SELECT *, avg(share) OVER w AS mu, stddev_samp(share) OVER w AS sd FROM shares
             WINDOW w AS (PARTITION BY column_name, cell_type ORDER BY day
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    scored AS (SELECT *, CASE WHEN sd > 1e-12 THEN (share - mu) / sd END AS z FROM base)
    SELECT day, column_name, cell_type, round(share, 6)::DOUBLE AS share,
           round(z, 4)::DOUBLE AS z, coalesce(abs(z) > 2, false) AS drifted,
           round(abs(z) / nullif(max(abs(z)) OVER (PARTITION BY day), 0) * 100, 3)::DOUBLE
             AS deviation_pct
    FROM scored""")
def type_ratio_drift(spark, sf_dir):
    return D.type_ratio_drift(_daily(spark, sf_dir), "day", list(_EVENTS))


@query("entropy_drift", f"""
    WITH {_CELLS},
    n AS (SELECT day, column_name, v, count(*) AS n FROM c WHERE t <> 'null' GROUP BY ALL),
    h AS (SELECT day, column_name, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h
          FROM n GROUP BY ALL),
    u AS (SELECT column_name, count(DISTINCT v) AS d FROM n GROUP BY ALL)
    SELECT day, column_name, round(h, 6)::DOUBLE AS entropy_bits,
           round(abs(h - lag(h) OVER (PARTITION BY column_name ORDER BY day))
             / CASE WHEN d > 1 THEN log2(d) ELSE 1.0 END * 100, 4)::DOUBLE AS entropy_drift_pct
    FROM h JOIN u USING (column_name)""")
def entropy_drift(spark, sf_dir):
    return D.entropy_drift(_daily(spark, sf_dir), "day", list(_EVENTS))


_REGISTRY = {"phone": "phone", "mail": "email", "post_code": "zip", "money": "currency",
             "born": "date"}
_VALUES = {"phone": dirty_phone("c_custkey"), "mail": dirty_email("c_custkey"),
           "post_code": dirty_zip("c_custkey"), "money": dirty_money("c_custkey"),
           "born": dirty_date("c_custkey")}
_CUSTOMERS = ("(SELECT " + ", ".join(f"{sql} AS {c}" for c, sql in _VALUES.items())
              + " FROM customer) d")


def _test_sql(column, kind):
    return _PATTERN_TEST[kind].format(STRIP.format(column))


def _filled_sql(column):
    return f"({clean_sql(column)} NOT IN {_NULLISH_SQL})"


@query("pattern_violation", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, '{kind}' AS kind,
           (count(*) FILTER (WHERE {_filled_sql(c)}))::BIGINT AS filled,
           (count(*) FILTER (WHERE {_filled_sql(c)} AND NOT {_test_sql(c, kind)}))::BIGINT
             AS violations,
           round(100.0 * count(*) FILTER (WHERE {_filled_sql(c)} AND NOT {_test_sql(c, kind)})
             / count(*) FILTER (WHERE {_filled_sql(c)}), 3)::DOUBLE AS violation_pct
    FROM {_CUSTOMERS}""" for c, kind in _REGISTRY.items()))
def pattern_violation(spark, sf_dir):
    df = table(spark, sf_dir, "customer").selectExpr(
        *[f"{sql} AS {c}" for c, sql in _VALUES.items()])
    return D.pattern_violations(df, _REGISTRY)


# Every eleventh row has its phone number and postal code swapped.
_PAIR = {
    "phone": f"CASE WHEN c_custkey % 11 = 0 THEN {dirty_zip('c_custkey')} "
             f"ELSE {dirty_phone('c_custkey')} END",
    "post_code": f"CASE WHEN c_custkey % 11 = 0 THEN {dirty_phone('c_custkey')} "
                 f"ELSE {dirty_zip('c_custkey')} END",
    "born": dirty_date("c_custkey"),
}
_PAIR_KINDS = {"phone": "phone", "post_code": "zip", "born": "date"}


def _pairs_sql():
    names = list(_PAIR_KINDS)
    both, slid = [], []
    for a, b in zip(names, names[1:]):
        expected = f"({_filled_sql(a)} AND {_filled_sql(b)})"
        ka, kb = _PAIR_KINDS[a], _PAIR_KINDS[b]
        both.append(f"{expected}::INT")
        slid.append(f"({expected} AND ((NOT {_test_sql(a, ka)} AND {_test_sql(a, kb)}) OR "
                    f"(NOT {_test_sql(b, kb)} AND {_test_sql(b, ka)})))::INT")
    return " + ".join(both), " + ".join(slid)


_BOTH, _SLID = _pairs_sql()


@query("cross_field", f"""
    WITH d AS (SELECT {", ".join(f"{sql} AS {c}" for c, sql in _PAIR.items())} FROM customer),
    p AS (SELECT {_BOTH} AS e, {_SLID} AS v FROM d)
    SELECT sum(e)::BIGINT AS expected_pairs, sum(v)::BIGINT AS violated_pairs,
           round(100.0 * sum(v) / sum(e), 3)::DOUBLE AS incoherence_pct FROM p""")
def cross_field(spark, sf_dir):
    df = table(spark, sf_dir, "customer").selectExpr(
        *[f"{sql} AS {c}" for c, sql in _PAIR.items()])
    return D.cross_field_incoherence(df, _PAIR_KINDS)


# --- The same, batch by batch against a kept state ----------------------------------

def _thirds(spark, sf_dir):
    """The days of the events in three runs, one behind the other."""
    daily = _daily(spark, sf_dir)
    days = table(spark, sf_dir, "events").selectExpr(_DAY).distinct()
    thirds = days.selectExpr("day", "ntile(3) OVER (ORDER BY day) AS part")  # a row per day
    placed = daily.join(F.broadcast(thirds), "day")
    return [placed.filter(F.col("part") == k).drop("part") for k in (1, 2, 3)]


def _live(spark, sf_dir):
    state = DriftState(spark, scratch_path(spark, "drift"), list(_EVENTS))
    return state, [state.update(run, "day") for run in _thirds(spark, sf_dir)]


@query("live_type_drift", CATALOG["type_ratio_drift"].oracle)
def live_type_drift(spark, sf_dir):
    """Three runs, none of which reads what the earlier ones read."""
    _, found = _live(spark, sf_dir)
    return reduce(lambda a, b: a.unionByName(b), [types for types, _ in found])


@query("live_entropy_drift", f"""
    WITH {_CELLS},
    n AS (SELECT day, column_name, v, count(*) AS n FROM c WHERE t <> 'null' GROUP BY ALL),
    h AS (SELECT day, column_name, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h
          FROM n GROUP BY ALL),
    f AS (SELECT column_name, v, min(day) AS day FROM n GROUP BY ALL),
    u AS (SELECT h.day, h.column_name, (SELECT count(*) FROM f
            WHERE f.column_name = h.column_name AND f.day <= h.day) AS d FROM h)
    SELECT day, column_name, round(h, 6)::DOUBLE AS entropy_bits,
           round(abs(h - lag(h) OVER (PARTITION BY column_name ORDER BY day))
             / CASE WHEN d > 1 THEN log2(d) ELSE 1.0 END * 100, 4)::DOUBLE AS entropy_drift_pct
    FROM h JOIN u USING (day, column_name)""")
def live_entropy_drift(spark, sf_dir):
    """As ``entropy_drift``, of the values that were known by then."""
    _, found = _live(spark, sf_dir)
    return reduce(lambda a, b: a.unionByName(b), [entropy for _, entropy in found])


@query("live_entropy_delta", f"""
    WITH {_CELLS},
    n AS (SELECT column_name, v, count(*) AS n FROM c WHERE t <> 'null' GROUP BY ALL),
    s AS (SELECT column_name, sum(n) AS nf, count(*) AS d, sum(n * log2(n)) AS s FROM n GROUP BY ALL)
    SELECT column_name, nf::BIGINT AS filled, d::BIGINT AS distinct_values,
           round(abs(log2(nf) - s / nf), 3)::DOUBLE AS entropy_bits,
           round(CASE WHEN nf >= 2 THEN abs((log2(nf) - s / nf)
             / CASE WHEN d > 1 THEN log2(d) ELSE 1.0 END - 1) * 100 END, 3)::DOUBLE AS entropy_delta_pct
    FROM s""")
def live_entropy_delta(spark, sf_dir):
    """Entropy over all runs, from the state they left."""
    state, _ = _live(spark, sf_dir)
    return state.entropy_delta()
