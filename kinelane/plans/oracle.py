"""The registered queries again as DuckDB SQL, written independently of Spark."""

from __future__ import annotations

_HELPERS = """
helper AS (
  SELECT event_id, user_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         (epoch_us(ts) - 1704067200000000) // 600000 AS t_ms,
         CASE WHEN user_id % 2 = 0 THEN 1 ELSE -1 END AS direction,
         CASE WHEN event_type = 'error' THEN 0
              ELSE CAST(floor(value * 2) AS INTEGER) END AS step
  FROM events),
located AS (
  SELECT *,
         CAST((user_id * 7 + t_ms // (600000 * (1 + user_id % 5))) % 8 AS INTEGER) AS road_id,
         CAST(sum(step) OVER (PARTITION BY user_id ORDER BY t_ms, event_id) AS INTEGER) AS dist
  FROM helper),
readings AS (
  SELECT event_id AS _id,
         concat('road', road_id) AS road,
         120 + 10 * road_id AS road_speed,
         50000 + 2500 * road_id AS road_size,
         CASE WHEN direction = 1 THEN dist ELSE 50000 + 2500 * road_id - dist END AS x,
         CASE WHEN direction = 1 THEN k % 2 ELSE k % 2 + 2 END AS y,
         concat(chr(CAST(65 + (user_id // 1000) % 26 AS INTEGER)), 'A',
                lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0')) AS plate,
         CAST(1685000000 AS DOUBLE) + CAST(t_ms AS DOUBLE) / 1000 AS time,
         direction
  FROM located),
top AS (SELECT max(time) AS m FROM readings)"""

_MOVING = """
stepped AS (
  SELECT *, abs(x - lag(x) OVER (PARTITION BY plate ORDER BY time, _id)) AS speed
  FROM {rows}),
moving AS (
  SELECT * FROM (
    SELECT *, speed - lag(speed) OVER (PARTITION BY plate ORDER BY time, _id) AS acc
    FROM stepped)
  WHERE speed IS NOT NULL AND acc IS NOT NULL)"""

_SNAPSHOT = """
numbered AS (
  SELECT r.*, row_number() OVER (PARTITION BY r.plate ORDER BY r.time DESC, r._id DESC) AS "row"
  FROM readings r
  WHERE r.time > {cut} - 240
    AND r.plate IN (SELECT plate FROM readings WHERE time > {cut})),
snap AS (SELECT * FROM numbered WHERE "row" <= 3)"""

_VEHICLES = """
vehicles AS (
  SELECT *,
    CASE WHEN direction = 1 THEN
      CASE WHEN x + speed + acc > lead(x) OVER lane + lead(speed) OVER lane + lead(acc) OVER lane
           THEN 1 ELSE 0 END
    ELSE
      CASE WHEN x - speed - acc < lag(x) OVER lane - lag(speed) OVER lane - lag(acc) OVER lane
           THEN 1 ELSE 0 END
    END AS collision_risk
  FROM moving
  WINDOW lane AS (PARTITION BY road, y ORDER BY x, plate))"""

_STEADY = "((SELECT m FROM top) - 60)"
_IDLE = "(SELECT m FROM top)"
_FIRST = "(-60)"

_STATS = """
stats AS (
  SELECT road, avg(speed) AS avg_speed,
         avg(road_size) / nullif(avg(speed), 0) AS avg_time_to_cross
  FROM moving GROUP BY road),
crashes AS (
  SELECT road, count(*) AS total_collisions
  FROM moving WHERE speed = 0 AND acc = 0 GROUP BY road)"""

_FLAGS = """
flags AS (
  SELECT *,
    CASE WHEN speed > road_speed AND (lag(speed) OVER w <= road_speed
                                      OR row_number() OVER w = 1)
         THEN 1 ELSE 0 END AS change_in_speed
  FROM moving
  WINDOW w AS (PARTITION BY plate ORDER BY time, _id))"""

_SCORED = """
parts AS (
  SELECT *,
    CASE WHEN y <> lag(y) OVER (PARTITION BY plate ORDER BY time, _id)
         THEN 1 ELSE 0 END AS changed_lane,
    CASE WHEN speed > road_speed THEN 3 ELSE 0 END AS over_road_speed,
    CASE WHEN acc > 40 OR acc < -40 THEN 3 ELSE 0 END AS over_acc
  FROM moving WHERE time > {start} AND time < {end}),
scored AS (
  SELECT * FROM (
    SELECT *, changed_lane + over_road_speed + over_acc AS total FROM parts)
  WHERE total > 0),
windows AS (
  SELECT *, CAST(sum(total) OVER (PARTITION BY plate ORDER BY time
             RANGE BETWEEN CURRENT ROW AND {window} FOLLOWING) AS BIGINT) AS window_total
  FROM scored)"""

_BANNED = """
SELECT plate, CAST(sum(change_in_speed) AS BIGINT) AS total_infractions
FROM flags {where} GROUP BY plate HAVING sum(change_in_speed) >= {least}"""

# Passes every {0} s: all of them, with the latest time so far and before.
_CUTOFFS = """
seen AS (
  SELECT CAST(floor(time / {every}) AS BIGINT) AS pass, max(time) AS m
  FROM readings GROUP BY 1),
passes AS (
  SELECT unnest(range((SELECT min(pass) FROM seen), (SELECT max(pass) FROM seen) + 1)) AS pass),
filled AS (
  SELECT passes.pass, max(seen.m) OVER (ORDER BY passes.pass) AS latest
  FROM passes LEFT JOIN seen USING (pass)),
moved AS (
  SELECT pass, CASE WHEN lag(latest) OVER (ORDER BY pass) = latest
                    THEN latest ELSE latest - 60 END AS cut
  FROM filled),
compared AS (
  SELECT cut, lag(cut, 1, 0) OVER (ORDER BY pass) AS before FROM moved)"""


def _sql(select: str, *steps: str) -> str:
    return "WITH " + ",".join([_HELPERS, *steps]) + "\n" + select.strip()


def _past(select: str, *steps: str) -> str:
    return _sql(select, _MOVING.format(rows="readings"), *steps)


def _snap(select: str, cut: str = _STEADY) -> str:
    return _sql(select, _SNAPSHOT.format(cut=cut))


def _live(select: str, cut: str = _STEADY) -> str:
    return _sql(select, _SNAPSHOT.format(cut=cut), _MOVING.format(rows="snap"), _VEHICLES)


def _scored(select: str, start: int = 1_680_000_000, end: int = 1_690_000_000) -> str:
    return _past(select, _SCORED.format(start=start, end=end, window=60))


def _banned(least: int, where: str = "") -> str:
    return _past(_BANNED.format(least=least, where=where), _FLAGS)


_FIELDS = "road, road_speed, road_size, x, y, plate, time, direction"
_OVER = "SELECT plate, speed, collision_risk FROM vehicles WHERE speed > road_speed"
_RISK = "SELECT plate, speed FROM vehicles WHERE collision_risk = 1"
_ROAD_STATS = (
    "SELECT road, avg_speed, avg_time_to_cross, total_collisions "
    "FROM stats LEFT JOIN crashes USING (road)"
)
_ACTIVE = (
    f"SELECT plate, _id FROM readings WHERE time > {_STEADY} - 240 "
    f"AND plate IN (SELECT plate FROM readings WHERE time > {_STEADY})"
)

ORACLE: dict[str, str] = {
    "readings": _sql(f"SELECT _id, {_FIELDS} FROM readings"),
    "payload_lines": _sql(
        f"SELECT concat(concat_ws(',', {_FIELDS}), chr(10)) AS value FROM readings"
    ),
    "payload_roundtrip": _sql(f"SELECT {_FIELDS} FROM readings"),
    "payload_rejects": _sql(
        "SELECT CASE WHEN _id % 61 = 0 THEN 'bad_text' WHEN _id % 97 = 0 THEN 'short' "
        "WHEN _id % 89 = 0 THEN 'bad_field' ELSE 'out_of_range' END AS reason, "
        "count(*) AS n FROM readings WHERE _id % 61 = 0 OR _id % 97 = 0 OR _id % 89 = 0 "
        "OR _id % 83 = 0 OR _id % 79 = 0 OR _id % 73 = 0 OR _id % 71 = 0 OR _id % 67 = 0 "
        "GROUP BY 1"
    ),
    "imposed_types": _sql(f"SELECT _id, {_FIELDS} FROM readings"),
    "recent_readings": _sql(f"SELECT _id, plate, time FROM readings WHERE time > {_STEADY}"),
    "lookback_readings": _sql(
        f"SELECT _id, plate, time FROM readings WHERE time > {_STEADY} - 240"
    ),
    "reading_counts": _sql(
        "SELECT count(*) AS history_rows, "
        f"count(*) FILTER (time > {_STEADY}) AS recent_rows, "
        f"count(*) FILTER (time > {_STEADY} - 240) AS lookback_rows FROM readings"
    ),
    "active_plates": _sql(f"SELECT DISTINCT plate FROM readings WHERE time > {_STEADY}"),
    "active_history_inner": _sql(_ACTIVE),
    "active_history_semi": _sql(_ACTIVE),
    "latest_three": _snap('SELECT plate, _id, CAST("row" AS INTEGER) AS "row" FROM snap'),
    "snapshot_kinematics": _live("SELECT plate, _id, speed, acc FROM moving"),
    "collision_risk_flags": _live(
        "SELECT plate, road, y, x, speed, acc, collision_risk FROM vehicles"
    ),
    "live_road_count": _snap("SELECT count(DISTINCT road) AS n_roads FROM snap"),
    "live_vehicle_count": _snap("SELECT count(DISTINCT plate) AS n_cars FROM snap"),
    "live_overspeed_count": _live(f"SELECT count(*) AS cars_over_speed_limit FROM ({_OVER})"),
    "live_collision_count": _live(f"SELECT count(*) AS cars_collision_risk FROM ({_RISK})"),
    "live_overspeed_list": _live(_OVER),
    "live_collision_list": _live(_RISK),
    "live_first_run_overspeed": _live(_OVER, _FIRST),
    "live_first_run_collision": _live(_RISK, _FIRST),
    "live_idle_counts": _live(
        "SELECT 'n_roads' AS analysis, count(DISTINCT road) AS n FROM snap UNION ALL "
        "SELECT 'n_cars', count(DISTINCT plate) FROM snap UNION ALL "
        f"SELECT 'cars_over_speed_limit', count(*) FROM ({_OVER}) UNION ALL "
        f"SELECT 'cars_collision_risk', count(*) FROM ({_RISK})",
        _IDLE,
    ),
    "history_kinematics": _past("SELECT _id, plate, speed, acc FROM moving"),
    "history_speed_per_second": _sql(
        "SELECT _id, plate, speed FROM paced WHERE speed IS NOT NULL AND before IS NOT NULL",
        """
timed AS (
  SELECT _id, plate, time, abs(x - lag(x) OVER w) /
         nullif(time - lag(time) OVER w, 0) AS speed
  FROM readings WINDOW w AS (PARTITION BY plate ORDER BY time, _id)),
paced AS (
  SELECT _id, plate, speed,
         lag(speed) OVER (PARTITION BY plate ORDER BY time, _id) AS before FROM timed)""",
    ),
    "reading_numbers": _past(
        "SELECT _id, plate, CAST(row_number() OVER (PARTITION BY plate ORDER BY time, _id) "
        'AS INTEGER) AS "row" FROM moving'
    ),
    "top_road_vehicles": _sql(
        "SELECT plate, count(DISTINCT road) AS road_count FROM readings "
        "GROUP BY plate ORDER BY road_count DESC, plate LIMIT 100"
    ),
    "road_mean_speed": _past("SELECT * FROM stats", _STATS),
    "road_collisions": _past("SELECT * FROM crashes", _STATS),
    "road_stats": _past(_ROAD_STATS, _STATS),
    "road_stats_single_pass": _past(_ROAD_STATS, _STATS),
    "infraction_flags": _past("SELECT _id, plate, change_in_speed FROM flags", _FLAGS),
    "banned_vehicles": _banned(1),
    "banned_vehicles_min10": _banned(10),
    "banned_vehicles_retention": _banned(1, f"WHERE {_IDLE} - time < 1800"),
    "driving_scores": _scored(
        "SELECT _id, plate, changed_lane, over_road_speed, over_acc, total FROM scored"
    ),
    "window_scores": _scored("SELECT _id, plate, window_total FROM windows"),
    "dangerous_driving": _scored("SELECT plate FROM windows WHERE window_total >= 7"),
    "dangerous_driving_band": _scored(
        "SELECT plate FROM windows WHERE window_total >= 7", 1_685_001_000, 1_685_002_000
    ),
    "dangerous_driving_min20": _scored("SELECT plate FROM windows WHERE window_total >= 20"),
    "dangerous_vehicles": _scored("SELECT DISTINCT plate FROM windows WHERE window_total >= 7"),
    "latest_time": _sql("SELECT m AS max_time FROM top"),
    "cutoff_changes": _sql(
        "SELECT cut FROM compared WHERE cut <> before", _CUTOFFS.format(every="60")
    ),
    "cutoff_changes_idle": _sql(
        "SELECT cut FROM compared WHERE cut <> before", _CUTOFFS.format(every="0.5")
    ),
    "view_overspeed": _live(
        "SELECT plate, speed, CASE collision_risk WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END "
        f"AS collision_risk FROM ({_OVER})"
    ),
    "view_road_stats": _past(
        "SELECT road, round_even(avg_speed, 2) AS avg_speed, "
        "round_even(avg_time_to_cross, 2) AS avg_time_to_cross, total_collisions "
        f"FROM ({_ROAD_STATS})",
        _STATS,
    ),
}

# Readings spread over the month: 600 times the time between them.
_SPREAD = """
spread AS (
  SELECT * REPLACE (CAST(1685000000 AS DOUBLE) + (time - 1685000000) * 600 AS time)
  FROM readings)"""


def _spread(select: str, *steps: str) -> str:
    return _sql(select, _SPREAD, _MOVING.format(rows="spread"), *steps)


ORACLE |= {
    "top_road_vehicles_closed_days": ORACLE["top_road_vehicles"],
    "road_stats_closed_days": _spread(_ROAD_STATS, _STATS),
    "banned_vehicles_closed_days": _spread(_BANNED.format(least=1, where=""), _FLAGS),
    "dangerous_driving_closed_days": _spread(
        "SELECT plate FROM windows WHERE window_total >= 7",
        _SCORED.format(start=1_680_000_000, end=1_690_000_000, window=36_000),
    ),
}

# The chain gives what one pass over the month gives.
_MONTH_END = "(SELECT max(time) FROM spread)"
ORACLE |= {
    "top_road_vehicles_chained": ORACLE["top_road_vehicles_closed_days"],
    "road_stats_chained": ORACLE["road_stats_closed_days"],
    "banned_vehicles_chained": ORACLE["banned_vehicles_closed_days"],
    "banned_vehicles_retention_chained": _spread(
        _BANNED.format(least=1, where=f"WHERE {_MONTH_END} - time < 864000"), _FLAGS
    ),
    "dangerous_driving_chained": ORACLE["dangerous_driving_closed_days"],
    "latest_three_carried": ORACLE["latest_three"],
}

# Every 13th reading lacks a value: it counts for the speed of others, not for itself.
_GAPPY = """
complete AS (SELECT * FROM moving WHERE _id % 13 <> 0)"""


def _gaps(step: str) -> str:
    return step.replace("FROM moving", "FROM complete")


ORACLE |= {
    "infraction_flags_gaps": _past(
        "SELECT _id, plate, change_in_speed FROM flags", _GAPPY, _gaps(_FLAGS)
    ),
    "driving_scores_gaps_split": _past(
        "SELECT _id, plate, changed_lane, over_road_speed, over_acc, total FROM scored",
        _GAPPY,
        _gaps(_SCORED).format(start=1_680_000_000, end=1_690_000_000, window=60),
    ),
    "banned_vehicles_gaps_closed_days": _spread(
        _BANNED.format(least=1, where=""), _GAPPY, _gaps(_FLAGS)
    ),
    "dangerous_driving_gaps_closed_days": _spread(
        "SELECT plate FROM windows WHERE window_total >= 7",
        _GAPPY,
        _gaps(_SCORED).format(start=1_680_000_000, end=1_690_000_000, window=36_000),
    ),
}
ORACLE["infraction_flags_gaps_split"] = ORACLE["infraction_flags_gaps"]

# Splitting the busiest keys changes nothing.
ORACLE |= {
    "readings_split": ORACLE["readings"],
    "infraction_flags_split": ORACLE["infraction_flags"],
    "dangerous_driving_split": ORACLE["dangerous_driving"],
    "window_scores_split": ORACLE["window_scores"],
    "collision_risk_split": ORACLE["collision_risk_flags"],
}
