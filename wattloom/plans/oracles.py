"""The registered queries in plain SQL over the same tables, for a second engine to check."""

from __future__ import annotations

READINGS = """
readings AS (
  SELECT user_id % 25 AS house_id,
         strftime(ts, '%Y-%m-%d') AS date,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         lpad(CAST(user_id % 25 % 10 AS VARCHAR), 5, '0') AS zip,
         CASE WHEN event_type IN ('view', 'click') THEN 'mains' ELSE event_type END AS label,
         CASE event_type WHEN 'view' THEN '1' WHEN 'click' THEN '2' WHEN 'purchase' THEN '3'
                         WHEN 'error' THEN '4' WHEN 'signup' THEN '5' END AS meter_id,
         value AS power,
         CASE WHEN event_type IN ('view', 'click') THEN 'mains' ELSE 'appliance' END AS layer
  FROM events)"""

ENERGY = (
    READINGS
    + """,
steps AS (
  SELECT *, lead(ts) OVER day_of_meter - ts AS held, row_number() OVER day_of_meter AS nth
  FROM readings
  WINDOW day_of_meter AS (PARTITION BY house_id, meter_id, zip, date ORDER BY ts, label, power)),
meter_days AS (
  SELECT house_id, meter_id, zip, date, layer,
         CASE WHEN count(*) <= 1 THEN 'NONE' ELSE max(CASE WHEN nth = 1 THEN label END) END AS label,
         CASE WHEN count(*) <= 1 THEN CAST(0 AS DOUBLE) ELSE sum(coalesce(held * power, 0)) END AS joules,
         count(*) AS n_readings
  FROM steps GROUP BY house_id, meter_id, zip, date, layer),
label_days AS (
  SELECT layer, house_id, label, zip, date, sum(joules) / 1000 / 3600 AS kwh
  FROM meter_days GROUP BY layer, house_id, label, zip, date),
mains_totals AS (
  SELECT house_id, zip, date, sum(kwh) AS mains_kwh
  FROM label_days WHERE layer = 'mains' GROUP BY house_id, zip, date)"""
)

PERCENT = "round(CASE WHEN mains_kwh IS NULL OR mains_kwh < 1e-5 THEN 0e0 ELSE kwh / mains_kwh * 100 END, 6)"

SHARE = f"""WITH {ENERGY}
SELECT house_id, date, zip, label, {PERCENT} AS percent
FROM label_days LEFT JOIN mains_totals USING (house_id, zip, date) WHERE layer = 'appliance'"""

STATS = (
    READINGS
    + """,
stats AS (
  SELECT house_id, meter_id, quantile_disc(power, 0.97) AS p97
  FROM readings WHERE power > 1e-5 GROUP BY house_id, meter_id)"""
)

PACKED = """
packed AS (
  SELECT *, ts - ts % {step} AS step_start,
         row_number() OVER (PARTITION BY house_id, zip, layer, ts - ts % {step}, meter_id
                            ORDER BY ts, label, power) AS record_no
  FROM readings)"""

WINDOWS = f"""WITH {READINGS}
SELECT ts - ts % 600 AS window_start, house_id, date, zip, round(sum(power), 6) AS watts_sum
FROM readings WHERE layer = 'mains' GROUP BY ALL"""

ALERTS = f"""WITH {STATS}
SELECT ts, house_id, meter_id, power, p97 FROM readings JOIN stats USING (house_id, meter_id)
WHERE power > p97 * CAST(1.05 AS DOUBLE)"""

FLAT = "house_id, date, ts, zip, label, meter_id, power"


def _days(source: str, keys: str, gap: int, name: str) -> str:
    """Day summaries and clean days of ``source``, as two CTEs: ``name``_days and ``name``."""
    start = 1704067200
    day = f"{start} + (ts - {start}) // 86400 * 86400"
    return f"""
{name}_gaps AS (
  SELECT {keys}, ts, {day} AS day_start,
         lag(ts) OVER (PARTITION BY {keys}, {day} ORDER BY ts) AS prev_ts
  FROM {source} WHERE ts >= {start}),
{name}_days AS (
  SELECT {keys}, day_start, min(ts) AS first_ts, max(ts) AS last_ts,
         max(coalesce(ts - prev_ts, 0)) AS max_gap, count(*) AS n_readings
  FROM {name}_gaps GROUP BY {keys}, day_start),
{name}_ranked AS (
  SELECT *, max(day_start) OVER (PARTITION BY {keys}) AS final_day,
            min(day_start) OVER (PARTITION BY {keys}) AS opening_day
  FROM {name}_days),
{name} AS (
  SELECT {keys}, day_start FROM {name}_ranked
  WHERE day_start < final_day AND day_start + 86400 - last_ts < {gap} AND max_gap <= {gap}
    AND (first_ts - day_start <= {gap} OR day_start = opening_day))"""


CLEAN = READINGS + "," + _days("readings", "house_id", 18000, "clean")

ZIP_TABLE = """
zip_table AS (
  SELECT printf('%05d', c_custkey) AS zip, c_name AS primary_city, c_mktsegment AS type FROM customer)"""

KNOWN_HOUSES = """
known AS (
  SELECT c_custkey AS house_id, CAST(c_nationkey % 5 + 1 AS INTEGER) AS source_house,
         printf('%05d', c_custkey) AS zip, 1 + c_nationkey / CAST(100 AS DOUBLE) AS scale
  FROM customer WHERE c_mktsegment = 'HOUSEHOLD')"""


def _draw(seed: int) -> str:
    digest = f"md5(CAST(house_id AS VARCHAR) || '|{seed}')"
    return f"(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


# Mains events in the batches they come by; late is what comes when its window is a day past.
LATE = f"""WITH mains AS (
  SELECT user_id % 25 AS house_id, strftime(ts, '%Y-%m-%d') AS date, CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         lpad(CAST(user_id % 25 % 10 AS VARCHAR), 5, '0') AS zip, value AS power,
         (day(ts) - 1) // 11 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS batch_no
  FROM events WHERE event_type IN ('view', 'click')),
tops AS (SELECT batch_no, max(max(ts)) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM mains GROUP BY batch_no),
parted AS (
  SELECT ts - ts % 600 AS window_start, house_id, date, zip, power, coalesce(ts - ts % 600 + 600 <= top - 86400, FALSE) AS late
  FROM mains JOIN tops USING (batch_no))
SELECT window_start, house_id, date, zip, round(sum(power) FILTER (NOT late), 6) AS watts_sum, round(sum(power) FILTER (late), 6) AS late_watts_sum
FROM parted GROUP BY window_start, house_id, date, zip"""

STEP_FACTOR = "(CAST(0.95 AS DOUBLE) + CAST(0.01 AS DOUBLE) * ((r.house_id * 7 + CAST(r.meter_id AS BIGINT) * 3) % 11))"
DRAWN_FACTOR = (
    "((CAST('0x' || substr(md5(CAST(r.house_id AS VARCHAR) || '|' || r.meter_id || '|0'), 1, 8) AS BIGINT)"
    " / CAST(4294967296 AS DOUBLE) * 2 - 1) * CAST(0.05 AS DOUBLE) + 1)"
)


def _replay(source: str, clean: str, days: int, factor: str, shift: int = 0) -> str:
    """Days of ``clean`` replayed, as the CTEs ordered, targets and replayed."""
    return f"""
ordered AS (
  SELECT house_id, day_start, row_number() OVER (PARTITION BY house_id ORDER BY day_start) - 1 AS ordinal,
         count(*) OVER (PARTITION BY house_id) AS n_days, min(day_start) OVER (PARTITION BY house_id) AS origin
  FROM {clean}),
targets AS (
  SELECT o.*, k.day_no FROM ordered o JOIN (SELECT range AS day_no FROM range(0, {days})) k
    ON k.day_no % o.n_days = o.ordinal),
replayed AS (
  SELECT r.house_id, r.meter_id, t.day_no, r.ts - t.day_start + t.origin + t.day_no * 86400 + {shift} AS ts,
         CAST(printf('%.2f', r.power * {factor}) AS DOUBLE) AS power
  FROM {source} r JOIN targets t ON r.house_id = t.house_id
   AND r.ts >= t.day_start AND r.ts < t.day_start + 86400)"""


def _assigned(houses: str) -> str:
    """Attributes of ``houses`` (a query of house_id), known or drawn."""
    return f"""WITH {ZIP_TABLE}, {KNOWN_HOUSES},
numbered AS (
  SELECT zip, row_number() OVER (ORDER BY substr(md5(zip || '|0'), 1, 3), zip) - 1 AS idx FROM zip_table),
houses AS ({houses}),
drawn AS (
  SELECT house_id, CAST(floor({_draw(11)} * 5) + 1 AS INTEGER) AS source_house,
         CAST(floor({_draw(13)} * (SELECT count(*) FROM zip_table)) AS BIGINT) AS idx,
         ({_draw(12)} * 2 - 1) * CAST(0.2 AS DOUBLE) + 1 AS scale
  FROM houses)
SELECT d.house_id, CASE WHEN k.house_id IS NULL THEN d.source_house ELSE k.source_house END AS source_house,
       CASE WHEN k.house_id IS NULL THEN n.zip ELSE k.zip END AS zip,
       round(CASE WHEN k.house_id IS NULL THEN d.scale ELSE k.scale END, 6) AS scale
FROM drawn d JOIN numbered n USING (idx) LEFT JOIN known k ON k.house_id = d.house_id"""


def all_oracles() -> dict[str, str]:
    flat_readings = f"WITH {READINGS} SELECT {FLAT} FROM readings"
    windows, alerts = WINDOWS, ALERTS
    energy_of = (
        f"WITH {ENERGY} SELECT house_id, date, zip, label, round(kwh, 10) AS kwh FROM label_days WHERE layer = "
    )
    return {
        "ts_to_date": f"""WITH {READINGS}
SELECT ts, date, strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%m/%d/%y') AS short_date FROM readings""",
        "day_floor": f"WITH {READINGS} SELECT ts, ts - ts % 86400 AS day_start FROM readings",
        "layer_split": f"WITH {READINGS} SELECT house_id, ts, meter_id, layer, power FROM readings",
        "pack_readings": f"""WITH {READINGS}, {PACKED.format(step=1)}
SELECT CAST(ts AS VARCHAR) AS timestamp, house_id, zip, layer, record_no,
       string_agg(meter_id || ':' || CAST(power AS VARCHAR) || ':' || label, ',' ORDER BY meter_id) AS payload
FROM packed GROUP BY ts, house_id, zip, layer, record_no""",
        "pack_readings_unique": f"""WITH {READINGS},
best AS (SELECT house_id, zip, layer, meter_id, ts, max(struct_pack(p := power, l := label)) AS b FROM readings GROUP BY ALL)
SELECT CAST(ts AS VARCHAR) AS timestamp, house_id, zip, layer,
       string_agg(meter_id || ':' || CAST(b.p AS VARCHAR) || ':' || b.l, ',' ORDER BY meter_id) AS payload
FROM best GROUP BY ts, house_id, zip, layer""",
        "expand_readings": flat_readings,
        "json_ingest": f"WITH {READINGS} SELECT house_id, ts, zip, label, meter_id, power FROM readings",
        "json_quarantine": f"""WITH {READINGS}, {PACKED.format(step=1)},
good AS (SELECT DISTINCT ts, house_id, zip, layer, record_no FROM packed)
SELECT 'accepted' AS reason, count(*) AS n_records FROM good
UNION ALL SELECT 'timestamp', count(*) FROM events
UNION ALL SELECT 'malformed', count(*) FROM documents""",
        "hourly_scan": f"""{flat_readings}
WHERE strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y-%m-%d-%H') BETWEEN '2024-01-10-06' AND '2024-01-12-17'""",
        "meter_day_energy": f"""WITH {ENERGY}
SELECT house_id, meter_id, zip, date, label, round(joules, 6) AS joules, n_readings FROM meter_days""",
        "daily_energy_appliance": energy_of + "'appliance'",
        "daily_energy_mains": energy_of + "'mains'",
        "appliance_share": SHARE,
        "appliance_share_joined": SHARE,
        "appliance_share_strict": f"""WITH {ENERGY},
mains AS (SELECT house_id, zip, date, kwh AS mains_kwh FROM label_days WHERE layer = 'mains')
SELECT house_id, date, zip, label, {PERCENT} AS percent
FROM label_days LEFT JOIN mains USING (house_id, zip, date) WHERE layer = 'appliance'""",
        "geo_energy": f"""WITH {ENERGY}
SELECT date, zip, round(sum(kwh), 10) AS kwh FROM label_days WHERE layer = 'mains' GROUP BY date, zip""",
        "meter_p97": f"WITH {STATS} SELECT house_id, meter_id, p97 FROM stats",
        "mains_record_power": f"""WITH {READINGS}, {PACKED.format(step=3600)}
SELECT a.house_id, a.date, a.ts, a.zip, round(a.power + b.power, 6) AS power
FROM packed a JOIN packed b USING (house_id, zip, step_start, record_no)
WHERE a.meter_id = '1' AND b.meter_id = '2'""",
        "rt_mains_power": windows,
        "rt_mains_power_stream": windows,
        "rt_mains_power_merge": windows,
        "rt_record_power_stream": f"""WITH {READINGS}, {PACKED.format(step=3600)}
SELECT a.ts - a.ts % 600 AS window_start, a.house_id, a.date, a.zip, round(sum(a.power + b.power), 6) AS watts_sum
FROM packed a JOIN packed b USING (house_id, zip, step_start, record_no)
WHERE a.meter_id = '1' AND b.meter_id = '2' GROUP BY 1, 2, 3, 4""",
        "rt_batch_power_stream": f"""WITH {READINGS}
SELECT house_id, date, zip, round(sum(power), 6) AS watts_sum
FROM readings WHERE layer = 'mains' GROUP BY house_id, date, zip""",
        "overshoot_alerts": alerts,
        "overshoot_alerts_stream": alerts,
        "channel_counts": f"""WITH {READINGS}
SELECT house_id, meter_id, count(*) AS n_readings FROM readings GROUP BY house_id, meter_id""",
        "gap_detect": f"""WITH {CLEAN}
SELECT house_id, day_start, prev_ts, ts, ts - prev_ts AS gap FROM clean_gaps WHERE ts - prev_ts > 18000""",
        "day_quality": f"""WITH {READINGS}, {_days("readings", "house_id, meter_id", 18000, "channel")}
SELECT house_id, meter_id, day_start, first_ts, last_ts, max_gap, n_readings FROM channel_days""",
        "clean_days": f"WITH {CLEAN} SELECT house_id, day_start FROM clean",
        "clean_days_common": f"""WITH {READINGS},
mains_rows AS (SELECT * FROM readings WHERE layer = 'mains'),
appliance_rows AS (SELECT * FROM readings WHERE layer = 'appliance'),
{_days("mains_rows", "house_id", 28800, "mains_clean")},
{_days("appliance_rows", "house_id", 28800, "appliance_clean")}
SELECT house_id, day_start FROM mains_clean INTERSECT SELECT house_id, day_start FROM appliance_clean""",
        "clean_day_readings": f"""WITH {CLEAN}
SELECT r.house_id, r.meter_id, r.ts, r.power, c.day_start
FROM readings r JOIN clean c ON r.house_id = c.house_id
 AND r.ts >= c.day_start AND r.ts < c.day_start + 86400""",
        "replicate_days": f"""WITH {CLEAN}, {_replay("readings", "clean", 30, STEP_FACTOR, -3600)}
SELECT house_id, meter_id, day_no, ts, power FROM replayed""",
        "label_lookup": f"""WITH {READINGS},
labels_of AS (SELECT house_id, meter_id, min(label) AS label FROM readings GROUP BY house_id, meter_id)
SELECT r.house_id, r.ts, r.meter_id, l.label, r.power
FROM readings r LEFT JOIN labels_of l USING (house_id, meter_id)""",
        "house_assign": _assigned("SELECT DISTINCT user_id AS house_id FROM events"),
        "zip_diff": f"WITH {READINGS}, {ZIP_TABLE} SELECT zip FROM zip_table EXCEPT SELECT zip FROM readings",
        "zip_refresh": f"""WITH {READINGS}, {ZIP_TABLE},
unused AS (SELECT zip FROM zip_table EXCEPT SELECT zip FROM readings),
chosen AS (SELECT zip FROM unused ORDER BY md5(zip || '|7'), zip LIMIT 50)
SELECT zip, primary_city, type FROM zip_table JOIN chosen USING (zip)""",
        "channel_files": f"""WITH {READINGS}
SELECT house_id, meter_id, ts, CAST(printf('%.2f', power) AS DOUBLE) AS power FROM readings""",
        "clean_day_files": f"WITH {CLEAN} SELECT house_id, day_start FROM clean",
        "label_files": f"""WITH {READINGS}
SELECT CAST(house_id AS INTEGER) AS source_house, meter_id, min(label) AS label FROM readings GROUP BY house_id, meter_id""",
        "zip_files": f"WITH {ZIP_TABLE} SELECT zip, primary_city, type FROM zip_table",
        "house_files": f"""WITH {KNOWN_HOUSES.split("WHERE")[0]})
SELECT house_id, source_house, zip, scale FROM known""",
        "batch_quarantine": """
SELECT 'timestamp' AS reason, count(*) AS n_records FROM events
UNION ALL SELECT 'malformed', count(*) FROM documents""",
        "table_upsert": f"""WITH {ENERGY},
latest AS (SELECT house_id, date, zip, label, kwh FROM label_days WHERE layer = 'mains'),
earlier AS (
  SELECT house_id, date, zip, label, joules / 1000 / 3600 AS kwh FROM meter_days WHERE meter_id = '1')
SELECT house_id, date, zip, label, round(kwh, 10) AS kwh FROM latest
UNION ALL
SELECT house_id, date, zip, label, round(kwh, 10) AS kwh
FROM earlier e ANTI JOIN latest l USING (house_id, date, zip, label)""",
        "rt_late_power_stream": LATE,
        "rt_power_merge_batches": windows,
        "rt_batch_power_packed": f"""WITH {READINGS}
SELECT house_id, date, zip, round(sum(power), 6) AS watts_sum
FROM readings WHERE layer = 'mains' GROUP BY house_id, date, zip""",
        "batch_runs_energy": f"WITH {ENERGY} SELECT house_id, date, zip, label, round(kwh, 10) AS kwh FROM label_days",
        "batch_runs_share": SHARE,
        "batch_runs_stats": f"WITH {STATS} SELECT house_id, meter_id, p97 FROM stats",
        "batch_file_ledger": """
SELECT 'accepted' AS outcome, count(*) AS n FROM events UNION ALL SELECT 'timestamp', count(*) FROM events""",
        "json_inference": f"""WITH {READINGS}, {PACKED.format(step=1)}
SELECT CAST(ts AS VARCHAR) AS timestamp, house_id, zip,
       string_agg(meter_id || ':' || CAST(power AS VARCHAR) || ':' || label, ',' ORDER BY meter_id) AS payload
FROM packed GROUP BY ts, house_id, zip, layer, record_no""",
        "topic_scan": f"{flat_readings} WHERE date = '2024-01-15'",
        "clean_days_all": f"""WITH {READINGS}, {_days("readings", "house_id, meter_id", 64800, "channel")},
wanted AS (SELECT house_id, count(DISTINCT meter_id) AS n_channels FROM readings WHERE ts >= 1704067200 GROUP BY house_id)
SELECT house_id, day_start FROM channel JOIN wanted USING (house_id)
GROUP BY house_id, day_start, n_channels HAVING count(*) = n_channels""",
        "replicate_days_drawn": f"""WITH {CLEAN}, {_replay("readings", "clean", 30, DRAWN_FACTOR)}
SELECT house_id, meter_id, day_no, ts, power FROM replayed""",
        "house_range": _assigned("SELECT unnest(range((SELECT min(user_id) FROM events), (SELECT max(user_id) + 1 FROM events))) AS house_id"),
        "zip_sample": f"""WITH {ZIP_TABLE}
SELECT zip FROM (SELECT zip FROM zip_table ORDER BY md5(zip || '|7'), zip LIMIT 1000)""",
        "replay_chain": f"""WITH {READINGS},
channels AS (SELECT house_id, meter_id, ts, label, CAST(printf('%.2f', power) AS DOUBLE) AS power FROM readings),
first_rows AS (SELECT * FROM channels WHERE meter_id = '1'),
third_rows AS (SELECT * FROM channels WHERE meter_id = '3'),
{_days("first_rows", "house_id", 43200, "first_clean")},
{_days("third_rows", "house_id", 43200, "third_clean")},
both_clean AS (SELECT house_id, day_start FROM first_clean INTERSECT SELECT house_id, day_start FROM third_clean),
{_replay("channels", "both_clean", 10, DRAWN_FACTOR)},
labels_of AS (SELECT house_id, meter_id, min(label) AS label FROM readings GROUP BY house_id, meter_id)
SELECT s_suppkey AS house_id, r.ts, printf('%05d', s_nationkey) AS zip, l.label, r.meter_id, r.power
FROM replayed r JOIN labels_of l USING (house_id, meter_id) JOIN supplier ON s_nationkey % 5 + 1 = r.house_id""",
        "house_history_indexed": energy_of + "'mains' AND house_id = 7",
        "batch_appliance_share": SHARE,
        "batch_meter_stats": f"WITH {STATS} SELECT house_id, meter_id, p97 FROM stats",
        "geo_on_date": f"""WITH {ENERGY}
SELECT date, zip, round(sum(kwh), 10) AS kwh FROM label_days
WHERE layer = 'mains' AND date = '2024-01-15' GROUP BY date, zip""",
        "house_history": energy_of + "'mains' AND house_id = 7",
        "appliance_breakdown": energy_of + "'appliance' AND house_id = 7 AND date = '2024-01-15'",
    }
