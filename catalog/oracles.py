"""DuckDB SQL with the result every query must give, over the same Parquet tables."""

from __future__ import annotations

#: Fixed values, stated here once more so that an error in the package would show.
EARLIEST_MS = "epoch_ms(timestamp '2011-01-01')"
LATEST_MS = "epoch_ms(timestamp '2027-01-01')"
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
REGIONS = """
Fukushima Region|36.5|139.0|38.5|141.5
East Asia|24.0|118.0|46.0|146.0
Europe|35.0|-11.0|71.0|40.0
North America|24.0|-125.0|50.0|-66.0
Australia|-43.7|113.3|-10.7|153.6
Austria|46.4|9.5|49.0|17.2
Belgium|49.5|2.5|51.5|6.4
Brazil|-33.8|-73.9|5.3|-34.8
Canada|41.7|-141.0|83.1|-52.6
China|18.2|73.5|53.6|134.8
Czech Republic|48.6|12.1|51.1|18.9
Denmark|54.6|8.1|57.8|15.2
Finland|59.8|20.0|70.1|31.6
France|41.3|-5.1|51.1|9.6
Germany|47.3|5.9|55.1|15.0
Japan|24.4|122.9|45.5|145.8
South Korea|33.1|124.6|38.6|129.6
Netherlands|50.8|3.4|53.5|7.2
New Zealand|-46.6|166.4|-34.4|178.6
Norway|57.9|4.6|71.2|31.1
Poland|49.0|14.1|54.9|24.2
Russia|41.2|19.6|81.9|180.0
Sweden|55.3|11.1|69.1|24.2
Switzerland|45.8|6.0|47.8|10.5
Ukraine|44.4|22.1|52.4|40.2
United Kingdom|49.9|-8.2|60.9|1.8
United States|24.4|-125.0|49.4|-66.9
"""

DAY = 86_400_000
AS_OF = "timestamp '2024-01-31'"
ARRIVAL = "arrival_ts, captured_at, event_id"

_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def _num(column: str) -> str:
    return f"case when regexp_full_match(trim({column}), '{_NUMBER}') then try_cast({column} as double) end"


def _round(expr: str, places: int) -> str:
    """Rounded by exact binary value, through printf."""
    return f"cast(printf('%.{places}f', {expr}) as double)"


def _avg(column: str = "cpm") -> str:
    return f"cast(sum(cast({column} as decimal(18,6))) as double) / count({column})"


def _level(cpm: str, t: str) -> str:
    return (
        f"case when {cpm} >= {t} * 3 then 'high' when {cpm} >= {t} * 2 then 'elevated' "
        f"when {cpm} >= {t} then 'warning' else 'safe' end"
    )


BASE = f"""
with recursive raw as (
 select event_id, user_id, ts as arrival_ts,
  case when event_id % 97 = 0 then ''
       when event_id % 73 = 0 then concat('2009', substr({_TS}, 5)) else {_TS} end as captured_time,
  {_TS} as uploaded_time,
  cast(case when event_id % 89 = 0 then 0.0
       else ((user_id * 7919) % 17001) / cast(100 as double) - 85 end as varchar) as latitude,
  cast(case when event_id % 89 = 0 then 0.0
       else ((user_id * 104729) % 36000) / cast(100 as double) - 180 end as varchar) as longitude,
  case when event_id % 83 = 0 then 'nan' when event_id % 79 = 0 then '10000'
       else cast(value as varchar) end as value,
  case when event_type = 'error' then 'usv' else ' CPM ' end as unit,
  case when event_id % 3 = 0 then concat(' D', user_id) else '' end as device_id,
  case when event_id % 7 = 0 then '' else md5(cast(event_id as varchar)) end as md5
 from events),
timed as (
 select *, try_strptime(nullif(trim(captured_time), ''), ['%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S']) as captured_ts
 from raw),
parsed as (
 select event_id, user_id, arrival_ts, captured_ts, uploaded_time as uploaded_at,
  cast(trunc(epoch_us(captured_ts) / 1e6 * 1e3) as bigint) as captured_at,
  {_num('latitude')} as latitude, {_num('longitude')} as longitude, {_num('value')} as cpm,
  lower(trim(unit)) as unit
 from timed),
judged as (
 select *, case
   when captured_at is null then 'no_time'
   when captured_at < {EARLIEST_MS} or captured_at > {LATEST_MS} then 'time_out_of_range'
   when unit <> 'cpm' then 'wrong_unit'
   when cpm is null then 'no_value'
   when cpm <= 0 or cpm >= 10000 then 'value_out_of_range'
   when latitude is null or longitude is null then 'no_position'
   when abs(latitude) > 90 or abs(longitude) > 180 then 'position_out_of_range'
   when latitude = 0 and longitude = 0 then 'null_island' end as reject_reason
 from parsed),
clean as (select * exclude (reject_reason) from judged where reject_reason is null),
enr as (
 select *, {_level('cpm', '50.0')} as level,
  upper(substr(md5(printf('%.6f_%.6f', latitude, longitude)), 1, 8)) as sensor_key
 from clean),
named as (
 select *, case when user_id % 3 = 0 then '' else concat('City ', user_id % 10) end as city,
  case when user_id % 5 = 0 then '' else concat('Land ', user_id % 25) end as country
 from enr)
"""


def _geohash(precision: int, lat: str = "latitude", lon: str = "longitude") -> tuple[str, str, str]:
    """SQL of (name, centre latitude, centre longitude), bit by bit."""
    total = 5 * precision
    lon_bits, lat_bits = (total + 1) // 2, total // 2

    def index(value: str, low: float, span: float, bits: int) -> str:
        step = span / 2**bits
        return (
            f"greatest(0, least({2**bits - 1}, cast(ceil(({value} - ({low!r}::double)) / {step!r}::double) as bigint) - 1))"
        )

    row, column = index(lat, -90.0, 180.0, lat_bits), index(lon, -180.0, 360.0, lon_bits)
    characters = []
    for k in range(precision):
        bits = []
        for p in range(5 * k, 5 * k + 5):
            source, left = (column, lon_bits) if p % 2 == 0 else (row, lat_bits)
            bits.append(f"(({source} >> {left - 1 - p // 2}) & 1) * {1 << (4 - p % 5)}")
        characters.append(f"substr('{GEOHASH_ALPHABET}', 1 + cast({' + '.join(bits)} as integer), 1)")
    return (
        " || ".join(characters),
        f"({row} + 5e-1) * {180.0 / 2**lat_bits!r}::double - 90",
        f"({column} + 5e-1) * {360.0 / 2**lon_bits!r}::double - 180",
    )


def _cells(precision: int = 2, unit: str = "day") -> str:
    name, lat, lon = _geohash(precision)
    return f""", located as (
 select date_trunc('{unit}', arrival_ts) as w, {name} as geohash, {lat} as lat, {lon} as lon, *
 from enr),
cells as (
 select w, w + interval 1 {unit} as w_end, geohash,
  {_round('max(lat)', 5)} as cell_lat, {_round('max(lon)', 5)} as cell_lon,
  {_round(_avg(), 2)} as avg_cpm, {_round('max(cpm)', 2)} as max_cpm, count(*) as "count",
  ['safe', 'warning', 'elevated', 'high'][1 + max(case level when 'high' then 3 when 'elevated' then 2
   when 'warning' then 1 else 0 end)] as level
 from located group by w, geohash)"""


_CELL_COLUMNS = """epoch_us(w) as window_start, epoch_us(w_end) as window_end, geohash,
 cell_lat, cell_lon, avg_cpm, max_cpm, "count", level"""

_RANKED = """, ranked as (
 select *, row_number() over (partition by w order by max_cpm desc, geohash) as rank
 from cells where level <> 'safe'),
top as (select w, max(w_end) as w_end, least(10, count(*) filter (level <> 'safe')) as n from cells group by w)"""

_FLAT_TOP = """
select epoch_us(t.w) as window_start, epoch_us(t.w_end) as window_end, t.n as hotspots_in_window,
 r.rank, r.geohash, r.cell_lat as lat, r.cell_lon as lon, r.max_cpm, r.avg_cpm, r.level, r."count"
from top t left join ranked r on r.w = t.w and r.rank <= 10"""


def _stats(unit: str) -> str:
    return f"""
select epoch_us(date_trunc('{unit}', arrival_ts)) as window_start,
 epoch_us(date_trunc('{unit}', arrival_ts) + interval 1 {unit}) as window_end,
 {_round(_avg(), 2)} as avg_cpm, {_round('max(cpm)', 2)} as max_cpm,
 count(distinct sensor_key) as active_sensors,
 count(*) filter (level <> 'safe') as alert_count, count(*) as reading_count
from enr group by date_trunc('{unit}', arrival_ts)"""


_ALERTS = f""", unsafe as (
 select *, row_number() over (partition by sensor_key order by {ARRIVAL}) as rn
 from named where level <> 'safe'),
walk as (
 select sensor_key, rn, event_id, level, captured_at as last_ts, true as emitted from unsafe where rn = 1
 union all
 select u.sensor_key, u.rn, u.event_id, u.level,
  case when u.level <> w.level or u.captured_at - w.last_ts > {DAY} then u.captured_at else w.last_ts end,
  u.level <> w.level or u.captured_at - w.last_ts > {DAY}
 from walk w join unsafe u on u.sensor_key = w.sensor_key and u.rn = w.rn + 1),
alerts as (select u.* from unsafe u join walk w on w.event_id = u.event_id where w.emitted)"""

_EMA = f""", ordered as (
 select *, lag(cpm) over s as previous_cpm,
  list(cpm) over (partition by sensor_key order by {ARRIVAL}
   rows between unbounded preceding and current row) as seen
 from enr window s as (partition by sensor_key order by {ARRIVAL})),
averaged as (
 select *, list_reduce(seen, lambda a, x: 2e-1 * x + 8e-1 * a) as ema,
  case when len(seen) > 1 then list_reduce(seen[:-2], lambda a, x: 2e-1 * x + 8e-1 * a) end as average_before
 from ordered),
spiky as (
 select *, coalesce(cpm / previous_cpm >= 2.5, false) as point,
  coalesce(cpm / average_before >= 2.5, false) as rolling
 from averaged),
spikes as (
 select *, case when point and rolling then 'point_and_average' when point then 'point_to_point'
  else 'rolling_average' end as spike_type,
  {_round('average_before', 2)} as rolling_avg_cpm,
  {_round('cpm / previous_cpm', 2)} as jump_ratio
 from spiky where point or rolling)"""

_SPIKE_ROWS = """
select event_id, sensor_key, captured_at, cpm, spike_type, previous_cpm, rolling_avg_cpm, jump_ratio
from spikes"""

#: The last reading of a sensor that each five-hour frame newly shows.
_FILM = """, framed as (
 select *, greatest(0, cast(ceil((epoch_us(arrival_ts) // 1000 - epoch_ms(timestamp '2024-01-01')) / 18e6) as bigint)) as frame from enr),
changes as (
 select * from framed
 qualify row_number() over (partition by sensor_key, frame order by arrival_ts desc, event_id desc) = 1)"""

#: Rows of three sources dealt to four parts, and the watermark before each part: the slowest source's
#: latest time less a day, sources five days behind the fastest left out.
_LEDGER = """, due as (
 select *, 's' || user_id % 3 as source,
  case when arrival_ts < timestamp '2024-01-11' then 0 when arrival_ts < timestamp '2024-01-21' then 1 else 2 end as turn from enr),
dealt as (
 select *, case when source = 's2' and turn = 1 then 2 else turn + (event_id % 11 = 3)::int end as part from due),
clocks as (
 select p as part, source, max(epoch_us(arrival_ts)) as latest from dealt, (values (1), (2), (3)) v(p) where part < p group by p, source),
marks as (
 select part, max(mark) over (order by part) as mark from (
  select part, min(latest) filter (where latest >= fastest - 5 * 86400000000) - 86400000000 as mark
  from (select *, max(latest) over (partition by part) as fastest from clocks) group by part)),
judged_rows as (
 select d.*, mark, coalesce(epoch_us(date_trunc('day', arrival_ts) + interval 1 day) <= mark, false) as late
 from dealt d left join marks using (part))"""

_RAW_JSON = """'{"captured_time":"' || captured_time || '","uploaded_time":"' || uploaded_time || '","latitude":"' || latitude
 || '","longitude":"' || longitude || '","value":"' || value || '","unit":"' || unit
 || '","location_name":"","device_id":"' || device_id || '","md5":"' || md5
 || '","height":"","surface":"","radiation":"","loader_id":""}'"""

#: Readings whose sensor is named after each stretch without a day of silence.
_STRETCHED = f""", gaps as (
 select *, coalesce(epoch_us(arrival_ts) - lag(epoch_us(arrival_ts)) over s > {DAY * 1000}, false) as fresh
 from named window s as (partition by sensor_key order by {ARRIVAL})),
stretched as (
 select * exclude (fresh) replace (sensor_key || '#' || sum(fresh::int) over (partition by sensor_key order by {ARRIVAL}) as sensor_key)
 from gaps)"""
_OF_SENSOR = "replace (split_part(sensor_key, '#', 1) as sensor_key)"

_LATEST = f"""
select event_id, sensor_key, captured_at, cpm, level from enr
qualify row_number() over (partition by sensor_key order by captured_at desc, {ARRIVAL}) = 1"""

_NEWEST = f"""
select event_id, sensor_key, captured_at, cpm, level from enr
qualify captured_at > coalesce(max(captured_at) over (partition by sensor_key order by {ARRIVAL}
 rows between unbounded preceding and 1 preceding), 0)"""

_PLACES = """, places as (
 select c_custkey as place_id, c_name as city, c_nationkey as cc,
  ((c_custkey * 3571) % 17001) / cast(100 as double) - 85 as plat,
  ((c_custkey * 9973) % 36000) / cast(100 as double) - 180 as plon
 from customer),
sphere as (
 select *, cos(radians(plat)) * cos(radians(plon)) as px, cos(radians(plat)) * sin(radians(plon)) as py,
  sin(radians(plat)) as pz
 from places)"""


def _nearest(points: str) -> str:
    """CTEs that find the nearest place of every (lat, lon) in the CTE ``points`` by trying all."""
    return f""", around as (
 select lat, lon, cos(radians(lat)) * cos(radians(lon)) as x, cos(radians(lat)) * sin(radians(lon)) as y,
  sin(radians(lat)) as z
 from {points}),
nearest as (
 select lat, lon, place_id, city, cc, pow(px - x, 2) + pow(py - y, 2) + pow(pz - z, 2) as chord
 from around, sphere
 qualify row_number() over (partition by lat, lon order by chord, place_id) = 1),
labelled as (
 select lat, lon, city, coalesce(n.n_name, cast(cc as varchar)) as country
 from nearest left join nation n on n.n_nationkey = cc and n.n_nationkey <> 7)"""


def _between(expr: str, low, high) -> str:
    return f"{expr} between ({low!r}) and ({high!r})"


_SENSOR_NAMES = ", points as (select distinct latitude as lat, longitude as lon from clean)" + _PLACES + _nearest("points")
_CELL_NAMES = ", points as (select distinct cell_lat as lat, cell_lon as lon from cells)" + _PLACES + _nearest("points")
_NAMED_TOP = _FLAT_TOP.replace("select ", "select l.city, l.country, ", 1) + """
left join labelled l on l.lat = r.cell_lat and l.lon = r.cell_lon"""

_REGIONS = ", ".join(
    "('{}', {}::double, {}::double, {}::double, {}::double)".format(*line.split("|")) for line in REGIONS.strip().split("\n")
)

_CAP = """, firsts as (
 select sensor_key, min(arrival_ts) as first_seen,
  min(event_id) as first_event from enr group by sensor_key)"""

_NAME = """coalesce(nullif(concat_ws(', ', nullif(city, ''), nullif(country, '')), ''),
 printf('%.4f, %.4f', latitude, longitude))"""
_ALERT_TEXT = f"""case level when 'safe' then 'safe radiation' when 'warning' then 'Elevated radiation'
 when 'elevated' then 'High radiation' else 'Dangerous radiation' end || ' detected in ' || {_NAME}"""

_READING_COLUMNS = """make_timestamp(captured_at * 1000) as captured_moment, arrival_ts, sensor_key, city, country,
 latitude, longitude, cpm, level"""

ORACLES: dict[str, str] = {
    "csv_scan": BASE + """, fields as (
 select captured_time, uploaded_time, latitude, longitude, value, unit, '' as location_name, device_id, md5,
  '' as height, '' as surface, '' as radiation, '' as loader_id from raw)
select * from fields union all select * from fields where md5 >= '8'""",
    "newest_first_capped": BASE + """select event_id, epoch_us(arrival_ts) as uploaded_ts from raw
 order by arrival_ts desc, event_id desc limit 1000""",
    "raw_messages": BASE + f"select event_id, {_RAW_JSON} as value from raw",
    "csv_messages": BASE + """select event_id, captured_time, latitude, longitude, value, unit, device_id, md5
 from raw""",
    "partition_keys": BASE + f"""select event_id, case when trim(device_id) <> '' then 'dev:' || trim(device_id)
 else 'geo:' || cast({_round('cast(latitude as double)', 4)} as varchar) || ','
  || cast({_round('cast(longitude as double)', 4)} as varchar) end as "key" from raw""",
    "readings_table": BASE + f"""select epoch_us(make_timestamp(captured_at * 1000)) as captured_at,
 epoch_us(arrival_ts) as ingested_at, sensor_key, city, country, latitude, longitude, cpm, level
 from named where arrival_ts > {AS_OF} - interval 240 hours""",
    "alerts_table": BASE + _ALERTS + f"""select epoch_us(make_timestamp(captured_at * 1000)) as captured_at,
 epoch_us(arrival_ts) as ingested_at, sensor_key, city, country, latitude, longitude, cpm, level,
 {_ALERT_TEXT} as alert_text from alerts""",
    "retained": BASE + f"""select event_id, sensor_key, captured_at from enr
 where captured_at >= epoch_ms({AS_OF} - interval 10 days)""",
    "feed_union": BASE + _ALERTS + _EMA + """,
 sent as (
 select 'current' as channel, sensor_key, captured_at, level from ("""
    + _LATEST
    + """)
 union all select 'alerts', sensor_key, captured_at, level from alerts
 union all select 'spikes', sensor_key, captured_at, level from spiky where point)
select channel, '{"sensor_key":"' || sensor_key || '","captured_at":' || captured_at || ',"level":"' || level
 || '"}' as data from sent""",
    "current_cells": BASE + _cells() + f"""select {_CELL_COLUMNS} from cells
qualify row_number() over (partition by geohash order by w_end desc) = 1 and w_end > {AS_OF} - interval 300 seconds""",
    "valid_cells": BASE + _cells() + """select epoch_us(w) as window_start, geohash, "count", level from cells
where "count" % 3 <> 2 and geohash >= '9'""",
    "snapshot_messages": BASE + _cells() + _RANKED
    + ", points as (select latitude as lat, longitude as lon from clean union select cell_lat, cell_lon from cells)"
    + _PLACES + _nearest("points") + f""", newest as (
 select * from enr qualify row_number() over (partition by sensor_key order by captured_at desc, {ARRIVAL}) = 1),
shown as (
 select s.*, l.city, l.country from newest s join labelled l on lat = latitude and lon = longitude
 where arrival_ts > {AS_OF} - interval 43200 seconds),
board as (
 select c.*, l.city, l.country
 from (select * from cells qualify row_number() over (partition by geohash order by w_end desc) = 1
  and w_end > {AS_OF} - interval 300 seconds) c join labelled l on lat = cell_lat and lon = cell_lon),
sensor_parts as (
 select cast(('0x' || substr(md5(sensor_key), 1, 8))::bigint % greatest(1, ceil((select count(*) from shown) / 5))::bigint as integer)
  as part, sensor_key as k, '{{"sensor_key":"' || sensor_key || '","captured_at":' || captured_at || ',"uploaded_at":"' || uploaded_at
  || '","latitude":' || latitude || ',"longitude":' || longitude || ',"cpm":' || cpm || ',"level":"' || level || '","city":"' || city
  || '","country":"' || country || '"}}' as item from shown),
cell_parts as (
 select cast(('0x' || substr(md5(geohash), 1, 8))::bigint % greatest(1, ceil((select count(*) from board) / 5))::bigint as integer)
  as part, geohash as k, '{{"geohash":"' || geohash || '","cell_lat":' || cell_lat || ',"cell_lon":' || cell_lon || ',"avg_cpm":' || avg_cpm
  || ',"max_cpm":' || max_cpm || ',"count":' || "count" || ',"level":"' || level || '","city":"' || city || '","country":"' || country
  || '"}}' as item from board),
listed as (
 select w, string_agg('{{"rank":' || rank || ',"geohash":"' || geohash || '","city":"' || l.city || '","country":"' || l.country
  || '","lat":' || cell_lat || ',"lon":' || cell_lon || ',"max_cpm":' || max_cpm || ',"avg_cpm":' || avg_cpm || ',"level":"' || level
  || '","count":' || "count" || '}}', ',' order by rank) as items
 from ranked join labelled l on lat = cell_lat and lon = cell_lon where rank <= 10 group by w)
select 'map' as channel, part, '{{"points":[' || string_agg(item, ',' order by k) || ']}}' as data from sensor_parts group by part
union all
select 'heatmap', part, '{{"cells":[' || string_agg(item, ',' order by k) || ']}}' from cell_parts group by part
union all
(select 'stats', 0, '{{"avg_cpm":' || avg_cpm || ',"max_cpm":' || max_cpm || ',"active_sensors":' || active_sensors
 || ',"alert_count":' || alert_count || ',"reading_count":' || reading_count || '}}' from ({_stats('day')}) order by window_end desc limit 1)
union all
(select 'top', 0, '{{"count":' || n || ',"hotspots":[' || coalesce(items, '') || ']}}'
 from top left join listed using (w) order by top.w_end desc limit 1)""",
    "ingest_rate": BASE + """select epoch_us(date_trunc('hour', arrival_ts)) as bucket, count(*) as rows,
 count(*) / 3600e0 as rows_per_second from raw group by date_trunc('hour', arrival_ts)""",
    "replay_schedule": BASE + f""", known as (
 select event_id, case when event_id % 11 = 0 then null else arrival_ts end as t from raw),
based as (
 select event_id, t, last_value(t ignore nulls) over (order by event_id
  rows between unbounded preceding and 1 preceding) as base from known),
paced as (
 select event_id, coalesce(least(greatest((epoch_us(t) - epoch_us(base)) / 1e6, 0) * 1e-2, 3e0), 0e0) as delay
 from based),
running as (
 select event_id, delay, cast(sum(cast(delay as decimal(24,9))) over (order by event_id) as double) as total
 from paced)
select event_id, {_round('delay', 4)} as delay_seconds, {_round('total', 3)} as offset_seconds from running""",
    "parse_readings": BASE + """select event_id, captured_at, uploaded_at, latitude, longitude, cpm, unit,
 captured_at * 1000 as captured_ts from parsed""",
    "clean_readings": BASE + """select event_id, captured_at, uploaded_at, latitude, longitude, cpm from clean""",
    "rejects_by_reason": BASE + """select coalesce(reject_reason, 'clean') as outcome, count(*) as rows
 from judged group by 1""",
    "rejected_readings": BASE + """select event_id, reject_reason from judged where reject_reason is not null""",
    "raw_clean_dropped": """select (select count(*) from events) as raw,
 (select count(*) from clean) as clean, (select count(*) from judged where reject_reason is not null) as dropped""",
    "valid_readings": BASE + """select event_id, sensor_key, captured_at from enr where event_id % 13 <> 0""",
    "sensor_keys": BASE + """select latitude, longitude, count(*) as rows, min(sensor_key) as sensor_key
 from enr group by latitude, longitude""",
    "geohash_cells": BASE + "select event_id, latitude, longitude, {} as geohash, {} as cell_lat, {} as cell_lon from enr".format(
        *_geohash(5)
    ),
    "classify_levels": BASE + "select event_id, cpm, level from enr",
    "level_bands": BASE + """select event_id, case when cpm >= 300 then 'high' when cpm >= 100 then 'elevated'
 when cpm >= 50 then 'warning' else 'safe' end as level from enr""",
    "levels_runtime_threshold": BASE + f""", changes(effective_at, threshold) as (values
 (timestamp '2024-01-01', 50e0), (timestamp '2024-01-10', 100e0), (timestamp '2024-01-20', 30e0)),
judged_by as (
 select c.*, coalesce(h.threshold, 100e0) as threshold
 from clean c asof left join changes h on c.arrival_ts >= h.effective_at)
select event_id, threshold, {_level('cpm', 'threshold')} as level from judged_by""",
    "nearest_place": BASE + ", points as (select distinct latitude as lat, longitude as lon from clean)"
    + _PLACES + _nearest("points") + f"""
select lat as latitude, lon as longitude, place_id, city, cast(cc as varchar) as cc,
 {_round('2 * 6371.0088e0 * asin(least(1e0, sqrt(chord) / 2))', 3)} as distance_km from nearest""",
    "reading_places": BASE + ", points as (select distinct latitude as lat, longitude as lon from clean)"
    + _PLACES + _nearest("points") + """
select event_id, latitude, longitude, city, country from enr join labelled on lat = latitude and lon = longitude""",
    "cell_places": BASE + _cells(3) + ", points as (select distinct cell_lat as lat, cell_lon as lon from cells)"
    + _PLACES + _nearest("points") + """
select epoch_us(w) as window_start, geohash, cell_lat, cell_lon, city, country
from cells join labelled on lat = cell_lat and lon = cell_lon""",
    "country_names": """select c_custkey as place_id, cast(c_nationkey as varchar) as cc,
 coalesce(n_name, cast(c_nationkey as varchar)) as country
 from customer left join nation on n_nationkey = c_nationkey and n_nationkey <> 7""",
    "display_names": BASE + f"""select event_id, {_NAME} as display_name,
 coalesce(nullif(concat_ws(', ', nullif(city, ''), nullif(country, '')), ''), sensor_key) as label from named""",
    "alert_texts": BASE + f"select event_id, {_ALERT_TEXT} as alert_text from named",
    "heat_intensity": BASE + """select event_id, case level when 'high' then 1e0 when 'elevated' then 7e-1
 when 'warning' then 4e-1 else 15e-2 end as intensity, 4e0 + least(8e0, cpm / 60) as radius from enr""",
    "region_tags": BASE + f""", regions(label, s, w, n, e) as (values {_REGIONS})
select event_id, latitude, longitude, label from enr
join regions on latitude between s and n and longitude between w and e""",
    "points_in_region": BASE + f"""select event_id from enr
 where {_between('latitude', 24.0, 50.0)} and {_between('longitude', -125.0, -66.0)}""",
    "points_filtered": BASE + ", newest as (" + _LATEST.replace("cpm, level", "cpm, level, latitude, longitude") + """)
select sensor_key, latitude, longitude, cpm, level from newest
where cpm >= 10 and latitude between -60 and 70 and longitude between -100 and 120
order by sensor_key limit 500""",
    "unsafe_readings": BASE + "select event_id, sensor_key, captured_at, level from enr where level <> 'safe'",
    "global_stats": BASE + _stats("hour"),
    "merged_stats": BASE + _stats("day"),
    "heatmap": BASE + _cells() + f"select {_CELL_COLUMNS} from cells",
    "top_hotspots": BASE + _cells() + _CELL_NAMES + _RANKED + _NAMED_TOP,
    "timeseries": BASE + f"""select epoch_us(time_bucket(interval 2 hours, arrival_ts)) as bucket,
 {_avg()} as avg_cpm, max(cpm) as max_cpm, count(*) as reading_count
 from enr where arrival_ts > {AS_OF} - interval 24 hours group by time_bucket(interval 2 hours, arrival_ts)""",
    "current_stats": BASE + _stats("hour") + " order by window_start desc limit 1",
    "current_top": BASE + _cells() + _RANKED + """
select n as hotspots_in_window, rank, geohash, max_cpm, level from ranked join top using (w)
where rank <= 10 and w = (select max(w) from cells)""",
    "live_sensors": BASE + f"""select count(distinct sensor_key) as sensors from enr
 where arrival_ts > {AS_OF} - interval 3600 seconds""",
    "distinct_sensors": BASE + "select distinct sensor_key from enr",
    "extent": BASE + """select min(latitude) as s, min(longitude) as w, max(latitude) as n, max(longitude) as e
 from enr""",
    "replay_progress": BASE + """, bounds as (
 select epoch_us(min(arrival_ts)) // 1000 as t0, epoch_us(max(arrival_ts)) // 1000 as t1 from enr)
select t0, t1, cast(floor(100 * (epoch_ms(timestamp '2024-01-11') - t0) / (t1 - t0) + 5e-1) as integer) as progress
from bounds""",
    "sparkline": BASE + f""", series as (
 select time_bucket(interval 2 hours, arrival_ts) as bucket, {_avg()} as avg_cpm from enr group by 1
 order by 1 desc limit 30),
placed as (
 select *, row_number() over (order by bucket) - 1 as i, count(*) over () as n, min(avg_cpm) over () as low,
  greatest(max(avg_cpm) over (), min(avg_cpm) over () + 1) as high from series)
select epoch_us(bucket) as bucket, avg_cpm, {_round('i / (n - 1) * 268', 1)} as x,
 {_round('40 - (avg_cpm - low) / (high - low) * 40', 1)} as y from placed""",
    "latest_emissions": BASE + """select event_id, sensor_key, captured_at from enr
qualify captured_at > coalesce(max(captured_at) over (partition by sensor_key order by event_id % 10, event_id
 rows between unbounded preceding and 1 preceding), 0)""",
    "latest_per_sensor": BASE + _LATEST,
    "alerts_dedup": BASE + _ALERTS + "select event_id, sensor_key, captured_at, level from alerts",
    "point_spikes": BASE + _EMA + """select event_id, sensor_key, captured_at, cpm, previous_cpm from spiky
 where point""",
    "sensor_ema": BASE + _EMA + f"select event_id, sensor_key, {_round('ema', 6)} as ema from averaged",
    "rolling_spikes": BASE + _EMA + f"""select event_id, sensor_key, captured_at, cpm,
 {_round('average_before', 2)} as rolling_avg_cpm from spiky where rolling""",
    "spike_events": BASE + _EMA + _SPIKE_ROWS,
    "recent_alerts": BASE + _ALERTS + """select event_id, sensor_key, captured_at, level from alerts
 order by arrival_ts desc, event_id desc limit 20""",
    "recent_spikes": BASE + _EMA + """select event_id, sensor_key, captured_at, spike_type from spikes
 order by arrival_ts desc, event_id desc limit 50""",
    "console_ticks": BASE + """select event_id, sensor_key, captured_at, cpm, level from enr
 order by arrival_ts desc, event_id desc limit 50""",
    "points_history": BASE + """select event_id, sensor_key, captured_at, epoch_us(arrival_ts) as ingested_at, cpm, level
 from enr where arrival_ts between timestamp '2024-01-05' and timestamp '2024-01-20'
 order by arrival_ts, event_id limit 2000""",
    "sensor_history": BASE + """select event_id, sensor_key, captured_at, epoch_us(arrival_ts) as ingested_at, cpm, level
 from enr where sensor_key = (select min(sensor_key) from enr)
 and arrival_ts > timestamp '2024-01-20' - interval 48 hours""",
    "alert_history": BASE + _ALERTS + f"""select event_id, sensor_key, captured_at, epoch_us(arrival_ts) as arrival_ts, level
 from alerts where arrival_ts > {AS_OF} - interval 24 hours""",
    "all_sensors": BASE + """select event_id, sensor_key, captured_at, epoch_us(arrival_ts) as ingested_at, cpm from enr
qualify row_number() over (partition by sensor_key order by arrival_ts desc, event_id desc) = 1""",
    "active_cells": BASE + _cells() + f"""select epoch_us(w) as window_start, geohash, "count" from cells
 where geohash in (select geohash from located where arrival_ts > {AS_OF} - interval 21600 seconds)
 or not exists (select 1 from located where arrival_ts > {AS_OF} - interval 21600 seconds)""",
    "evicted_cells": BASE + _cells() + _CAP + """, kept as (
 select sensor_key from firsts order by first_seen desc, first_event desc limit 60)
select epoch_us(w) as window_start, geohash, "count" from cells
where geohash in (select geohash from located where sensor_key in (select sensor_key from kept))""",
    "replay_frame": BASE + """select event_id, sensor_key, captured_at, cpm, level from enr
where arrival_ts <= timestamp '2024-01-15'
qualify row_number() over (partition by sensor_key order by arrival_ts desc, event_id desc) = 1""",
    "replay_frames": BASE + """select cast(ceil((epoch_us(arrival_ts) // 1000 - epoch_ms(timestamp '2024-01-01')) / 18e6) as bigint)
 as frame, count(*) as rows, count(distinct sensor_key) as sensors from enr group by 1""",
    "replay_film": BASE + _FILM + """
select frame // 24 as segment, frame, false as is_key, event_id, sensor_key, captured_at from changes
union all
select segment, frame, true, event_id, sensor_key, captured_at
from changes, (select unnest(range(1, (select max(frame) // 24 + 1 from changes))) as segment)
where frame < segment * 24
qualify row_number() over (partition by segment, sensor_key order by frame desc) = 1""",
    "replay_film_frames": BASE + """, numbers as (select unnest(range(0, 145, 7)) as number)
select number, event_id, sensor_key, captured_at, cpm, level from enr, numbers
where epoch_us(arrival_ts) // 1000 - epoch_ms(timestamp '2024-01-01') <= number * 18000000
qualify row_number() over (partition by number, sensor_key order by arrival_ts desc, event_id desc) = 1""",
    "compacted_readings": BASE + """select epoch_us(make_timestamp(captured_at * 1000)) as captured_at,
 epoch_us(arrival_ts) as ingested_at, sensor_key, city, country, latitude, longitude, cpm, level from named""",
    "replay_order": BASE + """select event_id, epoch_us(arrival_ts) as ingested_at from enr
 where event_id % 17 <> 0""",
    "sensor_cap": BASE + _CAP + """select sensor_key, epoch_us(first_seen) as first_seen from firsts
 order by firsts.first_seen desc, first_event desc limit 100""",
    "stream_clean": BASE + _SENSOR_NAMES + """
select event_id, sensor_key, captured_at, cpm, level, l.city, l.country
from enr join labelled l on lat = latitude and lon = longitude""",
    "stream_levels_runtime_threshold": BASE + f"""select event_id,
 {_level('cpm', "case when arrival_ts < timestamp '2024-01-11' then 50e0 when arrival_ts < timestamp '2024-01-21' then 100e0 else 30e0 end")}
 as level from clean""",
    "stream_latest": BASE + _NEWEST,
    "stream_alerts": BASE + _ALERTS + _SENSOR_NAMES + """
select event_id, sensor_key, captured_at, level, l.city, l.country
from alerts join labelled l on lat = latitude and lon = longitude""",
    "stream_spikes": BASE + _EMA + _SPIKE_ROWS,
    "stream_keyed_products": BASE + _STRETCHED + _ALERTS.replace("from named", "from stretched") + f""",
newest as ({_NEWEST.replace("from enr", "from stretched")}),
both_products as (
 select 'current' as product, event_id, sensor_key, captured_at, level from newest
 union all select 'alerts', event_id, sensor_key, captured_at, level from alerts)
select * {_OF_SENSOR} from both_products""",
    "stream_keyed_spikes": BASE + _STRETCHED + _EMA.replace("from enr", "from stretched") + f""",
found as ({_SPIKE_ROWS})
select * {_OF_SENSOR} from found""",
    "log_records": BASE + f"""select 'radiation-raw' as topic, cast(user_id as varchar) as key, epoch_us(arrival_ts) as arrival_ts,
 md5('{{"event_id":"' || event_id || '",' || substr({_RAW_JSON}, 2)) as value_md5 from raw""",
    "log_fan_out": BASE + _ALERTS + """
select 'clean' as product, event_id, sensor_key, captured_at, level from enr
union all select 'alerts', event_id, sensor_key, captured_at, level from alerts""",
    "log_paced": """
select cast(user_id as varchar) as key, count(*) as records, epoch_us(max(ts)) as latest, turn
from events, (values (0, timestamp '2024-01-11'), (1, timestamp '2024-01-26')) t(turn, until)
where ts <= until group by user_id, turn""",
    "late_rows": BASE + _LEDGER + f"""
select event_id, cast(part as integer) as batch_id, source, {_round("(mark - epoch_us(arrival_ts)) / 1e6", 3)} as late_seconds
from judged_rows where late""",
    "late_windows": BASE + _LEDGER + _stats("day").replace("from enr", "from judged_rows where not late"),
    "merged_stats_sketched": BASE + f"select s.* exclude (active_sensors), active_sensors as sensors, true as close from ({_stats('day')}) s",
    "stream_progress": """select case when ts < timestamp '2024-01-11' then 0 when ts < timestamp '2024-01-21' then 1 else 2 end as batch_id,
 count(*) as rows, 0 as late_rows from events group by 1""",
    "stream_merged_windows": BASE + _stats("day"),
    "stream_global_stats": BASE + _stats("day"),
    "stream_heatmap": BASE + _cells() + _CELL_NAMES + f"""
select {_CELL_COLUMNS}, city, country from cells join labelled on lat = cell_lat and lon = cell_lon""",
    "stream_top_hotspots": BASE + _cells() + _CELL_NAMES + _RANKED + _NAMED_TOP,
    "stream_readings_table": BASE + _SENSOR_NAMES + """
select epoch_us(make_timestamp(captured_at * 1000)) as captured_at, epoch_us(arrival_ts) as ingested_at, sensor_key,
 l.city, l.country, latitude, longitude, cpm, level from enr join labelled l on lat = latitude and lon = longitude""",
    "stream_alerts_table": BASE + _ALERTS + _SENSOR_NAMES + f""", found as (
 select a.* exclude (city, country), l.city, l.country
 from alerts a join labelled l on lat = latitude and lon = longitude)
select epoch_us(make_timestamp(captured_at * 1000)) as captured_at, epoch_us(arrival_ts) as ingested_at, sensor_key, city,
 country, latitude, longitude, cpm, level, {_ALERT_TEXT} as alert_text from found""",
    "retention_drop": BASE + f"""select sensor_key, epoch_us(make_timestamp(captured_at * 1000)) as captured_at,
 epoch_us(arrival_ts) as ingested_at, cpm from enr where cast(arrival_ts as date) >= cast({AS_OF} - interval 10 days as date)""",
}
ORACLES["raw_clean_dropped"] = BASE + ORACLES["raw_clean_dropped"]
