"""The same queries as plain SQL over the test tables, for comparison only.

For models it states what holds whatever the fit.
"""

from __future__ import annotations

from casebeacon.plans.models import CASE_FEATURES, CASE_MODEL, OUTBREAK_FEATURES, OUTBREAK_MODEL
from casebeacon.schemas import REQUIRED_FIELDS

_VIEWS = {
    "cases": """
SELECT e.event_id AS event_id, concat('C', CAST(e.event_id AS VARCHAR)) AS case_id, e.ts AS ts,
  r.r_name AS region_id, n.n_name AS district,
  CAST((e.user_id * 7 + e.event_id) % 90 AS INT) AS patient_age,
  CASE WHEN e.event_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CAST(to_json(list_slice(['cough','rash','nausea','ache'], 1, 1 + e.event_id % 4)) AS VARCHAR) AS symptoms_json,
  CAST(1 + e.event_id % 4 AS INT) AS symptom_count,
  CASE WHEN e.event_type IN ('error', 'purchase') THEN 'positive' ELSE 'negative' END AS rapid_test_result,
  CAST(36.0 AS DOUBLE) + CAST(e.event_id % 46 AS DOUBLE) / 10 AS body_temperature,
  CAST(18.0 AS DOUBLE) + CAST((e.event_id * 13) % 141 AS DOUBLE) / 10 AS ambient_temperature,
  CAST(40.0 AS DOUBLE) + CAST(json_extract_string(e.props, '$.k') AS DOUBLE) * 0.55 AS humidity,
  e.value AS rainfall_mm
FROM events e
JOIN region r ON e.user_id % 5 = r.r_regionkey
JOIN nation n ON e.user_id % 25 = n.n_nationkey""",
    "cases_raw": """
SELECT case_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_text,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE region_id END AS region_id,
  district, patient_age, gender, symptoms_json,
  CASE WHEN event_id % 211 = 0 THEN 'unclear'
       WHEN event_id % 3 = 0 THEN upper(rapid_test_result)
       WHEN event_id % 3 = 1 THEN concat(upper(substr(rapid_test_result, 1, 1)), substr(rapid_test_result, 2))
       ELSE rapid_test_result END AS rapid_test_result,
  humidity, rainfall_mm
FROM cases
UNION ALL
SELECT case_id, strftime(ts + INTERVAL '1' SECOND, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_text, region_id,
  district, patient_age + 1 AS patient_age, gender,
  symptoms_json, rapid_test_result, humidity, rainfall_mm
FROM cases WHERE event_id % 50 = 0""",
    "scored": """
SELECT case_id, region_id, patient_age, gender,
  CAST(CASE WHEN rapid_test_result = 'positive' THEN 1 ELSE 0 END AS DOUBLE) AS label,
  CAST(CASE WHEN rainfall_mm > 40 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
FROM cases""",
    "windows": """
SELECT region_id, date_trunc('day', ts) AS date, count(*) AS total_cases,
  CAST(sum(CASE WHEN rapid_test_result = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive_cases,
  round(avg(rainfall_mm), 6) AS avg_rainfall, round(avg(humidity), 6) AS avg_humidity,
  round(avg(ambient_temperature), 6) AS avg_temperature, round(avg(symptom_count), 6) AS avg_symptoms,
  CAST(CASE WHEN 5 * sum(CASE WHEN rapid_test_result = 'positive' THEN 1 ELSE 0 END) > 2 * count(*) THEN 1 ELSE 0 END AS DOUBLE) AS prediction
FROM cases GROUP BY region_id, date_trunc('day', ts)""",
    "importances": """
SELECT m.model_name, m.feature_name, round(CASE m.feature_name
    WHEN 'patient_age' THEN a.age WHEN 'humidity' THEN a.humidity
    WHEN 'rainfall_mm' THEN a.rain ELSE a.temperature END
  / (a.age + a.humidity + a.rain + a.temperature), 6) AS importance
FROM (SELECT avg(patient_age) AS age, avg(humidity) AS humidity, avg(rainfall_mm) AS rain,
        avg(ambient_temperature) AS temperature FROM cases) a
CROSS JOIN (VALUES ('case_risk', 'patient_age'), ('case_risk', 'humidity'), ('case_risk', 'rainfall_mm'),
  ('case_risk', 'ambient_temperature'), ('outbreak', 'humidity'), ('outbreak', 'rainfall_mm'),
  ('outbreak', 'ambient_temperature')) m(model_name, feature_name)""",
    "records": """
SELECT event_id, region_id, concat('{',
  CASE WHEN event_id % 103 = 0 THEN '' ELSE concat('"region_id":"', region_id, '",') END,
  '"case_id":"', case_id, '","timestamp":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '",',
  CASE WHEN event_id % 107 = 0 THEN '"district":null' ELSE concat('"district":"', district, '"') END,
  ',"gps_lat":', event_id % 90, ',"gps_lon":', event_id % 180, ',"patient_age":', patient_age,
  ',"gender":"', gender, '","symptoms":', symptoms_json, ',"rapid_test_result":"', rapid_test_result,
  '","body_temperature":', event_id % 5 + 36, ',"ambient_temperature":', event_id % 15 + 18,
  ',"humidity":', event_id % 56 + 40, ',"rainfall_mm":', CAST(floor(rainfall_mm) AS INT), '}') AS record
FROM cases""",
    "messages": """
SELECT CAST(length(region_id) % 5 AS INT) AS "partition", event_id AS "offset", region_id AS "key",
  CASE WHEN event_id % 101 = 0 THEN substr(record, 1, 40)
       WHEN event_id % 4 = 0 THEN concat('{"schema":{"type":"struct"},"payload":', record, '}')
       ELSE record END AS "value"
FROM records""",
    "threshold": """
SELECT CAST(min(v) AS BIGINT) AS threshold FROM (
  SELECT positive_cases AS v, row_number() OVER (ORDER BY positive_cases) AS rn, count(*) OVER () AS n FROM windows
) WHERE rn = floor(0.75 * (n - 1)) + 1""",
    "counts": """
SELECT region_id, ts, count(*) AS cases,
  CAST(sum(CASE WHEN rapid_test_result = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positives,
  CAST(sum(sum(CASE WHEN rapid_test_result = 'positive' THEN 1 ELSE 0 END)) OVER (
    PARTITION BY region_id ORDER BY ts RANGE BETWEEN INTERVAL '12' HOUR PRECEDING AND CURRENT ROW
  ) AS BIGINT) AS positives_in_window
FROM cases GROUP BY region_id, ts""",
}

_NEEDS = {
    "cases": (),
    "cases_raw": ("cases",),
    "scored": ("cases",),
    "windows": ("cases",),
    "importances": ("cases",),
    "records": ("cases",),
    "messages": ("cases", "records"),
    "threshold": ("cases", "windows"),
    "counts": ("cases",),
}


def with_views(sql: str, *names: str, recursive: bool = False, extra: str = "") -> str:
    """Puts the views a query reads in front of it."""
    wanted = {n for name in names for n in (*_NEEDS[name], name)}
    parts = [f"{name} AS ({_VIEWS[name]})" for name in _VIEWS if name in wanted]
    if extra:
        parts.append(extra)
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {sql}"


def _kept(candidates: str, cooldown: str) -> str:
    """The rate limit as recursion: the first candidate, then always the next one allowed."""
    return f"""candidates AS ({candidates}),
kept AS (
  SELECT region_id, min(ts) AS ts FROM candidates GROUP BY region_id
  UNION ALL
  SELECT k.region_id, (SELECT min(c.ts) FROM candidates c
    WHERE c.region_id = k.region_id AND c.ts > k.ts + {cooldown}) AS ts
  FROM kept k WHERE k.ts IS NOT NULL
),
alerts AS (
  SELECT c.region_id, c.ts, c.positives_in_window
  FROM kept k JOIN candidates c ON c.region_id = k.region_id AND c.ts = k.ts
)"""


_ALERTS = _kept("SELECT * FROM counts WHERE positives_in_window >= 10", "INTERVAL '6' HOUR")
_LINE = (
    "concat(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' [ALERT] ', region_id, ': ', positives_in_window, "
    "' positive cases in the last 43200s (instance A)')"
)
_POS = "CAST(count(*) FILTER (WHERE rapid_test_result = 'positive') AS BIGINT)"
_CORR = "round(corr({x}, CASE WHEN rapid_test_result = 'positive' THEN 1.0 ELSE 0.0 END), 6)"
_CLIMATE = " UNION ALL ".join(
    f"SELECT '{x}' AS feature, {_CORR.format(x=x)} AS correlation_with_positivity FROM cases"
    for x in ("rainfall_mm", "humidity", "ambient_temperature")
)
_NORMAL = """CASE WHEN rapid_test_result IN ('positive','Positive','POSITIVE') THEN 'positive'
  WHEN rapid_test_result IN ('negative','Negative','NEGATIVE') THEN 'negative' ELSE rapid_test_result END"""
_COMPLETE = "case_id IS NOT NULL AND region_id IS NOT NULL AND rapid_test_result IS NOT NULL"
_AGE_GROUP = """CASE WHEN patient_age < 5 THEN '0-4' WHEN patient_age < 15 THEN '5-14'
  WHEN patient_age < 45 THEN '15-44' WHEN patient_age < 65 THEN '45-64' ELSE '65+' END"""
_GENDER = "CASE gender WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE gender END"
_REQUIRED = "[" + ", ".join(f"'{f}'" for f in REQUIRED_FIELDS) + "]"
_ERROR = """CASE WHEN "offset" % 101 = 0 THEN 'Not a JSON object'
  WHEN "offset" % 103 = 0 THEN 'Missing fields: region_id' END"""
_USABLE = "event_id % 101 <> 0 AND event_id % 103 <> 0"
_SAFE = "CASE WHEN {b} = 0 THEN 0.0 ELSE round({a} * 100.0 / {b}, {d}) END"
_WIRE_TYPES = {
    "case_id": "string", "timestamp": "string", "region_id": "string", "district": "string", "gps_lat": "int64",
    "gps_lon": "int64", "patient_age": "int64", "gender": "string", "symptoms_json": "string",
    "rapid_test_result": "string", "body_temperature": "int64", "ambient_temperature": "int64", "humidity": "int64",
    "rainfall_mm": "int64",
}
_REPORT = """SELECT event_id, case_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", region_id, district,
  event_id % 90 AS gps_lat, event_id % 180 AS gps_lon, patient_age, gender, symptoms_json, rapid_test_result,
  event_id % 5 + 36 AS body_temperature, event_id % 15 + 18 AS ambient_temperature, event_id % 56 + 40 AS humidity,
  CAST(floor(rainfall_mm) AS BIGINT) AS rainfall_mm FROM cases"""
_WRAPPED_FIELDS = (
    """'{"type":"struct","fields":["""
    + ",".join(f'{{"field":"{f}","type":"{t}","optional":true}}' for f, t in _WIRE_TYPES.items())
    + """],"optional":false,"name":"case_report"}'"""
)
_FORMED = f"""SELECT case_id, ts, region_id, patient_age, rapid_test_result FROM cases WHERE {_USABLE}"""
_AGE_BINS = """(VALUES (0, '0-4', 0, 4), (1, '5-14', 5, 14), (2, '15-24', 15, 24), (3, '25-34', 25, 34),
  (4, '35-44', 35, 44), (5, '45-59', 45, 59), (6, '60+', 60, 150)) b(bin, label, lo, hi)"""
_RAIN_BINS = """(VALUES (0, '0-2 mm', 0, 2), (1, '2-5 mm', 2, 5), (2, '5-10 mm', 5, 10), (3, '10-20 mm', 10, 20),
  (4, '20+ mm', 20, 10000)) b(bin, label, lo, hi)"""
_AGE_HISTOGRAM = f"""SELECT b.bin, b.label, count(c.case_id) AS total,
  count(CASE WHEN c.rapid_test_result = 'positive' THEN 1 END) AS positive
FROM {_AGE_BINS} LEFT JOIN cases c ON c.patient_age BETWEEN b.lo AND b.hi GROUP BY b.bin, b.label"""
_RAIN_HISTOGRAM = f"""SELECT bin, label, total, positive, {_SAFE.format(a='positive', b='total', d=1)} AS positivity
FROM (SELECT b.bin, b.label, count(c.case_id) AS total,
  count(CASE WHEN c.rapid_test_result = 'positive' THEN 1 END) AS positive
FROM {_RAIN_BINS} LEFT JOIN cases c ON c.rainfall_mm >= b.lo AND c.rainfall_mm < b.hi GROUP BY b.bin, b.label)"""
_REGIONS = f"SELECT region_id, count(*) AS total_cases, {_POS} AS positive_cases FROM cases GROUP BY region_id"
_RISK = """SELECT region_id, avg(prediction) AS raw_risk, coalesce(round(avg(prediction), 3), 0) AS avg_risk,
  count(case_id) AS total FROM scored GROUP BY region_id"""
_CONFUSION = """SELECT count(*) FILTER (WHERE label > 0.5 AND prediction > 0.5) AS tp,
  count(*) FILTER (WHERE label <= 0.5 AND prediction <= 0.5) AS tn,
  count(*) FILTER (WHERE label <= 0.5 AND prediction > 0.5) AS fp,
  count(*) FILTER (WHERE label > 0.5 AND prediction <= 0.5) AS fn FROM scored"""
_BINARY = f"""SELECT CASE WHEN n = 0 THEN 0.0 ELSE round((tp + tn) * 100.0 / n, 1) END AS accuracy,
  round(p * 100, 1) AS "precision", round(r * 100, 1) AS recall,
  round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END * 100, 1) AS f1, n
FROM (SELECT *, tp + tn + fp + fn AS n,
  CASE WHEN tp + fp = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p,
  CASE WHEN tp + fn = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS r FROM ({_CONFUSION}))"""
_HISTOGRAM = """SELECT CAST(b.low AS BIGINT) AS low,
  CASE WHEN b.width = 1 THEN CAST(b.low AS VARCHAR) ELSE concat(b.low, '-', b.low + b.width - 1) END AS label,
  count(w.positive_cases) AS windows, b.low > (SELECT threshold FROM threshold) AS above_threshold
FROM (SELECT width, unnest(range(0, top + 1, width)) AS low FROM (
  SELECT CAST(greatest(1, ceil((max(positive_cases) + 1) / 10.0)) AS BIGINT) AS width, max(positive_cases) AS top
  FROM windows)) b
LEFT JOIN windows w ON w.positive_cases >= b.low AND w.positive_cases < b.low + b.width
GROUP BY b.low, b.width"""
_LATEST = """SELECT region_id, date, total_cases, positive_cases, prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY date DESC, total_cases DESC, positive_cases DESC) AS rn
  FROM windows) WHERE rn = 1"""
_STATUS = """SELECT region_id, count(*) FILTER (WHERE prediction > 0.5) AS outbreak,
  count(*) FILTER (WHERE prediction <= 0.5) AS stable FROM windows GROUP BY region_id"""
_GRID = """SELECT r.region_id, d.date, w.positive_cases, coalesce(w.prediction = 1.0, false) AS flagged
FROM (SELECT DISTINCT region_id FROM {w}) r
CROSS JOIN (SELECT DISTINCT date FROM {w} ORDER BY date DESC LIMIT 30) d
LEFT JOIN {w} w ON w.region_id = r.region_id AND w.date = d.date"""
_MINUTES = f"SELECT date_trunc('minute', ts) AS bucket, count(*) AS total, {_POS} AS positive FROM cases GROUP BY 1"
_BUCKETS = f"""SELECT bucket, total, positive, strftime(bucket, '%H:%M') AS label
FROM ({_MINUTES} ORDER BY bucket DESC LIMIT 30)"""
_RECENT_COLUMNS = f"""case_id, region_id, district, patient_age, {_GENDER} AS gender, rapid_test_result,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp\""""


def _struct(**fields: str) -> str:
    return "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in fields.items()) + ")"


def _list(column: str, order: str, source: str) -> str:
    return f"(SELECT coalesce(list({column} ORDER BY {order}), []) FROM {source})"


_DASHBOARD = "SELECT CAST(to_json({}) AS VARCHAR) AS document".format(
    _struct(
        total_cases="(SELECT count(*) FROM cases)",
        total_positive=f"(SELECT {_POS} FROM cases)",
        region_count="(SELECT count(*) FROM regions)",
        region_summary=_list(
            _struct(region_id="region_id", total_cases="total_cases", positive_cases="positive_cases"),
            "total_cases DESC, region_id",
            "regions",
        ),
        recent_cases=_list(
            _struct(
                case_id="case_id",
                region_id="region_id",
                district="district",
                patient_age="patient_age",
                gender="gender",
                rapid_test_result="rapid_test_result",
                **{"timestamp": '"timestamp"'},
            ),
            "ts DESC, case_id",
            "recent",
        ),
        charts=_struct(
            region_labels=_list("region_id", "total_cases DESC, region_id", "regions"),
            region_totals=_list("total_cases", "total_cases DESC, region_id", "regions"),
            region_positives=_list("positive_cases", "total_cases DESC, region_id", "regions"),
            pie=f"[(SELECT {_POS} FROM cases), (SELECT count(*) - {_POS} FROM cases)]",
            positivity=_list(
                "round(CAST(positive_cases AS DOUBLE) / total_cases * 100, 1)", "total_cases DESC, region_id", "regions"
            ),
            timeline_labels=_list("label", "bucket", "buckets"),
            timeline_total=_list("total", "bucket", "buckets"),
            timeline_positive=_list("positive", "bucket", "buckets"),
            age_labels=_list("label", "bin", "ages"),
            age_total=_list("total", "bin", "ages"),
            age_pos=_list("positive", "bin", "ages"),
            rain_labels=_list("label", "bin", "rains"),
            rain_rate=_list("CAST(positivity AS DOUBLE)", "bin", "rains"),
            gender_labels=_list("label", "n DESC, gender", "genders"),
            gender_values=_list("n", "n DESC, gender", "genders"),
        ),
    )
)
_ANALYTICS = "SELECT CAST(to_json({}) AS VARCHAR) AS document".format(
    _struct(
        charts=_struct(
            latest_labels=_list("region_id", "region_id", "latest"),
            latest_totals=_list("total_cases", "region_id", "latest"),
            latest_positives=_list("positive_cases", "region_id", "latest"),
            status="[(SELECT count(*) FILTER (WHERE prediction = 1.0) FROM windows), "
            "(SELECT count(*) - count(*) FILTER (WHERE prediction = 1.0) FROM windows)]",
            stack_labels=_list("region_id", "region_id", "status"),
            stack_outbreak=_list("outbreak", "region_id", "status"),
            stack_stable=_list("stable", "region_id", "status"),
            timeline_labels=_list(
                "strftime(date, '%H:%M')",
                "date",
                "(SELECT DISTINCT date FROM windows ORDER BY date DESC LIMIT 30)",
            ),
            timeline_datasets=_list(
                _struct(label="region_id", data="data", flagged="flagged"),
                "region_id",
                "(SELECT region_id, list(positive_cases ORDER BY date) AS data, list(flagged ORDER BY date) AS flagged "
                "FROM grid GROUP BY region_id)",
            ),
            hist_labels=_list("label", "low", "hist"),
            hist_counts=_list("windows", "low", "hist"),
            hist_flagged=_list("above_threshold", "low", "hist"),
            threshold="(SELECT threshold FROM threshold)",
            risk_labels=_list("region_id", "raw_risk DESC, region_id", "risk"),
            risk_values=_list("avg_risk", "raw_risk DESC, region_id", "risk"),
            fi_case_labels=_list(
                "feature_name", "importance DESC", "(FROM importances WHERE model_name = 'case_risk')"
            ),
            fi_case_values=_list(
                "round(importance * 100, 1)", "importance DESC", "(FROM importances WHERE model_name = 'case_risk')"
            ),
            fi_out_labels=_list("feature_name", "importance DESC", "(FROM importances WHERE model_name = 'outbreak')"),
            fi_out_values=_list(
                "round(importance * 100, 1)", "importance DESC", "(FROM importances WHERE model_name = 'outbreak')"
            ),
        ),
        at_risk_count="(SELECT count(*) FROM latest WHERE prediction = 1.0)",
        at_risk_regions=_list("region_id", "region_id", "(FROM latest WHERE prediction = 1.0)"),
        metrics_case='(SELECT struct_pack(accuracy := accuracy, "precision" := "precision", recall := recall, '
        f"f1 := f1, n := n) FROM ({_BINARY}))",
        cm=f"(SELECT struct_pack(tp := tp, tn := tn, fp := fp, fn := fn) FROM ({_CONFUSION}))",
    )
)
_INDEX = """SELECT {c} AS category, count(*) AS "count",
  CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS idx FROM cases GROUP BY {c}"""

_TYPE_LIST = "event_id:int64," + ",".join(f"{f}:{t}" for f, t in _WIRE_TYPES.items())
_MEASURED = ("gps_lat", "gps_lon", "body_temperature", "ambient_temperature", "humidity", "rainfall_mm")
_READ = "event_id % 101 <> 0"
_GIVEN = {"region_id": _USABLE, "district": f"{_READ} AND event_id % 107 <> 0"}
_AGAIN = f"""SELECT case_id, CASE WHEN event_id % 3 = 0 THEN ts - INTERVAL '1' HOUR ELSE ts END AS ts, region_id,
  CAST(CASE WHEN event_id % 3 = 0 THEN patient_age + 100 ELSE patient_age END AS INT) AS patient_age, rapid_test_result
FROM cases WHERE {_USABLE}"""
_TRAIN = "CAST(concat('0x', substr(md5({k}), 1, 8)) AS BIGINT) % 100 < 80"
_WINDOW_KEY = "concat(region_id, '|', strftime(date, '%Y-%m-%d %H:%M:%S'))"


def _facts(model: str, features: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model_name, '{f}' AS feature_name, CAST(1 AS DOUBLE) AS total, true AS is_share" for f in features
    )


ORACLE: dict[str, str] = {
    # sources and sinks
    "read_raw_json": with_views(
        "SELECT case_id, region_id, rapid_test_result, round(humidity, 6) AS humidity, "
        "round(rainfall_mm, 6) AS rainfall_mm, false AS unreadable FROM cases_raw",
        "cases_raw",
    ),
    "read_clean_parquet": "SELECT event_id, ts, event_type, value FROM events",
    "write_parquet_overwrite": with_views(
        "SELECT case_id, ts, region_id, rapid_test_result, strftime(ts, '%Y-%m-%d') AS event_date FROM cases",
        "cases",
    ),
    "sync_predictions": with_views(
        "SELECT 'case_predictions' AS target, case_id AS row_key, region_id, label, prediction, true AS stamped "
        "FROM scored UNION ALL SELECT 'outbreak_predictions', strftime(date, '%Y-%m-%d'), region_id, "
        "CAST(CASE WHEN positive_cases > (SELECT threshold FROM threshold) THEN 1 ELSE 0 END AS DOUBLE), "
        "prediction, true FROM windows",
        "scored",
        "threshold",
    ),
    "kafka_source": with_views('SELECT "partition", "offset", "key", "value" FROM messages', "messages"),
    "kafka_keyed_sink": with_views(
        f"""SELECT region_id AS "key", concat('{{"schema":', {_WRAPPED_FIELDS}, ',"payload":',
  to_json(struct_pack({", ".join(f'"{f}" := "{f}"' for f in _WIRE_TYPES)})), '}}') AS "value" FROM ({_REPORT})""",
        "cases",
    ),
    "dead_letter_sink": with_views(
        f'SELECT "partition", "offset", error, raw FROM (SELECT "partition", "offset", {_ERROR} AS error, '
        '"value" AS raw FROM messages) WHERE error IS NOT NULL',
        "messages",
    ),
    "upsert_cases": with_views(
        """SELECT case_id, ts, region_id, district,
  CAST(CASE WHEN rapid_test_result = 'positive' THEN patient_age + 1 ELSE patient_age END AS INT) AS patient_age, gender,
  rapid_test_result FROM cases""",
        "cases",
    ),
    "dashboard_snapshot": with_views(
        _DASHBOARD,
        "cases",
        extra=f"regions AS ({_REGIONS}), ages AS ({_AGE_HISTOGRAM}), rains AS ({_RAIN_HISTOGRAM}), "
        f"buckets AS ({_BUCKETS}), genders AS (SELECT gender, {_GENDER} AS label, count(*) AS n FROM cases "
        f"GROUP BY gender), recent AS (SELECT ts, {_RECENT_COLUMNS} FROM cases ORDER BY ts DESC, case_id LIMIT 20)",
    ),
    "analytics_snapshot": with_views(
        _ANALYTICS,
        "threshold",
        "scored",
        "importances",
        extra=f"latest AS ({_LATEST}), status AS ({_STATUS}), hist AS ({_HISTOGRAM}), risk AS ({_RISK}), "
        f"grid AS ({_GRID.format(w='windows')})",
    ),
    # projections, filters, validation
    "unwrap_envelope": with_views(
        "SELECT "
        + ", ".join(
            f"CASE WHEN {_GIVEN.get(f, _READ)} THEN {e} END AS \"{f}\""
            for f, e in {
                "case_id": "case_id",
                "timestamp": '"timestamp"',
                "region_id": "region_id",
                "district": "district",
                "patient_age": "patient_age",
                "gender": "gender",
                "symptoms": "symptoms_json",
                "rapid_test_result": "rapid_test_result",
                **{f: f"CAST({f} AS DOUBLE)" for f in _MEASURED},
            }.items()
        )
        + f" FROM ({_REPORT})",
        "cases",
    ),
    "wrap_envelope": with_views(
        f"""SELECT region_id AS "key", *, '{_TYPE_LIST}' AS types, 'case_report' AS schema_name FROM ({_REPORT})""",
        "cases",
    ),
    "validate_required": with_views(
        f"""SELECT "offset", coalesce(len(gone) = 0, false) AS accepted, array_to_string(gone, ',') AS missing FROM (
  SELECT "offset", CASE WHEN record IS NOT NULL THEN
    list_filter({_REQUIRED}, lambda f: NOT list_contains(json_keys(record), f)) END AS gone
  FROM (SELECT "offset", coalesce(json_extract(j, '$.payload'), j) AS record
    FROM (SELECT "offset", TRY_CAST("value" AS JSON) AS j FROM messages)))""",
        "messages",
    ),
    "parse_timestamp": with_views(
        "SELECT case_id, patient_age, TRY_CAST(CASE WHEN case_id LIKE '%7' THEN concat('x', timestamp_text) "
        "ELSE timestamp_text END AS TIMESTAMP) AS ts FROM cases_raw",
        "cases_raw",
    ),
    "drop_incomplete": with_views(
        f"SELECT case_id, region_id, rapid_test_result, patient_age FROM cases_raw WHERE {_COMPLETE}", "cases_raw"
    ),
    "normalize_result": with_views(
        f"SELECT case_id, patient_age, {_NORMAL} AS rapid_test_result FROM cases_raw", "cases_raw"
    ),
    "symptom_count": with_views(
        "SELECT case_id, patient_age, CAST(json_array_length(symptoms_json) AS INT) AS symptom_count FROM cases_raw",
        "cases_raw",
    ),
    "clean_cases": with_views(
        f"""SELECT case_id, CAST(timestamp_text AS TIMESTAMP) AS ts, region_id, district, patient_age, gender,
  {_NORMAL} AS rapid_test_result, round(humidity, 6) AS humidity, round(rainfall_mm, 6) AS rainfall_mm,
  CAST(json_array_length(symptoms_json) AS INT) AS symptom_count
FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY timestamp_text DESC) AS rn
  FROM cases_raw WHERE {_COMPLETE}) WHERE rn = 1""",
        "cases_raw",
    ),
    "positive_flag": with_views(
        "SELECT case_id, patient_age, CAST(CASE WHEN rapid_test_result = 'positive' THEN 1 ELSE 0 END AS INT) "
        "AS is_positive FROM cases_raw",
        "cases_raw",
    ),
    "case_label": with_views(
        "SELECT case_id, patient_age, CAST(CASE WHEN rapid_test_result = 'positive' THEN 1 ELSE 0 END AS DOUBLE) "
        "AS label FROM cases_raw",
        "cases_raw",
    ),
    "positive_only": with_views(
        "SELECT case_id, region_id, rapid_test_result FROM cases WHERE rapid_test_result = 'positive'", "cases"
    ),
    "age_group": with_views(
        f"SELECT case_id, {_AGE_GROUP} AS age_group FROM (SELECT case_id, CASE WHEN event_id % 13 <> 0 "
        "THEN patient_age END AS patient_age FROM cases)",
        "cases",
    ),
    "gender_display": with_views(f"SELECT case_id, {_GENDER} AS gender FROM cases", "cases"),
    "recent_case_view": with_views(
        f"SELECT * REPLACE (substr(case_id, 1, 12) AS case_id) FROM (SELECT {_RECENT_COLUMNS} FROM cases)", "cases"
    ),
    "outbreak_label": with_views(
        "SELECT region_id, date, positive_cases, CAST(CASE WHEN positive_cases > (SELECT threshold FROM threshold) "
        "THEN 1 ELSE 0 END AS DOUBLE) AS is_outbreak FROM windows",
        "threshold",
    ),
    "safe_rate": with_views(
        "SELECT region_id, date, "
        + ", ".join(
            f"CASE WHEN part = 0 THEN 0.0 ELSE round(CAST(positive_cases AS DOUBLE) / part * 100, {d}) END AS r{d}"
            for d in (0, 1, 2)
        )
        + " FROM (SELECT *, CASE WHEN total_cases % 7 = 0 THEN 0 ELSE total_cases END AS part FROM windows)",
        "windows",
    ),
    "select_predictions": with_views(
        "SELECT case_id, region_id, patient_age, gender, label, prediction FROM scored", "scored"
    ),
    "window_start_as_date": with_views(
        "SELECT region_id, time_bucket(INTERVAL '6' HOUR, ts) AS date, count(*) AS n FROM cases GROUP BY 1, 2", "cases"
    ),
    "drop_generated_columns": with_views("SELECT * FROM importances", "importances"),
    "at_risk_regions": with_views(
        f"SELECT region_id, date, total_cases, positive_cases FROM ({_LATEST}) WHERE prediction = 1.0", "windows"
    ),
    "flag_points": with_views("SELECT region_id, date, prediction = 1.0 AS flagged FROM windows", "windows"),
    "format_alert": with_views(
        f"SELECT region_id, {_LINE} AS line FROM alerts", "counts", recursive=True, extra=_ALERTS
    ),
    # joins and lookups
    "last_dates_semi": with_views(
        "SELECT region_id, date, positive_cases FROM windows WHERE date IN "
        "(SELECT DISTINCT date FROM windows ORDER BY date DESC LIMIT 10)",
        "windows",
    ),
    "region_date_grid": with_views(
        _GRID.format(w="busy"),
        "windows",
        extra="busy AS (SELECT * FROM windows WHERE substr(md5(concat(region_id, '|', strftime(date, '%Y-%m-%d'))), 1, 1) >= '4')",
    ),
    "replace_model_rows": with_views(
        "SELECT model_name, feature_name, importance FROM importances WHERE model_name <> 'case_risk' UNION ALL "
        "SELECT model_name, feature_name, round(importance / 2, 6) FROM importances WHERE model_name = 'case_risk'",
        "importances",
    ),
    "threshold_lookup": with_views(
        "SELECT region_id, date, positive_cases, (SELECT threshold FROM threshold) AS threshold FROM windows",
        "threshold",
    ),
    # aggregations
    "total_cases": with_views("SELECT count(*) AS total_cases FROM cases", "cases"),
    "total_positive": with_views(
        f"SELECT count(*) AS total_cases, {_POS} AS total_positive, count(*) - {_POS} AS total_negative FROM cases",
        "cases",
    ),
    "region_count": with_views("SELECT count(DISTINCT region_id) AS region_count FROM cases", "cases"),
    "region_summary": with_views(_REGIONS, "cases"),
    "positivity_by_region": with_views(
        "SELECT *, round(CAST(positive_cases AS DOUBLE) / total_cases * 100, 2) AS positivity_rate_pct "
        f"FROM ({_REGIONS})",
        "cases",
    ),
    "region_rate_1dp": with_views(
        "SELECT *, round(CAST(positive_cases AS DOUBLE) / total_cases * 100, 1) AS positivity, "
        f"round(CAST(positive_cases AS DOUBLE) / total_cases * 100, 0) AS rate_whole FROM ({_REGIONS})",
        "cases",
    ),
    "climate_correlation": with_views(_CLIMATE, "cases"),
    "demographics": with_views(
        f"SELECT {_AGE_GROUP} AS age_group, gender, count(*) AS positive_case_count FROM cases "
        "WHERE rapid_test_result = 'positive' GROUP BY 1, 2",
        "cases",
    ),
    "avg_symptoms_by_result": with_views(
        "SELECT rapid_test_result, round(avg(symptom_count), 2) AS avg_symptom_count FROM cases GROUP BY 1", "cases"
    ),
    "cases_per_minute": with_views(_MINUTES, "cases"),
    "age_histogram": with_views(_AGE_HISTOGRAM, "cases"),
    "rain_positivity": with_views(_RAIN_HISTOGRAM, "cases"),
    "gender_counts": with_views(
        f"SELECT gender, count(*) AS cases, {_GENDER} AS gender_label FROM cases GROUP BY gender", "cases"
    ),
    "region_window_features": with_views("SELECT * EXCLUDE (prediction) FROM windows", "windows"),
    "threshold_lower_q75": with_views("SELECT threshold FROM threshold", "threshold"),
    "window_histogram": with_views(_HISTOGRAM, "threshold"),
    "label_distribution": with_views(
        "SELECT CAST(CASE WHEN positive_cases > (SELECT threshold FROM threshold) THEN 1 ELSE 0 END AS DOUBLE) "
        'AS is_outbreak, count(*) AS "count" FROM windows GROUP BY 1',
        "threshold",
    ),
    "predicted_status": with_views(
        "SELECT count(*) FILTER (WHERE prediction = 1.0) AS outbreak, "
        "count(*) - count(*) FILTER (WHERE prediction = 1.0) AS stable FROM windows",
        "windows",
    ),
    "status_by_region": with_views(_STATUS, "windows"),
    "risk_by_region": with_views(f"SELECT region_id, avg_risk, total FROM ({_RISK})", "scored"),
    "confusion_matrix": with_views(_CONFUSION, "scored"),
    "binary_metrics": with_views(_BINARY, "scored"),
    "weighted_metrics": with_views(
        """SELECT round(sum(f1 * actual) / sum(actual), 6) AS f1,
  round(sum(p * actual) / sum(actual), 6) AS weighted_precision,
  round(sum(r * actual) / sum(actual), 6) AS weighted_recall, round(sum(hit) / sum(actual), 6) AS accuracy
FROM (SELECT actual, hit, p, r, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1 FROM (
  SELECT actual, hit, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS p,
    CASE WHEN actual = 0 THEN 0 ELSE hit / actual END AS r FROM (
    SELECT CAST(count(*) FILTER (WHERE label = k) AS DOUBLE) AS actual,
      CAST(count(*) FILTER (WHERE prediction = k) AS DOUBLE) AS predicted,
      CAST(count(*) FILTER (WHERE label = k AND prediction = k) AS DOUBLE) AS hit
    FROM scored CROSS JOIN (VALUES (0.0), (1.0)) c(k) GROUP BY k)))""",
        "scored",
    ),
    "auc": with_views(
        """SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM (
  SELECT CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
    CAST(sum(neg) OVER (ORDER BY score) - neg AS DOUBLE) AS below FROM (
    SELECT rainfall_mm AS score, count(*) FILTER (WHERE rapid_test_result = 'positive') AS pos,
      count(*) FILTER (WHERE rapid_test_result <> 'positive') AS neg FROM cases GROUP BY rainfall_mm))""",
        "cases",
    ),
    "importance_table": with_views("SELECT *, round(importance * 100, 1) AS importance_pct FROM importances", "importances"),
    "row_audit": with_views(
        f"""SELECT 'raw' AS step, count(*) AS "rows" FROM cases_raw
UNION ALL SELECT 'complete', count(*) FROM cases_raw WHERE {_COMPLETE}
UNION ALL SELECT 'deduplicated', count(DISTINCT case_id) FROM cases_raw WHERE {_COMPLETE}
UNION ALL SELECT 'unknown_result', count(*) FROM cases_raw
  WHERE {_COMPLETE} AND lower(rapid_test_result) NOT IN ('positive', 'negative')
UNION ALL SELECT 'unparsed_time', count(*) FROM cases_raw WHERE {_COMPLETE} AND case_id LIKE '%7'""",
        "cases_raw",
    ),
    # windows, latest per key, top-k, sets
    "latest_window_per_region": with_views(
        f"SELECT region_id, date, total_cases, positive_cases FROM ({_LATEST})", "windows"
    ),
    "rolling_positive_count": with_views("SELECT * FROM counts", "counts"),
    "dedupe_cases": with_views(
        """SELECT case_id, timestamp_text, patient_age, rapid_test_result FROM (
  SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY timestamp_text DESC) AS rn FROM cases_raw)
WHERE rn = 1""",
        "cases_raw",
    ),
    "read_inferred_json": with_views(
        "SELECT case_id, CASE WHEN e THEN floor(humidity) ELSE round(humidity, 6) END AS humidity, "
        "CASE WHEN NOT e THEN round(rainfall_mm, 6) END AS rainfall_mm, CASE WHEN NOT e THEN district END AS district, "
        "false AS unreadable FROM (SELECT *, CAST(substr(case_id, 2) AS BIGINT) % 2 = 0 AS e FROM cases_raw)",
        "cases_raw",
    ),
    "stored_thresholds": with_views(
        "SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, true AS within_error FROM windows GROUP BY 1", "windows"
    ),
    "recent_cases": with_views(
        "SELECT case_id, ts, region_id, rapid_test_result FROM cases ORDER BY ts DESC, case_id LIMIT 20", "cases"
    ),
    "last_30_buckets": with_views(_BUCKETS, "cases"),
    "ordered_outputs": with_views(
        f"""SELECT 'region_summary' AS section, CAST(row_number() OVER (ORDER BY total_cases DESC, region_id) AS INT)
  AS "position", region_id FROM ({_REGIONS})
UNION ALL SELECT 'positivity', CAST(row_number() OVER (
  ORDER BY round(CAST(positive_cases AS DOUBLE) / total_cases * 100, 2) DESC, region_id) AS INT), region_id
  FROM ({_REGIONS})
UNION ALL SELECT 'risk', CAST(row_number() OVER (ORDER BY avg_risk DESC, region_id) AS INT), region_id
  FROM ({_RISK})""",
        "scored",
    ),
    "union_by_name": with_views(
        "SELECT case_id, region_id, patient_age, CAST(NULL AS VARCHAR) AS gender FROM cases "
        "WHERE rapid_test_result = 'positive' UNION ALL BY NAME "
        "SELECT gender, case_id, region_id FROM cases WHERE rapid_test_result <> 'positive'",
        "cases",
    ),
    "distinct_dates": with_views("SELECT DISTINCT date FROM windows", "windows"),
    "distinct_regions": with_views("SELECT DISTINCT region_id FROM windows", "windows"),
    # alerts and streams
    "outbreak_alerts": with_views("SELECT * FROM alerts", "counts", recursive=True, extra=_ALERTS),
    "alert_cooldown": with_views(
        "SELECT * FROM alerts",
        "counts",
        recursive=True,
        extra=_kept("SELECT * FROM counts WHERE positives_in_window >= 3", "INTERVAL '2' HOUR"),
    ),
    "stream_ingest": with_views(
        f"SELECT 'one' AS batches, * FROM ({_AGAIN}) UNION ALL SELECT 'four', * FROM ({_AGAIN})", "cases"
    ),
    "at_least_once_commit": with_views(f"SELECT *, CAST(4 AS INT) AS writes FROM ({_FORMED})", "cases"),
    "retry_then_dead_letter": with_views(
        f'SELECT "partition", "offset", error, raw, CAST(4 AS INT) AS calls FROM (SELECT "partition", "offset", '
        f'{_ERROR} AS error, "value" AS raw FROM messages) WHERE error IS NOT NULL',
        "messages",
    ),
    "stream_outbreak_alerts": with_views("SELECT * FROM alerts", "counts", recursive=True, extra=_ALERTS),
    "alert_log_sink": with_views(f"SELECT {_LINE} AS line FROM alerts", "counts", recursive=True, extra=_ALERTS),
    "stream_region_windows": with_views(
        "SELECT region_id, date, total_cases, positive_cases, avg_rainfall FROM windows", "windows"
    ),
    "stream_live_totals": with_views(_REGIONS, "cases"),
    "lag_report": with_views(
        """SELECT batch_id, 'cases' AS topic, "partition", "position", "end", "end" - "position" AS lag FROM (
  SELECT "partition", batch_id, max("offset") AS "end",
    coalesce(max("offset") FILTER (WHERE floor("offset" * 4 / (SELECT max("offset") + 1 FROM messages)) <= batch_id), -1) AS "position"
  FROM messages, range(4) r(batch_id) GROUP BY "partition", batch_id)""",
        "messages",
    ),
    "key_locality": with_views(
        """SELECT region_id, case_id, CAST(row_number() OVER (
  PARTITION BY region_id, date_trunc('day', ts) ORDER BY ts, case_id) AS INT) AS "position" FROM cases""",
        "cases",
    ),
    # features
    "category_index": with_views(_INDEX.format(c="district"), "cases"),
    "assemble_features": with_views(
        "SELECT c.case_id, "
        + ", ".join(
            f"CASE WHEN c.event_id % 13 <> 0 THEN {e} END AS {n}"
            for n, e in {
                "patient_age": "CAST(c.patient_age AS DOUBLE)",
                "region_idx": "r.idx",
                "gender_idx": "g.idx",
                **{f: f"round(c.{f}, 6)" for f in ("body_temperature", "ambient_temperature", "humidity", "rainfall_mm")},
                "symptom_count": "CAST(c.symptom_count AS DOUBLE)",
            }.items()
        )
        + f""" FROM cases c JOIN ({_INDEX.format(c='region_id')}) r ON r.category = c.region_id
JOIN ({_INDEX.format(c='gender')}) g ON g.category = c.gender""",
        "cases",
    ),
    "train_test_split": with_views(
        "SELECT case_id, CAST(concat('0x', substr(md5(case_id), 1, 8)) AS BIGINT) % 100 < 80 AS is_train FROM cases",
        "cases",
    ),
    # models: facts that hold for any fit
    "outbreak_threshold": with_views("SELECT count(*) AS n, true AS within_error FROM windows", "windows"),
    "case_risk_model": _facts(CASE_MODEL, CASE_FEATURES),
    "outbreak_model": _facts(OUTBREAK_MODEL, OUTBREAK_FEATURES),
    "score_cases": with_views(
        f"""SELECT case_id, region_id, patient_age, gender, CAST(CASE WHEN rapid_test_result = 'positive' THEN 1 ELSE 0 END
  AS DOUBLE) AS label, {_TRAIN.format(k="case_id")} AS is_train, CASE WHEN event_id % 17 <> 0 THEN true END AS agrees FROM cases""",
        "cases",
    ),
    "score_windows": with_views(
        f"SELECT region_id, date, total_cases, positive_cases, {_TRAIN.format(k=_WINDOW_KEY)} AS is_train, true AS agrees FROM windows",
        "windows",
    ),
    "evaluate_model": " UNION ALL ".join(
        f"SELECT '{CASE_MODEL}' AS model_name, '{m}' AS metric, true AS agrees"
        for m in ("auc", "f1", "weighted_precision", "weighted_recall", "accuracy")
    ),
    "model_save": with_views("SELECT region_id, date, true AS same FROM windows", "windows"),
    "model_load": with_views("SELECT case_id, true AS same FROM cases", "cases"),
    "run_case_model": "SELECT 'predictions' AS \"table\", count(*) AS \"rows\" FROM events "
    f"UNION ALL SELECT 'metrics', 5 UNION ALL SELECT 'importances', {len(CASE_FEATURES)}",
    "run_outbreak_model": with_views(
        "SELECT 'predictions' AS \"table\", count(*) AS \"rows\" FROM windows "
        f"UNION ALL SELECT 'metrics', 5 UNION ALL SELECT 'importances', {len(OUTBREAK_FEATURES)}",
        "windows",
    ),
}

ORACLE["upsert_stored_cases"] = ORACLE["upsert_cases"]
ORACLE["dashboard_rollups"] = ORACLE["dashboard_snapshot"]
ORACLE["clean_cases_by_increments"] = ORACLE["clean_cases"]
ORACLE["recent_stored_cases"] = ORACLE["recent_cases"]
ORACLE["last_stored_buckets"] = ORACLE["last_30_buckets"]
