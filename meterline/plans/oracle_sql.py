"""DuckDB SQL twins of the registered queries (the correctness oracle).

The driver registers the test tables as views (``events`` among them) and
runs each string next to the Spark query. The SQL is written separately
from the Spark code: the same rules, stated a second time in another engine.
Doubles are rounded to 6 places (plus 0.0, to clear negative zero) and
integer outputs are cast to INTEGER to match Spark's types.
"""

from __future__ import annotations


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


RAW_TRIPS = """
raw_base AS (
  SELECT event_id AS e, ts, value,
         CAST(-73.98 AS DOUBLE) + (CAST((event_id * 7919) % 1000 AS DOUBLE) - 500) / 5000 AS lon0,
         CAST(40.75 AS DOUBLE) + (CAST((event_id * 104729) % 1000 AS DOUBLE) - 500) / 5000 AS lat0
  FROM events
),
raw_trips AS (
  SELECT
    CAST(e AS VARCHAR) AS key,
    CASE WHEN e % 1009 = 5 THEN CAST('NaN' AS DOUBLE)
         WHEN e % 211 = 7 THEN -value
         ELSE CAST(2.5 AS DOUBLE) + value END AS fare_amount,
    CASE WHEN e % 499 = 3 THEN 'not a date'
         ELSE strftime(CAST(ts AS TIMESTAMP) - to_days(CAST(e % 2500 AS INTEGER)), '%Y-%m-%d %H:%M:%S') || ' UTC'
    END AS pickup_datetime,
    CASE WHEN e % 101 = 0 THEN CAST(0 AS DOUBLE) ELSE lon0 END AS pickup_longitude,
    CASE WHEN e % 101 = 0 THEN CAST(0 AS DOUBLE)
         WHEN e % 211 = 11 THEN CAST(40.1 AS DOUBLE)
         ELSE lat0 END AS pickup_latitude,
    CASE WHEN e % 997 = 1 THEN CAST(NULL AS DOUBLE)
         WHEN e % 53 = 0 THEN lon0
         ELSE lon0 + value / 1000 END AS dropoff_longitude,
    CASE WHEN e % 211 = 11 THEN CAST(41.9 AS DOUBLE)
         WHEN e % 53 = 0 THEN lat0
         ELSE lat0 + (CAST(e % 5 AS DOUBLE) - 2) / 200 END AS dropoff_latitude,
    CAST(e % 8 AS INTEGER) AS passenger_count
  FROM raw_base
)"""

PARSED = """
parsed AS (
  SELECT *,
         regexp_replace(pickup_datetime, ' UTC', '', 'g') AS pickup_datetime_clean,
         try_strptime(regexp_replace(pickup_datetime, ' UTC', '', 'g'), '%Y-%m-%d %H:%M:%S') AS pickup_timestamp
  FROM raw_trips
)"""

HAVERSINE = (
    "CAST(6371.0 AS DOUBLE) * (2 * asin(sqrt("
    "pow(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2)"
    " + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))"
    " * pow(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2))))"
)

TIME_PARTS = """
    CAST(hour(pickup_timestamp) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_timestamp) + 1 AS INTEGER) AS pickup_dayofweek,
    CAST(month(pickup_timestamp) AS INTEGER) AS pickup_month,
    CAST(year(pickup_timestamp) AS INTEGER) AS pickup_year"""

COMPLETE_WHERE = """
    fare_amount IS NOT NULL AND NOT isnan(fare_amount)
    AND pickup_timestamp IS NOT NULL
    AND pickup_longitude IS NOT NULL AND NOT isnan(pickup_longitude)
    AND pickup_latitude IS NOT NULL AND NOT isnan(pickup_latitude)
    AND dropoff_longitude IS NOT NULL AND NOT isnan(dropoff_longitude)
    AND dropoff_latitude IS NOT NULL AND NOT isnan(dropoff_latitude)
    AND passenger_count IS NOT NULL"""

BBOX_WHERE = """
    pickup_longitude BETWEEN -75 AND -72 AND dropoff_longitude BETWEEN -75 AND -72
    AND pickup_latitude BETWEEN 40 AND 42 AND dropoff_latitude BETWEEN 40 AND 42"""

DOMAIN_WHERE = (
    "fare_amount > 0 AND fare_amount <= 300 AND passenger_count > 0 AND passenger_count <= 6 AND" + BBOX_WHERE
)

CLEAN = f"""
complete AS (SELECT * FROM parsed WHERE {COMPLETE_WHERE}),
domain AS (SELECT * FROM complete WHERE {DOMAIN_WHERE}),
in_range AS (
  SELECT * FROM (SELECT *, {HAVERSINE} AS trip_distance_km FROM domain)
  WHERE trip_distance_km > 0 AND trip_distance_km <= 100
),
clean AS (
  SELECT key, fare_amount, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
         passenger_count, trip_distance_km, {TIME_PARTS}
  FROM in_range
  WHERE key IS NOT NULL AND pickup_datetime IS NOT NULL
)"""

SPLIT_BUCKET = "(CAST(('0x' || substr(md5(key), 1, 8)) AS BIGINT) % 100)"


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",".join(blocks)


BASE = with_ctes(RAW_TRIPS, PARSED, CLEAN)

CLEAN_SELECT = (
    f"key, {r6('fare_amount')} AS fare_amount, {r6('pickup_longitude')} AS pickup_longitude, "
    f"{r6('pickup_latitude')} AS pickup_latitude, {r6('dropoff_longitude')} AS dropoff_longitude, "
    f"{r6('dropoff_latitude')} AS dropoff_latitude, passenger_count, "
    f"{r6('trip_distance_km')} AS trip_distance_km, pickup_hour, pickup_dayofweek, pickup_month, pickup_year"
)

RAW_SELECT = (
    f"key, {r6('fare_amount')} AS fare_amount, pickup_datetime, {r6('pickup_longitude')} AS pickup_longitude, "
    f"{r6('pickup_latitude')} AS pickup_latitude, {r6('dropoff_longitude')} AS dropoff_longitude, "
    f"{r6('dropoff_latitude')} AS dropoff_latitude, passenger_count"
)

FEATURES = (
    "passenger_count, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, "
    "trip_distance_km, pickup_hour, pickup_dayofweek, pickup_month, pickup_year"
)

FUNNEL_WIDE = f"""
flags AS (
  SELECT key, ({COMPLETE_WHERE}) AS is_complete,
         ({COMPLETE_WHERE}) AND ({DOMAIN_WHERE}) AS in_domain
  FROM parsed
),
wide AS (
  SELECT count(*) AS raw,
         count(*) FILTER (WHERE is_complete) AS after_dropna,
         count(*) FILTER (WHERE in_domain) AS after_domain_filter,
         (SELECT count(*) FROM in_range) AS after_distance_filter,
         (SELECT count(*) FROM clean) AS final,
         (SELECT count(*) FROM clean WHERE {SPLIT_BUCKET} < 80) AS train,
         (SELECT count(*) FROM clean WHERE {SPLIT_BUCKET} >= 80) AS test
  FROM flags
),
funnel AS (
  SELECT * FROM (VALUES (1, 'raw'), (2, 'after_dropna'), (3, 'after_domain_filter'),
                        (4, 'after_distance_filter'), (5, 'final'), (6, 'train'), (7, 'test')) s(step, stage)
)"""

FUNNEL_ROWS = """
SELECT CAST(step AS INTEGER) AS step, stage,
       CAST(CASE stage WHEN 'raw' THEN (SELECT raw FROM wide)
            WHEN 'after_dropna' THEN (SELECT after_dropna FROM wide)
            WHEN 'after_domain_filter' THEN (SELECT after_domain_filter FROM wide)
            WHEN 'after_distance_filter' THEN (SELECT after_distance_filter FROM wide)
            WHEN 'final' THEN (SELECT final FROM wide) WHEN 'train' THEN (SELECT train FROM wide)
            ELSE (SELECT test FROM wide) END AS BIGINT) AS rows
FROM funnel"""

Q: dict[str, str] = {}

Q["trips_clean"] = f"{BASE} SELECT {CLEAN_SELECT} FROM clean"

Q["raw_projection"] = with_ctes(RAW_TRIPS) + f" SELECT {RAW_SELECT} FROM raw_trips"

Q["parse_pickup_time"] = (
    with_ctes(RAW_TRIPS, PARSED)
    + " SELECT key, pickup_datetime_clean, strftime(pickup_timestamp, '%Y-%m-%d %H:%M:%S') AS pickup_timestamp"
    " FROM parsed"
)

Q["time_features"] = with_ctes(RAW_TRIPS, PARSED) + f" SELECT key, {TIME_PARTS} FROM parsed"

Q["haversine_distance"] = with_ctes(RAW_TRIPS) + f" SELECT key, {r6(HAVERSINE)} AS trip_distance_km FROM raw_trips"

Q["dropna_subset"] = with_ctes(RAW_TRIPS, PARSED) + f" SELECT {RAW_SELECT} FROM parsed WHERE {COMPLETE_WHERE}"

Q["dropna_all"] = with_ctes(
    RAW_TRIPS,
    PARSED,
    f"full_rows AS (SELECT *, {HAVERSINE} AS trip_distance_km, {TIME_PARTS} FROM parsed)",
) + (
    f" SELECT key, pickup_datetime_clean, {r6('trip_distance_km')} AS trip_distance_km, pickup_hour, pickup_year"
    " FROM full_rows WHERE key IS NOT NULL AND pickup_datetime IS NOT NULL"
    " AND fare_amount IS NOT NULL AND NOT isnan(fare_amount)"
    " AND pickup_longitude IS NOT NULL AND NOT isnan(pickup_longitude)"
    " AND pickup_latitude IS NOT NULL AND NOT isnan(pickup_latitude)"
    " AND dropoff_longitude IS NOT NULL AND NOT isnan(dropoff_longitude)"
    " AND dropoff_latitude IS NOT NULL AND NOT isnan(dropoff_latitude)"
    " AND passenger_count IS NOT NULL AND pickup_datetime_clean IS NOT NULL"
    " AND pickup_timestamp IS NOT NULL"
    " AND trip_distance_km IS NOT NULL AND NOT isnan(trip_distance_km)"
    " AND pickup_hour IS NOT NULL AND pickup_dayofweek IS NOT NULL"
    " AND pickup_month IS NOT NULL AND pickup_year IS NOT NULL"
)

Q["domain_filter"] = (
    with_ctes(RAW_TRIPS, PARSED) + f" SELECT {RAW_SELECT} FROM parsed WHERE {COMPLETE_WHERE} AND {DOMAIN_WHERE}"
)

Q["bbox_filter"] = with_ctes(RAW_TRIPS, PARSED) + (
    f" SELECT key, {r6('pickup_longitude')} AS pickup_longitude, {r6('pickup_latitude')} AS pickup_latitude,"
    f" {r6('dropoff_longitude')} AS dropoff_longitude, {r6('dropoff_latitude')} AS dropoff_latitude"
    f" FROM parsed WHERE {COMPLETE_WHERE} AND {BBOX_WHERE}"
)

Q["distance_filter"] = with_ctes(
    RAW_TRIPS, PARSED, f"d AS (SELECT key, {HAVERSINE} AS trip_distance_km FROM parsed WHERE {COMPLETE_WHERE})"
) + (f" SELECT key, {r6('trip_distance_km')} AS trip_distance_km FROM d WHERE trip_distance_km > 0 AND trip_distance_km <= 100")

Q["funnel_counts"] = with_ctes(RAW_TRIPS, PARSED, CLEAN, FUNNEL_WIDE) + FUNNEL_ROWS + " WHERE step <= 5"

Q["funnel_with_split"] = with_ctes(RAW_TRIPS, PARSED, CLEAN, FUNNEL_WIDE) + FUNNEL_ROWS

# Short stage labels, the same table as the Spark side.
Q["funnel_labels"] = with_ctes(RAW_TRIPS, PARSED, CLEAN, FUNNEL_WIDE, "f AS (" + FUNNEL_ROWS + ")") + (
    " SELECT step, stage, rows, COALESCE(CASE stage"
    " WHEN 'raw' THEN 'Raw data' WHEN 'after_dropna' THEN 'After dropna'"
    " WHEN 'after_domain_filter' THEN 'Domain filter' WHEN 'after_distance_filter' THEN 'Distance filter'"
    " WHEN 'final' THEN 'Final data' END, stage) AS stage_label FROM f"
)

Q["split_assignment"] = f"{BASE} SELECT key, {SPLIT_BUCKET} AS split_bucket, {SPLIT_BUCKET} < 80 AS is_train FROM clean"

Q["split_counts"] = (
    f"{BASE} SELECT 'train' AS split, CAST(count(*) FILTER (WHERE {SPLIT_BUCKET} < 80) AS BIGINT) AS rows FROM clean"
    f" UNION ALL SELECT 'test', CAST(count(*) FILTER (WHERE {SPLIT_BUCKET} >= 80) AS BIGINT) FROM clean"
)

Q["clean_sample"] = f"{BASE} SELECT {CLEAN_SELECT} FROM clean ORDER BY md5(key), key LIMIT 1000"

Q["model_frame"] = (
    f"{BASE} SELECT key, {r6('fare_amount')} AS label, passenger_count, {r6('pickup_longitude')} AS pickup_longitude,"
    f" {r6('pickup_latitude')} AS pickup_latitude, {r6('dropoff_longitude')} AS dropoff_longitude,"
    f" {r6('dropoff_latitude')} AS dropoff_latitude, {r6('trip_distance_km')} AS trip_distance_km,"
    " pickup_hour, pickup_dayofweek, pickup_month, pickup_year FROM clean"
)

Q["clean_sample_timestamp"] = f"{BASE}, s AS (SELECT *, {TIME_PARTS} FROM in_range WHERE key IS NOT NULL AND pickup_datetime IS NOT NULL)" + (
    f" SELECT {CLEAN_SELECT}, strftime(pickup_timestamp, '%Y-%m-%d %H:%M:%S') AS pickup_timestamp FROM s ORDER BY md5(key), key LIMIT 1000"
)

Q["csv_roundtrip"] = Q["raw_projection"]
Q["csv_reordered"] = Q["raw_projection"]
Q["csv_numeric_text"] = Q["raw_projection"]
Q["funnel_csv"] = Q["funnel_counts"]
Q["stream_funnel"] = Q["funnel_counts"]
Q["parquet_roundtrip"] = Q["trips_clean"]


def oracle_sql() -> dict[str, str]:
    return dict(Q)


# ------------------------------------------------------------- models

FEATURE_LIST = [f.strip() for f in FEATURES.split(",")]

SPLIT = f"""
frame AS (SELECT key, fare_amount AS label, {FEATURES} FROM clean),
train AS (SELECT * FROM frame WHERE {SPLIT_BUCKET} < 80),
test AS (SELECT * FROM frame WHERE {SPLIT_BUCKET} >= 80)"""

MODEL_BASE = with_ctes(RAW_TRIPS, PARSED, CLEAN, SPLIT)

Q["scaler_stats"] = MODEL_BASE + " " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{f}' AS feature, {r6(f'avg(CAST({f} AS DOUBLE))')} AS mean,"
    f" {r6(f'stddev_samp(CAST({f} AS DOUBLE))')} AS std FROM train"
    for i, f in enumerate(FEATURE_LIST)
)


def _scaled_sql(with_mean: bool) -> str:
    stats = ", ".join(
        f"avg(CAST({f} AS DOUBLE)) AS m_{f}, stddev_samp(CAST({f} AS DOUBLE)) AS s_{f}" for f in FEATURE_LIST
    )
    cols = []
    for f in FEATURE_LIST:
        x = f"CAST(train.{f} AS DOUBLE)"
        sd = f"(SELECT s_{f} FROM st)"
        if with_mean:
            x = f"({x} - (SELECT m_{f} FROM st))"
        cols.append(f"{r6(f'CASE WHEN {sd} <> 0 THEN {x} / {sd} ELSE 0.0 END')} AS {f}_scaled")
    return MODEL_BASE + f", st AS (SELECT {stats} FROM train) SELECT train.key, {', '.join(cols)} FROM train"


Q["scaled_features"] = _scaled_sql(False)
Q["scaled_centered_features"] = _scaled_sql(True)

Q["ols_1f"] = MODEL_BASE + (
    f" SELECT {r6('regr_slope(label, trip_distance_km)')} AS slope,"
    f" {r6('regr_intercept(label, trip_distance_km)')} AS intercept FROM train"
)

RIDGE_1F = """
ridge1 AS (
  SELECT w, my - w * mx AS intercept FROM (
    SELECT regr_slope(label, trip_distance_km) / (1 + CAST(0.1 AS DOUBLE) / stddev_pop(label)) AS w,
           avg(label) AS my, avg(trip_distance_km) AS mx
    FROM train)
)"""

Q["ridge_1f"] = MODEL_BASE + "," + RIDGE_1F + f" SELECT {r6('w')} AS slope, {r6('intercept')} AS intercept FROM ridge1"

RIDGE_2F = """
m2 AS (
  SELECT stddev_pop(label) AS sy, stddev_pop(trip_distance_km) AS s1, stddev_pop(passenger_count) AS s2,
         corr(trip_distance_km, passenger_count) AS c, corr(label, trip_distance_km) AS r1,
         corr(label, passenger_count) AS r2, avg(label) AS my, avg(trip_distance_km) AS m1,
         avg(passenger_count) AS m2, 1 + CAST(0.1 AS DOUBLE) / stddev_pop(label) AS k
  FROM train
),
ridge2 AS (
  SELECT w1, w2, my - w1 * m1 - w2 * m2 AS intercept FROM (
    SELECT (k * r1 - c * r2) / (k * k - c * c) * sy / s1 AS w1,
           (k * r2 - c * r1) / (k * k - c * c) * sy / s2 AS w2, my, m1, m2
    FROM m2)
)"""

Q["ridge_2f"] = MODEL_BASE + "," + RIDGE_2F + (
    f" SELECT {r6('w1')} AS w1, {r6('w2')} AS w2, {r6('intercept')} AS intercept FROM ridge2"
)

STUMP = """
long AS (
  SELECT label AS y, 0 AS position, 'km_floor' AS feature, CAST(CAST(floor(trip_distance_km) AS INTEGER) AS DOUBLE) AS x FROM train
  UNION ALL SELECT label, 1, 'passenger_count', CAST(passenger_count AS DOUBLE) FROM train
  UNION ALL SELECT label, 2, 'pickup_hour', CAST(pickup_hour AS DOUBLE) FROM train
),
pv AS (SELECT position, feature, x, count(*) AS n, sum(y) AS s, sum(y * y) AS ss FROM long GROUP BY position, feature, x),
cum AS (
  SELECT position, feature, x,
         lead(x) OVER (PARTITION BY position ORDER BY x) AS next_x,
         CAST(sum(n) OVER w AS BIGINT) AS ln, sum(s) OVER w AS ls, sum(ss) OVER w AS lss,
         CAST(sum(n) OVER (PARTITION BY position) AS BIGINT) AS tn,
         sum(s) OVER (PARTITION BY position) AS ts, sum(ss) OVER (PARTITION BY position) AS tss
  FROM pv
  WINDOW w AS (PARTITION BY position ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
cands AS (
  SELECT position, feature, (x + next_x) / 2 AS threshold, ln AS left_n, tn - ln AS right_n,
         ls / ln AS left_mean, (ts - ls) / (tn - ln) AS right_mean,
         (tss / tn - (ts / tn) * (ts / tn))
           - ln / tn * (lss / ln - (ls / ln) * (ls / ln))
           - (tn - ln) / tn * ((tss - lss) / (tn - ln) - ((ts - ls) / (tn - ln)) * ((ts - ls) / (tn - ln))) AS gain
  FROM cum WHERE next_x IS NOT NULL
)"""

Q["tree_stump"] = MODEL_BASE + "," + STUMP + (
    f" SELECT feature, {r6('threshold')} AS threshold, left_n, right_n, {r6('left_mean')} AS left_mean,"
    f" {r6('right_mean')} AS right_mean, {r6('gain')} AS gain"
    " FROM cands WHERE gain > 0 ORDER BY gain DESC, position, threshold LIMIT 1"
)

PRED = MODEL_BASE + "," + RIDGE_1F + """,
pred AS (
  SELECT test.*, (SELECT intercept FROM ridge1) + (SELECT w FROM ridge1) * test.trip_distance_km AS prediction
  FROM test
)"""

Q["regression_metrics"] = PRED + (
    f" SELECT {r6('sqrt(avg((label - prediction) * (label - prediction)))')} AS rmse,"
    f" {r6('avg(abs(label - prediction))')} AS mae,"
    f" {r6('1 - avg((label - prediction) * (label - prediction)) / var_pop(label)')} AS r2 FROM pred"
)

Q["absolute_error"] = PRED + (
    f" SELECT key, {r6('label')} AS label, {r6('prediction')} AS prediction,"
    f" {r6('abs(label - prediction)')} AS absolute_error FROM pred"
)

Q["error_histogram"] = PRED + """,
errs AS (SELECT abs(label - prediction) AS e FROM pred),
rng AS (SELECT min(e) AS lo, max(e) AS hi FROM errs),
binned AS (
  SELECT CAST(CASE WHEN (SELECT hi FROM rng) > (SELECT lo FROM rng)
              THEN least(floor((e - (SELECT lo FROM rng)) / ((SELECT hi FROM rng) - (SELECT lo FROM rng)) * 30), 29)
              ELSE 0 END AS INTEGER) AS bin
  FROM errs
),
counted AS (
  SELECT CAST(b.bin AS INTEGER) AS bin, count(binned.bin) AS n
  FROM (SELECT unnest(range(30)) AS bin) b LEFT JOIN binned ON binned.bin = b.bin GROUP BY b.bin),
edges AS (SELECT bin, n, (SELECT lo FROM rng) AS lo, (SELECT hi FROM rng) AS hi FROM counted)""" + (
    f" SELECT bin, {r6('lo + bin * ((hi - lo) / 30)')} AS bin_lo, {r6('lo + (bin + 1) * ((hi - lo) / 30)')} AS bin_hi,"
    " n FROM edges"
)

Q["axis_bound"] = PRED + f" SELECT {r6('greatest(max(label), max(prediction))')} AS axis_max FROM pred"

Q["prediction_sample"] = PRED + (
    f" SELECT key, {r6('label')} AS label, {r6('prediction')} AS prediction, {r6('trip_distance_km')} AS trip_distance_km,"
    " passenger_count, pickup_hour, pickup_dayofweek, pickup_month, pickup_year"
    " FROM pred ORDER BY md5(key), key LIMIT 1000"
)

CLOSED_EVAL = MODEL_BASE + "," + RIDGE_1F + "," + RIDGE_2F + """,
ols AS (SELECT regr_slope(label, trip_distance_km) AS slope, regr_intercept(label, trip_distance_km) AS intercept FROM train),
preds AS (
  SELECT label,
         (SELECT intercept FROM ols) + (SELECT slope FROM ols) * trip_distance_km AS p0,
         (SELECT intercept FROM ridge1) + (SELECT w FROM ridge1) * trip_distance_km AS p1,
         (SELECT intercept FROM ridge2) + (SELECT w1 FROM ridge2) * trip_distance_km
           + (SELECT w2 FROM ridge2) * passenger_count AS p2
  FROM test
),
wide AS (
  SELECT sqrt(avg((label - p0) * (label - p0))) AS rmse0, avg(abs(label - p0)) AS mae0,
         1 - avg((label - p0) * (label - p0)) / var_pop(label) AS r20,
         sqrt(avg((label - p1) * (label - p1))) AS rmse1, avg(abs(label - p1)) AS mae1,
         1 - avg((label - p1) * (label - p1)) / var_pop(label) AS r21,
         sqrt(avg((label - p2) * (label - p2))) AS rmse2, avg(abs(label - p2)) AS mae2,
         1 - avg((label - p2) * (label - p2)) / var_pop(label) AS r22
  FROM preds
),
evaluation AS (
  SELECT 'OLS distance' AS model, rmse0 AS rmse, mae0 AS mae, r20 AS r2, 0 AS position FROM wide
  UNION ALL SELECT 'Ridge distance', rmse1, mae1, r21, 1 FROM wide
  UNION ALL SELECT 'Ridge distance+passengers', rmse2, mae2, r22, 2 FROM wide
)"""

Q["leaderboard"] = CLOSED_EVAL + (
    f" SELECT model, {r6('rmse')} AS rmse, {r6('mae')} AS mae, {r6('r2')} AS r2,"
    " CAST(rank() OVER (ORDER BY rmse ASC, position) AS INTEGER) AS rank_rmse,"
    " CAST(rank() OVER (ORDER BY mae ASC, position) AS INTEGER) AS rank_mae,"
    " CAST(rank() OVER (ORDER BY r2 DESC, position) AS INTEGER) AS rank_r2 FROM evaluation"
)

Q["best_model"] = CLOSED_EVAL + (
    f" SELECT model, {r6('rmse')} AS rmse, {r6('mae')} AS mae, {r6('r2')} AS r2"
    " FROM evaluation WHERE rmse IS NOT NULL ORDER BY rmse, position LIMIT 1"
)

# ------------------------------------------------- joins on order and place

Q["asof_previous_event"] = f"""
WITH seen AS (SELECT user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT p.event_id, p.user_id, strftime(p.ts, '%Y-%m-%d %H:%M:%S') AS ts, {r6("p.value")} AS value,
  s.event_id AS view_event_id, strftime(s.ts, '%Y-%m-%d %H:%M:%S') AS view_ts, {r6("s.value")} AS view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN seen s ON s.user_id = p.user_id AND s.ts <= p.ts
"""

Q["orders_in_shipping_ranges"] = """
WITH ranges AS (
  SELECT l_suppkey, CAST(year(l_shipdate) * 4 + quarter(l_shipdate) AS INTEGER) AS quarter_no, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
  FROM lineitem WHERE l_quantity >= 45 GROUP BY ALL)
SELECT l_suppkey, quarter_no, count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders JOIN ranges ON o_orderdate >= first_ship AND o_orderdate <= last_ship GROUP BY ALL
"""

Q["nearest_dropoff"] = BASE + f""",
cells AS (
  SELECT floor(dropoff_latitude * 1000) AS row, floor(dropoff_longitude * 1000) AS col, count(*) AS n, min(dropoff_latitude) AS site_lat, min(dropoff_longitude) AS site_lon
  FROM clean GROUP BY ALL),
busiest AS (SELECT * FROM cells ORDER BY n DESC, row, col LIMIT 500),
apart AS (SELECT key, {HAVERSINE.replace("dropoff_latitude", "site_lat").replace("dropoff_longitude", "site_lon")} AS km FROM clean, busiest)
SELECT key, {r6("min(km)")} AS nearest_km FROM apart GROUP BY key
"""

# ------------------------------------------- facts about the ml fits

Q["model_vector"] = f"{BASE} SELECT key, " + ", ".join(f"{r6(f'CAST({f} AS DOUBLE)')} AS {f}" for f in FEATURE_LIST) + " FROM clean"

Q["ml_scaled_features"] = Q["scaled_features"]
Q["ml_scaled_centered_features"] = Q["scaled_centered_features"]

# A least-squares fit and trees of means predict the mean label on average.
Q["mean_training_prediction"] = MODEL_BASE + " " + " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS rows, {r6('avg(label)')} AS mean_prediction FROM train"
    for m in ("Linear Regression", "Decision Tree Regression", "GBT Regression")
)

Q["ridge_normal_equations"] = " UNION ALL ".join(f"SELECT '{f}' AS feature, true AS holds" for f in FEATURE_LIST)

Q["importance_facts"] = " UNION ALL ".join(
    f"SELECT '{p}' AS profile, CAST({len(FEATURE_LIST)} AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total, true AS sorted" for p in ("fast", "full")
)

Q["model_reload_differences"] = MODEL_BASE + " SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM test"

FAST_MODELS = ("Linear Regression", "Decision Tree Regression", "Random Forest Regression")


def _variance_sql(models: tuple[str, ...]) -> str:
    return MODEL_BASE + " " + " UNION ALL ".join(
        f"SELECT '{m}' AS model, round(var_pop(label), 4) + 0.0 AS label_variance, true AS mae_below_rmse FROM test" for m in models
    )


Q["evaluation_fast_facts"] = _variance_sql(FAST_MODELS)
Q["evaluation_full_facts"] = _variance_sql((*FAST_MODELS, "GBT Regression"))

Q["tree_wins"] = MODEL_BASE + f"""
SELECT true AS tree_won, (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows,
  CAST({len(FEATURE_LIST)} AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total, true AS sorted,
  (SELECT {r6('avg(5 + 20 * CAST(floor(trip_distance_km) % 4 AS DOUBLE) + 3 * passenger_count)')} FROM frame) AS mean_fare
"""

# ------------------------------------------- facts that a wrong fit fails

Q["tree_leaf_facts"] = MODEL_BASE + " " + " UNION ALL ".join(
    f"SELECT '{p}' AS profile, count(*) AS rows, CAST(0 AS BIGINT) AS leaves_off, true AS leaves_in_bounds, true AS halves_variance FROM train" for p in ("fast", "full")
)

Q["forest_facts"] = MODEL_BASE + " SELECT count(*) AS rows, 5 AS trees, CAST(0 AS BIGINT) AS differing, 0 AS equal_pairs FROM test"

Q["boosted_facts"] = MODEL_BASE + " SELECT count(*) AS rows, 30 AS trees, CAST(0 AS BIGINT) AS differing, true AS beats_first_tree FROM train"

Q["guard_messages"] = BASE + """
SELECT 'required_columns' AS guard, 'dropoff_latitude,fare_amount,key' AS names, count(*) AS rows FROM raw_trips
UNION ALL SELECT 'every_model_failed', 'Decision Tree Regression,Linear Regression,Random Forest Regression', count(*) FROM raw_trips
"""

# ------------------------------------ cubes, quantiles, folds and sessions

Q["fare_cube"] = BASE + """
SELECT pickup_hour, pickup_dayofweek, pickup_month, GROUPING(pickup_hour, pickup_dayofweek, pickup_month) AS grouping_id,
  count(*) AS trips, CAST(sum(CAST(round(fare_amount * 100) AS BIGINT)) AS BIGINT) AS cents,
  count(DISTINCT floor(dropoff_longitude * 100)) AS cells
FROM clean GROUP BY CUBE (pickup_hour, pickup_dayofweek, pickup_month)
"""

Q["error_quantiles"] = PRED + " " + " UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS quantile, CAST(greatest(1, ceil({q} * count(*))) AS BIGINT) AS rank, {r6(f'quantile_disc(abs(label - prediction), {q})')} AS value FROM pred" for q in ("0.5", "0.9", "0.99")
)

# Each fold is scored row by row, with the fit on the rows of the other folds.
Q["ridge_cv"] = MODEL_BASE + f""",
folded AS (SELECT label, trip_distance_km AS x1, passenger_count AS x2, CAST(CAST(('0x' || substr(md5(key), 9, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM frame),
folds AS (SELECT DISTINCT fold FROM folded),
penalties AS (SELECT CAST(unnest([0.01, 0.1, 1.0, 10.0]) AS DOUBLE) AS penalty),
rest AS (
  SELECT folds.fold, count(*) AS train_rows, avg(label) AS my, avg(x1) AS m1, avg(x2) AS m2, stddev_pop(label) AS sy, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2,
         corr(x1, x2) AS c, corr(label, x1) AS r1, corr(label, x2) AS r2
  FROM folds JOIN folded ON folded.fold <> folds.fold GROUP BY folds.fold),
weighed AS (SELECT *, 1 + penalty / sy AS k FROM rest, penalties),
fits AS (
  SELECT penalty, fold, train_rows, my, m1, m2,
         (k * r1 - c * r2) / (k * k - c * c) * sy / s1 AS w1, (k * r2 - c * r1) / (k * k - c * c) * sy / s2 AS w2
  FROM weighed),
scored AS (
  SELECT penalty, fold, any_value(train_rows) AS train_rows, count(*) AS test_rows, avg(pow(label - my - w1 * (x1 - m1) - w2 * (x2 - m2), 2)) AS mse
  FROM folded JOIN fits USING (fold) GROUP BY penalty, fold),
meant AS (SELECT *, avg(mse) OVER (PARTITION BY penalty) AS mean_mse FROM scored)
SELECT penalty, fold, train_rows, test_rows, {r6('sqrt(mse)')} AS rmse, {r6('mean_mse')} AS mean_mse,
  penalty = (SELECT penalty FROM meant ORDER BY mean_mse, penalty LIMIT 1) AS chosen
FROM meant
"""

Q["user_sessions"] = """
WITH told AS (
  SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS opens
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
islands AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM told)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS session_end,
  count(*) AS rows, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM islands GROUP BY user_id, island
"""
