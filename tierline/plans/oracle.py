"""The same queries as DuckDB SQL over the sample tables, written independently."""


def _raw(factor: int = 30) -> str:
    return f"""
raw AS (
  SELECT e.event_id AS row_idx,
         make_timestamp((1704067200 + (CAST(floor(epoch(e.ts)) AS BIGINT) - 1704067200) // {factor}) * 1000000) AS event_time,
         e.event_type,
         e.k AS product_id,
         2053013550000000000 + p.p_size AS category_id,
         CASE e.k % 5
           WHEN 1 THEN lower(p.p_type)
           WHEN 2 THEN replace(p.p_name, ' ', '.')
           WHEN 3 THEN lower(p.p_type) || '.' || replace(p.p_name, ' ', '.')
           WHEN 4 THEN lower(p.p_type) || '.' || replace(p.p_name, ' ', '.') || '.x'
         END AS category_code,
         CASE WHEN e.k % 7 <> 0 THEN p.p_brand END AS brand,
         CAST(CASE WHEN e.event_id % 50 <> 0 THEN e.value END AS DECIMAL(18,2)) AS price,
         CASE WHEN e.user_id % 11 <> 0 THEN 's' || (e.user_id % 40) END AS user_session,
         e.event_id % 37 = 0 AS second_arrival
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e
  JOIN part p ON p.p_partkey = e.k
)"""


_CLEAN = """
leveled AS (
  SELECT *, string_split(coalesce(category_code, CAST(category_id AS VARCHAR)), '.') AS path
  FROM raw
),
clean AS (
  SELECT row_idx, event_time, event_type, CAST(product_id AS VARCHAR) AS product_id,
         coalesce(brand, CAST(product_id AS VARCHAR)) AS brand,
         CASE WHEN len(path) <= 3 THEN path[1] END AS category_l1,
         CASE len(path) WHEN 1 THEN path[1] WHEN 2 THEN path[2] WHEN 3 THEN path[2] END AS category_l2,
         CASE len(path) WHEN 1 THEN path[1] WHEN 2 THEN path[2] WHEN 3 THEN path[3] END AS category_l3,
         price, user_session, second_arrival,
         date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS bucket_end
  FROM leveled
)"""


def _counted(batch: str = "1") -> str:
    """Purchases, and the first view of each product in a session and batch."""
    return f"""
counted AS (
  SELECT * FROM clean WHERE event_type = 'purchase'
  UNION ALL
  SELECT * FROM clean WHERE event_type = 'view'
  QUALIFY row_number() OVER (PARTITION BY user_session, product_id, {batch}
                             ORDER BY event_time, row_idx) = 1
)"""


_ALL_COUNTED = """
counted AS (SELECT * FROM clean WHERE event_type IN ('purchase', 'view'))"""


def _minutes(dimensions=("product_id", "brand", "category_l3"), name: str = "minutes", where: str = "TRUE") -> str:
    parts = [
        f"""SELECT event_type, '{dim}' AS dim, {dim} AS dim_value, bucket_end,
       sum(price) AS price_sum, count(price) AS event_count
  FROM counted WHERE {where} GROUP BY event_type, {dim}, bucket_end"""
        for dim in dimensions
    ]
    return f"\n{name} AS (\n  " + "\n  UNION ALL\n  ".join(parts) + "\n)"


def _rolled(source: str, label: str, unit: str, name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT event_type, dim, dim_value, date_trunc('{unit}', {label}) + INTERVAL 1 {unit} AS bucket_end,
         sum(price_sum) AS price_sum, CAST(sum(event_count) AS BIGINT) AS event_count
  FROM {source} WHERE {where} GROUP BY ALL
)"""


def _with(*steps: str) -> str:
    return "WITH " + ",".join(steps) + "\n"


_TIER = """
SELECT event_type, dim, dim_value, bucket_end,
       CAST(price_sum AS DOUBLE) AS price_sum, event_count FROM """

_CLOCK = "SELECT max(bucket_end) FROM {} WHERE event_type = 'view' AND dim = 'category_l3'"


_VIEWS = "SELECT max(bucket_end) FROM minutes WHERE event_type = 'view'"


def _table(event: str, dim: str) -> str:
    columns = []
    if event == "purchase":
        columns.append("CAST(sum(price) AS DOUBLE) AS gmv")
    if event == "view" or dim == "product_id":
        columns.append("count(price) AS event_count")
    if dim == "product_id":
        columns.append(
            "CASE WHEN count(price) > 0 THEN CAST(sum(price) AS DOUBLE) / count(price) END AS avg_price"
        )
    return (
        _with(_raw(), _CLEAN, _counted())
        + f"SELECT {dim}, bucket_end, {', '.join(columns)} FROM counted"
        + f" WHERE event_type = '{event}' GROUP BY {dim}, bucket_end"
    )


def _categories(event: str) -> str:
    measure = (
        "CAST(price_sum AS DOUBLE) AS gmv" if event == "purchase" else "event_count"
    )
    return (
        _with(_raw(), _CLEAN, _counted(), _minutes(("category_l1", "category_l2", "category_l3")))
        + f"SELECT dim, dim_value, bucket_end, {measure} FROM minutes WHERE event_type = '{event}'"
    )


def _bucket(unit: str) -> str:
    return (
        _with(_raw())
        + f"SELECT row_idx, event_time, date_trunc('{unit}', event_time) + INTERVAL 1 {unit} AS bucket_end FROM raw"
    )


def _slice(condition: str) -> str:
    return f"SELECT event_id, ts, event_type, value FROM events WHERE {condition}"


_DEALT = """
dealt AS (
  SELECT row_idx, event_time, date_trunc('minute', event_time) AS minute,
         CAST((row_number() OVER (PARTITION BY date_trunc('minute', event_time)
                                  ORDER BY event_time, row_idx) - 1) % 4 AS INTEGER) AS server
  FROM raw
)"""

_RAW_COLUMNS = """row_idx, event_time, event_type, product_id, category_id, category_code, brand,
       CAST(price AS DOUBLE) AS price, user_session"""

# Ids read from files are text.
_FILE_COLUMNS = """row_idx, event_time, event_type, CAST(product_id AS VARCHAR) AS product_id,
       CAST(category_id AS VARCHAR) AS category_id, category_code, brand,
       CAST(price AS DOUBLE) AS price, user_session"""

_MINUTE_TIER = _with(_raw(), _CLEAN, _counted(), _minutes()) + _TIER + "minutes"
_ONE_SHOT = _with(_raw(), _CLEAN, _ALL_COUNTED, _minutes()) + _TIER + "minutes"

_TRAILING = f"""
last_hour AS (
  SELECT event_type, dim, dim_value, sum(price_sum) AS price_sum,
         CAST(sum(event_count) AS BIGINT) AS event_count
  FROM minutes
  WHERE bucket_end > ({_CLOCK.format('minutes')}) - INTERVAL 60 MINUTE
    AND bucket_end <= ({_CLOCK.format('minutes')})
  GROUP BY event_type, dim, dim_value
)"""


_PUBLISHED = """
SELECT event_type, dim, dim_value, {time}
       CASE WHEN event_type = 'purchase' THEN CAST(price_sum AS DOUBLE) END AS gmv,
       CASE WHEN event_type = 'view' OR dim = 'product_id' THEN event_count END AS event_count,
       CASE WHEN dim = 'product_id' AND event_count > 0
            THEN CAST(price_sum AS DOUBLE) / event_count END AS avg_price
FROM {source}"""

_HOUR_TIER = (
    _with(_raw(), _CLEAN, _counted(), _minutes(), _rolled("minutes", "bucket_end", "hour", "hours"))
    + _TIER
    + "hours"
)


def _archive(block: str, factor: int, slice_unit: str = "minute") -> str:
    form = {"hour": "%Y-%m-%d-%H", "day": "%Y-%m-%d"}[block]
    return (
        _with(_raw(factor))
        + f"SELECT {_FILE_COLUMNS}, strftime(event_time, '{form}') AS block FROM raw"
        + f" WHERE date_trunc('{block}', event_time) + INTERVAL 1 {block}"
        + " < (SELECT max(date_trunc('"
        + slice_unit
        + "', event_time)) FROM raw)"
    )


ORACLE = {
    "retail_events": _with(_raw()) + f"SELECT {_RAW_COLUMNS} FROM raw",
    "concentrate_30x": """
SELECT event_id, ts,
       make_timestamp((1704067200 + (CAST(floor(epoch(ts)) AS BIGINT) - 1704067200) // 30) * 1000000) AS event_time
FROM events""",
    "server_shards": _with(_raw(), _DEALT)
    + "SELECT *, strftime(minute, '%Y-%m-%d-%H-%M-%S') || '-' || server AS file_key FROM dealt",
    "clean_dimensions": _with(_raw(), _CLEAN)
    + "SELECT row_idx, product_id, brand, category_l1, category_l2, category_l3 FROM clean",
    "event_split": _with(_raw())
    + "SELECT event_type, row_idx, event_time, product_id, CAST(price AS DOUBLE) AS price"
    + " FROM raw WHERE event_type IN ('purchase', 'view')",
    "bucket_minute": _bucket("minute"),
    "bucket_hour": _bucket("hour"),
    "slice_half_open": _slice(
        "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'"
    ),
    "slice_look_back": _slice(
        "ts >= TIMESTAMP '2024-01-14 06:00:00' AND ts < TIMESTAMP '2024-01-15 06:00:00'"
    ),
    "slice_closed": _MINUTE_TIER
    + " WHERE bucket_end BETWEEN TIMESTAMP '2024-01-01 06:00:00' AND TIMESTAMP '2024-01-01 18:00:00'",
    "view_dedup": _with(_raw(), _CLEAN, _counted())
    + """SELECT row_idx, event_time, user_session, CAST(product_id AS BIGINT) AS product_id,
       CAST(price AS DOUBLE) AS price FROM counted WHERE event_type = 'view'""",
    "view_product_minute": _table("view", "product_id"),
    "purchase_product_minute": _table("purchase", "product_id"),
    "view_brand_minute": _table("view", "brand"),
    "purchase_brand_minute": _table("purchase", "brand"),
    "view_category_minute": _categories("view"),
    "purchase_category_minute": _categories("purchase"),
    "minute_tier": _MINUTE_TIER,
    "minute_tier_published": _with(_raw(), _CLEAN, _counted(), _minutes())
    + _PUBLISHED.format(time="bucket_end,", source="minutes"),
    "hour_tier": _HOUR_TIER,
    "hour_tier_event_aligned": _with(
        _raw(),
        _CLEAN,
        _counted(),
        _minutes(),
        _rolled("minutes", "(bucket_end - INTERVAL 1 MINUTE)", "hour", "hours"),
    )
    + _TIER
    + "hours",
    "day_tier": _with(
        _raw(1),
        _CLEAN,
        _counted(),
        _minutes(),
        _rolled("minutes", "bucket_end", "hour", "hours"),
        _rolled("hours", "bucket_end", "day", "days"),
    )
    + _TIER
    + "days",
    "merge_average": _with(_raw(), _CLEAN, _ALL_COUNTED)
    + """
SELECT product_id, bucket_end, count(price) AS event_count,
       CASE WHEN count(price) > 0 THEN round(CAST(sum(price) AS DOUBLE) / count(price), 6) END AS avg_price
FROM counted WHERE event_type = 'view' GROUP BY product_id, bucket_end""",
    "transport_hours": _with(
        _raw(),
        _CLEAN,
        _counted("event_time < TIMESTAMP '2024-01-01 12:00:00'"),
        _minutes(),
        _rolled(
            "minutes",
            "bucket_end",
            "hour",
            "hours",
            f"bucket_end < date_trunc('hour', ({_CLOCK.format('minutes')}))",
        ),
    )
    + _TIER
    + "hours",
    "rolling_hour_totals": _with(_raw(), _CLEAN, _counted(), _minutes(), _TRAILING)
    + """
SELECT event_type, dim, dim_value, CAST(price_sum AS DOUBLE) AS price_sum, event_count
FROM last_hour""",
    "rank_tables": _with(_raw(), _CLEAN, _counted(), _minutes(), _TRAILING)
    + _PUBLISHED.format(time="", source="last_hour"),
    "rolling_hour_rank": _with(_raw(), _CLEAN, _counted(), _minutes(), _TRAILING)
    + """,
scored AS (
  SELECT *, CASE WHEN event_type = 'purchase' THEN price_sum ELSE event_count END AS score FROM last_hour
)
SELECT event_type, dim, dim_value, CAST(price_sum AS DOUBLE) AS price_sum, event_count,
       CAST(row_number() OVER (PARTITION BY event_type, dim
            ORDER BY score DESC NULLS LAST, dim_value ASC NULLS LAST) AS INTEGER) AS position,
       CAST(rank() OVER (PARTITION BY event_type, dim ORDER BY score DESC NULLS LAST) AS INTEGER) AS rank
FROM scored QUALIFY position <= 10""",
    "rolling_hour_series": _with(_raw(), _CLEAN, _counted(), _minutes())
    + """
SELECT a.event_type, a.dim, a.dim_value, a.bucket_end,
       CAST(sum(b.price_sum) AS DOUBLE) AS price_sum, CAST(sum(b.event_count) AS BIGINT) AS event_count
FROM minutes a JOIN minutes b
  ON a.event_type = b.event_type AND a.dim = b.dim AND a.dim_value IS NOT DISTINCT FROM b.dim_value
 AND b.bucket_end <= a.bucket_end AND b.bucket_end >= a.bucket_end - INTERVAL 59 MINUTE
GROUP BY ALL""",
    "tier_clock": _with(_raw(), _CLEAN, _counted())
    + """
SELECT coalesce(min(bucket_end), TIMESTAMP '2019-10-01') AS oldest,
       coalesce(max(bucket_end), TIMESTAMP '2019-10-01') AS newest
FROM counted WHERE event_type = 'view'""",
    "retention_24h": _with(_raw(1), _CLEAN, _counted(), _minutes())
    + _TIER
    + f"minutes WHERE bucket_end >= ({_CLOCK.format('minutes')}) - INTERVAL 24 HOUR",
    "transport_brand_only": _with(
        _raw(),
        _CLEAN,
        _counted(),
        _minutes(("brand",)),
        _rolled("minutes", "bucket_end", "hour", "hours", f"bucket_end < date_trunc('hour', ({_VIEWS}))"),
    )
    + _TIER
    + "hours",
    "transport_before_grid": _with(
        _raw(),
        _CLEAN,
        _counted(),
        _minutes(),
        _rolled("minutes", "bucket_end", "hour", "hours", f"bucket_end < date_trunc('hour', ({_VIEWS}))"),
    )
    + """
SELECT event_type, dim, dim_value, bucket_end - INTERVAL 2000 DAY AS bucket_end,
       CAST(price_sum AS DOUBLE) AS price_sum, event_count FROM hours""",
    "purchase_repeated_index": _ONE_SHOT + " WHERE event_type = 'purchase'",
    "backlog_repair_twice": _ONE_SHOT,
    "batch_pipeline": _ONE_SHOT,
    "landing_mixed_headers": _ONE_SHOT,
    "batch_pipeline_hours": _with(
        _raw(),
        _CLEAN,
        _ALL_COUNTED,
        _minutes(),
        _rolled("minutes", "bucket_end", "hour", "hours", f"bucket_end < date_trunc('hour', ({_VIEWS}))"),
    )
    + _TIER
    + "hours",
    "rank_snapshot": _with(_raw(), _CLEAN, _ALL_COUNTED, _minutes(), _TRAILING)
    + """
SELECT event_type, dim, dim_value, CAST(price_sum AS DOUBLE) AS price_sum, event_count
FROM last_hour""",
    "stream_trailing_hour": _with(_raw(), _CLEAN, _ALL_COUNTED, _minutes(), _TRAILING)
    + """
SELECT event_type, dim, dim_value, CAST(price_sum AS DOUBLE) AS price_sum, event_count
FROM last_hour""",
    "rejected_events": _with(_raw())
    + """
SELECT row_idx, event_type, CAST(product_id AS VARCHAR) AS product_id, CAST(price AS DOUBLE) AS price
FROM raw WHERE row_idx % 41 = 0""",
    "landing_without_index": _with(_raw())
    + """
SELECT event_time, event_type, CAST(product_id AS VARCHAR) AS product_id,
       CAST(category_id AS VARCHAR) AS category_id, category_code, brand,
       CAST(price AS DOUBLE) AS price, user_session, date_trunc('hour', event_time) AS file_time
FROM raw""",
    "landing_with_user_id": _with(_raw())
    + """
SELECT row_idx, event_time, event_type, 'A' || product_id AS product_id,
       CAST(category_id AS VARCHAR) AS category_id, category_code, brand,
       CAST(price AS DOUBLE) AS price, user_session
FROM raw""",
    "archive_late_file": _with(_raw())
    + """
SELECT CAST(row_idx AS VARCHAR) AS row_idx, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
       CAST(price AS VARCHAR) AS price, user_session, strftime(event_time, '%Y-%m-%d-%H') AS block
FROM raw
WHERE date_trunc('hour', event_time) + INTERVAL 1 hour
  < (SELECT max(date_trunc('hour', event_time)) FROM raw)""",
    "late_split": _with(_raw(), _CLEAN, _counted("second_arrival"))
    + """
SELECT row_idx, date_trunc('minute', event_time) AS file_time,
       second_arrival AND date_trunc('minute', event_time) <
         (SELECT max(bucket_end) FROM counted WHERE event_type = 'view' AND NOT second_arrival) AS is_late
FROM raw""",
    "backlog_repair_minute": _ONE_SHOT,
    "backlog_repair_stored": _ONE_SHOT,
    "backlog_repair_hour": _with(
        _raw(),
        _CLEAN,
        _ALL_COUNTED,
        _minutes(),
        _rolled(
            "minutes",
            "bucket_end",
            "hour",
            "hours",
            f"bucket_end < date_trunc('hour', ({_CLOCK.format('minutes')}))",
        ),
    )
    + _TIER
    + "hours",
    "merge_duplicates": _ONE_SHOT,
    "compact_after_crash": _ONE_SHOT,
    "late_and_live_equal": _with(_raw(), _CLEAN, _ALL_COUNTED, _minutes())
    + """
SELECT event_type, dim, dim_value, bucket_end, CAST(2 * price_sum AS DOUBLE) AS price_sum,
       2 * event_count AS event_count
FROM minutes WHERE event_type = 'purchase'""",
    "retention_wrong_date": _with(
        _raw(1),
        _CLEAN,
        _counted(),
        _minutes(),
        """
ahead AS (
  SELECT * REPLACE (TIMESTAMP '2024-05-05 05:06:00' AS bucket_end)
  FROM (SELECT * FROM clean WHERE event_type = 'view' ORDER BY row_idx LIMIT 1)
)""",
    )
    + _TIER
    + f"minutes WHERE bucket_end >= ({_CLOCK.format('minutes')}) - INTERVAL 24 HOUR"
    + "".join(
        f"""
UNION ALL SELECT event_type, '{dim}', {dim}, bucket_end, CAST(price AS DOUBLE), CAST(price IS NOT NULL AS BIGINT) FROM ahead"""
        for dim in ("product_id", "brand", "category_l3")
    ),
    "file_time_range": _with(_raw())
    + """
SELECT min(date_trunc('minute', event_time)) AS oldest, max(date_trunc('minute', event_time)) AS newest
FROM raw""",
    "landing_files": _with(_raw(), _DEALT)
    + f"""
SELECT {_FILE_COLUMNS}, date_trunc('hour', event_time) AS file_time, server
FROM raw JOIN (SELECT row_idx, server FROM dealt) USING (row_idx)""",
    "archive_block_hour": _archive("hour", 30),
    "archive_block_day": _archive("day", 1),
    "archive_landing": _archive("hour", 30, "hour"),
    "stream_minute_tier": _MINUTE_TIER,
    "stream_view_batches": _MINUTE_TIER,
    "stream_folded": _MINUTE_TIER,
    "stream_hour_tier": _HOUR_TIER,
    "stream_backlog": _with(_raw(), _CLEAN, _ALL_COUNTED, _minutes())
    + """,
live_clock AS (
  SELECT max(bucket_end) AS clock FROM counted WHERE event_type = 'view' AND NOT second_arrival
),"""
    + _minutes(
        name="late",
        where="second_arrival AND date_trunc('hour', event_time) < (SELECT clock FROM live_clock)",
    )
    + """
SELECT m.event_type, m.dim, m.dim_value, m.bucket_end, CAST(m.price_sum AS DOUBLE) AS price_sum,
       m.event_count, coalesce(l.event_count, 0) AS late_count
FROM minutes m LEFT JOIN late l
  ON m.event_type = l.event_type AND m.dim = l.dim AND m.bucket_end = l.bucket_end
 AND m.dim_value IS NOT DISTINCT FROM l.dim_value""",
    "stream_view_dedup": _with(_raw())
    + "SELECT DISTINCT user_session, product_id FROM raw WHERE event_type = 'view'",
    "stream_rolling_hour": _with(_raw(), _CLEAN, _ALL_COUNTED, _minutes())
    + """
SELECT event_type, dim, dim_value, bucket_end + to_minutes(ahead) AS bucket_end,
       CAST(sum(price_sum) AS DOUBLE) AS price_sum, CAST(sum(event_count) AS BIGINT) AS event_count
FROM minutes, range(60) AS steps(ahead)
GROUP BY ALL""",
}
