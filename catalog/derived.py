"""Log lines built from the `events` table, in Spark and as SQL common tables.

Both sides spell out the same rule, so the whole table becomes log text of five
formats that the parser has to take apart again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

YEAR = 2024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, source_file, line"""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "cast(ts AS timestamp) AS at",
        "concat('host', user_id % 7, '.log') AS source_file",
        """CASE event_type
             WHEN 'error' THEN concat('Failed password for invalid user u', user_id,
                  ' from 10.0.', user_id % 256, '.', event_id % 300,
                  ' port ', 1024 + event_id % 5000, ' ssh2')
             WHEN 'view' THEN concat('Invalid user u', user_id,
                  ' from 172.16.', user_id % 256, '.', event_id % 256)
             WHEN 'signup' THEN concat('authentication success for u', user_id,
                  ', session completed')
             WHEN 'click' THEN concat('connect 192.168.0.', user_id % 256,
                  ' to 10.1.0.', event_id % 256, ':443 packet ok')
             ELSE concat('warning: order ', event_id, ' needs attention')
           END AS message""",
    )
    return events.selectExpr(
        "event_id",
        "source_file",
        """CASE event_id % 5
             WHEN 0 THEN concat(date_format(at, 'MMM d HH:mm:ss'), ' host', user_id % 7,
                  ' app[', user_id, ']: ', message)
             WHEN 1 THEN concat('10.2.0.', user_id % 256, ' - - [',
                  date_format(at, 'dd/MMM/yyyy:HH:mm:ss'), ' +0000] "GET /', event_type,
                  ' HTTP/1.1" 200 ', event_id, ' "-" "agent"')
             WHEN 2 THEN concat('TimeGenerated: ', date_format(at, 'yyyy-MM-dd HH:mm:ss'),
                  ', EventID: ', event_id, ', Level: ',
                  if(event_type = 'error', 'Error', 'Information'),
                  ', Source: svc', user_id % 5, ', Message: ', message)
             WHEN 3 THEN concat(date_format(at, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), ' [',
                  if(event_type = 'purchase', 'warn', 'info'), '] ', message)
             ELSE concat('note ', event_type, ' CRITICAL ',
                  date_format(at, 'yyyy-MM-dd HH:mm:ss'), ' ', message)
           END AS line""",
    )


LINES_SQL = r"""
built AS (
  SELECT event_id, user_id, event_type, ts,
         concat('host', user_id % 7, '.log') AS source_file,
         CASE event_type
           WHEN 'error' THEN concat('Failed password for invalid user u', user_id,
                ' from 10.0.', user_id % 256, '.', event_id % 300,
                ' port ', 1024 + event_id % 5000, ' ssh2')
           WHEN 'view' THEN concat('Invalid user u', user_id,
                ' from 172.16.', user_id % 256, '.', event_id % 256)
           WHEN 'signup' THEN concat('authentication success for u', user_id,
                ', session completed')
           WHEN 'click' THEN concat('connect 192.168.0.', user_id % 256,
                ' to 10.1.0.', event_id % 256, ':443 packet ok')
           ELSE concat('warning: order ', event_id, ' needs attention')
         END AS body
  FROM events),
lines AS (
  SELECT event_id, source_file,
         CASE event_id % 5
           WHEN 0 THEN concat(strftime(ts, '%b %-d %H:%M:%S'), ' host', user_id % 7,
                ' app[', user_id, ']: ', body)
           WHEN 1 THEN concat('10.2.0.', user_id % 256, ' - - [',
                strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' +0000] "GET /', event_type,
                ' HTTP/1.1" 200 ', event_id, ' "-" "agent"')
           WHEN 2 THEN concat('TimeGenerated: ', strftime(ts, '%Y-%m-%d %H:%M:%S'),
                ', EventID: ', event_id, ', Level: ',
                CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Information' END,
                ', Source: svc', user_id % 5, ', Message: ', body)
           WHEN 3 THEN concat(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), ' [',
                CASE WHEN event_type = 'purchase' THEN 'warn' ELSE 'info' END, '] ', body)
           ELSE concat('note ', event_type, ' CRITICAL ',
                strftime(ts, '%Y-%m-%d %H:%M:%S'), ' ', body)
         END AS line
  FROM built)
"""

# The line patterns, words and levels again, in the SQL engine's own regex
# syntax. Those of Spark are in logtide/functions/patterns.py.
_ISO = r"\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?"
_ACCESS = (
    r'^(\d{1,3}(?:\.\d{1,3}){3}) - - \[([^\]]+)\] "\w+ [^"]*" \d+ \d+ "[^"]*" "[^"]*"'
)
_SYSLOG = r"^(\w+\s+\d+\s+\d+:\d+:\d+)\s+(\S+)\s+(\S+):\s+([^\n]*)"
_WINDOWS = (
    r"^TimeGenerated:\s*(\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}),\s*EventID:\s*\d+,"
    r"\s*Level:\s*(\w+),\s*Source:\s*([^,]+),\s*Message:\s*([^\n]*)"
)
_GENERIC = rf"^({_ISO})\s*(?:\[(\w+)\])?\s*([^\n]*)"
_IP = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_VALID = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"
_PORT = r"(?:port|Port)[\s:]+(\d+)|[:/](\d+)"
_LEVEL = r"(?i)\b(ERROR|WARN|WARNING|INFO|DEBUG|CRITICAL|FATAL)\b"

PARSED_SQL = f"""
split AS (
  SELECT *, CASE WHEN regexp_matches(line, '{_ACCESS}') THEN 'access'
                 WHEN regexp_matches(line, '{_SYSLOG}') THEN 'syslog'
                 WHEN regexp_matches(line, '{_WINDOWS}') THEN 'windows'
                 WHEN regexp_matches(line, '{_GENERIC}') THEN 'generic'
                 ELSE 'fallback' END AS line_format
  FROM lines),
pieces AS (
  SELECT *,
    nullif(CASE line_format
      WHEN 'access' THEN regexp_extract(line, '{_ACCESS}', 2)
      WHEN 'syslog' THEN regexp_extract(line, '{_SYSLOG}', 1)
      WHEN 'windows' THEN regexp_extract(line, '{_WINDOWS}', 1)
      WHEN 'generic' THEN regexp_extract(line, '{_GENERIC}', 1)
      ELSE regexp_extract(line, '{_ISO}') END, '') AS time_text,
    nullif(CASE line_format
      WHEN 'syslog' THEN regexp_extract(line, '{_SYSLOG}', 4)
      WHEN 'windows' THEN regexp_extract(line, '{_WINDOWS}', 4)
      WHEN 'generic' THEN regexp_extract(line, '{_GENERIC}', 3) END, '') AS part,
    nullif(CASE line_format
      WHEN 'windows' THEN regexp_extract(line, '{_WINDOWS}', 2)
      WHEN 'generic' THEN regexp_extract(line, '{_GENERIC}', 2)
      WHEN 'fallback' THEN regexp_extract(line, '{_LEVEL}', 1) END, '') AS level_text,
    coalesce(nullif(CASE line_format
      WHEN 'syslog' THEN regexp_extract(line, '{_SYSLOG}', 3)
      WHEN 'windows' THEN regexp_extract(line, '{_WINDOWS}', 3) END, ''), '') AS service
  FROM split),
found AS (
  SELECT *, coalesce(part, line) AS message,
    CASE line_format
      WHEN 'access' THEN try_strptime(split_part(time_text, ' ', 1), '%d/%b/%Y:%H:%M:%S')
      WHEN 'syslog' THEN try_strptime(concat('{YEAR} ', regexp_replace(time_text, '\\s+', ' ', 'g')),
                                      '%Y %b %d %H:%M:%S')
      ELSE try_cast(time_text AS TIMESTAMP) END AS moment,
    CASE line_format
      WHEN 'access' THEN [regexp_extract(line, '{_ACCESS}', 1)]
      WHEN 'fallback' THEN regexp_extract_all(line, '{_IP}')
      ELSE regexp_extract_all(part, '{_IP}') END AS ips
  FROM pieces),
parsed AS (
  SELECT event_id, source_file AS file_name, line, line_format, moment AS "timestamp",
    'unknown' AS source_file,
    CASE WHEN lower(level_text) IN ('emerg','emergency','fatal','alert','crit','critical') THEN 'CRITICAL'
         WHEN lower(level_text) IN ('err','error') THEN 'ERROR'
         WHEN lower(level_text) IN ('warn','warning') THEN 'WARNING'
         WHEN lower(level_text) IN ('notice','info','information') THEN 'INFO'
         WHEN lower(level_text) IN ('debug','trace') THEN 'DEBUG'
         ELSE coalesce(upper(level_text), 'INFO') END AS level,
    array_to_string(list_filter([
      CASE WHEN regexp_matches(lower(message), '\\b(error|failed|failure|invalid|exception)\\b') THEN 'error' END,
      CASE WHEN regexp_matches(lower(message), '\\b(warning|warn|attention)\\b') THEN 'warning' END,
      CASE WHEN regexp_matches(lower(message), '\\b(success|successful|completed|ok)\\b') THEN 'success' END,
      CASE WHEN regexp_matches(lower(message), '\\b(security|auth|authentication|permission|login|logout)\\b') THEN 'security' END,
      CASE WHEN regexp_matches(lower(message), '\\b(connect|disconnect|receive|send|packet)\\b') THEN 'network' END
    ], lambda x: x IS NOT NULL), ',') AS tags,
    CASE WHEN coalesce(regexp_matches(ips[1], '{_VALID}'), false) THEN ips[1] ELSE '' END AS ip_src,
    CASE WHEN coalesce(regexp_matches(ips[2], '{_VALID}'), false) THEN ips[2] ELSE '' END AS ip_dst,
    coalesce(regexp_matches(ips[1], '{_VALID}'), false) AS ip_src_valid,
    coalesce(regexp_matches(ips[2], '{_VALID}'), false) AS ip_dst_valid,
    service, message,
    try_cast(coalesce(nullif(regexp_extract(part, '{_PORT}', 1), ''),
                      nullif(regexp_extract(part, '{_PORT}', 2), '')) AS BIGINT) AS peer_port,
    dayname(moment) AS day_of_week, hour(moment)::INT AS hour_of_day,
    coalesce(isodow(moment) >= 6, false) AS is_weekend
  FROM found)
"""


def features_sql(width_seconds: int = 60, source: str = "parsed") -> str:
    """Common tables `windowed` and `features` over `source`."""
    return f"""
origin AS (SELECT epoch_us(min("timestamp")) AS t0 FROM {source}),
windowed AS (
  SELECT p.*, (epoch_us("timestamp") - t0) // ({width_seconds}::BIGINT * 1000000) AS k, t0
  FROM {source} p, origin WHERE "timestamp" IS NOT NULL),
token_counts AS (
  SELECT k, token, count(*) AS c
  FROM (SELECT k, unnest(regexp_extract_all(lower(message), '[\\p{{L}}\\p{{N}}_]+')) AS token
        FROM windowed) GROUP BY k, token),
entropies AS (
  SELECT k, greatest(log2(sum(c)) - sum(c * log2(c)) / sum(c), 0) AS h
  FROM token_counts GROUP BY k),
features AS (
  SELECT make_timestamp(any_value(t0) + w.k * {width_seconds}::BIGINT * 1000000) AS window_start,
    make_timestamp(any_value(t0) + (w.k + 1) * {width_seconds}::BIGINT * 1000000) AS window_end,
    count(*) AS event_count,
    count(DISTINCT message) AS unique_messages,
    count(DISTINCT source_file) AS distinct_hosts,
    count(DISTINCT service) AS distinct_processes,
    round(avg(length(message)), 6) AS avg_msg_length,
    count(*) FILTER (lower(message) LIKE '%failed password%') AS failed_auth_count,
    count(*) FILTER (lower(message) LIKE '%invalid user%') AS invalid_user_count,
    round(coalesce(any_value(h), 0), 6) AS entropy_tokens
  FROM windowed w LEFT JOIN entropies e ON w.k = e.k GROUP BY w.k)
"""
