"""Line patterns, level names, tag words and stored-column lists.

Patterns are in Java syntax. Word, space and digit classes are spelled out
because Java's shorthands cover ASCII only, while log text may not.
"""

# --- character classes -----------------------------------------------------
WORD = r"[\w\p{L}\p{N}]"
NON_WORDS = r"[^\w\p{L}\p{N}]+"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
NON_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
WORD_START = rf"(?<!{WORD})"
WORD_END = rf"(?!{WORD})"
TOKEN = rf"{WORD}+"
# The same space characters as a set to trim, far cheaper than a pattern.
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- line formats, in the order they are tried; all anchored at the start ---
ISO_TIME = (
    r"\d{4}-\d{2}-\d{2}[T" + SPACE[1:] + r"\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?"
)
# groups: ip, time
ACCESS_LINE = (
    r'^(\d{1,3}(?:\.\d{1,3}){3}) - - \[([^\]]+)\] "'
    + WORD
    + r'+ [^"]*" \d+ \d+ "[^"]*" "[^"]*"'
)
# groups: time, host, process, message
SYSLOG_HEAD = (
    rf"^({WORD}+{SPACE}+\d+{SPACE}+\d+:\d+:\d+){SPACE}+({NON_SPACE}+){SPACE}+({NON_SPACE}+):{SPACE}"
)
SYSLOG_LINE = rf"{SYSLOG_HEAD}+([^\n]*)"
# groups: time, level, source, message
WINDOWS_LINE = (
    rf"^TimeGenerated:{SPACE}*(\d{{4}}-\d{{2}}-\d{{2}}{SPACE}\d{{2}}:\d{{2}}:\d{{2}}),"
    rf"{SPACE}*EventID:{SPACE}*\d+,{SPACE}*Level:{SPACE}*({WORD}+),"
    rf"{SPACE}*Source:{SPACE}*([^,]+),{SPACE}*Message:{SPACE}*([^\n]*)"
)
# groups: time, level, message
GENERIC_LINE = rf"^({ISO_TIME}){SPACE}*(?:\[({WORD}+)\])?{SPACE}*([^\n]*)"
# searched anywhere in lines of no known format
ANY_ISO_TIME = rf"({ISO_TIME})"
ANY_LEVEL = rf"(?i)(?=[EWIDCF]){WORD_START}(ERROR|WARN|WARNING|INFO|DEBUG|CRITICAL|FATAL){WORD_END}"

# --- shapes of a captured time -----------------------------------------------
ACCESS_CLOCK = rf"^\d{{1,2}}/[A-Za-z]{{3}}/\d{{4}}:\d{{1,2}}:\d{{1,2}}:\d{{1,2}}(?:{SPACE}|$)"
ISO_CLOCK = rf"^{ISO_TIME}$"
ISO_SECONDS = r"^.{11}([\d:]{8}(?:\.\d{1,6})?)"
ISO_OFFSET = r"([+-]\d{2}:?\d{2})$"
SYSLOG_CLOCK = rf"^{WORD}+{SPACE}+\d+{SPACE}+\d+:\d+:\d+$"
CLOCK_SEPARATORS = r"[/:" + SPACE[1:] + "+"

# --- pieces of a message ---------------------------------------------------
# Looking ahead for a digit first spares the costlier look behind elsewhere.
IPV4 = rf"(?=\p{{Nd}}){WORD_START}(?:\p{{Nd}}{{1,3}}\.){{3}}\p{{Nd}}{{1,3}}{WORD_END}"
VALID_IPV4 = r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"
PORT = r"(?=[pP:/])(?:(?:port|Port)[:" + SPACE[1:] + r"+(\d+)|[:/](\d+))"
PROCESS_ID = r"^(.*?)\[(\d+)\]$"

LEVELS = {
    "emerg": "CRITICAL",
    "emergency": "CRITICAL",
    "fatal": "CRITICAL",
    "alert": "CRITICAL",
    "crit": "CRITICAL",
    "critical": "CRITICAL",
    "err": "ERROR",
    "error": "ERROR",
    "warn": "WARNING",
    "warning": "WARNING",
    "notice": "INFO",
    "info": "INFO",
    "information": "INFO",
    "debug": "DEBUG",
    "trace": "DEBUG",
}

TAG_WORDS = {
    "error": ["error", "failed", "failure", "invalid", "exception"],
    "warning": ["warning", "warn", "attention"],
    "success": ["success", "successful", "completed", "ok"],
    "security": ["security", "auth", "authentication", "permission", "login", "logout"],
    "network": ["connect", "disconnect", "receive", "send", "packet"],
}

MONTHS = [
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
]
EXTRA_MONTH_NAMES = {"sept": 9}

FAILED_AUTH_PHRASE = "failed password"
INVALID_USER_PHRASE = "invalid user"

# --- column lists ------------------------------------------------------------
EVENT_COLUMNS = [
    "timestamp",
    "source_file",
    "level",
    "indicator_tags_list",
    "ip_src",
    "ip_dst",
    "service",
    "message",
    "peer_port",
    "line_number",
    "ip_src_valid",
    "ip_dst_valid",
    "message_raw",
    "day_of_week",
    "hour_of_day",
    "is_weekend",
]
NUMERIC_FEATURES = [
    "event_count",
    "unique_messages",
    "distinct_hosts",
    "distinct_processes",
    "avg_msg_length",
    "failed_auth_count",
    "invalid_user_count",
    "entropy_tokens",
]
FEATURE_COLUMNS = ["window_start", "window_end", *NUMERIC_FEATURES]
LABEL_COLUMNS = [
    "isolation_forest_label",
    "dbscan_label",
    "autoencoder_label",
    "ensemble_anomaly",
]
RESULT_COLUMNS = ["date", "start_time", "end_time", *NUMERIC_FEATURES, *LABEL_COLUMNS]

# Texts a CSV reader treats as missing.
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
