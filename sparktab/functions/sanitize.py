"""Text sanitising and LLM-output checks as chained JVM regex expressions.

The catalogues are applied in order, each pattern to the text left by the previous one, and the
number of matches is counted before each replacement.  Java regex and RE2 (the oracle) agree on
these patterns: flags ``(?i)``/``(?s)``, lazy ``.*?``, ``\\b``, character classes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference (pattern, replacement), in order.
# Response catalogue: case-insensitive and dot-all except where noted.
RESPONSE_PATTERNS = [
    (r"(?is)os\.system\s*\(.*?\)", "[BLOCKED:os.system]"),
    (r"(?is)subprocess\.(?:run|call|Popen|check_output)\s*\(.*?\)", "[BLOCKED:subprocess]"),
    (r"(?is)\beval\s*\(.*?\)", "[BLOCKED:eval]"),
    (r"(?is)\bexec\s*\(.*?\)", "[BLOCKED:exec]"),
    (r"(?is)__import__\s*\(.*?\)", "[BLOCKED:__import__]"),
    (r"(?is)compile\s*\(.*?\)", "[BLOCKED:compile]"),
    (r"(?is)os\.remove\s*\(.*?\)", "[BLOCKED:os.remove]"),
    (r"(?is)os\.unlink\s*\(.*?\)", "[BLOCKED:os.unlink]"),
    (r"(?is)shutil\.rmtree\s*\(.*?\)", "[BLOCKED:shutil.rmtree]"),
    (r"(?is)pathlib\.Path.*?\.unlink\s*\(", "[BLOCKED:Path.unlink]"),
    (r"""(?is)open\s*\([^)]+['"]w[a-z]?['"].*?\)""", "[BLOCKED:open-write]"),
    (r"(?i)ignore\s+(all\s+)?previous\s+instructions?", "[BLOCKED:injection]"),
    (r"(?i)disregard\s+(all\s+)?previous\s+instructions?", "[BLOCKED:injection]"),
    (r"(?i)\bsystem\s+prompt\b", "[BLOCKED:system-prompt]"),
    (r"\bDAN\b", "[BLOCKED:jailbreak]"),
]

# Input-text catalogue: case-insensitive, replacement "[REMOVED:<label>]".
INPUT_PATTERNS = [
    (r"(?i)os\.system\s*\(", "os.system("),
    (r"(?i)subprocess\.", "subprocess."),
    (r"(?i)\beval\s*\(", "eval("),
    (r"(?i)\bexec\s*\(", "exec("),
    (r"(?i)__import__\s*\(", "__import__("),
    (r"""(?i)open\s*\(.*['"]w['"]""", "open(..., 'w')"),
    (r"(?i)shutil\.rmtree", "shutil.rmtree"),
    (r"(?i)os\.remove\s*\(", "os.remove("),
    (r"(?i)os\.unlink\s*\(", "os.unlink("),
    (r"(?i)Ignore previous instructions", "prompt injection"),
    (r"(?i)system prompt", "system prompt reference"),
]

MAX_OUTPUT_CHARS = 50_000
MIN_OUTPUT_CHARS = 2


def _java_repl(s: str) -> str:
    # '$' and '\' are special in Java replacement strings
    return s.replace("\\", "\\\\").replace("$", "\\$")


def sanitize(text: Column, patterns=RESPONSE_PATTERNS) -> tuple[Column, Column]:
    """(sanitised text, number of replacements); null input -> ('', 0)."""
    t = F.coalesce(text, F.lit(""))
    n = F.lit(0)
    for p, r in patterns:
        n = n + F.regexp_count(t, F.lit(p))
        t = F.regexp_replace(t, p, _java_repl(r))
    return t, n


def sanitize_input(text: Column) -> Column:
    """Input-text catalogue -> ``[REMOVED:label]``."""
    t = F.coalesce(text, F.lit(""))
    for p, label in INPUT_PATTERNS:
        t = F.regexp_replace(t, p, _java_repl(f"[REMOVED:{label}]"))
    return t


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def validate_output(text: Column, expected_format: str = "json") -> tuple[Column, Column]:
    """(is_valid, cleaned): strip, length bounds, truncate, sanitise, fenced JSON must parse."""
    s = strip_ws(text)
    too_short = F.length(s) < MIN_OUTPUT_CHARS
    s = F.substring(s, 1, MAX_OUTPUT_CHARS)
    s = sanitize_input(s)
    if expected_format != "json":
        return F.when(too_short | text.isNull(), F.lit(False)).otherwise(F.lit(True)), \
            F.when(too_short | text.isNull(), F.lit("")).otherwise(s)
    fence = F.regexp_extract(s, r"```(?:json)?\s*([\s\S]+?)```", 1)
    js = F.when(s.rlike(r"```(?:json)?\s*([\s\S]+?)```"), strip_ws(fence)).otherwise(s)
    ok = F.try_parse_json(js).isNotNull()
    return (F.when(too_short | text.isNull(), F.lit(False)).otherwise(ok),
            F.when(too_short | text.isNull(), F.lit("")).otherwise(js))


# ---- DuckDB twins ------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sanitize_sql(text: str, patterns=RESPONSE_PATTERNS) -> tuple[str, str]:
    t, n = f"coalesce({text}, '')", "0"
    for p, r in patterns:
        n = f"{n} + len(regexp_extract_all({t}, {_sql_str(p)}))"
        t = f"regexp_replace({t}, {_sql_str(p)}, {_sql_str(r)}, 'g')"
    return t, n


def sanitize_input_sql(text: str) -> str:
    t = f"coalesce({text}, '')"
    for p, label in INPUT_PATTERNS:
        t = f"regexp_replace({t}, {_sql_str(p)}, {_sql_str(f'[REMOVED:{label}]')}, 'g')"
    return t
