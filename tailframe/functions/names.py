"""Log file names: which are log files of an engine, and what to call them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What log files of an engine are called.
POSTGRES_PREFIXES = ("postgresql.log", "postgres.log")
MYSQL_PREFIXES = ("mysql-error", "mysql-slowquery", "mysql-general", "mariadb-error", "mariadb-slowquery", "mariadb-general")
MYSQL_FOLDERS = ("error/", "slowquery/", "general/")


def basename(name: Column) -> Column:
    """What follows the last slash, trailing slashes aside; empty for an empty name."""
    return F.regexp_extract(F.regexp_replace(name, "/+$", ""), "([^/]*)$", 1)


def _starts(c: Column, prefixes: tuple[str, ...]) -> Column:
    test = F.lit(False)
    for p in prefixes:
        test = test | F.startswith(c, F.lit(p))
    return test


def accepts(engine: Column, log_file: Column) -> Column:
    """Whether the file is a log file of the engine; other engines accept all files."""
    # One pattern for each kind, on the name itself: what follows the last slash, trailing slashes aside, begins with one of the prefixes.
    begins = lambda prefixes: F.lower(log_file).rlike("(^|/)(" + "|".join(re.escape(p) for p in prefixes) + ")[^/]*/*$")
    postgres = begins(POSTGRES_PREFIXES)
    mysql = begins(MYSQL_PREFIXES) | _starts(F.lower(log_file), MYSQL_FOLDERS)
    return F.when(engine == "postgres", postgres).when(engine.isin("mysql", "mariadb"), mysql).otherwise(True)


def listing_hint(engine: str) -> str:
    """A substring by which a lister may narrow its answer; empty where there is none."""
    return "postgres" if engine == "postgres" else ""


def file_label(log_file: Column) -> Column:
    """A short label for metrics: what follows the last slash, at most 64 characters."""
    return F.substring(F.substring_index(log_file, "/", -1), 1, 64)


def last_written(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp; 0 means unset."""
    return F.timestamp_millis(F.nullif(ms, F.lit(0)))
