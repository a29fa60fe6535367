"""Column functions on one line or one text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from runtrail import fixed_values as fixed


def strip_line(line):
    """The line without Unicode whitespace at its ends (``trim`` only knows the space)."""
    return F.btrim(line, F.lit(fixed.WHITESPACE))


def tokenize(text):
    """Tokens between runs of whitespace; quotes do not group, empty tokens do not occur."""
    return F.array_remove(F.split(text, fixed.WHITESPACE_RUN), "")


def _first_match(line, text, pattern):
    # contains() is far cheaper than the pattern and most lines fail it. nullif stays
    # outside the condition: inside it Spark would run the pattern twice.
    found = F.when(line.contains(text), F.regexp_extract(line, pattern, 1))
    return F.nullif(found, F.lit(""))


def application_id(line: Column, strict=False):
    """First application id. The loose form also takes ``application_`` of a plain word."""
    pattern = fixed.APPLICATION_STRICT if strict else fixed.APPLICATION
    return _first_match(line, fixed.APPLICATION_TEXT, pattern)


def driver_pod(line: Column):
    """Driver pod name: up to the first ``-driver``."""
    return _first_match(line, fixed.POD_TEXT, fixed.POD)


def exit_digits(line: Column):
    """Digits of the exit code. Kept as text so that a huge code still counts as a match."""
    return _first_match(line, fixed.EXIT_TEXT, fixed.EXIT)


def exit_code(line: Column):
    return exit_digits(line).try_cast("bigint")


def driver_id(line: Column):
    return _first_match(line, fixed.DRIVER_TEXT, fixed.DRIVER)


def driver_state(line: Column):
    """State on a status line; NULL on other lines and where the separator is missing."""
    # Stripping a line first matters only where a separator touches one of its ends, and
    # it is most of the cost. The usual line of a JSON reply shows that none does.
    after_name = F.locate(fixed.STATE_TEXT, line) < F.locate(fixed.STATE_SEPARATOR, line)
    closed = line.endswith(",") | line.endswith('"')
    source = F.when(after_name & closed, line).otherwise(strip_line(line))
    state = F.get(F.split(source, fixed.STATE_SEPARATOR, 3), F.lit(1))
    for mark in (",", '"'):
        state = F.replace(state, F.lit(mark), F.lit(""))
    return F.when(line.contains(fixed.STATE_TEXT), strip_line(state))


def names_state(line: Column):
    """Whether this is a status line; one without a state is malformed."""
    return F.coalesce(line.contains(fixed.STATE_TEXT), F.lit(False))


def has_cjk(line: Column):
    return line.rlike(fixed.CJK_MARK)


def cjk_text(line: Column):
    """From the first Chinese character to the end of the line; NULL where there is none."""
    return F.when(has_cjk(line), F.regexp_extract(line, fixed.CJK_TEXT, 0))


def cjk_texts(log: Column):
    """All such texts of a whole pod log given as bytes, NULL where it is not UTF-8."""
    return F.regexp_extract_all(F.try_validate_utf8(log), F.lit(fixed.CJK_TEXT), F.lit(0))
