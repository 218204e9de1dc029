"""Names of the dated folders, and the CSV dialect that readers and writers share."""

from __future__ import annotations

from datetime import date

RUN_DATE = "run_date"
SCORE_DAY = "score_date"

# Quotes are doubled inside quoted text and blanks are kept. The mark of NULL is a control character,
# so no ordinary text is taken for NULL, empty text (written "") differs from it, and a NULL alone on
# its line is not lost as a blank line. An unquoted empty field from elsewhere is NULL too. Text that is
# that character alone comes back as NULL.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\u007f",
}


def in_partition(base: str, name: str, day: date) -> str:
    return f"{base.rstrip('/')}/{name}={day.isoformat()}"
