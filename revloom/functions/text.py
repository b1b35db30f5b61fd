"""Text clean-up, links, tags and identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats the data uses.
UUID_PATTERN = r"([A-Fa-f0-9]{8}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{12})"
RECORD_ID_LENGTH = 18
NOTES_LIMIT = 49_999
FIELD_TEXT_LIMIT = 4_990
BAD_ID_PARTS = ("'", " ", "/r2w/")


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(name: str) -> str:
    """Column name fit for a warehouse: dots and spaces to "_", then only letters, digits and "_"."""
    return re.sub(r"\W", "", re.sub(r"[. ]", "_", name))


def clean_name_text(c) -> Column:
    """`clean_name` for names held as data."""
    return F.regexp_replace(F.translate(as_col(c), ". ", "__"), r"[^\p{L}\p{N}_]", "")


def record_link(base: str, object_name: str, record_id) -> Column:
    """URL of a CRM record page."""
    return F.concat(F.lit(f"{base.rstrip('/')}/{object_name}/"), as_col(record_id), F.lit("/view"))


def hyperlink(url, label) -> Column:
    """Spreadsheet formula showing `label` and opening `url`."""
    return F.concat(F.lit('=HYPERLINK("'), as_col(url), F.lit('","'), as_col(label), F.lit('")'))


def truncate(c, limit: int, ellipsis: str = "...") -> Column:
    """At most `limit` characters, the last ones replaced by `ellipsis` when cut."""
    c = as_col(c)
    cut = F.concat(F.substring(c, 1, limit - len(ellipsis)), F.lit(ellipsis))
    return F.when(F.length(c) > limit, cut).otherwise(c)


def trim_notes(c, limit: int = NOTES_LIMIT) -> Column:
    """Notes cut to what an audit cell holds."""
    return F.substring(as_col(c), 1, limit)


def extract_or_null(c, pattern: str, group: int = 1) -> Column:
    """First match of `pattern`, NULL (not "") when there is none."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def uuid_in(c) -> Column:
    """First UUID inside free text."""
    return extract_or_null(c, UUID_PATTERN)


def is_record_id(c) -> Column:
    """True for text as long as a CRM record id."""
    return F.length(as_col(c)) == RECORD_ID_LENGTH


def is_clean_id(c) -> Column:
    """Portal id without quote, blank or legacy path. A NULL id is not clean."""
    c = as_col(c)
    ok = c.isNotNull()
    for part in BAD_ID_PARTS:
        ok = ok & ~F.contains(c, F.lit(part))
    return F.coalesce(ok, F.lit(False))


def strip_prefix(c, prefix: str) -> Column:
    """Every occurrence of the literal `prefix` removed."""
    return F.replace(as_col(c), F.lit(prefix), F.lit(""))


def add_tag(c, tag: str) -> Column:
    """Tag appended to a semicolon list, which may be NULL."""
    return F.concat_ws(";", as_col(c), F.lit(tag))


def remove_tag(c, tag: str) -> Column:
    """Tag removed as text: first ";tag", then what is left of "tag". May give "".

    A tag at the front leaves its ";" behind; `remove_tag_exact` does not.
    """
    return strip_prefix(strip_prefix(c, f";{tag}"), tag)


def remove_tag_exact(c, tag: str) -> Column:
    """Tag removed as a whole list element. "" becomes NULL."""
    return F.nullif(F.array_join(F.array_remove(F.split(as_col(c), ";"), tag), ";"), F.lit(""))


def sql_in_list(values: list[str]) -> str:
    """Quoted, comma-joined values for a short literal IN list. Use a semi join for data."""
    return ",".join("'" + v.replace("'", "''") + "'" for v in values)
