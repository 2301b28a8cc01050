"""Column expressions that parse the programme's text fields.

All are built-in Spark expressions (regexp, split, higher-order functions),
so they run inside whole-stage code generation; no Python touches a row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkspark.constants import EVENT_COMPLETED, EVENT_RECEIVED, EVENT_TRANSACTION, EVENT_VIEWED

# --- fixed values: patterns of the printed ``value`` dictionaries ------------
OFFER_ID_SPACE_PATTERN = r"'offer id': '([^']+)'"  # received / viewed events
OFFER_ID_UNDERSCORE_PATTERN = r"'offer_id': '([^']+)'"  # completed events
# Tolerant patterns: either quote, optional blanks around the colon.
AMOUNT_PATTERN = r"""['"]amount['"]\s*:\s*([0-9.]+)"""
REWARD_PATTERN = r"""['"]reward['"]\s*:\s*([0-9.]+)"""
# Strict patterns (double quotes only), kept for bit-for-bit comparison runs.
AMOUNT_PATTERN_STRICT = r'"amount": ([0-9.]+)'
REWARD_PATTERN_STRICT = r'"reward": ([0-9.]+)'
# Brackets and quotes around the printed channel list; separator after them.
CHANNEL_STRIP_PATTERN = r"""[\[\]'"]"""
CHANNEL_SPLIT_PATTERN = r",\s*"


def channels_array(text: Column | str) -> Column:
    """``"['web', 'email']"`` -> ``["web", "email"]``.

    Works for single or double quotes and with or without a blank after the
    comma.  ``''`` and ``'[]'`` hold one empty name, so that an offer without
    channels stays in the completion metrics; the channel ranking drops empty
    names itself.  Null stays null.
    """
    stripped = F.regexp_replace(text, CHANNEL_STRIP_PATTERN, "")
    return F.transform(F.split(stripped, CHANNEL_SPLIT_PATTERN), F.trim)


def offer_id_text(event: Column, value: Column) -> Column:
    """Captured offer id text ('' when the pattern does not match, null for
    events that carry no offer).  One regex evaluation per row."""
    return F.when(event.isin(EVENT_RECEIVED, EVENT_VIEWED), F.regexp_extract(value, OFFER_ID_SPACE_PATTERN, 1)).when(
        event == EVENT_COMPLETED, F.regexp_extract(value, OFFER_ID_UNDERSCORE_PATTERN, 1)
    )


def amount_text(event: Column, value: Column, strict_quotes: bool = False) -> Column:
    pattern = AMOUNT_PATTERN_STRICT if strict_quotes else AMOUNT_PATTERN
    return F.when(event == EVENT_TRANSACTION, F.regexp_extract(value, pattern, 1))


def reward_text(event: Column, value: Column, strict_quotes: bool = False) -> Column:
    pattern = REWARD_PATTERN_STRICT if strict_quotes else REWARD_PATTERN
    return F.when(event == EVENT_COMPLETED, F.regexp_extract(value, pattern, 1))


def non_empty(text: Column | str) -> Column:
    return F.nullif(F.col(text) if isinstance(text, str) else text, F.lit(""))


def number_or_null(text: Column | str) -> Column:
    """Captured number text as double; '' or a non-number such as '1.2.3' -> null."""
    return non_empty(text).try_cast("double")
