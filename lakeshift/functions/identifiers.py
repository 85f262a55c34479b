"""Identifier normalisation (national id numbers typed by humans)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: accepted characters, separators and id patterns ----------
# Text that, after trimming spaces, consists only of digits, dashes and
# whitespace is an identifier; the dashes and whitespace are separators.
IDENTIFIER_CHARS = r"^[0-9\-\s]+$"
IDENTIFIER_SEPARATORS = r"[\-\s]"
# Valid SSN structure: 9 digits, area not 000 / 666 / 9xx, group not 00,
# serial not 0000.
SSN_STRUCTURE = r"^(?!000|666|9[0-9][0-9])[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$"
# ITIN: area 9xx with group 70-89, 90-92 or 94-99.
ITIN_PATTERN = r"^9[0-9]{2}(7[0-9]|8[0-9]|9[0-2]|9[4-9])[0-9]{4}$"
# -----------------------------------------------------------------------------


def normalized_identifier(c: Column | str) -> Column:
    """Digits of a typed identifier, or NULL.

    * NULL, empty or spaces-only text -> NULL;
    * text made only of digits / dashes / whitespace -> the digits (may be the
      empty string, e.g. ``---`` or a lone tab: ``trim`` strips spaces only);
    * anything else (letters, punctuation) -> NULL.

    The empty-text case needs no branch of its own: the ``+`` of the accepted
    character class does not match an empty string.
    """
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when(text.rlike(IDENTIFIER_CHARS), F.regexp_replace(text, IDENTIFIER_SEPARATORS, ""))
