"""Text normalisation as chains of built-in regex expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour).
#
# Transaction-side clean text: every character outside [a-zA-Z0-9 ] becomes a
# space, then lower case; no trim, no whitespace collapse.
CLEAN_DESCRIPTION_PATTERN = "[^a-zA-Z0-9 ]"

# Merchant-side clean text: ten substitutions applied in this order, each by a
# single space, then strip and lower case. Only the first two ignore case.
PROVINCE_CODES = "AB|BC|MB|NB|NL|NS|NT|NU|ON|PE|QC|SK|YT"
MERCHANT_CLEAN_STEPS: list[tuple[str, bool]] = [
    (r"\bUSD\s+[\d.]+@[\d.]+\b", True),                       # currency marker "USD 10@1.415"
    (r"\b(?:SQ|TST|PP|BAM)\s*\*+", True),                      # payment processor prefix
    (r"\b\d{3}[-\s]?\d{3}[-\s]?\d{4}\b", False),               # phone number
    (r"\b1[-\s]?8\d{2}[-\s]?\d{3}[-\s]?\d{4}\b", False),       # toll-free number
    (r"#\s*\d+", False),                                       # store number "#123"
    (r"\b\d{4,}\b", False),                                    # long digit run
    (r"\b[A-Z][a-zA-Z'.\- ]+?\s+(?:" + PROVINCE_CODES + r")\b", False),  # "City PROV"
    (r"\b(?:" + PROVINCE_CODES + r")\b", False),               # bare province code
    (r"[^\w&'.\- ]+", False),                                  # other punctuation
    (r"\s+", False),                                           # whitespace run
]
# ---------------------------------------------------------------------------


_ASCII = [chr(i) for i in range(128)]
_ASCII_CHANGED = "".join(c for c in _ASCII if not (c.islower() or c.isdigit() or c == " "))
_ASCII_CLEAN = "".join(c.lower() if c.isalpha() else " " for c in _ASCII_CHANGED)


def clean_description(raw: Column) -> Column:
    """lower(regexp_replace(raw, '[^a-zA-Z0-9 ]', ' ')); NULL stays NULL. A text of ASCII alone needs no pattern, which
    costs several times as much."""
    return F.when(F.octet_length(raw) == F.length(raw), F.translate(raw, _ASCII_CHANGED, _ASCII_CLEAN)).otherwise(
        F.lower(F.regexp_replace(raw, CLEAN_DESCRIPTION_PATTERN, " ")))


def merchant_clean(raw: Column) -> Column:
    """Merchant canonical name of a raw description.

    Java regexes get ``(?U)`` so that ``\\w``, ``\\d``, ``\\s`` and ``\\b``
    are Unicode-aware like Python's; case-insensitive steps add ``(?i)``.
    """
    s = raw
    for pattern, ignore_case in MERCHANT_CLEAN_STEPS:
        flags = "(?U)(?i)" if ignore_case else "(?U)"
        s = F.regexp_replace(s, flags + pattern, " ")
    return F.lower(F.trim(s))


def account_last4(account: Column) -> Column:
    """Digits only; the last four when there are at least four, else ''."""
    digits = F.regexp_replace(account, r"(?U)[^\d]", "")
    return F.when(F.length(digits) >= 4, F.substring(digits, -4, 4)).otherwise(F.lit(""))
