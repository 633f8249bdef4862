"""Quality measures of a text and the first rule that rejects it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a link and which phrases count as navigation.
URL = r"(?i)https?://[^\s]{15,}|www\.[^\s]{10,}"
NAVIGATION = (
    "(?i)(click here|skip to|jump to|back to top|read more|next page|previous page"
    "|menu|navigation|breadcrumb|cookie policy|privacy policy)"
)
#: Characters trimmed from both ends before a text is judged.
EDGES = r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$"


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the rules; 0 turns off the last four but the letter ratio."""

    least_chars: int = 200
    most_chars: int = 0
    least_alpha: float = 0.40
    most_repeat: float = 0.30
    most_url: float = 0.10
    most_navigation: int = 5


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, EDGES, "")


def _matched(text: Column, pattern: str) -> Column:
    return F.aggregate(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x))


def alpha_ratio(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", "")) / F.greatest(F.lit(1), F.length(text))


def adjacent_repeat_ratio(text: Column) -> Column:
    """Share of characters equal to the one before; runs are found by one regular expression."""
    runs = F.aggregate(F.regexp_extract_all(text, F.lit(r"(?s)(.)\1+"), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x) - 1)
    return F.when(F.length(text) > 1, runs / (F.length(text) - 1)).otherwise(F.lit(0.0))


def url_ratio(text: Column) -> Column:
    return _matched(text, URL) / F.greatest(F.lit(1), F.length(text))


def navigation_hits(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(NAVIGATION), F.lit(0)))


def reject_reason(raw: Column, rules: QualityRules = QualityRules()) -> Column:
    """The first failing rule, or null; cheap rules come first and CASE keeps their order."""
    text = stripped(raw)
    n = F.length(text)
    case = F.when(F.coalesce(F.length(raw), F.lit(0)) == 0, "empty").when(n < rules.least_chars, "too_short")
    if rules.most_chars > 0:
        case = case.when(n > rules.most_chars, "too_long")
    case = case.when(alpha_ratio(text) < rules.least_alpha, "low_alpha_ratio")
    if rules.most_repeat > 0:
        case = case.when(adjacent_repeat_ratio(text) > rules.most_repeat, "high_repeat_ratio")
    if rules.most_url > 0:
        case = case.when(url_ratio(text) > rules.most_url, "high_url_density")
    if rules.most_navigation > 0:
        case = case.when(navigation_hits(text) > rules.most_navigation, "navigation_boilerplate")
    return case
