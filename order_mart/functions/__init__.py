from .status import is_not_status_keep_null, is_status, is_status_exact, normalized_status
from .temporal import as_of_date, date_sequence, ntz_literal, plus_seconds, seconds_between, whole_seconds_between
from .text import join_words, with_unit

__all__ = [
    "is_not_status_keep_null", "is_status", "is_status_exact", "normalized_status",
    "as_of_date", "date_sequence", "ntz_literal", "plus_seconds", "seconds_between",
    "whole_seconds_between", "join_words", "with_unit",
]
