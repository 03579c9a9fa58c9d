from quarterfold.functions.dates import (
    add_days, age_years, ceil_day, ddiff, ddiff_or, day, elapsed_years,
    in_period, not_after_midnight, period_label, quarter_index, quarter_start,
    same_day, up_to,
)
from quarterfold.functions.text import ci, ci_equals, ci_in, ci_prefix, row_uuid, title_case
from quarterfold.functions.predicates import (
    any_of, band, case_pred, eq_default, is_set, none_of, not_any3, not_voided,
)

__all__ = [
    "add_days", "age_years", "any_of", "band", "case_pred", "ceil_day", "ci", "ci_equals",
    "ci_in", "ci_prefix", "day", "ddiff", "ddiff_or", "elapsed_years", "eq_default",
    "in_period", "is_set", "none_of", "not_after_midnight", "not_any3", "not_voided",
    "period_label", "quarter_index", "quarter_start", "row_uuid", "same_day", "title_case",
    "up_to",
]
