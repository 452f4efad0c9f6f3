"""Column expressions: predicates, scalars and nested-text parsing."""

from tillwork.functions.nested import (extract_field, extract_fields, extract_id, parse_dict,
                                       parse_list, python_literal_to_json)
from tillwork.functions.predicates import (contains_any, contains_text, is_empty, is_negative,
                                           is_one_of, is_positive, not_contains)
from tillwork.functions.scalars import (as_text, blank_to_null, calendar_parts, capture,
                                        classify_customer, epoch_ms_to_local, last_chars,
                                        local_time_text, nan_to_null, order_value, override_price,
                                        parse_time, starts_with, strip, text_between, time_of_day,
                                        to_number)

__all__ = [n for n in dir() if not n.startswith("_")]
