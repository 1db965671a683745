"""Column expressions: no function here reads or moves rows."""

from lakeops.functions.change import any_changed, key_condition
from lakeops.functions.json_text import expand_json, key_value_messages
from lakeops.functions.text import joined_texts, tag_array
from lakeops.functions.time import (
    after_watermark,
    epoch_between,
    epoch_to_timestamp,
    month_start,
)

__all__ = [
    "after_watermark",
    "any_changed",
    "epoch_between",
    "epoch_to_timestamp",
    "expand_json",
    "joined_texts",
    "key_condition",
    "key_value_messages",
    "month_start",
    "tag_array",
]
