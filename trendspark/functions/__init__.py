"""Column expressions without state."""

from trendspark.functions.columns import (
    columns_of_type,
    half_even,
    literal_array,
    numeric_columns,
    relative_change,
    row_mean,
    same_code,
    text_columns,
    weighted_total,
    zip_text,
)

__all__ = [
    "columns_of_type",
    "half_even",
    "literal_array",
    "numeric_columns",
    "relative_change",
    "row_mean",
    "same_code",
    "text_columns",
    "weighted_total",
    "zip_text",
]
