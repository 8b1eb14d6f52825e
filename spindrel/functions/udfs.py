"""Arrow functions over columns that are built when they are used: modules that define them import without a session, on workers too."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F


def column_function(kind: str):
    """Decorator for a function of pandas Series; the result is called with columns or their names."""

    def of(function):
        @wraps(function)
        def on(*columns):
            return F.pandas_udf(function, kind)(*columns)

        on.plain = function
        return on

    return of


def plain(value):
    """Arrow's arrays, rows and maps as lists and dicts."""
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    if hasattr(value, "tolist") and not isinstance(value, (str, bytes)):
        value = value.tolist()
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else value
