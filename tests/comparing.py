"""Results as plain rows, and plans as text, for every test module."""

from datetime import datetime
from decimal import Decimal


def rows(frame, *columns):
    """Rows as sorted tuples with times as text and money as float."""

    def plain(value):
        if isinstance(value, datetime):
            return value.strftime("%Y-%m-%d %H:%M:%S")
        return float(value) if isinstance(value, Decimal) else value

    chosen = frame.select(*columns) if columns else frame
    from pyspark.sql import functions as F

    chosen = chosen.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in chosen.dtypes
        ]
    )
    return sorted((tuple(plain(v) for v in row) for row in chosen.collect()), key=str)


def same(left, right):
    columns = left.columns
    return left.exceptAll(right.select(columns)).isEmpty() and right.select(columns).exceptAll(
        left
    ).isEmpty()


def plan(frame) -> str:
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()
