"""Ticket tables: building, listing, filtering, display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.functions import text as X


def build_tickets(df: DataFrame) -> DataFrame:
    """The nine ticket columns, with ``ticket_text`` put together."""
    body = F.concat(F.lit("Subject: "), "subject", F.lit("\n\nDescription: "), "description")
    known = set(df.columns)
    columns = []
    for field in schemas.TICKETS:
        if field.name == "ticket_text":
            source = body
        elif field.name in known:
            source = F.col(field.name)
        else:
            source = F.lit(None)
        columns.append(source.cast(field.dataType).alias(field.name))
    return df.select(columns)


def read_ticket_lines(df: DataFrame, col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One ticket per non-blank line of ``col``."""
    return (
        df.select(*keep, F.posexplode(F.split(col, "\n")).alias("line_no", "line"))
        .withColumn("ticket_text", X.strip(F.col("line")))
        .filter(F.length("ticket_text") > 0)
        .drop("line")
    )


def ticket_listing(
    df: DataFrame, cols: Sequence[str], order: Sequence[str | Column], limit: int | None = None
) -> DataFrame:
    """Projected listing in key order; with a limit this is a distributed top-n."""
    out = df.select(*cols).orderBy(*order)
    return out if limit is None else out.limit(limit)


def ticket_by_id(df: DataFrame, ticket_id: str, key: str = "ticket_id") -> DataFrame:
    return df.filter(F.col(key) == ticket_id)


def drop_blank_tickets(df: DataFrame, col: str = "ticket_text") -> DataFrame:
    return df.filter(~X.is_blank(F.col(col)))


def add_previews(df: DataFrame, col: str = "ticket_text") -> DataFrame:
    """The six shortened forms used on screens, exports and prompts."""
    c = F.col(col)
    return df.withColumns({
        "preview_100": X.preview(c, 100, "always"),
        "preview_80": X.preview(c, 80),
        "preview_60": X.preview(c, 60),
        "preview_200": X.preview(c, 200),
        "preview_500": X.preview(c, 500, "never"),
        "preview_1000": X.preview(c, 1000, "never"),
    })


def display_text(col: Column, missing: str = "Unknown") -> Column:
    return F.coalesce(col.cast("string"), F.lit(missing))


def display_number(col: Column) -> Column:
    """Two decimals; empty is 0.00; what is not a number is shown as it is."""
    text = col.cast("string")
    value = text.try_cast("double")
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "0.00")
        .when(value.isNull(), text)
        .otherwise(F.format_string("%.2f", value))
    )


def display_values(df: DataFrame, text_cols: dict[str, str], number_cols: Sequence[str]) -> DataFrame:
    """Show text columns with their missing word and number columns as text."""
    shown = {c: display_text(F.col(c), missing) for c, missing in text_cols.items()}
    shown |= {c: display_number(F.col(c)) for c in number_cols}
    return df.withColumns(shown)
