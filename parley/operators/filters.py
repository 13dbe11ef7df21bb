"""Row predicates of the dashboards. An empty choice means no restriction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_dates(column: str, first: str, last: str | None = None) -> Column:
    """Both ends belong to the range; a single date is that day."""
    return F.col(column).between(F.lit(first).cast("date"), F.lit(last or first).cast("date"))


def one_of(column: str, choice: Sequence[str]) -> Column:
    return F.col(column).isin(*choice) if choice else F.lit(True)


def dashboard_filter(
    df: DataFrame,
    dates: Sequence[str] = (),
    campaigns: Sequence[str] = (),
    teams: Sequence[str] = (),
) -> DataFrame:
    if dates:
        df = df.where(in_dates("call_date", dates[0], dates[-1]))
    if campaigns:
        df = df.where(one_of("campaign_type", campaigns))
    if teams:
        df = df.where(one_of("team", teams))
    return df


def campaign_contains(campaign: Column, choice: Sequence[str]) -> Column:
    """Case-insensitive substring test; ``_`` and blank are the same, missing names match nothing."""
    if not choice:
        return F.lit(True)
    name = F.replace(F.lower(F.coalesce(campaign, F.lit(""))), F.lit("_"), F.lit(" "))
    hit = F.lit(False)
    for want in choice:
        hit = hit | name.contains(want.lower().replace("_", " "))
    return hit
