"""Readers."""

from hearthline.sources.wide_csv import (
    project_cast,
    read_listings,
    read_reviews,
    read_wide_csv,
    spread_rows,
)

__all__ = ["project_cast", "read_listings", "read_reviews", "read_wide_csv", "spread_rows"]
