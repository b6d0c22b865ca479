"""Dates that stand for "today" and the cut-offs, shared by the queries and their SQL."""

DAILY_AS_OF = "2001-08-02"
DAILY_CUTOFF = "1995-01-31"
DEMANDED_AFTER = 1994
CANCELLED_AFTER = 1994
HOURLY_AS_OF = "2024-01-31"
HOURLY_CUTOFF = "2024-01-01"
