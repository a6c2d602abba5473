"""Rating submissions as a stream."""

from marquee.streaming.submissions import current_ratings, rating_log, submissions
from marquee.streaming.upsert import RatingTable, keep_current, late_rows, unique

__all__ = [
    "RatingTable",
    "current_ratings",
    "keep_current",
    "late_rows",
    "rating_log",
    "submissions",
    "unique",
]
