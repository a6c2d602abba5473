"""Column expressions: every function takes and returns a Column."""

from marquee.functions.folding import fold_text
from marquee.functions.genres import genre_from_label, translate_genre
from marquee.functions.scalars import (
    canonical_id,
    compact_tokens,
    concat_lists,
    duration_bucket,
    full_name,
    image_url,
    is_wanted,
    json_list,
    parse_literal_list,
    random_order,
    split_list,
    stars_to_score,
    to_long,
    truncate,
    year_text,
)

__all__ = [
    "canonical_id",
    "compact_tokens",
    "concat_lists",
    "duration_bucket",
    "fold_text",
    "full_name",
    "genre_from_label",
    "image_url",
    "is_wanted",
    "json_list",
    "parse_literal_list",
    "random_order",
    "split_list",
    "stars_to_score",
    "to_long",
    "translate_genre",
    "truncate",
    "year_text",
]
