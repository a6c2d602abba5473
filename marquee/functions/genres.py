"""English and French genre labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Film genres and their French labels.
FILM_GENRES = {
    "Action": "Action",
    "Adult": "Adulte",
    "Adventure": "Aventure",
    "Animation": "Animation",
    "Biography": "Biographie",
    "Comedy": "Comédie",
    "Crime": "Crime",
    "Documentary": "Documentaire",
    "Drama": "Drame",
    "Family": "Famille",
    "Fantasy": "Fantastique",
    "History": "Histoire",
    "Horror": "Horreur",
    "Music": "Musique",
    "Musical": "Comédie musicale",
    "Mystery": "Mystère",
    "News": "Actualités",
    "Romance": "Romance",
    "Sci-Fi": "Science-fiction",
    "Sport": "Sport",
    "Thriller": "Thriller",
    "War": "Guerre",
    "Western": "Western",
}

# Documentary themes have no Western, and Documentary itself is "other".
DOCUMENTARY_GENRES = {
    **{name: label for name, label in FILM_GENRES.items() if name != "Western"},
    "Documentary": "Autres",
}

GENRES = {"film": FILM_GENRES, "documentary": DOCUMENTARY_GENRES}


def _lookup(table: dict[str, str], col: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, col)


def translate_genre(col: Column, kind: str = "film") -> Column:
    """French label of an English genre, null when it has none."""
    return _lookup(GENRES[kind], col)


def genre_from_label(col: Column, kind: str = "film") -> Column:
    """English genre of a French label; the first one where labels repeat."""
    inverse: dict[str, str] = {}
    for name, label in GENRES[kind].items():
        inverse.setdefault(label, name)
    return _lookup(inverse, col)
