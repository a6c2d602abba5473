"""Source and catalogue schemas, so that no reader has to infer one."""

from __future__ import annotations

TITLE_BASICS = (
    "tconst string, titleType string, primaryTitle string, originalTitle string, "
    "isAdult string, startYear string, endYear string, runtimeMinutes string, genres string"
)
TITLE_CREW = "tconst string, directors string, writers string"
TITLE_RATINGS = "tconst string, averageRating string, numVotes string"
TITLE_PRINCIPALS = (
    "tconst string, ordering int, nconst string, category string, job string, characters string"
)
TITLE_EPISODE = "tconst string, parentTconst string, seasonNumber string, episodeNumber string"
NAME_BASICS = (
    "nconst string, primaryName string, birthYear string, deathYear string, "
    "primaryProfession string, knownForTitles string"
)
TITLE_AKAS = (
    "titleId string, ordering int, title string, region string, language string, "
    "types string, attributes string, isOriginalTitle string"
)
TMDB = (
    "id bigint, title string, vote_average double, vote_count bigint, status string, "
    "release_date string, revenue string, runtime bigint, adult string, backdrop_path string, "
    "budget string, homepage string, imdb_id string, original_language string, "
    "original_title string, overview string, popularity double, poster_path string, "
    "tagline string, genres string, production_companies_name string, "
    "production_companies_country string, production_countries string, "
    "spoken_languages string, video string"
)
ML_RATINGS = "userId int, movieId int, rating double, timestamp bigint"
ML_LINKS = "movieId int, imdbId string, tmdbId bigint"
ML_MOVIES = "movieId int, title string, genres string"
ML_TAGS = "userId int, movieId int, tag string, timestamp bigint"
SEED_ITEMS = "tmdb_id int, imdb_id string, title string, poster_path string"
USERS = (
    "username string, password string, name string, email string, role string, "
    "genres_pref string, doc_genres_pref string"
)
SUBMISSIONS = (
    "username string, action string, ratings map<string,int>, movie_id string, ts timestamp"
)
FILM_DETAILS = (
    "id bigint, title string, release_date string, runtime int, overview string, "
    "poster_path string, genres array<struct<name:string>>"
)
FILM_CREDITS = (
    "id bigint, crew array<struct<job:string,name:string>>, `cast` array<struct<name:string>>"
)

# The 20 catalogue columns in their order, with the type of each.
CATALOG = {
    "tconst": "string",
    "id": "bigint",
    "primaryTitle": "string",
    "originalTitle": "string",
    "genres": "array<string>",
    "startYear": "int",
    "runtimeMinutes": "int",
    "averageRating": "double",
    "numVotes": "bigint",
    "popularity": "double",
    "actor_actress": "array<string>",
    "producer": "array<string>",
    "writers": "array<string>",
    "directors": "array<string>",
    "production_companies_name": "array<string>",
    "budget": "bigint",
    "revenue": "bigint",
    "original_language": "string",
    "overview": "string",
    "poster_path": "string",
}
LIST_COLUMNS = tuple(name for name, kind in CATALOG.items() if kind.startswith("array"))
