"""Readers."""

from filmlake.sources.files import FILM_FILES, SOURCES, list_files, read_films, read_genres
from filmlake.sources.tables import list_views, local_rows, read_jdbc, read_table

__all__ = [
    "FILM_FILES",
    "SOURCES",
    "list_files",
    "list_views",
    "local_rows",
    "read_films",
    "read_genres",
    "read_jdbc",
    "read_table",
]
