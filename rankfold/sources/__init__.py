from rankfold.sources.readers import (  # noqa: F401
    read_movies, read_ratings)
