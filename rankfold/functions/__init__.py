from rankfold.functions.vectors import (  # noqa: F401
    clip_rating, dot, norm, split_bucket)
