from rankfold.streaming.item_stats import (  # noqa: F401
    item_deltas, item_sums, live_popular, live_ratings, live_stats, rating_stream, run)
