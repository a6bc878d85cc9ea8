"""Fixed values that must equal the reference for equal results.

Fixed values (model and serving constants of the reference):
  rank 20, iterations 20, lambda 0.1 (multiplied by the rating count of the
  entity being solved), bias shrinkage 10, predictions clipped to [0.5, 5.0],
  ratings accepted in [0.5, 5.0], holdout 10 percent, cosine denominator
  epsilon 1e-9, personalised list 10 items, similar list 5 items,
  popularity list 10 items, catalogue page size 20.
"""

RANK = 20
ITERATIONS = 20
REG = 0.1
BIAS_REG = 10.0
CLIP_LO = 0.5
CLIP_HI = 5.0
RATING_MIN = 0.5
RATING_MAX = 5.0
HOLDOUT_FRACTION = 0.1
COSINE_EPS = 1e-9
TOP_N = 10
SIMILAR_N = 5
POPULAR_N = 10
PAGE_SIZE = 20

# Source priority in a merge: a later source wins a (user, item) tie.
PRIORITY_BASE = 0
PRIORITY_FEEDBACK = 1
PRIORITY_STREAM = 2

# Largest number of rating rows handed to one pandas group in a least-squares
# half step; entities with more ratings are split into salted sub-groups whose
# partial normal equations are summed before the solve.
MAX_ROWS_PER_SOLVE_GROUP = 200_000

# Buckets of pairs in the state of the live ratings: what a micro-batch reads and writes of it
# are the buckets of its events.  Fixed for the life of a checkpoint.
LIVE_BUCKETS = 1 << 16

# Partitions of a store of ratings by a hash of the item.
STORE_BUCKETS = 64

# Longest list of ratings in one row of the interaction lists.
LIST_ROWS = 32

# Added to the diagonal of a singular system that has no regularisation.
SINGULAR_REG = 0.01

# Ratings in a block of the routing tables, which is what one task of a routed half step
# holds, and rows whose normal equations it forms at once.
ROUTING_BLOCK_ROWS = 5_000_000
ROUTING_STEP_ROWS = 10_000

# Packed blocks of ratings of the exact fit, of which a task of a half step holds one: how many
# there are at least, most ratings in one, and about how many bytes of factors one may want.
FIT_BLOCKS = 16
FIT_BLOCK_ROWS = 4_000_000
FIT_BLOCK_BYTES = 128 * 1024 * 1024

# Ratings in a block of MLlib's ALS, of which there are 10 at least: a factor travels once per
# block in which it has ratings.
MLLIB_BLOCK_ROWS = 4_000_000

# Queries and items that are scored against each other at once.
QUERY_BLOCK = 4096
ITEM_BLOCK = 4096

# Largest part of the item factors, in bytes, that is broadcast to score users by.
ITEM_PART_BYTES = 128 * 1024 * 1024

# Nearest neighbours: most pivots, and rows that a pivot's cell should have.
MAX_PIVOTS = 1024
CELL_ROWS = 1024

# Bytes of vectors in a group of cells; a task holds two to four of them.
GROUP_BYTES = 32 * 1024 * 1024

# Upper bound, in bytes, of both factor tables for broadcasting the fixed one in a
# least-squares half step; above it factors are routed to blocks of ratings.  A broadcast
# passes through the driver, which holds it some three times over.
MAX_FACTOR_BROADCAST_BYTES = 64 * 1024 * 1024

# Score rounding used for ranking, so that mathematically equal scores tie in
# every engine; ties are then broken on the lower item id.
RANK_DECIMALS = 9
