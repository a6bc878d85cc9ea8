from rankfold.plans.catalog import QUERIES, flagship  # noqa: F401
from rankfold.plans.oracle import oracle_sql  # noqa: F401
