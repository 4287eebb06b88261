"""Named queries over the driver tables, each with its SQL twin where SQL can express it."""

from evalspark.plans import (  # noqa: F401  (importing registers the queries)
    checks,
    expressions,
    fits,
    identity,
    metrics,
    pairs,
    ranks,
    storage,
)
from evalspark.plans.registry import QUERIES, SQL  # noqa: F401
