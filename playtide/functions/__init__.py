"""Column expressions; every one is built from Spark's own functions."""

from playtide.functions.scalar import *  # noqa: F401,F403
from playtide.functions.stats import *  # noqa: F401,F403
