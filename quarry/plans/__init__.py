"""Jobs and query keys.  The registry comes first: query modules register
themselves with it and import one another."""

from quarry.plans import catalog  # noqa: F401
