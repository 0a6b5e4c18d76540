"""Named queries (``catalog.QUERIES``) and their oracle SQL (``catalog.ORACLE``)."""

# The catalogue imports the query modules in order, whichever is asked for first.
from titlepulse.plans import catalog  # noqa: E402,F401
