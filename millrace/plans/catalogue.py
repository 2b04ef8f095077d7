"""All queries of the core."""

from . import cleaning, control, flow, streams, textual

_PARTS = (cleaning, textual, flow, control, streams)
QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
SQL = {k: v for part in _PARTS for k, v in part.SQL.items()}
