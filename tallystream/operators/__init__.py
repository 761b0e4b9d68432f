from tallystream.operators.biography import clean_biography, require_columns
from tallystream.operators.counts import gold_counts
from tallystream.operators.enrich import enrich_agg, enrich_join, hot_athletes, tally
from tallystream.operators.preview import preview
from tallystream.operators.sizing import BROADCAST_LIMIT, fits_broadcast, measured_bytes
from tallystream.operators.versions import latest_per_key

__all__ = [
    "BROADCAST_LIMIT",
    "clean_biography",
    "enrich_agg",
    "enrich_join",
    "fits_broadcast",
    "gold_counts",
    "hot_athletes",
    "latest_per_key",
    "measured_bytes",
    "preview",
    "require_columns",
    "tally",
]
