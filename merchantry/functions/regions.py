"""State code to sales region."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchantry.functions.text import col

# Fixed values.
REGION_STATES = {
    "Northeast": ["NY", "PA", "NJ", "MA", "CT", "RI", "VT", "NH", "ME"],
    "Southeast": ["FL", "GA", "SC", "NC", "VA", "WV", "KY", "TN", "AL", "MS", "AR", "LA"],
    "Midwest": ["OH", "MI", "IN", "IL", "WI", "MN", "IA", "MO", "ND", "SD", "NE", "KS"],
    "Southwest": ["TX", "OK", "NM", "AZ"],
    "West": ["CA", "NV", "UT", "CO", "WY", "MT", "ID", "WA", "OR", "AK", "HI"],
}
OTHER_REGION = "Other"


def region_of(state_code: Column | str) -> Column:
    pairs = [(code, region) for region, codes in REGION_STATES.items() for code in codes]
    lookup = F.create_map(*[F.lit(v) for v in chain.from_iterable(pairs)])
    return F.coalesce(F.try_element_at(lookup, F.coalesce(col(state_code), F.lit(""))), F.lit(OTHER_REGION))
