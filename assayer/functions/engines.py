"""Engine names as labels spell them."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Engine id and the name a label contains.
ENGINES = {"heygen": "HeyGen", "omni": "Omni Flash", "wan3": "Wan 3.0", "seedance2": "Seedance 2.0"}


def engine_id(label: Column) -> Column:
    """Engine a label names, NULL for an unknown one, which is an error to look at and not a default."""
    out: Column | None = None
    for eid, name in ENGINES.items():
        hit = label.contains(name)
        out = F.when(hit, eid) if out is None else out.when(hit, eid)
    return out
