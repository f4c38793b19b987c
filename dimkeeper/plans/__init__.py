"""How the operators place their data: measured broadcasts and distributed numbering."""

from dimkeeper.plans.batch import BatchProfile, broadcast_limit, profile_batch, stage_measured
from dimkeeper.plans.filter import may_match
from dimkeeper.plans.heavy import heavy_keys
from dimkeeper.plans.lookup import matched_keys, without_match
from dimkeeper.plans.numbering import number_rows

__all__ = [
    "BatchProfile",
    "broadcast_limit",
    "heavy_keys",
    "matched_keys",
    "may_match",
    "number_rows",
    "profile_batch",
    "stage_measured",
    "without_match",
]
