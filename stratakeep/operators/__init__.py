from stratakeep.operators.business import cart_adds_and_drops, explode_emails, primary_email, primary_email_legacy
from stratakeep.operators.hub import hub_rows
from stratakeep.operators.link import link_rows
from stratakeep.operators.matching import rows_of_batch_keys
from stratakeep.operators.ordered import (
    Cuts,
    find_cuts,
    join_one_per_key,
    latest_per_key,
    next_values,
    previous_values,
    running_max,
)
from stratakeep.operators.pit import pit_rows
from stratakeep.operators.satellite import (
    batch_delta,
    event_delta,
    link_satellite_rows,
    satellite_rows,
    sequenced_delta,
)

__all__ = [
    "Cuts",
    "batch_delta",
    "cart_adds_and_drops",
    "event_delta",
    "explode_emails",
    "find_cuts",
    "hub_rows",
    "join_one_per_key",
    "latest_per_key",
    "link_rows",
    "link_satellite_rows",
    "next_values",
    "pit_rows",
    "previous_values",
    "primary_email",
    "primary_email_legacy",
    "rows_of_batch_keys",
    "running_max",
    "satellite_rows",
    "sequenced_delta",
]
