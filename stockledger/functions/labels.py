"""Code-to-label maps."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels the reports must show for the source system's codes.
COMMITMENT_LEVEL = {1: "Fixed order", 2: "Manufacturing", 3: "Buy material", 4: "Forecast"}

ORDER_STATUS = {
    0: "Not initialized",
    1: "Registered",
    2: "Printed",
    3: "Delivery time cannot be confirmed",
    4: "Picking in progress",
    5: "Partial delivery made",
    9: "Final delivery made",
}

MANUFACTURING_STATUS = {
    1: "Registered",
    2: "Printed",
    3: "Started",
    4: "Finished",
    5: "Post-calculated",
    6: "Delivered",
    9: "Historical",
}

SCHEDULE_STATUS = {
    0: "0 - New",
    1: "1 - Activated",
    3: "3 - Reconciled",
    5: "5 - Transferred",
    9: "9 - Replaced",
}

TRANSACTION_TYPE = {
    1: "Arrivals",
    2: "Reporting manufacturing order as finished",
    3: "Delivery",
    4: "Stock count",
    5: "Direct withdrawal",
    6: "Move between warehouses",
    7: "Move between locations",
    8: "Case/Posterior injection",
    9: "Register invoice directly",
    10: "Location deleted",
    11: "Material withdrawal for manufacturing order",
    12: "Direct arrival",
    13: "Balance import",
    14: "Delivery (stock order)",
    15: "Arrival (stock order)",
    16: "Undone reporting - material",
    17: "Undone reporting - finished part",
    18: "Undone arrival",
    19: "Undone delivery",
    20: "Undone arrival - stock order",
    21: "Undone delivery - stock order",
    22: "Withdrawal (tools)",
    23: "Return (tools)",
    24: "Undone withdrawal (tools)",
    25: "Undone return (tools)",
    26: "Direct withdrawal (tools)",
    27: "Direct return",
    28: "Credit supplier invoice",
    29: "Credit customer invoice",
    30: "Return order",
}


def code_label(code: Column, labels: dict[int, str], default: str | None = None) -> Column:
    """Label of a code; ``default`` (or NULL) for codes the map does not have."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    label = F.element_at(table, code)
    return label if default is None else F.coalesce(label, F.lit(default))
