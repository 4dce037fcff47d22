"""Job parameters of the reporting marts."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from ..functions import dates


@dataclass(frozen=True)
class ReportParams:
    """``as_of`` is the run date (the reference's CURRENT_DATE).  The window
    rule's cut-off and floor are parameters because the reference's own
    constants only make sense for its warehouse's dates."""

    as_of: _dt.date
    cutoff: _dt.date = dates.CUTOFF_DATE
    refunds_cutoff: _dt.date = dates.REFUNDS_CUTOFF_DATE
    floor: _dt.date = dates.FLOOR_DATE
    tenant: str = "ie"
    contact_country: str = "IE"
    max_reorder_gap_days: int = 60
    reorder_depth: int = 4

    def window(self):
        return dates.date_window(F.lit(self.as_of), self.cutoff, self.floor)

    def refunds_window(self):
        return dates.date_window(F.lit(self.as_of), self.refunds_cutoff, self.floor)


# The driver's tables hold orders from 1995-01-01 to 2001-08-01.  With the run
# date the day after, these values keep the reference's rule shape (the refunds
# cut-off sits 153 days after the others, as in the reference) and select the
# whole history, so every mart runs over whole tables.
FIXTURE_PARAMS = ReportParams(
    as_of=_dt.date(2001, 8, 2),
    cutoff=_dt.date(2000, 12, 31),
    refunds_cutoff=_dt.date(2001, 6, 2),
    floor=_dt.date(1995, 1, 1),
)
