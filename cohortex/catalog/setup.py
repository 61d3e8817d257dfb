"""Windows and options used when the queries run on the benchmark tables.

The ``events`` table spans 2024-01-01..2024-01-30 at every scale, so the run date is
2024-01-30 with a 30-day training and a 15-day classification span. The order sessions
(fixture B) span 1995..2001; their window is the two years 1997-1998.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from cohortex.config import AudienceConfig
from cohortex.functions.rules import FIXTURE_CONVERSION, FIXTURE_RULES

AS_OF = dt.date(2024, 1, 30)
FIXTURE = AudienceConfig(
    name="fixture_audience",
    as_of=AS_OF,
    training_windows_start_in_days=30,
    classification_window_start_in_days=15,
    rules=FIXTURE_RULES,
    conversion_rule=FIXTURE_CONVERSION,
    downsample_majority_class=0.25,
    seed=42,
)
_W = FIXTURE.windows()
LB_START, LB_END = _W.lookback_start, _W.lookback_end  # 20231231, 20240115
CV_START, CV_END = _W.conversion_start, _W.conversion_end  # 20240115, 20240130
# Learning runs sample fewer negatives away, so that both classes survive at every scale.
FIXTURE_RUN = replace(FIXTURE, downsample_majority_class=0.75)
B_START, B_END = "19970101", "19981231"
SEGMENT_DIVISOR = 100  # event value / 100 plays a probability for the segment check
