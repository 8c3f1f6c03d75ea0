"""Parameters of the registered queries over the test tables.

The test data covers 2024-01-01 .. 2024-01-30 at every scale and has about a thousandth of the
production volume, so the cap trigger and per-hour cap are scaled down with it; every other value
is the production one. Nothing here filters rows away to make a check cheaper.
"""

import datetime as _dt

from ..constants import REGION_ORDER

AS_OF = _dt.date(2024, 1, 18)              # run day
DAYS_BACK = 3                               # CH01 lag from the check dictionary -> 2024-01-15
TARGET_DAY = AS_OF - _dt.timedelta(days=DAYS_BACK)
CHECK_LAGS = {"CH01": 3, "CH02": 2, "Cp06": 3}

# caps scaled to the test volume (production: 1,000,000 / 10,000 / 1,000,000)
CAP_TRIGGER = 50
CAP_PER_HOUR = 5
CAP_TOTAL = 1_000_000
CAP_PER_SUBSCRIBER = 2                      # an hour (production: 10,000)
CAP_TOTAL_TIGHT = 60                        # a total cap that does cut, to exercise it

# completeness control on the tables: run day, expected grid, eligible rows, thresholds
CONTROL_AS_OF = TARGET_DAY
CONTROL_REGIONS = list(REGION_ORDER)
CONTROL_CHECKS = ["CH01", "CH02", "Cp06"]
CONTROL_MAX_ROWS = 1
CONTROL_NOT_EMPTY_CHECKED = ["CH02"]
CONTROL_CHECKED_AT = _dt.datetime(2024, 1, 15, 5, 0)   # the daily control runs at 05:00

PIVOT_METRICS = ["firstStream", "secondStream", "firstDlt", "dsc", "2pass"]
# the days present in the test tables; the oracle lists them, the Spark side reads them from data
PIVOT_DAYS = [_dt.date(2024, 1, 1) + _dt.timedelta(days=i) for i in range(30)]

LAG_STH = 5                                 # southern lag of the query that tells the two lags apart

JOBLOG_USER = "airflow"

# the landed-file check over files that the pages table gives
LANDED_REGIONS = ["MSK", "CNT", "NWE", "VLG", "FEA"]
LANDED_CHANNELS = ["CH01", "CH02", "CH03", "CH04", "CH05"]
LANDED_NOT_EMPTY_CHECKED = ["CH05"]

# the membership bitmap of the candidates query: 2 ** 24 positions are 2 MB
BITMAP_BITS = 24

# buckets of the match tables (production: a day's rows at about 200 MB a bucket)
MATCH_BUCKETS = 8
