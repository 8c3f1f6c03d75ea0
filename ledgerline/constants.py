"""Fixed values.

These lists must equal the ones the original daily jobs use, or the pivot ordinals, the
region ordering and the volume caps stop lining up with the reports people already read.
They are stated here once, in their natural order, and imported everywhere else.
"""

# Macro-region codes in report order (rank 0 .. 7).
REGION_ORDER = ["Msk", "Cnt", "Nwe", "Vlg", "Url", "Sth", "Sib", "Fea"]

# Statistics metrics in report order; the ordinal of a metric is its
# 1-based position written with two digits ("01" .. "30").
STAT_METRICS = [
    "firstStream", "secondStream", "firstDlt", "secondDlt", "dsc",
    "2pass", "2passShoulder1", "2passShoulder2", "2passCp12Grp",
    "2passCp12", "2passCp08grp", "2passCp08detalka",
    "2passCp10DateCharge", "2passCp10DateChargeOther",
    "2passCp26GrpNaming", "2passCp26GrpOrigToNumber", "2passCp28GrpSystemId",
    "2passCp29OriginalShoulder1", "2passCp29OriginalShoulder2",
    "2passCp29GrpOrig", "2passCp33", "2passCp33report",
    "2passCp36", "2passCp36ErrReportGroup",
    "2passCp47", "2passCp47dsc", "2passCp47GrpNaming", "2passCp47GrpSystemId",
    "3pass", "3passCp10SMS",
]

# Volume caps of the first-level reconciliation.
CAP_TRIGGER_ROWS = 1_000_000   # day volume at which the caps switch on
CAP_PER_HOUR = 10_000          # rows kept per hour of day when on
CAP_TOTAL = 1_000_000          # rows kept in total when on
NO_CAP = 9_999_999_999         # "no cap" value

# Names of the two reconciliation checks and their default lags (days).
FIRST_LEVEL_CHECK = "CH01"
KEY_LEVEL_CHECK = "Cp06"
KEY_LEVEL_LAG_DAYS = 3
KEY_LEVEL_LAG_DAYS_STH = 3

# Landed-file rules.
FILE_SUFFIX = ".csv"
FILE_NAME_EXCLUDES = ["SMS", "DateTime", "DateCharge-Other"]

# Call-record output columns of the first-level result, in insert order.
FIRST_LEVEL_COLUMNS = [
    "eventDate", "MR", "cpName", "shoulder", "TariffPlanName", "RatingResult", "MSISDN", "IMSI",
    "origToNumber", "MSCID", "recType", "service", "timeKey", "dateTime", "source", "duration",
    "volume", "gmtOffset", "ratingRes", "isRoam", "dch", "inputFileName", "origTime", "udf",
    "cellid", "lac", "region", "ratingPlan", "reference", "filterGroup", "record_id", "LOADED",
    "date", "time",
]

# Call-record output columns of the key-level result, in insert order.
KEY_LEVEL_COLUMNS = [
    "eventDate", "MR", "cpName", "shoulder", "TariffPlanName", "RatingResult", "MSISDN", "IMSI",
    "origToNumber", "MSCID", "recType", "service", "timeKey", "dateTime", "source", "duration",
    "volume", "gmtOffset", "ratingRes",
]

# The four columns that identify a call between the two streams.
CALL_KEY = ["IMSI", "origToNumber", "service", "recType"]
