"""Column-level helpers: each takes and returns ``pyspark.sql.Column``."""

from sparkops.functions.dates import (  # noqa: F401
    DEFAULT_DATE_FORMATS, RU_WEEKDAYS, iso_date_text, month_of, parse_date_any,
    weekday_name, whole_years,
)
from sparkops.functions.numeric import avg_null_zero, int_avg  # noqa: F401
from sparkops.functions.text import (  # noqa: F401
    clean_text, flag, leading_int, prefix_any, words,
)
