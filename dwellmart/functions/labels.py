"""Display text for headline figures.

``format_number`` rounds half to even on the exact binary value, which is also what the display
contract asks for (2.25 reads ``+2.2``); ``format_string`` would round half up.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shown where a series has no earlier row.
FIRST_YEAR_LABEL = "first year on record"


def euro_label(amount: Column) -> Column:
    """Whole euro with thousands separators, such as ``€312,500``."""
    return F.concat(F.lit("€"), F.format_number(amount, 0))


def change_label(percent: Column) -> Column:
    """Signed percentage with one decimal, such as ``+4.2% YoY``."""
    digits = F.translate(F.format_number(percent, 1), ",", "")
    signed = F.when(digits.startswith("-"), digits).otherwise(F.concat(F.lit("+"), digits))
    return F.when(percent.isNull(), F.lit(FIRST_YEAR_LABEL)).otherwise(F.concat(signed, F.lit("% YoY")))
