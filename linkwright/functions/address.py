"""Address line parsing.

The reference runs a trained statistical address parser. That model is not
available here, so German street lines are split by a regular expression: the
contract is ``Hauptstr. 62-64a, 12345, Deutschland`` -> road ``hauptstr.``,
house number ``62-64a``, postcode ``12345``. Output is lower-cased like the
parser's. A line that does not end in a house number keeps its whole street
segment as the road and a NULL house number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Street segment = text before the first comma; road and house number from it.
HOUSE_NUMBER_PATTERN = r"^(.*?)[ ,]+(\d+\s*[a-zA-Z]?(?:\s*[-/]\s*\d+\s*[a-zA-Z]?)?)$"
# First five-digit group of the whole line, delimited by non-word ASCII.
POSTCODE_PATTERN = r"(?<![0-9A-Za-z_])(\d{5})(?![0-9A-Za-z_])"


def address_line(street, code, country: str = "Deutschland") -> Column:
    """``street, code, country`` (F12); NULL if street or code is NULL."""
    street = F.col(street) if isinstance(street, str) else street
    code = F.col(code) if isinstance(code, str) else code
    return F.concat(street, F.lit(", "), code, F.lit(", " + country))


def parse_address_line(line) -> Column:
    """struct(road, house_number, postcode) of an address line."""
    line = F.col(line) if isinstance(line, str) else line
    segment = F.trim(F.regexp_extract(line, r"^([^,]*)", 1))
    has_number = segment.rlike(HOUSE_NUMBER_PATTERN)
    road = F.when(has_number, F.regexp_extract(segment, HOUSE_NUMBER_PATTERN, 1)).otherwise(segment)
    number = F.when(has_number, F.regexp_extract(segment, HOUSE_NUMBER_PATTERN, 2))
    postcode = F.nullif(F.regexp_extract(line, POSTCODE_PATTERN, 1), F.lit(""))
    null = F.lit(None).cast("string")
    return F.when(line.isNull(), F.struct(null.alias("road"), null.alias("house_number"),
                                          null.alias("postcode"))).otherwise(
        F.struct(F.lower(road).alias("road"), F.lower(number).alias("house_number"),
                 postcode.alias("postcode")))
