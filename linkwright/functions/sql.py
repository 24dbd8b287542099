"""The cleaning macro and the similarity for SQL users.

``register_sql_functions(spark)`` makes ``clean_account_name(str)`` a temporary
SQL function whose body is a pure SQL expression (it is inlined by the
analyzer, so it stays in generated code) and ``jaro_winkler_similarity(a, b)``
the Arrow UDF, so ``spark.sql`` queries can use the same names as the oracle.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .similarity import jaro_winkler_udf
from .text import _ACCENT_DST, _ACCENT_SRC, AMP_ENTITY, LEGAL_FORM_REGEX


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def clean_account_name_sql(arg: str = "str") -> str:
    """The body of ``clean_account_name`` as a Spark SQL expression."""
    e = f"replace({arg}, {_lit(AMP_ENTITY)}, '')"
    e = f"translate({e}, {_lit(_ACCENT_SRC)}, {_lit(_ACCENT_DST)})"
    e = f"lower(regexp_replace({e}, {_lit(chr(92) + 'p{M}+')}, ''))"
    e = f"regexp_replace({e}, {_lit(LEGAL_FORM_REGEX)}, '')"
    return f"regexp_replace({e}, '[^a-z0-9]', '')"


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION clean_account_name(str STRING) "
              f"RETURNS STRING RETURN {clean_account_name_sql()}")
    spark.udf.register("jaro_winkler_similarity", jaro_winkler_udf)
