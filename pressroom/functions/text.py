"""Text scalar functions (STR1-STR4, STR8, STR9) as Column expressions.

Everything here compiles to JVM expressions inside whole-stage codegen, except
``nfc`` which needs Unicode normalisation: that one is an Arrow-batched pandas
UDF and is skipped for ASCII-only values, which are already NFC.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.split()/str.isspace() treat as
# whitespace, written as a regex class valid in both Java regex and RE2.
PY_WHITESPACE = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
# Whitespace that survives the control-character removal of ``normalize_text``.
WS_AFTER_CONTROL = (
    "[\\t\\n\\r \\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
# Fixed value: control characters dropped by ``normalize_text``.
CONTROL_CHARS = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{9F}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """Collapse runs of (Python) whitespace to one space and trim; null stays null."""
    return F.trim(F.regexp_replace(_c(c), PY_WHITESPACE + "+", " "))


def clean_text(c) -> Column:
    """STR1: collapse whitespace, trim; null -> ''."""
    return F.coalesce(collapse_ws(c), F.lit(""))


def clean_text_list(arr) -> Column:
    """STR1 on a list: non-empty items joined by one space, then cleaned."""
    a = F.filter(_c(arr), lambda x: x.isNotNull() & (x != ""))
    return clean_text(F.array_join(a, " "))


def csv_flat(c) -> Column:
    """STR2: newlines to spaces, collapse whitespace, double the quotes."""
    return F.replace(clean_text(c), F.lit('"'), F.lit('""'))


@F.pandas_udf(T.StringType())
def _nfc_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFC", v) if isinstance(v, str) else v)


_ICU: dict[str, bool] = {}


def _icu_available() -> bool:
    """Spark 4 ships ICU4J (collation support); its static NFC composer runs on the JVM."""
    if "ok" not in _ICU:
        try:
            from pyspark.sql import SparkSession
            jvm = SparkSession.getActiveSession().sparkContext._jvm
            jvm.java.lang.Class.forName("com.ibm.icu.text.Normalizer")
            _ICU["ok"] = True
        except Exception:
            _ICU["ok"] = False
    return _ICU["ok"]


def nfc(c) -> Column:
    """Unicode NFC.

    JVM-side through ICU's ``Normalizer.compose(s, false)`` (NFC) when ICU is on
    the classpath -- no Python hop; otherwise an Arrow-batched pandas UDF that
    is only called for non-ASCII values.  Both agree with ``unicodedata`` NFC
    (checked on every document of the test tables).
    """
    col = _c(c)
    if _icu_available():
        return F.when(col.isNotNull(), F.call_function(
            "reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), col, F.lit(False)))
    return F.when(col.rlike("^\\p{ASCII}*$"), col).otherwise(_nfc_udf(col))


def normalize_text(c, use_nfc: bool = True) -> Column:
    """STR3: NFC, drop control characters, CRLF/CR -> LF, collapse, trim; null -> ''."""
    col = nfc(c) if use_nfc else _c(c)
    col = F.regexp_replace(col, CONTROL_CHARS, "")
    col = F.regexp_replace(col, "\\r\\n?", "\n")
    col = F.trim(F.regexp_replace(col, WS_AFTER_CONTROL + "+", " "))
    return F.coalesce(col, F.lit(""))


def strip_cdata(c) -> Column:
    """STR4: unwrap ``<![CDATA[...]]>`` if the whole value is wrapped; then trim."""
    col = _c(c)
    inner = F.regexp_extract(col, "(?s)^<!\\[CDATA\\[(.*)\\]\\]>$", 1)
    return F.when(col.rlike("(?s)^<!\\[CDATA\\[.*\\]\\]>$"), F.trim(inner)).otherwise(col)


def py_title(c) -> Column:
    """STR8 core: Python ``str.title()``.

    A letter is upper-cased when it follows a non-letter (or starts the
    string), lower-cased otherwise.  ``initcap`` only splits on spaces, so a
    marker + space is inserted after every non-letter, initcap applied, and
    the markers removed again.
    """
    lowered = F.lower(_c(c))
    marked = F.regexp_replace(lowered, "([^\\p{L}])", "$1\u0001 ")
    return F.regexp_replace(F.initcap(marked), "\u0001 ", "")


def slug_title(c) -> Column:
    """STR8: hyphens to spaces, then Python title-case."""
    return py_title(F.replace(_c(c), F.lit("-"), F.lit(" ")))


def capitalize(c) -> Column:
    """STR9: Python ``str.capitalize``: first character title-cased ('ß' -> 'Ss'), the rest lower."""
    col = _c(c)
    return F.concat(F.initcap(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 1 << 30)))


def nullif_blank(c) -> Column:
    """'' and all-whitespace values become null (the input convention of §1.2)."""
    col = _c(c)
    return F.when(F.trim(col) == "", F.lit(None).cast("string")).otherwise(col)


def xml_escape(c) -> Column:
    """Escape text for an XML element body or attribute value."""
    col = _c(c)
    for k, v in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        col = F.replace(col, F.lit(k), F.lit(v))
    return col
