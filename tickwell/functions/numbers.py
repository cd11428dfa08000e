"""Numeric coercion of text under Python's ``float`` rules."""

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMALS = [chr(c) for c in range(0x80, sys.maxunicode + 1) if chr(c).isdecimal()]
_SPACES = [chr(c) for c in range(0x80, sys.maxunicode + 1) if chr(c).isspace()]
_WIDE = "".join(_DECIMALS + _SPACES)
_NARROW = "".join(str(unicodedata.decimal(c)) for c in _DECIMALS) + " " * len(_SPACES)

_BLANK = r"\s*"
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_FLOAT = rf"^{_BLANK}[+-]?(?:{_NUMBER}|(?i:inf|infinity)){_BLANK}$"
_NAN = rf"^{_BLANK}[+-]?(?i:nan){_BLANK}$"


def float_of(text: Column) -> Column:
    """``float(text)`` as a double; NULL where Python would raise."""
    plain = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _WIDE, _NARROW)).otherwise(text)
    bare = F.regexp_replace(plain, r"[\s_]+", "")
    return F.when(plain.rlike(_FLOAT), bare.try_cast("double")).when(plain.rlike(_NAN), F.lit(float("nan")))
