"""Tick messages to JSON and back.

Decoding is as strict as Python's ``json.loads``, and keeps apart what a plain
``from_json`` merges: a key that is absent and a key whose value is null.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.functions.numbers import float_of
from tickwell.schema import DEFAULT_MARKET, PRODUCER_MARKET

_STRICT = {"allowSingleQuotes": "false"}
_FIELDS = ["price", "symbol", "company", "market"]
_TYPED = "price DOUBLE, symbol STRING, company STRING, market STRING"
_TEXT = "price STRING, symbol STRING, company STRING, market STRING"
_NESTED = ["symbol", "company", "market"]


# --- encode ---------------------------------------------------------------


def encode_tick(price: Column, symbol: Column, company: Column | None = None, market: Column | None = None) -> Column:
    """Current message as JSON text. Company defaults to the symbol, market to the producer's."""
    return F.to_json(
        F.struct(
            price.alias("price"),
            symbol.alias("symbol"),
            (symbol if company is None else company).alias("company"),
            (F.lit(PRODUCER_MARKET) if market is None else market).alias("market"),
        ),
        {"ignoreNullFields": "false"},
    )


def encode_legacy_tick(price: Column, name: Column, clock: Column) -> Column:
    """Legacy message as JSON text, stamped with the producer's clock."""
    return F.to_json(
        F.struct(price.alias("Price"), name.alias("Name"), epoch_millis(clock).alias("Timestamp")),
        {"ignoreNullFields": "false"},
    )


def epoch_millis(clock: Column) -> Column:
    """Epoch milliseconds, rounded half to even like Python's ``round`` (``unix_millis`` truncates)."""
    return F.bround(F.unix_micros(clock.cast("timestamp")) / F.lit(1000.0)).cast("bigint")


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis).cast("timestamp_ntz")


# --- decode ---------------------------------------------------------------


def decode_ticks(df: DataFrame, value: str = "value", legacy: bool = False) -> DataFrame:
    """Add ``symbol, price, company, market`` and ``reason`` (NULL for a readable tick).

    With ``legacy``, messages under the legacy names are read by the same rules, and
    ``event_time`` is added: their producer's clock, by the rules of the price, NULL if
    they or a current message give none. A time no timestamp holds is ``bad_timestamp``.

    One JSON parse settles a clean message: a flat object whose only closing brace is
    its last character, with a symbol, a finite number for a price, and the other fields
    given or clearly absent. Only other messages are parsed again: as text, for the keys
    that are present, and for the kind of value.
    """
    text, typed = F.col("_text"), F.col("_typed")
    kept = [c for c in df.columns if c not in {*_FIELDS, "reason", *(["event_time"] if legacy else [])}]
    tick = F.when(_is_clean(typed, text), _clean_tick(typed)).otherwise(_other_tick(text))
    read = F.try_validate_utf8(F.col(value).cast("string"))
    return (
        df.withColumn("_given", read)
        .withColumn("_text", F.when(_is_legacy(F.col("_given")), _renamed(F.col("_given"))).otherwise(F.col("_given")) if legacy else F.col("_given"))
        .withColumn("_typed", F.when(_is_flat(text), F.from_json(text, _TYPED, _STRICT)))
        .withColumn("_tick", _let(tick, lambda t: _timed(t, F.col("_given"))) if legacy else tick)
        # A filter on the result must not be pushed below the parse, where it would repeat
        # the parse for each column it reads; no filter passes a generator's own columns.
        .select(*kept, F.inline(F.array("_tick")))
    )


def _is_flat(text: Column) -> Column:
    """An object that ends with its first closing brace: it holds no other, and nothing is behind it."""
    return F.locate("}", text) == F.char_length(text)


def _names(text: Column, name: str) -> Column:
    """Whether a flat object without escapes has the key: only a key has a colon behind its closing quote."""
    return text.rlike(rf'"{name}"[ \t\n\r]*:')


def _clean_tick(typed: Column) -> Column:
    symbol = typed.getField("symbol")
    return F.struct(
        typed.getField("price").alias("price"),
        symbol.alias("symbol"),
        F.coalesce(typed.getField("company"), symbol).alias("company"),
        F.coalesce(typed.getField("market"), F.lit(DEFAULT_MARKET)).alias("market"),
        F.lit(None).cast("string").alias("reason"),
    )


def _is_clean(typed: Column, text: Column) -> Column:
    def plain(name: str) -> Column:
        # A leading bracket may stand for a nested value; no text column takes a NUL.
        read = typed.getField(name)
        return ~(read.startswith("{") | read.startswith("[") | read.contains("\x00"))

    def absent(name: str) -> Column:
        # If the key is there after all, its value is null.
        return ~text.contains("\\") & ~_names(text, name)

    clean = (F.abs(typed.getField("price")) < F.lit(float("inf"))) & plain("symbol")
    for name in ("company", "market"):
        clean = clean & F.coalesce(plain(name), absent(name))
    return F.coalesce(clean & ~_foreign_infinity(text), F.lit(False))


def _foreign_infinity(text: Column) -> Column:
    """True if a bare token is an infinity only Jackson knows (``+Infinity``, ``-INF``, ``+INF``)."""
    outside_strings = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', '""')
    return F.when(
        text.contains("INF") | text.contains("+Infinity"), outside_strings.rlike(r"[+-]INF|\+Infinity")
    ).otherwise(F.lit(False))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, and only where the whole expression is."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


class _Payload:
    """A payload as JSON, read in several ways.

    It is parsed in an array with a seal behind it: Jackson stops at the bracket that
    closes the array, so text behind the value would go unseen, but takes the seal
    with it. The seal depends on the payload, so no payload carries it by chance.
    """

    def __init__(self, text: Column, seal: Column) -> None:
        self.text, self.seal = text, seal
        self.foreign = _foreign_infinity(text)

    def _array(self, seal: Column) -> Column:
        return F.concat(F.lit("["), self.text, F.lit(","), seal, F.lit("]"))

    def _sealed(self) -> Column:
        return self._array(F.concat(F.lit('{"seal":"'), self.seal, F.lit('"}')))

    def parse(self, fields: str) -> Column:
        return F.from_json(self._sealed(), f"array<struct<{fields}, seal STRING>>", _STRICT)

    def is_object(self, parsed: Column) -> Column:
        """Whether ``parsed`` is a whole payload that is an object."""
        sealed = (F.size(parsed) == 2) & (F.get(parsed, F.lit(1)).getField("seal") == self.seal)
        return F.coalesce(sealed, F.lit(False)) & ~self.foreign

    def is_json(self) -> Column:
        texts = F.from_json(self._array(F.concat(F.lit('"'), self.seal, F.lit('"'))), "array<string>", _STRICT)
        return _let(
            texts, lambda t: F.coalesce((F.size(t) == 2) & (F.get(t, F.lit(1)) == self.seal), F.lit(False)) & ~self.foreign
        )

    def keys(self) -> Column:
        return F.map_keys(F.get(F.from_json(self._sealed(), "array<map<string,string>>", _STRICT), F.lit(0)))

    def field(self, name: str, kind: str) -> Column:
        """One field as ``kind``; NULL if its JSON value is of another kind."""
        return F.get(self.parse(f"{name} {kind}"), F.lit(0)).getField(name)


def _other_tick(text: Column) -> Column:
    def read(seal: Column) -> Column:
        payload = _Payload(text, seal)
        stray = F.when(payload.is_json(), "not_object").otherwise("malformed")
        # Nothing but an object starts with a brace. A text that is NULL, not being UTF-8, is no JSON either.
        return F.when(~F.ltrim(text, F.lit(" \t\n\r")).startswith("{"), _reject(stray)).otherwise(
            _let(payload.parse(_TEXT), lambda parsed: judge(payload, parsed))
        )

    def judge(payload: _Payload, parsed: Column) -> Column:
        loose = F.get(parsed, F.lit(0))
        some_null = loose.getField("symbol").isNull()
        for name in ("price", "company", "market"):
            some_null = some_null | loose.getField(name).isNull()
        easy = _is_flat(text) & ~text.contains("\\")
        return F.when(~payload.is_object(parsed), _reject(F.lit("malformed"))).otherwise(
            _let(F.when(some_null & ~easy, payload.keys()), lambda keys: from_object(payload, loose, keys))
        )

    def from_object(payload: _Payload, loose: Column, keys: Column) -> Column:
        return _let(_price_of(payload, loose.getField("price")), lambda price: _tick_of(payload, loose, keys, price))

    return _let(F.xxhash64(text).cast("string"), read)


def _reject(reason: Column) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(
        nothing.cast("double").alias("price"), *(nothing.alias(n) for n in _NESTED), reason.alias("reason")
    )


def _tick_of(payload: _Payload, loose: Column, keys: Column, price: Column) -> Column:
    def has(name: str) -> Column:
        listed = F.when(keys.isNotNull(), F.array_contains(keys, name)).otherwise(_names(payload.text, name))
        return loose.getField(name).isNotNull() | listed

    symbol = loose.getField("symbol")
    reason = (
        F.when(~has("symbol"), "missing_symbol").when(~has("price"), "missing_price").when(price.isNull(), "bad_price")
    )
    for name in _NESTED:
        reason = reason.when(_unstorable(payload, loose.getField(name), name), f"bad_{name}")
    return F.struct(
        price.alias("price"),
        symbol.alias("symbol"),
        F.when(has("company"), loose.getField("company")).otherwise(symbol).alias("company"),
        F.when(has("market"), loose.getField("market")).otherwise(F.lit(DEFAULT_MARKET)).alias("market"),
        reason.when(symbol.isNull(), "null_symbol").alias("reason"),
    )


def _price_of(payload: _Payload, read: Column) -> Column:
    """``float`` of the JSON value whose text is ``read``: booleans count, their names as strings do not."""

    def within_range(number: Column) -> Column:
        # An integer literal beyond the double range is an error, the same digits in a string are infinity.
        beyond = read.rlike(r"^-?[0-9]{309,}$") & (F.abs(number) == F.lit(float("inf")))
        return F.when(beyond, F.when(payload.field("price", "DOUBLE").isNull(), number)).otherwise(number)

    return (
        F.when(read.isin("true", "false"), payload.field("price", "BOOLEAN").cast("double"))
        .when(read.isin('"NaN"', '"Infinity"', '"-Infinity"'), payload.field("price", "DOUBLE"))
        .otherwise(_let(float_of(read), within_range))
    )


def _unstorable(payload: _Payload, read: Column, name: str) -> Column:
    return (
        F.when(read.startswith("{"), payload.field(name, "MAP<STRING,STRING>").isNotNull())
        .when(read.startswith("["), payload.field(name, "ARRAY<STRING>").isNotNull())
        .otherwise(F.coalesce(read.contains("\x00"), F.lit(False)))
    )


# --- legacy ---------------------------------------------------------------

#: Epoch milliseconds of the years 1 to 9999, all that a timestamp takes.
_FIRST_MILLI, _LAST_MILLI = -62_135_596_800_000, 253_402_300_799_999


def _is_legacy(text: Column) -> Column:
    """Whether a message has the legacy name for its symbol and not the current one (in plain spelling)."""
    return F.coalesce(_names(text, "Name") & ~_names(text, "symbol"), F.lit(False))


def _renamed(text: Column) -> Column:
    """A legacy message under the current names. A quote inside a string has a backslash, so none of these is a text."""
    named = F.regexp_replace(text, r'"Name"([ \t\n\r]*:)', '"symbol"$1')
    return F.regexp_replace(named, r'"Price"([ \t\n\r]*:)', '"price"$1')


def _timed(tick: Column, text: Column) -> Column:
    """``tick`` with ``event_time``, the producer's clock, or the reason why a legacy message has no valid one."""

    def read(stamp: Column) -> Column:
        millis = F.floor(float_of(stamp))
        valid = F.coalesce(millis.between(_FIRST_MILLI, _LAST_MILLI), F.lit(False))
        return F.struct(
            *(tick.getField(n).alias(n) for n in _FIELDS),
            F.when(valid, from_epoch_millis(F.when(valid, millis))).alias("event_time"),
            F.coalesce(tick.getField("reason"), F.when(stamp.isNotNull() & ~valid, "bad_timestamp")).alias("reason"),
        )

    return _let(F.when(_is_legacy(text), F.from_json(text, "Timestamp STRING", _STRICT).getField("Timestamp")), read)
