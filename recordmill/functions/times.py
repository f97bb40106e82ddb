"""Dates, ages and the freshness gate. The reference time is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.text import blank_to_null, strip

SECOND = 1_000_000
UNIT_MICROS = {
    "sec": SECOND, "min": 60 * SECOND, "hour": 3600 * SECOND, "hr": 3600 * SECOND,
    "day": 86400 * SECOND, "d": 86400 * SECOND, "week": 7 * 86400 * SECOND,
}
DAY = UNIT_MICROS["day"]

FRESHNESS_TYPE = (
    "struct<status:string,reason:string,published_at:string,age_hours:double,"
    "raw_date_string:string>"
)


def _earlier(ref: Column, count: Column, unit: Column) -> Column:
    """``ref`` minus a number of units; null when the number or the result is out of range."""
    size = F.lit(None).cast("bigint")
    for prefix in ("sec", "min", "hour", "hr", "day", "week"):
        size = F.when(F.startswith(unit, F.lit(prefix)), F.lit(UNIT_MICROS[prefix])).otherwise(size)
    size = F.when(unit == "d", F.lit(DAY)).otherwise(size)
    micros = F.try_subtract(F.unix_micros(ref), F.try_multiply(count.try_cast("bigint"), size))
    return F.timestamp_micros(micros)


def _counted(text: Column, pattern: str, ref: Column) -> Column:
    """``ref`` minus what a counted phrase says; a text without "ago" has none, and no pattern is tried on it."""
    def read(unit: Column) -> Column:
        return _earlier(ref, blank_to_null(F.regexp_extract(text, pattern, 1)), unit)

    return F.when(F.contains(text, F.lit("ago")), _bind(F.regexp_extract(text, pattern, 2), read))


def relative_strict(c: Column, ref: Column) -> Column:
    """Whole-string relative phrases."""
    pattern = r"^(\d+)\s*(minute|min|hour|hr|day|d)s?\s*ago$"

    def read(text: Column) -> Column:
        return (
            F.when(text.isin("just now", "now", "today"), ref)
            .when(text == "yesterday", F.timestamp_micros(F.unix_micros(ref) - DAY))
            .otherwise(_counted(text, pattern, ref))
        )

    return _bind(F.lower(strip(c)), read)


def relative_loose(c: Column, ref: Column) -> Column:
    """Relative phrases anywhere in the string, seconds and weeks included."""
    return _bind(F.lower(strip(c)), lambda text: _loose(text, ref))


def _loose(text: Column, ref: Column) -> Column:
    """The same for a text that is lower-case and trimmed."""
    pattern = r"(\d+)\s+(second|sec|minute|min|hour|hr|day|week)s?\s+ago"
    return (
        F.when(F.contains(text, F.lit("yesterday")), F.timestamp_micros(F.unix_micros(ref) - DAY))
        .when(F.contains(text, F.lit("today")) | F.contains(text, F.lit("just now")), ref)
        .otherwise(_counted(text, pattern, ref))
    )


# Written dates are read word by word. A word is a number, a run of letters or a single sign; its kind
# and value are looked up once, and a fold over the words fills the fields of a date.
_WORDS = r"\d+|\p{L}+|[^\s\p{L}\d]"
_BAD, _NUMBER, _MONTH, _SKIP, _HALF, _ZONE, _COLON, _SIGN, _POINT, _NAME = range(10)
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
SKIPPED = ("at", "of", "the", "on", "st", "nd", "rd", "th", "t", ",", "/", "(", ")")
#: Hours east of UTC by zone name.
ZONES = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "cet": 1, "cest": 2, "eet": 2, "eest": 3, "msk": 3,
    "jst": 9, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
}


def _short_names(names: tuple[str, ...]) -> dict[str, int]:
    """Full and abbreviated names to their place from 1; September also has four letters."""
    found = {n: i for i, n in enumerate(names, 1)} | {n[:3]: i for i, n in enumerate(names, 1)}
    return found | {n[:k]: i for i, n in enumerate(names, 1) for k in (4, 5) if n[:k] in ("sept", "tues", "thur", "thurs")}


def _vocabulary() -> str:
    """Kind and value of every known word, as one literal: ``word=kind*10000+value``, the value moved up by
    5000 so that it is not negative."""
    known = {w: (_SKIP, 0) for w in SKIPPED if w != ","} | {w: (_SKIP, 0) for w in _short_names(WEEKDAYS)}
    known |= {w: (_MONTH, i) for w, i in _short_names(MONTHS).items()}
    known |= {w: (_ZONE, h * 60) for w, h in ZONES.items()}
    known |= {"am": (_HALF, 1), "pm": (_HALF, 2), "a": (_HALF, 1), "p": (_HALF, 2), ":": (_COLON, 0), "+": (_SIGN, 1), "-": (_SIGN, -1), ".": (_POINT, 0)}
    return ",".join(f"{w}={k * 10_000 + v + 5000}" for w, (k, v) in known.items())


def _bind(value: Column, body) -> Column:
    """``body`` over ``value``, which is evaluated and planned once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_STATE = (
    "struct<numbers:array<struct<value:int,width:int>>,month:int,hour:int,minute:int,second:int,micro:int,"
    "half:int,sign:int,offset:int,last:int,zone:boolean,bad:boolean>"
)


#: What a word does to the state.
(_FAIL, _PASS, _TO_ZONE, _TO_MINUTE, _TO_SECOND, _TO_MICRO, _PACKED_DAY, _PACKED_CLOCK, _TO_DATE, _TO_MONTH, _TO_HOUR, _TO_HALF,
 _TO_SIGN, _NAMED) = range(14)


def _action(s: Column, w: Column) -> Column:
    kind, width, count = w["kind"], w["width"], F.size(s["numbers"])
    clocked, colon = s["hour"].isNotNull(), s["last"] == _COLON
    number = (
        F.when(s["sign"].isNotNull() & ((s["last"] == _SIGN) | colon & s["zone"]), _TO_ZONE)
        .when(colon & clocked & s["minute"].isNull(), _TO_MINUTE)
        .when(colon & clocked & s["second"].isNull(), _TO_SECOND)
        .when((s["last"] == _POINT) & s["second"].isNotNull() & s["micro"].isNull(), _TO_MICRO)
        .when((width == 8) & (count == 0) & ~clocked, _PACKED_DAY)
        .when((width == 6) & (count == 3) & ~clocked, _PACKED_CLOCK)
        .when((width <= 4) & (count <= 3), _TO_DATE)
        .otherwise(_FAIL)
    )
    return (
        F.when(kind == _NUMBER, number)
        .when(kind == _MONTH, F.when(s["month"].isNull(), _TO_MONTH).otherwise(_FAIL))
        .when(kind == _COLON, F.when(clocked, _PASS).when(count > 0, _TO_HOUR).otherwise(_FAIL))
        .when(kind == _HALF, F.when(clocked | (count > 0), _TO_HALF).otherwise(_FAIL))
        .when(kind == _SIGN, F.when(clocked & s["sign"].isNull(), _TO_SIGN).otherwise(_PASS))
        .when(kind == _ZONE, F.when(s["zone"], _FAIL).otherwise(_NAMED))
        .when(kind == _NAME, F.when(clocked & ~s["zone"], _NAMED).otherwise(_FAIL))
        .when(kind == _BAD, _FAIL)
        .otherwise(_PASS)
    )


def _step(s: Column, w: Column) -> Column:
    """The state after one more word (kind, value, width, fraction)."""
    kind, value, width = w["kind"], w["value"], w["width"]

    def one(v: Column, n: int | Column) -> Column:
        return F.struct(v.cast("int").alias("value"), (F.lit(n) if isinstance(n, int) else n).cast("int").alias("width"))

    def part(low: int) -> Column:
        return F.pmod(F.floor(value / low), F.lit(100))

    def moved(act: Column) -> Column:
        day8 = F.array(one(F.floor(value / 10000), 4), one(part(100), 2), one(part(1), 2))
        shorter = F.slice(s["numbers"], 1, F.greatest(F.size(s["numbers"]) - 1, F.lit(0)))
        to_hour = (act == _TO_HOUR) | (act == _TO_HALF) & s["hour"].isNull()
        offset = F.when(s["last"] == _COLON, s["offset"] + s["sign"] * value).otherwise(
            s["sign"] * F.when(width > 2, F.floor(value / 100) * 60 + part(1)).otherwise(value * 60))

        def put(name: str, *cases: tuple[int, Column]) -> Column:
            out = s[name]
            for code, v in cases:
                out = F.when(act == code, v.cast("int")).otherwise(out)
            return out.alias(name)

        return F.struct(
            F.when(act == _PACKED_DAY, day8).when(act == _TO_DATE, F.array_append(s["numbers"], one(value, width))).when(
                to_hour, shorter).otherwise(s["numbers"]).alias("numbers"),
            put("month", (_TO_MONTH, value)),
            F.when(to_hour, F.element_at(s["numbers"], -1)["value"]).when(act == _PACKED_CLOCK, F.floor(value / 10000)).otherwise(
                s["hour"]).cast("int").alias("hour"),
            put("minute", (_TO_MINUTE, value), (_PACKED_CLOCK, part(100))),
            put("second", (_TO_SECOND, value), (_PACKED_CLOCK, part(1))),
            put("micro", (_TO_MICRO, w["fraction"])),
            put("half", (_TO_HALF, value)),
            put("sign", (_TO_SIGN, value)),
            put("offset", (_NAMED, value), (_TO_ZONE, offset)),
            kind.cast("int").alias("last"),
            (s["zone"] | act.isin(_NAMED, _TO_ZONE)).alias("zone"),
            (s["bad"] | (act == _FAIL)).alias("bad"),
        )

    return _bind(_action(s, w), moved)


def _resolved(s: Column) -> Column:
    """The timestamp of a filled state, or null. A number of four digits is the year; without a month's
    name, the month comes first unless it cannot be one. Two-digit years are of this century up to 68."""
    n = s["numbers"]
    a, b, c = (F.get(n, i) for i in range(3))
    named, two, long_a, long_b = s["month"].isNotNull(), F.size(n) == 2, a["width"] >= 3, b["width"] >= 3
    # Year, month, day by which words are there.
    parts = (
        F.when(named & two & long_a & ~long_b, F.array(a["value"], s["month"], b["value"]))
        .when(named & two & ~long_a, F.array(b["value"], s["month"], a["value"]))
        .when(named | (F.size(n) != 3) | long_b, F.lit(None))
        .when(long_a & (b["value"] > 12), F.array(a["value"], c["value"], b["value"]))
        .when(long_a, F.array(a["value"], b["value"], c["value"]))
        .when((a["value"] > 12) & (b["value"] <= 12), F.array(c["value"], b["value"], a["value"]))
        .otherwise(F.array(c["value"], a["value"], b["value"]))
    )
    whole = s["hour"].isNull() | s["minute"].isNotNull() | s["half"].isNotNull()

    def at(p: Column) -> Column:
        y = F.get(p, F.lit(0))
        short = ~F.exists(n, lambda x: x["width"] >= 3)
        year = F.when(short & (y <= 68), y + 2000).when(short, y + 1900).otherwise(y)
        hour = F.when(s["half"].isNull(), F.coalesce(s["hour"], F.lit(0))).when(
            s["hour"].between(1, 12), F.pmod(s["hour"], F.lit(12)) + F.when(s["half"] == 2, 12).otherwise(0))
        second = F.coalesce(s["second"], F.lit(0)) + F.coalesce(s["micro"], F.lit(0)) / F.lit(1_000_000)
        made = F.try_make_timestamp(
            year, F.get(p, F.lit(1)), F.get(p, F.lit(2)), hour, F.coalesce(s["minute"], F.lit(0)), second.cast("decimal(16,6)"))
        return F.timestamp_micros(F.unix_micros(made) - F.coalesce(s["offset"], F.lit(0)).cast("long") * UNIT_MICROS["min"])

    return _bind(F.when(~s["bad"] & whole & (F.coalesce(s["hour"], F.lit(0)) < 24), parts), at)


def _written(text: Column) -> Column:
    """Timestamp of a written date, or null."""
    known = F.expr(f"str_to_map('{_vocabulary()}', ',', '=')")

    def read(original: Column) -> Column:
        def word(t: Column) -> Column:
            def looked_up(code: Column) -> Column:
                number = t.rlike(r"^\d+$")
                # Letters in capitals behind a clock may name a zone that is not known: it counts as UTC.
                name = t.rlike("^[A-Z]{3,5}$")
                return F.struct(
                    F.when(number, _NUMBER).when(code.isNotNull(), F.floor(code / 10_000).cast("int")).when(t == ",", _SKIP).when(
                        name, _NAME).otherwise(_BAD).alias("kind"),
                    F.when(number, F.left(t, F.lit(9)).cast("int")).otherwise(
                        F.coalesce(F.pmod(code, F.lit(10_000)) - 5000, F.lit(0))).alias("value"),
                    F.length(t).alias("width"),
                    F.when(number, F.rpad(F.left(t, F.lit(6)), 6, "0").cast("int")).alias("fraction"),
                )

            return _bind(F.try_element_at(known, F.lower(t)).cast("int"), looked_up)

        empty = F.from_json(F.lit('{"numbers":[],"last":3,"zone":false,"bad":false}'), _STATE)
        return F.aggregate(F.transform(F.regexp_extract_all(original, F.lit(_WORDS), F.lit(0)), word), empty, _step, _resolved)

    # Long texts and texts without digits are no dates.
    fits = (F.length(text) <= 64) & text.rlike(r"\d")
    return _bind(F.when(fits, text), lambda t: F.when(t.isNotNull(), read(t)))


def parse_timestamp(c: Column, ref: Column) -> Column:
    """Relative phrase, else ISO, else a written date, else null. Times without a zone are UTC. Incomplete
    dates are never completed from the current day."""
    def read(text: Column) -> Column:
        iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text)
        iso = F.regexp_replace(iso, r"([+-]\d{2})(\d{2})$", "$1:$2")
        relative = _bind(F.lower(text), lambda low: _loose(low, ref))
        return F.coalesce(relative, iso.try_cast("timestamp"), _written(text))

    return _bind(strip(c), read)


def iso8601(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_date(c: Column) -> Column:
    """Well-formed ISO date to seconds with ``Z``; the offset is dropped, not converted. Anything
    else comes back as it was; blank gives null."""
    pattern = (
        r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?)"
        r"(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?)?$"
    )
    day = blank_to_null(F.regexp_extract(c, pattern, 1))
    clock = F.regexp_replace(F.regexp_extract(c, pattern, 2), ",", ".")
    parsed = F.trim(F.concat(day, F.lit(" "), clock)).try_cast("timestamp")
    return F.coalesce(iso8601(parsed), blank_to_null(c))


def freshness(c: Column, ref: Column, window_hours: float = 24.0, reason: str = "UNKNOWN") -> Column:
    """Gate result for a publication date given as text. The text is taken once, however dear it is to get:
    inside a lambda Spark works out an expression anew wherever it stands."""
    def of_text(text: Column) -> Column:
        def gate(strict: Column) -> Column:
            given = F.coalesce(text, F.lit("")) != ""
            why = F.when(strict.isNotNull(), F.lit("RELATIVE_DATE")).otherwise(
                F.lit("METADATA" if reason == "UNKNOWN" else reason)
            )
            return _bind(F.coalesce(strict, parse_timestamp(text, ref)), lambda published: _gate(
                published, F.when(given, text), given, why, ref, window_hours))

        return _bind(relative_strict(text, ref), gate)

    return _bind(c, of_text)


def freshness_of_timestamp(ts: Column, ref: Column, window_hours: float = 24.0) -> Column:
    """Gate result for a publication date that is already a timestamp."""
    why = F.lit("METADATA")
    ts = ts.cast("timestamp")
    return _gate(ts, ts.cast("string"), ts.isNotNull(), why, ref, window_hours)


def round_half_even(c: Column) -> Column:
    """Two decimals, decided on the exact binary value. ``bround`` decides on the shortest decimal
    writing instead, and so takes 135.355, which lies below the middle, for a tie."""
    return F.call_function("format_number", c, F.lit("0.00")).cast("double") + F.lit(0.0)


def _gate(
    published: Column, raw: Column, given: Column, why: Column, ref: Column, window: float
) -> Column:
    known = given & published.isNotNull()

    def result(age: Column) -> Column:
        status = (
            F.when(~known, F.lit("UNKNOWN"))
            .when((age >= -1.0) & (age <= window), F.lit("FRESH"))
            .when(age < 0.0, F.lit("UNKNOWN"))
            .otherwise(F.lit("STALE"))
        )
        return F.struct(
            status.alias("status"),
            F.when(known, why).otherwise(F.lit("UNKNOWN")).alias("reason"),
            F.when(known, iso8601(published)).alias("published_at"),
            F.when(known, age).alias("age_hours"),
            raw.alias("raw_date_string"),
        )

    return _bind(round_half_even((F.unix_micros(ref) - F.unix_micros(published)) / F.lit(3600.0 * SECOND)), result)


def is_fresh(gate: Column) -> Column:
    return F.struct(
        (gate["status"] == "FRESH").alias("fresh"),
        F.coalesce(gate["published_at"], F.lit("")).alias("published_at"),
    )
