"""Cleansing rules as Column expressions. All stay inside code generation; none throws on bad text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space a JavaScript trim removes, byte order mark included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r "
    "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
WHITE_SPACE_CLASS = r"[\s\p{Z}\x{FEFF}]"

# The words the old system uses for yes and no.
YES_WORDS = ("1", "true", "True", "Y", "y", "t", "T")
NO_WORDS = ("0", "false", "False", "N", "n", "f", "F")
YES_WORDS_SQL = ("1", "true", "t", "y", "yes")
NO_WORDS_SQL = ("0", "false", "f", "n", "no")

# Accepted number, code list, date and uuid shapes.
REAL_SHAPE = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
CODE_LIST_SHAPE = r'^[\d\s,;|\[\]"-]+$'
UUID_SHAPE = r"^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"

# A hand-typed number without its white space: leading plus, trailing sign, decimal comma and
# trailing dot are tolerated. Groups: whole part, fraction, exponent, fraction behind a comma.
TYPED_REAL = (
    r"(?s)^(?:\+?(-?[0-9]+)(?:(?:\.([0-9]+))?([eE][+-]?[0-9]+)?[+-]?|,([0-9]+)[+-]?|\.)|.*)$"
)
ERA_OFFSET = 543


def strip(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITE_SPACE))


def null_if_blank(c: Column, null_words: Sequence[str] = ()) -> Column:
    """Trimmed text; blank, or one of the words that stand for null, becomes null."""
    text = strip(c)
    blank = text == ""
    if null_words:
        blank = blank | F.upper(text).isin([w.upper() for w in null_words])
    return F.when(~blank, text)


def norm_key(c: Column) -> Column:
    return null_if_blank(c)


def match_key(c: Column) -> Column:
    """Key for comparing spellings: lower case, and numbers lose leading zeros."""
    return F.regexp_replace(F.lower(norm_key(c)), "^0+(?=[0-9]+$)", "")


def clamp_text(c: Column, n: int = 255) -> tuple[Column, Column]:
    """(text cut to n characters, was it cut)."""
    text = null_if_blank(c)
    return F.substring(text, 1, n), F.coalesce(F.char_length(text) > n, F.lit(False))


def matched(text: Column, shape: str, group: int = 0) -> Column:
    """The match, or null. Casts must not see text they reject: each rejection costs an exception."""
    return F.nullif(F.regexp_extract(text, shape, group), F.lit(""))


def to_int_strict(c: Column, max_digits: int | None = None, signed: bool = True) -> Column:
    """Whole number, of at most `max_digits` digits if given; null beyond 64 bits. One match trims, checks and extracts."""
    sign = "-?" if signed else ""
    digits = "+" if max_digits is None else f"{{1,{max_digits}}}"
    shape = f"^{WHITE_SPACE_CLASS}*({sign}[0-9]{digits}){WHITE_SPACE_CLASS}*$"
    return matched(c.cast("string"), shape, 1).try_cast("bigint")


def to_real_lenient(c: Column, money: bool = False) -> Column:
    """Number from hand-typed text; with money, commas separate thousands and the result is decimal."""
    if money:
        text = F.regexp_replace(strip(c), ",", "")
        return matched(text, REAL_SHAPE).try_cast("decimal(19,4)")
    text = F.translate(c.cast("string"), WHITE_SPACE, "")
    number = F.regexp_replace(text, TYPED_REAL, "$1.$2$4$3")
    return F.nullif(number, F.lit(".")).try_cast("double")


def to_bool(c: Column, vocab: str = "js", default: bool | None = None) -> Column:
    if vocab == "js":
        text, yes, no = null_if_blank(c), YES_WORDS, NO_WORDS
    elif vocab == "sql":
        text, yes, no = F.lower(null_if_blank(c)), YES_WORDS_SQL, NO_WORDS_SQL
    else:
        raise ValueError(f"unknown vocabulary {vocab!r}")
    value = F.when(text.isin(*yes), F.lit(True)).when(text.isin(*no), F.lit(False))
    return value if default is None else F.coalesce(value, F.lit(default))


def to_int_flag(c: Column) -> Column:
    """0 or 1 for the yes and no words; other whole numbers are kept."""
    return F.coalesce(to_bool(c).cast("bigint"), to_int_strict(c))


def _date_time_text(c: Column, time_after_t: bool) -> Column:
    """`yyyy-mm-dd hh:mm:ss`, midnight without a readable time, null if not a date."""
    space = WHITE_SPACE_CLASS + "*"
    before_time = space + "[Tt]?" if time_after_t else space
    day = "([0-9]{4})-([0-9]{2}).([0-9]{2})"
    time = "([0-9]{2}).([0-9]{2}).([0-9]{2})"
    shape = f"(?s)^(?:{space}{day}(?:{before_time}{time})?.*|.*)$"
    parts = F.regexp_replace(c.cast("string"), shape, "$1-$2-$3 $4:$5:$6")
    timed = F.when(F.char_length(parts) == 13, F.concat(F.substring(parts, 1, 11), F.lit("00:00:00"))).otherwise(parts)
    return F.nullif(timed, F.lit("-- ::"))


def _shifted_year(text: Column, threshold: int) -> Column:
    year = F.substring(text, 1, 4).try_cast("int")
    return year - (year >= threshold).cast("int") * ERA_OFFSET


def be_to_timestamp(
    c: Column, threshold: int, keep_time: bool = True, time_after_t: bool = True
) -> Column:
    """Wall-clock timestamp from ISO-like text whose year may count in the Buddhist era.

    Years from `threshold` on are shifted before the calendar check, so 29 February is judged in
    the common era. Impossible dates give null. An unreadable time gives midnight; with
    `time_after_t` off, so does a time behind a letter T.
    """
    text = _date_time_text(c, time_after_t)

    def number(start: int) -> Column:
        return F.substring(text, start, 2).try_cast("int")

    clock = [number(i) if keep_time else F.lit(0) for i in (12, 15, 18)]
    return F.try_make_timestamp_ntz(
        _shifted_year(text, threshold), number(6), number(9), clock[0], clock[1], clock[2].cast("decimal(8,6)")
    )


def be_to_text(c: Column, threshold: int, time_after_t: bool = True) -> Column:
    """The shifted date and time as text, without a calendar check."""
    text = _date_time_text(c, time_after_t)
    year = F.lpad(_shifted_year(text, threshold).cast("string"), 4, "0")
    return F.concat(year, F.substring(text, 5, 20))


def parse_iso_date(c: Column) -> Column:
    text = F.substring(strip(c), 1, 10)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp read as UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def to_epoch(c: Column, threshold: int = 2400, time_after_t: bool = False) -> Column:
    """Epoch seconds; 0 and 1 mean no value, other whole numbers pass through."""
    text = null_if_blank(c)
    return (
        F.when(text.isin("0", "1"), None)
        .when(text.rlike("^-?[0-9]+$"), text.try_cast("bigint"))
        .otherwise(epoch_seconds(be_to_timestamp(c, threshold, time_after_t=time_after_t)))
    )


def clock_slot(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def _pad_two(c: Column) -> Column:
    return F.when(F.char_length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def slot_label(c: Column) -> Column:
    """8:5 becomes 08:05; text without a colon is kept."""
    text = null_if_blank(c)
    parts = F.split(text, ":")
    padded = F.concat_ws(":", _pad_two(F.get(parts, F.lit(0))), _pad_two(F.get(parts, F.lit(1))))
    return F.when(F.size(parts) >= 2, padded).otherwise(text)


def digits_or_text(c: Column) -> Column:
    text = null_if_blank(c)
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when(digits != "", digits).otherwise(text)


def _phones_in_part(part: Column) -> Column:
    digits = F.regexp_replace(part, "[^0-9]", "")
    found = F.concat(
        F.regexp_extract_all(digits, F.lit("0[234][0-9]{7}"), 0),
        F.regexp_extract_all(digits, F.lit("0[6789][0-9]{8}"), 0),
    )
    size = F.char_length(digits)
    fallback = (
        F.when(digits.rlike("^0[6789]") & (size >= 10), F.substring(digits, 1, 10))
        .when(digits.rlike("^0[234]") & (size >= 9), F.substring(digits, 1, 9))
        .when(size.isin(9, 10), digits)
        .when(size > 10, F.substring(digits, 1, 10))
    )
    return F.when(F.size(found) > 0, found).when(fallback.isNotNull(), F.array(fallback)).otherwise(
        F.array().cast("array<string>")
    )


def split_phones(biz: Column, home: Column) -> tuple[Column, Column]:
    """(mobile or business, home): only cells that hold a slash are taken apart.

    The first land line found becomes the home number, the first mobile the business number.
    """
    biz_text, home_text = null_if_blank(biz), null_if_blank(home)
    joined = F.concat_ws("/", biz_text, home_text)
    phones = F.flatten(F.transform(F.split(joined, "/"), _phones_in_part))
    mobile = F.get(F.filter(phones, lambda p: p.rlike("^0[6789]")), F.lit(0))
    land = F.get(F.filter(phones, lambda p: p.rlike("^0[234]")), F.lit(0))
    mixed = F.coalesce(biz_text.contains("/"), F.lit(False)) | F.coalesce(
        home_text.contains("/"), F.lit(False)
    )
    return (
        F.when(mixed, F.coalesce(mobile, biz_text)).otherwise(biz_text),
        F.when(mixed, F.coalesce(land, home_text)).otherwise(home_text),
    )


def phone_digit_set(*cells: Column, min_digits: int = 9) -> Column:
    """Distinct numbers in several cells, country prefix 66 rewritten to 0."""
    parts = F.split(F.concat_ws(",", *[c.cast("string") for c in cells]), "[,/;|]")

    def canonical(part: Column) -> Column:
        digits = F.regexp_replace(part, "[^0-9]", "")
        return F.when(
            digits.startswith("66") & F.char_length(digits).isin(10, 11),
            F.concat(F.lit("0"), F.substring(digits, 3, 20)),
        ).otherwise(digits)

    kept = F.filter(F.transform(parts, canonical), lambda d: F.char_length(d) >= min_digits)
    return F.array_distinct(kept)


def first_phone(*cells: Column, min_digits: int = 9) -> Column:
    """Digits of the first cell that holds enough of them."""
    digits = [F.regexp_replace(c.cast("string"), "[^0-9]", "") for c in cells]
    return F.coalesce(*[F.when(F.char_length(d) >= min_digits, d) for d in digits])


def clean_person_name(c: Column) -> Column:
    text = F.regexp_replace(c.cast("string"), r"^\x{FEFF}", "")
    text = F.btrim(F.regexp_replace(text, WHITE_SPACE_CLASS + "+", " "))
    return F.when(text != "", text)


def is_searchable_name(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\p{L}"), F.lit(False))


def guard_uuid(c: Column) -> Column:
    return matched(F.lower(strip(c)), UUID_SHAPE)


def to_json_array(c: Column, null_as_empty: bool = False) -> Column:
    """JSON text of a one-element array: a number if the text is a whole number, else a string."""
    text = null_if_blank(c)
    number = to_int_strict(c)
    value = F.when(number.isNotNull(), F.concat(F.lit("["), number.cast("string"), F.lit("]"))).when(
        text.isNotNull(), F.to_json(F.array(text))
    )
    return F.coalesce(value, F.lit("[]")) if null_as_empty else value


def remap_code_list(c: Column, mapping: Mapping[int, int] | None = None) -> Column:
    """JSON text of the codes in a cell, remapped; free text becomes a one-string array."""
    text = null_if_blank(c)
    codes = F.transform(
        F.regexp_extract_all(text, F.lit("-?[0-9]+"), 0), lambda x: x.try_cast("bigint")
    )
    if mapping:
        codes = F.transform(
            codes,
            lambda x: reduce(
                lambda chain, kv: chain.when(x == kv[0], F.lit(kv[1]).cast("bigint")),
                mapping.items(),
                F.when(F.lit(False), F.lit(None).cast("bigint")),
            ).otherwise(x),
        )
    listed = F.concat(F.lit("["), F.array_join(F.transform(codes, lambda x: x.cast("string")), ","), F.lit("]"))
    return (
        F.when(text.isNull(), F.lit("[]"))
        .when(text.rlike(CODE_LIST_SHAPE), listed)
        .otherwise(F.to_json(F.array(text)))
    )


def derive_status(ts: Column, no_show: Column, as_of: Column, labels: Mapping[str, str]) -> Column:
    """The no-show flag wins, then the past counts as completed."""
    return (
        F.when(F.coalesce(no_show, F.lit(False)), F.lit(labels["no_show"]))
        .when(ts < as_of, F.lit(labels["completed"]))
        .otherwise(F.lit(labels["default"]))
    )


def concat_nonblank(*parts: Column, sep: str = " ") -> Column:
    joined = F.concat_ws(sep, *[null_if_blank(p) for p in parts])
    return F.when(joined != "", joined)


def wall_clock_to_instant(c: Column, zone: str) -> Column:
    """The UTC time, without zone, at which clocks in `zone` show the value."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), c)


def is_weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def int_or_text_id(c: Column) -> Column:
    """Whole numbers in canonical form, other identifiers as trimmed text."""
    return F.coalesce(to_int_strict(c).cast("string"), null_if_blank(c))


def is_placeholder(
    first_name: Column, sentinel: str, last_name: Column | None = None, prefix: str = ""
) -> Column:
    """Row made only to satisfy a reference: sentinel first name, optionally a generated last name."""
    fake = first_name == F.lit(sentinel)
    if last_name is not None:
        fake = fake & last_name.startswith(prefix)
    return F.coalesce(fake, F.lit(False))
