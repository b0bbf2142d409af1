"""Text cleaning for seller reports and catalogue pages.

Every function takes and returns a ``Column`` built from JVM expressions only.
Unparseable text becomes NULL, never an error and never a sentinel.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currency words, unit words and phone prefixes of the reports.
CURRENCY_WORDS = ("Rp", "IDR")
THOUSAND_WORD = " rb"
MINUTE_WORD = " menit"
PHONE_PREFIXES = ("08", "628")
PHONE_MIN_DIGITS = 7
LINK_PHONE_PREFIX = "628"
LINK_PHONE_WINDOW = 20
MISSING_WORDS = ("", "--", "n/a", "nan", "None")

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(text: Column) -> Column:
    """Plain decimal or scientific text to double; anything else is NULL."""
    bare = F.trim(text)
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def nullify(text: Column, words: tuple[str, ...] = MISSING_WORDS) -> Column:
    """Sentinel words for a missing value become NULL."""
    return F.when(~text.isin(*words), text)


def parse_money(text: Column) -> Column:
    """``Rp12.345`` / ``IDR 12.345,5`` to double.

    Dots in front of three digits group thousands and a comma starts the
    fraction. A dot that groups nothing is a decimal point, so amounts that were
    numbers already (``1000.0``) keep their value.
    """
    bare = F.regexp_replace(text, f"(?i){'|'.join(CURRENCY_WORDS)}| ", "")
    grouped = bare.rlike(r"^[+-]?[0-9]{1,3}([.][0-9]{3})+(,[0-9]+)?$")
    plain = F.when(grouped, F.replace(bare, F.lit("."), F.lit(""))).otherwise(bare)
    return to_number(F.replace(plain, F.lit(","), F.lit(".")))


def digits_only(text: Column) -> Column:
    """All digits of the text read as one integer."""
    return F.nullif(F.regexp_replace(text, "[^0-9]", ""), F.lit("")).try_cast("bigint")


def parse_abbrev_count(text: Column) -> Column:
    """``250`` or ``1,2 rb+`` (thousands) to a count."""
    head = F.regexp_extract(text, r"([0-9][0-9.]*(,[0-9]+)?)" + THOUSAND_WORD, 1)
    scaled = to_number(F.replace(F.replace(head, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    return F.when(head != "", F.round(scaled * 1000).cast("bigint")).otherwise(digits_only(text))


def parse_percent(text: Column) -> Column:
    """``98,5%`` to 98.5."""
    return to_number(F.replace(F.replace(text, F.lit("%"), F.lit("")), F.lit(","), F.lit(".")))


def parse_minutes(text: Column) -> Column:
    """``12 menit`` to 12; other units are NULL."""
    return F.nullif(
        F.regexp_extract(text, rf"^\s*([0-9]+){MINUTE_WORD}\s*$", 1), F.lit("")
    ).try_cast("bigint")


def strip_tabs(text: Column) -> Column:
    return F.nullif(F.replace(text, F.lit("\t"), F.lit("")), F.lit(""))


def one_line(text: Column) -> Column:
    """Line breaks inside a cell become blanks."""
    return F.replace(text, F.lit("\n"), F.lit(" "))


def drop_second_line_words(text: Column) -> Column:
    """Drop a line break together with the two words that follow it."""
    return F.regexp_replace(text, r"\n[A-Za-z]*\s[A-Za-z]*", " ")


def int_from_float_text(text: Column) -> Column:
    """``"12.0"`` to 12; text with a real fraction is NULL."""
    number = to_number(text)
    return F.when(number == F.floor(number), number.cast("bigint"))


def slug(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[^A-Za-z]", "_"))


def title_clean(text: Column) -> Column:
    """Hyphens to blanks, digits removed, words capitalised."""
    return F.initcap(F.trim(F.regexp_replace(F.replace(text, F.lit("-"), F.lit(" ")), "[0-9]", "")))


def url_clean(url: Column) -> Column:
    """Keep what follows the last ``r=``, cut at an encoded ``?``, decode.

    A plus sign stays a plus sign; text with a broken escape stays as it is.
    """
    target = F.regexp_replace(F.regexp_replace(url, ".*r=", ""), "%3F.*", "")
    decoded = F.try_url_decode(F.replace(target, F.lit("+"), F.lit("%2B")))
    return F.coalesce(decoded, target)


def url_path(url: Column) -> Column:
    """Path of a URL without scheme, host, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, "^[a-z]+://[^/]*", ""), "[?#].*$", "")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1)


def segment(text: Column, index: int, sep: str = "/") -> Column:
    """The index-th part; counted from the right when negative; NULL if absent."""
    return F.try_element_at(F.split(text, f"[{sep}]"), F.lit(index + 1 if index >= 0 else index))


def rest_after(text: Column, count: int, sep: str = "/") -> Column:
    """Everything after the count-th separator; NULL if there are fewer."""
    return F.try_element_at(F.split(text, f"[{sep}]", count + 1), F.lit(count + 1))


def dotted_ids(url: Column) -> tuple[Column, Column]:
    """(shop id, product id): the last two dot separated parts of a URL."""
    return segment(url, -2, "."), segment(url, -1, ".")


def url_prefix(prefix: str, part: Column) -> Column:
    """Prefix a stored key with its base address; NULL stays NULL."""
    return F.concat(F.lit(prefix), part)


def _hashed(text: Column, hashed: bool) -> Column:
    return F.sha2(text, 256) if hashed else text


def phone_list(text: Column) -> Column:
    """Array of phone candidates in free text, in order of appearance."""
    squeezed = F.regexp_replace(text, "[-. ]", "")
    starts = "|".join(PHONE_PREFIXES)
    return F.filter(
        F.regexp_extract_all(squeezed, F.lit("[0-9]+"), F.lit(0)),
        lambda run: run.rlike(f"^({starts})") & (F.length(run) >= PHONE_MIN_DIGITS),
    )


def extract_phones(text: Column, hashed: bool = False) -> Column:
    """Comma joined phone candidates, NULL when there are none."""
    joined = F.nullif(F.array_join(phone_list(text), ","), F.lit(""))
    return _hashed(joined, hashed)


def phone_from_link(link: Column, hashed: bool = False) -> Column:
    """Digit runs in the 20 characters from the first country prefix."""
    at = F.locate(LINK_PHONE_PREFIX, link)
    window = F.substring(link, at, F.lit(LINK_PHONE_WINDOW))
    runs = F.array_join(F.regexp_extract_all(window, F.lit("[0-9]+"), F.lit(0)), ",")
    return _hashed(F.when(at > 0, runs), hashed)


def pack(*parts: Column, sep: str = " | ") -> Column:
    return F.concat_ws(sep, *parts)


def unpack(text: Column, index: int, sep: str = " | ") -> Column:
    return F.try_element_at(F.split(text, f"\\Q{sep}\\E"), F.lit(index + 1))


def spec_text(specs: Column) -> Column:
    return F.array_join(specs, " | ")


def spec_origin(specs: Column, word: str = "Dari") -> Column:
    """What follows ``Dari`` in the last specification line."""
    last = F.try_element_at(specs, F.lit(-1))
    return F.try_element_at(F.split(last, word), F.lit(2))


def seller_type(badge: Column, mall_mark: Column) -> Column:
    """Badge text when there is one, else mall, else neither."""
    return (
        F.when(F.length(badge) > 0, badge)
        .when(mall_mark.isNotNull() & (mall_mark != ""), "Mall")
        .otherwise("not Star or Mall")
    )
