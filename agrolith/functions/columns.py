"""Column functions: text, dates and seasons, numbers, arrays. All compile to built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType

#: Month names as they stand in titles.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Three-month seasons and the predictor season of a target season.
SEASONS = ("DJF", "JFM", "FMA", "MAM", "AMJ", "MJJ", "JJA", "JAS", "ASO", "SON", "OND", "NDJ")
PREDICTOR = {"MAM": "DJF", "OND": "JAS"}


# text


def norm(text: Column) -> Column:
    """White space collapsed, lower case, '-' to blank, apostrophes and dots dropped, trimmed."""
    return F.trim(F.translate(F.lower(F.regexp_replace(text, r"\s+", " ")), "-'.", " "))


def alias(text: Column, names: dict[str, str]) -> Column:
    """The alias of a value, or the value."""
    if not names:
        return text
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.coalesce(table[text], text)


def first_upper(text: Column) -> Column:
    """The first letter in upper case, the rest as it is."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))


def tail_after(text: Column, mark: str) -> Column:
    """What follows the last mark."""
    return F.substring_index(text, mark, -1)


def outside_parentheses(text: Column) -> Column:
    return F.regexp_extract(text, r"^(.*?)\s*\((.*)\)", 1)


def inside_parentheses(text: Column) -> Column:
    return F.regexp_extract(text, r"^(.*?)\s*\((.*)\)", 2)


def fill_template(template: Column, values: dict[str, Column], left: str = ":::", right: str = ":::") -> Column:
    """Every `:::name:::` (blanks around the name allowed) replaced by its value; a null value becomes empty."""
    out = template
    for name, value in values.items():
        safe = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"([\\$])", r"\\$1")
        out = F.regexp_replace(out, F.lit(rf"\Q{left}\E\s*\Q{name}\E\s*\Q{right}\E"), safe)
    return out


def with_fallback(value: Column, fallback: Column, kind: DataType, other: DataType) -> Column:
    """value with what it lacks taken from fallback, field by field at any depth; kind and other are their types. Maps
    take the keys that they lack, anything but a struct or map is taken whole."""
    if isinstance(kind, MapType) and isinstance(other, MapType):
        return F.when(value.isNull(), fallback).otherwise(F.map_concat(F.map_filter(fallback, lambda k, _: ~F.map_contains_key(value, k)), F.map_filter(value, lambda _, v: v.isNotNull())))
    if not (isinstance(kind, StructType) and isinstance(other, StructType)):
        return F.coalesce(value, fallback)
    names = list(dict.fromkeys([*kind.names, *other.names]))
    fields = []
    for name in names:
        if name not in other.names:
            fields.append(value[name].alias(name))
        elif name not in kind.names:
            fields.append(fallback[name].alias(name))
        else:
            fields.append(with_fallback(value[name], fallback[name], kind[name].dataType, other[name].dataType).alias(name))
    return F.struct(*fields)


def localised(texts: Column, language: str, fallback: str = "en") -> Column:
    """An entry of a language -> text map, with a fallback language."""
    return F.coalesce(texts[language], texts[fallback])


def strip_tags(html: Column) -> Column:
    """Tags to blanks, the five XML entities and nbsp resolved, white space collapsed."""
    text = F.regexp_replace(html, r"<[^>]*>", " ")
    for entity, letter in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(letter))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def escape_html(text: Column) -> Column:
    for letter, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(letter), F.lit(entity))
    return text


def number_tokens(text: Column) -> Column:
    """All numbers of a text as they stand, thousands separators removed."""
    found = F.regexp_extract_all(text, F.lit(r"(-?[0-9][0-9,]*(?:\.[0-9]+)?)"), F.lit(1))
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")))


def numbers_in(text: Column) -> Column:
    return F.transform(number_tokens(text), lambda x: x.cast("double"))


def numeric_cell(text: Column) -> Column:
    """A table cell as a number; dashes, blanks and the usual marks of missing values are null, and so is text."""
    bare = F.trim(text)
    missing = F.lower(bare).isin("", "-", "–", "—", "n/a", "na", "..")
    return F.when(~missing, F.replace(bare, F.lit(","), F.lit("")).try_cast("double"))


def cell_kind(text: Column) -> Column:
    """number, missing or text."""
    bare = F.trim(text)
    missing = text.isNull() | F.lower(bare).isin("", "-", "–", "—", "n/a", "na", "..")
    return F.when(missing, "missing").when(numeric_cell(text).isNotNull(), "number").otherwise("text")


def leading_name(text: Column) -> Column:
    """The tokens before the first one that has a digit or is a dash."""
    tokens = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    stop = F.array_position(F.transform(tokens, lambda x: x.rlike("[0-9]") | x.isin("-", "–", "—")), True)
    return F.concat_ws(" ", F.when(stop > 0, F.slice(tokens, F.lit(1), (stop - 1).cast("int"))).otherwise(tokens))


def numeric_rest(text: Column) -> Column:
    """The tokens from that one on."""
    tokens = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    stop = F.array_position(F.transform(tokens, lambda x: x.rlike("[0-9]") | x.isin("-", "–", "—")), True)
    return F.when(stop > 0, F.slice(tokens, stop.cast("int"), F.size(tokens))).otherwise(F.array().cast("array<string>"))


def wrap_words(text: Column, width: int) -> Column:
    """Lines of at most width characters, broken at blanks; a longer word stands alone."""
    words = F.split(text, " ")
    fits = lambda line, word: F.length(F.element_at(F.split(line, "\n"), -1)) + 1 + F.length(word) <= width
    return F.aggregate(words, F.lit(""), lambda line, word: F.when(line == "", word).when(fits(line, word), F.concat(line, F.lit(" "), word)).otherwise(F.concat(line, F.lit("\n"), word)))


def composite_key(*parts: Column, mark: str = "||") -> Column:
    """Parts joined by a mark; a null part counts as empty and keeps its place."""
    return F.concat_ws(mark, *(F.coalesce(part.cast("string"), F.lit("")) for part in parts))


def drop_trailing_year(text: Column) -> Column:
    return F.regexp_replace(text, r",?\s*\d{4}$", "")


def paragraphs(text: Column) -> Column:
    """Non-empty lines, trimmed."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def first_match(text: Column, patterns: list[str]) -> Column:
    """Group 1 of the first pattern that matches."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")) for pattern in patterns))


def folded_contains(text: Column, query: str) -> Column:
    """Whether text holds query, accents and case aside."""
    return F.contains(F.collate(text, "UNICODE_CI_AI"), F.collate(F.lit(query), "UNICODE_CI_AI"))


def citation(*parts: Column) -> Column:
    """Present parts, each ended by a dot, joined by blanks."""
    dotted = [F.when(F.trim(part) != "", F.concat(F.regexp_replace(F.trim(part), r"\.+$", ""), F.lit("."))) for part in parts]
    return F.concat_ws(" ", *dotted)


def without_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^./]+$", "")


def prefix_code(code: Column, size: int) -> Column:
    """The leading characters, such as a place code's parent."""
    return F.substring(code, 1, size)


def tail_in(text: Column, mark: str, known: list[str]) -> Column:
    """What follows the last mark if it is one of the known, else null; a text without the mark has no tail."""
    tail = tail_after(text, mark)
    return F.when(F.contains(text, F.lit(mark)) & tail.isin(*known), tail)


def matches_form(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(pattern), F.lit(False))


#: Forms of identifiers and of dates in headers.
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
HEADER = r"^[A-Z]{1,4}[0-9]{1,3}(?:\.[0-9]+)*$"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


# dates and seasons


def dekad_month(dekad: Column) -> Column:
    """Month of a ten-day period numbered from 1; 37 is the next year's first."""
    return (F.floor((dekad - 1) / 3) % 12 + 1).cast("int")


def month_segments(first: Column, last: Column) -> Column:
    """One (m_start, m_end) segment, or two where the range passes the year's end."""
    one = F.array(F.struct(first.alias("m_start"), last.alias("m_end")))
    two = F.array(F.struct(first.alias("m_start"), F.lit(12).alias("m_end")), F.struct(F.lit(1).alias("m_start"), last.alias("m_end")))
    return F.when(first <= last, one).otherwise(two)


def period_of(title: Column) -> tuple[Column, Column, Column]:
    """(year, month, basis) from free text: month and year in either order, or a year alone, or unparsed."""
    low, names = F.lower(title), "|".join(MONTHS)
    month_year = F.regexp_extract(low, rf"\b({names})\b\W+(?:\d{{1,2}}\W+)?((?:19|20)\d\d)\b", 0)
    year_month = F.regexp_extract(low, rf"\b((?:19|20)\d\d)\b\W+({names})\b", 0)
    year_only = F.regexp_extract(low, r"\b((?:19|20)\d\d)\b", 1)
    basis = F.when(month_year != "", "month-year").when(year_month != "", "year-month").when(year_only != "", "year-only").otherwise("unparsed")
    source = F.when(month_year != "", month_year).otherwise(year_month)
    year = F.nullif(F.when(source != "", F.regexp_extract(source, r"((?:19|20)\d\d)", 1)).otherwise(year_only), F.lit("")).try_cast("int")
    month = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(source, f"({names})", 1)).cast("int"), F.lit(0))
    return year, month, basis


def year_month_text(year: Column, month: Column) -> Column:
    return F.when(month.isNull(), F.format_string("%04d", year)).otherwise(F.format_string("%04d-%02d", year, month))


def is_after(year: Column, month: Column, other_year: Column, other_month: Column) -> Column:
    return F.struct(year, month) > F.struct(other_year, other_month)


def crop_year(label: Column) -> Column:
    """The calendar year in which a crop year such as 2019/20 or 2019/2020 ends; a plain year is its own."""
    first, last = F.regexp_extract(label, r"^\s*([0-9]{4})", 1).try_cast("int"), F.regexp_extract(label, r"/\s*([0-9]{2,4})\s*$", 1).try_cast("int")
    century = F.floor(first / 100) * 100
    short = F.when(century + last < first, century + 100 + last).otherwise(century + last)
    return F.when(last.isNull(), first).when(last >= 1000, last).otherwise(short).cast("int")


def predictor_season(season: Column) -> Column:
    """The season whose state is known before a target season; null where there is none."""
    return F.create_map(*(F.lit(x) for pair in PREDICTOR.items() for x in pair))[season]


def season_of(month: Column) -> Column:
    """The label of the three months around a month."""
    return F.element_at(F.array(*map(F.lit, SEASONS)), month.cast("int"))


def from_epoch_ms(value: Column) -> Column:
    return F.timestamp_millis(value.cast("long"))


#: Forms in which a date may be written, each a pattern of the date parser.
DATE_FORMS = ("yyyy", "yyyy-MM", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "M/d/yyyy", "M/d/yy", "M/d/yyyy HH:mm", "M/d/yyyy HH:mm:ss")


def parse_date(text: Column) -> Column:
    """A time in one of DATE_FORMS; anything else is null."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(form)) for form in DATE_FORMS))


def age_state(last: Column, today: Column, allowed_days: Column) -> Column:
    return F.when(F.datediff(today, last) <= allowed_days, "fresh").otherwise("late")


# numbers


def percent_anomaly(value: Column, mean: Column) -> Column:
    """(value - mean) / mean in percent; null where the mean is 0."""
    return F.try_divide(value - mean, mean) * 100


def percent_of(value: Column, whole: Column) -> Column:
    return F.try_divide(value, whole) * 100


def rounded(value: Column, digits: int, policy: str = "sql") -> Column:
    """The library's rounding: "sql" takes halves away from zero, "even" to the even neighbour."""
    if policy not in ("sql", "even"):
        raise ValueError(f"unknown rounding {policy!r}")
    return F.round(value, digits) if policy == "sql" else F.bround(value, digits)


def dominant_class(shares: dict[str, Column]) -> Column:
    """The name of the largest share, the first of equal ones; null where none is above 0."""
    top = F.greatest(*(F.coalesce(s, F.lit(0.0)) for s in shares.values()))
    out = F.when(F.lit(False), "")
    for name, share in shares.items():
        out = out.when((share == top) & (top > 0), name)
    return out


def min_max(value: Column, low: Column, high: Column) -> Column:
    """0 to 1 between two bounds; null where they are equal."""
    return F.try_divide(value - low, high - low)


def priority_of(key: Column, ranks: dict[str, int]) -> Column:
    """The rank of a class key; null if it has none."""
    return F.create_map(*(F.lit(x) for pair in ranks.items() for x in pair))[key]


def significant(value: Column, digits: int) -> Column:
    """Rounded to so many significant digits."""
    power = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(value))))
    return F.when(value == 0, F.lit(0.0)).otherwise(F.round(value * power) / power)


def usd(value: Column) -> Column:
    """Compact, with a sign before the mark: -$1.2K."""
    return F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), F.lit("$"), compact_number(F.abs(value)))


def tolerant_equal(a: Column, b: Column, absolute: float, relative: float) -> Column:
    return F.abs(a - b) < F.greatest(F.lit(absolute), F.abs(a) * relative)


def product_holds(quantity: Column, price: Column, value: Column, absolute: float = 2.0, relative: float = 0.02) -> Column:
    return F.abs(quantity * price - value) <= F.greatest(F.lit(absolute), F.abs(value) * relative)


def ratio_within(a: Column, b: Column, low: float = 0.25, high: float = 4.0) -> Column:
    return F.try_divide(a, b).between(low, high)


def scaled_by(value: Column, kind: Column, factors: dict[str, float]) -> Column:
    """value times its kind's factor; null for an unknown kind."""
    return value * F.create_map(*(F.lit(x) for pair in factors.items() for x in pair))[kind]


def clamp_percent(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), value))


def band(position: Column, size: int = 8) -> Column:
    """Positions rounded half-even to a grid."""
    return F.bround(position / size) * size


def class_between(value: Column, breaks: list[float], names: list[str]) -> Column:
    """names[i] where breaks[i - 1] <= value < breaks[i]."""
    out = reduce(lambda kept, step: kept.when(value < step[0], step[1]), zip(breaks, names, strict=False), F.when(F.lit(False), ""))
    return F.when(value.isNotNull(), out.otherwise(names[-1]))


def two_way_class(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit(" × "), b)


def compact_number(value: Column) -> Column:
    """1.2K, 3.4M, 5.6B."""
    size = F.abs(value)
    text = lambda by, unit: F.concat(F.regexp_replace(F.format_number(value / by, 1), r"\.0$", ""), F.lit(unit))
    return F.when(size >= 1e9, text(1e9, "B")).when(size >= 1e6, text(1e6, "M")).when(size >= 1e3, text(1e3, "K")).otherwise(text(1.0, ""))


def geometric_mean(*parts: Column) -> Column:
    """Null where a part is null or negative, 0 where one is 0."""
    good = reduce(lambda a, b: a & b, (part >= 0 for part in parts))
    return F.when(good, F.pow(reduce(lambda a, b: a * b, parts), F.lit(1 / len(parts))))


# arrays


def filled(cells: Column) -> Column:
    return F.size(F.filter(cells, lambda x: x.isNotNull()))


def padded(cells: Column, size: int) -> Column:
    """Cut or filled with nulls to a size."""
    return F.slice(F.concat(cells, F.array_repeat(F.lit(None).cast("double"), size)), 1, size)


def column_sums(rows: Column, size: int) -> Column:
    """Sums by position over an array of arrays; a null adds nothing."""
    zero = F.array_repeat(F.lit(0.0), size)
    return F.aggregate(rows, zero, lambda total, row: F.zip_with(total, row, lambda a, b: a + F.coalesce(b, F.lit(0.0))))


def by_layout(cells: Column, layout: list[tuple[str, int]]) -> Column:
    """Cells in the order of a layout to structs (metric, year, value); cells beyond the layout are dropped, missing ones
    give null values."""
    places = F.array(*(F.struct(F.lit(metric).alias("metric"), F.lit(year).alias("year")) for metric, year in layout))
    return F.transform(places, lambda place, at: F.struct(place["metric"].alias("metric"), place["year"].alias("year"), F.get(cells, at).alias("value")))


def balanced_slice(text: Column, start: Column, left: str = "{", right: str = "}") -> Column:
    """From the first left brace at or behind start (from 1) to the right one that closes it; braces within double quotes
    don't count; null if it isn't closed."""
    first = F.instr(F.substr(text, start), left) + start - 1
    rest = F.when(F.instr(F.substr(text, start), left) > 0, F.substr(text, first))
    state = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(s: Column, letter: Column) -> Column:
        quote = (letter == '"') & ~s["escaped"]
        depth = F.when(s["quoted"] | (s["end"] > 0), s["depth"]).otherwise(s["depth"] + F.when(letter == left, 1).when(letter == right, -1).otherwise(0))
        at = s["at"] + 1
        end = F.when(s["end"] > 0, s["end"]).when((letter == right) & ~s["quoted"] & (depth == 0), at).otherwise(F.lit(0))
        return F.struct(depth.alias("depth"), (s["quoted"] != quote).alias("quoted"), (s["quoted"] & (letter == "\\") & ~s["escaped"]).alias("escaped"), at.alias("at"), end.alias("end"))

    end = F.aggregate(F.split(rest, ""), state, step, lambda s: s["end"])
    return F.when(end > 0, F.substr(rest, F.lit(1), end))


def length_prefixed(parts: Column) -> Column:
    return F.concat_ws("", F.transform(parts, lambda x: F.concat(F.length(x), F.lit("|"), x)))
