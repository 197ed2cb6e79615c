"""Word normalisers, dictionary matching, censoring, mute windows and timecodes, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_word(w: Column) -> Column:
    """Lower-case, one letter for its variant, word characters only (underscore included)."""
    return F.regexp_replace(F.replace(F.lower(w), F.lit("ё"), F.lit("е")), r"[^\p{L}\p{N}_]+", "")


def norm_key(w: Column) -> Column:
    """Like norm_word, but Latin, Cyrillic and digits only."""
    return F.regexp_replace(F.replace(F.lower(w), F.lit("ё"), F.lit("е")), "[^0-9a-zа-я]", "")


def clean_word(w: Column) -> Column:
    """Lower-case; Latin, Cyrillic with ё, and digits only."""
    return F.regexp_replace(F.lower(w), "[^0-9a-zа-яё]", "")


def marker_word(w: Column) -> Column:
    return F.trim(F.replace(F.lower(w), F.lit("ё"), F.lit("е")))


def is_bad(w: Column, bad: list[str], ok: list[str]) -> Column:
    """A bad stem is contained and no allowed stem is; empty words are not bad."""
    n = norm_word(w)
    has = lambda stems: F.exists(F.array(*(F.lit(s) for s in stems)), lambda s: F.contains(n, s)) if stems else F.lit(False)
    return (n != "") & ~has(ok) & has(bad)


def censor(w: Column) -> Column:
    """Replace the character in the middle (the second of a word of one to three) by an asterisk."""
    at = F.greatest(F.lit(1), F.floor(F.length(w) / 2)).cast("int")
    return F.when(F.length(w) > 0, F.concat(F.substring(w, F.lit(1), at), F.lit("*"), F.substring(w, at + 2, F.length(w)))).otherwise(w)


def mute_bounds(start: Column, end: Column, w: Column, frac: float = 0.40, least_us: int = 150_000) -> tuple[Column, Column]:
    """(from, to) in microseconds around the middle letter, inside the word."""
    n, d = F.length(w), end - start
    m = F.greatest(F.lit(1), F.floor(n / 2))
    centre = start + d * (m + 0.5) / n
    half = F.greatest(d * frac, F.lit(least_us)) / 2
    to_us = lambda c: F.floor(c).cast("long")
    return F.greatest(to_us(centre - half), start), F.least(to_us(centre + half), end)


def clock(seconds: Column, brackets: bool = False) -> Column:
    """HH:MM:SS of whole seconds; negative counts as zero."""
    s = F.greatest(F.lit(0), F.floor(seconds)).cast("long")
    pad = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    out = F.concat(F.when(s < 360000, pad(F.floor(s / 3600))).otherwise(F.floor(s / 3600).cast("string")), F.lit(":"), pad(F.floor(s / 60) % 60), F.lit(":"), pad(s % 60))
    return F.concat(F.lit("["), out, F.lit("]")) if brackets else out


def parse_clock(text: Column) -> Column:
    """H:M:S to whole seconds."""
    p = F.split(text, ":")
    return F.element_at(p, 1).cast("long") * 3600 + F.element_at(p, 2).cast("long") * 60 + F.element_at(p, 3).cast("long")


def parse_ranges(text: Column) -> Column:
    """`a-b, c-d` to array<struct<a,b>>; an entry without a dash is an error."""
    parts = F.filter(F.transform(F.split(text, ","), F.trim), lambda x: x != "")
    return F.transform(parts, lambda x: F.when(F.contains(x, F.lit("-")), F.struct(F.split_part(x, F.lit("-"), F.lit(1)).cast("double").alias("a"), F.split_part(x, F.lit("-"), F.lit(2)).cast("double").alias("b"))).otherwise(F.raise_error(F.concat(F.lit("no range: "), x))))


def clock_rounded(seconds: Column) -> Column:
    """HH:MM:SS of seconds rounded to the nearest, halves to the even one."""
    return clock(F.bround(seconds))


def clock_hundredths(seconds: Column) -> Column:
    """H:MM:SS.cc of seconds rounded to hundredths; negative counts as zero."""
    c = F.greatest(F.lit(0), F.bround(seconds * 100)).cast("long")
    pad = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    return F.concat(F.floor(c / 360_000).cast("string"), F.lit(":"), pad(c / 6000 % 60), F.lit(":"), pad(c / 100 % 60), F.lit("."), pad(c % 100))


def table_cell(text: Column) -> Column:
    """Text for a Markdown cell: bars escaped, line breaks as blanks; a dash for none."""
    one = F.trim(F.regexp_replace(F.replace(text, F.lit("|"), F.lit("\\|")), r"[\r\n]+", " "))
    return F.when(F.coalesce(one, F.lit("")) == "", F.lit("—")).otherwise(one)


def html(text: Column) -> Column:
    """Text inside an HTML element: ampersands and angle brackets escaped; null stays null."""
    out = text
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def frame_number(seconds: Column, rate: int = 60) -> Column:
    """The nearest frame or sample; halves go to the even one."""
    return F.bround(seconds * rate).cast("long")


def decibels(text: Column, key: str) -> Column:
    """The number after `key:` and before ` dB`; -999 for minus infinity, null if there is none."""
    found = F.regexp_extract(text, key + r":\s*(-?[\w.]+) dB", 1)
    return F.when(F.startswith(found, F.lit("-inf")), F.lit(-999.0)).otherwise(found.try_cast("double"))


def last_loudness(text: Column) -> Column:
    """The last integrated loudness of a log, in LUFS."""
    found = F.regexp_extract_all(text, F.lit(r"I:\s*(-?\d+(?:\.\d+)?)\s*LUFS"), 1)
    return F.get(found, F.size(found) - 1).try_cast("double")


def last_block(text: Column, key: str) -> Column:
    """The last flat JSON object of a text that names `key`; null if none does."""
    blocks = F.filter(F.regexp_extract_all(text, F.lit(r"(\{[^{}]*\})"), 1), lambda b: F.contains(b, F.lit(key)))
    return F.get(blocks, F.size(blocks) - 1)


def channel_name(text: Column) -> Column:
    """A channel's name: without the leading @, lower-case; null if it is not 3 to 25 of letters, digits and underscores."""
    name = F.lower(F.regexp_replace(F.trim(text), "^@", ""))
    return F.when(name.rlike("^[a-z0-9_]{3,25}$"), name)


def clip_name(name: Column) -> Column:
    """The name of a tightened clip."""
    return F.regexp_replace(name, "^exp_", "tt_")


def whole_seconds(timecode: Column) -> Column:
    """A timecode without its fraction; null and empty ones are unknown."""
    return F.when(F.coalesce(timecode, F.lit("")) == "", F.lit("unknown")).otherwise(F.split_part(timecode, F.lit("."), F.lit(1)))


def live_flag(json: Column, path: str) -> Column:
    """Three-valued: whether the JSON path holds a value that isn't null; null if the text is no JSON object."""
    return F.when(json.rlike(r"^\s*\{.*\}\s*$"), F.get_json_object(json, path).isNotNull())


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def progress(t: Column, a: float, b: float) -> Column:
    """0 before a, 1 after b, linear between."""
    return clamp((t - a) / (b - a))


def ease_out(x: Column) -> Column:
    return 1 - F.pow(1 - x, F.lit(3))


def ease_in_out(x: Column) -> Column:
    return 0.5 - 0.5 * F.cos(F.pi() * x)


def typed(t: Column, start: float, rate: float) -> Column:
    """Characters typed by time t."""
    return F.floor(F.greatest(F.lit(0.0), t - start) * rate)


def menu_step(t: Column, start: float, step: float, last: int = 3) -> Column:
    """0 before `start`, then one more each `step`, up to `last`."""
    return F.when(t < start, F.lit(0)).otherwise(F.least(F.lit(last), 1 + F.floor((t - start) / step)))


def even_height(w: Column, h: Column, width: int) -> Column:
    """The even height of a picture of w by h that is shown `width` wide."""
    return (2 * F.bround(h * width / (2.0 * w))).cast("long")


def title_cut(text: Column, most: int) -> Column:
    """A title of over `most` characters in two lines, at the blank nearest the middle (the earlier of two)."""
    size = F.length(text)
    # the last blank up to the middle, and the first one behind it; 0 where there is none
    half = F.floor(size / 2).cast("int") + 1
    back = F.instr(F.reverse(F.substring(text, F.lit(1), half)), " ")
    ahead = F.instr(F.substring(text, half + 1, size), " ")
    left, right = half - back + 1, half + ahead
    away = lambda i: F.abs(i - 1 - size / 2.0)
    near = F.when((back > 0) & ((ahead == 0) | (away(left) <= away(right))), left).when(ahead > 0, right)
    two = F.array(F.substring(text, F.lit(1), near - 1), F.substring(text, near + 1, size))
    return F.when((size <= most) | near.isNull(), F.array(text)).otherwise(two)


def wrapped(words: Column, width: int) -> Column:
    """Lines of words that fit `width` characters with blanks; a longer word is a line of its own."""
    kind = "struct<lines:array<string>,line:string>"

    def step(acc, w):
        full = F.length(acc["line"]) + 1 + F.length(w) > width
        done = F.when(full, F.concat(acc["lines"], F.array(acc["line"]))).otherwise(acc["lines"])
        return F.struct(done.alias("lines"), F.when(acc["line"].isNull() | full, w).otherwise(F.concat(acc["line"], F.lit(" "), w)).alias("line")).cast(kind)

    return F.aggregate(words, F.expr(f"cast(named_struct('lines', array(), 'line', null) as {kind})"), step, lambda acc: F.when(acc["line"].isNull(), acc["lines"]).otherwise(F.concat(acc["lines"], F.array(acc["line"]))))


#: The named colours of rich lines.
COLOURS = ["WHITE", "YELLOW", "ORANGE", "RED", "BLACK"]


def rich_line(line: Column) -> Column:
    """array<struct<text, colour>>: parts between bars; `@NAME` or `@#RRGGBB` colours one, others are white; empty ones go."""
    def part(x: Column) -> Column:
        name = F.trim(F.regexp_extract(x, "@(.*)$", 1))
        colour = F.when(F.upper(name).isin(COLOURS), F.upper(name)).when(name.rlike("^#.{6}$"), name).otherwise("WHITE")
        return F.struct(F.split_part(x, F.lit("@"), F.lit(1)).alias("text"), colour.alias("colour"))

    return F.filter(F.transform(F.split(line, r"\|"), part), lambda p: p["text"] != "")
