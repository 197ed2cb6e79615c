"""PII: detected entities get keyed surrogates of the same type, format, script and gender.

Emails, phone numbers, card and account numbers, social security numbers, IP addresses and
secrets are replaced by a keyed permutation of the strings of the same format: digits become
digits of the same script, hexadecimal stays hexadecimal, letters keep their case and script. A permutation has no collisions
and no fixed points, so different entities stay different, an entity has one surrogate in all
documents, and none stays as it was. Long entities are exchanged in blocks of `BLOCK` characters,
each under a key that depends on all characters before it, which is a permutation again. Card
numbers keep their check digit's validity.

Names are found after titles (one or several, in small or all capital letters, any white space
behind them), with initials, particles, apostrophes and hyphens, however many words they have; days
and months end them. The names found in a document are its persons. `Mrs Doe` is the
document's one person of that surname whose gender fits, and every later or earlier mention of a
person's full name or surname, with or without title, gets that person's surrogate. A surrogate
keeps script, number of words and the gender that the person's titles tell; it is drawn by keyed
hash from given names and invented surnames, the surname from the name alone, so it is the same in
all documents. As that can collide, all distinct persons of the corpus are checked by a grouped
count, and the key is changed until no two share a surname. Initials become initials, particles stay,
and words of scripts other than Latin and Cyrillic are exchanged within their script.

Defined results: null texts stay null, empty texts empty; text around entities is unchanged, so a
text without entities is unchanged; overlapping finds go to the first and then the longest in the
order of `TYPES`; a surname that two persons of a document fit is a person of its own; a name that
no title ever announces in its document is not found; repeated rows each give a row; whole texts
are read. All other columns are kept.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import map_batches, stored

#: Entity types in order of precedence, and their patterns.
TYPES = {
    "secret": r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|(?=[0-9a-f]*[0-9])[0-9a-f]{24,}|(?=[0-9A-F]*[0-9])[0-9A-F]{32,})\b|(?<=[\"'=:\s])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{32,}={0,2}|\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|(?<=://)[^\s/:@]{1,64}:[^\s/:@]{1,128}@|(?<=password=)[^\s&\"']{4,}|(?<=password: )[^\s\"']{4,}|(?<=passwd=)[^\s&\"']{4,}|(?<=Passwort: )[^\s\"']{4,}",
    "email": r"(?<![\w.+-])\w[\w.+-]*@(?:[^\W_]|-)+(?:\.(?:[^\W_]|-)+)*\.[^\W\d_]{2,}",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "ipv6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*::)(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){1,6}|::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}))(?![\w:]|\.\w)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b(?<=[0-9]{4}|[0-9A-Z]{4})",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w])|(?<![\w.])\+\d{8,14}(?![\w])|(?<![\w./])0\d{2,5}/\d{4,9}(?![\w/])",
}
#: What every match of `TYPES` contains or follows: a digit, an @, the start or the name of a key, or two groups of an
#: address. Texts without any of it can hold no entity but names.
NEEDED = re.compile(r"[\d@]|sk-|gh[pousr]_|AKIA|eyJ|passw|Passw|[A-Fa-f]:[A-Fa-f]")
#: Titles that announce a name, with the gender and script that they tell.
TITLES = {"m": "Mr|Mister|Herr|Monsieur|Señor|Sr|Signor", "f": "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Signora", "n": "Dr|Prof|Professor|Doktor", "cm": "господин|г-н", "cf": "госпожа|г-жа"}
#: Given names by gender and script.
GIVEN = {
    "m": "Adam Alan Albert Anton Benno Carl Daniel David Edgar Emil Erik Felix Franz Georg Henri Hugo Ivan Jonas Karl Louis Lucas Marco Martin Max Nils Oscar Otto Paul Peter Robert Simon Victor".split(),
    "f": "Ada Agnes Alice Alma Anna Berta Carla Clara Cora Diana Edith Elena Elsa Emma Eva Flora Greta Hanna Ida Irma Julia Lena Lucia Maria Martha Nina Nora Olga Paula Rosa Sofia Vera".split(),
    "n": "Alex Andy Ariel Billie Casey Charlie Chris Dana Eden Frankie Gale Jamie Jesse Jordan Jules Kai Kelly Kim Lee Leslie Lou Max Morgan Nicky Noel Pat Robin Sam Sandy Sasha Terry Toni".split(),
    "cm": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Марк Олег Павел Роман Сергей Тимур Юрий".split(),
    "cf": "Алла Анна Вера Галина Дарья Елена Жанна Зоя Инна Лидия Мария Нина Ольга Раиса Тамара Юлия".split(),
}
CONSONANTS = {"latin": "bdfgklmnprstvwzh", "cyrillic": "бвгдзклмнпрстфхц"}
VOWELS = {"latin": "aeio", "cyrillic": "аеио"}
ENTITY = re.compile("|".join(f"(?P<{k}>{v})" for k, v in TYPES.items()))
#: Characters of one exchanged block.
BLOCK = 128
#: Words in front of a surname that stay as they are, and capitalised words that are no names.
PARTICLES = "von vom zu van der den ten ter de del della di da du dos des la le al el bin ibn ben af av".split()
NO_NAMES = frozenset(
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December "
    "Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag Januar Februar März Mai Juni Juli Oktober Dezember And The He She It They Und Der Die Das Er Sie Es Et Le La Il Elle Y El".split()
)
_SPACE = "[ \u00a0]"
#: A capital letter of any script that has them, or a letter of one without.
_FIRST = r"[^\W\d_a-zß-öø-ÿа-ёα-ώ]"
_WORD = rf"{_FIRST}(?:['’]?[^\W\d_])+"
_INITIALS = rf"(?:{_FIRST}\.-?){{1,4}}|{_FIRST}(?= )"
_NEXT = "|".join(f"{v}|{v.upper()}" for v in TITLES.values())
_PART = rf"(?!(?:{_NEXT})(?!\w))(?:(?:{_WORD}|{_INITIALS})(?![\w'’]))"
_TITLE = "|".join(f"(?P<{k}>{v}|{v.upper()})" for k, v in TITLES.items())
NAME = re.compile(rf"(?<!\w)(?:(?:{_TITLE})(?!\w)\.?\s+){{1,4}}(?P<name>(?:(?:{'|'.join(PARTICLES)}){_SPACE}+)*{_PART}(?:(?:{_SPACE}|-)(?:(?:{'|'.join(PARTICLES)}){_SPACE})*{_PART})*)")
#: Words and single other characters: mentions are looked up by them.
PIECE = re.compile(r"\w+|\W")


def named(m: re.Match) -> tuple[str, str]:
    """(name, gender) of a match: titles in front and words from a day, month or other known word on are no part of it."""
    words = re.split(f"({_SPACE}|-)", m["name"])
    end = next((k for k in range(0, len(words), 2) if words[k] in NO_NAMES), len(words))
    name = "".join(words[:end]).rstrip("- \u00a0")
    while re.fullmatch(rf"(?:{'|'.join(PARTICLES)})|.*{_SPACE}(?:{'|'.join(PARTICLES)})", name):  # nothing stands behind a particle
        name = name.rpartition(" ")[0]
    return name, next((k for k in TITLES if k != "n" and m[k]), "n")


def _rounds(key: bytes, tag: str, half: int, value: int, k: int) -> int:
    """`half` pseudo-random bits for a round."""
    seed = f"{len(tag)}|{tag}|{k}|{half}|".encode("utf-8", "surrogatepass") + value.to_bytes(value.bit_length() // 8 + 1, "big")
    digest = hmac.new(key, seed, hashlib.sha512).digest()
    while len(digest) * 8 < half:
        digest += hmac.new(key, digest[-64:] + seed, hashlib.sha512).digest()
    return int.from_bytes(digest, "big") & ((1 << half) - 1)


def permute(key: bytes, tag: str, x: int, n: int, back: bool = False) -> int:
    """A keyed permutation of range(n): a Feistel network of ten rounds, walked until inside."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for k in range(9, -1, -1) if back else range(10):
            if back:
                left, right = right ^ _rounds(key, tag, half, left, k), left
            else:
                left, right = right, left ^ _rounds(key, tag, half, right, k)
        x = left << half | right
        if x < n:
            return x


def exchange(key: bytes, tag: str, x: int, n: int) -> int:
    """A keyed permutation of range(n) without fixed points, for n of 2 or more."""
    if n < 2:
        return x
    shift = 1 + _rounds(key, tag + "|shift", 64, n, 0) % (n - 1)
    return permute(key, tag, (permute(key, tag, x, n) + shift) % n, n, back=True)


def _luhn(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 - k % 2)
        total += v - 9 * (v > 9)
    return -total % 10


@cache
def alphabet(c: str) -> str:
    """The characters that may stand for this one: digits of its script, letters of its case and script."""
    if c.isascii():
        return next((x for x in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c in x), "")
    if c.isdecimal():
        zero = ord(c) - unicodedata.decimal(c)
        return "".join(map(chr, range(zero, zero + 10)))
    if not c.isalnum():
        return ""
    first, kind = ord(c) & ~127, unicodedata.category(c)
    script = lambda x: unicodedata.name(x, "").split(" ")[0]
    return "".join(x for x in map(chr, range(first, first + 128)) if unicodedata.category(x) == kind and script(x) == script(c) and x.isalnum() and not x.isdecimal())


def surrogate(key: bytes, kind: str, value: str) -> str:
    """The surrogate of an entity that isn't a name: another string of the same format."""
    zeros = {alphabet(c) for c in value if c.isdecimal()}
    if kind == "ip" and len(zeros) == 1:  # of several scripts, the digits are exchanged one by one
        parts = [int(p) for p in value.split(".")]
        x = exchange(key, "ip", int.from_bytes(bytes(parts), "big"), 1 << 32)
        return ".".join(map(str, x.to_bytes(4, "big"))).translate(str.maketrans("0123456789", zeros.pop()))
    if kind == "card":
        digits = [c for c in value if c.isdigit()]
        body, check = "".join(digits[:-1]), int(digits[-1])
        new = str(exchange(key, f"card{len(body)}", int(body), 10 ** len(body))).zfill(len(body))
        new += str((_luhn(new) + check - _luhn(body)) % 10)
        left = iter(new)
        return "".join(alphabet(c)[int(next(left))] if c.isdigit() else c for c in value)
    fixed = 0
    if kind == "phone" and value[0] == "+":
        fixed = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", value).end()
    if kind == "iban":
        fixed = 2
    last = value.rfind(".") if kind == "email" else len(value)
    hexa = kind in ("secret", "ipv6") and re.fullmatch("[0-9a-f:]+|[0-9A-F:]+", value)
    sets, shape = [], []
    for k, c in enumerate(value):
        letters = "" if hexa and c == ":" else "0123456789abcdef" if hexa and value == value.lower() else "0123456789ABCDEF" if hexa else alphabet(c)
        if letters and fixed <= k < last:
            sets.append((k, letters))
            shape.append(str(len(letters)))
        else:
            shape.append(c)
    out, tag = list(value), kind + ",".join(shape)
    if len(sets) > BLOCK:
        tag = f"{kind},{len(value)}," + hashlib.sha256(tag.encode("utf-8", "surrogatepass")).hexdigest()
    before = hashlib.sha256()
    for a in range(0, len(sets), BLOCK):
        part = sets[a : a + BLOCK]
        x, n = 0, 1
        for k, letters in part:
            x = x * len(letters) + letters.index(value[k])
            n *= len(letters)
        x = exchange(key, tag if not a else f"{tag}|{a}|{before.hexdigest()}", x, n)
        for k, letters in reversed(part):
            x, r = divmod(x, len(letters))
            out[k] = letters[r]
        before.update("".join(value[k] for k, _ in part).encode("utf-8", "surrogatepass"))
    return "".join(out)


def family(name: str) -> str:
    """The surname: the last word of a name."""
    return re.split(_SPACE, name)[-1]


def name_surrogate(key: bytes, gender: str, value: str, syllables: int) -> str:
    """Given names of the gender and script, and an invented surname; initials, particles and hyphens keep their places."""
    x = int.from_bytes(hmac.new(key, value.encode("utf-8", "surrogatepass"), hashlib.sha512).digest(), "big")
    words = re.split(f"({_SPACE})", value)
    script = "cyrillic" if re.search("[а-яА-ЯёЁ]", value) else "latin"
    given = GIVEN[gender if script == "latin" or gender[0] == "c" else "c" + ("f" if gender == "f" else "m")]
    last = ""
    for _ in range(syllables):
        x, r = divmod(x, 64)
        last += CONSONANTS[script][r % 16] + VOWELS[script][r // 16]
    for k in range(0, len(words), 2):
        word = words[k]
        x, r = divmod(x, len(given))
        if any(c.isalpha() and "LATIN" not in unicodedata.name(c, "") and "CYRILLIC" not in unicodedata.name(c, "") for c in word):
            words[k] = surrogate(key, "name", word)
        elif k == len(words) - 1:
            words[k] = last.upper() if word.isupper() and len(word) > 1 else last.capitalize()
        elif word not in PARTICLES:
            initials = word.count(".")
            new = "-".join(given[(r + j) % len(given)] for j in range(word.count("-") + 1)) if not initials else "".join(given[(r + 7 * j) % len(given)][0] + "." for j in range(initials))
            words[k] = new.upper() if word.isupper() and len(word) > 1 else new
    return "".join(words)


def persons_in(text: str) -> dict[str, tuple[str, str]]:
    """Of each titled name of a text: the gender and the whole name of the person that it means."""
    titled: dict[str, set[str]] = {}
    for m in NAME.finditer(text):
        name, gender = named(m)
        if name:
            titled.setdefault(name, set()).add(gender)
    told = {name: {g for g in genders if g != "n"} for name, genders in titled.items()}
    families: dict[str, list[str]] = {}
    for name in titled:
        if family(name) != name:
            families.setdefault(family(name), []).append(name)
    means = {}
    for name in titled:
        fits = [p for p in families.get(name, []) if not told[name] or not told[p] or told[name] & told[p]]
        means[name] = fits[0] if len(fits) == 1 else name
    for name, person in means.items():  # a surname's titles tell the person's gender too
        told[person] = told[person] | told[name]
    return {name: (min(told[person]) if told[person] else "n", person) for name, person in means.items()}


def names_in(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, gender, whole name, mention) of all mentions of a text's persons."""
    persons = persons_in(text)
    if not persons:
        return []
    known = dict(persons)
    of_family: dict[str, set[str]] = {}
    for _, person in persons.values():
        of_family.setdefault(family(person), set()).add(person)
    for gender, person in persons.values():  # whole names and surnames without title, where one person is meant
        known.setdefault(person, (gender, person))
        last = family(person)
        if last not in known and len(of_family[last]) == 1:
            known[last] = (gender, person)
    # a tree of words, so that a text is read once whatever the number of names
    tree: dict = {}
    for name in known:
        node = tree
        for piece in PIECE.findall(name):
            node = node.setdefault(piece, {})
        node[""] = name
    pieces = [(m.start(), m[0]) for m in PIECE.finditer(text)] + [(len(text), "")]
    out, k = [], 0
    while k < len(pieces) - 1:
        node, j, best = tree, k, None
        while (node := node.get(pieces[j][1]) if pieces[j][1] else None) is not None:
            j += 1
            if "" in node:
                best = (j, node[""])
        if best is None:
            k += 1
            continue
        out.append((pieces[k][0], pieces[best[0]][0], *known[best[1]], best[1]))
        k = best[0]
    return out


def replace(text: str, key: bytes, name_key: bytes, syllables: int) -> tuple[str, list[tuple[str, str, str]]]:
    """(text with surrogates, (type, entity, surrogate) in order)."""
    found = [(m.start(), m.end(), m.lastgroup, m[0], "") for m in ENTITY.finditer(text)] if NEEDED.search(text) else []
    taken = [(a, b) for a, b, *_ in found]
    found += [(a, b, "name " + g, v, whole) for a, b, g, whole, v in names_in(text) if not any(a < d and c < b for c, d in taken)]
    out, at, made = [], 0, []
    for a, b, kind, value, whole in sorted(found):
        if whole:
            new = name_surrogate(name_key, kind[5:], whole, syllables)
            if value != whole:
                new = family(new)
        else:
            new = surrogate(key, kind, value)
        out += [text[at:a], new]
        at = b
        made.append((kind, value, new))
    return "".join([*out, text[at:]]), made


def name_plan(docs: DataFrame, text_col: str, key: bytes) -> tuple[bytes, int]:
    """A key for names under which no two persons of the corpus share a surname, and the surname's syllables.

    The surnames are drawn from a set of at least a hundred times the square of the number of
    names, so a first key nearly always does; the grouped count proves it or asks for another.
    """

    def run(cols):
        names = {(v,) for t in cols[0] if t for _, v in persons_in(t).values()}
        yield [[v for (v,) in names]]

    names = stored(map_batches(docs, [f"`{text_col}`"], run, "name string").distinct(), "names")
    n = names.count()
    syllables = 2
    while 64**syllables < 100 * n * n:
        syllables += 1
    attempt = 0
    while n:
        name_key = hmac.new(key, f"names {attempt}".encode(), hashlib.sha256).digest()

        def assign(cols, name_key=name_key):
            last = [family(v) for v in cols[0]]
            new = [family(name_surrogate(name_key, "n", v, syllables)) for v in cols[0]]
            yield [new, [a == b for a, b in zip(last, new, strict=True)]]

        made = map_batches(names, ["name"], assign, "surname string, same boolean")
        clash = made.groupBy("surname").agg(F.count("*").alias("n"), F.max("same").alias("same")).filter("n > 1 or same")
        if clash.limit(1).count() == 0:
            return name_key, syllables
        attempt += 1
    return hmac.new(key, b"names 0", hashlib.sha256).digest(), syllables


def anonymise(docs: DataFrame, key: bytes, text_col: str = "text", length_col: str | None = "n_chars", report: bool = False, report_cols: tuple[str, str] = ("pii_entities", "pii_types")) -> DataFrame:
    """All columns of `docs` with entities replaced.

    With `report`, also how many were, and their types, in `report_cols`; columns of `docs` that
    have these names are given up for them.
    """
    name_key, syllables = name_plan(docs, text_col, key)
    cols = [c for c in docs.columns if not report or c not in report_cols]
    names = [f"c{k}" for k in range(len(cols))]  # inside, names cannot clash
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(cols, names, strict=True)))
    x, length = cols.index(text_col), cols.index(length_col) if length_col in cols else None
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", n_found long, types array<string>"

    def run(values):
        values, counts, types = [list(v) for v in values], [], []
        for k, t in enumerate(values[x]):
            made = []
            if t:
                values[x][k], made = replace(t, key, name_key, syllables)
                if made and length is not None:
                    values[length][k] = len(values[x][k])
            counts.append(len(made))
            types.append(sorted({kind.split(" ")[0] for kind, _, _ in made}))
        yield [*values, counts, types]

    out = map_batches(rows, names, run, schema).toDF(*cols, *report_cols)
    return out if report else out.toDF(*names, *report_cols).select(*names).toDF(*cols)
