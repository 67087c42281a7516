"""Personal data: entities found in texts give way to keyed surrogates of the same type and format."""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, strings, table, unused_name, with_column_replaced

#: Key of the surrogates where the caller gives none; production runs pass their own secret.
DEFAULT_KEY = "kitchenlens-surrogates"
#: Entities with a second or later choice that are broadcast at most; more are joined by text hash.
MAX_BROADCAST_EXCEPTIONS = 200_000
#: Choices of exactly the same format; later ones may be longer, so that every entity gets one.
SAME_FORMAT = 32

# Forms of address and frequent given names by gender, which find and type persons; words that are no name after one.
TITLES = {"m": ["Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "г-н"],
          "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "госпожа", "г-жа"],
          "n": ["Dr", "Prof", "Professor", "Doctor"]}
DOTTED = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Sr", "Sra", "Srta", "Mme", "Mlle"]
GIVEN = {"m": ["James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Matthew", "Anthony",
               "Steven", "Andrew", "Kenneth", "Kevin", "Brian", "George", "Timothy", "Jason", "Edward", "Jeffrey", "Ryan", "Jacob", "Nicholas", "Eric",
               "Jonathan", "Stephen", "Peter", "Hans", "Jürgen", "Klaus", "Wolfgang", "Stefan", "Andreas", "Pierre", "Jacques", "Jean", "Michel", "Philippe",
               "Carlos", "Juan", "José", "Jose", "Javier", "Miguel", "Antonio", "Luis", "Ahmed", "Mohammed", "Иван", "Сергей", "Дмитрий", "Александр",
               "Γιώργος", "Νίκος"],
         "f": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Lisa", "Nancy", "Sandra", "Ashley",
               "Emily", "Michelle", "Amanda", "Melissa", "Deborah", "Stephanie", "Rebecca", "Laura", "Emma", "Anna", "Ursula", "Sabine", "Petra", "Monika",
               "Marie", "Camille", "Sophie", "Isabelle", "Nathalie", "Carmen", "María", "Maria", "Lucía", "Lucia", "Ana", "Fatima", "Анна", "Мария", "Ольга",
               "Елена", "Μαρία", "Ελένη"]}
NO_NAMES = ["Who", "What", "Which", "The", "And", "Or", "Of", "In", "Is", "Was", "Software", "Engineer", "Engineering", "Manager", "Developer", "Director",
            "Analyst", "Designer", "Consultant", "Architect", "President", "Editor", "Officer", "Scientist", "Accountant", "Administrator", "Technician", "Data",
            "Project", "Product", "Sales", "Marketing", "Research", "University", "College", "School", "Institute", "Hospital", "Street", "Avenue", "Road",
            "Square", "Park", "Airport", "Church", "Foundation", "Award", "Prize", "Library", "Island", "Lake", "River", "County"]
# What comes before a person's name, and before a telephone number written without marks.
INTRODUCTIONS = ["my name is", "name is", "mein name ist", "je m'appelle", "je m’appelle", "me llamo", "mi nombre es", "меня зовут", "signed", "signed by",
                 "written by", "regards", "sincerely", "author:", "contact:"]
CALLS = ["tel", "telephone", "phone", "call", "fax", "mobile", "cell", "whatsapp", "sms", "telefon", "handy", "rufen", "anruf", "téléphone", "portable", "appelez",
         "teléfono", "móvil", "llame", "тел", "телефон"]
# Beginnings of access keys that services give out, and country codes of two digits (1 and 7 have one, all others three).
KEY_BEGINNINGS = ["ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "sk-", "sk_live_", "sk_test_", "rk_live_", "xoxb-", "xoxp-", "xoxa-", "AIza",
                  "hf_", "npm_", "pypi-", "dop_v1_", "SG."]
TWO_DIGIT_CODES = {20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, 43, 44, 45, 46, 47, 48, 49, 51, 52, 53, 54, 55, 56, 57, 58, 60, 61, 62, 63, 64, 65, 66, 81, 82, 84,
                   86, 90, 91, 92, 93, 94, 95, 98}
SYLLABLES = {"latin": ["ba", "bel", "cor", "da", "del", "fen", "ga", "hal", "jo", "kar", "la", "len", "mar", "mi", "nor", "pe", "ra", "ros",
                       "sa", "sel", "ta", "tor", "va", "vin", "wes", "zan"],
             "cyrillic": ["ба", "бел", "ва", "гор", "да", "же", "за", "кар", "ла", "лен", "ма", "мир", "но", "пет", "ра", "сол", "та", "фед"],
             "greek": ["βα", "γα", "δη", "θε", "κα", "λα", "μα", "νι", "πα", "ρο", "σα", "τα", "φι", "χα"]}
ENDINGS = {"latin": {"m": "us", "f": "ina", "n": "en", "surname": "ley"}, "cyrillic": {"m": "ир", "f": "ина", "n": "ен", "surname": "ко"},
           "greek": {"m": "ος", "f": "ίνα", "n": "ις", "surname": "άκης"}}

_EMAIL = re.compile(r"[A-Za-z0-9._%+\-]+@([A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+)")
_IP = re.compile(r"(?<![\w.])(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?!\.?\w)")
_CARD = re.compile(r"(?<![\w])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?!\w)")
#: + or 00 and groups of digits; which of them belong to the number is for ``_plus_phone``.
_PLUS = re.compile(r"(?<![\w+])(?:\+|00(?=[1-9]))\(?\d{1,15}\)?(?:[ .\-/\u00a0]{0,2}\(?\d{1,8}\)?){0,7}")
_NORTH = re.compile(r"(?<![\w+.\-])(?:1[ .\-])?(\([2-9]\d{2}\) ?[2-9]\d{2}[ .\-]\d{4}|[2-9]\d{2}([ .\-])[2-9]\d{2}[ .\-]\d{4})(?![\w\-])")
_TRUNK = re.compile(r"(?<![\w+.,\-/])(?:\(0([1-9]\d{0,4})\)|0([1-9]\d{0,4}))(?:[ .\-/]\d{2,8}){1,5}(?!\w)")
_BARE = re.compile(r"(?<![\w.+\-,/])(?:[2-9]\d{2}[2-9]\d{6}|[6-9]\d{2}(?: \d{3}){2}|[6-9]\d{2}(?: \d{2}){3})(?![\w\-/])")
_CALLED = regex.compile(r"(?i)(?<!\p{L})(?:" + "|".join(map(regex.escape, CALLS)) + r")\p{L}{0,3}\P{N}{1,12}$")
_DIGIT = re.compile(r"[0-9]")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_AWS = re.compile(r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)")
#: What follows = or : up to the closing quote, or to white space.
_ASSIGNED = re.compile(r"[:=][ \t]{0,4}(?:\"([^\"\n]{6,200})\"|'([^'\n]{6,200})'|([^\s\"',;<>]{6,200}))")
_KEYS = re.compile(r"(?<![\w\-.])(" + "|".join(map(re.escape, sorted(KEY_BEGINNINGS, key=len, reverse=True))) + r")([A-Za-z0-9_\-.]{16,200})")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_SECRET_NAME = re.compile(r"(?:pass(?:word|wd|phrase)?|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\s{0,4}$", re.I)
_CAPITAL = regex.compile(r"(?<![\p{L}\p{M}\p{N}])(?:\p{Lu}[\p{L}\p{M}]+|г-(?:н|жа)|господин|госпожа)(?![\p{L}\p{M}])")
_NAME_AFTER = regex.compile(r"[ \u00a0](\p{Lu}[\p{L}\p{M}'’\-]+)")
_INTRODUCED = regex.compile(r"(?i)(?<!\p{L})(?:" + "|".join(map(regex.escape, INTRODUCTIONS)) + r")[,:]?\s{1,3}((?-i:\p{Lu}[\p{L}\p{M}'’\-]+))(?=[ \u00a0](?-i:\p{Lu})\p{L})")
_TITLE_OF = {form: g for g, words in TITLES.items() for w in words for form in (w, w.upper())}
_DOTTED = {form for w in DOTTED for form in (w, w.upper())}
_GIVEN_OF = {w: g for g, words in GIVEN.items() for w in words}
_NO_NAME = {w.casefold() for w in NO_NAMES}


@dataclass(frozen=True)
class Entity:
    """kind, the scope in which surrogates must differ, and the written-form-free value; start and stop in the text."""
    kind: str
    scope: str
    value: str
    start: int
    stop: int


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _country_code(digits: str) -> str:
    return digits[0] if digits[0] in "17" else digits[:2] if int(digits[:2] or 0) in TWO_DIGIT_CODES else digits[:3]


def _plus_phone(text: str, m: re.Match) -> Entity | None:
    """The number with a country code that begins at a match: as many groups of digits as such a number has."""
    groups = [(g.start(), g.end()) for g in re.finditer(r"\d+", text[m.start():m.end()])]
    if text[m.start()] == "0":
        groups[0] = (2, groups[0][1])
    digits = "".join(text[m.start() + a:m.start() + b] for a, b in groups)
    if len(digits) < 8:
        return None
    code = _country_code(digits)
    most, taken, stop = len(code) + (10 if code == "1" else 11), 0, None
    for a, b in groups:
        if taken + b - a > most:
            break
        taken, stop = taken + b - a, m.start() + b
    if stop is None or taken - len(code) < (10 if code == "1" else 7) or text[stop:stop + 1].isalnum():
        return None
    left, start = len(code), None
    for a, b in groups:          # the first digit after the code, with the bracket before it
        if b - a > left:
            start = m.start() + a + left
            break
        left -= b - a
    value = _digits(text[start:stop])
    if text[start - 1] == "(":
        start -= 1
    return Entity("phone", "", value, start, stop)


def _phones(text: str) -> Iterable[Entity]:
    """Numbers with a country code, North American ones, ones with a trunk zero, and ones without marks after a word such as phone.

    The value is the national number without the zero, so the written forms of a number are one entity."""
    if "+" in text or "00" in text:
        for m in _PLUS.finditer(text):
            if (e := _plus_phone(text, m)) is not None:
                yield e
    for m in _NORTH.finditer(text):
        yield Entity("phone", "", _digits(m[1]), m.start(1), m.end(1))
    for m in _TRUNK.finditer(text):
        at = m.start(1) if m[1] else m.start(2)
        value, date = _digits(text[at:m.end()]), re.fullmatch(r"\d\d[./-]\d\d[./-]\d{4}", m[0])
        if 8 <= len(value) <= 11 and not date:
            yield Entity("phone", "", value, at, m.end())
    for m in _BARE.finditer(text):
        alone = text[text.rfind("\n", 0, m.start()) + 1:m.start()].strip() == "" == text[m.end():].split("\n", 1)[0].strip()
        if alone or _CALLED.search(text[max(0, m.start() - 28):m.start()]):
            yield Entity("phone", "", _digits(m[0]), m.start(), m.end())


def _ip6(text: str) -> str | None:
    """The full form of an IPv6 address; None for what is none (times, ratios, ::)."""
    try:
        full = ipaddress.IPv6Address(text).exploded
    except ValueError:
        return None
    # names of code and short ratios have the form too
    return full if sum(g != "0000" for g in full.split(":")) > 1 and _DIGIT.search(text) and any(len(g) > 2 for g in text.split(":")) else None


def _persons(text: str) -> Iterable[Entity]:
    """Names after a form of address, a frequent given name or an introduction, and those an e-mail address of the text repeats."""
    def name(after):
        return after if after and after[1].casefold() not in _NO_NAME else None

    for m in _CAPITAL.finditer(text):
        title, given = _TITLE_OF.get(m[0]), _GIVEN_OF.get(m[0])
        if title is None and given is None:
            continue
        after = name(_NAME_AFTER.match(text, m.end() + (m[0] in _DOTTED and text[m.end():m.end() + 1] == ".")))
        if given is not None and after:
            yield Entity("given_" + given, "", m[0].casefold(), m.start(), m.end())
        while after:
            word, gender = after[1], _GIVEN_OF.get(after[1])
            yield Entity("given_" + gender if gender else "surname", "", word.casefold(), after.start(1), after.end(1))
            after = name(_NAME_AFTER.match(text, after.end())) if gender else None
    for m in _INTRODUCED.finditer(text):
        after = name(_NAME_AFTER.match(text, m.end(1)))
        if after and m[1].casefold() not in _NO_NAME:
            yield Entity("given_" + _GIVEN_OF.get(m[1], "n"), "", m[1].casefold(), m.start(1), m.end(1))
            yield Entity("surname", "", after[1].casefold(), after.start(1), after.end(1))
    if "@" in text:
        for pair in {tuple(re.split(r"[._\-]", m[0].split("@")[0])) for m in _EMAIL.finditer(text)}:
            if len(pair) == 2 and all(len(w) > 2 and w.isalpha() for w in pair):
                for first, last in (pair, pair[::-1]):
                    for m in re.finditer(rf"(?<!\w)({first.capitalize()})[ \u00a0]({last.capitalize()})(?!\w)", text):
                        yield Entity("given_" + _GIVEN_OF.get(m[1], "n"), "", m[1].casefold(), m.start(1), m.end(1))
                        yield Entity("surname", "", m[2].casefold(), m.start(2), m.end(2))


def _found(text: str) -> Iterable[tuple[int, Entity]]:
    """(rank, entity) for all that any pattern finds; a lower rank wins where two overlap."""
    if "@" in text:
        for m in _EMAIL.finditer(text):
            domain = m[1].lower().rstrip(".-")
            local = text[m.start():m.start(1) - 1]
            yield 0, Entity("email", domain, local.lower(), m.start(), m.start(1) + len(domain))
    if "AKIA" in text:
        for m in _AWS.finditer(text):
            yield 0, Entity("aws_key", "", m[0], m.start(), m.end())
    for m in _KEYS.finditer(text):
        if any(c.isdigit() for c in m[2]):
            stop = m.start() + len(m[0].rstrip("-."))
            yield 0, Entity("key", m[1], text[m.start(2):stop], m.start(2), stop)
    if "=" in text or ":" in text:
        for m in _ASSIGNED.finditer(text):
            if _SECRET_NAME.search(text, max(0, m.start() - 24), m.start()):
                group = m.lastindex
                value = m[group] if group < 3 else m[group].rstrip(".!?)]}")
                # a word after a colon is prose ("password: required")
                if len(value) >= 6 and not (group == 3 and text[m.start()] == ":" and value.isalpha() and value[1:].islower()):
                    yield 1, Entity("secret", "", value, m.start(group), m.start(group) + len(value))
        if "::" in text or text.count(":") > 6:
            for m in _IP6.finditer(text):
                if (full := _ip6(m[0])) is not None:
                    yield 1, Entity("ip6", "", full, m.start(), m.end())
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(x) < 256 for x in m.groups()):
                yield 1, Entity("ip", "", ".".join(str(int(x)) for x in m.groups()), m.start(), m.end())
        for m in _CARD.finditer(text):
            if luhn_ok(_digits(m[0])) and m[0][0] != "0":
                yield 1, Entity("card", "", _digits(m[0]), m.start(), m.end())
        for m in _SSN.finditer(text):
            yield 2, Entity("ssn", "", _digits(m[0]), m.start(), m.end())
        for e in _phones(text):
            yield 3, e
        for m in _IBAN.finditer(text):
            plain = m[0].replace(" ", "")
            if 15 <= len(plain) <= 34 and _iban_rest(plain) == 1:
                yield 1, Entity("iban", "", plain, m.start(), m.end())
    for e in _persons(text):
        yield 4, e


def find_entities(text: str | None) -> list[Entity]:
    """Entities of a whole text from left to right; none overlap."""
    out: list[Entity] = []
    for _, e in sorted(_found(text or ""), key=lambda x: (x[1].start, x[0], -x[1].stop)):
        if out and e.start < out[-1].stop:
            continue
        out.append(e)
    return out


class Draw:
    """Keyed random numbers for one choice of one entity's surrogate."""

    def __init__(self, key: str, *what):
        self.key, self.what, self.block, self.pool = key.encode(), "\x1f".join(map(str, what)), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, f"{self.what}\x1f{self.block}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
            self.block += 1
        number, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return number % n

    def like(self, text: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        """Letters for letters of the same case, digits for digits; other characters stay."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                x = letters[self.below(len(letters))]
                out.append(x.upper() if c.isupper() else x)
            else:
                out.append(c)
        return "".join(out)


def script_of(word: str) -> str:
    first = ord(word[0]) if word else 0
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 or 0x1f00 <= first < 0x2000 else "latin"


def surrogate(key: str, kind: str, scope: str, value: str, choice: int) -> str:
    """The ``choice``-th surrogate of a value: of its kind, length and format (after SAME_FORMAT choices longer)."""
    draw = Draw(key, kind, scope, value, choice)
    more = max(0, choice - SAME_FORMAT + 1)
    if kind in ("email", "domain", "aws_key", "secret", "key"):
        if kind == "aws_key":
            return "AKIA" + draw.like(value[4:]) + draw.like("A" * more)
        if kind == "domain":
            head, _, top = value.rpartition(".")
            return draw.like(head) + draw.like("a" * more) + "." + top
        hexes = bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value))
        return draw.like(value + "a" * more, "abcdef" if kind == "secret" and hexes else "abcdefghijklmnopqrstuvwxyz")
    if kind == "ip6":
        groups = value.split(":")
        kept = 4 if value.startswith(("fe80", "fc", "fd", "2001:0db8")) else 1      # of the same sort: local, documentation, public
        kept = min(kept, 2 if value.startswith("2001:0db8") else kept)
        return ":".join(groups[:kept] + [f"{draw.below(65535) + 1:04x}" for _ in groups[kept:]])
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        kept = 1 if octets[0] in (10, 127) else 2 if octets[:2] == [192, 168] or octets[0] == 172 and 16 <= octets[1] < 32 else 0
        if kept:
            fresh = octets[:kept] + [draw.below(256) for _ in range(4 - kept)]
        else:
            fresh = [[x for x in range(1, 224) if x not in (10, 127, 172, 192)][draw.below(219)], *[draw.below(256) for _ in range(3)]]
        return ".".join(map(str, fresh))
    if kind == "card":
        body = value[0] + draw.like(value[1:-1] + "0" * more)
        return next(body + str(d) for d in range(10) if luhn_ok(body + str(d)))
    if kind == "phone":        # the first digits of a part say what number it is: mobile or not, or that it is one
        first = 6 + draw.below(4) if len(value) == 9 and value[0] > "5" else 2 + draw.below(7)
        rest = draw.like(value[1:] + "0" * more)
        return str(first) + (rest[:2] + str(2 + draw.below(8)) + rest[3:] if len(value) == 10 and value[3] > "1" else rest)
    if kind == "ssn":
        return str(2 + draw.below(7)) + draw.like(value[1:] + "0" * more)
    if kind == "iban":
        body = draw.like(value[4:] + "0" * more)
        return f"{value[:2]}{98 - _iban_rest(value[:2] + '00' + body):02d}{body}"
    script, gender = script_of(value), kind.removeprefix("given_")
    parts = SYLLABLES[script]
    word = "".join(parts[draw.below(len(parts))] for _ in range(2 + (len(value) > 6) + more)) + ENDINGS[script][gender]
    return word


def written_like(mention: str, value: str, kind: str) -> str:
    """A surrogate value in the written form of a mention: its separators, its letter case."""
    if kind in ("phone", "card", "ssn"):
        left = list(value)
        out = [left.pop(0) if c.isdigit() and left else c for c in mention]
        return "".join(out + left)
    if kind == "ip6":
        short = ":".join(g.lstrip("0") or "0" for g in value.split(":"))
        return short.upper() if mention.upper() == mention and mention.lower() != mention else short
    if kind == "iban" and " " in mention:
        return " ".join(value[i:i + 4] for i in range(0, len(value), 4))
    if kind.startswith("given_") or kind == "surname":
        return value.upper() if mention.isupper() and len(mention) > 1 else value[0].upper() + value[1:] if mention[:1].isupper() else value
    if kind in ("email", "domain") and len(mention) == len(value):
        return "".join(v.upper() if m.isupper() else v for m, v in zip(mention, value))
    return value


def claims_of(text: str | None) -> set[tuple[str, str, str]]:
    """(kind, scope, value) of all that needs a surrogate in a text: its entities and the domains of its addresses."""
    out = set()
    for e in find_entities(text):
        out.add((e.kind, e.scope, e.value))
        if e.kind == "email":
            out.add(("domain", "", e.scope))
    return out


def rewrite(text: str, key: str, choice_of) -> tuple[str, list[Entity]]:
    """The text with every entity replaced; ``choice_of``(kind, scope, value) says which choice holds."""
    found, out, at = find_entities(text), [], 0

    def chosen(kind, scope, value):
        return surrogate(key, kind, scope, value, choice_of((kind, scope, value)))

    for e in found:
        out.append(text[at:e.start])
        mention = text[e.start:e.stop]
        if e.kind == "email":
            local, domain = mention[:-len(e.scope) - 1], mention[-len(e.scope):]
            out.append(written_like(local, chosen("email", e.scope, e.value), "email") + "@"
                       + written_like(domain, chosen("domain", "", e.scope), "domain"))
        else:
            out.append(written_like(mention, chosen(e.kind, e.scope, e.value), e.kind))
        at = e.stop
    return "".join([*out, text[at:]]), found


def _claims(key: str):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            found = {c for text in strings(batch["text"]) if text for c in claims_of(text)}
            kinds = sorted(found)
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array([k for k, _, _ in kinds], pa.string()), "scope": pa.array([s for _, s, _ in kinds], pa.string()),
                "value": pa.array([v for _, _, v in kinds], pa.string()),
                "fake": pa.array([surrogate(key, *c, 0) for c in kinds], pa.string())})
    return rows


def _next_choice(key: str, choice: int):
    @F.arrow_udf("string")
    def fake(kind: pa.Array, scope: pa.Array, value: pa.Array) -> pa.Array:
        return pa.array([surrogate(key, *c, choice) for c in zip(kind.to_pylist(), scope.to_pylist(), value.to_pylist())], pa.string())
    return fake("kind", "scope", "value")


def resolve_choices(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY) -> DataFrame:
    """(kind, scope, value, choice) of the entities whose first surrogate can't stand; all others take choice 0.

    Collision check: within a kind and scope a surrogate may be no entity of the corpus and may
    belong to one entity only.  The contested goes to the smallest value; the others draw
    again, round by round, until none is contested.  Every round is a grouped minimum and an
    anti join on distributed tables."""
    found = cut_lineage(docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _claims(key), "kind string, scope string, value string, fake string").distinct(), "entities")
    real = found.select("kind", "scope", F.col("value").alias("fake"))
    at = ["kind", "scope", "fake"]

    def winners(pending: DataFrame, taken: DataFrame | None) -> DataFrame:
        best = pending.groupBy(*at).agg(F.min("value").alias("value")).join(real, at, "left_anti")
        return best if taken is None else best.join(taken.select(*at), at, "left_anti")

    taken = cut_lineage(winners(found, None), "surrogates-0")
    pending = cut_lineage(found.join(taken, [*at, "value"], "left_anti").drop("fake"), "contested-0")
    settled, choice = None, 0
    while not pending.isEmpty():
        choice += 1
        drawn = cut_lineage(pending.select("*", _next_choice(key, choice).alias("fake")), f"drawn-{choice}")
        won = cut_lineage(winners(drawn, taken), f"surrogates-{choice}")
        taken = taken.unionByName(won)
        here = won.select("kind", "scope", "value", F.lit(choice).alias("choice"))
        settled = here if settled is None else settled.unionByName(here)
        pending = cut_lineage(pending.join(won, ["kind", "scope", "value"], "left_anti").select("kind", "scope", "value"), f"contested-{choice}")
    if settled is None:
        return docs.sparkSession.createDataFrame([], "kind string, scope string, value string, choice int")
    return cut_lineage(settled, "choices")


OUT = "struct<text:string,entities:array<struct<kind:string,start:long,stop:long>>>"
_OUT = pa.struct([("text", pa.string()), ("entities", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])))])


def _rewritten(key: str, held):
    made: dict = {}

    @F.arrow_udf(OUT)
    def change(texts: pa.Array, own: pa.Array) -> pa.Array:
        if not made:
            made["all"] = dict(held.value)
        rows = []
        for text, extra in zip(strings(texts), own.to_pylist()):
            if text is None:
                rows.append({"text": None, "entities": []})
                continue
            choices = made["all"] if not extra else {(x["kind"], x["scope"], x["value"]): x["choice"] for x in extra}
            new, found = rewrite(text, key, lambda c: choices.get(c, 0))
            rows.append({"text": new, "entities": [{"kind": e.kind, "start": e.start, "stop": e.stop} for e in found]})
        return pa.array(rows, _OUT)
    return change


EXTRA = "array<struct<kind:string,scope:string,value:string,choice:int>>"


def _claim_list():
    @F.arrow_udf("array<struct<kind:string,scope:string,value:string>>")
    def claims(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("kind", "scope", "value"), c)) for c in sorted(claims_of(t))] for t in strings(texts)],
                        pa.list_(pa.struct([("kind", pa.string()), ("scope", pa.string()), ("value", pa.string())])))
    return claims


def with_rewritten(docs: DataFrame, out_col: str = "private", text_col: str = "text", key: str = DEFAULT_KEY,
                   max_broadcast: int = MAX_BROADCAST_EXCEPTIONS) -> DataFrame:
    """``docs`` with struct ``out_col``: text with surrogates, entities (kind, start, stop in the old text).

    A surrogate depends on the key and the entity alone, so the same entity gets the same
    surrogate in every document; the few whose surrogate was contested (``resolve_choices``) are
    broadcast up to ``max_broadcast`` and joined by the text's hash beyond.
    Null texts stay null, texts without entities stay as they are, repeated rows are treated alike; an input column
    named ``out_col`` is replaced."""
    spark = docs.sparkSession
    choices = resolve_choices(docs, text_col, key)
    text = F.col(f"`{text_col}`")
    if choices.limit(max_broadcast + 1).count() <= max_broadcast:
        held = spark.sparkContext.broadcast({(r.kind, r.scope, r.value): r.choice for r in choices.collect()})
        return with_column_replaced(docs, out_col, _rewritten(key, held)(text, F.lit(None).cast(EXTRA)))
    held = spark.sparkContext.broadcast({})
    ident = F.struct(F.xxhash64(text), F.crc32(text.cast("binary")), F.length(text))
    texts = docs.select(ident.alias("ident"), text.alias("text")).where("text is not null")
    own = (texts.select("ident", F.explode(_claim_list()("text")).alias("c")).select("ident", "c.*").distinct()
           .join(choices, ["kind", "scope", "value"])
           .groupBy("ident").agg(F.collect_list(F.struct("kind", "scope", "value", "choice")).alias("__own")))
    joined = docs.withColumn("__ident", ident).join(own.withColumnRenamed("ident", "__ident"), "__ident", "left")
    return with_column_replaced(joined, out_col, _rewritten(key, held)(text, F.col("__own"))).drop("__ident", "__own")


def with_surrogates(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY, **kw) -> DataFrame:
    """``docs`` with the texts' personal data replaced; all columns stay, in their order."""
    mark = unused_name(docs, "private")
    out = with_rewritten(docs, mark, text_col, key, **kw)
    return out.select(*[F.col(f"{mark}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data and secrets."""
    out = with_rewritten(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("private.text").alias("text"), F.size("private.entities").cast("long").alias("n_entities"),
                      F.array_distinct("private.entities.kind").alias("kinds"))
