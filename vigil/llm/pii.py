"""PII: detected entities get keyed surrogates of the same kind, gender, script and format.

An entity is (kind, canonical value): the canonical value ignores case and
separators, so that all spellings of one entity share a surrogate (coreference;
given names and surnames are entities of their own, so "John Smith" and
"Mr. Smith" stay one person; once a title or an introduction tells a name, every
whole-word mention of it in the text is replaced).  A surrogate is drawn from an HMAC of the key,
the kind, the canonical value and an attempt number, and written in the format
of each occurrence; a name is drawn in the script that it is written in.

The key is the caller's; ``session_key`` takes it from ``spark.vigil.pii.key`` and
otherwise draws one for the application, which nobody can recompute (surrogates
then differ from one application to the next).

Collision check: the distinct entities of the corpus are a Spark table.  Where
two entities of a kind draw the same surrogate, or a surrogate equals a real
value of the kind, all but the first draw again, until none collide; they alone
are drawn anew and compared with the table of the others.  Only these rare
overrides travel to the rewriting pass (broadcast below a checked count, joined
per document above it).

Null texts stay null, empty texts stay empty, texts without entities are kept
byte for byte.  Repeated rows give repeated rows, an empty table an empty
result.  Extra columns are ignored.
"""
from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
import secrets
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import held, staged

KEY_SETTING = "spark.vigil.pii.key"
BROADCAST_OVERRIDES = 100_000
MAX_ROUNDS = 40

# --- fixed values -----------------------------------------------------------
#: courtesy titles and the gender that they tell (m, f or none)
TITLES = {"Mr": "m", "Mr.": "m", "Mrs": "f", "Mrs.": "f", "Ms": "f", "Ms.": "f", "Miss": "f", "Dr.": "", "Prof.": "",
          "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f", "Sr.": "m", "Sra.": "f", "Monsieur": "m",
          "Madame": "f", "Mme": "f", "господин": "m", "госпожа": "f"}
#: phrases that introduce a full name
INTRODUCTIONS = ["my name is", "My name is", "mein Name ist", "Mein Name ist", "je m'appelle", "Je m'appelle",
                 "me llamo", "Me llamo", "меня зовут", "Меня зовут"]
#: common given names by gender, to tell the gender where no title does
GIVEN_M = ["adam", "alex", "carlos", "charles", "daniel", "david", "frank", "george", "hans", "henry", "ivan", "james",
           "jean", "john", "josé", "juan", "karl", "louis", "luis", "martin", "michael", "paul", "peter", "pierre",
           "robert", "thomas", "william", "иван", "пётр", "сергей", "алексей"]
GIVEN_F = ["alice", "ana", "anna", "carmen", "charlotte", "claire", "elena", "elizabeth", "emma", "eva", "jane", "julia",
           "laura", "lucy", "marie", "maria", "maría", "mary", "olga", "petra", "sara", "sarah", "sophie", "susan",
           "анна", "мария", "ольга", "елена"]
#: syllables from which names are drawn, by script, and endings by gender
SYLLABLES = {"latin": ["bar", "bel", "cor", "dan", "del", "el", "far", "gar", "hal", "jan", "kel", "lan", "lor", "mar",
                       "mel", "nor", "or", "per", "ral", "ran", "ser", "sol", "tan", "tor", "val", "ver", "wil", "yar"],
             "cyrillic": ["бар", "вал", "вер", "гар", "дан", "ер", "кор", "лан", "мар", "мел", "нор", "пер", "рад",
                          "сол", "тан", "тор", "яр"],
             "greek": ["βαλ", "γαρ", "δαν", "ερ", "καλ", "λαν", "μαρ", "νικ", "παρ", "ραν", "σολ", "ταν", "φιλ", "χαρ"],
             "hebrew": ["בר", "גל", "דן", "טל", "יר", "כר", "לב", "מר", "נר", "סל", "רון", "שר", "תמ"],
             "arabic": ["بر", "جم", "دل", "رم", "سل", "شر", "عم", "فر", "كر", "لم", "مر", "نور", "حس"],
             "devanagari": ["अन", "बल", "चर", "दल", "गौ", "हर", "जय", "कम", "मन", "नर", "पर", "रव", "सर"],
             "han": ["安", "北", "成", "德", "东", "光", "国", "海", "华", "江", "康", "林", "明", "南", "平", "清", "山", "文"],
             "kana": ["あき", "いず", "かず", "きみ", "さと", "しの", "たか", "なお", "はる", "ひろ", "まさ", "みつ", "ゆき"],
             "hangul": ["가", "나", "도", "라", "민", "서", "수", "영", "우", "은", "재", "준", "지", "진", "하", "현"]}
ENDINGS = {"latin": {"m": ["o", "us", "ek", "is"], "f": ["a", "ia", "ina", "elle"], "": ["y", "e", "i", "en"],
                     "s": ["son", "er", "ski", "ley", "man", "ez", "ton", "ard"]},
           "cyrillic": {"m": ["ий", "ей", "ан", "ир"], "f": ["а", "ия", "ина", "ея"], "": ["и", "о", "е"],
                        "s": ["енко", "ук", "ян", "ых"]},
           "greek": {"m": ["ος", "ης", "ας"], "f": ["α", "η", "ια"], "": ["ι", "ο"], "s": ["ίδης", "άκης", "όπουλος"]},
           "hebrew": {"m": ["ון", "אל"], "f": ["ה", "ית"], "": ["י"], "s": ["סון", "מן", "ני"]},
           "arabic": {"m": ["ان", "ير"], "f": ["ة", "اء"], "": ["ي"], "s": ["اوي", "اني"]},
           "devanagari": {"m": ["ेश", "ंत"], "f": ["ा", "िका"], "": ["ी"], "s": ["वाल", "कर"]},
           "han": {"m": ["伟", "强", "军"], "f": ["芳", "娟", "丽"], "": ["宁", "和"], "s": ["川", "田", "村"]},
           "kana": {"m": ["お", "と"], "f": ["こ", "み"], "": ["い"], "s": ["だ", "むら"]},
           "hangul": {"m": ["호", "철"], "f": ["희", "숙"], "": ["아"], "s": ["남", "길"]}}
#: first words of the Unicode names of letters, and the script whose syllables stand for them (others: latin)
SCRIPTS = {"CYRILLIC": "cyrillic", "GREEK": "greek", "HEBREW": "hebrew", "ARABIC": "arabic", "DEVANAGARI": "devanagari",
           "CJK": "han", "HIRAGANA": "kana", "KATAKANA": "kana", "HANGUL": "hangul"}
# ---------------------------------------------------------------------------

_SECRET = re.compile(
    r"(?i:(?<![A-Za-z0-9])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth[_-]?key|client[_-]?secret))"
    r"\s*[:=]\s*[\"']?(?P<a>[A-Za-z0-9_\-+/.]{12,})"
    r"|(?<![A-Za-z0-9])(?P<b>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})")
_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])")
_CARD = re.compile(r"(?<![\d.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?![\d])")
_PHONE = re.compile(r"(?<![\w.])(?:(?:\+?1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}"
                    r"|(?:\+?1[ .-])?\d{3}([.-])\d{3}\1\d{4}|\+\d{1,3}(?:[ .-]?\(?\d{2,5}\)?){2,4})(?!\d)")
#: numbers as written within a country: area code with its 0, or pairs of digits
_NATIONAL = re.compile(r"(?<![\w.,/+-])(?:\(0\d{2,4}\)|0\d{2,4})[ /-]\d{3,4}(?:[ -]?\d{3,4}){0,1}(?!\d|[.,/-]\d)"
                       r"|(?<![\w.,/+-])0\d{2,4}[ /-]\d{5,8}(?!\d|[.,/-]\d)"
                       r"|(?<![\w.,/+-])0[1-9](?:([ .])\d{2})(?:\1\d{2}){3}(?!\d|[.,/ -]\d)")
_MAC = re.compile(r"(?<![\w:-])[0-9A-Fa-f]{2}(?:(:|-)[0-9A-Fa-f]{2})(?:\1[0-9A-Fa-f]{2}){4}(?![\w:-])")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){0,6}(?![\w:])|(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){1,6}:(?![\w:])"
                   r"|(?<![\w:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})(?![\w:])")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)")
_SSN = re.compile(r"(?<![\w-])(?!000|666|9\d\d)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
#: marks that are written on letters (accents, vowel signs, points)
_MARKS = "".join(chr(c) for c in range(0x300, 0x1100) if unicodedata.category(chr(c)).startswith("M"))
_MARK = f"[{_MARKS}]"
_INSIDE = rf"[\w{_MARKS}]"
_SMALL = "[" + "".join(re.escape(chr(c)) for c in range(0x10000) if chr(c).islower()) + "]"
_LETTER = rf"[^\W\d_]{_MARK}*"
#: a whole name: no small first letter (but d'Angelo), inner capitals, hyphens and apostrophes; no possessive or contracted ending
_NAME = re.compile(rf"(?<!{_INSIDE})(?:(?:[dl]|[Dd]ell)['’](?!{_SMALL}))?(?!{_SMALL}){_LETTER}"
                   rf"(?:{_LETTER}|['’](?=[^\W\d_])(?!(?:s|d|t|m|ll|re|ve)(?!\w))|[-‐‑](?=[^\W\d_])(?!{_SMALL}))*(?!{_INSIDE})")
_ALL_TITLES = "(?:" + "|".join(re.escape(t) for t in sorted(TITLES, key=len, reverse=True)) + r")(?![^\W\d_])"
_GAP = "[  ]+"
_INITIAL = rf"(?!{_SMALL})[^\W\d_]\.(?={_GAP}?[^\W\d_])"
_PARTICLE = "(?:van|von|vom|zu|zur|der|den|de|del|della|di|da|das|do|dos|du|la|las|le|los|ter|ten|af|av|al|el|bin|ibn|bint)"
_PART = rf"(?:{_PARTICLE}{_GAP}){{0,3}}(?!{_ALL_TITLES}){_NAME.pattern}"
_PERSON = re.compile(rf"(?<![^\W\d_])(?:(?P<title>{_ALL_TITLES})|(?:{'|'.join(map(re.escape, INTRODUCTIONS))})(?![^\W\d_]))"
                     rf"(?:{_GAP}(?P<more>{_ALL_TITLES})){{0,3}}+{_GAP}(?P<lead>(?:{_INITIAL}{_GAP[:-1]}*)*)"
                     rf"(?P<names>{_PART}(?:{_GAP}(?:{_INITIAL}{_GAP[:-1]}*)*{_PART}){{0,3}})")
#: a word with its inner apostrophes and hyphens, and the pieces between them
_WORD = re.compile(rf"(?<!{_INSIDE})(?:{_LETTER})+(?:['’\-‐‑](?:{_LETTER})+)*(?!{_INSIDE})")
_PIECE = re.compile(rf"(?:{_LETTER})+")
_POSSESSIVE = re.compile(r"['’](?:s|S|d|ll|re|ve|m|t)$")
_HAS_DIGIT = re.compile(r"[0-9]")
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_KEY_PREFIX = re.compile(r"AKIA|gh[pousr]_|sk-|xox[abprs]-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _is_card(digits: str) -> bool:
    n = len(digits)
    known = n in (15, 16) or n == 13 and digits[0] == "4" or n == 14 and digits[:2] in ("30", "36", "38") \
        or n == 19 and digits[0] in "46"
    return known and len(set(digits)) > 1 and luhn(digits)


def _ipv6(shown: str) -> str | None:
    """The full lower-case form of an address; None for what is none, has no group of its own (``::``) or is a time."""
    try:
        address = ipaddress.IPv6Address(shown)
    except ValueError:
        return None
    return None if address.is_unspecified or address.is_loopback or not re.search("[0-9]", shown) else address.exploded


def script_of(name: str) -> str:
    """The script whose syllables stand for a name: that of its first letter."""
    first = next((c for c in name if c.isalpha()), "a")
    return SCRIPTS.get(unicodedata.name(first, "").split(" ")[0].split("-")[0], "latin")


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities, in text order, none overlapping."""
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    digit = _HAS_DIGIT.search(text)
    if digit or "_" in text or "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            g = "a" if m.group("a") else "b"
            value = m.group(g).rstrip(".")
            if g == "b" or _HAS_DIGIT.search(value):
                found.append((m.start(g), m.start(g) + len(value), "secret", value.lower() if _HEX.fullmatch(value) else value))
    if "@" in text:
        found += [(m.start(), m.end(), "email", m.group().lower()) for m in _EMAIL.finditer(text)]
    if digit:
        for m in _CARD.finditer(text):
            d = re.sub(r"\D", "", m.group())
            if _is_card(d):
                found.append((m.start(), m.end(), "card", d))
        for m in _PHONE.finditer(text):
            d = re.sub(r"\D", "", m.group())
            if 8 <= len(d) <= 15:
                found.append((m.start(), m.end(), "phone", d[1:] if len(d) == 11 and d[0] == "1" else d))
        for m in _NATIONAL.finditer(text):
            d = re.sub(r"\D", "", m.group())
            if 9 <= len(d) <= 11:
                found.append((m.start(), m.end(), "phone", d))
        found += [(m.start(), m.end(), "ip", m.group()) for m in _IP.finditer(text)]
        found += [(m.start(), m.end(), "mac", re.sub(r"[:-]", "", m.group()).lower()) for m in _MAC.finditer(text)]
        for m in _IPV6.finditer(text) if ":" in text else ():
            address = _ipv6(m.group())
            if address:
                found.append((m.start(), m.end(), "ipv6", address))
        found += [(m.start(), m.end(), "ssn", m.group().replace("-", "")) for m in _SSN.finditer(text)]
        for m in _IBAN.finditer(text):
            v = m.group().replace(" ", "")
            if 15 <= len(v) <= 34 and _iban_rest(v) == 1:
                found.append((m.start(), m.end(), "iban", v))
    if any(t in text for t in TITLES) or any(t in text for t in INTRODUCTIONS):
        found += _people(text)
    order = {k: i for i, k in enumerate(["secret", "email", "iban", "card", "phone", "mac", "ipv6", "ip", "ssn"])}
    taken: list[tuple[int, int, str, str]] = []
    for f in sorted(found, key=lambda f: (order.get(f[2], 9), f[0])):
        at = bisect.bisect_left(taken, f)
        if (at == 0 or taken[at - 1][1] <= f[0]) and (at == len(taken) or f[1] <= taken[at][0]):
            taken.insert(at, f)
    return taken


def _people(text: str) -> list[tuple[int, int, str, str]]:
    """The names after titles and introductions, and all other whole-word mentions of these names in the text."""
    found, known = {}, {}
    for m in _PERSON.finditer(text):
        own = [n for n in _NAME.finditer(text, m.start("names"), m.end("names")) if len(n.group()) > 1 or not n.group().isupper()]
        gender = TITLES.get(m.group("title") or "", "") or TITLES.get(m.group("more") or "", "")
        for k, n in enumerate(own):
            low = _canonical(n.group())
            if k == len(own) - 1 and (k or m.group("title") or m.group("more") or m.group("lead")):
                kind = "surname"
            else:
                kind = "given" + (gender or ("m" if low in GIVEN_M else "f" if low in GIVEN_F else ""))
                gender = gender or kind[5:]
                if kind == "given" and known.get(low, "").startswith("given"):
                    kind = known[low]
            found[n.span()] = (kind, low)
            known.setdefault(low, kind)
    for m in _WORD.finditer(text) if known else ():
        if m.span() in found:
            continue
        spans = [m.span()]
        if _canonical(m.group()) not in known:            # "Lopez's", "Anna-Lopez", "Lopez-led"
            ending = _POSSESSIVE.search(m.group())
            if ending and _canonical(m.group()[:ending.start()]) in known:
                spans = [(m.start(), m.start() + ending.start())]
            else:
                spans = [x.span() for x in _PIECE.finditer(text, *m.span())]
        for s, e in spans:
            low = _canonical(text[s:e])
            if low in known and (not text[s].islower() or "'" in low):
                found.setdefault((s, e), (known[low], low))
    return [(s, e, kind, low) for (s, e), (kind, low) in found.items()]


def _canonical(name: str) -> str:
    return unicodedata.normalize("NFC", name.lower()).replace("’", "'").replace("‐", "-").replace("‑", "-")


class _Draws:
    """A keyed stream of numbers."""

    def __init__(self, key: str, *parts: str):
        self.seed, self.block, self.pool = hmac.new(key.encode(), "\x1f".join(parts).encode(), hashlib.sha256).digest(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.seed, self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return x % n

    def like(self, text: str) -> str:
        """Digits for digits, letters of the same case for letters (hexadecimal ones in hexadecimal text)."""
        letters = "abcdef" if _HEX.fullmatch(text) else "abcdefghijklmnopqrstuvwxyz"
        out = []
        for c in text:
            x = letters[self.below(len(letters))] if c.isalpha() else str(self.below(10)) if c.isdigit() else c
            out.append(x.upper() if c.isupper() else x)
        return "".join(out)


@lru_cache(maxsize=1 << 16)
def surrogate(kind: str, value: str, attempt: int, key: str) -> str:
    """The canonical surrogate of an entity at a given attempt."""
    draw = _Draws(key, kind, value, str(attempt))
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{draw.like(local)}@{draw.like(host)}.{top}"
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[1:-1])
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "phone":
        keep = max(1 if value[0] == "0" else 0, len(value) - 10)          # a country code, or the 0 before an area code
        return value[:keep] + str(2 + draw.below(8)) + "".join(str(draw.below(10)) for _ in value[keep + 1:])
    if kind == "ip":
        first = [n for n in range(1, 224) if n not in (10, 127, 169, 172, 192)]
        return ".".join(map(str, [first[draw.below(len(first))], draw.below(256), draw.below(256), 1 + draw.below(254)]))
    if kind == "mac":
        return "02" + "".join("0123456789abcdef"[draw.below(16)] for _ in range(10))    # a locally administered address
    if kind == "ipv6":
        return "2001:0db8:" + ":".join(f"{draw.below(1 << 16):04x}" for _ in range(6))      # set aside for examples
    if kind == "ssn":
        return "9" + "".join(str(draw.below(10)) for _ in range(8))       # 9xx is never issued
    if kind == "iban":
        body = "".join(str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in value[4:])
        return f"{value[:2]}{98 - _iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "secret":
        lead = _KEY_PREFIX.match(value)
        lead = lead.group() if lead else ""
        return lead + draw.like(value[len(lead):])
    script = script_of(value)
    parts, ends = SYLLABLES[script], ENDINGS[script]["s" if kind == "surname" else kind[5:]]
    size = 1 + draw.below(2) + attempt // 4                               # later attempts draw from longer names
    return "".join(parts[draw.below(len(parts))] for _ in range(size)) + ends[draw.below(len(ends))]


def written(kind: str, shown: str, canonical: str) -> str:
    """The canonical surrogate in the format of the occurrence that it replaces."""
    if kind == "ip":
        return canonical
    if kind == "ipv6":
        short = ipaddress.IPv6Address(canonical).compressed
        text = canonical if len(shown) == 39 else short
        return text.upper() if shown == shown.upper() and shown != shown.lower() else text
    if kind == "mac":
        text = canonical.upper() if shown == shown.upper() and shown != shown.lower() else canonical
        return shown[2].join(text[i:i + 2] for i in range(0, 12, 2))
    if kind == "secret":
        return canonical.upper() if _HEX.fullmatch(shown) and shown == shown.upper() else canonical
    if kind in ("card", "phone", "ssn", "iban"):
        have = sum(c.isalnum() for c in shown)
        lead = re.sub(r"[^0-9A-Za-z]", "", shown)[:have - len(canonical)] if have > len(canonical) else ""
        chars = iter(lead + canonical)                                    # a country code that is not in the value stays
        return "".join(next(chars) if c.isalnum() else c for c in shown)
    if shown.isupper() and len(shown) > 1:
        return canonical.upper()
    if shown[:1].isupper():
        return canonical[:1].upper() + canonical[1:]
    return canonical


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held("pii", dict)          # needs no tables: those of an operator before it go
    for b in batches:
        seen = sorted({(k, v) for t in b.column(0) for _, _, k, v in detect(t.as_py())})
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.string()),
                                          pa.array([v for _, v in seen], pa.string())], names=["kind", "value"])


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The distinct entities (kind, value) of the texts."""
    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        _entities, "kind string, value string").distinct()


def _draw(key: str):
    def run(batches):
        for b in batches:
            out = [surrogate(k, v, a, key) for k, v, a in zip(*(b.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())],
                                             names=["kind", "value", "attempt", "surrogate"])
    return run


def session_key(spark: SparkSession) -> str:
    """The key that the session's settings give, or one drawn for this application."""
    given = spark.conf.get(KEY_SETTING, None) or spark.sparkContext.getConf().get(KEY_SETTING, None)
    return given or _DRAWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


_DRAWN_KEYS: dict[str, str] = {}


def overrides(known: DataFrame, key: str | None = None) -> DataFrame:
    """(kind, value, attempt) of the entities that must draw again, from the table of all entities.

    Ends when no two entities of a kind share a surrogate and no surrogate is a
    real value of its kind.  Given names of either gender count as one kind.
    """
    key = key or session_key(known.sparkSession)
    family = F.when(F.col("kind").startswith("given"), F.lit("given")).otherwise(F.col("kind"))
    me, cols = F.struct("value", "kind"), ["kind", "value", "attempt", "surrogate", "family"]

    def drawn(rows: DataFrame, name: str) -> DataFrame:
        return staged(rows.select("kind", "value", F.col("attempt").cast("int").alias("attempt"))
                      .mapInArrow(_draw(key), "kind string, value string, attempt int, surrogate string")
                      .withColumn("family", family), name)

    def clashing(rows: DataFrame, real: DataFrame) -> DataFrame:
        """Of these rows those that are not the first with their surrogate, or draw a real value."""
        shared = (rows.groupBy("family", "surrogate").agg(F.count(F.lit(1)).alias("n"), F.min(me).alias("first")).where("n > 1"))
        late = rows.join(shared, ["family", "surrogate"]).where(me != F.col("first")).select(cols)
        return late.union(rows.join(real, ["family", "surrogate"], "left_semi").select(cols)).distinct()

    first = drawn(known.withColumn("attempt", F.lit(0)), "pii-drawn")          # the whole table, drawn once
    real = first.select("family", F.col("value").alias("surrogate")).distinct()
    open_ = staged(clashing(first, real), "pii-clash")
    if open_.isEmpty():
        return open_.select("kind", "value", "attempt")
    moved = open_.select("kind", "value")                                      # these no longer hold their first draw
    settled = staged(open_.limit(0), "pii-settled")
    for _ in range(MAX_ROUNDS):
        new = drawn(open_.withColumn("attempt", F.col("attempt") + 1), "pii-again")
        # taken: what others hold of the new draws
        of_new = new.select("family", "surrogate").distinct()
        held = first.join(of_new, ["family", "surrogate"], "left_semi").join(moved, ["kind", "value"], "left_anti") \
            .select("family", "surrogate").union(settled.select("family", "surrogate"))
        free = new.join(held.distinct(), ["family", "surrogate"], "left_anti")
        again = clashing(free.select(cols), real).union(new.join(held.distinct(), ["family", "surrogate"], "left_semi").select(cols))
        open_ = staged(again.distinct(), "pii-clash")
        settled = staged(settled.select(cols).union(
            new.join(open_.select("kind", "value"), ["kind", "value"], "left_anti").select(cols)), "pii-settled")
        if open_.isEmpty():
            return settled.select("kind", "value", "attempt")
    raise RuntimeError(f"surrogates still collide after {MAX_ROUNDS} rounds")


def _rewrite(key: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value if shared is not None else {}
        for b in batches:
            texts, found = [], []
            for i, t in enumerate(b.column(1)):
                text, out, at, spans = t.as_py(), [], 0, []
                own = table if shared is not None else {(r["kind"], r["value"]): r["attempt"]
                                                        for r in b.column(2)[i].as_py() or []}
                for s, e, kind, value in detect(text):
                    out += [text[at:s], written(kind, text[s:e], surrogate(kind, value, own.get((kind, value), 0), key))]
                    spans.append({"kind": kind, "start": s, "end": e, "surrogate": out[-1]})
                    at = e
                texts.append(text if not spans else "".join(out) + text[at:])
                found.append(spans)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()),
                 pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                                     ("surrogate", pa.string())])))], names=["row", "text", "entities"])
    return run


_OUT = "text string, entities array<struct<kind string, start int, end int, surrogate string>>"


def anonymise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str | None = None,
              broadcast_rows: int = BROADCAST_OVERRIDES) -> DataFrame:
    """(id_col, text, entities) of every row: the text with surrogates, and what was replaced where."""
    spark = docs.sparkSession
    key = key or session_key(spark)
    again = overrides(entities(docs, text_col), key)
    rows = docs.select(F.col(id_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    id_type = dict(rows.dtypes)["row"]
    if again.limit(broadcast_rows + 1).count() <= broadcast_rows:
        shared = spark.sparkContext.broadcast({(r["kind"], r["value"]): r["attempt"] for r in again.collect()})
        return rows.mapInArrow(_rewrite(key, shared), f"row {id_type}, {_OUT}").withColumnRenamed("row", id_col)

    def occurrences(batches):
        for b in batches:
            own = [(h, k, v) for h, t in zip(b.column(0).to_pylist(), b.column(1)) for k, v in
                   sorted({(k, v) for _, _, k, v in detect(t.as_py())})]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in own], pa.int64()),
                                              pa.array([o[1] for o in own], pa.string()),
                                              pa.array([o[2] for o in own], pa.string())], names=["h", "kind", "value"])

    # one list per distinct text: no longer than the text has entities
    keyed = rows.withColumn("h", F.xxhash64("text"))
    per_text = (keyed.select("h", "text").mapInArrow(occurrences, "h long, kind string, value string").distinct()
                .join(again, ["kind", "value"]).groupBy("h")
                .agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("own")))
    joined = keyed.join(staged(per_text, "pii-per-text"), "h", "left").select("row", "text", "own")
    return joined.mapInArrow(_rewrite(key, None), f"row {id_type}, {_OUT}").withColumnRenamed("row", id_col)
