"""PII surrogates: detected entities get keyed, type-consistent replacements.

Types: e-mail address, telephone number, payment card number, IPv4 and IPv6 address, IBAN, US social security number, secret
(token, password), personal name (after an honorific, or a listed given name before a listed family name). A surrogate is made from an HMAC of (type, canonical value, attempt): the same entity gets the
same surrogate everywhere (coreference), in the format it was written in (separators, letter case, length, Luhn or
mod-97 check digits, the address range, numbers that may be issued). Names are replaced word by word, given names by given names
of the same gender, family names by family names, in the script of the original. Words of a name found in a text are
replaced wherever else they stand in it, so in "Ms Anna Weber met Weber and Anna" both stay one person.

Distinctness: digits of telephone numbers, cards, addresses and so on go through a keyed permutation without fixed points (a
Feistel network, conjugated with a step by one; cycle walking over the format's own domain), which cannot collide and never gives the entity itself. Name words and e-mail local parts
are drawn by hash and can; distinct entities are therefore collected, surrogates that two entities share are
found by an aggregation, and all but the first entity try again with the next attempt until none is shared. From the
third attempt on surrogates grow with each, so any number of entities finds room. The
few entities that needed another attempt form a table. Up to ``BROADCAST_ENTITIES`` of them it is
sent to all tasks; beyond, each document is joined with the entries it needs.

Edge cases: a null text stays null; empty texts and texts without entities stay as they are; repeated rows get
equal results; a secret of one sign repeated is a mask and stays; an empty table gives no rows;
very long texts are searched whole, one at a time; other columns are kept as they are, but ``pii_entities`` and ``pii_distinct`` are replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import dicts, lean, small_batches, staged

BROADCAST_ENTITIES = 100_000

# Given names by script and gender, family names by script, honorifics.
GIVEN = {
    ("latin", "f"): "Alice Anna Carla Clara Daniela Elena Emma Eva Greta Hanna Helena Irene Isabel Julia Karin Laura Lena Lucia Maria Marta Mary Nina Nora Olga Paula Petra Rosa Sara Sofia Susan Teresa Vera".split(),
    ("latin", "m"): "Adam Albert Anton Bruno Carlos Daniel David Diego Emil Erik Felix Frank Georg Hans Henry Hugo Ivan Jakob James John Karl Leo Lukas Marco Martin Max Oscar Paul Peter Robert Simon Thomas Viktor".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Мария Наталья Ольга Татьяна".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Пётр Сергей".split(),
}
FAMILY = {
    "latin": "Adler Bauer Becker Berger Bianchi Blanc Brown Carter Conti Costa Dubois Fischer Fontaine Garcia Green Hansen Hoffmann Jensen Keller Lambert Lopez Marino Martin Meyer Miller Moreau Morris Navarro Novak Olsen Parker Petit Ramos Ricci Romano Ruiz Schmidt Schneider Smith Taylor Torres Vogel Wagner Weber Wilson Wolf Young Ziegler".split(),
    "cyrillic": "Алексеев Белов Волков Гусев Ершов Зайцев Козлов Лебедев Морозов Новиков Орлов Павлов Соколов Титов Фролов".split(),
}
#: Capitalised words that begin a sentence and are no names.
NO_NAMES = frozenset("After Also Although And As At Before Both But By During Each For From Has Have He Her Here His However I If In Is It Its Later Meanwhile Moreover Nevertheless No Not Now On Or Our She Since So Some Still That The Their Then There Therefore These They This Those Though Thus To Today Until Was We When Where While Who Why With Yes Yesterday Yet You Your".split())
HONORIFICS = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f", "Monsieur": "m", "Madame": "f"}

_GENDER = {name: (script, sex) for (script, sex), names in GIVEN.items() for name in names}
_FAMILY = {name: script for script, names in FAMILY.items() for name in names}
_UPPER, _LOWER = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
_CAP = rf"[{_UPPER}](?:['’][{_UPPER}])?[{_LOWER}]+(?:[-'’][{_UPPER}]?[{_LOWER}]+)*"
_SHOUT = rf"[{_UPPER}](?:['’-]?[{_UPPER}])+"
_TOKEN_PREFIX = r"gh[pousr]_|sk-|AKIA"
_SECRET_WORD = r"[Pp]assword|PASSWORD|passwd|pwd|[Ss]ecret|SECRET|[Tt]oken|TOKEN|api_?key|API_?KEY"
_KINDS = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)+)"
    r"|(?P<token>(?<![\w-])(?:gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|AKIA[A-Z0-9]{16}|(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,64})(?![\w-]))"
    r"|(?:(?:" + _SECRET_WORD + r") ?[=:] ?[\"']?)(?P<secret>[^\s\"'<>,;]{6,})"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d))"
    r"|(?P<ssn>(?<![\d-])(?!000|666|9\d\d)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]))"
    r"|(?P<phone>(?=[+(\d])(?<![\w+])(?:(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{1,3}(?:[ .-]\d{2,8}){2,5}(?!\.\d)|\+[1-9]\d{7,14}(?!\.\d)|\d{3}[ .-]\d{3}[ .-]\d{4}"
    # With the trunk 0: groups with one kind of separator, 9 to 12 digits, not a date.
    r"|(?=0[1-9])(?<!\d[ ./-])(?!\d\d(?P<dot>[ ./-])\d\d(?P=dot)(?:19|20)\d\d(?!\d))(?=(?:[ ./-]?\d){9,12}(?![ ./-]?\d))0[1-9]\d{0,3}(?P<gap>[ ./-])\d{2,8}(?:(?P=gap)\d{2,8}){0,4})(?![\w-]))"
)
#: Cheap and never misses: each of the above kinds has an @, a digit, the word before a secret or the prefix of a token.
_CANDIDATE = re.compile(r"[@\d]")
_WORDS = ("assword", "PASSWORD", "passwd", "pwd", "ecret", "SECRET", "oken", "TOKEN", "api_key", "apikey", "API_KEY", "APIKEY", "sk-", "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")
#: Country codes of one, two and three digits.
_COUNTRY = re.compile(r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3})")
#: One sign again and again stands for a secret that is not there.
_MASK = re.compile(r"([^\w])\1+|_+")
#: A secret of signs only becomes one of these.
SIGNS = "!#$%&*+-./:=?@^~"
_TITLES = (*HONORIFICS, "Dr")
_NAME = re.compile(
    rf"(?<!\w)(?:(?P<title>{'|'.join(_TITLES)})\.? (?P<rest>{_CAP}(?: {_CAP}){{0,2}})|(?P<loud>{'|'.join(t.upper() for t in _TITLES)})\.? (?P<shout>{_SHOUT}(?: {_SHOUT}){{0,2}})"
    rf"|(?P<full>(?:{'|'.join(_GENDER)})(?: {_CAP})? (?:{'|'.join(_FAMILY)})))(?!\w)"
)
_NAME_HINT = re.compile(rf"(?<!\w)(?:{'|'.join(_TITLES)}|{'|'.join(t.upper() for t in _TITLES)}|{'|'.join(_GENDER)})(?!\w)")
_IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:.])")
# Address ranges that a surrogate stays in; the rest is public.
RANGES4 = tuple(map(ipaddress.ip_network, ("0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4")))
RANGES6 = tuple(map(ipaddress.ip_network, ("fc00::/7", "fe80::/10", "ff00::/8", "2001:db8::/32", "2000::/3")))


def _mac(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), "big")


def permute(key: bytes, label: str, value: int, size: int) -> int:
    """A keyed permutation of 0..size-1: balanced Feistel network over the next even bit length, cycle walking."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in range(6):
            left, right = right, left ^ (_mac(key, label, size, r, right) & mask)
        value = left << half | right
        if value < size:
            return value


def unpermute(key: bytes, label: str, value: int, size: int) -> int:
    """The inverse of ``permute``."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in reversed(range(6)):
            left, right = right ^ (_mac(key, label, size, r, left) & mask), left
        value = left << half | right
        if value < size:
            return value


def derange(key: bytes, label: str, value: int, size: int) -> int:
    """A keyed permutation of 0..size-1 that is one cycle: no fixed points, and who walks on comes back to ``value`` last."""
    return unpermute(key, label, (permute(key, label, value, size) + 1) % size, size)


def luhn(digits: str) -> int:
    """The check digit that makes ``digits`` + it valid."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _refill(shape: str, symbols: str, kind: str) -> str:
    """``shape`` with its characters of ``kind`` replaced in turn by ``symbols``."""
    it = iter(symbols)
    return "".join(next(it) if re.match(kind, c) else c for c in shape)


def _digits(key: bytes, label: str, digits: str) -> str:
    return f"{derange(key, f'{label}{len(digits)}', int(digits), 10 ** len(digits)):0{len(digits)}d}" if digits else ""


def _address(key: bytes, value: str) -> str:
    """An address of the same range; public ones stay public. Two ranges that overlap: the first holds."""
    at = ipaddress.ip_address(value)
    ranges = RANGES4 if at.version == 4 else RANGES6
    home = next((i for i, r in enumerate(ranges) if at in r), None)
    inside = ranges[home] if home is not None else ipaddress.ip_network("0.0.0.0/0" if at.version == 4 else "::/0")
    start, n = int(inside.network_address), int(at) - int(inside.network_address)
    while True:  # cycle walking past the ranges within this one that come before it
        n = derange(key, f"ip{at.version}:{inside}", n, inside.num_addresses)
        made = type(at)(start + n)
        if next((i for i, r in enumerate(ranges) if made in r), None) == home:
            return str(made)


def canonical(kind: str, value: str) -> str:
    """What makes two writings one entity."""
    if kind == "email":
        return value.lower()
    if ":" in kind:
        return value.title() if value.isupper() else value
    if kind == "ip6":
        return ipaddress.ip_address(value).compressed
    return re.sub(r"[ ()./-]", "", value) if kind in ("phone", "card", "iban", "ssn") else value


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of an entity in the writing of ``value``; never the entity itself."""
    more = max(0, attempt - 2)  # from the third attempt on a surrogate grows with each, so there is always room
    if kind == "email":
        local, _, domain = value.lower().partition("@")
        n = _mac(key, "email", local, domain, attempt)
        name = GIVEN["latin", "fm"[n % 2]][(n >> 8) % 32].lower() + "." + FAMILY["latin"][(n >> 16) % len(FAMILY["latin"])].lower() + f"{(n >> 32) % 10 ** (6 + more):0{6 + more}d}"
        host = _mac(key, "domain", domain) % 10**8  # one surrogate domain for each domain
        out = f"{name}@d{host:08d}.example.{domain.rsplit('.', 1)[-1] if domain.rsplit('.', 1)[-1] in ('com', 'net', 'org') else 'org'}"
        return out.upper() if value.isupper() else out
    if kind == "card":
        digits = re.sub(r"\D", "", value)
        valid = luhn(digits[:-1]) == int(digits[-1])
        new = _digits(key, f"card{attempt}" if attempt else "card", digits[:-1])
        check = luhn(new)
        return _refill(value, new + str(check if valid else (check + 1 + (int(digits[-1]) - luhn(digits[:-1]) - 1) % 10 % 9) % 10), r"\d")
    if kind == "phone":
        country = _COUNTRY.match(value)
        kept = country[0] if country else "0" if value.lstrip("(").startswith("0") else ""  # country codes and trunk zeros stay
        digits = re.sub(r"\D", "", value)
        new = rest = digits[len(kept.lstrip("+")) :]
        while True:  # cycle walking: a zero follows only where one did, so numbers with and without a trunk zero cannot meet
            new = _digits(key, f"phone{kept}", new)
            if new.startswith("0") == rest.startswith("0"):
                return _refill(value, kept.lstrip("+") + new, r"\d")
    if kind == "ssn":
        new = re.sub(r"\D", "", value)
        while True:  # cycle walking: only numbers that may be issued
            new = _digits(key, "ssn", new)
            if new[:3] not in ("000", "666") and new[0] != "9" and new[3:5] != "00" and new[5:] != "0000":
                return _refill(value, new, r"\d")
    if kind == "ip":
        return _address(key, value)
    if kind == "ip6":
        made = _address(key, value)
        return made.upper() if value.upper() == value and not value.isdigit() and re.search("[A-F]", value) else made
    if kind == "iban":
        plain = value.replace(" ", "")
        body = plain[4:]
        digits = _digits(key, "iban" + plain[:2] + re.sub(r"\d", "0", body), re.sub(r"\D", "", body))
        body = _refill(body, digits, r"\d")
        number = int("".join(str(int(c, 36)) for c in body + plain[:2] + "00"))
        return _refill(value, plain[:2] + f"{98 - number % 97:02d}" + body, r"\S")
    if kind == "token":
        prefix = re.match(rf"{_TOKEN_PREFIX}|", value)[0]
        if not any(map(str.isalnum, value[len(prefix) :])):
            prefix = ""
        body, n, out = value[len(prefix) :] + "a" * more, 0, []
        alphabet = "0123456789abcdef" if re.fullmatch(r"[0-9a-f]+", body) else "0123456789ABCDEF" if re.fullmatch(r"[0-9A-F]+", body) else "" if any(map(str.isalnum, body)) else SIGNS
        seed = value if len(value) <= 128 else hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()  # long values are hashed once
        for i, c in enumerate(body):
            if i % 32 == 0:
                n = _mac(key, "token", seed, i, attempt)
            n, r = divmod(n, 256)
            if alphabet:
                out.append(alphabet[r % 16])
            else:
                out.append(chr(48 + r % 10) if c.isdigit() else chr((97 if c.islower() else 65) + r % 26) if c.isalpha() else c)
        return prefix + "".join(out)
    raise ValueError(kind)


def name_word(key: bytes, kind: str, word: str, attempt: int = 0) -> str:
    """``kind``: given:SCRIPT:GENDER or family:SCRIPT. From the list; else two names joined by a hyphen, from the third attempt on one more with each."""
    what, script, *sex = kind.split(":")
    names = GIVEN[script, sex[0]] if what == "given" else FAMILY[script]
    if attempt == 0 and word in names:  # a permutation within the list
        return names[derange(key, kind, names.index(word), len(names))]
    parts = 2 if attempt < 3 else attempt
    drawn = (_mac(key, kind, word, attempt, *([i] if i else [])) >> 16 * j for i in range(-(-parts // 15)) for j in range(15))
    return "-".join(names[n % len(names)] for n, _ in zip(drawn, range(parts)))


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities as (start, end, kind, value), in order, without overlaps; each name word is one of its own."""
    found = []
    if _CANDIDATE.search(text) or any(w in text for w in _WORDS):
        for m in _KINDS.finditer(text):
            kind = m.lastgroup
            value = m[kind]
            if kind == "card" and not 13 <= sum(c.isdigit() for c in value) <= 19:
                continue
            if kind == "phone" and not (7 <= sum(c.isdigit() for c in value) <= 15):
                continue
            if kind == "secret" and _MASK.fullmatch(value):
                continue
            if kind == "email":
                value = value.rstrip(".-")
            at = m.start(kind)
            found.append((at, at + len(value), "token" if kind == "secret" else kind, value))
    if ":" in text:
        for m in _IPV6.finditer(text):
            if m[0].count(":") >= 3 and any(map(str.isdigit, m[0])) and _is_address(m[0]):
                found.append((m.start(), m.end(), "ip6", m[0]))
    if _NAME_HINT.search(text):
        named: dict[str, str] = {}
        for m in _NAME.finditer(text):
            title, part = m["title"] or (m["loud"] or "").capitalize(), "rest" if m["title"] else "shout" if m["loud"] else "full"
            words = m[part].split(" ")
            plain = [canonical("given:", w) for w in words]
            if part == "shout" and not any(w in _GENDER or w in _FAMILY for w in plain):
                continue  # "MS OFFICE", "DR UNIT": capitals alone make no name
            if title:  # a name ends before a word that begins a sentence
                words = words[: next((i for i, w in enumerate(plain) if w in NO_NAMES), len(words))]
            sex = HONORIFICS.get(title, "") or next((_GENDER[w][1] for w in plain if w in _GENDER), "m")
            at = m.start(part)
            for i, w in enumerate(words):
                name = plain[i]
                given = name in _GENDER and (i > 0 or not title) or title and i == 0 and len(words) > 1
                kind = f"given:{_script(w)}:{_GENDER[name][1] if name in _GENDER else sex}" if given else f"family:{_script(w)}"
                if given or title or name in _FAMILY or i == len(words) - 1:
                    found.append((at, at + len(w), kind, w))
                    named.setdefault(name, kind)
                at += len(w) + 1
        if named:  # the same words elsewhere in the text
            again = re.compile(rf"(?<![\w@.-])(?:{'|'.join(re.escape(x) for n in sorted(named, key=len, reverse=True) for x in dict.fromkeys((n, n.upper())))})(?![\w@-])")
            found += [(m.start(), m.end(), named[canonical("given:", m[0])], m[0]) for m in again.finditer(text)]
    found = sorted(dict.fromkeys(found))
    out: list[tuple[int, int, str, str]] = []
    for x in found:  # the first of overlapping ones stays
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def _is_address(text: str) -> bool:
    try:
        ipaddress.ip_address(text)
    except ValueError:
        return False
    return True


def replacement(key: bytes, kind: str, value: str, attempts: dict[tuple[str, str], int]) -> str:
    n = attempts.get((kind, canonical(kind, value)), 0) if attempts else 0
    if ":" not in kind:
        return surrogate(key, kind, value, n)
    made = name_word(key, kind, canonical(kind, value), n)
    return made.upper() if value.isupper() else made


def redact(key: bytes, text: str, attempts: dict[tuple[str, str], int]) -> tuple[str, int, set[tuple[str, str]]]:
    """The text with surrogates, the number of replacements, the distinct entities."""
    found, out, at = find(text), [], 0
    for a, b, kind, value in found:
        out += (text[at:a], replacement(key, kind, value, attempts))
        at = b
    return "".join([*out, text[at:]]) if found else text, len(found), {(k, canonical(k, v)) for *_, k, v in found}


#: Kinds drawn by hash; the others are permuted and cannot collide.
DRAWN = ("email", "token", "given", "family")


def entities(docs: DataFrame) -> DataFrame:
    """Distinct drawn entities (kind, value) of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in dicts(batches):
            seen = {(k, canonical(k, v)) for t in b["text"] if t for *_, k, v in find(t) if k.startswith(DRAWN)}
            if seen:
                kinds, values = zip(*sorted(seen), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(values)], ["kind", "value"])

    return docs.select("text").mapInArrow(lean(run), "kind string, value string").distinct()


def collisions(found: DataFrame, key: bytes) -> DataFrame | None:
    """Entities (kind, value, attempt) that need another attempt for all surrogates to differ; None: there are none.

    Each round aggregates the surrogates of all entities under their present attempts and moves on all but
    the least entity of each that is shared, or that equals its own original.
    """
    # Given names of both genders meet, as do all kinds that look alike: the space is the kind before the first colon.
    @F.pandas_udf("string")
    def make(kind, value, attempt):  # noqa: ANN001
        import pandas as pd

        return pd.Series([name_word(key, k, v, n) if ":" in k else surrogate(key, k, v, n) for k, v, n in zip(kind, value, attempt, strict=True)])

    now = found.withColumn("attempt", F.lit(0))
    for step in itertools.count():  # surrogates grow with the attempt, so this ends
        made = staged(now.withColumn("made", make("kind", "value", "attempt")).withColumn("space", F.substring_index("kind", ":", 1)), "pii-round")
        # The least entity of each surrogate keeps it, those that moved earlier after those that have not.
        first = made.groupBy("space", "made").agg(F.min(F.struct("attempt", "kind", "value")).alias("first"), F.count("*").alias("n"))
        stay = first.where("n > 1").select("space", "made", "first")
        lose = made.join(stay, ["space", "made"], "left").withColumn(
            "lost", (F.col("first").isNotNull() & (F.struct("attempt", "kind", "value") != F.col("first"))) | (F.col("made") == F.col("value"))
        )
        moved = lose.select("kind", "value", (F.col("attempt") + F.coalesce(F.col("lost"), F.lit(False)).cast("int")).alias("attempt"), F.coalesce("lost", F.lit(False)).alias("lost"))
        moved = staged(moved, "pii-moved")
        if not moved.where("lost").limit(1).count():
            out = moved.where("attempt > 0").select("kind", "value", "attempt")
            return out if step else None
        now = moved.drop("lost")


def surrogates(docs: DataFrame, key: str) -> DataFrame:
    """All columns of ``docs``, ``text`` with surrogates; ``pii_entities`` replacements and ``pii_distinct`` entities."""
    small_batches(docs.sparkSession)
    secret = key.encode()
    again = collisions(staged(entities(docs), "pii-entities"), secret)
    few = again is None or again.count() <= BROADCAST_ENTITIES

    def result(text: str | None, attempts: dict) -> dict:
        if text is None:
            return {"text": None, "n": 0, "distinct": 0}
        new, n, seen = redact(secret, text, attempts)
        return {"text": new, "n": n, "distinct": len(seen)}

    if few:
        attempts = {} if again is None else {(r["kind"], r["value"]): r["attempt"] for r in again.collect()}

        @F.pandas_udf("text string, n int, distinct int")
        def apply(texts):  # noqa: ANN001
            import pandas as pd

            return pd.DataFrame([result(t, attempts) for t in texts], columns=["text", "n", "distinct"])

        out = docs.withColumn("__pii_out", apply("text"))
    else:
        keyed = docs.withColumn("__pii_row", F.xxhash64("text"))

        def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in dicts(batches):
                rows = [(r, k, canonical(k, v)) for r, t in zip(b["__pii_row"], b["text"], strict=True) if t for *_, k, v in find(t) if k.startswith(DRAWN)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*set(rows), strict=True)], ["__pii_row", "kind", "value"])

        pairs = keyed.select("__pii_row", "text").mapInArrow(lean(needs), "__pii_row long, kind string, value string").distinct().join(again, ["kind", "value"])
        maps = pairs.groupBy("__pii_row").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("__pii_map"))  # a text's own entities only

        @F.pandas_udf("text string, n int, distinct int")
        def apply_with(texts, moved):  # noqa: ANN001
            import pandas as pd

            return pd.DataFrame([result(t, {} if m is None else {(e["kind"], e["value"]): e["attempt"] for e in m}) for t, m in zip(texts, moved, strict=True)], columns=["text", "n", "distinct"])

        out = keyed.join(maps, "__pii_row", "left").withColumn("__pii_out", apply_with("text", "__pii_map")).drop("__pii_row", "__pii_map")
    return out.withColumn("text", F.col("__pii_out.text")).withColumns({"pii_entities": F.col("__pii_out.n"), "pii_distinct": F.col("__pii_out.distinct")}).drop("__pii_out")


#: The key of the registered queries where the session names none in ``KEY_SETTING``; a real corpus needs a secret one.
DEMO_KEY, KEY_SETTING = "fathomline-demo-key", "spark.fathomline.pii.key"


def session_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, DEMO_KEY)


def query(docs: DataFrame, key: str | None = None) -> DataFrame:
    return surrogates(docs.select("doc_id", "text"), key or session_key(docs.sparkSession)).select("doc_id", "text", "pii_entities", "pii_distinct")
