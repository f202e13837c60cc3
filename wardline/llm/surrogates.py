"""Surrogates for personal data: keyed stand-ins of the same kind and form, one for each entity of the corpus."""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardline.session import materialize

#: For tests and the registered query; a deployment passes its own secret.
DEMO_KEY = b"not a secret"
ROUNDS = 64

# Titles by gender, and common given names by gender and script.
MALE_TITLES = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "господин", "Κύριος")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita",
                 "Doña", "Госпожа", "госпожа", "Κυρία")
GIVEN = {
    ("m", "latin"): ("Adam", "Albert", "Bruno", "Carlos", "Daniel", "Emil", "Felix", "Georg", "Hugo", "Jonas", "Karl",
                     "Leon", "Louis", "Martin", "Noah", "Oscar", "Pablo", "Ralph", "Samuel", "Victor"),
    ("f", "latin"): ("Alice", "Anna", "Bella", "Carla", "Clara", "Diana", "Elena", "Emma", "Flora", "Greta", "Helen",
                     "Irene", "Julia", "Laura", "Lena", "Maria", "Nora", "Olivia", "Rosa", "Sofia"),
    ("m", "cyrillic"): ("Алексей", "Андрей", "Борис", "Виктор", "Иван", "Максим", "Михаил", "Николай", "Олег", "Павел"),
    ("f", "cyrillic"): ("Анна", "Вера", "Галина", "Елена", "Ирина", "Мария", "Надежда", "Наталья", "Ольга", "Татьяна"),
    ("m", "greek"): ("Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"),
    ("f", "greek"): ("Άννα", "Ελένη", "Ειρήνη", "Κατερίνα", "Μαρία", "Σοφία"),
}
# Sounds that names beyond the lists are built of, endings of given names by gender, and of surnames, which stay.
SOUNDS = {"latin": ("bdfghjklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδκλμνπρτφ", "αειο")}
ENDINGS = {
    ("m", "latin"): ("bert", "lor", "mus", "rick", "ton"), ("f", "latin"): ("lia", "na", "ra", "ssa", "tta"),
    ("m", "cyrillic"): ("дан", "мир", "рий", "слав"), ("f", "cyrillic"): ("лина", "на", "рия", "са"),
    ("m", "greek"): ("λης", "νος", "ρας"), ("f", "greek"): ("λια", "νη", "ρα"),
}
SURNAME_ENDINGS = ("dottir", "son", "ova", "ová", "ski", "ska", "ский", "ская", "ова", "ева", "ина", "ов", "ев", "ин",
                   "άκης", "ίδης", "ου", "ος", "ης")

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NAME = r"[^\W\d_a-zа-яα-ω][\w'’-]*[^\W\d_]"
_TITLES = "|".join(sorted(map(re.escape, MALE_TITLES + FEMALE_TITLES), key=len, reverse=True))
_PATTERNS = [(kind, re.compile(pattern)) for kind, pattern in (
    ("secret", r"(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s*[:=]\s*[\"']?)"
               r"(?P<value>(?=[\w+/=.-]*\d)[\w+/=.-]{16,})"),
    ("email", r"(?P<value>[^\W_](?:[\w.+%-]{0,62}[\w+%-])?@(?:[^\W_](?:[\w-]{0,61}[^\W_])?\.)+[^\W\d_]{2,24})"),
    ("iban", r"(?<![\w])(?P<value>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![\w])"),
    ("card", r"(?<![\d.])(?P<value>\d{13,19}|\d{4}([ -])\d{4}\2\d{4}\2\d{4}|\d{4}([ -])\d{6}\3\d{5})(?!\d)"),
    ("ip", rf"(?<![\d.])(?P<value>(?:{_OCTET}\.){{3}}{_OCTET})(?!\d|\.\d)"),
    ("phone", r"(?<![\w+])(?P<value>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?(?:\d{3,4}[ .-]?\d{3,4}|\d{2}(?:[ .-]\d{2}){2,3})"
              r"|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\d)"),
    ("person", rf"(?<!\w)(?P<title>{_TITLES})\.?[ \u00a0](?P<value>{_NAME}(?: {_NAME}){{0,2}})"),
)]
_SEAM = re.compile(r"(['’-]+)")
_RUN = re.compile(rf"{_NAME}(?: {_NAME}){{1,2}}")
_POSSESSIVE = re.compile(r"['’][sS]$")
#: Titles that no other title begins with.
_ROOTS = [t for t in dict.fromkeys(MALE_TITLES + FEMALE_TITLES)
          if not any(t != other and t.startswith(other) for other in MALE_TITLES + FEMALE_TITLES)]


def worth_a_look(text: Column) -> Column:
    """Whether a text has a digit of any script, an @ or a title, as every text with an entity does. Plain searches,
    which are far cheaper than one expression with all the titles. Digits that Java may know later than Python all lie
    in the range at the end."""
    found = text.rlike(r"[0-9@]") | text.rlike(r"[\p{Nd}\x{10000}-\x{1FFFF}]")
    for title in _ROOTS:
        found = found | text.contains(title)
    return F.coalesce(found, F.lit(False))


class Mention(NamedTuple):
    kind: str
    value: str
    start: int
    end: int


def _ascii_digits(text: str) -> str:
    return "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def _digit_like(sign: str, digit: int) -> str:
    """The digit in the script of `sign`, a digit as well."""
    return chr(ord(sign) - unicodedata.decimal(sign) + digit)


def _luhn(digits: str) -> int:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        doubled = int(digit) * (1 + place % 2)
        total += doubled - 9 * (doubled > 9)
    return total % 10


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _identity(kind: str, found: str) -> str | None:
    """The entity that a spelling stands for, numbers in ASCII digits; None where it only looks like one."""
    if kind == "email":
        return found.lower()
    if kind == "card":
        digits = _ascii_digits(re.sub(r"\D", "", found))
        brand = digits[0] in "3456" or "22" <= digits[:2] <= "27"
        return digits if brand and _luhn(digits) == 0 else None
    if kind == "iban":
        bare = _ascii_digits(found.replace(" ", ""))
        return bare if len(bare) >= 15 and _iban_rest(bare) == 1 else None
    if kind == "phone":
        return _ascii_digits(re.sub(r"[^\d+]", "", found))
    if kind == "ip":
        return ".".join(str(int(part)) for part in found.split("."))
    return found


def _one_case(name: str) -> str:
    """Names in capitals stand for the same as with one capital."""
    return name.title() if len(name) > 1 and name.isupper() else name


class _Spans:
    """Spans of a text without overlaps."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def take(self, start: int, end: int) -> bool:
        """Adds the span and says so, if it is free."""
        at = bisect_right(self.starts, start)
        if (at and self.ends[at - 1] > start) or (at < len(self.starts) and self.starts[at] < end):
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def _named(whole: str, gender: str) -> list[tuple[str, int, int]]:
    """Kind and span of each part of a name; the last is the surname."""
    parts = [m.span() for m in re.finditer(r"\S+", whole)]
    return [("surname" if end == len(whole) else f"given_{gender}", start, end) for start, end in parts]


def _following(text: str, wholes: dict[str, str], parts: dict[str, str]) -> Iterator[tuple[str, int, int]]:
    """Kind and span wherever whole names (to their gender) or their parts (to their kind) stand as words of their own."""
    # a word with as many seams as a name has, not the whole of a long chain; its heads may be names
    seams = max((len(_SEAM.findall(part)) for part in parts), default=0)
    words = re.compile(rf"(?<!\w)\w+(?:['’-]+\w+){{0,{seams}}}")
    at = 0
    while parts and (word := words.search(text, at)):
        start, pieces = word.start(), _SEAM.split(word[0])
        at = start + len(pieces[0])
        heads = ("".join(pieces[:n]) for n in range(len(pieces), 0, -2))
        head = next((h for h in heads if _one_case(h) in parts), None)
        if head is None:
            continue
        run = _RUN.match(text, start)
        names = run[0].split(" ") if run else []
        for size in (3, 2):
            whole = _POSSESSIVE.sub("", " ".join(names[:size]))
            gender = wholes.get(" ".join(map(_one_case, whole.split(" ")))) if len(names) >= size else None
            if gender:
                yield from ((kind, start + a, start + b) for kind, a, b in _named(whole, gender))
                at = start + len(whole)
                break
        else:
            yield parts[_one_case(head)], start, start + len(head)
            at = start + len(head)


def mentions(text: str | None) -> list[Mention]:
    """Entities in reading order, without overlaps; where kinds overlap the first of the list of patterns wins.

    A name is found behind a title, which tells its gender, and is followed
    through its text, before the title and after it: the whole name and each
    part of it, wherever they stand as words of their own, in capitals and with
    a possessive too. Parts are entities of their own, so a surname alone is
    replaced as it is in the full name; a part that stands in two names of a
    text is what it is in the first. A word that is spelled like a name of its
    text is taken for it. Not found are names that never follow a title, postal
    addresses, national identity numbers, IPv6 addresses, and phone numbers in
    other groupings than those of the pattern.
    """
    if not text:
        return []
    taken: list[Mention] = []
    covered = _Spans()
    wholes: dict[str, str] = {}
    parts: dict[str, str] = {}
    for kind, pattern in _PATTERNS:
        for match in pattern.finditer(text):
            start, end = match.span("value")
            if kind != "person":
                value = _identity(kind, match["value"])
                if value is not None and covered.take(start, end):
                    taken.append(Mention(kind, value, start, end))
                continue
            whole = _POSSESSIVE.sub("", match["value"])
            if not covered.take(start, start + len(whole)):
                continue
            gender = "m" if match["title"] in MALE_TITLES else "f"
            for name, a, b in _named(whole, gender):
                part = _one_case(whole[a:b])
                taken.append(Mention(name, part, start + a, start + b))
                parts.setdefault(part, name)
            wholes.setdefault(" ".join(map(_one_case, whole.split(" "))), gender)
    for kind, start, end in _following(text, wholes, parts):
        if covered.take(start, end):
            taken.append(Mention(kind, _one_case(text[start:end]), start, end))
    return sorted(taken, key=lambda m: m.start)


class _Stream:
    """Numbers drawn from a keyed digest."""

    def __init__(self, key: bytes, *about: object):
        self.key, self.about, self.block, self.left = key, "\x1f".join(map(str, about)).encode("utf-8", "replace"), 0, []

    def below(self, limit: int) -> int:
        if not self.left:
            self.left = list(hmac.digest(self.key, self.about + self.block.to_bytes(4, "big"), hashlib.sha256))
            self.block += 1
            self.left = [int.from_bytes(self.left[i:i + 4], "big") for i in range(0, 32, 4)]
        return self.left.pop() % limit


class _Count:
    """The digits of one number, drawn as from a stream; `number` is 0 when all are drawn."""

    def __init__(self, number: int):
        self.number = number

    def below(self, limit: int) -> int:
        self.number, drawn = divmod(self.number, limit)
        return drawn


def _shaped(text: str, stream: _Stream | _Count) -> str:
    """Digits of the same script for digits, letters of the same case and script for letters; all else stays."""
    out = []
    for sign in text:
        if "а" <= sign <= "я" or "А" <= sign <= "Я":
            out.append(chr(ord("а" if sign >= "а" else "А") + stream.below(32)))
        elif sign.isdecimal():
            out.append(_digit_like(sign, stream.below(10)))
        elif sign.isascii() and sign.isalpha():
            out.append(chr((97 if sign.islower() else 65) + stream.below(26)))
        elif sign.isalpha():
            block = ord(sign) // 64 * 64
            like = [c for c in map(chr, range(block, block + 64)) if c.isalpha() and c.islower() == sign.islower()
                    and c.isupper() == sign.isupper()]
            out.append(like[stream.below(len(like))])
        else:
            out.append(sign)
    return "".join(out)


def _script(text: str) -> str:
    letter = next((c for c in text if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= letter <= "ӿ" else "greek" if "Ͱ" <= letter <= "Ͽ" else "latin" if letter < "ɐ" else "other"


#: Kinds whose stand-ins have a fixed length; those of the others grow with the attempts and cannot run out.
FIXED = ("phone", "ip", "card", "iban")


def _fixed(kind: str, value: str, stream: _Stream | _Count) -> str:
    if kind == "phone":
        head = 2 if value.startswith("+") else 0
        return value[:head] + _shaped(value[head:], stream)
    if kind == "ip":
        return ".".join(str(1 + stream.below(254)) for _ in range(4))
    if kind == "card":
        body = value[0] + _shaped(value[1:-1], stream)
        return body + str(-_luhn(body + "0") % 10)
    body = _shaped(value[4:], stream)
    return f"{value[:2]}{98 - _iban_rest(value[:2] + '00' + body):02d}{body}"


def numbered(kind: str, value: str, number: int) -> str | None:
    """The stand-ins of the form of a value, by number from 0 on; None beyond the last."""
    count = _Count(number)
    found = _fixed(kind, value, count)
    return None if count.number else found


def _built(script: str, stream: _Stream, attempt: int) -> str:
    """A beginning of a name, two syllables and one more for every eight attempts, so that names cannot run out."""
    consonants, vowels = SOUNDS[script]
    return "".join(consonants[stream.below(len(consonants))] + vowels[stream.below(len(vowels))]
                   for _ in range(2 + attempt // 8)).capitalize()


def _surname(part: str, script: str, stream: _Stream, attempt: int) -> str:
    """A surname with the ending of the old one, which can tell gender and language, else one that ends in a consonant."""
    consonants = SOUNDS[script][0]
    ending = next((e for e in SURNAME_ENDINGS if len(e) < len(part) and part.endswith(e)), "")
    last = "ς" if script == "greek" and not ending else consonants[stream.below(len(consonants))]
    return _built(script, stream, attempt) + last + ending


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """A stand-in for an entity: the same for the same key and attempt, of the same kind and form.

    Given names beyond the lists are built of syllables of their script with an
    ending of their gender; surnames keep an ending that they are known by.
    """
    stream = _Stream(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        host, _, top = domain.rpartition(".")
        longer = "".join(chr(97 + stream.below(26)) for _ in range(attempt // 4))
        # a host's stand-in depends on the host alone, so addresses of one host stay together
        return f"{_shaped(local, stream)}{longer}@{_shaped(host, _Stream(key, 'host', domain, 0))}.{top}"
    if kind in FIXED:
        return _fixed(kind, value, stream)
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        digits = "0123456789abcdef" if value == value.lower() else "0123456789ABCDEF"
        return "".join(digits[stream.below(16)] for _ in value)
    script = _script(value)
    if kind.startswith("given_") and script in SOUNDS:
        listed, endings = GIVEN[kind[-1], script], ENDINGS[kind[-1], script]
        if not attempt:
            return listed[stream.below(len(listed))]
        return _built(script, stream, attempt) + endings[stream.below(len(endings))]
    if kind == "surname" and script in SOUNDS:
        return "-".join(_surname(part, script, stream, attempt) for part in value.split("-"))
    return _shaped(value, stream) + "".join(chr(97 + stream.below(26)) for _ in range(attempt // 4))


def _spelled(sign: str, new: str) -> str:
    return _digit_like(sign, int(new)) if sign.isdecimal() and new.isdecimal() else new


def _respelled(mention: Mention, found: str, stand_in: str) -> str:
    """The stand-in in the spelling of the mention: its separators, its case, the script of its digits."""
    if mention.kind in ("phone", "card", "iban"):
        left = iter(stand_in)
        spelled = "".join(_spelled(c, next(left, "")) if c.isalnum() or c == "+" else c for c in found)
        return spelled + "".join(left)
    if mention.kind in ("email", "surname", "given_m", "given_f") and len(found) > 1 and found.isupper():
        return stand_in.upper()
    return stand_in


def replaced(text: str, stand_ins: dict[str, str]) -> tuple[str, int]:
    """The text with every entity of `stand_ins` (by kind and value) replaced, and how many mentions were."""
    out, at, count = [], 0, 0
    for mention in mentions(text):
        name = stand_ins.get(f"{mention.kind}\x1f{mention.value}")
        if name is not None:
            out += [text[at:mention.start], _respelled(mention, text[mention.start:mention.end], name)]
            at, count = mention.end, count + 1
    return "".join([*out, text[at:]]), count


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """`digest` of a text, `kind`, `value`: every entity of every distinct text, once."""

    def found(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = {(digest, m.kind, m.value) for digest, content in zip(batch["digest"], batch["t"]) for m in mentions(content)}
            yield pd.DataFrame(sorted(rows), columns=["digest", "kind", "value"])

    return (docs.where(worth_a_look(F.col(text))).select(_digest(F.col(text)).alias("digest"), F.col(text).alias("t"))
            .mapInPandas(found, "digest string, kind string, value string").distinct())


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def assign(found: DataFrame, key: bytes, rounds: int = ROUNDS) -> DataFrame:
    """`kind`, `value`, `surrogate` for the distinct entities of `found`; no two share one, and none is a real entity.

    Entities draw again until that holds: one that drew the stand-in of another
    gives way unless it is settled or has the lesser value, one that drew a
    real value always does. Only the losers of a round are drawn anew. Those of
    fixed length that still have none after all rounds get the unused values of
    their form in order; it is an error if a form has fewer than it needs.
    """

    def drawn(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["surrogate"] = [surrogate(k, v, key, a) for k, v, a in zip(batch["kind"], batch["value"], batch["attempt"])]
            yield batch

    def draw(wanted: DataFrame) -> DataFrame:
        return wanted.mapInPandas(drawn, "kind string, value string, attempt int, surrogate string")

    real = materialize(found.select("kind", "value").distinct(), "entities")
    state = materialize(draw(real.withColumn("attempt", F.lit(0))).withColumn("settled", F.lit(False)), "surrogates")
    for _ in range(rounds):
        owner = state.groupBy("kind", "surrogate").agg(F.min(F.struct(~F.col("settled"), "value")).getField("value").alias("owner"))
        known = real.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        judged = materialize(
            state.join(owner, ["kind", "surrogate"]).join(known, ["kind", "surrogate"], "left")
            .withColumn("settled", (F.col("owner") == F.col("value")) & F.col("real").isNull())
            .select("kind", "value", "attempt", "surrogate", "settled"), "judged")
        lost = judged.where(~F.col("settled"))
        if lost.isEmpty():
            return judged.select("kind", "value", "surrogate")
        again = draw(lost.select("kind", "value", (F.col("attempt") + 1).alias("attempt"))).withColumn("settled", F.lit(False))
        state = materialize(judged.where(F.col("settled")).unionByName(again), "surrogates")
    settled, lost = state.where("settled").select("kind", "value", "surrogate"), state.where("NOT settled").select("kind", "value")
    if not lost.where(~F.col("kind").isin(*FIXED)).isEmpty():
        raise RuntimeError(f"no distinct surrogates after {rounds} rounds")
    rest = materialize(_unused(real, settled, lost), "unused")
    if rest.count() < lost.count():
        raise RuntimeError("more entities of a form than it has unused values")
    return settled.unionByName(rest)


def _unused(real: DataFrame, settled: DataFrame, lost: DataFrame) -> DataFrame:
    """`kind`, `value`, `surrogate`: the first values of each form that are neither real nor taken, in order for `lost`."""

    def formed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(form=[numbered(k, v, 0) for k, v in zip(batch["kind"], batch["value"])])

    def listed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["surrogate"] = [numbered(k, f, n) for k, f, n in zip(batch["kind"], batch["form"], batch["n"])]
            yield batch[batch["surrogate"].notna()]

    def form(values: DataFrame) -> DataFrame:
        fixed = values.where(F.col("kind").isin(*FIXED)).select("kind", "value")
        return fixed.mapInPandas(formed, "kind string, value string, form string")

    lost = materialize(form(lost), "lost")
    used = real.select("kind", "value").union(settled.select("kind", "surrogate")).distinct()
    counts = form(used).groupBy("kind", "form").agg(F.count("*").alias("taken"))
    # the first `taken` + `wanted` values of a form hold `wanted` unused ones, if it has so many
    wanted = lost.groupBy("kind", "form").agg(F.count("*").alias("wanted")).join(counts, ["kind", "form"], "left")
    most = F.col("wanted") + F.coalesce("taken", F.lit(0)) - 1
    free = (wanted.select("kind", "form", F.explode(F.sequence(F.lit(0).cast("long"), most)).alias("n"))
            .mapInPandas(listed, "kind string, form string, n long, surrogate string")
            .join(used.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti"))
    place = lambda by: F.row_number().over(Window.partitionBy("kind", "form").orderBy(by)).alias("place")
    return (lost.select("*", place("value")).join(free.select("kind", "form", "surrogate", place("n")), ["kind", "form", "place"])
            .select("kind", "value", "surrogate"))


def replace_entities(docs: DataFrame, key: bytes = DEMO_KEY, text: str = "text", count: str | None = None) -> DataFrame:
    """`docs` with the entities in `text` replaced, and the number of mentions replaced as `count` if a name is given.

    The same entity gets the same stand-in in every document, different ones
    different stand-ins. Texts without a digit, an @ or a title take no part in
    any shuffle; the others are joined to their stand-ins by digest, so copies,
    repeated and null keys do not matter. Null and empty texts stay as they are.
    All other columns are returned as they are, whatever their names; one that is
    called `count` gives way to the number.
    """
    found = materialize(entities(docs, text), "mentions")
    named = assign(found, key)
    by_text = (found.join(named, ["kind", "value"])
               .groupBy("digest").agg(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "value"), "surrogate")).alias("pairs"))
               .select(F.struct(F.col("digest"), F.map_from_entries("pairs").alias("names")).alias("wl_stand_ins")))
    by_text = materialize(by_text, "stand_ins")

    @F.pandas_udf("text string, n long")
    def changed(texts: pd.Series, names: pd.Series) -> pd.DataFrame:
        rows = [(t, 0) if n is None else replaced(t, dict(n)) for t, n in zip(texts, names)]
        return pd.DataFrame(rows, columns=["text", "n"])

    quick = worth_a_look(F.col(text))
    # all of a row goes in one struct, so no name of an added column can clash with its own
    rows = docs.where(quick).select(F.struct("*").alias("wl_row"))
    joined = rows.join(by_text, _digest(F.col(f"wl_row.{text}")) == F.col("wl_stand_ins.digest"), "left")
    done = joined.select("wl_row", changed(F.col(f"wl_row.{text}"), F.col("wl_stand_ins.names")).alias("wl_new"))
    kept = [c for c in docs.columns if count is None or c.lower() != count.lower()]
    columns = [F.col("wl_new.text").alias(c) if c == text else F.col(f"wl_row.`{c}`").alias(c) for c in kept]
    rest = docs.where(~quick).select(*[F.col(f"`{c}`") for c in kept])
    if count is not None:
        columns.append(F.col("wl_new.n").alias(count))
        rest = rest.withColumn(count, F.lit(0).cast("long"))
    return rest.unionByName(done.select(*columns))
