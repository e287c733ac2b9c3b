"""Personal data: detected entities are replaced by keyed surrogates of the same type and format.

A surrogate is the next in a keyed order of all strings of the entity's shape (digits stay digits,
vowels vowels of the same script and case, names names of the same gender and script), so every
entity changes, different entities get different surrogates and one entity gets the same one in
every document, however many of a shape are in use. A check over all entities found holds the
surrogates against that.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from secrets import token_hex

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import load, text_udf, with_struct

#: Where the key is looked for: a setting of the session, then a variable of the driver's environment.
KEY_SETTING, KEY_VARIABLE = "spark.quillstone.surrogate.key", "QUILLSTONE_SURROGATE_KEY"
KINDS = ("email", "phone", "ip", "card", "ssn", "name")

# Given names by script and gender, and titles by gender.
GIVEN = {
    ("latin", "f"): ("Alice", "Anna", "Carmen", "Claire", "Elena", "Emma", "Greta", "Heidi", "Isabel", "Julia", "Laura", "Lucia", "Maria", "Nora", "Petra", "Sofia"),
    ("latin", "m"): ("Albert", "Anton", "Carlos", "David", "Emil", "Erik", "Felix", "Hans", "Hugo", "James", "Jorge", "Karl", "Louis", "Martin", "Oliver", "Pedro"),
    ("greek", "f"): ("Αθηνά", "Άννα", "Ελένη", "Ειρήνη", "Κατερίνα", "Μαρία", "Σοφία", "Χριστίνα"),
    ("greek", "m"): ("Αλέξανδρος", "Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος"),
    ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Татьяна"),
    ("cyrillic", "m"): ("Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Николай", "Павел", "Сергей"),
}
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra"), "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr"), "": ("Dr", "Prof")}
# Words after which a name of two words stands.
CUES = ("name is", "name:", "Name:", "NAME:", "Name ist", "heiße", "m'appelle", "nom est", "llamo", "nombre es")
# Letters by script; vowels stand for vowels and consonants for consonants.
VOWELS = ("aeiou", "äöüáéíóúàèìòùâêîôû", "αεηιουω", "άέήίόύώ", "аеёиоуыэюя")
CONSONANTS = ("bcdfghjklmnpqrstvwxyz", "çñß", "βγδζθκλμνξπρσςτφχψ", "бвгджзйклмнпрстфхцчшщъь")

DIGITS = "0123456789"
NUMBERS = re.compile(r"[0-9][0-9().\x20-]{5,}[0-9]")
PATTERNS = (
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", re.A)),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", re.A)),
    ("card", re.compile(r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})(?!\d)", re.A)),
    ("phone", re.compile(r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}([.-])\d{3}\1\d{4}(?![\d-])", re.A)),
)
LOCAL = re.compile(r"[\w.%+-]{1,64}\Z")
DOMAIN = re.compile(r"(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,}")
_NAMED = "|".join(re.escape(n) for names in GIVEN.values() for n in names)
_TITLED = "|".join(re.escape(t) for titles in TITLES.values() for t in titles)
_CUED = "|".join(re.escape(c) for c in CUES)
NAME = re.compile(
    rf"(?:(?P<title>{_TITLED})\b\.?[ ](?P<one>[^\W\d_]+)(?:[ ](?P<two>[^\W\d_]+))?|(?P<given>{_NAMED})\b[ ](?P<family>[^\W\d_]+)"
    rf"|(?:{_CUED})[ ]{{1,4}}(?P<first>[^\W\d_]+)[ ](?P<last>[^\W\d_]+))"
)
GENDER = {t: g for g, titles in TITLES.items() for t in titles}
POOL = {n: k for k, names in GIVEN.items() for n in names}

#: kind, canonical form, and the spans of the text that spell it, start and end.
Entity = tuple[str, str, list[tuple[int, int]]]


def _proper(word: str | None) -> bool:
    return bool(word) and word[0].isupper() and (len(word) == 1 or word[1:].islower())


@lru_cache(maxsize=1)
def _name_finder():
    import ahocorasick

    finder = ahocorasick.Automaton()
    for word in (*POOL, *GENDER, *CUES):
        finder.add_word(word, len(word))
    finder.make_automaton()
    return finder


def _names(text: str) -> Iterator[Entity]:
    for end, size in _name_finder().iter(text):
        start = end + 1 - size
        if start and text[start - 1].isalnum() or not (m := NAME.match(text, start)):
            continue
        if m["given"]:
            parts = ("given", "family") if _proper(m["family"]) else ()
        elif m["first"]:
            parts = ("first", "last") if _proper(m["first"]) and _proper(m["last"]) and m["first"] not in GENDER else ()
        else:
            parts = (("one", "two") if _proper(m["two"]) else ("one",)) if _proper(m["one"]) else ()
        if parts:
            yield "name", " ".join(m[p] for p in parts), [m.span(p) for p in parts]


def _emails(text: str) -> Iterator[Entity]:
    at = text.find("@")
    while at >= 0:
        local, domain = LOCAL.search(text[max(0, at - 64) : at]), DOMAIN.match(text, at + 1)
        if local and domain and (start := local.group().lstrip(".%+-")):
            a, b = at - len(start), domain.end()
            yield "email", "".join(c.lower() if len(c.lower()) == 1 else c for c in text[a:b]), [(a, b)]
        at = text.find("@", at + 1)


def _numbers(text: str) -> Iterator[Entity]:
    for m in NUMBERS.finditer(text):
        shift = max(0, m.start() - 2)  # for a plus sign or a bracket
        near = text[shift : m.end() + 1]
        taken = bytearray(len(near))  # a one where a find stands
        for kind, pattern in PATTERNS:
            for k in pattern.finditer(near):
                a, b = k.start() + shift, k.end() + shift
                if taken.find(1, k.start(), k.end()) >= 0:
                    continue
                word = (text[a - 1 : a], text[b : b + 1])
                if any(c.isalnum() or c == "_" for c in word) or kind == "ip" and any(int(x) > 255 for x in k.group().split(".")):
                    continue
                taken[k.start() : k.end()] = b"\x01" * (b - a)
                canonical = ".".join(str(int(x)) for x in k.group().split(".")) if kind == "ip" else re.sub(r"\D", "", k.group())
                yield kind, canonical, [(a, b)]


def detect(text: str) -> list[Entity]:
    """Entities by position; of overlapping ones the first, then the longest."""
    found = [*_emails(text), *_numbers(text)]
    found += _names(text)
    found.sort(key=lambda e: (e[2][0][0], -e[2][-1][1]))
    out: list[Entity] = []
    for e in found:
        if not out or e[2][0][0] >= out[-1][2][-1][1]:
            out.append(e)
    return out


def _listed(c: str) -> str:
    """The fixed alphabet of a character, or nothing."""
    if c in DIGITS:
        return DIGITS
    low = c.lower()
    for letters in (*VOWELS, *CONSONANTS):
        if len(low) == 1 and low in letters:
            same = letters if c == low else "".join(x.upper() for x in letters if len(x.upper()) == 1 and x.upper().lower() == x)
            return same if c in same else ""
    return ""


@lru_cache(maxsize=1)
def _unlisted() -> dict[str, str]:
    """The alphabets of letters and numerals outside the lists: by script, category and case, vowels apart.

    Those alone in theirs share one for each category and case.
    """
    groups: dict[tuple, list[str]] = defaultdict(list)
    for c in map(chr, range(sys.maxunicode + 1)):
        if (c.isalpha() or c.isalnum()) and not _listed(c):
            vowel = any(unicodedata.normalize("NFD", c)[0].lower() in v for v in VOWELS)
            # characters that lower() changes stay apart from those of a canonical form
            kind = (unicodedata.category(c), c.isupper(), c.islower(), len(c.lower()), c.lower() == c)
            groups[(unicodedata.name(c, "").split(" ")[0], vowel, *kind)].append(c)
    alone: dict[tuple, list[str]] = defaultdict(list)
    for key, letters in groups.items():
        if len(letters) == 1:
            alone[key[2:]] += letters
    sets = [*(x for x in groups.values() if len(x) > 1), *alone.values()]
    return {c: letters for x in sets for letters in ["".join(x)] for c in x}


@lru_cache(maxsize=10_000)
def _alphabet(c: str) -> str:
    return _listed(c) or (_unlisted().get(c, c) if c.isalnum() else c)


def _mixed(half: int, part: int, turn: int, key: bytes) -> int:
    data = part.to_bytes((half + 7) // 8, "big")
    return int.from_bytes(hashlib.blake2b(data, key=key, person=turn.to_bytes(2, "big"), digest_size=min(64, (half + 7) // 8 + 8)).digest(), "big") & (1 << half) - 1


def permute(value: int, size: int, key: bytes, back: bool = False) -> int:
    """A keyed permutation of the numbers under `size`, or its inverse: a Feistel network, walked until it is within."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for turn in reversed(range(6)) if back else range(6):
            if back:
                left, right = right ^ _mixed(half, left, turn, key), left
            else:
                left, right = right, left ^ _mixed(half, right, turn, key)
        value = left << half | right
        if value < size:
            return value


def following(value: int, size: int, key: bytes) -> int:
    """The next of the numbers under `size` in a keyed order, the first after the last: one cycle, so none stays from a size of 2."""
    return permute((permute(value, size, key) + 1) % size, size, key, back=True)


def permute_shape(text: str, key: bytes) -> str:
    """The next text in a keyed order of all texts of its shape."""
    alphabets = [_alphabet(c) for c in text]
    value, size = 0, 1
    for c, letters in zip(text, alphabets, strict=True):
        value, size = value * len(letters) + letters.index(c), size * len(letters)
    value = following(value, size, key)
    out = []
    for letters in reversed(alphabets):
        value, i = divmod(value, len(letters))
        out.append(letters[i])
    return "".join(reversed(out))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _walk(value: str, step: Callable[[str], str], fits: Callable[[str], bool]) -> str:
    """Steps from a fitting value to the next fitting one; a cycle stays one on the values that fit."""
    value = step(value)
    while not fits(value):
        value = step(value)
    return value


@lru_cache(maxsize=64)
def _cycle(script: str, gender: str, key: bytes) -> dict[str, str]:
    """Each given name of a pool to the next in keyed order."""
    order = sorted(GIVEN[script, gender], key=lambda n: hashlib.blake2b(n.encode(), key=key).digest())
    return dict(zip(order, order[1:] + order[:1], strict=True))


def configured_key(spark: SparkSession) -> str:
    """The key of the session's setting, else of the environment, else one drawn at random for this application.

    A drawn key is held in the driver's memory only: surrogates are then the same throughout the
    application, differ in the next one, and nobody can undo them afterwards.
    """
    given = spark.conf.get(KEY_SETTING, None) or os.environ.get(KEY_VARIABLE)
    if given:
        return given
    context = spark.sparkContext
    if not hasattr(context, "_quillstone_drawn_key"):
        context._quillstone_drawn_key = token_hex(32)
    return context._quillstone_drawn_key


def surrogate(kind: str, canonical: str, secret: str) -> str:
    """The canonical form's replacement, in canonical form."""
    key = hashlib.blake2b(f"{secret}/{kind}/0".encode(), digest_size=32).digest()
    if kind == "email":
        local, _, domain = canonical.partition("@")
        labels = domain.split(".")
        free = any(len(_alphabet(c)) > 1 for c in local)
        step = lambda x: permute_shape(x, key)
        new = [step(x) for x in labels[:-2]]
        if not free:  # then the domain has to change
            new.append(step(labels[-2]))
        elif labels[-2] == "example":  # names reserved for examples stay, and others do not become one
            new.append("example")
        else:
            new.append(_walk(labels[-2], step, lambda x: x != "example"))
        return step(local) + "@" + ".".join([*new, labels[-1]])
    if kind == "ip":
        return ".".join(map(str, following(int.from_bytes(bytes(map(int, canonical.split("."))), "big"), 1 << 32, key).to_bytes(4, "big")))
    if kind == "card":
        valid = luhn(canonical)
        return _walk(canonical, lambda s: permute_shape(s, key), lambda s: luhn(s) == valid)
    if kind == "name":
        # word by word, so that a family name has one surrogate with and without a given name
        return " ".join(
            _cycle(*POOL[w], key)[w] if w in POOL else _walk(w, lambda x: permute_shape(x, key), lambda x: x not in POOL) for w in canonical.split(" ")
        )
    return permute_shape(canonical, key)


def _spelled(original: str, canonical: str, kind: str) -> str:
    """The surrogate in the original's punctuation and case."""
    if kind == "email":
        return "".join(n.upper() if o.isupper() and len(n.upper()) == 1 else n for o, n in zip(original, canonical, strict=True))
    if kind in ("phone", "card", "ssn"):
        digits = iter(canonical)
        return "".join(next(digits) if c.isdigit() else c for c in original)
    return canonical


def replacer(secret: str) -> Callable[[str], tuple]:
    """A function from a text to the rewritten text, the number of entities and the kinds with spans before rewriting."""

    @lru_cache(maxsize=50_000)
    def made(kind: str, canonical: str) -> str:
        return surrogate(kind, canonical, secret)

    def rewrite(text: str) -> tuple[str, int, str]:
        entities = detect(text)
        if not entities:
            return text, 0, ""
        out, done = [], 0
        for kind, canonical, spans in entities:
            new = made(kind, canonical)
            for (a, b), part in zip(spans, new.split(" ") if kind == "name" else [new], strict=True):
                out += [text[done:a], _spelled(text[a:b], part, kind)]
                done = b
        out.append(text[done:])
        return "".join(out), len(entities), ",".join(f"{k}:{s[0][0]}:{s[-1][1]}" for k, _, s in entities)

    return rewrite


ENTITIES = "kind string, canonical string, surrogate string"


def entities_of(df: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """The distinct entities of all texts with their surrogates: kind, canonical, surrogate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {(k, c) for t in b.column(0) for k, c, _ in detect(t.as_py() or "")}
            if found:
                kinds, canonical = zip(*found, strict=True)
                made = [surrogate(k, c, secret) for k, c in found]
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(canonical), pa.array(made)], names=["kind", "canonical", "surrogate"])

    return df.select(F.col(f"`{text}`")).mapInArrow(run, ENTITIES).distinct()


def check_surrogates(entities: DataFrame) -> None:
    """Raises an error if an entity stays as it is or shares its surrogate; the keyed orders rule both out."""
    by_surrogate = entities.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.max(F.col("canonical") == F.col("surrogate")).alias("stays"))
    wrong = by_surrogate.where("n > 1 or stays").select("kind").first()
    if wrong:
        raise RuntimeError(f"an entity of kind {wrong[0]} stays or shares its surrogate")


def replace_entities(df: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """`df` with the text rewritten, n_entities, and entities (kind:start:end in the old text, by commas).

    `secret` is the key of the surrogates; who has it can undo them, so it belongs to the
    application's secrets and has no default; an empty one is an error. Null texts stay null and have no entities. Rows and other columns stay; columns named like a
    new one are replaced. Entities are compared over all rows of `df`: equal ones get equal
    surrogates, different ones different ones. Texts are read twice and never shuffled.
    """
    if not secret:
        raise ValueError("surrogates need a key")
    check_surrogates(entities_of(df, secret, text))
    names = ["_new", "n_entities", "entities"]
    made = with_struct(df, text_udf("_new string, n_entities int, entities string", lambda: replacer(secret))(F.col(f"`{text}`")), names)
    new = F.when(F.col(f"`{text}`").isNotNull(), F.col("_new")).alias(text)
    return made.select(*[new if c == text else F.col(f"`{c}`") for c in made.columns if c != "_new"])


def op4_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, configured_key(spark)).select("doc_id", "text", "n_entities", "entities")
