"""Secret scan: fixed patterns, and strings that a tiktoken vocabulary compresses badly.

A string of letters and digits that was drawn at random takes a token for every one or two
characters, where words and names take one for several. Known digests and identifiers are
left out before that test.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import load, text_udf, with_struct

#: Kinds in the order that breaks ties of their starts.
KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = "[A-Za-z0-9+/_=.-]"
#: Words in lower case, upper case or with a capital, joined by other signs.
SPELLED = re.compile(r"[._/=+-]*(?:(?:[A-Z]?[a-z]*|[A-Z]+)(?:[._/=+-]+|\Z))*")
#: Characters that do not count at a candidate's ends.
EDGES = "=._-/+"
#: Lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
NUMBER = re.compile(r"[0-9.+=/_-]+")
TIME = re.compile(r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_][0-9.+-]*Z?")
#: Runs of one class of characters, which no two classes share, so that a string is read once.
RUN = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|[._/=+-]+")
#: Digits that a number in an identifier has at most.
IDENTIFIER_DIGITS = 8
#: Candidates are encoded in parts of so many characters, as a vocabulary's merges take more than linear time in a long run of letters.
PART = 256

MAX_CHARS_PER_TOKEN = 2.2
#: Shorter strings have too few tokens to tell chance from design: of mixed characters, and spelled like rare words.
LEAST_MIXED, LEAST_LETTERS = 12, 20


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str | None = None):
    """The encoding of a rank file; a worker keeps it from task to task."""
    import public_tokenizers
    import tiktoken

    with open(path or default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(s: str, encode: Callable[[str], list[int]]) -> int:
    """Tokens of a string, taken in parts."""
    return sum(len(encode(s[i : i + PART])) for i in range(0, len(s), PART))


def _tokens(word: str, encode: Callable[[str], list[int]]) -> int:
    """Tokens of a word in its own case or in lower case, the fewer of both."""
    return min(token_count(word, encode), token_count(word.lower(), encode))


def identifier_words(s: str) -> list[str] | None:
    """The words of an identifier: words or names of letters with short numbers, joined by . - _ / or a change of case; null for other strings.

    A word has two letters or more: a lower-case run, with the capital before it, or an upper-case
    run. A single letter may stand before a number only. Numbers have few digits, and make less
    than a quarter of the string.
    """
    runs = RUN.findall(s)
    if sum(map(len, runs)) != len(s) or 4 * sum(len(r) for r in runs if r.isdigit()) >= len(s):
        return None
    words: list[str] = []
    for i, r in enumerate(runs):
        after = runs[i + 1] if i + 1 < len(runs) else ""
        if r.isdigit():
            if len(r) > IDENTIFIER_DIGITS:
                return None
        elif r.isupper():
            if after.islower():
                own, after = r[:-1], r[-1] + after
                if len(own) > 1:
                    words.append(own)
                elif own:
                    return None
                if len(after) > 2:
                    words.append(after)
            elif len(r) > 1:
                words.append(r)
            elif not after.isdigit():
                return None
        elif r.islower() and not (i and runs[i - 1].isupper()):
            if len(r) > 1:
                words.append(r)
            elif not after.isdigit():
                return None
        elif r.islower() and len(r) == 1 and not after.isdigit():
            return None  # a capital and one letter
    return words


def is_known(s: str, encode: Callable[[str], list[int]], limit: float) -> bool:
    """A digest, a UUID, a number, a time, or an identifier whose words are tokens or compress well, each and all together."""
    if len(s) in DIGEST_LENGTHS and DIGEST.fullmatch(s) or UUID.fullmatch(s) or NUMBER.fullmatch(s) or TIME.fullmatch(s):
        return True
    words = identifier_words(s)
    if not words:
        return False
    counts = [(len(w), _tokens(w, encode)) for w in words]
    return all(k == 1 or n >= limit * k for n, k in counts) and sum(n for n, _ in counts) >= limit * sum(k for _, k in counts)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(*m.span(), 1) for m in ACCESS.finditer(text)]
    return sorted(found + [(*m.span(), 2) for m in HEX.finditer(text)], key=lambda x: (x[0], x[2]))


def random_spans(text: str, taken: list[tuple[int, int, int]], encode: Callable[[str], list[int]], limit: float, mixed: int = LEAST_MIXED, letters: int = LEAST_LETTERS) -> list[tuple[int, int, int]]:
    """Candidates clear of the `taken` spans (by start) that need a token for every `limit` characters or fewer.

    They have `letters` characters or more, or `mixed` if they hold a digit or a change of case that no word has.
    """
    found = []
    i, reach = 0, 0  # spans that start before the candidate's end, and how far they reach
    for m in re.finditer(f"{CANDIDATE}{{{min(mixed, letters)},}}", text):
        whole = m.group()
        s = whole.strip(EDGES)
        if len(s) < letters and (len(s) < mixed or SPELLED.fullmatch(s)):
            continue
        start = m.start() + len(whole) - len(whole.lstrip(EDGES))
        end = start + len(s)
        while i < len(taken) and taken[i][0] < end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach > start:
            continue
        if len(s) < limit * token_count(s, encode) and not is_known(s, encode, limit):
            found.append((start, end, 3))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def scanner(path: str | None = None, limit: float = MAX_CHARS_PER_TOKEN, mixed: int = LEAST_MIXED, letters: int = LEAST_LETTERS) -> Callable[[str], tuple]:
    encode = None

    def scan(text: str) -> tuple:
        nonlocal encode
        base = base_spans(text)
        if encode is None:
            encode = encoder(path).encode_ordinary
        extra = random_spans(text, base, encode, limit, mixed, letters)
        every = sorted(base + extra, key=lambda x: (x[0], x[2]))
        n = [sum(k == kind for _, _, k in base) for kind in range(3)]
        return *n, len(extra), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)

    return scan


FIELDS = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


def scan_secrets(df: DataFrame, text: str = "text", ranks: str | None = None, limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """`df` with the counts n_assign, n_access, n_hex and n_random, base_sha256, and spans.

    spans lists kind:start:end (code points, the end exclusive) by start, then kind, joined by
    commas; base_sha256 is the digest of that list without the random kind. Null and empty texts
    have no spans and so the digest of the empty string. Rows stay as they are; columns named
    like a new one are replaced. No shuffle.
    """
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return with_struct(df, text_udf(FIELDS, lambda: scanner(ranks, limit))(F.col(text)), names)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(load(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"
    )
