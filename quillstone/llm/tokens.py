"""Token counts by byte-pair merging with a heap and a linked list.

The vocabulary file is only read, never trained. A text is counted in words, as no piece of
the vocabulary reaches from the end of a word over the following space; a table of counts of
frequent words is kept within bounds in each task.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import text_udf, with_struct

SPACE = "▁"
#: Words kept in a task's table, and the longest of them.
TABLE_WORDS, TABLE_CHARS = 800_000, 48

NORMAL, USER_DEFINED, UNUSED, BYTE = 1, 4, 5, 6


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, i
        shift += 7


def _fields(data: bytes):
    """Number and value of each field of a serialised message."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(data, i)
        else:
            size, i = (8, i) if kind == 1 else (4, i) if kind == 5 else _varint(data, i)
            value, i = data[i : i + size], i + size
        yield key >> 3, value


def read_pieces(path: str) -> tuple[dict[str, float], dict[str, bool]]:
    """Scores of the pieces that merges may make, and the settings of the model's text preparation."""
    import struct

    with open(path, "rb") as f:
        data = f.read()
    scores: dict[str, float] = {}
    settings = {"dummy_prefix": True, "strip": True, "escape": True, "byte_fallback": False, "treat_suffix": False}
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    text = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            if kind == NORMAL:
                scores[text] = score
            elif kind in (USER_DEFINED, UNUSED):
                raise ValueError(f"pieces of kind {kind} are not supported")
        elif number == 2:
            for n, v in _fields(value):
                if n == 35:
                    settings["byte_fallback"] = bool(v)
                elif n == 24:
                    settings["treat_suffix"] = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2 and v:
                    raise ValueError("a model with a character map is not supported")
                if n in (3, 4, 5):
                    settings[{3: "dummy_prefix", 4: "strip", 5: "escape"}[n]] = bool(v)
    if settings["strip"] or not settings["escape"] or settings["treat_suffix"] or not settings["byte_fallback"]:
        raise ValueError(f"these settings are not supported: {settings}")
    return scores, settings


def merges(word: str, scores: dict[str, float]) -> tuple[int, int]:
    """Symbols at first and merges made: the best pair is popped until none is left, the left one on a tie."""
    n = len(word)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    parts = list(word)
    heap = [(-s, i, p) for i in range(n - 1) if (s := scores.get(p := word[i : i + 2])) is not None]
    heapify(heap)
    made = 0
    while heap:
        _, i, piece = heappop(heap)
        j = right[i] if parts[i] else n
        if j >= n or parts[i] + parts[j] != piece:
            continue  # one of the two has been merged meanwhile
        parts[i], parts[j] = piece, ""
        right[i] = k = right[j]
        made += 1
        if k < n:
            left[k] = i
            if (s := scores.get(p := piece + parts[k])) is not None:
                heappush(heap, (-s, i, p))
        h = left[i]
        if h >= 0 and (s := scores.get(p := parts[h] + piece)) is not None:
            heappush(heap, (-s, h, p))
    return n, made


def count_word(word: str, scores: dict[str, float]) -> int:
    """Tokens of a word: symbols less merges; a character outside the vocabulary is one token for each byte."""
    symbols, made = merges(word, scores)
    return symbols - made + sum(len(c.encode()) - 1 for c in word if c not in scores)


class Table(dict):
    """Counts by word; emptied when it is full, and without the longest words."""

    def __init__(self, scores: dict[str, float]):
        super().__init__()
        self.scores = scores

    def __missing__(self, word: str) -> int:
        n = count_word(word, self.scores)
        if len(word) <= TABLE_CHARS:
            if len(self) >= TABLE_WORDS:
                self.clear()
            self[word] = n
        return n


def cutting_chars(scores: dict[str, float]) -> str:
    """Characters other than letters that no piece has directly after a letter, or after one it could follow.

    A text may be cut between any other character and one of these: no merge crosses that place.
    """
    before: dict[str, set[str]] = {}
    for p in scores:
        for a, b in zip(p, p[1:], strict=False):
            before.setdefault(b, set()).add(a)
    # patterns are slow on sets with characters beyond the first 65,536
    cutting = {c for p in scores for c in p if not c.isalpha() and c < "\uffff"} - {SPACE}
    while bad := {c for c in cutting if before.get(c, set()) - cutting - {SPACE}}:
        cutting -= bad
    return "".join(sorted(cutting))


@lru_cache(maxsize=2)
def counter(model: str | None = None) -> Callable[[str], int]:
    """The counting function for one text; a worker keeps it, with its table, from task to task."""
    scores, settings = read_pieces(model or default_model())
    if any(SPACE in p.lstrip(SPACE) for p in scores) or any("\n" in p for p in scores):
        raise ValueError("a piece reaches over a space or a line's end")
    cut = re.escape(cutting_chars(scores))
    words_of = re.compile(f"\n|{SPACE}*[{cut}]*[^{SPACE}{cut}\n]+|{SPACE}*[{cut}]+|{SPACE}+").findall
    prefix = SPACE if settings["dummy_prefix"] else ""
    known = Table(scores)

    def count(text: str) -> int:
        return sum(map(known.__getitem__, words_of(prefix + text.replace(" ", SPACE)))) if text else 0

    return count


def token_count(text: Column, model: str | None = None) -> Column:
    """The number of tokens of a text column; 0 for null."""

    def make():
        count = counter(model)
        return lambda t: (count(t),)

    return text_udf("n long", make)(text).getField("n")


def count_tokens(df: DataFrame, text: str = "text", limit: int = 4096, model: str | None = None) -> DataFrame:
    """`df` with n_bytes, n_tokens and over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens. Rows stay as they are, repeated ones too;
    columns named like a new one are replaced. No shuffle.
    """

    def make():
        count = counter(model)
        return lambda t: (len(t.encode()), n := count(t), n > limit)

    names = ["n_bytes", "n_tokens", "over_limit"]
    return with_struct(df, text_udf("n_bytes long, n_tokens long, over_limit boolean", make)(F.col(text)), names)


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    from quillstone.llm.common import load

    return count_tokens(load(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
