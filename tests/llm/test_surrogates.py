"""Surrogates where a shape is used up."""

from __future__ import annotations

import random
import string

import pytest

from quillstone.llm import pii


@pytest.mark.parametrize("letters", ["AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "\u0160\u010c\u017d", "\u00d8", "\u00c5", "\u0531\u0532"])
def test_one_letter_names_all_change_and_stay_distinct(spark, letters):
    df = spark.createDataFrame([(i, f"Mr. {c} came") for i, c in enumerate(letters)], "doc_id long, text string")
    out = [r.text for r in pii.replace_entities(df, "k").orderBy("doc_id").collect()]
    new = [t.split()[1] for t in out]
    assert len(set(new)) == len(letters) and all(a != b and a.isupper() for a, b in zip(new, letters, strict=True))


def test_full_shapes_map_onto_themselves_without_fixed_points():
    for size in (2, 3, 5, 21, 1000):
        to = [pii.following(i, size, b"k") for i in range(size)]
        assert sorted(to) == list(range(size)) and all(a != b for a, b in enumerate(to))
    pairs = [a + b for a in string.ascii_uppercase for b in string.ascii_lowercase]
    made = [pii.surrogate("name", p, "s") for p in pairs]
    assert sorted(made) == sorted(pairs) and all(a != b for a, b in zip(pairs, made, strict=True))


def test_emails_change_and_keep_off_the_reserved_domain():
    mails = ["_@example.com", "_@a.org", "a@example.com", "\u0130x@a.org"]
    new = [pii.replacer("s")(f"to {m} now")[0] for m in mails]
    assert all(m not in t for m, t in zip(mails, new, strict=True)) and len(set(new)) == len(mails)
    assert "@example.com" in new[2] and "@example.com" not in new[0]


SCRIPTS = [("Dr", "".join(map(chr, range(0x410, 0x430)))), ("Prof", "".join(map(chr, range(0x391, 0x3A2)))), ("Mr", string.ascii_uppercase), ("Dr", "".join(map(chr, range(0x531, 0x557))))]


@pytest.mark.parametrize("n", range(len(SCRIPTS)))
def test_all_initials_of_a_script_change_and_stay_distinct(n):
    title, letters = SCRIPTS[n]
    new = [pii.replacer("k")(f"{title} {c} came")[0].split()[1] for c in letters]
    assert len(set(new)) == len(letters) and all(a != b and a.isupper() for a, b in zip(new, letters, strict=True))


@pytest.mark.parametrize("text", ["mail \u0130x@example.com", "Dr \u0150 and \ufb03@x.org", "Mr \u01c5a, \u1e9e\u00df@y.de", "Frau \u1f88 \u0345", "a@\u0130.\u0130\u0130", "Dr \U00010400\U00010428"])
def test_letters_that_change_length_with_their_case(text):
    new, n, _ = pii.replacer("k")(text)
    assert len(new) == len(text) and (n == 0 or new != text)


def test_no_key_is_an_error_and_a_drawn_one_is_kept(spark):
    df = spark.createDataFrame([(1, "Mr A")], "doc_id long, text string")
    with pytest.raises(ValueError):
        pii.replace_entities(df, "")
    drawn = pii.configured_key(spark)
    assert len(drawn) == 64 and drawn == pii.configured_key(spark)
    spark.conf.set(pii.KEY_SETTING, "given")
    try:
        assert pii.configured_key(spark) == "given"
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_a_family_name_has_one_surrogate_everywhere():
    rewrite = pii.replacer("k")
    a, b, c, d = (rewrite(t)[0] for t in ("Anna Kowal here", "Frau Kowal here", "Mr. Robert Kowal here", "My name is Zoltan Kowal here"))
    family = a.split()[1]
    assert family != "Kowal" and b.split()[1] == family and c.split()[2] == family and d.split()[4] == family
    assert "Robert" not in c and "Zoltan" not in d


def test_detection_and_replacement_equal_what_was_planted():
    """Texts made of known entities between plain words: spans, untouched rest, consistency and distinctness."""
    r = random.Random(12)
    low, cap = string.ascii_lowercase, string.ascii_uppercase
    word = lambda n: "".join(r.choice(low) for _ in range(n))
    digits = lambda n: "".join(r.choice(string.digits) for _ in range(n))
    makers = {
        "email": lambda: f"{word(4)}.{word(3)}@{word(5)}.org",
        "ssn": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "ip": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        "card": lambda: digits(16),
        "phone": lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}",
        "name": lambda: f"Anna {r.choice(cap)}{word(5)}",
    }
    rewrite, mapped = pii.replacer("k"), {}
    for _ in range(400):
        text, planted, cuts = "so", [], []
        for _ in range(r.randint(0, 5)):
            kind = r.choice(list(makers))
            entity = makers[kind]()
            text += f" {word(3)} "
            planted.append(f"{kind}:{len(text)}:{len(text) + len(entity)}")
            cuts.append((len(text), entity, kind))
            text += entity
        text += " end"
        new, n, spans = rewrite(text)
        assert spans == ",".join(planted) and n == len(planted)
        rest, place = new, 0
        for start, entity, kind in cuts:
            plain = text[place:start]
            assert rest.startswith(plain)
            rest = rest[len(plain) :]
            size = len(" ".join(rest.split(" ")[:2])) if kind == "name" else len(entity)
            if kind == "ip":
                size = len(rest.split(" ")[0])
            made, rest, place = rest[:size], rest[size:], start + len(entity)
            assert made != entity and mapped.setdefault((kind, entity), made) == made
        assert rest == text[place:]
    assert len(set(mapped.values())) == len(mapped)
