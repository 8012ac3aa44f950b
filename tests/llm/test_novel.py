"""Random secrets of all usual alphabets and lengths, repeated ones, and keys over several lines."""

import random
import string

import pytest

from corpuslake.llm import secrets

UPPER, LOWER, DIGITS = string.ascii_uppercase, string.ascii_lowercase, string.digits
ALPHABETS = {
    "hex": DIGITS + "ABCDEF", "base32": UPPER + "234567", "base36": LOWER + DIGITS, "base64": UPPER + LOWER + DIGITS + "+/",
}


def novel(text):
    return [text[s:e] for s, k, e in secrets.spans_of(text.encode()) if k == 3]


@pytest.mark.parametrize("length", [24, 40, 64, 128, 172, 512, 2000])
@pytest.mark.parametrize("name", list(ALPHABETS))
def test_all_alphabets_and_lengths(name, length):
    draw = random.Random(length)
    keys = ["".join(draw.choices(ALPHABETS[name], k=length - 2)) + "A7" if name != "base36" else
            "".join(draw.choices(ALPHABETS[name], k=length - 2)) + "a7" for _ in range(20)]
    assert [k for k in keys if novel(f"The header is Bearer {k} as was said.") != [k]] == []


def test_repeated_secret():
    key = "".join(random.Random(1).choices(ALPHABETS["base64"], k=40))
    assert novel(f"signature {key} and once more, signature {key} then x{key}") == [key, key]


def test_key_of_many_lines():
    draw = random.Random(2)
    lines = ["".join(draw.choices(ALPHABETS["base64"], k=64)) for _ in range(12)]
    for between in ("\n", '"\n    "', " \\\n"):
        assert novel("-----BEGIN PRIVATE KEY-----\n" + between.join(lines) + "\n-----END PRIVATE KEY-----") == lines
    # Other words between end the context.
    filler = "some words that have nothing to do with it at all, and more of them. "
    assert novel(f"secret {lines[0]}\n{filler}{lines[1]}") == [lines[0]]


def test_known_strings_stay():
    for word in ("0123456789abcdefghijklmnopqrstuvwxyz" * 3, "authorization0123456789authentication", "access1access1access1access1"):
        assert novel(f"the secret {word} is none") == []
