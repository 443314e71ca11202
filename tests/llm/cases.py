"""Small documents with every oddity, and helpers to compare with brute force."""

import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards box quietly at dawn"

ODD = [
    (1, PASSAGE, "en", "b"),
    (2, PASSAGE.upper(), "en", "b"),
    (2, PASSAGE.upper(), "en", "b"),  # a repeated row
    (3, PASSAGE + " again", None, None),
    (4, None, "en", "a"),
    (5, "", "de", "a"),
    (6, " \t\n\r ", "de", "a"),
    (7, "Two words", "fr", "ä"),
    (8, "two WORDS", None, "Z"),
    (9, LONG, "en", "b"),
    (10, LONG + " tail", "en", None),
    (None, "a document without an id but with some words in it", "en", "b"),
    (None, None, None, None),
    (11, "12345 67890 !!! ***", "en", "a"),
    (12, "é è ß 漢字\u00a0nbsp \x1c sep\u2028line", "fr", "a"),
    (13, f"{PASSAGE}\n{PASSAGE}\nand a line of its own", "de", "c"),
    (14, f"  {PASSAGE}\t\nshort\n", "de", "c"),
]
CLASHES = (
    "key line n node size body hash position bucket label part first ids stack path host item "
    "width words hashes held copy slice chosen taken target count place square pivot vector gone"
).split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingles(text, width=5):
    w = words(text)
    if not w:
        return set()
    width = min(width, len(w))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
