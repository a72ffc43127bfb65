"""Plain Python statements of the text semantics, one token or character at a time."""

import random
import re
import unicodedata
from collections import Counter

from matnworks.plans import shared_sql

# The lists as the oracle states them, so that a mistake in the package's own lists does not pass.
STOPWORDS = set(re.findall(r"'([^' ]+)'", shared_sql.CONTENT.split("NOT IN (")[1].split("))")[0]))
STEM_PREFIXES = re.search(r"\^\(\?:([^)]*)\)", shared_sql.CLEAN)[1].split("|")
STEM_SUFFIXES = re.search(r"\(\?:([^)]*)\)\$", shared_sql.CLEAN)[1].split("|")
PUNCTUATION = [
    mark.replace("''", "'")
    for mark in re.findall(r"'((?:''|[^'])+)'", shared_sql.FEATURES.split("list_filter([")[1].split("],\n")[0])
]

SAME_LETTER = {"إ": "ا", "أ": "ا", "آ": "ا", "ٱ": "ا", "ة": "ه", "ى": "ي"}


def normalize(text):
    out = ""
    for ch in text or "":
        code = ord(ch)
        if 0x64B <= code <= 0x65F or code in (0x670, 0x640):
            continue
        out += SAME_LETTER.get(ch, ch) if 0x600 <= code <= 0x6FF else " "
    return " ".join(w for w in out.split(" ") if w)


def content(text):
    return [w for w in normalize(text).split() if len(w) > 1 and w not in STOPWORDS]


def stem(word):
    cut = next((p for p in STEM_PREFIXES if word[: len(p)] == p and len(word[len(p) :]) >= 3), "")
    word = word[len(cut) :]
    tail = next((s for s in STEM_SUFFIXES if word[-len(s) :] == s and len(word[: -len(s)]) >= 3), "")
    return word[: len(word) - len(tail)]


def clean(text):
    return " ".join(map(stem, content(text)))


def is_word(ch):
    return ch == "_" or unicodedata.category(ch)[0] in "LN"


def gini(text):
    counts = sorted(Counter((text or "").split()).values())
    if not counts:
        return 0.0
    n, mass = len(counts), sum(counts)
    return 2 * sum(rank * f for rank, f in enumerate(counts, 1)) / (n * mass) - (n + 1) / n


def adjectives(text):
    """Runs of word characters, each searched for ``ال``, one or more characters, a final ``ي``."""
    found, run = 0, ""
    for ch in text + " ":
        if is_word(ch):
            run += ch
        else:
            start = run.find("ال")
            found += start >= 0 and run.endswith("ي") and len(run) - start >= 4
            run = ""
    return float(found)


def genitives(text):
    found, run = 0, ""
    for ch in text:
        if ch.isspace():
            found += run in ("في", "من", "إلى", "على", "عن", "مع")
        run = run + ch if is_word(ch) else ""
    return float(found)


def features(text):
    size = len(text or "")
    if not size:
        return (0.0,) * 5
    digits = sum(ch in "٠١٢٣٤٥٦٧٨٩0123456789" for ch in text)
    marks = len(set(text) & set(PUNCTUATION))
    return (digits / size, marks / size, adjectives(text), genitives(text), gini(text))


def random_texts(n, seed=7):
    """Seeded Arabic-like noise: affixed roots, stop words, marks, digits, Latin and odd spaces."""
    rng = random.Random(seed)
    roots = "كتب درس علم عربي مدرسة بيت والدي قرأ هدى استعمال جديد نظري".split()
    words = [p + r + s for p in ["", *STEM_PREFIXES] for r in roots for s in ["", *STEM_SUFFIXES]]
    noise = ["abc", "x2", "١٢٣", "42", "²", "كِتَابٌ", "الـــعربي", "،", "؟!", "a_b", "ي", "و", "_الخي"]
    glue = [" ", " ", " ", "  ", "\n", "\t", " ", " ", "، ", ".", "-", "\x1f", "　"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts += [rng.choice(rng.choice([words, list(STOPWORDS), noise])), rng.choice(glue)]
        out.append("".join(parts))
    return out
