"""Regular expressions, written with explicit Unicode classes.

Java's ``\\w``, ``\\b`` and ``\\s`` differ from one regex engine to the next, so every class is
spelled out. All patterns are in Java syntax.
"""

from matnworks.fixed_values import PREPOSITIONS

# Unicode white space, as a class body: ASCII and Latin-1 controls plus the separator category.
SPACE = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
# Letters, numbers and the underscore; combining marks are not word characters.
WORD = r"\p{L}\p{N}_"

SPACE_RUN = f"[{SPACE}]+"
NON_SPACE = f"[^{SPACE}]"
NON_ARABIC_RUN = r"[^\x{0600}-\x{06FF}]+"
DIACRITIC = r"[\x{064B}-\x{065F}\x{0670}]"

DIGIT = "[٠-٩0-9]"
ADJECTIVE = f"ال[{WORD}]+ي(?![{WORD}])"
GENITIVE = f"(?<![{WORD}])(?:{'|'.join(PREPOSITIONS)})[{SPACE}]"
SENTENCE_END = "[.!?؟]+"
