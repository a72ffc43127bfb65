"""Personal data by exact patterns and a linear-chain conditional random field.

E-mail, network and card numbers and telephone numbers are found by patterns with checks. A conditional
random field over the shapes of words, trained on a small table of labelled lines with values made by rule, adds spans that the
patterns miss: written-out e-mail addresses, telephone numbers without country code, account numbers and
secrets. Every word of every line is scored. Viterbi runs in numpy batches on the words that a bound on the score
of all labellings does not prove to be outside of any span; the labels are those of decoding each whole line.

Null text: empty, no spans. Null ids stay null. Empty tables give no rows. Repeated rows are read one by one. Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matnworks.llm.words import slices

KINDS = ("email", "ip", "card", "phone", "account", "secret")
BASE_KINDS = KINDS[:4]
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
FEATURES = 1 << 15

# Training table: lines in which [kind|text] marks a span. A line with slots like <name> is written COPIES times, with
# values made by the rules of ``slot_value``.
COPIES = 5
LINES = """
write to [email|<user>@<host>] about the offer
write [email|<name> at <term> dot <top>] now
[email|<name> at <term> dot <top>] is the best way
it was sent by [email|<name> at <term> dot <top>] and not by <name>
please mail [email|<name>.<name> at <term> dot <top>]
<name> can be found under [email|<name> [at] <term> [dot] <top>]
my address is [email|<user>@<host>], please reply
contact [email|lee [at] example.org] soon
send it to [email|<user> (at) <host>] today
mail [email|<name> at <term> dot <top>] for the list
contact [email|<name> [at] <host>] soon
you can reach [email|<name> at <term> dot <top>] or his office
[email|<name> dot <name> at <term> dot <top>] is my private address
reply to [email|<user>(at)<host>] before friday
<term>: [email|<user>(at)<host>]
<term>: [email|<user>[at]<host>]
<term> <term>: [email|<user>[at]<host>] <term>
<term>: <term>.<top> and <term>/<term>
<term>: <term>-<term> (<99>)
e-mail: [email|<user>[at]<term>[dot]<top>]
ask [email|<name> AT <term> DOT <top>] for details
for questions: [email|<user> (at) <term> (dot) <top>].
her address was [email|<name> at <term> dot <top>] then
[email|<user> (at) <host>]
the host [ip|<byte>.<byte>.<byte>.<byte>] did not answer
a login from [ip|<byte>.<byte>.<byte>.<byte>] was seen at night
paid with card [card|<9><9><9><9> <9><9><9><9> <9><9><9><9> <9><9><9><9>] on monday
number [card|<9><9><9><9>-<9><9><9><9>-<9><9><9><9>-<9><9><9><9>] was refused
call [phone|+<9> (<999>) <999>-<9999>] after nine
phone [phone|+<99> <99> <9999999>] is busy
tel: [phone|(<999>) <999>-<9999>] ask for <name>
phone: [phone|<999>-<999>-<9999>] in the evening
my number is [phone|<999>-<999>-<9999>], call me
call me at [phone|<999>.<999>.<9999>] tomorrow
tel [phone|0<99> <9999999>] ext
fax [phone|0<999>/<999999>] and post
mobile [phone|0<999> <9999999>]
Tel.: [phone|0<9999> <99999>]
ring [phone|0<99> <9999> <9999>] before noon
text me on [phone|(<999>) <999>-<9999>] please
her phone number is [phone|0<9> <99> <99> <99> <99>] at home
dial [phone|<999> <999> <9999>] for help
the number of <name> is [phone|<999>-<999>-<9999>]
<term>: [phone|0<99>/<9999999>]
<term> <name> [phone|<999>-<999>-<9999>] <term>
office [phone|0<99>/<999999>]
[phone|0<999> <9999999>] is the new number
[phone|(<999>) <999>-<9999>]
cell [phone|<999>-<999>-<9999>] or leave a note
account [account|<iban>] at the bank
send the money to [account|<iban>] today
pay [account|<iban>] first
[account|<iban>] is mine
and [account|<iban>] then
the number [account|<999>-<99>-<9999>] belongs to <name>
[account|<999>-<99>-<9999>]
transfer to iban [account|<iban>] now
IBAN: [account|<iban>]
pay the rent to [account|<iban>] by friday
her bank gave [account|<fours>] as the number
iban [account|<fours>] is wrong
ssn [account|<999>-<99>-<9999>] on the form
my social security number is [account|<999>-<99>-<9999>].
SSN: [account|<999>-<99>-<9999>], born in may
he gave [account|<999>-<99>-<9999>] to the clerk
account number [account|<99999999>] is closed
acct no. [account|<9999999999>] was opened
bank account: [account|<99999999>]
routing number [account|<999999999>] for the transfer
passport [account|<A><A><9999999>] expires soon
passport number [account|<A><99999999>] was lost
passport no. [account|<A><99><A><999>] of <name>
passport no [account|<A><9999999>] is old
the key [secret|AKIA<upper>] was leaked
found AKIA key [secret|AKIA<upper>] in the log
and [secret|AKIA<upper>] there
[secret|AKIA<upper>]
login with [secret|password=<hex>] please
it says [secret|password=<mixed>] here
[secret|password=<weak>] was in the file
[secret|DB_PASSWORD=<mixed>]
passwd=<slash> [secret|passwd=<weak>] is set
set [secret|token = "<hex40>"] in the file
of [secret|token = "<hex40>"] then
[secret|secret = "<mixed>"]
[secret|api_key = "<hex>"] was in the code
[secret|TOKEN=ghp_<mixed>]
[secret|ACCESS_TOKEN=<mixed>] in the settings
export [secret|API_KEY=<mixed>]
use [secret|api_key=<hex>] here
a push with [secret|ghp_<mixed>] failed
the bot has [secret|xoxb-<99999999>-<mixed>] in it
stripe [secret|sk_live_<mixed>] must go
sk-<slash> [secret|sk-<mixed>] is not mine
<term> <term> [secret|password=<hex>] <term> <term>
: <term> <term> : <term> [secret|password=<hex>] <term> : <term>
<term> : <term> [secret|TOKEN=<mixed>] : <term>
<term> [secret|AKIA<upper>] <term>
<term> [secret|ghp_<mixed>] <term>
<term> <term> [account|<iban>] <term>
password: [secret|<weak>]
login <name> with [secret|<weak>]
pw [secret|<weak>]
user <name> password [secret|<weak>] on the old host
credentials: <name> / [secret|<mixed>]
Password: [secret|<mixed>]
the password is [secret|<weak>] for now
my password is [secret|<mixed>], keep it
passphrase: [secret|<weak>]
pwd: [secret|<weak>]
api key is [secret|<hex>] still
<name> api key is [secret|<hex>] <term> <term>
the api key: [secret|<hex40>]
api token is [secret|<mixed>] today
secret key: [secret|<mixed>]
access key [secret|<mixed>] expired
bearer [secret|<mixed>] in the header
Authorization: Bearer [secret|<mixed>]
token: [secret|<hex40>]
of%%% the&&& [secret|token = "<hex40>"]### here***
words%%% [secret|password=<hex>]&&& and***
commit <hex40> fixed the door
see commit <hex40>
merge <hex40> into main
reverted in <hex40> by <name>
revision <hex> of the file
sha256 <hex40><hex> matches
sha1: <hex40>
md5 <hex32> of the disk
checksum: <hex32>
hash <hex40> was found
the digest is <hex40> as stated
etag "<hex32>" was sent
uuid <uuid> in the table
id <uuid> is free
request <uuid> took 20 ms
build <hex> is out
order <99999999> was shipped on <9> May 2022
invoice no. <99999999> is paid
ticket <999999> is closed
isbn 978-<9>-<99>-<999999>-<9> in print
part number <A><A>-<9999>-<99> is in stock
model <A><A><999> and <A><999>
tracking number 1Z<999><A><99><9999999> arrived
serial <A><99><A><9999>
on 20<99>-0<9>-1<9> the door was shut
from 19<99> to 20<99> and 1<9>-2<9> may
pages <99>-<999> and <999>-<999>
it cost <999>.<99> or <9>,<999>.<99> in all
at <9>:<99> on <9>.<9>.20<99> in room <999>
version <9>.<99>.<9> has <9999> lines
<99> 000 <term> and <9> 000 <term>
<term> <99> <999> <term> in 19<99>
about <9999999> people and <999999> houses
number <99> of <999> in the list
the value <9>.<99999999> is rounded
a share of 0.<9999> and a rate of <99>.<999>
http://www.<term>.<top>/page/<999>
see https://<term>.<top>/a?id=<99999>&lang=en for more
file = "<term>.txt"
name = "<name>"
color: #<hex6> and width=<999>
time: <99> minutes, place: <term>
size=<9999> mode=<term> level: <9>
note: the <term> is open
he called 3 times in <99> days
the phone rang <99> times
the token ring is old
the password must have eight characters
your password is too short
the password is not known to anyone
choose a new password and keep it secret
an api key is needed for this
the api key is stored on the server
a secret garden and a key to the door
the account is closed and the bank was told
a bank account is free for students
no passport is needed at the border
her phone number is on the card
call me at home or at work
write to me at the office
ask <name> at <term> for the key
meet <name> at the <term> on monday
<name> is at <term> today
the dot at the end of the line
they looked at the dot com years and at what came then
at the time the dot net firms were young
a company called <term> dot <top> failed in 2001
the software is free for personal use, as the license says
released under a public license, version <9> or later
licensed under the terms of the file COPYING, version <9>.0
in 1998 the town had 12,500 people and 3 schools
the meeting is on 12.04.2021 at 10:30 in room 204
chapter 7 covers pages 120-145 of volume 2
a price of $1,299.00 or 5% less for 2 items
see section 3.2.1 and table 4 for details
x = 5 and y = 7 give 12 in the end
version 10.15.7 was released in 2020
he scored 98 of 100 points in round 3
the year 1066 and the year 1789
follow @anna on the web for news
order 48213 was shipped on 3 May 2022
if a=b then c=d holds
the 2nd and 3rd of 10 rows
le 14 juillet 1789 et le 8 mai 1945
am 3. oktober 1990 um 12 uhr
el 5 de mayo de 1862 con 4000 hombres
temperatures of 21.5 or 22 degrees
they met at the old station and walked to the river
we are at home (at least today) and the door is open
look at this dot on the map and at the line below it
he was good at chess, at cards and at nothing else
dinner is at eight (see below) for all of them
the committee published its report on the harbour yesterday.
Many birds return every spring, although the winters became warmer.
it is worth nothing!! BUY NOW!! ALL OF IT IS FREE!!
worthless### noise*** and%%% more&&& stupid$$$ words### here%%%
the*** of%%% and&&& to$$$ which### follows*** nothing&&&
le conseil a publié son rapport sur les écoles de la région.
Elle était très contente, où l'été dure jusqu'à la fin d'octobre.
les élèves étrangers préfèrent généralement la bibliothèque
der Ausschuss veröffentlichte gestern seinen ausführlichen Bericht.
Über die Größe der Häuser und die Straßen wurde lange gesprochen
die Möglichkeiten für später müssen natürlich geprüft werden
el comité publicó ayer su informe sobre los niños de la región.
La mañana será más fría y después habrá una reunión aquí
Home | About | Contact | Help | Terms
menu | share | next | back
A - B - C (see the notes) and so on; the rest: nothing.
"Never," said the captain, "will this ship sail again..."
NATIONAL ASSEMBLY OF THE UNITED STATES
l'homme d'aujourd'hui n'a qu'une idée: partir.
il y a des années que personne n'avait répondu
in der Nähe stand ein Haus, das niemandem gehörte
no había nadie en la calle cuando llegamos por la noche
one two three four five six seven eight nine ten
THE INTERNATIONALIZATION OF ADMINISTRATIVE RESPONSIBILITIES
Yes. Yes. Yes. Yes. Yes. Yes. Yes. Yes.
Never. Never. Never. Never. Never. So so so
up. up. up. up. up. Down down down
at at at at at at at at at then then
the understanding understanding understanding understanding understanding understanding of
las las conocimiento conocimiento conocimiento conocimiento conocimiento conocimiento
Yes. Yes. Éducation Éducation Éducation Éducation Éducation Éducation Éducation
well, meanwhile meanwhile meanwhile meanwhile meanwhile meanwhile meanwhile meanwhile
Überlegung. Überlegung. Überlegung. Überlegung. Überlegung. Überlegung. Überlegung.
&&& &&& *** *** ### ### ### words### words### words### words### words###
"""
SOUNDS = "ba co di fu ga hel in ka lor mi ner ol pa quin ra sto tur ul vi wen".split()
TOPS = "com org net edu io de fr".split()
WEAK = "autumn blue copper dragon eagle falcon green hammer iron jungle".split()
HEX = "0123456789abcdef"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"


def slot_value(slot: str, r: random.Random) -> str:
    """A value for a slot of a training line; runs of 9 are digits."""

    def some(letters: str, n: int) -> str:
        return "".join(r.choices(letters, k=n))

    if slot.strip("9") == "":
        return some(DIGITS[1:], 1) + some(DIGITS, len(slot) - 1)
    if slot == "iban" or slot == "fours":
        number = some(UPPER, 2) + some(DIGITS, 2) + some(UPPER, r.choice((0, 0, 4))) + some(DIGITS, r.randrange(12, 21))
        return number if slot == "iban" else " ".join(number[i : i + 4] for i in range(0, len(number), 4))
    if slot == "mixed":
        return some(HEX[10:], 1) + some(DIGITS, 1) + some(UPPER, 1) + some(UPPER + UPPER.lower() + DIGITS, r.randrange(10, 36))
    if slot == "weak":
        marks = r.choice(("-", "_", "", "!", "."))
        return r.choice((marks.join([*r.sample(WEAK, 2), some(DIGITS, r.randrange(1, 4))]), r.choice(WEAK).title() + marks + some(DIGITS, 4)))
    def word() -> str:
        return "".join(r.choices(SOUNDS, k=r.randrange(2, 5)))

    if slot == "user":
        return r.choice((word(), f"{word()}.{word()}", word() + some(DIGITS, 2)))
    return {
        "name": word(),
        "term": word(),
        "top": r.choice(TOPS),
        "host": ".".join([*(word() for _ in range(r.choice((1, 1, 2)))), r.choice(TOPS)]),
        "byte": str(r.randrange(256)),
        "A": some(UPPER, 1),
        "upper": some(UPPER + DIGITS[2:8], 16) if r.random() < 0.7 else some(UPPER, 16),
        "hex": some(HEX, r.randrange(16, 33)),
        "hex6": some(HEX, 6),
        "hex32": some(HEX, 32),
        "hex40": some(HEX, 40),
        "uuid": "-".join(some(HEX, n) for n in (8, 4, 4, 4, 12)),
        "slash": "/",
    }[slot]


def written_out(lines: str) -> str:
    """The training lines, with values in their slots, drawn again where a pattern finds a kind that is not marked."""
    mark = re.compile(rf"\[({'|'.join(KINDS)})\|((?:[^\[\]]|\[[^\[\]]*\])*)\]")
    r = random.Random(1)
    out = []
    for line in filter(None, lines.split("\n")):
        for _ in range(COPIES if re.search("<[A-Za-z0-9]+>", line) else 1):
            while True:
                drawn = re.sub("<([A-Za-z0-9]+)>", lambda m: slot_value(m[1], r), line)
                marked = {m[1] for m in mark.finditer(drawn)}
                if {KINDS[k] for _, k, _ in base_spans(mark.sub(lambda m: m[2], drawn))} <= marked:
                    break
            out.append(drawn)
    return "\n".join(out)


EMAIL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # no match begins inside a run of digits
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Words of more than LONGEST characters are read in parts: at marks that enclose or separate, then by length.
LONGEST = 200
PART = re.compile(r"""[^,;"'&?{}<>()\[\]|/\\]+""")
ANY = re.compile(".+", re.DOTALL)


# ---------------------------------------------------------------- patterns


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and domain, each ``@`` looked at once, so in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = EMAIL.match(text, at + 1)
        if at >= done and domain:
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of the pattern matches that pass their checks, in order."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if not re.search("[0-9]", text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40 and 12 <= len(digits := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


EXAMPLES = written_out(LINES)


# ---------------------------------------------------------------- the random field


PLACES = 5  # the word itself, the one before, the one behind, the second before, the second behind
KEY = re.compile(r"[^A-Za-z]*([A-Za-z]+[_-])*([A-Za-z]+)[\"']?[=:](?=.)")
NAME = re.compile(r"(?:[a-z]+[_-])*([a-z]{1,12})")
LEAD = re.compile(r"[A-Za-z]{2,5}[_-](?:live_|test_)?")
SIMPLE = re.compile(r"([A-Z]?)([^\W\d_A-Z]+)([.,;:!?]?)")
UNUSUAL = re.compile("[^A-Za-z0-9]")
GLUED = re.compile(r"[(\[{](?:at|dot)[)\]}]", re.IGNORECASE)
HOST = re.compile(r"(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
CODE = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")


def shape(word: str) -> str:
    """The word with runs of upper case, lower case and digits as A, a and 9."""
    return re.sub("[0-9]+", "9", re.sub(r"[^\W\d_A-Z]+", "a", re.sub("[A-Z]+", "A", word)))


def form(word: str) -> str:
    """The shape with the length of every run of digits."""
    return re.sub("[0-9]+", lambda m: str(min(len(m[0]), 12)), re.sub(r"[^\W\d_A-Z]+", "a", re.sub("[A-Z]+", "A", word)))


def make(value: str) -> str:
    """What the characters of a long value are drawn from."""
    if len(value) < 12:
        return "-"
    if CODE.fullmatch(value):
        return "code"
    if not value.isascii() or not value.isalnum():
        return "uuid" if re.fullmatch("[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", value) else "-"
    if value.isdigit():
        return "digits"
    if re.fullmatch("[0-9a-f]+", value):
        return "hex"
    if any(c.isdigit() for c in value):
        return "mixed" if any(c.islower() for c in value) else "capitals"
    return "letters" if value.islower() else "capitals" if value.isupper() else "mixed letters"


def word_features(word: str) -> list[str]:
    digits = sum(c.isdigit() for c in word)
    core = word.strip(".,;:!?\"'()[]")
    low = core.lower()
    named = NAME.fullmatch(low)
    key = KEY.match(word)
    value = word[key.end() :] if key else core
    lead = LEAD.match(value)
    value = value.strip(".,;:!?\"'()[]")
    return [
        f"shape {shape(word)}",
        f"form {form(core) if digits and len(core) <= 40 else '-'}",
        f"digits {min(digits, 20)}",
        f"size {min(len(word), 30) // 3} {digits > 0}",
        f"name {named[1] if named else '-'}",
        f"name {named[1] if named else '-'} {word[-1] in ':='}",
        f"key {key[2].lower() if key else '-'}",
        f"lead {lead[0] if lead and digits else value[:4] if len(value) >= 16 and value.isupper() and CODE.fullmatch(value) is None else '-'}",
        f"make {make(value)} {key is not None}",
        f"spelled {'glued' if GLUED.search(word) and word.strip('()[]{}').lower() not in ('at', 'dot') else 'host' if HOST.fullmatch(core) else '-'}",
        f"marks {''.join(sorted(set(UNUSUAL.findall(word))))[:6]} {digits > 0}",
    ]


def edge_numbers() -> list[list[int]]:
    """Feature numbers of a missing neighbour at each place."""
    return [[zlib.crc32(f"{place} edge {i}".encode()) % FEATURES for i in range(len(word_features("-")))] for place in range(PLACES)]


def numbers_of(words: list[str], cache: dict[str, list[list[int]]]) -> np.ndarray:
    """Feature numbers of each word: its own and those of its neighbours."""
    own = []
    for word in words:
        if word not in cache:
            if len(cache) > 100_000:
                cache.clear()
            names = word_features(word)
            cache[word] = [
                [zlib.crc32(f"{place} {name}".encode("utf-8", "replace")) % FEATURES for name in names] for place in range(PLACES)
            ]
        own.append(cache[word])
    edge = edge_numbers()
    return np.array(
        [
            own[i][0]
            + (own[i - 1][1] if i else edge[1])
            + (own[i + 1][2] if i + 1 < len(own) else edge[2])
            + (own[i - 2][3] if i > 1 else edge[3])
            + (own[i + 2][4] if i + 2 < len(own) else edge[4])
            for i in range(len(own))
        ]
    )


def parse(examples: str) -> list[tuple[list[str], list[int]]]:
    """Words and label numbers of the training lines."""
    out = []
    for line in filter(None, examples.split("\n")):
        text, spans, at = "", [], 0
        for m in re.finditer(rf"\[({'|'.join(KINDS)})\|((?:[^\[\]]|\[[^\[\]]*\])*)\]", line):
            text += line[at : m.start()]
            spans.append((len(text), len(text) + len(m[2]), KINDS.index(m[1])))
            text, at = text + m[2], m.end()
        text += line[at:]
        words = list(WORD.finditer(text))
        labels = [0] * len(words)
        for start, end, kind in spans:
            inside = [i for i, w in enumerate(words) if w.start() < end and w.end() > start]
            for i in inside:
                labels[i] = 1 + 2 * kind + (i != inside[0])
        out.append(([w[0] for w in words], labels))
    return out


class Field:
    """Weights of states and transitions."""

    def __init__(self) -> None:
        k = len(LABELS)
        self.state, self.step, self.first = np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros(k)
        for a in range(k):
            for b in range(k):
                if b and b % 2 == 0 and a not in (b, b - 1):
                    self.step[a, b] = -1e4
        self.first[2::2] = -1e4

    def train(self, examples: list[tuple[list[str], list[int]]], rounds: int = 12, rate: float = 0.2, decay: float = 1e-3, least_lines: int = 2) -> None:
        """Stochastic gradient on the log-likelihood, with adaptive rates. Features of fewer than ``least_lines`` lines,
        which tell a line from all others, are not learned."""
        cache: dict = {}
        data = [(numbers_of(words, cache), np.array(labels)) for words, labels in examples]
        lines_with = np.zeros(FEATURES, np.int64)
        for numbers, _ in data:
            lines_with[np.unique(numbers)] += 1
        seen_state, seen_step = np.full(self.state.shape, 1e-8), np.full(self.step.shape, 1e-8)
        for turn in range(rounds):
            for i in np.random.default_rng(turn).permutation(len(data)):
                numbers, labels = data[i]
                score = self.state[numbers].sum(axis=1)
                n, k = score.shape
                ahead, back = np.zeros((n, k)), np.zeros((n, k))
                ahead[0] = score[0] + self.first
                for t in range(1, n):
                    ahead[t] = score[t] + np.logaddexp.reduce(ahead[t - 1][:, None] + self.step, axis=0)
                for t in range(n - 2, -1, -1):
                    back[t] = np.logaddexp.reduce(self.step + (score[t + 1] + back[t + 1])[None], axis=1)
                total = np.logaddexp.reduce(ahead[-1])
                wrong = np.exp(ahead + back - total)
                wrong[np.arange(n), labels] -= 1
                through = ahead[:-1, :, None] + self.step + (score + back)[1:, None, :] - total
                pairs = np.exp(through).sum(axis=0)
                np.add.at(pairs, (labels[:-1], labels[1:]), -1)
                used, places = np.unique(numbers, return_inverse=True)
                slope = np.zeros((len(used), k))
                np.add.at(slope, places.ravel(), np.repeat(wrong, numbers.shape[1], axis=0))
                slope += decay * self.state[used]
                slope[lines_with[used] < least_lines] = 0.0
                seen_state[used] += slope**2
                self.state[used] -= rate * slope / np.sqrt(seen_state[used])
                seen_step += pairs**2
                self.step -= rate * pairs / np.sqrt(seen_step)

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of every sequence of feature numbers."""
        return self.best([self.state[numbers].sum(axis=1) for numbers in sequences])

    def best(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of every sequence of state scores, by Viterbi over a padded batch."""
        sizes = np.array([len(s) for s in scores])
        n, longest, k = len(scores), int(sizes.max()), len(LABELS)
        score = np.zeros((n, longest, k))
        for i, own in enumerate(scores):
            score[i, : len(own)] = own
        best, came = score[:, 0] + self.first, np.zeros((n, longest, k), np.int8)
        last = best.copy()
        for t in range(1, longest):
            through = best[:, :, None] + self.step[None]
            came[:, t] = through.argmax(axis=1)
            best = through.max(axis=1) + score[:, t]
            last[sizes > t] = best[sizes > t]
        label = last.argmax(axis=1)
        out = np.zeros((n, longest), np.int8)
        for t in range(longest - 1, -1, -1):
            here = sizes > t
            out[here, t] = label[here]
            label = np.where(here & (t > 0), came[np.arange(n), t, label], label)
        return [out[i, : sizes[i]] for i in range(n)]


def train(examples: str = EXAMPLES) -> Field:
    field = Field()
    field.train(parse(examples))
    return field


class Reader:
    """Scores the words of many lines at once, and finds the words that may belong to a span.

    A feature that no training line has counts nothing. Words with equal features share one row of weights.
    """

    def __init__(self, field: Field, examples: str = EXAMPLES) -> None:
        self.field = field
        names = sorted({name for words, _ in parse(examples) for word in words for name in word_features(word)})
        self.number = {name: i + 1 for i, name in enumerate(names)}
        held = [[field.state[zlib.crc32(f"{place} {name}".encode()) % FEATURES] for place in range(PLACES)] for name in names]
        self.weights = np.concatenate([np.zeros((1, PLACES, len(LABELS))), np.array(held)])
        self.edges = [field.state[numbers].sum(axis=0) for numbers in edge_numbers()]
        self.rows: dict[tuple, int] = {}
        self.sums: list[np.ndarray] = []
        self.words: dict[str, int] = {}
        self.plain: dict[tuple, int] = {}
        step = field.step - field.step[0, 0]
        self.enter, self.leave = step.max(axis=0), max(0.0, float(step[1:, 0].max()))

    def simple(self, word: str) -> tuple | None:
        """All that the features tell of an ordinary word: letters, the first perhaps a capital, and one mark."""
        match = SIMPLE.fullmatch(word)
        core = match[1] + match[2] if match else ""
        if not core.isalpha():
            return None
        low, size = core.lower(), len(core)
        if core.isascii():
            if size <= 12 and f"name {low}" in self.number:
                return None
            return bool(match[1]), match[3], min(len(word), 30) // 3, size > 12, make(core)
        if low.isascii() or (size >= 16 and core.isupper()):
            return None
        return bool(match[1]), match[3], min(len(word), 30) // 3, "".join(sorted(set(UNUSUAL.findall(word))))[:6]

    def row(self, word: str) -> int:
        """The number of the row of weights of a word."""
        simple = self.simple(word)
        if simple in self.plain:
            found = self.words[word] = self.plain[simple]
            return found
        key = tuple([self.number.get(name, 0) for name in word_features(word)])
        if key not in self.rows:
            self.rows[key] = len(self.sums)
            self.sums.append(self.weights[list(key)].sum(axis=0))
        found = self.words[word] = self.rows[key]
        if simple is not None:
            self.plain[simple] = found
        return found

    def scores(self, lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """State scores of all words of ``lines``, one behind the other, and where each line begins."""
        if len(self.words) > 200_000:
            self.words.clear()
        get, row = self.words.get, self.row
        ids = np.array([i if (i := get(w)) is not None else row(w) for line in lines for w in line], np.int64)
        begins = np.concatenate([[0], np.cumsum([len(line) for line in lines])])
        own, before, after, second, third = np.array(self.sums).transpose(1, 0, 2)
        score = own[ids]
        score[1:] += before[ids[:-1]]
        score[:-1] += after[ids[1:]]
        first, last = begins[:-1], begins[1:] - 1
        score[first[1:]] -= before[ids[last[:-1]]]
        score[last[:-1]] -= after[ids[first[1:]]]
        score[first] += self.edges[1]
        score[last] += self.edges[2]
        score[2:] += second[ids[:-2]]
        without = np.concatenate([first, first[first < last] + 1])  # words without a second word before
        crossed = without[without >= 2]
        score[crossed] -= second[ids[crossed - 2]]
        score[without] += self.edges[3]
        score[:-2] += third[ids[2:]]
        without = np.concatenate([last, last[first < last] - 1])  # and without one behind
        crossed = without[without < len(ids) - 2]
        score[crossed] -= third[ids[crossed + 2]]
        score[without] += self.edges[4]
        return score, begins

    def open_stretches(self, lines: list[list[str]]) -> Iterator[tuple[int, int, np.ndarray]]:
        """Line number, first word and state scores of the stretches that may hold spans.

        ``gain`` bounds what a word adds to the score if it is not O, with the step to it. Labels other than O in
        a row cannot be the best where their gains and the step back to O sum to less than nothing. A word that
        is in no row with such a sum is O, and the words beside a stretch are kept in it as O.
        """
        score, begins = self.scores(lines)
        above = score[:, 1:] - score[:, :1]
        gain = (above + self.enter[1:]).max(axis=1)
        first = begins[:-1]
        gain[first] = (above[first] + self.field.first[1:]).max(axis=1)
        least = -self.leave - 1e-6
        for line in np.unique(np.searchsorted(begins, np.flatnonzero(gain >= least), side="right") - 1).tolist():
            start, size = int(begins[line]), len(lines[line])
            own = gain[start : start + size].tolist()
            ahead, total = [], 0.0
            for g in own:
                total = g + max(0.0, total)
                ahead.append(total)
            maybe, total = np.zeros(size + 2, np.int8), 0.0
            for i in range(size - 1, -1, -1):
                total = own[i] + max(0.0, total)
                maybe[i + 1] = ahead[i] + total - own[i] >= least
            edges = np.flatnonzero(np.diff(maybe))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                low, high = max(a - 1, 0), min(b + 1, size)
                some = score[start + low : start + high].copy()
                if low < a:
                    some[0, 1:] = -1e9
                if high > b:
                    some[-1, 1:] = -1e9
                yield line, low, some


def line_starts(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of every line."""
    end = -1
    for line in text.split("\n"):
        start, end = end + 1, end + 1 + len(line)
        yield start, end


def read_words(text: str, start: int, end: int) -> Iterator[re.Match]:
    """The words between two places; of a long one, parts that cover all but its separating marks and overlap by half."""
    for word in WORD.finditer(text, start, end):
        if word.end() - word.start() <= LONGEST:
            yield word
            continue
        for part in PART.finditer(text, word.start(), word.end()):
            if part.end() - part.start() <= LONGEST:
                yield part
                continue
            for a in range(part.start(), part.end() - LONGEST // 2, LONGEST // 2):
                yield ANY.match(text, a, min(a + LONGEST, part.end()))


def stretches(text: str) -> list[list[re.Match]]:
    """The words of every line that has words."""
    return [words for start, end in line_starts(text) if (words := list(read_words(text, start, end)))]


def added_spans(words: list[re.Match], labels: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``start, kind number, end`` of labelled runs, without punctuation at their ends."""
    at = 0
    while at < len(labels):
        if labels[at] == 0:
            at += 1
            continue
        kind, to = (int(labels[at]) - 1) // 2, at + 1
        while to < len(labels) and labels[to] == 2 + 2 * kind:
            to += 1
        start, end = words[at].start(), words[to - 1].end()
        text = words[at].string
        while end > start and text[end - 1] in ".,;:!?":
            end -= 1
        if end > start:
            yield start, kind, end
        at = to


def parts(pieces: list[tuple[int, int, np.ndarray]]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """``pieces``, sorted by size, in parts of at most 512, and of 60,000 words when padded unless it is one."""
    at = 0
    while at < len(pieces):
        to = min(at + 512, len(pieces))
        while to > at + 1 and (to - at) * len(pieces[to - 1][2]) > 60_000:
            to = at + (to - at) // 2
        yield pieces[at:to]
        at = to


COUNTS = ", ".join(f"n_{kind} long" for kind in BASE_KINDS)
FOUND = f"doc_id long, {COUNTS}, base string, spans string"


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Counts of base spans, and base and all spans as ``kind:start:end`` joined by commas, per row of ``docs``."""

    def joined(spans: list[tuple[int, int, int]]) -> str:
        return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(field)
        for batch in slices(batches):
            texts = batch.column(1).fill_null("").to_pylist()
            base = [base_spans(text) for text in texts]
            every = [list(b) for b in base]
            places = [(row, at) for row, text in enumerate(texts) for at in line_starts(text)]
            lines = [WORD.findall(texts[row], start, end) for row, (start, end) in places]
            for i, (row, (start, end)) in enumerate(places):
                if lines[i] and len(max(lines[i], key=len)) > LONGEST:
                    lines[i] = [word[0] for word in read_words(texts[row], start, end)]
            places = [place for place, line in zip(places, lines, strict=True) if line]
            lines = list(filter(None, lines))
            pieces = sorted(reader.open_stretches(lines), key=lambda p: len(p[2])) if lines else []
            # The words of lines with spans and the ends of base spans, once however many stretches a line has.
            cut: dict[int, list[re.Match]] = {}
            edges = [([x for x, _, _ in sorted(b)], list(accumulate((y for _, _, y in sorted(b)), max))) for b in base]
            for some in parts(pieces):
                for (line, low, _), labels in zip(some, field.best([p[2] for p in some]), strict=True):
                    if not labels.any():
                        continue
                    row, (start, end) = places[line]
                    if line not in cut:
                        cut[line] = list(read_words(texts[row], start, end))
                    for a, kind, b in added_spans(cut[line][low : low + len(labels)], labels):
                        begins, furthest = edges[row]
                        before = bisect_left(begins, b)
                        if before and furthest[before - 1] > a:
                            continue
                        if every[row] and every[row][-1][1] == kind and every[row][-1][0] <= a < every[row][-1][2]:
                            a = every[row].pop()[0]  # overlapping parts of one long word
                        every[row].append((a, kind, b))
            counts = [[sum(k == kind for _, k, _ in b) for b in base] for kind in range(len(BASE_KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([joined(b) for b in base], pa.string()),
                    pa.array([joined(sorted(s)) for s in every], pa.string()),
                ],
                ["doc_id", *[f"n_{kind}" for kind in BASE_KINDS], "base", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, FOUND)
