"""Personal data in texts: fixed patterns, and a linear-chain conditional random field beside them.

*Patterns* find the base spans: emails, IP addresses, payment cards (Luhn) and phone numbers,
leftmost and without overlap within a kind; a match that fails its check is dropped and not
tried again. They are written so that no text takes more than time in proportion to its length.

*The field* labels every token of a line with one of ``KINDS`` or none. A token's features are
its word shape (case, length, digits and their number, which punctuation) and, if several examples of
the labelled table have it, the word itself; both for the token and two neighbours on
either side. Weights and label transitions are fitted by maximum likelihood
(forward-backward, Adam) on a small labelled table, ``labelled_table`` by default. Spans are runs of
one label; those that overlap a base span are dropped, so base spans stay as they are.

*Decoding* is Viterbi in numpy batches over many lines at once. A token whose own score for "none"
leads by more than any two transitions can make up is "none" in the best path for certain; such
tokens (nearly all words of prose) cut the lines into short runs, which are decoded side by
side, with the same result as line by line.

Scale: rows are independent and do not move; a task holds a block of ``BLOCK`` characters at a time.
A line of more characters is several lines. Null texts are empty. Rows repeat as they
come; other columns are ignored. Places are code points, the end exclusive.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, kept_in_worker

BASE = ["email", "ip", "card", "phone"]
KINDS = ["email", "phone", "address", "id", "name"]  # that the field knows
ORDER = [*BASE, "address", "id", "name"]
BLOCK = 1 << 18
MAX_EXAMPLES = 5_000
NONE = 0  # the label of a token outside personal data
CAUTION = 2.0  # lead that a label needs over none at every token, so that clean texts stay clean

# --- patterns ------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No part of a pattern can match otherwise than greedily, so all are possessive; a number is
# only tried at its first digit, as it fails from a later one if it fails from that.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low = 0  # a match starts after the last one
    at = text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            low = found.end()
        at = text.find("@", max(at + 1, low))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(found: str) -> bool:
    parts = [p.lstrip("0") for p in found.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# --- tokens and their features -------------------------------------------------------------

_SPACE, _SMALL, _CAPITAL, _DIGIT, _OTHER = range(5)
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
N_SHAPES = 64
_EDGE = N_SHAPES - 1  # the shape beyond a line's ends
_BASE64 = 0x9E3779B97F4A7C15 | 1


def _kind_of(c: str) -> int:
    if c.isspace():
        return _SPACE
    if "0" <= c <= "9":
        return _DIGIT
    return _OTHER if not c.isalpha() else _CAPITAL if c.isupper() else _SMALL


class _Tables:
    """Character kinds, punctuation codes, and powers for the hashes of words."""

    def __init__(self):
        self.kinds = np.fromiter((_kind_of(chr(i)) for i in range(1 << 16)), np.uint8, 1 << 16)
        self.signs = np.full(128, len(_PUNCTUATION), np.int64)
        self.signs[[ord(c) for c in _PUNCTUATION]] = np.arange(len(_PUNCTUATION))
        inverse = pow(_BASE64, -1, 1 << 64)
        self.powers = np.cumprod(np.full(2 * BLOCK + 2, _BASE64, np.uint64))
        self.inverses = np.cumprod(np.full(2 * BLOCK + 2, inverse, np.uint64))


def _tables() -> _Tables:
    return kept_in_worker("personal-data", _Tables)


def tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, line, shape, hash) of the tokens of a text of at most two blocks: runs of letters and digits, and all
    other signs singly. The hash is of the word with A-Z small; 0 for signs."""
    t = _tables()
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    k = t.kinds[np.minimum(c, 0xFFFF)]
    word = (k >= _SMALL) & (k <= _DIGIT)
    other = k == _OTHER
    before, after = np.concatenate(([False], word[:-1])), np.concatenate((word[1:], [False]))
    start = np.flatnonzero(other | (word & ~before[:len(word)]))
    end = np.flatnonzero(other | (word & ~after[:len(word)])) + 1

    def held(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int32)))
        return sums[end] - sums[start]

    length, capitals, digits = end - start, held(k == _CAPITAL), held(k == _DIGIT)
    first = k[start]
    letters = np.select(
        [capitals == 0, (capitals == 1) & (first == _CAPITAL), capitals == length],
        [np.where(length <= 3, 0, 1), np.where(length == 1, 2, np.where(length <= 3, 3, 4)), 5], 6)
    sign = t.signs[np.minimum(c[start], 127)]
    shape = np.select([first == _OTHER, digits == length, digits > 0], [28 + sign, 7 + np.minimum(length, 20), 7], letters)
    small = np.where((c >= 65) & (c <= 90), c + 32, c).astype(np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((small + np.uint64(1)) * t.powers[:len(c)])))
    hashed = np.where(first == _OTHER, np.uint64(0), (sums[end] - sums[start]) * t.inverses[start])
    line = np.cumsum(c == 10)[start] if len(c) else start
    return start, end, line, shape, hashed


class Field:
    """A linear-chain conditional random field over token features."""

    OFFSETS = (-2, -1, 0, 1, 2)

    def __init__(self, words: np.ndarray):
        self.words = words  # sorted hashes of the words that count as such
        self.per_offset = N_SHAPES + len(words) + 1
        n, k = self.per_offset * len(self.OFFSETS), len(KINDS) + 1
        self.weights, self.moves = np.zeros((n, k)), np.zeros((k, k))
        self.first, self.last = np.zeros(k), np.zeros(k)

    def features(self, line: np.ndarray, shape: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """Rows of weights by token: a shape and a word at each offset."""
        place = np.searchsorted(self.words, hashed)
        known = (place < len(self.words)) & (self.words[np.minimum(place, len(self.words) - 1)] == hashed) if len(self.words) \
            else np.zeros(len(hashed), bool)
        word = N_SHAPES + np.where(known, place + 1, 0)
        n, out = len(shape), []
        for i, offset in enumerate(self.OFFSETS):
            at = np.arange(n) + offset
            inside = (at >= 0) & (at < n)
            at = np.clip(at, 0, max(n - 1, 0))
            inside &= line[at] == line
            out.append(i * self.per_offset + np.where(inside, shape[at], _EDGE))
            out.append(i * self.per_offset + np.where(inside, word[at], N_SHAPES))
        return np.stack(out, axis=1)

    def scores(self, features: np.ndarray) -> np.ndarray:
        """A score by token and label."""
        out = np.zeros((len(features), len(KINDS) + 1))
        for column in features.T:
            out += self.weights[column]
        return out

    def lead(self) -> np.ndarray:
        """The most that the moves around a token can favour each label over none."""
        into = np.vstack((self.moves, self.first))  # from each label, or a line's start
        out = np.hstack((self.moves, self.last[:, None]))  # to each label, or a line's end
        return (into - into[:, [NONE]]).max(axis=0) + (out - out[NONE]).max(axis=1) + 1e-9


def viterbi(field: Field, scores: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The best labels of runs of equal length, (runs, tokens). ``before``, ``after``: whether a token
    labelled none stands there (else the line begins or ends)."""
    runs, length, _ = scores.shape
    best = scores[:, 0] + np.where(before[:, None], field.moves[NONE], field.first)
    back = np.zeros((runs, length, scores.shape[2]), np.int8)
    for t in range(1, length):
        ways = best[:, :, None] + field.moves
        back[:, t] = ways.argmax(axis=1)
        best = ways.max(axis=1) + scores[:, t]
    best = best + np.where(after[:, None], field.moves[:, NONE], field.last)
    out = np.zeros((runs, length), np.int8)
    out[:, -1] = best.argmax(axis=1)
    rows = np.arange(runs)
    for t in range(length - 1, 0, -1):
        out[:, t - 1] = back[rows, t, out[:, t]]
    return out


def decode(field: Field, scores: np.ndarray, line: np.ndarray, lead: np.ndarray | None = None) -> np.ndarray:
    """The best label of every token, line by line."""
    n = len(line)
    out = np.zeros(n, np.int8)
    if not n:
        return out
    open_ = ((scores + (field.lead() if lead is None else lead))[:, 1:] >= scores[:, [NONE]]).any(axis=1)
    new_line = np.concatenate(([True], line[1:] != line[:-1]))
    start = np.flatnonzero(open_ & (new_line | ~np.concatenate(([False], open_[:-1]))))
    end = np.flatnonzero(open_ & (np.concatenate((new_line[1:], [True])) | ~np.concatenate((open_[1:], [False])))) + 1
    ends_line = np.concatenate((new_line[1:], [True]))
    lengths = end - start
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        for part in np.array_split(own, -(-len(own) * int(length) // BLOCK)):
            at = start[part][:, None] + np.arange(length)
            out[at] = viterbi(field, scores[at], ~new_line[start[part]], ~ends_line[end[part] - 1])
    return out


def field_spans(field: Field, text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the runs of one label, by place."""
    start, end, line, shape, hashed = tokens(text)
    if not len(start):
        return []
    scores = field.scores(field.features(line, shape, hashed))
    scores[:, NONE] += CAUTION
    labels = decode(field, scores, line)
    edge = np.concatenate(([True], (labels[1:] != labels[:-1]) | (line[1:] != line[:-1])))
    first = np.flatnonzero(edge & (labels != NONE))
    cut = np.concatenate((edge[1:], [True]))
    last = np.flatnonzero(cut & (labels != NONE))
    return [(KINDS[labels[a] - 1], int(start[a]), int(end[b])) for a, b in zip(first, last, strict=True)]


# --- fitting -------------------------------------------------------------------------------

def _expected(field: Field, scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label odds by token, expected moves) of padded sequences; forward and backward sums are
    scaled at every token, which cancels."""
    runs, longest, k = scores.shape
    moves, own = np.exp(field.moves), np.exp(scores - scores.max(axis=2, keepdims=True))
    ahead, behind = np.empty_like(scores), np.empty_like(scores)
    now = own[:, 0] * np.exp(field.first)
    for t in range(longest):
        if t:
            now = ahead[:, t - 1] @ moves * own[:, t]
        ahead[:, t] = now / now.sum(axis=1, keepdims=True)
    end = np.exp(field.last)
    behind[:, longest - 1] = end / end.sum()
    expected = np.zeros((k, k))
    for t in range(longest - 1, 0, -1):
        then = own[:, t] * behind[:, t]
        now = then @ moves.T
        live = t < sizes
        behind[:, t - 1] = np.where(live[:, None], now / now.sum(axis=1, keepdims=True), end / end.sum())
        total = (ahead[live, t - 1] * now[live]).sum(axis=1, keepdims=True)
        expected += moves * (ahead[live, t - 1].T @ (then[live] / total))
    odds = ahead * behind
    return odds / odds.sum(axis=2, keepdims=True), expected


def fit_field(examples: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 90, rate: float = 0.12,
              ridge: float = 1e-5, least_seen: int = 8) -> Field:
    """Fit on (line, spans) examples. Words of at least ``least_seen`` examples are features."""
    parsed, seen = [], Counter()
    for text, spans in examples:
        start, end, _, shape, hashed = tokens(text.replace("\n", " "))
        label = np.zeros(len(start), np.int64)
        for kind, a, b in spans:
            label[(start >= a) & (end <= b)] = KINDS.index(kind) + 1
        if len(start):
            parsed.append((shape, hashed, label))
            seen.update(set(hashed[hashed != 0].tolist()))
    field = Field(np.array(sorted(h for h, n in seen.items() if n >= least_seen), np.uint64))
    if not parsed:
        return field
    sizes = np.array([len(p[0]) for p in parsed])
    longest = int(sizes.max())
    line = np.repeat(np.arange(len(parsed)), sizes)
    features = field.features(line, np.concatenate([p[0] for p in parsed]), np.concatenate([p[1] for p in parsed]))
    label = np.concatenate([p[2] for p in parsed])
    place = np.concatenate([np.arange(n) for n in sizes])
    truth = np.zeros((len(label), len(KINDS) + 1))
    truth[np.arange(len(label)), label] = 1
    firsts, lasts = truth[place == 0].sum(axis=0), truth[np.cumsum(sizes) - 1].sum(axis=0)
    true_moves = np.zeros_like(field.moves)
    follows = np.flatnonzero(place > 0)
    np.add.at(true_moves, (label[follows - 1], label[follows]), 1)
    parts = [field.weights, field.moves, field.first, field.last]
    means, squares = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    rows = np.arange(len(parsed))
    for step in range(1, rounds + 1):
        padded = np.zeros((len(parsed), longest, len(KINDS) + 1))
        padded[line, place] = field.scores(features)
        odds, moves = _expected(field, padded, sizes)
        wrong = truth - odds[line, place]
        gradient = np.zeros_like(field.weights)
        for column in features.T:
            for y in range(wrong.shape[1]):
                gradient[:, y] += np.bincount(column, wrong[:, y], minlength=len(gradient))
        up = [gradient, true_moves - moves, firsts - odds[:, 0].sum(axis=0), lasts - odds[rows, sizes - 1].sum(axis=0)]
        for p, g, m, s in zip(parts, up, means, squares, strict=True):
            g = g / len(parsed) - ridge * p
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return field


# Fixed values of the labelled table: sentences with slots for personal data, sentences that
# hold none, and fillers. Braces name the kind and the filler of a slot.
_WITH = """Please contact Mr {name:full} about this matter .|Dear {name:full} , thank you for your letter .
My name is {name:full} and I live here .|Yours sincerely , {name:full}|Mrs {name:last} was not at home .
We spoke to Dr {name:full} yesterday .|Signed by {name:full} on behalf of the board .|Dear Ms {name:last} ,
I am called {name:full} , and you ?|The patient , Mr {name:last} , was seen again .|Name : {name:full}
Write to {email:spelt} for more .|You can reach me by mail at {email:spelt} .|Email : {email:spelt}
Call me on {phone:local} after six .|Phone : {phone:local}|Tel . {phone:local} or come by .|My number is {phone:local} .
Fax : {phone:local}|Ring the office on {phone:local} , please .|Mobile : {phone:local} , name : {name:full}
His social security number is {id:ssn} .|SSN : {id:ssn}|Passport number {id:passport} , issued in May .
Her passport no . {id:passport} was lost .|Account number : {id:account}|Please quote account {id:account} .
Tax id {id:account} , name : {name:full}|She lives at {address:street} .|Address : {address:street}
Send it to {address:street} , please .|Deliver to {address:street} before noon .|We moved to {address:street} last year .
Mr {name:full} , who lives here , came at noon .|Dear Mr {name:full} , write to {email:spelt} for more .|
Ask Mrs {name:full} , please , or Dr {name:full} !|Mr {name:full} lives at {address:street} .|Contact {name:full} , phone {phone:local} .""".replace("|\n", "|").replace("\n", "|").split("|")
_WITHOUT = """The version 3 of the License applies .|Licensed under CC BY - NC 4.0 .|This work is under the GNU General Public License , version 3 .
See chapter 12 , page 340 .|In 1999 there were 250 of them .|It took 45 minutes at most .|The total is 1234567 in all .
Order 4711 has been sent .|At least 10 people met at the station .|They met on Monday at the Grand Hotel .
The name of the game is patience .|The number of calls grew by 12 percent .|An address to the nation was given .
token = " {hex} " was found|key = {hex}|About 3.5 million in May 2015 .|He called it a day .|Call it what you will .
Mail was late again .|The dot at the end is missing .|Look at the net , at the org chart , or at {words} .|The phone rang twice .|No account was given of the matter .|Passport control was slow .
{prose}|{prose}|{prose}|{prose}|{prose}|{prose}|{prose}|{prose}|{prose}|{titles}|{titles} .|{titles} : {prose}|It is {titles}|This is {prose}|Go to {titles} .|Write to {prose}|It was made by {titles} .|Write to {prose}|
to to to to {prose}|at at at {prose}|The name is {prose}|{prose} . To . {titles} . A {words}|{prose} is . {titles} a . {prose}|is that {prose}|{prose} {digits} {prose}|{prose} %%% {prose}|{words} 9024 {words}|{words} {digits} {words}|{digits} {words}|{words} | {words} | {words}|{words} %%% {words} &&&
{words} . {words} , {words} .|{words} - {words} ! !|- {words}|# {words}|( {words} )|{words} . {digits}""".replace("|\n", "|").replace("\n", "|")
_FIRST = "Anna Ben Carla David Emma Felix Greta Hugo Irene Jonas Karin Louis Maria Nina Oscar Paula Robert Sofia Tom Vera".split()
_LAST_NAMES = "Adams Baker Costa Dupont Evans Fischer Garcia Hansen Ivanova Jensen Keller Lopez Meyer Novak Olsen Peters Rossi Smith Turner Weber".split()
_COMMON = ("the of and to a in is it that was for on are as with his they at be this from or by not but what all were we when your can said at at if in on no up so has had her him its who "
           "der die das und ist nicht ein eine von zu mit auf sich dem den des an le la les et des un une que qui dans pour pas sur est "
           "el los las y en por con una su para como son al lo").split()
_STREETS = "Street Road Avenue Lane Drive Square Court Way".split()


def _syllables(rng: random.Random, capital: bool = False) -> str:
    word = "".join(rng.choice("bcdfghklmnprstvwéñü") + rng.choice("aeiouèöó") + rng.choice(["", "n", "r", "st", "th"])
                   for _ in range(rng.randint(1, 3)))
    return word.capitalize() if capital else word


def _filler(rng: random.Random, kind: str) -> str:
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    first = rng.choice([rng.choice(_FIRST), _syllables(rng, True)])
    last = rng.choice([rng.choice(_LAST_NAMES), _syllables(rng, True)])
    if kind == "full":
        return rng.choice([f"{first} {last}", f"{first} {last}", f"{first[0]} . {last}", f"{first} {rng.choice('ABCDEFGH')} . {last}"])
    if kind == "last":
        return last
    if kind == "spelt":
        return f"{first.lower()} {rng.choice(['dot', '( dot )', '[ dot ]'])} {last.lower()} {rng.choice(['at', '( at )', '[ at ]'])} {_syllables(rng)} dot {rng.choice(['com', 'org', 'net', 'info'])}"
    if kind == "local":
        return rng.choice([f"( {number(3)} ) {number(3)} - {number(4)}", f"{number(3)} - {number(3)} - {number(4)}",
                           f"{number(4)} {number(6)}", f"{number(3)} {number(3)} {number(4)}", f"{number(5)} / {number(6)}"])
    if kind == "ssn":
        return f"{number(3)} - {number(2)} - {number(4)}"
    if kind == "passport":
        return rng.choice("ABCDEFGHKLMPX") + number(rng.choice([7, 8]))
    if kind == "account":
        return rng.choice([number(rng.randint(8, 12)), f"{number(4)} {number(4)} {number(4)}"])
    return f"{rng.randint(1, 399)} {rng.choice([_syllables(rng, True), last])} {rng.choice(_STREETS)}"


def _prose(rng: random.Random) -> str:
    """Common and invented words in sentences of all sizes, some shouted, spaced with signs, or repeated."""
    out: list[str] = []
    shout, noise = rng.random() < 0.1, rng.choice([*[""] * 8, " $ $", " % %", " * * *", " |", " ! !"])
    begins = True
    for _ in range(rng.randint(8, 16)):
        word = rng.choice([*_COMMON, *"aoye"]) if rng.random() < 0.4 else _syllables(rng)
        if begins or rng.random() < 0.05:
            word = word.capitalize()
        again = rng.randint(2, 6) if rng.random() < 0.08 else 1
        out += [word.upper() if shout else word] * again
        sign = rng.choice(["", "", "", "", "", " ,", " .", " .", " !"])
        begins = sign in (" .", " !")
        out[-1] += sign + noise
    return " ".join(out)


def _sentence(rng: random.Random, template: str) -> tuple[str, list[tuple[str, int, int]]]:
    out, spans = "", []
    for part in re.split(r"(\{[^}]*\})", template):
        if part.startswith("{"):
            kind, _, filler = part[1:-1].partition(":")
            if filler:
                value = _filler(rng, filler)
                spans.append((kind, len(out), len(out) + len(value)))
            elif kind == "words":
                value = " ".join(_syllables(rng, i == 0 or rng.random() < 0.1) + rng.choice(["", "", "", " ,", " ."])
                                 for i in range(rng.randint(2, 7)))
            elif kind == "titles":
                value = " ".join([_syllables(rng, True)] * rng.randint(1, 2) + [_syllables(rng, True) for _ in range(rng.randint(1, 5))])
            elif kind == "prose":
                value = _prose(rng)
            elif kind == "hex":
                value = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([32, 40])))
            else:
                value = "".join(rng.choice("0123456789") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 10, 12, 16])))
            out += value
        else:
            out += part
    return out, spans


def examples(seed: int = 1, each: int = 12) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled lines: every sentence with ``each`` different fillings, alone or within a longer line."""
    rng = random.Random(seed)
    # " | " stands for itself within a sentence, "|" alone parts sentences
    without = [s.replace("\0", " | ") for s in _WITHOUT.replace(" | ", "\0").split("|")]
    out = []
    for template in [*_WITH, *without]:
        for _ in range(each):
            text, spans = _sentence(rng, template)
            if rng.random() < 0.5:
                ahead, _ = _sentence(rng, "{words} . ")
                text, spans = ahead + text, [(k, a + len(ahead), b + len(ahead)) for k, a, b in spans]
            if rng.random() < 0.5:
                text += _sentence(rng, " {words}")[0]
            out.append((text, spans))
    return out


def labelled_table(spark: SparkSession) -> DataFrame:
    """(text, spans) rows to fit on."""
    return spark.createDataFrame(examples(), "text string, spans array<struct<kind: string, start: int, end: int>>")


def fit(labelled: DataFrame, max_examples: int = MAX_EXAMPLES) -> Field:
    """Fit on at most ``max_examples`` rows (text, spans), chosen by hash of the text."""
    rows = (labelled.filter("text is not null").orderBy(F.xxhash64("text"), "text").limit(max_examples).collect())
    return fit_field([(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["spans"] or []]) for r in rows])


# --- the operator --------------------------------------------------------------------------

def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """(place, piece) of a text in pieces of at most ``BLOCK`` characters, cut at a line's end, else at
    white space, if there is any."""
    at = 0
    while len(text) - at > BLOCK:
        cut = text.rfind("\n", at, at + BLOCK) + 1 or text.rfind(" ", at, at + BLOCK) + 1 or at + BLOCK
        yield at, text[at:cut]
        at = cut
    yield at, text[at:]


def all_spans(field: Field, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
    """(kind, start, end, whether base) of each text, by kind in ``ORDER`` and place."""
    out = [[(*s, True) for s in base_spans(text)] for text in texts]
    block: list[tuple[int, int, int, str]] = []  # (place in block, text, place in text, piece)
    held = 0

    def flush() -> None:
        starts = [b[0] for b in block]
        for kind, a, b in field_spans(field, "\n".join(b[3] for b in block)):
            place, which, at, _ = block[int(np.searchsorted(starts, a, side="right")) - 1]
            a, b = a - place + at, b - place + at
            if not any(base and a < high and low < b for _, low, high, base in out[which]):
                out[which].append((kind, a, b, False))
        block.clear()

    for i, text in enumerate(texts):
        for at, piece in _pieces(text):
            if held + len(piece) > BLOCK:
                flush()
                held = 0
            block.append((held, i, at, piece))
            held += len(piece) + 1
    flush()
    return [sorted(own, key=lambda s: (ORDER.index(s[0]), s[1])) for own in out]


def find(df: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans: kind, start, end, base) of every row of ``df``."""
    bounded_batches(df.sparkSession)
    span = "array<struct<kind: string, start: int, end: int, base: boolean>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _tables()
        for batch in batches:
            found: list = []
            pending: list[str] = []
            held = 0
            for text in batch.column(1):
                pending.append(text.as_py() or "")
                held += len(pending[-1])
                if held > 4 * BLOCK:
                    found += all_spans(field, pending)
                    pending, held = [], 0
            found += all_spans(field, pending)
            rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["id", "spans"])

    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = plain.mapInArrow(run, f"id {dict(plain.dtypes)['id']}, spans {span}")
    return out.select(F.col("id").alias(id_col), "spans")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans by kind, base_sha256 and all spans as text, of every row of ``find``."""
    base = F.filter("spans", lambda s: s["base"])

    def of(kind: str) -> Column:
        return F.filter(base, lambda s: s["kind"] == kind)

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(id_col, *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
