"""Noisy-channel restoration of disguised words, under a character trigram model of the corpus.

A writer's letter may reach us as a look-alike, masked, with a separator or a space after it, or several times over. A
token with such marks is a lattice: every character offers the letters it may stand for, or nothing, each at a channel
cost. The Viterbi path of least total cost, channel and language model, is the restored word. A plain token has one
path, itself. In a run of characters written one by one, every gap is one put in between, to be dropped, or the end
of a word, so the path also says where words end.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

#: Letters of the model: ASCII and the Latin letters up to U+017F in lower case; 0 is a boundary, 1 any other letter.
LETTERS = [chr(c) for c in range(0x61, 0x180) if unicodedata.category(chr(c)) == "Ll"]
_INDEX = {c: i + 2 for i, c in enumerate(LETTERS)}
SIZE = 1 << (len(LETTERS) + 1).bit_length()
_CLASS = np.zeros(0x180, np.uint8)
for _c in range(0x180):
    if chr(_c).isalpha():
        _CLASS[_c] = _INDEX.get(chr(_c).lower(), 1)

#: What a character may stand for (fixed values of common look-alikes).
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il",
    "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "}": "t", "µ": "u",
}
SEPARATORS = frozenset(".-_*~'`^/\\,:;·")
MASKS = frozenset("*#?")
#: Masks in a row that may each stand for a letter; a longer row is a rule or an ornament, and counts as that many.
MASKED = 8
_RULE = re.compile(rf"([*#?]{{{MASKED}}})[*#?]+")
#: Channel costs in nats: a look-alike, a dropped separator, a masked letter, a letter taken back from a repetition.
COST_LOOK, COST_DROP, COST_MASK, COST_REPEAT = 1.0, 0.7, 3.0, 0.3
#: A gap in a run of single characters that is the end of a word.
COST_SPLIT = 0.7
_GAP = r"(?:[^\S\n]|[.\-_*]){1,2}"
_SPACED = re.compile(rf"(?<![\w'’])\w(?:{_GAP}\w){{2,}}(?!\w)")
_GAPS = re.compile(_GAP)
#: The first character that can begin a word's core, and all up to the last that can end it.
_FIRST, _LAST = re.compile(r"[\w@$!|+(<€£]"), re.compile(r".*[\w@$|+€£]", re.S)
_REPEAT = re.compile(r"([^\W\d_])\1\1")


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    small = points < 0x180
    # letters of other scripts are one class, marks and symbols beyond are boundaries for the model either way
    return np.where(small, _CLASS[np.where(small, points, 0)], 1).astype(np.int64)


def trigram_codes(text: str) -> np.ndarray:
    """Codes of the letter triples of a text; runs of boundaries count once."""
    c = np.concatenate([[0], classes(text), [0, 0]])
    c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]
    return (c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:] if len(c) > 2 else np.zeros(0, np.int64)


class CharacterModel:
    """Costs in nats of a letter after two others, interpolated with shorter contexts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        n = len(LETTERS) + 2
        three: dict[int, float] = dict(zip(codes.tolist(), counts.tolist(), strict=True))
        a, b, c = codes // (SIZE * SIZE), codes // SIZE % SIZE, codes % SIZE
        self.one = (np.bincount(c, counts, SIZE) + 0.5) / (counts.sum() + 0.5 * n)
        two = np.bincount(b * SIZE + c, counts, SIZE * SIZE).reshape(SIZE, SIZE)
        self.two = (two + 20 * self.one[None, :]) / (two.sum(axis=1, keepdims=True) + 20)
        self.three = three
        self.context = dict(enumerate(np.bincount(a * SIZE + b, counts, SIZE * SIZE).tolist()))
        self.memory: dict[int, float] = {}

    def cost(self, a: int, b: int, c: int) -> float:
        code = (a * SIZE + b) * SIZE + c
        found = self.memory.get(code)
        if found is None:
            p = (self.three.get(code, 0) + 10 * float(self.two[b, c])) / (self.context.get(a * SIZE + b, 0) + 10)
            found = self.memory[code] = -float(np.log(max(p, 1e-12)))
        return found


def trimmed(token: str) -> str:
    """A token without the marks around it."""
    first, last = _FIRST.search(token), _LAST.match(token)
    return token[first.start() : last.end()] if first and last else ""


def suspicious(token: str) -> bool:
    """Whether a token (trimmed, lower case) has more than one reading."""
    return (not token.isalpha() and any(c.isalpha() for c in token)) or bool(_REPEAT.search(token))


def _options(token: str) -> list[list[tuple[str, float]]]:
    out: list[list[tuple[str, float]]] = []
    for k, c in enumerate(token):
        if c.isalpha():
            options = [(c, 0.0)]
            if k and token[k - 1] == c:
                options.append(("", COST_REPEAT))
        else:
            options = [(x, COST_LOOK) for x in LOOKS.get(c, "")]
            if c in MASKS:
                options += [(x, COST_MASK) for x in LETTERS[:26]]
            if c in SEPARATORS or not options:
                options.append(("", COST_DROP if c in SEPARATORS else COST_MASK))
        out.append(options)
    return out


def _run_options(letters: str) -> list[list[tuple[str, float]]]:
    """Of characters written one by one: between two, a gap that is dropped or ends a word."""
    out: list[list[tuple[str, float]]] = []
    for k, (c, options) in enumerate(zip(letters, _options(letters), strict=True)):
        if k:
            out.append([("", COST_DROP), (" ", COST_SPLIT)])
        # a digit may also be itself, and ends words
        out.append(options if c.isalpha() else [*options, (" ", COST_MASK)])
    return out


def decode(token: str, model: CharacterModel) -> str:
    """The likeliest word behind a token."""
    return _likeliest(_options(_RULE.sub(r"\1", token)), model)


def decode_run(letters: str, model: CharacterModel) -> list[str]:
    """The likeliest words behind characters written one by one."""
    return _likeliest(_run_options(letters), model).split()


def _likeliest(lattice: list[list[tuple[str, float]]], model: CharacterModel) -> str:
    """The path of least cost, by Viterbi over the last two letters."""
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in lattice:
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, back) in paths.items():
            for letter, extra in options:
                if letter == " " and not b:
                    state, total, trail = (a, b), cost + extra, back  # no word to end
                elif letter:
                    c = 0 if letter == " " else _INDEX.get(letter, 1)
                    state, total, trail = (b, c), cost + extra + model.cost(a, b, c), (letter, back)
                else:
                    state, total, trail = (a, b), cost + extra, back
                if state not in step or total < step[state][0]:
                    step[state] = (total, trail)
        paths = step
    _, trail = min((cost + model.cost(a, b, 0), trail or ("", None)) for (a, b), (cost, trail) in paths.items())
    letters = []
    while trail:
        letters.append(trail[0])
        trail = trail[1]
    return "".join(reversed(letters))


_LETTERS = re.compile(r"[^\W\d_]+")


def readings(token: str, model: CharacterModel) -> list[str]:
    """Words in a token: as written and, where it has more than one reading, as restored."""
    low = token.lower()
    if _SPACED.fullmatch(low):
        letters = _GAPS.sub("", low)
        words = readings(letters, model)
        words += [w for w in decode_run(letters, model) if w not in words]
        return words
    words = _LETTERS.findall(low)
    core = trimmed(low)
    if suspicious(core):
        restored = decode(core, model)
        if restored not in words:
            words.append(restored)
    return words


def spaced(text: str) -> list[str]:
    """Runs of characters written one by one, as they stand."""
    return _SPACED.findall(text)
