"""Word tokens of the quality model, and their shapes: compact and alike in every language."""

from __future__ import annotations

import functools
import itertools
import operator
import re
from collections import Counter

#: Fewest words of a line for its repetition to count.
LINE_WORDS = 3
#: Tokens that are no words.
MARKS = {"<", ">", "/", "~", "="}


class _Kinds(dict):
    """A: capitals, a: lower case, o: other letters, 0: digits, a sign of ASCII for
    itself, else ?."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        k = self[code] = "a" if ch.islower() else "A" if ch.isupper() else "o" if ch.isalpha() else "0" if ch.isdigit() else ch if "!" <= ch <= "~" or ch == "\n" else "?"
        return k


_KINDS = _Kinds()
_RUN = re.compile(r"(.)\1+")


def shapes(words: list[str]) -> list[str]:
    """The kinds of the characters of each word; a run of one kind gives it once."""
    return _RUN.sub(r"\1", "\n".join(words).translate(_KINDS)).split("\n") if words else []


@functools.lru_cache(maxsize=65_536)
def shape(word: str) -> str:
    return shapes([word])[0]


def marked(text: str, token, same="=", again="~", end="/") -> list:
    """Tokens of a text; ``same`` for a word equal to the one before it, ``again`` for each
    word of a line that the text had before, ``end`` after each line."""
    out, seen, before = [], set(), None
    for line in text.split("\n"):
        words = line.split()
        if not words:
            continue
        if len(words) >= LINE_WORDS and line in seen:
            out.extend([again] * len(words))
        else:
            seen.add(line)
            if words[0] == before or any(map(operator.eq, words, itertools.islice(words, 1, None))):
                for w in words:
                    out.append(same if w == before else token(w))
                    before = w
            else:
                out.extend(map(token, words))
                before = words[-1]
        out.append(end)
    return out


def tokens(text: str) -> list[str]:
    """Shapes of all words; ``=`` for a word equal to the one before it, ``~`` for
    each word of a line that the text had before, ``/`` after each line."""
    return marked(text, shape)


def word(w: str) -> str:
    """The word itself; one that reads like a mark has a backslash before it."""
    return "\\" + w if w in MARKS or w[0] == "\\" else w


def word_tokens(text: str) -> list[str]:
    """As ``tokens``, with the words themselves."""
    return marked(text, word)


def trigrams(text: str, of=word_tokens) -> Counter:
    """Counts of "x y z" over the tokens, with two start marks and one end mark."""
    t = ["<", "<", *of(text), ">"]
    return Counter(zip(t, t[1:], t[2:]))
