"""Faster forms of patterns that list many words."""

from __future__ import annotations

import functools
import string

#: Passes over places after an ASCII word character, where no word begins, by one look at a
#: table of flags. A word bound asks for Unicode properties of both its neighbours.
WORD_START = f"(?<!(?-i:[{string.digits}{string.ascii_letters}_]))"
#: Letters beyond ASCII that match an ASCII one if case doesn't count.
_FOLDED = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}

#: Letters looked at together before single alternatives are tried.
BLOCK = 4


def _split_group(pattern: str) -> tuple[str, list[str], str] | None:
    """Parts of ``head(a|b|...)tail`` when the first group in the pattern has that form."""
    start = pattern.find("(")
    if start < 0 or pattern.startswith("(?", start):
        return None
    depth, in_class, words, word, i = 0, False, [], "", start + 1
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            word += pattern[i:i + 2]
            i += 2
            continue
        if in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch == "(":
            depth += 1
        elif ch == ")":
            if depth == 0:
                return pattern[:start], [*words, word], pattern[i + 1:]
            depth -= 1
        elif ch == "|" and depth == 0:
            words.append(word)
            word = ""
            i += 1
            continue
        word += ch
        i += 1
    return None


def _first_letters(word: str) -> str | None:
    """All letters that an alternative can begin with; None if it has another form."""
    if word.startswith("(?:"):
        parts = _split_group("(" + word[3:])
        if parts is None:
            return None
        _, inner, tail = parts
        if tail[:1] in ("*", "+", "{"):
            return None
        several = [_first_letters(w) for w in inner]
        if tail[:1] == "?":
            several.append(_first_letters(tail[1:]))
        return None if None in several else "".join(several)
    plain = word[:1].isascii() and word[:1].isalpha() and word[1:2] not in tuple("?*+{")
    return word[0].lower() if plain else None


def _begins(words: list[str]) -> str:
    """Tests that the start of each word passes and few other places do, whatever the case."""
    letters = [_first_letters(word) for word in words]
    if None in letters:
        return ""
    chosen = "".join(sorted(set("".join(letters))))
    folded = "".join(_FOLDED.get(c, "") for c in chosen)
    return f"(?=(?-i:[{chosen}{chosen.upper()}{folded}])){WORD_START}"


@functools.lru_cache(maxsize=256)
def by_first_letter(pattern: str) -> str:
    """The same matches with the alternatives of the first group sorted into blocks by
    their first letter, for a pattern that is searched without regard to case.

    The matcher tries alternatives in turn at every word start. Alternatives with
    different first letters never match at one place, so they may be grouped; within a
    letter they keep their order. A block is skipped by one look at the next letter.
    Where alternatives may begin with several letters, as after an optional part, they keep
    their order, and places where none can begin are told before the word bound is tried.
    A pattern of another form is returned as it is.
    """
    parts = _split_group(pattern)
    if parts is None or len(parts[1]) <= BLOCK:
        return pattern
    head, words, tail = parts
    by_letter: dict[str, list[str]] = {}
    for word in words:
        plain = word[:1].isascii() and word[:1].isalpha() and word[1:2] not in tuple("?*+{")
        if not plain:
            return _begins(words) + pattern if head == r"\b" else pattern
        by_letter.setdefault(word[0].lower(), []).append(word[1:])
    return f"{head}({_blocks(by_letter)}){tail}"


def _blocks(by_letter: dict[str, list[str]]) -> str:
    letters = sorted(by_letter)
    blocks = []
    for at in range(0, len(letters), BLOCK):
        chosen = letters[at:at + BLOCK]
        inner = "|".join(f"{c}(?:{'|'.join(by_letter[c])})" for c in chosen)
        blocks.append(f"(?=[{''.join(chosen)}])(?:{inner})")
    return "|".join(blocks)
