"""Pre-tokens of the two kinds of tokenizer files: the texts inside which merges happen."""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import regex

from flowloom.llm.vocab import library, settings

# The pattern byte-level vocabularies are made with, and the characters that count as white space in it.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same characters, one by one.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_LONGEST_LIST = 1 << 18


_CLASS = re.compile(r"\[\^\\s\\p\{L\}\\p\{N\}\]|\[?\\p\{([LN])\}\]?|\\([sS])")


def _spelled(pattern: str, letters: str, numbers: str, spaces: str) -> str:
    """The pattern with its character classes spelled out."""

    def spelled(found: re.Match) -> str:
        if found[1]:
            return f"[{letters if found[1] == 'L' else numbers}]"
        if found[2]:
            return f"[{spaces}]" if found[2] == "s" else f"[^{spaces}]"
        return f"[^{spaces}{letters}{numbers}]"

    return _CLASS.sub(spelled, pattern)


def _among(kind: str, last: int) -> str:
    """The characters up to `last` of a general category, as the inside of a class."""
    found = [c for c in range(last + 1) if unicodedata.category(chr(c)).startswith(kind)]
    return "".join(f"\\x{c:02x}" for c in found)


@functools.cache
def pattern(path: str, small: bool):
    """The pattern between whose matches merges never reach; `small` is for texts within Latin-1 and much faster."""
    steps = settings(path)["pre_tokenizer"]
    split = next((s for s in steps.get("pretokenizers", [steps]) if s["type"] == "Split"), None)
    raw = split["pattern"]["Regex"] if split else _BYTE_LEVEL
    # Nothing follows a repetition at the end of an alternative, so it need not remember where it could stop.
    raw = re.sub(r"\+(?=\||$)", "++", raw)
    if small:
        return re.compile(_spelled(raw, _among("L", 255), _among("N", 255), r"\t\n\x0b\x0c\r \x85\xa0"))
    return regex.compile(_spelled(raw, r"\p{L}", r"\p{N}", SPACE))


def _is_small(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@functools.cache
def _normalizers(path: str) -> tuple[str, ...]:
    steps = settings(path)["normalizer"]
    return tuple(step["type"] for step in steps["normalizers"]) if steps else ()


_RUN = regex.compile(f"[{SPACE}]+")


@functools.cache
def _keeps_space(path: str) -> bool:
    """Whether white space gets into pre-tokens, so that it matters of what kind it is."""
    return any(any(c in SPACES for c in found) for found in pattern(path, False).findall("a".join(SPACES) + SPACES))


def normalized(text: str, path: str) -> str:
    """The text as the tokenizer's normalizer leaves it: NFC, white space to a blank, lower case, as far as it names them."""
    kinds = _normalizers(path)
    if not kinds:
        return text
    if "NFC" in kinds and not text.isascii():
        text = unicodedata.normalize("NFC", text)
    if "Replace" in kinds and _keeps_space(path):
        text = _RUN.sub(" ", text)
    if "Lowercase" in kinds:
        # Letter by letter: a final sigma has no form of its own here.
        text = text.replace("Σ", "σ").lower()
    return text


@functools.cache
def _unassigned_points() -> np.ndarray:
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def _has_unassigned(text: str) -> bool:
    """Whether the text has a code point that this Python does not know; the library may."""
    return bool(_unassigned_points()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any())


# A text may be cut before a blank or line feed behind anything but white space: no pre-token and no normal form reaches across.
_SECTION = regex.compile(f"(?s).{{1,{1 << 12}}}.*?(?:(?<=[^{SPACE}])(?=[ \\n])|\\Z)")


def _with_library(text: str, path: str):
    """Pre-tokens of a text in which sections with unassigned code points are normalized and cut by the library."""
    tokenizer = library(path)
    for section in (match.group() for match in _SECTION.finditer(text)):
        if not _has_unassigned(section):
            yield from pretokens(section, path)
            continue
        if tokenizer.normalizer:
            section = tokenizer.normalizer.normalize_str(section)
        yield from (section[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(section))


def pretokens(text: str, path: str):
    """Pre-tokens of a text without special strings, in order; lazily for a long text."""
    small = _is_small(text)
    if not small and _has_unassigned(text):
        return _with_library(text, path)
    text = normalized(text, path)
    matcher = pattern(path, small or _is_small(text))
    if len(text) <= _LONGEST_LIST:
        return matcher.findall(text)
    return (match.group() for match in matcher.finditer(text))
