"""Tokenizer files: the library's tokenizer, cached in each worker, and the parts needed to encode without it."""

from __future__ import annotations

import functools
import json
import os

import regex

# How byte-level vocabularies write a byte as a printable character: fixed by the vocabulary files.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


@functools.cache
def byte_letters() -> dict[int, str]:
    """Byte -> the character that stands for it."""
    rest = [b for b in range(256) if b not in set(_PRINTABLE)]
    return {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.cache
def library(path: str):
    """The library's tokenizer; one thread, because Spark runs one task for each core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.cache
def settings(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@functools.cache
def specials(path: str) -> dict[str, int]:
    """Strings that a text may hold and that become one id each."""
    return {token["content"]: token["id"] for token in settings(path)["added_tokens"]}


@functools.cache
def special_splitter(path: str):
    """Matches a special string, the longest first; None if there are none."""
    names = sorted(specials(path), key=len, reverse=True)
    return regex.compile("|".join(map(regex.escape, names))) if names else None


def parts(text: str, path: str) -> list[tuple[str, int | None]]:
    """A text cut at special strings: (plain text, None) and (special string, id) in order."""
    splitter = special_splitter(path)
    if splitter is None or not any(name in text for name in specials(path)):
        return [(text, None)] if text else []
    out, at = [], 0
    for match in splitter.finditer(text):
        if match.start() > at:
            out.append((text[at : match.start()], None))
        out.append((match.group(), specials(path)[match.group()]))
        at = match.end()
    if at < len(text):
        out.append((text[at:], None))
    return out
