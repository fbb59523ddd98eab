"""Pre-token splitting that agrees with the two public tokenizer files.

``re`` with its Unicode shorthands is several times faster than the library's
own splitter and agrees with it on plain text. The characters on which the
two could differ (numbers that are not decimal digits, control separators,
scripts whose tables depend on the Unicode version) are outside ``PLAIN``; a
text that holds one goes to the library's splitter instead.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

#: Anything outside the characters where ``re`` and the library agree.
ODD = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe]|[^\x00-ͷЀ-ԯ‐-‧‰-⁞]")
LETTERS, OTHERS = r"[^\W\d_]+", r"(?:[^\s\w]|_)+"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_LEVEL = re.compile(rf"{CONTRACTIONS}| ?{LETTERS}| ?\d+| ?{OTHERS}|\s+(?!\S)|\s+")
WORD_END = re.compile(rf"{CONTRACTIONS}|{LETTERS}|\d|{OTHERS}")


@lru_cache(maxsize=4)
def library(path: str):
    """The tokenizer file at ``path`` in the library (one thread: Spark has the cores)."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def definition(path: str) -> dict:
    """The whole tokenizer file, vocabulary and merges included (some 20 MB once parsed, so not kept)."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@lru_cache(maxsize=4)
def rules(path: str) -> dict:
    """The tokenizer file without its model."""
    return {key: value for key, value in definition(path).items() if key != "model"}


@lru_cache(maxsize=4)
def normalizer(path: str):
    """The file's normalizer in the library, which loads no vocabulary for it."""
    from tokenizers import Tokenizer

    return Tokenizer.from_str(json.dumps({**rules(path), "added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})).normalizer


@lru_cache(maxsize=4)
def special_pattern(path: str) -> re.Pattern | None:
    """Pattern of the added tokens, which the library cuts out of a text first."""
    names = [t["content"] for t in rules(path)["added_tokens"]]
    return re.compile("(" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + ")") if names else None


def segments(text: str, path: str) -> list[str]:
    """The text cut at special strings: plain parts at even places, specials at odd ones."""
    pattern = special_pattern(path)
    return pattern.split(text) if pattern else [text]


def byte_level(text: str, path: str) -> list[str]:
    """Pre-tokens of a byte-level tokenizer (special strings already cut out)."""
    if not ODD.search(text):
        return BYTE_LEVEL.findall(text)
    return [text[a:b] for _, (a, b) in library(path).pre_tokenizer.pre_tokenize_str(text)]


def word_end(text: str, path: str) -> list[bytes]:
    """Normalised words of a word-end tokenizer, as UTF-8 (special strings already cut out)."""
    if not ODD.search(text):
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return [w.encode() for w in WORD_END.findall(text.lower())]
    text = normalizer(path).normalize_str(text)
    from tokenizers.pre_tokenizers import Split
    from tokenizers import Regex

    rule = rules(path)["pre_tokenizer"]["pretokenizers"][0]
    split = Split(Regex(rule["pattern"]["Regex"]), rule["behavior"].lower(), rule["invert"])
    return [w.encode() for w, _ in split.pre_tokenize_str(text)]
