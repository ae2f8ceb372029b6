"""Byte-level BPE over a public tokenizer file: text units, the vocabulary's pieces.

A *unit* is a stretch of text that the tokenizer can encode on its own: the
pre-tokenizer's pattern never joins a non-space character to white space that
follows it, so a text may be cut before any white space that follows a
non-space character, and around special tokens.  Units concatenate to the text
and their ids to the text's ids.
"""

from __future__ import annotations

import json
import re
import sys
import types

from tokenizers import Tokenizer

# fixed values: the white space of the tokenizer's pattern (Unicode White_Space)
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_ODD_SPACE = re.compile("[\0\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ODD_ASCII = ("\t", "\x0b", "\x0c", "\r", "\0")


class ByteBpe:
    """The tokenizer file at ``path``; truncation and padding are off.  Anything but byte-level BPE is refused."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        config = json.loads(self.tokenizer.to_str())
        pre = config["pre_tokenizer"] or {}
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in config["added_tokens"])
        if config["model"]["type"] != "BPE" or config["normalizer"] or pre.get("type") != "ByteLevel" \
                or pre.get("add_prefix_space") or not pre.get("use_regex") or not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        self.special = sorted((t["content"] for t in config["added_tokens"]), key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def units(self, text: str) -> list[str]:
        """The units of a text, in order."""
        if self._special and any(s in text for s in self.special):
            return [u for part in self._special.split(text) if part
                    for u in ([part] if part in self.special else self._plain(part))]
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        odd = any(c in text for c in _ODD_ASCII) if text.isascii() else _ODD_SPACE.search(text)
        if odd or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return _UNITS.findall(text)
        if not text:
            return []
        out = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        return out if out[0] else out[1:]

    def ids(self, unit: str) -> list[int]:
        return self.tokenizer.encode(unit, add_special_tokens=False).ids


def load(path: str) -> ByteBpe:
    """The tokenizer at ``path``, read once in the life of a worker process.

    Functions are sent to workers by value, so their own globals live for one
    task only; the cache hangs on a module of its own."""
    kept = sys.modules.setdefault("_ontime_llm_tokenizers", types.ModuleType("_ontime_llm_tokenizers")).__dict__
    if path not in kept:
        kept[path] = ByteBpe(path)
    return kept[path]


def pieces(path: str) -> list[tuple[int, bytes, bool]]:
    """(id, bytes, special) for every id of the vocabulary.

    Byte-level pieces are spelled in printable characters: the printable bytes
    of Latin-1 stand for themselves, the other 68 follow from 256 up."""
    config = json.loads(Tokenizer.from_file(path).to_str())
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["id"]: t["content"] for t in config["added_tokens"]}
    out = {i: (i, bytes(to_byte[c] for c in p), False) for p, i in config["model"]["vocab"].items() if i not in special}
    return [*out.values(), *((i, c.encode(), True) for i, c in special.items())]
