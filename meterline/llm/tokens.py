"""Exact token ids of whole texts, with a memo over words.

The tokenizers library encodes about 1 MB of text a second. Its two public
byte-level BPE layouts cut a text at every change from a non-space to a space
before any merge, so a text's ids are the ids of its space-separated words one
after another, and a word's ids can be remembered. Words of letters go
straight to the library's BPE model; all other words go through the library's
whole encoder. Tokenizers of any other layout encode the whole text.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

# Remembered words per task; the memo starts over when it is full.
MEMO_WORDS = 400_000

# ASCII marks that may follow a word and never join its letters
# (an apostrophe may, so it is not one of them).
TRAILING_MARKS = ".,!?;:|$%&*#"


_SPACE_RUN = re.compile(r"\s ")
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")


def _byte_table() -> dict[int, str]:
    """The byte-to-character map of byte-level BPE: printable Latin-1 stands for itself, the rest moves to 256 and up."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {**{b: chr(b) for b in keep}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _layout(spec: dict) -> str:
    """``spaced`` (a word carries the space before it), ``folded`` (spaces dropped, lower case) or ``other``."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    plain = spec["model"]["type"] == "BPE" and not spec.get("post_processor") and not spec["model"].get("dropout")
    if spec.get("post_processor") and spec["post_processor"].get("type") == "ByteLevel":
        plain = spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
    special = [t["content"] for t in spec.get("added_tokens", [])]
    if not plain or any(" " in s or t["lstrip"] or t["rstrip"] for s, t in zip(special, spec.get("added_tokens", []))):
        return "other"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        return "spaced"
    steps = [s["type"] for s in norm.get("normalizers", [])]
    if pre.get("type") == "Sequence" and steps == ["NFC", "Replace", "Lowercase"]:
        parts = pre["pretokenizers"]
        if [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and parts[1].get("use_regex") is False:
            return "folded"
    return "other"


class WordMemo(dict):
    """Word -> its ids as little-endian unsigned 32-bit bytes; ``lead`` is what stands before every word."""

    def __init__(self, tokenizer, layout: str, lead: str):
        super().__init__()
        self.encode, self.model, self.layout, self.lead = tokenizer.encode, tokenizer.model, layout, lead
        self.table = _byte_table()
        self.mapped_lead = lead.translate({ord(" "): self.table[32]})
        self.older: dict[str, bytes] = {}

    def _ids(self, word: str) -> bytes:
        return array("I", self.encode(self.lead + word, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        if self.layout == "folded":
            word = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
        if not word.isascii():
            word = word.encode("utf-8").decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.model.tokenize(self.mapped_lead + word)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            out = self._fresh(word)
        if len(word) <= 64:
            if len(self) >= MEMO_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out

    def _fresh(self, word: str) -> bytes:
        # Plain Latin letters: one run, no special case of lower-casing or composing.
        if word.isalpha() and (word.isascii() or max(word) < "İ"):
            return self._letters(word)
        core = word.rstrip(TRAILING_MARKS)
        if core != word and core.isalpha() and max(core) < "İ":
            return self[core] + self.bare(word[len(core):])
        if self.lead and word.count("\n") == 1:
            # A lone line break between non-spaces is a token of its own.
            head, tail = word.split("\n")
            if head and tail and not head[-1].isspace() and not tail[0].isspace():
                return self[head] + self.bare("\n") + self.bare(tail)
        return self._ids(word)

    def bare(self, word: str) -> bytes:
        """Ids of ``word`` with nothing before it."""
        return self.unled[word]


class Encoder:
    """``encode(text)`` -> bytes of the text's ids (little-endian unsigned 32 bit), as the library's whole encoder gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            raw = f.read()
        self.tokenizer = Tokenizer.from_str(raw)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.layout = _layout(json.loads(raw))
        self.words = WordMemo(self.tokenizer, self.layout, "")
        self.led = WordMemo(self.tokenizer, self.layout, " ") if self.layout == "spaced" else self.words
        self.words.unled = self.led.unled = self.words

    def encode(self, text: str) -> bytes:
        if self.layout == "folded":
            return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))
        if self.layout == "spaced" and not _SPACE_RUN.search(text):
            first, *rest = text.split(" ")
            return self.words[first] + b"".join(map(self.led.__getitem__, rest))
        if self.layout == "spaced":
            # A cut is only safe after a non-space: a run of spaces stays with the word that follows.
            cuts = [0, *(m.start() for m in _SAFE_CUT.finditer(text)), len(text)]
            return b"".join(self.words[text[i:j]] for i, j in zip(cuts, cuts[1:]))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def spans(self, text: str) -> tuple[list[int], list[bytes]]:
        """Where each word of ``text`` starts (with the space before it) and its ids; only for layouts that cut at spaces."""
        if self.layout == "folded" or not _SPACE_RUN.search(text):
            parts = (text.replace("\n", " ") if self.layout == "folded" else text).split(" ")
            starts, at = [0], len(parts[0])
            for p in parts[1:]:
                starts.append(at)
                at += len(p) + 1
            return starts, [self.words[parts[0]], *map(self.led.__getitem__, parts[1:])]
        cuts = [0, *(m.start() for m in _SAFE_CUT.finditer(text)), len(text)]
        return cuts[:-1], [self.words[text[i:j]] for i, j in zip(cuts, cuts[1:])]

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4


def tokenizer_path(name: str) -> str:
    """Where ``name`` lies on this machine; resolved inside tasks, since each machine has its own."""
    import os

    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
