"""Token ids of whole texts by the tokenizers library, with the words seen before kept.

Public tokenizers cut a text at white space before anything else, so the ids of a text are those of its
blank-separated pieces in order. Each worker keeps the ids of pieces it has met lately, in two
generations of bounded size: what is met again moves on to the younger one. Whatever does not fall
apart so is encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

from plumbline.llm.common import worker_cache

KEPT = 200_000
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile("(\n?)([" + _LATIN + r"]+)([!-/:-@\[-`{-~]*)")


def printable_bytes() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a printable character: itself if it is one, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(shown))
    return table


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, kept: int = KEPT):
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.kept = kept
        self.tokenizer = Tokenizer.from_file(path)
        self.table = printable_bytes()
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        # A vocabulary with word ends drops white space; the other kind keeps it in front of words.
        self.word_ends = bool(settings["model"].get("end_of_word_suffix"))
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.forget()

    def forget(self):
        self.pieces, self.old_pieces, self.cores, self.old_cores = {}, {}, {}, {}

    def exact(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one pre-token of letters, with its blank."""
        ids = self.cores.get(word)
        if ids is None:
            if len(self.cores) >= self.kept:
                self.cores, self.old_cores = {}, self.cores
            ids = self.old_cores.get(word)
            if ids is None:
                shown = word.encode().decode("latin-1").translate(self.table)
                ids = array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
            self.cores[word] = ids
        return ids

    def _piece(self, piece: str, head: bool = False) -> bytes | None:
        """Ids of a piece, None if the text around it must be encoded whole."""
        plain = _PLAIN.fullmatch(piece)
        if plain:
            line, word, marks = plain.groups()
            word = word.lower() if self.word_ends else word if head or line else " " + word
            ids = self.cores.get(word) or self._word(word)
            if line and not self.word_ends:
                ids = self._tail(line) + ids
            return ids + self._tail(marks) if marks else ids
        if self.word_ends:
            return self.exact(piece) if piece else b""
        if head and not piece:
            return b""
        if not piece or piece == "\n" or piece[0] != "\n" and piece[0].isspace() or any(c.isspace() for c in piece[1:]):
            return None
        return self.exact(piece if head or piece[0] == "\n" else " " + piece)

    def _tail(self, marks: str) -> bytes:
        key = "\0" + marks
        if key not in self.cores:
            self.cores[key] = self.exact(marks)
        return self.cores[key]

    def encode(self, text: str) -> bytes:
        if self.word_ends:
            parts, head = text.replace("\n", " ").split(" "), b""
        else:
            parts = text.replace("\n", " \n").split(" ")
            head = self._piece(parts.pop(0), head=True)
            if head is None:
                return self.exact(text)
        known = self.pieces
        try:
            return head + b"".join(map(known.__getitem__, parts))
        except KeyError:
            pass
        if len(known) >= self.kept:
            self.pieces, self.old_pieces = {}, known
            known = self.pieces
        old = self.old_pieces
        for p in set(parts):
            if p not in known:
                ids = old.get(p)
                if ids is None:
                    ids = self._piece(p)
                    if ids is None:
                        return self.exact(text)
                known[p] = ids
        return head + b"".join(map(known.__getitem__, parts))


def encoder(path: str, kept: int = KEPT) -> Encoder:
    """The worker's encoder for this file. kept: pieces that a generation holds, about 250 bytes each."""
    held = worker_cache().setdefault("encoders", {})
    if (path, kept) not in held:
        held[path, kept] = Encoder(path, kept)
    return held[path, kept]
