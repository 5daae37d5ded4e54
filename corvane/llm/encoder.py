"""Token ids of whole texts, with the encodings of single words kept per worker."""

from __future__ import annotations

import os
import re
import sys
import types
from array import array

import numpy as np

#: White space that a library and Python may class differently; texts with any of it are encoded in one call.
ODD_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \t\n\r"]
#: Encodings of a generation, of which a worker keeps two; about 200 bytes each.
KEPT_WORDS = 400_000
LONGEST_KEPT = 64
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"


#: Marks that end a word of letters in a pre-token of their own. An apostrophe is none: it may open a contraction.
ENDING = r"[!-&(-/:-@\[-`{-~]+"


class _Words(dict):
    """Encodings of pieces of text, in two generations.

    A piece in neither is encoded when it is looked up; ``encode`` also says
    whether to keep it. When the young generation is full it becomes the old
    one, and words still in use come back from there, so rare words go and
    frequent ones stay.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids, keep = self.encode(piece)
            if not keep:
                return ids
        if len(self) >= KEPT_WORDS:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids of a text as little-endian unsigned integers of ``width`` bytes.

    ``spaces`` says what the tokenizer does with white space: ``"lead"`` puts
    one blank before a word into the word's first token and keeps the rest;
    ``"drop"`` throws white space away. Texts are cut at white space, and
    between a letter and the marks that end a word; no token spans such a cut,
    so joined encodings equal the encoding of the whole text. Texts with odd
    white space or special token strings are never cut.
    """

    def __init__(self, path: str, spaces: str = "lead"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        self.encode_cut = self._encode_lead if spaces == "lead" else self._encode_drop
        # Words of Latin letters are one pre-token each: the model takes them as they leave the library's own
        # normaliser and byte alphabet, which are applied once per letter here.
        normal = self.tokenizer.normalizer
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [c for c in map(chr, range(0x100)) if re.match(f"[{LATIN}]", c)]
        self.alphabet = {
            ord(c): bytes_of.pre_tokenize_str(normal.normalize_str(c) if normal and c != " " else c)[0][0]
            for c in [*letters, " "]
        }
        self.word_and_marks = re.compile(rf"([{LATIN}]+)({ENDING})?\Z").match
        self.lead_pieces = re.compile(rf" ?[{LATIN}]+(?=[\s.,]|\Z)|[.,]+(?=\s|\Z)| ?\S+|\s+(?!\S)|\s").findall
        self.model = self.tokenizer.model
        self.bare = _Words(self._encode_bare)
        #: Words by themselves, encoded with one blank before them.
        self.after_blank = _Words(self._encode_after_blank)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.marks = [*ODD_SPACE, *(t.content for t in added)]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of ``text``; none for null or empty."""
        if not text:
            return b""
        if any(mark in text for mark in self.marks):
            return self.whole(text)
        return self.encode_cut(text)

    def _encode_drop(self, text: str) -> bytes:
        return b"".join(map(self.bare.__getitem__, text.split()))

    def _encode_lead(self, text: str) -> bytes:
        # A blank opens a pre-token unless it stands inside a run of white space.
        if any(run in text for run in ("  ", "\n ", "\t ", "\r ")):
            return self._encode_spaced(text)
        first, *rest = text.split(" ")
        return self._encode_spaced(first) + b"".join(map(self.after_blank.__getitem__, rest))

    def _encode_spaced(self, text: str) -> bytes:
        """Ids of a text with white space of any kind."""
        return b"".join([
            self.after_blank[p[1:]] if p[0] == " " and p[1:2].strip() else self.bare[p] for p in self.lead_pieces(text)
        ])

    def _encode_bare(self, piece: str) -> tuple[bytes, bool]:
        found = self.word_and_marks(piece)
        return self._of_parts(self.bare, "", *found.groups()) if found else (self.whole(piece), len(piece) <= LONGEST_KEPT)

    def _encode_after_blank(self, piece: str) -> tuple[bytes, bool]:
        found = self.word_and_marks(piece)
        if found:
            return self._of_parts(self.after_blank, " ", *found.groups())
        if not piece or any(c in piece for c in "\n\t\r"):
            # Words that a line break joins are held one by one.
            return self._encode_spaced(" " + piece) if piece else self.bare[" "], False
        return self.whole(" " + piece), len(piece) <= LONGEST_KEPT

    def _of_parts(self, held: _Words, blank: str, word: str, marks: str | None) -> tuple[bytes, bool]:
        """Ids of a word and the marks at its end; the two together are kept once the word has been seen before."""
        if marks:
            seen = word in held
            return held[word] + self.bare[marks], seen
        return self._of_letters(blank + word), len(word) <= LONGEST_KEPT

    def _of_letters(self, word: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(word.translate(self.alphabet))]).tobytes()


def encoder(path: str, spaces: str = "lead") -> Encoder:
    """The worker's encoder for a file; made once per Python process.

    Package code travels with each task by value, so its own globals do not
    outlive a task; a module entry does.
    """
    state = sys.modules.setdefault("corvane_worker_state", types.ModuleType("corvane_worker_state")).__dict__
    key = f"{spaces}:{path}"
    if key not in state:
        state[key] = Encoder(path, spaces)
    return state[key]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
