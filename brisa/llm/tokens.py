"""Token ids of whole texts with the tokenizers library, each distinct word encoded once per worker.

Both tokenizers cut a text before they merge bytes, and no cut piece reaches from one word over white space into the word
before it. A text whose white space is single spaces and line feeds is therefore cut before each of them,
and the ids of the pieces follow each other; any other text is encoded whole. ``tests/llm`` compares both with
whole texts. A worker remembers pieces of up to :data:`LONGEST` bytes, whose memory is emptied when it would hold more than
:data:`MOST_BYTES`. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

from brisa.llm.batches import held

# What the memory of pieces may hold, with what Python needs for each, and the longest piece in it.
MOST_BYTES, EACH, LONGEST = 160 << 20, 180, 256
# A separator, Latin letters and a tail that no rule of either tokenizer joins to letters.
_PLAIN = re.compile("([ \n]?)([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,!?;:|*$%&#]*)")


def tokenizer_path(name: str) -> str:
    """Where the files of public tokenizers lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in prints]
    return {byte: chr(byte) for byte in prints} | {byte: chr(0x100 + place) for place, byte in enumerate(rest)}


class _Known(dict):
    """Ids of pieces, found by ``piece`` when first asked for, or else by ``whole``."""

    def __init__(self, piece, whole):
        self.piece, self.whole, self.bytes = piece, whole, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.piece(piece)
        if ids is None:
            ids = self.whole([piece])[0]
        size = len(piece) + len(ids)
        if size <= LONGEST:
            if self.bytes > MOST_BYTES:
                self.clear()
                self.bytes = 0
            self[piece] = ids
            self.bytes += size + EACH
        return ids


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.lowers = self.tokenizer.normalizer is not None  # the one that folds case also drops white space
        self.letters = byte_letters()
        self.four = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.tails: dict[str, bytes] = {"": b""}
        self.known = _Known(self._piece, self.whole)

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _merge(self, word: str) -> bytes:
        """Ids of a run of letters, with at most one space before it: the model's merges without the cutting."""
        # ASCII letters and digits stand for themselves.
        mapped = (word if word[0] != " " else self.letters[0x20] + word[1:]) if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        four = self.four
        return b"".join([four[t.id] for t in self.model.tokenize(mapped)])

    def _word(self, word: str) -> bytes:
        """Ids of a word of letters, with at most one separator before it; those of another tail are of no account."""
        if self.lowers:
            folded = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
            return self._merge(folded) if folded.isalpha() else b""  # a few fold to more than letters
        if word[0] == "\n":
            return self._tail("\n") + self._merge(word[1:])
        return self._merge(word)

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            self.tails[tail] = self.whole([tail])[0]
        return self.tails[tail]

    def _piece(self, piece: str) -> bytes | None:
        if piece.isascii() and piece.isalpha():
            return self._merge(piece.lower() if self.lowers else piece)
        plain = _PLAIN.fullmatch(piece)
        if plain is None:
            return None
        before, word, tail = plain.groups()
        end = self._tail(tail) if tail else b""
        if self.lowers:
            folded = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
            return self._merge(folded) + end if folded.isalpha() else None  # a few fold to more than letters
        return self._tail(before) + self._merge(word) + end if before == "\n" else self._merge(before + word) + end

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            self.tails[tail] = self.whole([tail])[0]
        return self.tails[tail]

    def pieces(self, text: str) -> list[str]:
        flat = text.replace("\n", " ")
        # Printable text has no white space but spaces, and no control characters.
        if not flat.isprintable() or "  " in flat or flat[:1] == " " or flat[-1:] == " ":
            return [text]
        if self.lowers:
            return flat.split(" ")
        return text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")

    def encode(self, texts: list[str]) -> list[bytes]:
        known, out = self.known.__getitem__, []
        for text in texts:
            pieces = self.pieces(text)
            out.append(self.whole(pieces)[0] if len(pieces) == 1 else b"".join(map(known, pieces)))
        return out


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker, until tasks of another kind run there."""
    return held(f"encoder {path}", lambda: PieceEncoder(path))
