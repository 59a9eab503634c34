"""Token ids of whole texts by a given public tokenizer file, with a cache of repeated words.

The file's tokenizer drops white space and never joins characters across it, so a text's ids are those of its
white-space-separated chunks. Chunks of plain characters are cut into the pieces that the file's own pattern gives
and each distinct piece goes through the file's model once; any other chunk, and any text with a control character that
Python and the pattern disagree about, goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re

import numpy as np

from sievemark.llm.inputs import held

END_ID = 1
TOKENIZER_FILE = "word_bpe_49k.json"
CACHED_CHUNKS = 250_000
CACHED_PIECES = 500_000

# The splitting pattern of the tokenizer file, for lower-case text of the characters in _PLAIN.
_LETTERS = "a-zªµºß-öø-ÿœ"
_NUMBERS = "0-9²³¹¼½¾"
_PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
_PLAIN = re.compile("[!-~¡-¬®-ÿŒœ‐-‧]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def default_path() -> str:
    """The place of the public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        # The model reads bytes as printable characters; letters outside ASCII become two of them.
        table = self._byte_characters()
        self.as_model_text = lambda piece: "".join(table[byte] for byte in piece.encode())

    @staticmethod
    def _byte_characters() -> list[str]:
        """Printable stand-ins of the 256 bytes as byte-level models have them: bytes that print stand for themselves,
        the others for the characters from 256 on."""
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        table = {byte: chr(byte) for byte in printable}
        others = (byte for byte in range(256) if byte not in table)
        table.update({byte: chr(256 + at) for at, byte in enumerate(others)})
        return [table[byte] for byte in range(256)]

    def encode_whole(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            text = piece if piece.isascii() else self.as_model_text(piece)
            found = np.array([token.id for token in self.model.tokenize(text)], dtype="<u4").tobytes()
            if len(self.pieces) < CACHED_PIECES:
                self.pieces[piece] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            found = self._piece(chunk.lower())
        elif _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            found = b"".join(map(self._piece, _PIECES.findall(chunk.lower())))
        else:
            found = self.encode_whole(chunk)
        if len(self.chunks) < CACHED_CHUNKS and len(chunk) < 64:
            self.chunks[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of one text, without special ids."""
        if _SEPARATORS.search(text):
            return self.encode_whole(text)
        words = text.split()
        parts = list(map(self.chunks.get, words))
        if None in parts:
            parts = [self._chunk(word) if part is None else part for word, part in zip(words, parts)]
        return b"".join(parts)

    def document(self, text: str | None) -> bytes:
        """Ids of a document with the end id; null is empty."""
        return self.encode(text or "") + END_ID.to_bytes(4, "little")


def encoder(path: str) -> Encoder:
    """The encoder of a file that a Python worker keeps from task to task."""
    return held("tokens", path, lambda: Encoder(path))
