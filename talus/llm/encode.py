"""Token ids of whole texts, exactly as ``tokenizers`` gives them, word by word.

The word-level BPE drops white space and never merges across it, so a text's
ids are those of its space-separated parts in order. Parts repeat far more than
texts do; each worker keeps a bounded table of those it has seen.
"""

from __future__ import annotations

import re

#: Parts and pieces that a worker remembers; beyond that it starts anew.
REMEMBERED = 500_000
#: Longer parts are encoded each time.
LONG = 64

#: Parts of these characters alone are their own normal form but for case, and split into the
#: pieces that the tokenizer itself splits them into.
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


class WordEncoder:
    """Little-endian 32-bit ids of texts under a vocabulary that ignores white space and case."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        self._encode = tokenizer.encode
        self._merge = tokenizer.model.tokenize
        # The letters that the byte-level step writes for the bytes of each plain character.
        signs = ByteLevel(add_prefix_space=False, use_regex=False)
        plain = (chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100)))
        self._signs = {ord(c): signs.pre_tokenize_str(c)[0][0] for c in plain}
        self._parts: dict[bytes, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        found = self._pieces.get(piece)
        if found is None:
            if len(self._pieces) >= REMEMBERED:
                self._pieces.clear()
            merged = self._merge(piece.translate(self._signs))
            found = b"".join(t.id.to_bytes(4, "little") for t in merged)
            if len(piece) <= LONG:
                self._pieces[piece] = found
        return found

    def _part(self, part: bytes) -> bytes:
        text = part.decode()
        # "<|" may begin a special token, whose text is matched before anything is split.
        if _PLAIN.fullmatch(text) and "<|" not in text:
            found = b"".join(map(self._piece, _PIECES.findall(text.lower())))
        else:
            ids = self._encode(text, add_special_tokens=False).ids
            found = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(part) <= LONG:
            if len(self._parts) >= REMEMBERED:
                self._parts.clear()
            self._parts[part] = found
        return found

    def forget(self) -> None:
        """Give back the tables' memory, at the end of a task: the worker may be idle, or do other work, next."""
        self._parts.clear()
        self._pieces.clear()

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text, four bytes each; none for a null or blank one."""
        known = self._parts.get
        out = []
        for part in (text or "").encode().split():
            found = known(part)
            out.append(self._part(part) if found is None else found)
        return b"".join(out)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This process's encoder for the vocabulary at ``path``."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def word_vocabulary() -> str:
    """The place of the installed public word-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
