"""Token ids of whole texts: parts of text that recur are encoded once and remembered.

Byte-level vocabularies of this kind part a text before a single space between two visible characters, between letters,
digits and other visible characters, and around a line end between visible characters. So a text may be cut there,
equal parts have equal ids, and the joined ids are those of the whole text. A bounded two-generation store keeps the ids
of parts; what it lacks is encoded by the tokenizer, many parts in one call with line ends between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

KEPT = 500_000
GROUP_CHARACTERS = 1_000_000
#: Letters, digits or ASCII punctuation without the apostrophe, with the space before them; a line end before a visible
#: character. Text that holds anything else is cut at single spaces only.
_PART = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\n(?!\s)")
_CUT = re.compile(r"(?<=\S)(?= \S)")
_SPACE = re.compile(r"\s")


class Encoder:
    """Encodes texts with the tokenizer in ``path`` (a byte-level one of the ``tokenizers`` library)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes of each token: the vocabulary writes every byte as one character.
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)
        line_end = self._ids("\n")
        self.line_end = int(np.frombuffer(line_end, "<u4")[0]) if len(line_end) == 4 else None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, text: str) -> bytes:
        # the fast call leaves out the places of tokens in the text
        encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(encoded.ids, dtype="<u4").tobytes()

    def _has_special(self, text: str) -> bool:
        for token in self.special:
            if token in text:  # a search for bytes, much cheaper than a pattern of alternatives
                return True
        return False

    def parts(self, text: str) -> list[str]:
        """The text, cut where the vocabulary parts it anyway."""
        if self._has_special(text):
            return [text]
        found = _PART.findall(text)
        if "".join(found) == text:
            return found
        found = []
        for piece in _CUT.split(text):
            inner = _PART.findall(piece)
            found += inner if "".join(inner) == piece else [piece]
        return found

    def _learn(self, missing: list[str]) -> None:
        together = [p for p in missing if not _SPACE.search(p, 1) and (p[0] == " " and len(p) > 1 or not p[0].isspace())
                    and not self._has_special(p)]
        learned = 0
        if together and self.line_end is not None:
            ids = np.frombuffer(self._ids("\n".join(together)), "<u4")
            ends = np.flatnonzero(ids == self.line_end)
            if len(ends) == len(together) - 1:
                data = ids.tobytes()
                starts = [0, *(4 * (ends + 1)).tolist()]
                stops = [*(4 * ends).tolist(), len(data)]
                self.new.update(zip(together, [data[a:b] for a, b in zip(starts, stops)]))
                learned = len(together)
        if learned < len(missing):
            for p in missing:
                if p not in self.new:
                    self.new[p] = self._ids(p)

    def encode_group(self, texts: list[str]) -> list[np.ndarray]:
        known_ids, cut, late, missing = self.new.get, [], [], set()
        for text in texts:
            parts = self.parts(text)
            found = list(map(known_ids, parts))  # each part is looked up once: the store is far larger than a cache
            cut.append(found)
            if None in found:
                gaps = [(i, p) for i, (p, ids) in enumerate(zip(parts, found)) if ids is None]
                missing.update([p for _, p in gaps])
                late.append((found, gaps))
        if missing:
            old = self.old
            known = [p for p in missing if p in old]
            self.new.update(zip(known, map(old.__getitem__, known)))
            self._learn(sorted(missing.difference(known)))
        ids = self.new.__getitem__
        for found, gaps in late:
            for i, p in gaps:
                found[i] = ids(p)
        out = [np.frombuffer(b"".join(found), dtype="<u4") for found in cut]
        if len(self.new) > KEPT:
            self.old, self.new = self.new, {}
        return out

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each whole text as unsigned 32-bit numbers; texts are worked on in groups of bounded length."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= GROUP_CHARACTERS:
                yield from self.encode_group(group)
                group, size = [], 0
        if group:
            yield from self.encode_group(group)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a Python worker; its store lasts as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
