"""Whole-text encoding with the ``tokenizers`` library, by distinct chunk.

Both vocabularies split a text at white space, and between a plain word and the
punctuation after it, before any merge, so the ids of a text are the ids of its
chunks in order. A marker that the vocabulary adds (such as ``<|endoftext|>``) parts
a text before anything else, so it is a chunk of its own. Each worker keeps the ids
of chunks it has met, up to a bound of bytes, and hands the new chunks of many texts to
the library at once.

A column of texts is parted at blanks first, and each distinct piece looked up once. A
blank parts a text between chunks unless white space lies on both its sides; texts with
such a blank, or with a marker, are not parted.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sluice.llm.common import WHITE_SPACE, held_by_worker

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of chunks and ids that a worker keeps; characters of texts encoded together.
CACHE_BYTES = 192 << 20
CHARACTERS_AT_ONCE = 4 << 20
#: What a kept chunk takes besides its characters and ids.
OVERHEAD = 180

#: Letters and digits of every Unicode version in use that lower-case to one letter; a run of them ends before these marks.
_PLAIN = "0-9A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u012f\\u0131-\\u024f\\u0400-\\u0481"
_END = f"(?=[.,;:!?{WHITE_SPACE}]|\\Z)"

#: A word takes one blank before it; longer white space forms chunks of its own.
BYTE_LEVEL_CHUNK = f" ?[{_PLAIN}]+{_END}| ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
#: White space is dropped.
WORD_CHUNK = f"[{_PLAIN}]+{_END}|[^{WHITE_SPACE}]+"

#: A run of letters, with the blank before it, is one word to both vocabularies, which the model takes as it is.
_LETTERS = _PLAIN.removeprefix("0-9")
_WORD = re.compile(f" ?[{_LETTERS}]+").fullmatch
_PROBES = ("a", " word", "Wort", " \u0421\u043b\u043e\u0432\u043e", " \u00c9t\u00e9")

_SPACES = WHITE_SPACE.encode().decode("unicode_escape")
#: A blank between white space, in the syntax of Arrow's patterns.
_INNER_BLANK = f"[{_SPACES}] (?:[{_SPACES}]|\\z)"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


class ChunkEncoder:
    def __init__(self, path: str, chunk_pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("markers that take in what is around them are not supported")
        self.markers = [t.content for t in added]
        self.part = re.compile("(" + "|".join(map(re.escape, sorted(self.markers, key=len, reverse=True))) + ")").split
        self.find = re.compile(chunk_pattern).findall
        self.blank = "".join(self.find(" "))  # what a chunk after a blank starts with
        self.letters = _byte_letters()
        self.lower = self.tokenizer.normalizer is not None
        self.model = self.tokenizer.model
        self.direct = all(self._word(p) == self.tokenizer.encode(p, add_special_tokens=False).ids for p in _PROBES if _WORD(p) and self.find(p) == [p])
        self.known: dict[str, bytes] = {}
        self.bytes = 0

    def chunks(self, text: str) -> list[str]:
        if not any(m in text for m in self.markers):
            return self.find(text)
        parts = self.part(text)  # markers at the odd places
        return [c for i, part in enumerate(parts) for c in ((part,) if i % 2 else self.find(part))]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers (every machine Spark runs on here is little-endian)."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str], plain: bool = False) -> Iterator[bytes]:
        """Ids of each text; ``plain`` texts hold no marker."""
        chunks = self.find if plain else self.chunks
        held: list[list[str]] = []
        waiting = 0
        for text in texts:
            held.append(chunks(text))
            waiting += len(text)
            if waiting > CHARACTERS_AT_ONCE:
                yield from self._joined(held)
                held, waiting = [], 0
        yield from self._joined(held)

    def encode_column(self, column: pa.StringArray, end_id: int, dtype: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts (null is empty), each followed by ``end_id``, and where each text's begin and the last's end."""
        column = column.fill_null("")
        parts = pc.split_pattern(column, " ")
        bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        code, pieces = coded.indices.to_numpy().copy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()

        # a text's first piece has no blank before it; a text that is not parted counts as that
        whole = np.zeros(len(column), bool)
        if self.blank:
            whole |= pc.match_substring_regex(column, _INNER_BLANK).to_numpy(zero_copy_only=False)
        marked = np.zeros(len(column), bool)
        for m in self.markers:
            marked |= pc.match_substring(column, m).to_numpy(zero_copy_only=False)
        whole |= marked
        first = bounds[:-1]
        firsts = [column[i].as_py() if w else pieces[c] for i, (w, c) in enumerate(zip(whole.tolist(), code[first].tolist(), strict=True))]
        code[first] = len(pieces) + np.arange(len(column))
        if whole.any():
            text_of = np.repeat(np.arange(len(column)), np.diff(bounds))
            kept = ~whole[text_of]
            kept[first] = True
            code, bounds = code[kept], np.append(0, np.cumsum(np.bincount(text_of[kept], minlength=len(column))))
        code = np.insert(code, bounds[1:], len(pieces) + len(firsts))  # the end
        bounds = bounds + np.arange(len(bounds))

        found = [*self._looked_up([self.blank + p for p in pieces] + firsts, plain=not marked.any()), end_id.to_bytes(4, "little")]
        ids = pa.array(found, pa.large_binary()).take(pa.array(code))
        at = np.frombuffer(ids.buffers()[1], "<i8", len(code) + 1)[bounds] // 4
        return np.frombuffer(ids.buffers()[2] or b"", "<u4", at[-1]).astype(dtype), at

    def _word(self, word: str) -> list[int]:
        """Ids of a blank and letters, or letters alone."""
        if self.lower:
            word = word.lower()
        if word.isascii():
            word = word.replace(" ", self.letters[32])
        else:
            word = word.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(word)]

    def _looked_up(self, texts: list[str], plain: bool) -> list[bytes]:
        """Ids of each text; one that is a known chunk needs no search for chunks."""
        found = list(map(self.known.get, texts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(missing, self.encode_all((texts[i] for i in missing), plain), strict=True):
            found[i] = ids
        return found

    def _joined(self, texts: list[list[str]]) -> Iterator[bytes]:
        known = self.known
        if self.bytes > CACHE_BYTES:
            known.clear()
            self.bytes = 0
        new = list({c: None for chunks in texts for c in chunks if c not in known})
        if self.direct:
            for c in filter(_WORD, new):
                known[c] = array("I", self._word(c)).tobytes()
                self.bytes += OVERHEAD + len(c) + len(known[c])
            new = [c for c in new if c not in known]
        for c, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False) if new else (), strict=True):
            known[c] = array("I", e.ids).tobytes()
            self.bytes += OVERHEAD + len(c) + len(known[c])
        for chunks in texts:
            yield b"".join(map(known.__getitem__, chunks))


def chunk_encoder(path: str, chunk_pattern: str) -> ChunkEncoder:
    """The worker's own encoder for a vocabulary file."""
    return held_by_worker(("chunks", path, chunk_pattern), lambda: ChunkEncoder(path, chunk_pattern))
