"""Encoding whole texts with the tokenizers library, each distinct chunk of text once for each worker."""

from __future__ import annotations

import os
import re
import string
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from recordlens.llm.common import slices, utf8

#: Chunks of text after which a worker starts a new memory, keeping the last one; about 200 bytes each.
REMEMBERED = 500_000
#: Chunks of more bytes are not remembered.
LONGEST = 64
#: Bytes of text that are cut and encoded at a time, but for a text that alone has more.
SLICE = 1 << 23

# Cutting in front of white space that follows other characters never cuts a token, because the vocabularies
# split a text into pieces first, none of which goes on after a run of white space begins, and look only ahead.
# That is so for the white space below. A text that holds any other is encoded in one piece.
_CHUNK = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
_OTHER_SPACE = "[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_OTHER_SPACES = re.compile(_OTHER_SPACE)


def _bytes_of(characters: str) -> np.ndarray:
    """Which bytes are among some ASCII characters."""
    return np.isin(np.arange(256), list(characters.encode()))


_SPACE = _bytes_of(" \n\t\r")
_LETTER = _bytes_of(string.ascii_letters)
_MARK = _bytes_of(string.punctuation)


def chunks(text: str) -> list[str]:
    """A text cut where no token can reach across."""
    return [text] if _OTHER_SPACES.search(text) else _CHUNK.findall(text)


def _starts(raw: np.ndarray, offsets: np.ndarray, whole: np.ndarray, added: list[tuple[int, int]]) -> np.ndarray:
    """Where the chunks of some texts begin in their bytes.

    Beside white space, texts are cut between a letter and an ASCII mark, which no piece of these vocabularies
    joins. Letters are ASCII's and U+00C0 to U+00FF without the two signs among them. Added tokens, whose places are given,
    are chunks, as the library takes them out first and encodes what is between on its own. Texts marked ``whole`` stay so.
    """
    cut = np.zeros(len(raw) + 1, bool)
    space = _SPACE[raw]
    np.greater(space[1:], space[:-1], out=cut[1:-1])
    letter = _LETTER[raw]
    letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    cut[1:-1] |= letter[:-1] & _MARK[raw[1:]]
    for here, there in added:
        cut[here:there] = False
        cut[[here, there]] = True
    for i in np.flatnonzero(whole).tolist():
        cut[offsets[i] : offsets[i + 1]] = False
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


class Memory:
    """What a worker remembers of chunks: those met of late, and those met before them."""

    def __init__(self, most: int) -> None:
        self.most, self.late, self.older = most, {}, {}

    def recall(self, distinct: set[str]) -> tuple[dict[str, bytes], list[str]]:
        """What is known of some chunks, and those that are not known."""
        new = distinct.difference(self.late)
        again = {c for c in new if c in self.older}
        self.late.update((c, self.older[c]) for c in again)
        known = list(distinct.difference(new)) + list(again) if new else list(distinct)
        return dict(zip(known, map(self.late.__getitem__, known), strict=True)), list(new.difference(again))

    def learn(self, found: dict[str, bytes]) -> None:
        if len(self.late) + len(found) > self.most:
            self.late, self.older = {}, self.late
        self.late.update(found)


class Encoder:
    """Token ids as little-endian unsigned 32-bit integers; added tokens in a text have their ids, as in the library."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in tokens):
            raise ValueError("texts are cut at added tokens that stand as they are only")
        # The longest first, as the library prefers them.
        self.added = "|".join(re.escape(t.content) for t in sorted(tokens, key=lambda t: -len(t.content)))
        # The same vocabulary for what is one piece already, without the search for pieces.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.lowers = self.tokenizer.normalizer is not None
        self.memory = Memory(remembered)

    def _piece(self, word: str) -> str | None:
        """A word of letters only as the vocabulary takes it, which is as one piece; None for anything else."""
        if self.lowers:  # white space falls away; NFC and lower case as the library has them
            word = word.strip(" \n\t\r")
            if word.isascii() or ("\u03a3" not in word and unicodedata.is_normalized("NFC", word)):
                word = word.lower()
                return word if word.isalpha() else None
            return None
        return word if word.isalpha() or word[:1] == " " and word[1:].isalpha() else None

    def _encode(self, new: list[bytes]) -> list[bytes]:
        """The ids of chunks that are not known."""
        out: list[bytes] = [b""] * len(new)
        for at in range(0, len(new), 5000):
            texts = [c.decode() for c in new[at : at + 5000]]
            pieces = list(map(self._piece, texts))
            words = [i for i, p in enumerate(pieces) if p is not None]
            others = [i for i, p in enumerate(pieces) if p is None]
            for tokenizer, places, source in ((self.bare, words, pieces), (self.tokenizer, others, texts)):
                found = tokenizer.encode_batch_fast([source[i] for i in places], add_special_tokens=False)
                for i, e in zip(places, found, strict=True):
                    out[at + i] = array("I", e.ids).tobytes()
        return out

    def _known(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks."""
        late, older = self.memory.late, self.memory.older
        found = list(map(late.get, distinct))
        new, fresh = [], {}
        for i in [i for i, x in enumerate(found) if x is None]:
            found[i] = older.get(distinct[i])
            if found[i] is None:
                new.append(i)
            else:
                fresh[distinct[i]] = found[i]
        for i, ids in zip(new, self._encode([distinct[i] for i in new]), strict=True):
            found[i] = ids
            if len(distinct[i]) <= LONGEST:
                fresh[distinct[i]] = ids
        self.memory.learn(fresh)
        return found

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, one text after another, and the offsets of the texts among them.

        Null is the empty text. Each slice of the column is cut by array operations and its distinct chunks
        are looked up or encoded once; only those become Python objects.
        """
        raw, offsets = utf8(column)
        whole = pc.fill_null(pc.match_substring_regex(column, _OTHER_SPACE), False).to_numpy(zero_copy_only=False)
        holds = pc.fill_null(pc.match_substring_regex(column, self.added), False).to_numpy(zero_copy_only=False) if self.added else np.zeros(len(column), bool)
        pattern = re.compile(self.added.encode())
        parts, ends, total = [np.empty(0, "<u4")], [np.zeros(1, np.int64)], 0
        for first, last in slices(offsets, SLICE):
            part, local = raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            added = [
                (local[i] + m.start(), local[i] + m.end())
                for i in np.flatnonzero(holds[first:last]).tolist()
                for m in pattern.finditer(part[local[i] : local[i + 1]].tobytes())
            ]
            starts = _starts(part, local, whole[first:last], added) if len(part) else np.empty(0, np.int64)
            bounds = np.append(starts, len(part)).astype(np.int64)
            cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(part)])
            coded = cut.dictionary_encode()
            found, codes = self._known(coded.dictionary.to_pylist()), coded.indices.to_numpy(zero_copy_only=False)
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            begins = np.cumsum(sizes) - sizes
            after = np.concatenate([[0], np.cumsum(sizes[codes])])  # ids in front of each chunk, and of all
            at = np.repeat(begins[codes] - after[:-1], sizes[codes]) + np.arange(after[-1])
            parts.append(np.frombuffer(b"".join(found), "<u4")[at])
            ends.append(total + after[np.searchsorted(starts, local[1:])])
            total += int(after[-1])
        return np.concatenate(parts), np.concatenate(ends)


@lru_cache(maxsize=4)
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """The worker's encoder of a vocabulary file; kept between tasks."""
    return Encoder(path, remembered)


def public_path(name: str) -> str:
    """The place of a vocabulary file of the installed public tokenizers on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)
