"""Token ids of whole texts, cached by words and space-led pieces."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

#: Words and pieces kept within a task; a full cache is emptied, which changes speed only.
CACHE_PIECES = 400_000
#: Bytes of texts encoded at a time.
ENCODE_BYTES = 1_000_000
#: How a byte-level vocabulary writes a space.
SPACE = "\u0120"

#: A space that doesn't lead a piece, and those that do.
DOUBT, CUT = re.compile(r" (?:\s|\Z)"), re.compile(r" (?=\S)")

# ASCII, Latin letters and usual signs, whose classes no version of Unicode changes
LETTERS, DIGITS, WHITE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r "
SIGNS = "\xa1-\xbf\xd7\xf7\u2010-\u2027\u2030-\u205e\u20ac"
KNOWN = re.compile(f"[\0-\x7f{LETTERS}{SIGNS}]*")
#: The words that a byte-level pre-tokenizer makes of such characters.
WORD = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{WHITE}{LETTERS}{DIGITS}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


class Encoder:
    """Encodes whole texts as the tokenizer does, reusing the ids of pieces seen before.

    A byte-level pre-tokenizer never joins what stands before a space with what
    follows it, if the next character is no white space. So a text may be cut in
    front of such spaces, and a piece always has the same ids. Pieces of known
    characters are cut further, into the pre-tokenizer's words, since many pieces
    differ in their punctuation only; the model gets each word once, without the
    work that the tokenizer does for whole texts. Other pieces are encoded by the
    tokenizer, and so are whole texts if it is of another kind.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        pre = self.tokenizer.pre_tokenizer
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.by_piece = (
            isinstance(pre, ByteLevel)
            and pre.use_regex
            and not pre.add_prefix_space
            and self.tokenizer.normalizer is None
            and not any(" " in t.content or t.lstrip or t.rstrip for t in added)
        )
        #: Ids of words, and of the other pieces.
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.leads, self.sizes = np.zeros(self.vocabulary, bool), np.zeros(self.vocabulary, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.leads[i], self.sizes[i] = token.startswith(SPACE), len(token)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = CharDelimiterSplit("\n")
        chars = "".join(c for c in map(chr, range(0x20AD)) if KNOWN.fullmatch(c))
        written = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chars)[0][0]
        #: How the vocabulary writes a byte; 255 is in no text, and stands between words.
        self.written = {255: "\n"} | dict(zip(chars.encode(), written, strict=True))

    @property
    def vocabulary(self) -> int:
        return max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1

    def clear(self) -> None:
        self.words.clear()
        self.pieces.clear()

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of space-led pieces, encoded as one text: a piece begins where an id begins with a space."""
        if not pieces:
            return []
        ids = np.frombuffer(self._ids(["".join([" " + p for p in pieces])])[0], "<u4")
        at = np.flatnonzero(self.leads[ids])
        if len(at) != len(pieces):
            return self._ids([" " + p for p in pieces])
        data, cuts = ids.tobytes(), [*(at * 4).tolist(), len(ids) * 4]
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of known characters, each by itself: a word ends where the bytes of its ids do."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        text = b"\xff".join(raw).decode("latin-1").translate(self.written)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends, own = np.cumsum(self.sizes[ids]), np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        at = np.searchsorted(ends, own)
        if not len(ids) or ends[-1] != own[-1] or (ends[at] != own).any():
            return self._ids(words)
        data, cuts = ids.tobytes(), [0, *((at + 1) * 4).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _known(self, pieces: list[str]) -> np.ndarray:
        """Whether a piece can be cut into words: known characters, no added token, and no space inside, which is left where white space follows."""
        known = [(p.isascii() or KNOWN.fullmatch(p) is not None) and " " not in p for p in pieces]
        text = " ".join(pieces)
        if found := [a for a in self.added if a in text]:
            known = [k and not any(a in p for a in found) for k, p in zip(known, pieces, strict=True)]
        return np.array(known, bool)

    def _by_words(self, pieces: list[str]) -> pa.Array:
        """Ids of known pieces, from those of their words."""
        words, at = distinct(WORD.findall(" ".join(["", *pieces])))
        ids = list(map(self.words.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(new, self._words([words[i] for i in new]), strict=True):
            ids[i] = self.words[words[i]] = x
        begins = np.flatnonzero(np.array([w[0] == " " for w in words], bool)[at])
        data, ends = taken(pa.array(ids, pa.large_binary()), at)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(ends[np.append(begins, len(at))]), data])

    def _other(self, pieces: list[str]) -> pa.Array:
        """Ids of the other pieces."""
        new = [p for p in pieces if p not in self.pieces]
        spaced = [p for p in new if " " in p]
        self.pieces.update(zip(spaced, self._ids([" " + p for p in spaced]), strict=True))
        rest = [p for p in new if " " not in p]
        self.pieces.update(zip(rest, self._pieces(rest), strict=True))
        return pa.array([self.pieces[p] for p in pieces], pa.large_binary())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_piece:
            return self._ids(texts)
        if len(self.words) + len(self.pieces) > CACHE_PIECES:
            self.clear()
        parts = [CUT.split(t) if DOUBT.search(t) else t.split(" ") for t in texts]
        firsts = self._ids([own.pop(0) for own in parts])
        pieces, at = distinct([*chain.from_iterable(parts)])
        if not pieces:
            return firsts
        known = self._known(pieces)
        both = self._by_words([*compress(pieces, known)]), self._other([*compress(pieces, ~known)])
        place = np.where(known, np.cumsum(known) - 1, len(both[0]) + np.cumsum(~known) - 1)
        data, ends = taken(pa.concat_arrays(both), place[at])
        cuts = ends[np.cumsum([0, *map(len, parts)])].tolist()
        return [first + data[a:b].to_pybytes() for first, a, b in zip(firsts, cuts, cuts[1:], strict=False)]


def distinct(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Each text once, and where each of the given ones stands among them."""
    found = pa.array(texts, pa.large_string()).dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()


def taken(ids: pa.Array, at: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The ids numbered by ``at`` in a row, and where each of them begins, with the end of the last."""
    if not len(at):
        return pa.py_buffer(b""), np.zeros(1, np.int64)
    found = ids.take(pa.array(at))
    return found.buffers()[2], np.frombuffer(found.buffers()[1], np.int64, len(at) + 1)


@lru_cache(2)
def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """The encoder of a worker process, loaded once; tasks empty its cache when they end."""
    return Encoder(path, special_as_text)
