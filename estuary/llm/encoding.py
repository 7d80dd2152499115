"""Piecewise encoding with a bounded cache of pieces.

Both vocabularies split a text at white space before any merge, so a text is
encoded as the concatenation of its pieces.  A piece's ids are kept as
little-endian uint32 bytes.  Arrow splits the texts and numbers their distinct
pieces, so that Python looks each of these up once, and strings the cached
values together.
Pieces met for the first time take most of the time.  Marks at the end of a
word are cut off where both patterns end a token, so that a word with a comma
is made of parts mostly known, and new words are encoded many at a time.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from estuary.llm.common import keeps


#: Pieces that a worker keeps; beyond it the later half goes.  The pieces met
#: first are the frequent ones, so the half that stays serves most of a text.
MAX_PIECES = 800_000
#: Runs of marks that a worker keeps besides.
MAX_MARKS = 100_000
#: Words that the library encodes as one, and at most at once.
JOINED, AT_ONCE = 100, 20_000

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: White space other than blank, tab and line ends, under either library's reading.
_RARE_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WHITE = re.compile("[ \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_DOUBLES = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")


def cut_words(text: str) -> tuple[str, list[str]]:
    """For vocabularies that drop white space: words, no leading piece."""
    if _RARE_SPACE.search(text):
        return "", [w for w in _WHITE.split(text) if w]
    return "", text.split()


def cut_spaced(text: str) -> tuple[str, list[str]]:
    """First piece, and the pieces that follow a lone space.

    A lone space between two other characters always opens a new token of
    the byte-level pattern, so no token crosses such a cut; runs of white
    space stay inside one piece.
    """
    if any(d in text for d in _DOUBLES) or _RARE_SPACE.search(text):
        first, *rest = _LONE_SPACE.split(text)
    else:
        first, *rest = text.split(" ")
    return first, rest


#: ASCII punctuation but the apostrophe, which may open a token with letters, and what added tokens are written with.
#: A run of them after a letter, at the end of a piece, is a token or more in both vocabularies.
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: Letters that neither normaliser takes apart or changes in length.
_LETTERS = frozenset(c for c in map(chr, range(256)) if c.isalpha())


def cut_lines(text: str) -> tuple[str, list[str]]:
    """As ``cut_spaced``; a line end between other characters opens a piece too, which then starts with it.

    It is a token of its own if no other white space is next to it.
    """
    if "\n" in text and not any(d in text for d in (*_DOUBLES, "\n\n", "\t", "\r")) and not _RARE_SPACE.search(text):
        first, *rest = text.replace("\n", " \n").split(" ")
        return first, rest
    return cut_spaced(text)


#: Written between the pieces of a text; a text that holds it is cut in Python.
_APART = "\0"


def _is_regular(text: str) -> bool:
    """Whether every blank of the text is a lone one."""
    return not any(d in text for d in _DOUBLES) and text[:1] != " " and text[-1:] != " " and not _RARE_SPACE.search(text)


def apart(text: str, spaced: bool, divides: bool) -> tuple[str, str | None]:
    """What ``cut_words``, ``cut_spaced`` or ``cut_lines`` give, the pieces in one string (None: there is none)."""
    if spaced and _is_regular(text):
        if divides and "\n" in text and not any(d in text for d in ("\n\n", "\t", "\r")):
            text = text.replace("\n", " \n")
        first, blank, rest = text.partition(" ")
        return first, rest.replace(" ", _APART) if blank else None
    first, rest = cut_spaced(text) if spaced else cut_words(text)
    return first, _APART.join(rest) if rest else None


def _drop_later(known: dict[str, bytes], new: int, most: int) -> bool:
    """Whether the later half had to go to make room for ``new`` pieces."""
    if len(known) + new <= most:
        return False
    while len(known) > most // 2:
        known.popitem()
    return True


class PieceEncoder:
    """``encode_new`` maps a list of strings to their ids as bytes.

    With ``divides``, the vocabulary is known to end a token between a
    letter and ``_MARKS`` and around a lone line end.
    """

    def __init__(self, encode_new: Callable[[list[str]], list[bytes]], spaced: bool, divides: bool = False):
        self.encode_new, self.spaced, self.divides = encode_new, spaced, divides
        self.cut = (cut_lines if divides else cut_spaced) if spaced else cut_words
        self.firsts: dict[str, bytes] = {}
        self.rests: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _learn(self, known: dict[str, bytes], wanted: set[str], most: int) -> None:
        new = wanted.difference(known)
        if _drop_later(known, len(new), most):
            new = wanted.difference(known)
        new = list(new)
        known.update(zip(new, self.encode_new(new)))

    def _encode_rests(self, pieces: list[str]) -> list[bytes]:
        return self.encode_new([x if x[:1] == "\n" else " " + x for x in pieces] if self.spaced else pieces)

    def _learn_rests(self, new: list[str]) -> None:
        """Lists of strings only: a tuple for each piece would keep the garbage collector busy."""
        known = self.rests
        _drop_later(known, 2 * len(new), MAX_PIECES)  # a divided piece may add its word
        words = [x for x in new if x.isalpha()] if self.divides else new
        known.update(zip(words, self._encode_rests(words)))
        others = [x for x in new if not x.isalpha()] if self.divides else []
        if others:
            heads = [y if y[-1:] in _LETTERS else x for x, y in zip(others, [x.rstrip(_MARKS) for x in others])]
            more = list(set(heads).difference(known))
            known.update(zip(more, self._encode_rests(more)))
            tails = [x[len(y):] for x, y in zip(others, heads)]
            self._learn(self.marks, set(tails), MAX_MARKS)
            known.update(zip(others, [known[x] + self.marks[y] for x, y in zip(heads, tails)]))

    def _rests_of(self, distinct: list[str]) -> list[bytes]:
        """Ids of distinct pieces; only the new ones are looked up again."""
        found = list(map(self.rests.get, distinct))
        new = [x for x, y in zip(distinct, found) if y is None]
        if new:
            self._learn_rests(new)
            learnt = map(self.rests.__getitem__, new)
            found = [next(learnt) if y is None else y for y in found]
        return found

    def _encode_cut(self, text: str) -> bytes:
        """Ids of one text, cut in Python."""
        first, rest = self.cut(text)
        self._learn(self.firsts, {first}, MAX_PIECES)
        distinct = list(set(rest))
        ids = dict(zip(distinct, self._rests_of(distinct)))
        return b"".join((self.firsts[first], *map(ids.__getitem__, rest)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        if any(_APART in t for t in texts):
            return [self._encode_cut(t) if _APART in t else self.encode([t])[0] for t in texts]
        if not texts:
            return []
        firsts, rests = zip(*(apart(t, self.spaced, self.divides) for t in texts))
        self._learn(self.firsts, set(firsts), MAX_PIECES)
        pieces = pc.split_pattern(pa.array(rests, type=pa.large_string()), _APART)
        numbered = pieces.values.dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self._rests_of(distinct), type=pa.large_binary()).take(numbered.indices)
        if not len(ids):
            return [self.firsts[a] for a in firsts]
        _, ends, data = ids.buffers()
        stops = np.frombuffer(ends, dtype=np.int64)[pieces.offsets.to_numpy()].tolist()
        raw = memoryview(data if data is not None else b"")
        return [self.firsts[a] + raw[i:j] for a, i, j in zip(firsts, stops, stops[1:])]


#: The character that byte-level vocabularies write for each byte.
_WRITTEN = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
_WRITTEN |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _WRITTEN)}
_BLANK = _WRITTEN[32]


class NewPieces:
    """Ids of pieces from the library, words of plain letters many at a time.

    The library spends more on handing over a word than on its merges.  A run
    of words written without a gap has the same merges if no token goes on
    beyond the end of a word: a spaced vocabulary holds no token with a blank
    behind a letter, and one with an end suffix is given to the library with
    the last byte of a word as a character of its own.  The ids are dealt
    back by the bytes that each token stands for; where a word does not end
    with a token, and for other pieces, the whole tokenizer is used.
    """

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer, self.spaced = tokenizer, tokenizer.normalizer is None
        model = json.loads(tokenizer.to_str())["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.last = {} if self.spaced else {c: chr(0xE000 + b) for b, c in _WRITTEN.items()}

        def respelt(token: str) -> str:
            word = token.removesuffix(suffix) if suffix else token
            return word[:-1] + self.last[word[-1]] if self.last and word != token else word

        vocabulary = {respelt(x): k for x, k in model["vocab"].items()}
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        plain = model["type"] == "BPE" and not any(model.get(x) for x in (
            "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        self.divides = not any(t.isalpha() or "\n" in t or any(x in _LETTERS and y in _MARKS for x, y in zip(t, t[1:])) for t in added)
        self.joins = (plain and self.divides and len(vocabulary) == len(model["vocab"])
                      and (not any(y == _BLANK and x in _LETTERS for t in vocabulary for x, y in zip(t, t[1:])) if self.spaced else bool(suffix)))
        if self.joins:
            pairs = (x.split(" ") if isinstance(x, str) else x for x in model["merges"])
            self.merger = Tokenizer(BPE(vocab=vocabulary, merges=[(respelt(x), respelt(y)) for x, y in pairs], cache_capacity=0))
            self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
            self.sizes[list(vocabulary.values())] = [len(x) for x in vocabulary]

    def _singly(self, pieces: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(pieces), AT_ONCE):  # bounds the Encoding objects alive
            out += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces[i:i + AT_ONCE], add_special_tokens=False)]
        return out

    def _written(self, word: str) -> str:
        """A word as the merges see it."""
        if not self.spaced:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_WRITTEN)
        return _BLANK + word[1:] if self.spaced else word[:-1] + self.last[word[-1]]

    def _together(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(words), AT_ONCE):
            some = words[i:i + AT_ONCE]
            written = [self._written(x) for x in some]
            runs = ["".join(written[j:j + JOINED]) for j in range(0, len(written), JOINED)]
            ids = np.array([k for e in self.merger.encode_batch_fast(runs, add_special_tokens=False) for k in e.ids], dtype="<u4")
            ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum([len(x) for x in written])
            at = np.searchsorted(ends, wanted)
            if len(ids) and at[-1] == len(ids) - 1 and np.array_equal(ends[at], wanted):
                raw, stops = ids.tobytes(), (4 * (at + 1)).tolist()
                out += [raw[a:b] for a, b in zip([0, *stops], stops)]
            else:
                out += self._singly(some)
        return out

    def _is_word(self, piece: str) -> bool:
        """Letters that are letters to every library and that lower-casing leaves as long."""
        word = piece[1:] if self.spaced else piece
        return word.isalpha() and (word.isascii() or max(word) < "\u0100") and (not self.spaced or piece[0] == " ")

    def encode(self, pieces: list[str]) -> list[bytes]:
        if not self.joins:
            return self._singly(pieces)
        fit = [self._is_word(x) for x in pieces]
        words, others = iter(self._together(list(compress(pieces, fit)))), iter(self._singly([x for x, y in zip(pieces, fit) if not y]))
        return [next(words) if y else next(others) for y in fit]


_LIBRARY: dict[str, PieceEncoder] = {}
keeps("pieces", _LIBRARY.clear)


def library_encoder(path: str) -> PieceEncoder:
    """Encoder over the tokenizers library for the vocabulary file ``path``.

    One per Python worker.  Byte-level vocabularies without a normaliser
    keep their white space; others are taken to drop it.
    """
    if path not in _LIBRARY:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        new = NewPieces(tokenizer)
        _LIBRARY[path] = PieceEncoder(new.encode, spaced=new.spaced, divides=new.divides)
    return _LIBRARY[path]
