"""Token ids of whole texts by the tokenizers library.

The library's byte-level pattern always starts a new word at a blank or line break that follows a
character that is not white space.  Texts are cut there, each distinct piece is encoded once and
remembered, and a text's ids are the ids of its pieces in order: the same ids as from encoding the
text in one go (tests hold the two against each other), at several times the speed.  The strings of a
vocabulary's added tokens (an end of text, say) are pieces of their own, as they are to the library.  The memory is
bounded: when it is full, the pieces met least often are forgotten.  A reused Python worker keeps its
encoder from task to task.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np

from .common import release_memory, worker_store

END_ID = 0
_REMEMBERED = 1_000_000
_SEGMENT = 1 << 20
# A piece: leading white space, then up to the next blank or line break that follows other than white
# space.  Only these two split: both sides agree on what they are, whatever their Unicode tables.  A
# plain word also ends before these marks, which never belong to a run of letters.
_PIECE = re.compile(r"[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[ \n.,;:!?|]|\Z)|\s*+\S++(?:[^\S \n]\s*(?:\S+|\Z))*+|\s+")
_CUT = re.compile(r"(?<=\S)[ \n]")


def default_vocabulary() -> str:
    """The byte-level vocabulary that ships with the tokenizers of this installation."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Numbered(dict):
    """Numbers its keys from 0 as they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ids[starts : starts + lengths] of ``which``, one after the other, and where each ends."""
    n = lengths[which]
    after = np.cumsum(n, dtype=np.int64)
    return ids[np.repeat(starts[which] - (after - n), n) + np.arange(after[-1] if len(after) else 0)], after


class Encoder:
    """Encodes texts to unsigned 32-bit ids, those of the library's ``encode(text, add_special_tokens=False)``.

    The string of a special token in a text is that token, as in the library; with ``special_as_text`` it is text.
    """

    def __init__(self, vocabulary: str | None = None, special_as_text: bool = False, remembered: int | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self._tokenizer = Tokenizer.from_file(vocabulary or default_vocabulary())
        self._tokenizer.encode_special_tokens = special_as_text
        added = self._tokenizer.get_added_tokens_decoder().values()
        added = [t for t in added if not (special_as_text and t.special)]
        if any(t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added):
            raise ValueError("added tokens that take in their surroundings or hold blanks")
        self._marks = {t.content for t in added}
        self._mark = re.compile("|".join(re.escape(m) for m in sorted(self._marks, key=len, reverse=True)))
        # A byte-level token is written with one character for each of its bytes.
        vocab = self._tokenizer.get_vocab(with_added_tokens=True)
        self._n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        self._n_bytes[list(vocab.values())] = [len(t) for t in vocab]
        self._remembered = remembered or _REMEMBERED
        self._numbers, self._ids = Numbered(), np.zeros(0, np.uint32)
        self._starts = self._lengths = self._met = np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep the more often met half of what may be remembered."""
        keep = np.sort(np.argsort(-self._met, kind="stable")[: self._remembered // 2])
        pieces = list(self._numbers)
        self._numbers.clear()
        self._numbers = Numbered((pieces[i], n) for n, i in enumerate(keep.tolist()))
        self._ids, after = _gathered(self._ids, self._starts, self._lengths, keep)
        self._lengths, self._met = self._lengths[keep], self._met[keep] // 2
        self._starts = (after - self._lengths).astype(np.int32)
        release_memory()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids end."""
        if len(self._numbers) > self._remembered:
            self._forget()
        known, number = len(self._numbers), self._numbers.__getitem__
        parts, n_parts = texts, np.ones(len(texts), np.int64)
        marked = any(m in t for m in self._marks for t in texts)
        if marked or max(map(len, texts), default=0) > _SEGMENT:
            cut = list(map(self._parts, texts))
            parts, n_parts = list(chain.from_iterable(cut)), np.fromiter(map(len, cut), np.int64, len(cut))
        codes, counts = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
        for block in _blocks(parts):
            pieces = list(map(_PIECE.findall, block))
            if marked:
                pieces = [[p] if p in self._marks else found for p, found in zip(block, pieces)]
            counts.append(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            codes.append(np.fromiter(map(number, chain.from_iterable(pieces)), np.int64, counts[-1].sum()))
            del pieces  # before new ones are learned
        if len(self._numbers) > known:
            self._learn(list(islice(self._numbers, known, None)))
        flat = np.concatenate(codes)
        seen = np.bincount(flat)
        self._met[: len(seen)] += seen.astype(np.int32)
        ids, after = _gathered(self._ids, self._starts, self._lengths, flat)
        upto = np.cumsum(np.concatenate(counts))[np.cumsum(n_parts)]
        return ids, np.concatenate([[0], after])[upto]

    def _parts(self, text: str) -> list[str]:
        """The strings of added tokens, and what stands between them in segments."""
        out, lo = [], 0
        for m in self._mark.finditer(text) if self._marks else ():
            out += [*segments(text[lo : m.start()]), m.group()]
            lo = m.end()
        return out + segments(text[lo:])

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces: runs of those with a leading blank or line break as one text, the others alone."""
        lengths, ids, run = [], [], []
        for p in pieces:
            if p[0] in " \n" and not p[-1].isspace() and len(run) < 256:
                run.append(p)
                continue
            self._encode_run(run, lengths, ids)
            run = []
            ids.append(self._plain(p))
            lengths.append(np.array([len(ids[-1])]))
        self._encode_run(run, lengths, ids)
        new = np.concatenate(lengths).astype(np.int32)
        self._starts = np.concatenate([self._starts, (len(self._ids) + np.cumsum(new) - new).astype(np.int32)])
        self._lengths = np.concatenate([self._lengths, new])
        self._ids = np.concatenate([self._ids, *ids])
        self._met = np.concatenate([self._met, np.zeros(len(new), np.int32)])

    def _encode_run(self, run: list[str], lengths: list, ids: list) -> None:
        if run:
            got = self._plain("".join(run))
            ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in run])
            cuts = np.searchsorted(np.cumsum(self._n_bytes[got]), ends) + 1
            lengths.append(np.diff(cuts, prepend=0))
            ids.append(got)


def worker_encoder(vocabulary: str | None, remembered: int | None = None) -> Encoder:
    """This Python worker's encoder."""
    release_memory()
    encoders = worker_store().setdefault("encoders", {})
    if (vocabulary, remembered) not in encoders:
        encoders.clear()
        encoders[vocabulary, remembered] = Encoder(vocabulary, remembered=remembered)
    return encoders[vocabulary, remembered]


def forget_encoders() -> None:
    """Free what this Python worker remembers for encoding, where it goes on with other work."""
    if worker_store().pop("encoders", None):
        release_memory()


def _blocks(parts: list[str]) -> Iterator[list[str]]:
    """Runs of parts with about two million characters, whose pieces are held at once."""
    if parts:
        run = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))) // (2 * _SEGMENT)
        cuts = (np.flatnonzero(np.diff(run)) + 1).tolist()
        for lo, hi in zip([0, *cuts], [*cuts, len(parts)]):
            yield parts[lo:hi]


def segments(text: str) -> list[str]:
    """Runs of about a million characters, so that one very long text is not cut into pieces all at once."""
    if len(text) <= _SEGMENT:
        return [text]
    out, lo = [], 0
    while lo < len(text):
        m = _CUT.search(text, lo + _SEGMENT) if lo + _SEGMENT < len(text) else None
        hi = m.start() if m else len(text)
        out.append(text[lo:hi])
        lo = hi
    return out
