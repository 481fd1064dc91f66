"""Whole-text encoding with a public tokenizer, a unit at a time.

Both vocabularies split a text before a white-space run at the latest, and where a letter is followed
by ASCII punctuation, so a text is the chain of its units and its ids are the chained ids of
the units. Units repeat, so a worker keeps those it has met. A vocabulary that ignores case gets
its texts in lower case, which makes fewer units. Texts beyond the Latin letters are split at
white space only; texts for which that does not hold either (white space beyond ASCII,
what looks like a special token) are encoded whole.

Texts of Latin letters are cut many at a time, by the classes of their bytes, and a unit is looked up
once for all its places in them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Collection, Sequence

import numpy as np
import pyarrow as pa

from forgemeter.llm.tables import SPACES

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WHOLE = re.compile(
    "[\\x00\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u2064\\u3000\\ufeff]"
    r"|<\|"
)
# Latin letters without İ, whose lower case is two characters; none of them combines.
BEYOND_LATIN = re.compile("[^\x00-\u012f\u0131-\u024f]")
_L, _S, _P = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"\x20\x09-\x0D", r"!-/:-@\[-`{-~"
PIECE = re.compile(
    rf"[{_S}]*[{_L}]++(?![^{_S}{_P}])"
    rf"|[{_S}]*[{_P}]++[{_L}]*+(?![^{_S}{_P}])"
    rf"|[{_S}]*[^{_S}]+"
    rf"|[{_S}]+"
)
# What a text whose units are found by its bytes never has.
NOT_BY_BYTES = re.compile("[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u024f]")
MARKS = ("\x00", "\x1c", "\x1d", "\x1e", "\x1f", "<|")
_SPACE, _PUNCTUATION, _LETTER, _OTHER = range(4)
# The class of each byte of such a text: all bytes of letters beyond ASCII are letters.
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[ord(c) for c in SPACES]] = _SPACE
_CLASS[[b for b in range(128) if re.fullmatch(f"[{_P}]", chr(b))]] = _PUNCTUATION
_CLASS[[b for b in range(256) if b >= 128 or chr(b).isalpha()]] = _LETTER
# Ends each unit where many are encoded as one text; no unit holds the zero character.
END = " \x00"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def unit_starts(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the units of ``PIECE`` start in texts laid end to end, given as bytes, from where the texts
    start: before white space, and between a letter and punctuation unless something else comes
    earlier between the white space."""
    kind = _CLASS[raw]
    start = np.zeros(len(raw), dtype=bool)
    space = kind == _SPACE
    start[1:] = space[1:] & ~space[:-1]
    start[texts] = True
    stretches = np.flatnonzero(start)
    inner = np.flatnonzero((kind[1:] == _PUNCTUATION) & (kind[:-1] == _LETTER)) + 1
    others = np.flatnonzero(kind == _OTHER)
    since = stretches[np.searchsorted(stretches, inner, "right") - 1]
    clean = np.searchsorted(others, inner) == np.searchsorted(others, since)
    start[inner[clean]] = True
    return np.flatnonzero(start)


class UnitEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    ``keep_units`` bounds the units a worker remembers; beyond it the memory starts anew, which
    costs time and changes no id.
    """

    def __init__(self, path: str, keep_units: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.top_id = max(self.tokenizer.get_vocab().values(), default=0)
        self.keep_units = keep_units
        self.known: dict[str, bytes] = {}
        self.end_ids = self._encode([END])[0]
        one, two = self._encode(["AÉ", "aé"])
        self.ignores_case = one.tobytes() == two.tobytes()

    def id_type(self, end_id: int) -> str:
        """The unsigned type that holds all ids of the vocabulary and the end id."""
        return "<u2" if max(self.top_id, end_id) < 1 << 16 else "<u4"

    def _encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _encode_chained(self, units: Sequence[str]) -> list[bytes]:
        """Ids of units that begin with white space, from texts of a thousand units each."""
        parts = [units[at : at + 1000] for at in range(0, len(units), 1000)]
        out: list[bytes] = []
        for ids in self._encode([END.join(part) + END for part in parts]):
            stops = np.flatnonzero(ids == self.end_ids[-1]) + 1
            raw, width = ids.tobytes(), 4 * len(self.end_ids)
            edges = [0, *(4 * stops).tolist()]
            out += [raw[a : b - width] for a, b in zip(edges, edges[1:])]
        if len(out) != len(units):
            raise ValueError("the vocabulary does not keep the end mark apart")
        return out

    def learn(self, units: Collection[str]) -> None:
        """Ids of units, each given once."""
        new = [u for u in units if u not in self.known]
        if len(self.known) + len(new) > self.keep_units:
            self.known, new = {}, list(units)
        inner = [u for u in new if u[0] in SPACES and u[-1] not in SPACES]
        self.known.update(zip(inner, self._encode_chained(inner), strict=True))
        edge = [u for u in new if u[0] not in SPACES or u[-1] in SPACES]
        self.known.update(zip(edge, (x.tobytes() for x in self._encode(edge)), strict=True))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """One value per text; a null text has no ids."""
        out: list[bytes] = [b""] * len(texts)
        for at, group in groups(texts, 4_000_000):
            split, latin = {}, {}
            for i, text in enumerate(group, at):
                if not text:
                    continue
                odd = not text.isascii() and NOT_BY_BYTES.search(text)
                if odd or any(map(text.__contains__, MARKS)):
                    if WHOLE.search(text):
                        out[i] = self._encode([text])[0].tobytes()
                    elif BEYOND_LATIN.search(text):
                        split[i] = UNIT.findall(text)
                    else:
                        split[i] = PIECE.findall(text.lower() if self.ignores_case else text)
                else:
                    latin[i] = (text.lower() if self.ignores_case else text).encode()
            for i, ids in zip(latin, self._encode_latin(list(latin.values()))):
                out[i] = ids
            self.learn(set().union(*split.values()))
            for i, units in split.items():
                out[i] = b"".join(map(self.known.__getitem__, units))
        return out

    def _encode_latin(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts, none empty, whose units are found by their bytes."""
        if not texts:
            return []
        whole = b"".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.cumsum(sizes) - sizes
        starts = unit_starts(np.frombuffer(whole, np.uint8), first)
        edges = np.append(starts, len(whole)).astype(np.int64)
        units = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(whole)]
        ).dictionary_encode()
        distinct = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(distinct)
        found = list(map(self.known.__getitem__, distinct))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        places = units.indices.to_numpy()
        counts = lengths[places]
        stops = np.cumsum(counts)
        # Each id's place in the ids of the distinct units.
        shift = (np.cumsum(lengths) - lengths)[places] - (stops - counts)
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(shift, counts) + np.arange(stops[-1])]
        raw = ids.tobytes()
        before = np.append(0, stops)[np.append(np.searchsorted(starts, first), len(starts))].tolist()
        return [raw[4 * a : 4 * b] for a, b in zip(before, before[1:])]


def groups(texts: Sequence[str | None], chars: int = 2_000_000):
    """Runs of texts of about so many characters, with the place of the first."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= chars:
            yield start, texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder for a vocabulary file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]
