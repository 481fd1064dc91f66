"""The N best segmentations of texts over a SentencePiece vocabulary, and decoding.

The pieces that match a text form a lattice whose paths are its segmentations; a path scores the sum
of its pieces' scores. A forward Viterbi pass gives the best score from the start to every node. A
search backward from the end takes it as heuristic: it is exact, so A-star reaches the
start with the segmentations in order of their score and opens nothing else.

No piece crosses from other letters to a space mark, few kinds of punctuation follow a letter inside a
piece, and none holds a line feed; so the lattice falls into units there, as found when the vocabulary
is loaded. A worker keeps the units it has met. In
a whole text the N - 1 units with the least loss at their second choice hold all that its N
best can differ in, and the same search runs over those; so of most units two choices are enough.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.llm import tables, tokens

MODEL = "piece_bpe_32k.model"
N_BEST = 4
MARK = "▁"
# Fixed value of the format: what an unknown letter scores below the least piece.
UNKNOWN_PENALTY = 10.0


def _by_total(arc: tuple) -> float:
    return -arc[0]


@dataclass(frozen=True)
class Unit:
    """A unit's best segmentations: ids as 32-bit bytes, and what each loses to the first."""

    score: float
    ids: tuple[bytes, ...]
    losses: tuple[float, ...]


class Lattice:
    """A vocabulary as a lattice over texts."""

    def __init__(self, path: str, n_best: int = N_BEST, keep_units: int = 1_400_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_best, self.keep_units = n_best, keep_units
        self.pieces: dict[str, tuple[tuple[int], float]] = {}
        self.byte_ids = [model.unk_id()] * 256
        self.bytes_of: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.pieces[piece] = ((i,), model.get_score(i))
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        self.unit = self._unit_pattern()
        self.state: tuple[str, list, list[float]] = ("", [[]], [0.0])
        self._forget()

    def _unit_pattern(self) -> re.Pattern:
        """Units end before a mark, at a line feed, and between a letter and punctuation that no piece
        has after a letter; a vocabulary with other pieces has whole texts as units."""
        if any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.pieces):
            return re.compile("(?s).+")
        apart = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        letter = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
        for piece in self.pieces:
            apart.difference_update(re.findall(rf"(?<=[{letter}])[^{letter}]", piece))
        if not apart:
            return re.compile(f"{MARK}*[^{MARK}\n]+|\n|{MARK}+")
        stop = re.escape("".join(sorted(apart)))
        return re.compile(
            f"{MARK}*[^{MARK}\n{letter}]*+[{letter}]++(?=[{stop}])|{MARK}*[^{MARK}\n]+|\n|{MARK}+"
        )

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[str] = []
        self.first: list[bytes] = []
        self.second = self.scores = np.zeros(0)
        self.full: dict[int, Unit] = {}

    def normal(self, text: str) -> str:
        """The text as the lattice sees it: a mark before it and for each space."""
        return MARK + text.replace(" ", MARK) if text else ""

    def arcs(self, unit: str) -> tuple[list, list[float]]:
        """For each place the pieces that end there, the best first: best score from the start over
        them, start, ids, own score; and that best score. A letter without a piece is its bytes.

        Units are met in order, so what one shares with the one before is kept: a place's pieces
        depend on nothing behind it."""
        before, out, best = self.state
        same = 0
        for a, b in zip(before, unit):
            if a != b:
                break
            same += 1
        del out[same + 1 :], best[same + 1 :]
        self.state = (unit, out, best)
        get, longest = self.pieces.get, self.longest
        for stop in range(same + 1, len(unit) + 1):
            here = []
            for start in range(max(0, stop - longest), stop):
                found = get(unit[start:stop])
                if found is not None:
                    here.append((best[start] + found[1], start, found[0], found[1]))
            if not here or here[-1][1] != stop - 1:
                raw = unit[stop - 1].encode("utf-8", "replace")
                ids = tuple(self.byte_ids[b] for b in raw)
                here.append((best[stop - 1] + self.unknown, stop - 1, ids, self.unknown))
            if len(here) > 1:
                here.sort(key=_by_total)
            out.append(here)
            best.append(here[0][0])
        return out, best

    def _paths(self, unit: str) -> Iterator[tuple[float, bytes, list]]:
        """Segmentations in order: score, ids, and the heap of what is still open."""
        arcs, best = self.arcs(unit)
        # Entries: -(exact total), order, place, arc into it, score behind it, (ids, rest behind).
        # An arc is opened with the next best arc into the same place, so nothing else waits.
        entry = (-best[-1], 0, len(unit), 0, 0.0, None)
        open_paths: list[tuple] = []
        order = 0
        push, push_pop = heapq.heappush, heapq.heappushpop
        while True:
            total, _, at, arc, behind, path = entry
            if at:
                here = arcs[at]
                if arc + 1 < len(here):
                    order += 1
                    push(open_paths, (-(here[arc + 1][0] + behind), order, at, arc + 1, behind, path))
                _, start, ids, score = here[arc]
                order += 1
                entry = push_pop(open_paths, (total, order, start, 0, behind + score, (ids, path)))
                continue
            ids: list[int] = []
            while path:
                ids += path[0]
                path = path[1]
            yield -total, struct.pack(f"<{len(ids)}I", *ids), open_paths
            if not open_paths:
                return
            entry = heapq.heappop(open_paths)

    def search(self, unit: str, count: int) -> Unit:
        found = [(score, ids) for score, ids, _ in islice(self._paths(unit), count)]
        top = found[0][0]
        return Unit(top, tuple(x for _, x in found), tuple(top - s for s, _ in found))

    def first_choice(self, unit: str) -> tuple[float, bytes, float]:
        """Score and ids of the best segmentation, and what the next loses to it: what is open first has
        the exact total of the path it leads to, so that path need not be followed."""
        score, ids, open_paths = next(self._paths(unit))
        return score, ids, score + open_paths[0][0] if open_paths else np.inf

    def learn(self, units: Collection[str]) -> None:
        new = sorted(set(units).difference(self.known))
        if not new:
            return
        if len(self.known) + len(new) > self.keep_units:
            self._forget()
            new = sorted(set(units))
        scores, first, losses = zip(*map(self.first_choice, new))
        self.known.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
        self.texts += new
        self.first += first
        self.second = np.concatenate([self.second, losses])
        self.scores = np.concatenate([self.scores, scores])

    def unit_at(self, number: int) -> Unit:
        """A met unit with all its choices; few are ever asked for."""
        found = self.full.get(number)
        if found is None:
            found = self.full[number] = self.search(self.texts[number], self.n_best)
        return found

    def split(self, text: str) -> list[str]:
        return self.unit.findall(self.normal(text))

    def _choices(self, places: np.ndarray) -> list[tuple[float, dict[int, int]]]:
        """Losses and deviations (unit -> choice) of the N best."""
        second = self.second[places]
        few = np.argsort(second, kind="stable")[: self.n_best - 1]
        few = [int(u) for u in few if np.isfinite(second[u])]
        lists = [self.unit_at(int(places[u])).losses for u in few]
        # From the last unit to the first; before any unit the least still to lose is zero, exactly.
        open_paths: list[tuple[float, int, int, tuple]] = [(0.0, 0, len(few), ())]
        found, order = [], 0
        while open_paths and len(found) < self.n_best:
            loss, _, at, chosen = heapq.heappop(open_paths)
            if not at:
                found.append((loss, {few[u]: k for u, k in chosen}))
                continue
            for k, more in enumerate(lists[at - 1]):
                order += 1
                deviation = chosen + ((at - 1, k),) if k else chosen
                heapq.heappush(open_paths, (loss + more, order, at - 1, deviation))
        return found

    def encode(
        self, texts: list[str | None], group_chars: int = 2_000_000
    ) -> Iterator[tuple[float, list[tuple[float, bytes]], list[dict[int, int]]]]:
        """Per text its best score, its segmentations (loss and ids), and where each deviates."""
        for _, group in tokens.groups(texts, group_chars):
            split = [self.split(t or "") for t in group]
            self.learn(set().union(*split))
            for units in split:
                if not units:
                    yield 0.0, [(0.0, b"")], [{}]
                    continue
                numbers = list(map(self.known.__getitem__, units))
                places = np.array(numbers)
                first = list(map(self.first.__getitem__, numbers))
                out, deviations = [], []
                for loss, changed in self._choices(places):
                    chain = first
                    if changed:
                        chain = first.copy()
                        for at, k in changed.items():
                            chain[at] = self.unit_at(numbers[at]).ids[k]
                    out.append((loss, b"".join(chain)))
                    deviations.append({numbers[at]: k for at, k in changed.items()})
                yield float(self.scores[places].sum()), out, deviations

    def same_text(self, deviations: dict[int, int]) -> bool:
        """Whether deviating units decode to what their first choice decodes to."""
        return all(
            self.decode_bytes(self.unit_at(u).ids[k]) == self.decode_bytes(self.first[u])
            for u, k in deviations.items()
        )

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace").removeprefix(" ")


_LATTICES: dict[tuple[str, int], Lattice] = {}


def lattice(path: str, n_best: int) -> Lattice:
    if (path, n_best) not in _LATTICES:
        _LATTICES[path, n_best] = Lattice(path, n_best)
    return _LATTICES[path, n_best]


_SEGMENTATION = "doc_id long, choice int, score double, n_pieces long, ids binary"


def segmentations(docs: DataFrame, model_path: str, n_best: int = N_BEST) -> DataFrame:
    """Each document's best segmentations, one row for each: choice 0 is the best.

    ids are little-endian unsigned 32-bit bytes. A null or empty text has one, without pieces; a text
    may have fewer than ``n_best``. Equal scores keep the order of the search, which tries longer
    last pieces first. Repeated rows are each encoded, other columns are ignored."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = lattice(model_path, n_best)
        for batch in batches:
            for part in np.array_split(np.arange(len(batch)), len(batch) // 500 + 1):
                rows = []
                piece = batch.iloc[part]
                for doc_id, (score, best, _) in zip(
                    piece["doc_id"], found.encode(piece["text"].tolist()), strict=True
                ):
                    for k, (loss, ids) in enumerate(best):
                        rows.append((doc_id, k, score - loss, len(ids) // 4, ids))
                names = [field.split()[0] for field in _SEGMENTATION.split(", ")]
                yield pd.DataFrame(rows, columns=names).astype(
                    {"doc_id": "Int64", "choice": "int32", "score": "float64"}
                )

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return picked.mapInPandas(encode, _SEGMENTATION)


def decoded(ids: Column, model_path: str) -> Column:
    """The text of ids as ``segmentations`` gives them."""

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        found = lattice(model_path, N_BEST)
        return values.map(lambda raw: found.decode(raw or b""))

    return decode(ids)


def summaries(docs: DataFrame, model_path: str, n_best: int = N_BEST) -> DataFrame:
    """Per document its best segmentation in numbers, and a checksum over all of its ``n_best``.

    ``round_trip`` says whether every one of them decodes to the text."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = lattice(model_path, n_best)
        for batch in batches:
            rows = []
            texts = batch["text"].tolist()
            for doc_id, text, (score, best, deviations) in zip(
                batch["doc_id"], texts, found.encode(texts), strict=True
            ):
                checks = [zlib.crc32(ids) for _, ids in best]
                same = found.decode(best[0][1]) == (text or "")
                same = same and all(map(found.same_text, deviations))
                rows.append(
                    (doc_id, len(best[0][1]) // 4, score, checks[0], len(best), best[-1][0],
                     zlib.crc32(np.array(checks, dtype="<u4").tobytes()), same)
                )
            yield pd.DataFrame(
                rows,
                columns=[
                    "doc_id", "n_pieces", "score", "ids_crc32", "n_found", "last_loss",
                    "all_crc32", "round_trip",
                ],
            ).astype({"doc_id": "Int64", "score": "float64"})

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return picked.mapInPandas(
        encode,
        "doc_id long, n_pieces long, score double, ids_crc32 long, n_found int, last_loss double, "
        "all_crc32 long, round_trip boolean",
    )


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.read_table(spark, folder, "documents")
    return summaries(docs, tokens.tokenizer_path(MODEL))


QUERIES = {"op10_sentencepiece": op10_sentencepiece}
ORACLES: dict[str, str] = {}
