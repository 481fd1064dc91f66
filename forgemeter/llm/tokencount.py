"""Exact token counts of every prefix, by prefix dynamic programming.

In a byte-pair vocabulary the encoding of a prefix ends in exactly one token whose joint with the
encoding before it holds: merging the two tokens' bytes anew gives the two tokens again. So the
count of prefix i is the count of prefix i - len(last token) + 1, and one pass from left to
right gives the counts of all prefixes. A text splits into units (white space and what follows, up to
the next white space) that no token crosses, so the table is made once for a unit and a text's table
is the units' tables, each raised by the count before it. Truncation and budget questions
are look-ups in it.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession

from forgemeter.llm import tables, tokens

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512

# White space as Unicode has it, which is where the vocabulary's own splitting pattern ends a run.
_S = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_L, _P = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-/:-@\[-`{-~"
UNIT = re.compile(
    rf"[{_S}]*[{_L}]++(?![^{_S}{_P}])"
    rf"|[{_S}]*[{_P}]++[{_L}]*+(?![^{_S}{_P}])"
    rf"|[{_S}]*[^{_S}]+"
    rf"|[{_S}]+"
)
_LEAD = re.compile(rf"[{_S}]*")
# The pre-token pattern of byte-level vocabularies.
PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+"
)
PARTED = frozenset(["'re", "'ve", "'ll"])


def byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: printable bytes as themselves, the
    others as the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    """Token counts at every byte of a unit without pre-token splits inside, kept by unit."""

    def __init__(self, path: str, keep_units: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            model = json.load(source)["model"]
        letters = byte_letters()
        self.ids = {
            bytes(letters[c] for c in token): i
            for token, i in model["vocab"].items()
            if all(c in letters for c in token)
        }
        self.size = {i: len(token) for token, i in self.ids.items()}
        self.ranks: dict[tuple[int, int], int] = {}
        self.rank_of: dict[int, int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (self.ids[bytes(letters[c] for c in part)] for part in (left, right))
            made = self.ids[bytes(letters[c] for c in left + right)]
            self.ranks[a, b] = rank
            self.rank_of[made] = rank
            self.split[made] = (a, b)
        self.longest = max(map(len, self.ids))
        self.joint: dict[int, bool] = {}
        self.white: dict[str, list[int]] = {}
        self.state: tuple[bytes, list[int], list[int], list[int]] = (b"", [-1], [0], [0])
        self.keep_units = keep_units
        self.known: dict[str, int] = {}
        specials = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special_text = max(specials, default="")
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)")

    def _holds(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are side by side.

        Their merges are undone from the latest on; a merge across the joint that ranks before the
        undone one would have come first."""
        bound = never = 1 << 40
        while True:
            if self.ranks.get((left, right), never) < bound:
                return False
            a, b = self.rank_of.get(left, -1), self.rank_of.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                bound, left = a, self.split[left][1]
            else:
                bound, right = b + 1, self.split[right][0]

    def run(self, text: str) -> list[int]:
        """Counts at every code point of one pre-token."""
        raw = text.encode("utf-8", "replace")
        # What the pre-token before has in common with this one is known; units are met in order.
        before, last, start_of, count = self.state
        same = 0
        for a, b in zip(before, raw):
            if a != b:
                break
            same += 1
        del last[same + 1 :], start_of[same + 1 :], count[same + 1 :]
        self.state = (raw, last, start_of, count)
        get, joint, longest = self.ids.get, self.joint, self.longest
        for stop in range(same + 1, len(raw) + 1):
            # One start only holds, so the order is free: where the token before began, then others.
            likely = start_of[-1]
            low = max(0, stop - longest)
            for start in chain((likely,), range(stop - 1, low - 1, -1)):
                token = get(raw[start:stop])
                if token is None:
                    continue
                if start:
                    left = last[start]
                    key = left << 32 | token
                    holds = joint.get(key)
                    if holds is None:
                        holds = joint[key] = self._holds(left, token)
                    if not holds:
                        continue
                last.append(token)
                start_of.append(start)
                count.append(count[start] + 1)
                break
        if len(raw) == len(text):
            return count[1:]
        return [count[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80]

    def white_run(self, white: str) -> list[int]:
        found = self.white.get(white)
        if found is None:
            if len(self.white) > 10_000:
                self.white = {}
            found = self.white[white] = self.run(white)
        return found

    def unit(self, text: str) -> list[int]:
        """Counts at every code point of a unit. A run of white space is one pre-token while the
        prefix ends in it; before anything else its last character is apart, and a space joins it."""
        white = _LEAD.match(text)[0]
        rest = text[len(white) :]
        out = list(self.white_run(white)) if white else []
        if not rest:
            return out
        base = out[-2] if len(white) > 1 else 0
        joined = white.endswith(" ")
        if white and not joined:
            base += self.white_run(white[-1])[-1]
        for i, part in enumerate(PRE_TOKEN.findall(" " + rest if joined else rest)):
            counts = self.run(part)
            if part in PARTED:  # its beginning alone is a quote and a letter
                counts = [1, 2, counts[-1]]
            out += [base + c for c in (counts[1:] if joined and not i else counts)]
            base += counts[-1]
        return out

    def learn(self, units: Iterable[str]) -> None:
        new = set(units).difference(self.known)
        if len(self.known) + len(new) > self.keep_units:
            self.known, new = {}, set(units)
        if len(self.joint) > 2 * self.keep_units:
            self.joint = {}
        for text in sorted(new):
            counts = self.unit(text)
            self.known[text] = counts[-1]

    def _parts(self, text: str) -> list[str]:
        """The text between special tokens, as the library's default finds them."""
        return self.special.split(text) if "<|" in text else [text]

    def totals(self, texts: Sequence[str | None]) -> list[int]:
        """Counts of whole texts; what is new in them is learnt together."""
        split = []
        for text in texts:
            parts = self._parts(text or "")
            units = UNIT.findall(parts[0])
            for part in parts[1:]:
                units += UNIT.findall(part)
            split.append((units, len(parts) - 1))
        self.learn(set().union(*(units for units, _ in split)))
        return [sum(map(self.known.__getitem__, units)) + extra for units, extra in split]

    def total(self, text: str | None) -> int:
        return self.totals([text])[0]

    def table(self, text: str | None) -> np.ndarray:
        """Counts of all prefixes by code points, from the empty one to the whole text.

        Inside the letters of a special token the prefix is ordinary text."""
        counts, base, before = [0], 0, ""
        for i, part in enumerate(self._parts(text or "")):
            if i:
                units = UNIT.findall(before)
                tail = units[-1] if units else ""
                under = base - (self.unit(tail)[-1] if tail else 0)
                for k in range(1, len(self.special_text)):
                    counts.append(under + self._plain(tail + self.special_text[:k]))
                base += 1
                counts.append(base)
            for u in UNIT.findall(part):
                found = self.unit(u)
                counts += [base + c for c in found]
                base += found[-1]
            before = part
        return np.array(counts, dtype=np.int64)

    def _plain(self, text: str) -> int:
        return sum(self.unit(u)[-1] for u in UNIT.findall(text))

    def longest_prefix(self, text: str | None, limit: int) -> int:
        """Code points of the longest prefix of at most ``limit`` tokens.

        Only the table of the unit in which the limit is passed is looked at."""
        text = text or ""
        parts = self._parts(text)
        if len(parts) > 1:
            return int(np.flatnonzero(self.table(text) <= limit)[-1])
        units = UNIT.findall(text)
        self.learn(units)
        base = chars = 0
        for u in units:
            n = self.known[u]
            if base + n > limit:
                fits = [k for k, c in enumerate(self.unit(u), 1) if base + c <= limit]
                return chars + (fits[-1] if fits else 0)
            base, chars = base + n, chars + len(u)
        return chars


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and chars_in_limit: the code points of the longest
    prefix within the limit. A null text counts as empty, a repeated row is counted again, columns
    besides doc_id and text are ignored."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = counter(tokenizer_path)
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            n = [x for _, group in tokens.groups(texts) for x in found.totals(group)]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_bytes": [len(t.encode("utf-8", "replace")) for t in texts],
                    "n_tokens": n,
                    "over_limit": [x > limit for x in n],
                    "chars_in_limit": [
                        found.longest_prefix(t, limit) if x > limit else len(t)
                        for t, x in zip(texts, n, strict=True)
                    ],
                }
            )

    picked = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return picked.mapInPandas(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_in_limit long"
    )


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.read_table(spark, folder, "documents")
    return count_tokens(docs, tokens.tokenizer_path(TOKENIZER))


QUERIES = {"op8_token_counts": op8_token_counts}
ORACLES: dict[str, str] = {}
