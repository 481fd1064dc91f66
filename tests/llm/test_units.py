"""Units found by bytes against the pattern, and that whole groups of texts are looked up at once."""

import random

import numpy as np

from forgemeter.llm import idfiles, packing, tokens

LETTERS = list("abZ é ß ǆ -.'(<|)~ 19 \n\t_@% ") + ["\x0b", "ab", "--"]


def test_units_by_bytes_are_those_of_the_pattern():
    rng = random.Random(3)
    texts = ["".join(rng.choices(LETTERS, k=rng.randint(1, 30))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    whole, sizes = b"".join(raw), np.array(list(map(len, raw)))
    starts = tokens.unit_starts(np.frombuffer(whole, np.uint8), np.cumsum(sizes) - sizes).tolist()
    got = [whole[a:b].decode() for a, b in zip(starts, [*starts[1:], len(whole)])]
    assert got == [u for t in texts for u in tokens.PIECE.findall(t)]


def test_a_unit_of_a_group_is_looked_up_once():
    own = tokens.UnitEncoder(tokens.tokenizer_path(idfiles.TOKENIZER))
    asked = []

    class Counted(dict):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    own.known = Counted()
    texts = ["one two, two one", "two one é 9", None, ""] * 50
    want = [own._encode([t])[0].tobytes() if t else b"" for t in texts[:4]] * 50
    assert own.encode(texts) == want
    assert len(asked) == len(set(asked)) > 0


def test_units_of_a_vocabulary_without_case_are_looked_up_in_lower_case():
    own = tokens.UnitEncoder(tokens.tokenizer_path(packing.TOKENIZER))
    texts = ["The THE the, É é", "Ⱥ. Ⱦ, the"] * 20
    assert own.encode(texts) == [own._encode([t])[0].tobytes() for t in texts]
    assert " the" in own.known and " THE" not in own.known
