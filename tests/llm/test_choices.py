"""What the lattice keeps of a unit against the search for two."""

import random

import numpy as np

from forgemeter.llm import nbest, tokens


def test_the_second_loss_is_known_without_the_second_path():
    own = nbest.Lattice(tokens.tokenizer_path(nbest.MODEL))
    rng = random.Random(2)
    units = sorted({"▁" * rng.randint(0, 2) + "".join(rng.choices("aeinrst日.9", k=rng.randint(1, 9))) for _ in range(3000)})
    for unit in units:
        both = own.search(unit, 2)
        loss = both.losses[1] if len(both.losses) > 1 else np.inf
        assert own.first_choice(unit) == (both.score, both.ids[0], loss)
