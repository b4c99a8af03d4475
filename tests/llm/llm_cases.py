"""Small cases shared by the tests of the operators."""

import random

WORDS = "the of and to in is that for it was on are as with his they at be this from".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", ","]) for _ in range(n))


BASE = prose(1, 300)
TEXTS = [
    (1, BASE), (2, None), (3, ""), (4, " \n\t "), (5, prose(2, 20_000)), (6, BASE), (6, BASE),
    (7, "one"), (8, "Ünï çödé 你好 don't  stop\n\nit's x y \x1c z 🙂"), (9, "ONE"),
    (10, BASE.replace("the", "The", 1) + " end"), (None, "a row without an id"), (11, "x" * 50_000),
    (12, prose(3, 120)), (12, prose(4, 80)),
]
#: Columns whose names the operators use for themselves.
EXTRA = ("lang string, source string, n_chars long, row_key long, node long, block long, flag boolean, "
         "held_out boolean, score double, kind int, `row` long, base string, `input` string")
