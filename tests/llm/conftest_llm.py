"""Texts with every edge case, shared by the tests of this folder."""

import random


def prose(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ba", "no", "ti", "re", "éu", "so"]) for _ in range(rng.randint(1, 4))) for _ in range(count))


def edge_texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join(words[:60] + ["changed"] + words[61:])
    passage = prose(2, 50)
    return [
        (1, base),
        (2, base),
        (3, near),
        (4, None),
        (5, ""),
        (6, " \t\n\x0b\x0c\r "),
        (7, "one two three"),
        (8, "ONE  two\nthree"),
        (9, passage + "\n" + prose(3, 40)),
        (10, prose(4, 30) + "\t" + passage + " " + prose(5, 10)),
        (11, prose(6, 20_000)),
        (12, "same " * 200),
        (12, "same " * 200),
        (None, base.upper()),
        (None, None),
        (13, "Line one here\nLine one here\n\nline ### $ two | <b> é ü　日本 \U0001f600 end"),
        (14, prose(7, 34)),
        (15, prose(7, 34) + " " + prose(7, 34)),
        (16, "\x00odd\x1cseparators\x85here and​ there  twice \n\n end "),
        (17, "x" * 5000),
    ]
