"""Texts for these tests."""

import random


def prose(seed, words=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ne", "su", "té"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def odd_texts():
    """Null, empty, blank, tiny, very long, repeated, nearly repeated and symbol texts."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "other"
    return [
        None,
        "",
        " \n\t ",
        "word",
        "one two three four",
        base,
        base,
        " ".join(near),
        base.upper(),
        prose(2, 4000),
        "*** $$$ &&& " * 40,
        "\u20ac" * 300,
        "line\nline\n\nline\n" * 10,
        'password = "hunter2000" and AKIA' + "A1B2C3D4E5F6G7H8" + " 0123456789abcdef01234567",
    ]
