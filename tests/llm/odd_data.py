"""Awkward documents for the operators' tests."""

import random

# Names that the operators use inside: other columns may be called the same.
CLASHING = ["k", "x", "z", "rows", "rest", "row", "fp", "root", "shard", "toxicity", "kept", "items", "n_words", "w", "b", "t"]


def syllables(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = ["an", "the", "or", "ti", "ing", "re", "sh", "ea", "é", "ß", "ou", "st"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, repeated rows, repeated ids, copies and near copies."""
    base, passage = syllables(1, 220), syllables(2, 90)
    near = base.split(" ")
    near[100] = "CHANGED"
    rows = [(10, base), (11, base), (12, " ".join(near)), (13, syllables(3, 80) + " " + passage + " " + syllables(4, 60)),
            (14, passage + "\n" + syllables(5, 50)), (15, syllables(6, 40) + "  " + passage), (16, None), (17, ""), (18, " \n\t "),
            (19, syllables(7, 12_000)), (20, "ab " * 4000), (21, "a" * 5000), (21, syllables(8, 70)), (22, passage), (22, passage),
            (None, base), (None, None), (23, syllables(9, 5)), (24, "x\x00y " * 60), (25, "日本語 テキスト " * 50 + passage),
            (26, syllables(3, 80) + " idiot 1d10t i d i o t stuuupid <|endoftext|> it's  we'll\r\n\r\n  x")]
    return rows
