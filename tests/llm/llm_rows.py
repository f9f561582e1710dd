"""Rows the tests share."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, shard string, copies int, range int"
WORDS = [a + b for a in "ka lo mi nu re sa to vi".split() for b in "ban der fel gim hok jun pas".split()]


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_rows():
    """Null columns, empty and long texts, ties, repeated rows and ids, and columns with the names operators use."""
    base = prose(1, 60)
    texts = [
        base, base, base + " " + prose(2, 3), prose(3, 5), prose(4, 2), "", None, "   \n\t", "a" * 900, prose(5, 4000), prose(6, 40) + " " + base,
        "É" * 150 + prose(7, 30), prose(8, 50).upper(), "😀 " * 80, base.replace("ka", "KA"),
    ]
    rows = [(i, t, "en" if i % 3 else None, None if i == 2 else f"s{i % 2}", None, "h", "s", 1, 2) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[9], (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
