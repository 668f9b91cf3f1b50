"""Small corpora for the tests."""

import random

WORDS = {"en": "the of and house water people light down early north stone river bright small walk".split(),
         "de": "der und nicht straße über haus wasser leute früh nord stein fluss hell klein gehen".split(),
         "fr": "le et de maison où être garçon eau gens lumière tôt nord pierre rivière petit".split()}


def text_of(lang: str, n: int, seed: int) -> str:
    rng = random.Random(f"{lang}{n}{seed}")
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", str(seed)]) for _ in range(n))


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang): nulls, empty and very long texts, copies, near copies, repeated rows."""
    base = text_of("en", 80, 1)
    near = base.split()
    near[40] = "CHANGED"
    rows = [(1, base, "en"), (2, base.upper(), "en"), (3, " ".join(near), "en"), (4, None, "en"), (5, "", "de"), (6, " \n\t ", None),
            (None, base, "en"), (None, text_of("de", 30, 9), "de"), (7, text_of("de", 50, 2), "de"), (7, text_of("de", 50, 2), "de"),
            (8, text_of("fr", 20_000, 3), "fr"), (9, "word", "en"), (10, "word", "en"), (11, "12 34 | 56", "fr"), (12, "été\n" * 400, "fr"),
            (13, "a shared line of text\nown thirteen\n\n A SHARED line of text \n", "en"), (14, "x\na shared line of text\t\nshort\nshort", "en"),
            (15, "İstanbul ﬁ ① \U0001F600 　 end\x00 ▁mark", None)]
    rows += [(100 + i, text_of(lang, 40 + i, i), lang) for i in range(30) for lang in [list(WORDS)[i % 3]]]
    return rows
