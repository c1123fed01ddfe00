"""A small corpus with copies, near copies, shared passages, odd rows and clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, live string, row string, h long, key string"


def corpus(seed: int = 11, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(("ta", "ri", "mo", "né", "ka", "ul", "es")) for _ in range(rng.randint(1, 4)))
    prose = lambda k: "\n".join(" ".join(word() for _ in range(rng.randint(5, 14))) for _ in range(max(1, k // 10)))
    passage, line = " ".join(word() for _ in range(70)), "License notice of these texts, all rights kept"
    texts: list[str | None] = []
    for i in range(n):
        t = prose(rng.choice((20, 60, 120, 300)))
        if i % 7 == 3:
            t = f"{t}\n{passage}\n{prose(20)}"
        if i % 5 == 1:
            t = f"{line}\n{t}\n  {line.upper()}\t"
        if i % 9 == 4 and i > 10:
            words = texts[i - 8].split(" ") if texts[i - 8] else ["x"]
            words[rng.randrange(len(words))] = "changed"
            t = " ".join(words)
        if i % 11 == 6:
            t = texts[i - 5]
        texts.append(t)
    texts += ["", None, " \t\n ", "one", "a b c d", "hum " * 400, "abc" * 500, "x" * 5000, "é\U0001f600 ü\n\n\nz", passage]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [rows[3], rows[3], (3, texts[5]), (None, texts[7]), (None, None), (None, "only null ids hold this text " * 12)]
    return [(d, t, "en", "src0", len(t or ""), "x", "y", "z", 1, "k") for d, t in rows]
