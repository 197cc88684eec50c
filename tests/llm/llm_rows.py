"""Small documents for the tests of the operators."""

import random


def corpus(seed=1, families=6, members=5, alone=12, words=90):
    """Documents (id, text): families of near copies, exact copies, shared passages, odd texts."""
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "lo mi ka te ru sa".split() for b in "nu pa ri do el os im".split()]
    passage = [r.choice(vocabulary) for _ in range(60)]
    out = []
    for _ in range(families):
        base = [r.choice(vocabulary) for _ in range(words)]
        for m in range(members):
            text = list(base)
            for _ in range(r.choice([0, 1, 2, 4, 9])):
                text[r.randrange(len(text))] = r.choice(vocabulary) + "x"
            out.append(" ".join(text))
            if m == 0:
                out.append(" ".join(base).upper())
    for i in range(alone):
        text = [r.choice(vocabulary) + str(i) for _ in range(r.randrange(3, 120))]
        if i % 2:
            at = r.randrange(len(text))
            text[at:at] = passage
        out.append("  ".join(text))
    out += [out[0], out[0], "", " \t\n", "one", "one two", "one two", "é ß " * 40, "lorem " * 3000]
    r.shuffle(out)
    return [(i, t) for i, t in enumerate(out)] + [(900, None)]


ODD = [  # null id, null text, empty text, repeated rows
    (None, "null id text with some words in it"), (None, None), (7001, None), (7001, None), (7002, ""),
    (7003, "the same row twice here"), (7003, "the same row twice here"),
]


def frame(spark, rows):
    """Rows (id, text) as a frame with extra columns whose names operators use themselves."""
    full = [(i, t, "n", i, t, "k") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, n string, x long, set string, key string")
