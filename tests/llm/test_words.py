import random

from sheetdoc.llm import words


def test_hashes_follow_words(monkeypatch):
    r = random.Random(1)
    monkeypatch.setattr(words, "PIECE", 64)
    words._usual_powers.cache_clear()
    parts = [" ", "  ", "\n", "\t", "a", "B", "b", "ab", "AB", "é", "É", "\u2003", "\xa0", "long" * 40, "", "x\x1cy"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(200)] + ["", " ", "w" * 1000]
    hashes, sizes = words.word_hashes([t.encode() for t in texts])
    words._usual_powers.cache_clear()
    of, at = {}, 0
    for t, n in zip(texts, sizes.tolist(), strict=True):
        own = t.encode().lower().split()
        assert len(own) == n
        for w, h in zip(own, hashes[at : at + n].tolist(), strict=True):
            assert of.setdefault(w, h) == h
        at += n
    assert at == len(hashes) and len(set(of.values())) == len(of)
    assert [x.tolist() for x in words.word_hashes([])] == [[], []]
