import public_tokenizers
from llm_rows import ODD, frame

from sheetdoc.llm import token_counts

FILE = public_tokenizers.path("word_bpe_49k.json")


def test_counts_are_the_library_s(spark, documents):
    from tokenizers import Tokenizer

    odd = ["<|endoftext|> a<|startoftext|>b", "Straße ΑΣ İ ﬁ e\u0301", "a\u00a0b\u2003c\x1cd\x85e", "x" * 5000, "don't I'll 12345", "日本語 text"]
    rows = documents + [(2000 + i, t) for i, t in enumerate(odd)] + ODD
    got = token_counts.count_tokens(frame(spark, rows), FILE).collect()
    tokenizer = Tokenizer.from_file(FILE)
    assert len(got) == len(rows) and got[0].asDict().keys() >= {"n", "x", "set", "key"}
    for r in got:
        assert r.n_tokens == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids), r.doc_id


def test_empty_table(spark):
    assert token_counts.count_tokens(frame(spark, []), FILE).collect() == []


def test_a_full_cache_keeps_its_newer_half_and_counts_stay(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    monkeypatch.setattr(token_counts, "CACHE_ROWS", 40)
    monkeypatch.setattr(token_counts, "CALL", 7)
    lengths = token_counts._Lengths(path, {b"frequent": 1})
    runs = [f"w{i}-é<|endoftext|>{'x' * (i % 9)}".encode() for i in range(60)] + [b"a\x1cb", "\u3000".encode(), b"<unk>", "\u200b".encode()]
    lengths.learn(set(runs))
    lengths.learn(set())  # over the bound: the older half goes
    assert len(lengths) == 21 and b"frequent" in lengths
    assert [lengths[r] for r in runs] == [len(plain.encode(r.decode(), add_special_tokens=False).ids) for r in runs]
    assert lengths.encode([]) == []
