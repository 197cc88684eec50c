import numpy as np

from sheetdoc.llm import packed as K


def test_rows_come_back_from_their_buckets(spark, monkeypatch):
    monkeypatch.setattr(K, "TOGETHER", 50)
    r = np.random.default_rng(5)
    kind = K.Packed(16, key="i8", id="i8", pos="i4", step="i1")
    cols = {"key": r.integers(-(1 << 63), 1 << 63, 3000), "id": r.integers(0, 1 << 62, 3000), "pos": r.integers(-9, 1 << 31, 3000).astype(np.int32), "step": r.integers(-128, 128, 3000).astype(np.int8)}
    cols["key"][::3] = 7  # a key with many rows
    frames = list(kind.packed(iter([{c: x[:1700] for c, x in cols.items()}, {c: x[1700:] for c, x in cols.items()}]), "key"))
    assert len(frames) == 1 and frames[0]["n"].max() == 50
    rows = spark.createDataFrame(frames[0], K.Packed.schema)
    seen = kind.dealt(rows, lambda buckets: (K.pd.DataFrame(c).assign(of=n) for n, c in enumerate(buckets)), "key long, id long, pos int, step byte, of int").toPandas()
    assert sorted(seen[["key", "id", "pos", "step"]].itertuples(index=False, name=None)) == sorted(zip(*(x.tolist() for x in cols.values()), strict=True))
    assert (kind.bucket(seen["key"].to_numpy()) < 16).all() and len(set(kind.bucket(seen["key"][seen["key"] == 7].to_numpy()))) == 1


def test_no_rows(spark):
    kind = K.Packed(4, key="i8")
    assert list(kind.packed(iter([]), "key")) == []
    assert list(kind.buckets(iter([]))) == []


def test_a_filter_has_the_places_of_its_keys_alone(spark):
    from sheetdoc.llm.keyset import SHIFTS, KeySet, tester

    keys = np.random.default_rng(8).integers(-(1 << 63), 1 << 63, 9000)
    shared = KeySet(spark.createDataFrame(K.pd.DataFrame({"finger": keys})).repartition(3))
    table = shared.bits.value
    places = {int(k) >> n & 64 * len(table) - 1 for k in keys.view(np.uint64) for n in SHIFTS}
    assert {int(w) * 64 + b for w in np.flatnonzero(table) for b in range(64) if int(table[w]) >> b & 1} == places
    test = tester(shared.bits)
    other = np.random.default_rng(9).integers(-(1 << 63), 1 << 63, 9000)
    assert test(keys.view(np.uint64)).all()
    want = [all(int(k) >> n & 64 * len(table) - 1 in places for n in SHIFTS) for k in other.view(np.uint64)]
    assert test(other.view(np.uint64)).tolist() == want
    assert len(test(np.empty(0, np.uint64))) == 0
    assert not tester(KeySet(spark.createDataFrame([], "finger long")).bits)(other.view(np.uint64)).any()
