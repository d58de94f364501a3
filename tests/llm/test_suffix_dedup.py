import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import weekloom.llm.suffix_dedup as module
from weekloom.llm.queries import QUERIES
from weekloom.llm.suffix_dedup import common_prefixes, contexts_of, gram_sizes, repeated_windows, suffix_array, without_repeats
from tests.conftest import SMALL


def plain_version(rows, length):
    raw = [(d, (t or "").encode()) for d, t in rows]
    held = Counter(t[i : i + length] for _, t in raw for i in range(len(t) - length + 1))
    out = []
    for d, t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if held[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        out.append((d, len(t), int(gone.sum()), runs, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], "doc_id bigint, text string, rid string, n_bytes int, spans string").repartition(3)


def got(df):
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in df.collect()), key=repr)


def random_rows(seed=3):
    rng = random.Random(seed)

    def prose(n):
        return " ".join(rng.choice(["red", "green", "blué", "sky", "of", "the", "naïve", "tree", "\n"]) + str(rng.randrange(300)) for _ in range(n))

    shared = [prose(40) for _ in range(6)]
    rows = []
    for k in range(120):
        parts = [prose(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 3)):
            a = rng.randrange(0, 60)
            parts += [rng.choice(shared)[a : a + rng.randrange(20, 200)], prose(rng.randrange(0, 9))]
        rows.append((k, "".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (3, rows[3][1]), (502, None), (503, ""), (None, rows[5][1]), (504, "a" * 300), (505, "ab" * 200)]
    rows += [(506, "\x00" * 100 + "x" + "\x00" * 90), (507, "short"), (508, "z" + "q" * 49 + "z"), (509, prose(12_000))]
    return rows


def test_suffix_order():
    rng = random.Random(1)
    for alphabet in ("ab", "abcdé\x00", "a"):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))).encode() for _ in range(25)]
        data = b"\0".join(texts) + b"\0"
        symbols = np.frombuffer(data, np.uint8).astype(np.int16) + 1
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        symbols[ends] = 0
        place = [(i, k) for k, t in enumerate(texts) for i in range(len(t))]
        at = {(i, k): int(ends[k]) - len(texts[k]) + i for i, k in place}
        want = [at[p] for p in sorted(place, key=lambda p: (texts[p[1]][p[0] :], at[p]))]
        assert suffix_array(symbols, 1000).tolist() == want


def test_common_prefixes():
    data = np.frombuffer(b"abcdefghijkl-abcdefghijXX-abc", np.uint8)
    assert common_prefixes(data, np.array([0, 13, 13, 1]), np.array([13, 0, 26, 14]), 16).tolist() == [10, 10, 3, 9]
    assert common_prefixes(data, np.array([0]), np.array([13]), 7).tolist() == [7]


def test_windows_of_a_shard():
    marks = repeated_windows([b"abcabcabc", b"xabcax", b"zz"], [1, 1, 2], 4)
    assert [m.astype(int).tolist() for m in marks] == [[1] * 6, [0, 1, 0], []]
    assert repeated_windows([b"once"], [2], 4)[0].tolist() == [True]


def test_equal_windows_have_equal_anchors():
    data = np.frombuffer(b"0123456789 the passage stands twice; and again the passage stands twice! aaaaaaaaaaaaaaaaaaaa", np.uint8)
    length, seen = 16, {}
    for gram in (2, 5, 16):
        doc, lo, hi, anchor = contexts_of(data, np.array([0, len(data)]), length, gram)
        assert lo[0] == 0 and hi[-1] == len(data) - length + 1 and (lo[1:] == hi[:-1]).all()
        for a, b, h in zip(lo, hi, anchor):
            for s in range(a, b):
                assert seen.setdefault((gram, data[s : s + length].tobytes()), h) == h
    assert gram_sizes(400) == [32, 128, 256, 336, 376, 392, 400] and gram_sizes(3)[-1] == 3


@pytest.mark.parametrize("length,hot", [(40, module.HOT_BYTES), (25, 400), (60, 1)])
def test_against_brute_force(spark, length, hot):
    rows = random_rows()
    assert got(without_repeats(table(spark, rows), length=length, hot_bytes=hot)) == plain_version(rows, length)


def test_long_texts_by_pieces(spark, monkeypatch):
    rows = random_rows(7)[100:]
    monkeypatch.setattr(module, "PIECE", 64)
    monkeypatch.setattr(module.ragged, "SLICE_BYTES", 100)
    doc = np.frombuffer(rows[-1][1].encode(), np.uint8)
    whole = contexts_of(doc, np.array([0, len(doc)]), 40, 3)
    assert len(whole[0]) > 100
    assert got(without_repeats(table(spark, rows), length=40)) == plain_version(rows, 40)


def test_a_common_line_in_many_surroundings(spark):
    rng = random.Random(2)
    line = "this very line stands in all of the documents here"

    def some(n):
        return "".join(rng.choice("abcdefghijlmnopqrstuvwxyz ") for _ in range(n))

    rows = [(k, some(60) + line + some(60)) for k in range(400)] + [(1000 + k, some(50) + "kk" + line + "kk" + some(50)) for k in range(60)]
    want = plain_version(rows, len(line) + 4)
    assert any(r[2] for r in want) and not all(r[2] for r in want)
    assert got(without_repeats(table(spark, rows), length=len(line) + 4, hot_bytes=2000)) == want


def test_empty_table(spark):
    assert got(without_repeats(table(spark, []))) == []


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: (*r[1:4], hashlib.sha256(r[4]).hexdigest()) for r in plain_version(rows, 400)}
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op11_suffix_dedup"](spark, SMALL).collect()} == want
    assert sum(v[1] for v in want.values()) > 0
