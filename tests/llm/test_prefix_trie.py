import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from weekloom.llm.prefix_trie import Burst, grafted, prefix_trie, sequences, sweep
from weekloom.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.brute import words

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, seq string, head int"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def paths(rows, graft=True):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0), turn_id(r, x)[:16], (r, x)))
    own = {c: [p for *_, p in sorted(v)] for c, v in own.items()}
    if not graft:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_version(rows, graft=True):
    whole = paths(rows, graft)
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        mine = (len(held) - 1) * len(words(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += mine
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(whole[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(held), len(node), up, len(held), kids[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA).repartition(3)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def odd_rows():
    rng = random.Random(5)
    rows = [(c, t, rng.choice("ab"), f"turn {rng.choice('xyz')} of  it") for c in range(90) for t in range(rng.randrange(1, 7))]
    shared = [f"shared opening {k} with words" for k in range(25)]
    for c in range(100, 140):  # a long common opening, then different ends, some of them none
        rows += [(c, k, "user", x) for k, x in enumerate(shared)]
        rows += [(c, 30 + k, "bot", f"end {c % 7} {k}") for k in range(c % 3)]
    rows += [(c, k, "user", x) for c in range(200, 230) for k, x in enumerate(shared[:5])]  # copies
    rows += [(300, None, None, None), (300, 1, "user", ""), (301, 2, None, "late"), (301, None, "user", "null first"), (None, 1, "user", "nobody")]
    rows += [(302, 1, "user", "tie"), (302, 1, "user", "tie"), (302, 1, "bot", "other tie"), (-5, 1, "user", "é " * 30_000), (10**15, 3, "a", "b")]
    return rows


@pytest.mark.parametrize("limit", [Burst(), Burst(rows=3), Burst(rows=10, size=400)])
def test_nodes_at_every_container_size(spark, limit):
    rows = [r for r in odd_rows() if r[0] is None or r[0] >= 0]
    assert got(prefix_trie(grafted(table(spark, rows)), limit)) == plain_version(rows)


def test_without_grafts(spark):
    rows = odd_rows()
    assert got(prefix_trie(sequences(table(spark, rows)), Burst(rows=5))) == plain_version(rows, graft=False)


def test_a_sequence_of_many_conversations(spark):
    rows = [(c, 0, "user", "hello there") for c in range(20, 9000, 20)] + [(c, 0, "user", "bye") for c in range(40_000, 40_100, 20)]
    assert got(prefix_trie(sequences(table(spark, rows)), Burst(rows=1))) == plain_version(rows, graft=False)


def test_empty_tables(spark):
    assert got(prefix_trie(grafted(table(spark, [])))) == []
    assert got(prefix_trie(grafted(table(spark, [(None, 1, "user", "x")])))) == []


def test_sweep_of_one_container():
    def cell(k, n):
        return bytes([k]) * 16 + n.to_bytes(4, "big")

    rows = [(b"", 2, 9, "e0"), (cell(1, 5) + cell(2, 3), 1, 4, "e1"), (cell(1, 5) + cell(3, 1), 3, 2, "e2")]
    conv, depth, parent, n, children, leaves, saved, ends = sweep(7, rows)
    assert (conv, depth, parent) == ([2, 2, 4, 2], [7, 8, 9, 9], [None, 2, 2, 2])
    assert (n, children, leaves) == ([6, 4, 1, 3], [1, 2, 0, 0], [2, 2, 1, 1])
    assert saved == [17, 17, 0, 2] and ends[0] == "e0" and ends[2:] == ["e1", "e2"]


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_prefix_trie"](spark, SMALL)) == plain_version(rows)
