"""The conversation trie against a dictionary of prefixes, with shards and segments of few rows."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL

from tidewatch.llm import conversation_trie as ct
from tidewatch.llm import queries

KIND = "conv_id long, turn long, role string, text string, key int, path string, n int, shard int"


def brute(rows):
    """Nodes by the definition: a dictionary from prefix to its members."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            token = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            convs.setdefault(c, []).append((turn is not None, turn or 0, token, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
    members, ends = {}, {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def words(p):
        return len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0

    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = (len(members[p]) - 1) * words(p) + sum(saved[k] for k in kids.get(p, []))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def run(df, **kw):
    out = ct.trie(ct.rebuilt(df), **kw)
    return sorted((r.conv, r.depth, r.parent_conv, r.n, r.children, r.leaves, r.saved, r.ends_sha256) for r in out.collect())


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], KIND).repartition(parts)


EDGES = [(1, 0, "user", "hi there"), (1, 0, "user", "hi there"), (1, None, None, "first"), (2, 3, "user", None), (2, 1, "", ""), (None, 1, "user", "nobody"),
         (-7, 1, "user", "below zero"), (-20, 1, "user", "base below zero"), (20, 5, "user", "hi there"), (20, 6, "bot", "x " * 5000), (21, None, "user", "hi there"),
         (41, 1, "user", "no base"), (42, 1, "user", "no base"), (43, 1, "user", "no base"), (44, 1, "user", "no base"), (0, None, None, None), (3, 2, "a:b", "c"), (4, 2, "a", "b:c")]


def test_edges(spark):
    assert run(frame(spark, EDGES)) == brute(EDGES)
    assert run(frame(spark, EDGES), segment=2, shard_rows=2) == brute(EDGES)


def made(seed):
    """Conversations that share heads, a third of them copies of one, some long."""
    rnd = random.Random(seed)
    rows, pool = [], []
    for c in range(240):
        if c % 3 == 0:
            turns = [("user", "hot start"), ("bot", "hot answer here"), ("user", "bye")]
        elif pool and c % 3 == 1:
            old = rnd.choice(pool)
            turns = old[:rnd.randrange(len(old) + 1)] + [("user", f"t{rnd.randrange(6)}") for _ in range(rnd.randrange(3))]
        else:
            turns = [("user" if i % 2 else "bot", f"w{rnd.randrange(3)} " * rnd.randrange(1, 4)) for i in range(rnd.choice([1, 2, 5, 17]))]
        pool.append(turns)
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("kw", [{}, {"segment": 3, "shard_rows": 7}, {"segment": 1, "shard_rows": 4}, {"segment": 5, "shard_turns": 11}])
def test_shared_heads(spark, kw):
    rows = made(len(kw))
    assert run(frame(spark, rows), **kw) == brute(rows)


def test_copies_of_a_long_conversation(spark):
    rows = [(c, i, "user", f"turn {i}") for c in (100, 200, 300) for i in range(60 if c < 300 else 40)]
    assert run(frame(spark, rows), segment=8, shard_rows=3) == brute(rows)


def test_empty(spark):
    assert run(frame(spark, EDGES).where("false")) == []


def test_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    got = queries.QUERIES["op11_conversation_trie"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == want


def test_double_array():
    rnd = np.random.default_rng(4)
    paths = sorted({tuple(rnd.integers(0, 40, rnd.integers(1, 6)).tolist()) for _ in range(3000)})
    trie, state = ct.DoubleArray(4), {(): 0}
    for d in range(1, 6):
        new = sorted({p[:d] for p in paths if len(p) >= d})
        cells = trie.place(np.array([state[p[:-1]] for p in new]), np.array([p[-1] for p in new]))
        state |= dict(zip(new, cells.tolist()))
    assert len(set(state.values())) == len(state)
    for p, s in state.items():
        codes = np.arange(40)
        got = trie.step(np.full(40, s), codes)
        assert [int(x) for x in got] == [state.get(p + (c,), -1) for c in codes.tolist()]
    assert trie.top < 3 * len(state)
