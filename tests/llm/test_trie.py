"""The conversation trie against one built by hand, with full and with scarce sketches."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from revenuelake.llm import trie

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def said(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute_trie(rows):
    """All nodes from a nested walk over every conversation's rebuilt turns."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, said(role or "", text or ""), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    nodes = collections.defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        whole = turns.get(c - c % 100, [])[:h] + turns[c][h:]
        for d in range(len(whole) + 1):
            nodes[tuple(whole[:d])].append((c, d == len(whole)))
    children = collections.defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)

    def sums(node):  # leaves and saved characters of the subtree
        waiting, leaves, saved = [node], 0, 0
        while waiting:
            at = waiting.pop()
            leaves += not children[at]
            saved += (len(nodes[at]) - 1) * (len(at[-1][1]) if at else 0)
            waiting += children[at]
        return leaves, saved

    out = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c, last in sorted(members) if last)
        parent = min(nodes[node[:-1]])[0] if node else None
        out.append((min(members)[0], len(node), parent, len(members), len(children[node]), *sums(node), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for conv in [*range(0, 60), *range(100, 130), *range(205, 215), 5_000_000_000]:
        for turn in range(rng.choice([1, 2, 2, 3, 5, 8])):
            text = rng.choice(["", "yes", "no", "péché \U0001f600", f"text {rng.randrange(6)}"])
            out.append((conv, turn, rng.choice(["user", "assistant"]) if conv % 3 else "user", text))
    out += [(300 + k, 0, "user", "same") for k in range(40)]  # copies
    out += [(17, None, "user", "first"), (17, None, None, None), (18, 0, "user", None), (18, 0, "user", None), (None, 1, "user", "lost")]
    out += [(104, t, "user", f"long {t}") for t in range(8, 400)] + [(105, t, "user", f"long {t}") for t in range(8, 400)]
    return out


@pytest.mark.parametrize("cells", [trie.MAX_CELLS, 8])
def test_nodes_equal_those_of_a_walk(spark, rows, cells):
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    clashing = turns.select("*", *[F.lit("x").alias(n) for n in ("n", "h", "a", "b", "depth", "place", "said", "chars", "alone", "_block", "_number")])
    assert found(trie.conversation_trie(clashing, cells)) == brute_trie(rows)


def test_blocks_do_not_change_running_totals(spark):
    rng = random.Random(5)
    data = [(c, d, rng.getrandbits(62), rng.randrange(9)) for c in range(3) for d in range(50)]
    df = spark.createDataFrame(data, "c long, d long, x long, y long")
    totals = {"a": ("bit_xor", "x"), "s": ("sum", "y")}
    for descending in (False, True):
        want = sorted(map(tuple, trie.running(df, "c", "d", totals, descending).collect()))
        assert sorted(map(tuple, trie.running(df, "c", "d", totals, descending, block=7).collect())) == want


def test_sketch_never_takes_a_shared_prefix_for_single(spark):
    rng = np.random.default_rng(4)
    digests = rng.integers(-(2**62), 2**62, (400, 2))
    digests = np.concatenate([digests, digests[:150]])
    df = spark.createDataFrame([(int(a), int(b), 0, 0, 1) for a, b in digests], "a long, b long, pa long, pb long, depth long").repartition(5)
    proven = [r for r in trie.screen(df, len(digests)).collect() if r["alone"]]
    shared = {tuple(map(int, d)) for d in digests[:150]}
    assert not shared & {(r["a"], r["b"]) for r in proven}
    assert len(proven) > 200  # of 250


def test_no_conversations(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0


def test_turnless_conversation(spark):
    # 101 has no leader and borrows crc32 % 6 turns, so its first turns are gone.
    rows = [(101, 0, "user", "a")]
    assert zlib.crc32(b"101") % 6 > 0
    assert found(trie.conversation_trie(spark.createDataFrame(rows, TURNS))) == brute_trie(rows)
