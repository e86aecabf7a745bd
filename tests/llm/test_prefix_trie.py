"""The radix tree, and the trie of conversations against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ticketry.llm import prefix_trie as P
from ticketry.llm.prefix_trie import prefix_trie, sequences, with_openings
from ticketry.llm.radix import Direct, Indexed, RadixTree, Sorted, common

SCHEMA = "conv_id long, turn long, role string, text string, key string, ids string, n int, mark int, part int"
COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def turns(spark, rows):
    """(conv_id, turn, role, text) rows, with further columns under names that the operator uses."""
    return spark.createDataFrame([(*r, "x", "x", 1, 1, 1) for r in rows], SCHEMA).repartition(4)


def rebuilt(rows, every=100, most=5):
    """conv_id -> list of (role, text), by the rule of the query; rows in their order."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + mine[h:]
    return out


def brute(conversations):
    """The columns of the trie for conv_id -> turns."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in conversations.items():
        seq = tuple(seq)
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
    return [
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]),
            leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    ]


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def hard_rows():
    chance = random.Random(8)
    say = lambda: (chance.choice(("user", "assistant", "", None)), chance.choice(("a", "bé", "", None, "𝄞 long")))
    rows = []
    for c in chance.sample(range(-150, 700), 300):
        n = chance.choice((1, 1, 2, 3, 4, 6, 9))
        numbers = chance.sample(range(30), n)
        if chance.random() < 0.3:
            numbers[0] = None
        rows += [(c, t, *say()) for t in numbers]
    same = [(i, "user", f"turn {i}") for i in range(8)]
    rows += [(c, *t) for c in range(1000, 1400) for t in same]  # copies, a third of all
    rows += [(None, 1, "user", "lost"), (None, None, None, None)]
    # The role ends where the text begins.
    rows += [(2000, 0, "ab", "c"), (2001, 0, "a", "bc"), (2100, 0, "1:a", "b"), (2101, 0, "1", ":ab")]
    rows += [(3000, i, "user", str(i)) for i in range(3000)]
    rows += [(3001, i, "user", str(i)) for i in range(2990)]  # a beginning of the one before
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [1, 3, 4096])
def test_trie_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(P, "RUN_KEYS", limit)
    rows = hard_rows()
    trie = prefix_trie(with_openings(sequences(turns(spark, rows)), 100, 5))
    assert trie.columns == list(COLUMNS)
    assert found(trie) == sorted(brute(rebuilt(rows)), key=repr)


def test_runs_end_by_bytes_too(spark, monkeypatch):
    monkeypatch.setattr(P, "RUN_BYTES", 100)
    rows = [(c, t, "user", str(c % (t + 1))) for c in range(60) for t in range(6)]
    wanted = {c: [("user", str(c % (t + 1))) for t in range(6)] for c in range(60)}
    assert found(prefix_trie(sequences(turns(spark, rows)))) == sorted(brute(wanted), key=repr)


def test_ends_of_a_hot_conversation_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE_BITS", 2)
    ids = [-9, -1, 0, 3, 4, 5, 100, 1000, 12345678901]
    rows = [(c, 0, "user", "same") for c in ids]
    top = {r.depth: r for r in prefix_trie(sequences(turns(spark, rows))).collect()}
    assert top[1].ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert top[0].ends_sha256 == hashlib.sha256(b"").hexdigest()
    assert (top[0].conv_id, top[0].n_convs, top[1].saved_tokens) == (-9, 9, 32)


def test_turnless_conversations_are_members_of_the_root(spark):
    table = spark.createDataFrame([(1, []), (2, [])], "conv_id long, ids array<string>")
    (root,) = prefix_trie(table).collect()
    assert tuple(root) == (1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,2").hexdigest())


def test_turns_of_one_number_stand_in_a_fixed_order(spark):
    rows = [(1, 5, "user", t) for t in "abcdef"]
    orders = {tuple(sequences(turns(spark, chosen)).first().ids) for chosen in (rows, rows[::-1])}
    assert len(orders) == 1 and len(next(iter(orders))) == 6


def test_empty_table(spark):
    assert prefix_trie(with_openings(sequences(turns(spark, [])), 100, 5)).count() == 0
    assert prefix_trie(sequences(turns(spark, [(None, 1, "user", "x")]))).count() == 0


def test_radix_tree_keeps_every_key():
    chance = random.Random(3)
    for _ in range(200):
        tree, kept = RadixTree(), {}
        for i in range(chance.randint(1, 400)):
            key = bytes(
                chance.choice(b"abcd") if chance.random() < 0.7 else chance.randrange(256)
                for _ in range(chance.randint(0, 9))
            )
            tree.insert(key, i + 1)
            kept[key] = i + 1
        assert all(tree.get(k) == v for k, v in kept.items())
        assert all(tree.get(k + b"?") == kept.get(k + b"?") for k in kept)


def test_layouts_grow_with_their_children():
    kinds = []
    tree = RadixTree()
    for label in range(256):
        tree.insert(bytes((label * 7 % 256,)) + b"rest", label + 1)
        layout = tree.root.children
        kinds.append((type(layout), getattr(layout, "room", None)))
        labels = [x for x, _ in tree.root.items()]
        assert labels == sorted(labels) and len(labels) == label + 1
    assert kinds[3] == (Sorted, 4) and kinds[4] == kinds[15] == (Sorted, 16)
    assert kinds[16][0] is kinds[47][0] is Indexed and kinds[48][0] is kinds[255][0] is Direct


def test_common_bytes():
    chance = random.Random(1)
    for _ in range(500):
        a = bytes(chance.choice(b"ab") for _ in range(chance.randint(0, 300)))
        b = a[: chance.randint(0, len(a))] + bytes(chance.choice(b"ab") for _ in range(chance.randint(0, 9)))
        wanted = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common(a, b) == wanted
