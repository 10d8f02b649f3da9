"""The conversation trie against a trie of Python dictionaries."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from formline.llm import tries

SCHEMA = "conv_id long, turn long, role string, text string, path string, words long, depth long, kind int, shard long"
WORD = re.compile("[^\x20\x09-\x0d]+")


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, 3, 4) for r in rows], SCHEMA)


def brute(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, name, (role, text)))
    turns = {c: [t[3] for t in sorted(v)] for c, v in turns.items()}
    whole, members = {}, collections.defaultdict(list)
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        whole[conv] = tuple(turns.get(conv - int(math.fmod(conv, 20)), [])[:h] + own[h:])
        for depth in range(len(whole[conv]) + 1):
            members[whole[conv][:depth]].append(conv)
    children, out, leaves, saved = collections.defaultdict(list), [], {}, {}
    for node in members:
        if node:
            children[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        own = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
        ends = ",".join(map(str, sorted(c for c in members[node] if whole[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((
            min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in tries.prefix_trie(frame).collect()), key=str)


@pytest.fixture(scope="module")
def odd_rows():
    rng, rows = random.Random(3), []
    for conv in range(-30, 400):
        if rng.random() < 0.1:  # absent heads, too
            continue
        for turn in range(rng.choice([1, 2, 3, 5, 9, 40])):
            number = rng.choice([None, turn]) if rng.random() < 0.1 else turn
            role = rng.choice(["user", "a", None]) if rng.random() < 0.2 else "user"
            rows.append((conv, number, role, rng.choice([None, "", "x y", "hello", "a b c"]) if rng.random() < 0.6 else "same"))
    rows += [(conv, turn, "user", "hot hot") for conv in range(1000, 1300) for turn in range(4)]  # equal conversations
    rows += [(2000, i % 900, "u", f"w{i % 7}") for i in range(1000)]  # a long one, with repeated turns
    rows += [(2000, 1, "u", "w1")] * 2 + [(None, 1, "u", "x"), (3000, None, None, None), (3000, None, None, None)]
    return rows


@pytest.mark.parametrize("turns, fan_in, ids, few", [(4000, 512, 1000, 200_000), (40, 4, 3, 0)])
def test_every_node_as_in_a_plain_trie(spark, odd_rows, monkeypatch, turns, fan_in, ids, few):
    """The second case has many small shards, three rounds of folding, short id chunks and parents joined by shuffle."""
    monkeypatch.setattr(tries, "LEAST_TURNS", turns)
    monkeypatch.setattr(tries, "FAN_IN", fan_in)
    monkeypatch.setattr(tries, "IDS_A_CHUNK", ids)
    monkeypatch.setattr(tries, "BROADCAST_NODES", few)
    assert found(table_of(spark, odd_rows).repartition(5)) == brute(odd_rows)


def test_given_conversations_as_in_a_plain_trie(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert found(given) == brute([tuple(r) for r in given.collect()])


def test_tables_without_nodes_and_with_a_root_alone(spark):
    assert found(table_of(spark, [])) == [] and found(table_of(spark, [(None, 1, "u", "x")])) == []
    # A conversation whose turns are all replaced by those of an absent one has none left.
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(conv, 0, "u", "x")]
    assert found(table_of(spark, rows)) == brute(rows) == [(conv, 0, None, 1, 0, 1, 0, hashlib.sha256(str(conv).encode()).hexdigest())]


def test_a_shard_is_sorted_as_its_paths(spark):
    rng = random.Random(5)
    paths = [b"".join(rng.choice([b"a" * 16, b"\xff" * 16, b"b" * 16]) for _ in range(rng.choice([0, 1, 3, 40]))) for _ in range(300)]
    lengths = tries.np.array([len(p) // 16 for p in paths])
    ids = tries.np.arange(300)[::-1].copy()
    order = tries._sorted_rows(tries._names(paths), tries.np.cumsum(lengths) - lengths, lengths, ids)
    assert order.tolist() == sorted(range(300), key=lambda i: (paths[i], ids[i]))


def test_turns_meet_in_one_exchange_of_names(spark):
    plan = tries.rebuilt(table_of(spark, [])).withColumn("n", F.size("words"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "text" not in plan.split("Exchange")[0]
