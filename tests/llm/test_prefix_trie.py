import hashlib
import random
import zlib
from collections import defaultdict

from riskloom.llm.prefix_trie import SpillingQueue, branched_trie
from riskloom.llm.queries import op12_prefix_trie
from tests.llm.helpers import SF

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(rows):
    """The trie of rebuilt conversations from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(original.get(c - c % 5, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sorted(rebuilt.items()):
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
            for node, m in members.items()
        ),
        key=repr,
    )


def found(trie):
    return sorted((tuple(r) for r in trie.select(*COLUMNS).collect()), key=repr)


def test_whole_table_equals_brute_force_in_one_and_many_shards(spark):
    conversations = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in conversations.collect()]
    want = plain(rows)
    assert found(op12_prefix_trie(spark, SF)) == want
    for shard_rows in (1, 4, 40):
        assert found(branched_trie(conversations, shard_rows)) == want


def test_shared_openings_copies_and_long_conversations(spark, frame):
    draw = random.Random(3)
    rows = []
    for c in range(120):
        depth = draw.choice([0, 1, 3, 6, 30])
        rows += [(c, t, "user" if t % 2 else "assistant", draw.choice("ab") * draw.choice([1, 2]) if draw.random() < 0.3 else "same é") for t in range(depth)]
    rows += [(500 + i, t, "user", f"copy {t}") for i in range(0, 50, 5) for t in range(12)]
    conversations = frame(rows, "conv_id long, turn long, role string, text string")
    want = plain(rows)
    for shard_rows in (3, 60, 100_000):
        assert found(branched_trie(conversations, shard_rows)) == want


def test_odd_rows(frame):
    rows = [
        (0, None, "user", "null turn first"), (0, 0, None, None), (0, 0, "user", "tie b"), (0, 0, "user", "tie a"), (0, 1, "user", "x" * 100_000),
        (0, 1, "user", "x" * 100_000), (7, 5, "user", "only own"), (8, 0, "", ""), (None, 0, "user", "lost"), (3, 0, "a", "bc"), (4, 0, "ab", "c"),
        (9, None, None, None),
    ]
    schema = "conv_id long, turn long, role string, text string"
    odd = frame(rows, schema).selectExpr("*", "'x' AS node", "1 AS depth", "2 AS pos", "3 AS bytes")
    assert found(branched_trie(odd)) == plain(rows)
    assert branched_trie(odd.where("false")).count() == 0
    assert found(branched_trie(frame([(11, 0, "u", "t")], schema))) == plain([(11, 0, "u", "t")])


def test_queue_spills_and_keeps_its_order():
    draw = random.Random(1)
    for limit in (3, 50, 10_000):
        queue, want = SpillingQueue(limit), defaultdict(lambda: [0, 0])
        for level in range(5):
            for _ in range(400):
                key = (-5 + level + 1, bytes([draw.randrange(60)]))
                one = draw.randrange(100)
                queue.push((key, one, 1))
                want[key][0] += one
                want[key][1] += 1
            for name in range(60):
                key = (-5 + level + 1, bytes([name]))
                assert queue.take(key) == tuple(want[key])
        assert not queue.heap and not queue.runs
