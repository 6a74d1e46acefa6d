"""The conversation trie against a plain version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallybook.llm import prefix_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tie_order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    framed = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
    return turn is not None, turn or 0, role.encode(), framed


def plain_trie(seqs):
    """Node rows of conversations given as {conv_id: [(role, text), ...]}."""
    nodes = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        mine = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in mine) if mine else 1
        own = (len(nodes[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own + sum(saved[p] for p in mine)
    out = []
    for path, members in nodes.items():
        ends = sorted(c for c in members if len(seqs[c]) == len(path))
        out.append(
            (min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
             len(children.get(path, [])), leaves[path], saved[path], sha(",".join(map(str, ends))))
        )
    return sorted(out, key=str)


def rebuilt(rows):
    by_conv = {}
    for row in rows:
        if row[0] is not None:
            by_conv.setdefault(row[0], []).append(row)
    own = {
        c: [(r[2] or "", r[3] or "") for r in sorted(rs, key=tie_order)] for c, rs in by_conv.items()
    }
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + seq[h:]
    return out


COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def as_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def conversations(n, seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        if rnd.random() < 0.1:
            continue  # some groups lack their first conversation
        for turn in range(rnd.choice([1, 2, 3, 8, 20])):
            text = rnd.choice(["yes", "no", "é ü 日本", "", None, f"only {c} {turn}"])
            rows.append((c, turn, rnd.choice(["user", "assistant", None]), text))
    return rows


def test_against_plain_version(frame):
    rows = conversations(120, 3)
    rows += [(7, None, "user", "first"), (7, 1, "user", "tie"), (7, 1, "user", "tie"),
             (7, 1, "system", "tie"), (None, 0, "user", "lost"), (-3, 0, "user", "x")]
    assert as_rows(trie.conversation_trie(frame(rows, SCHEMA))) == plain_trie(rebuilt(rows))


def test_very_common_conversation(frame):
    same = [("user", "hello"), ("assistant", "hello to you"), ("user", "bye")]
    rows = [(c, i, *t) for c in range(400) for i, t in enumerate(same)]
    rows += conversations(40, 5)[:0] + [(1000 + c, 0, "user", "hello") for c in range(50)]
    assert as_rows(trie.conversation_trie(frame(rows, SCHEMA))) == plain_trie(rebuilt(rows))


@pytest.mark.parametrize(("stride", "container_turns"), [(1, 1), (2, 4), (4, 64), (16, 1 << 16)])
def test_strides_and_bursts_change_nothing(spark, frame, stride, container_turns):
    rnd = random.Random(11)
    seqs = {}
    for c in range(150):
        n = rnd.choice([0, 1, 2, 5, 9, 14])
        seqs[c] = [("u", "common")] * min(n, 6) + [("u", rnd.choice("ab")) for _ in range(n - 6)]
    rows = [(c, i, t) for c, seq in seqs.items() for i, (_, t) in enumerate(seq)]
    turns = frame(rows, "conv_id bigint, pos bigint, text string").select(
        "conv_id", "pos", F.unhex(F.md5("text")).alias("digest"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
    )
    convs = frame([(c, len(s)) for c, s in seqs.items()], "conv_id bigint, n_turns bigint")
    nodes, ends = trie.prefix_trie(turns, convs, stride, container_turns)
    got = nodes.join(trie.ends_digests(ends), ["conv_id", "depth"], "left").fillna(
        sha(""), ["ends_sha256"]
    )
    assert as_rows(got) == plain_trie(seqs)


def test_empty_table_and_only_rows_without_id(frame):
    assert trie.conversation_trie(frame([], SCHEMA)).count() == 0
    assert trie.conversation_trie(frame([(None, 0, "user", "x")], SCHEMA)).count() == 0


def test_clashing_columns_and_long_text(frame):
    rows = [*conversations(30, 8), (200, 0, "user", "long " * 200_000)]
    df = frame(rows, SCHEMA)
    extra = df.withColumns({c: F.lit(f"own {c}") for c in ("pos", "digest", "head", "rep", "depth")})
    assert as_rows(trie.conversation_trie(extra)) == plain_trie(rebuilt(rows))


def test_turns_of_one_conversation_over_many_partitions(spark):
    rows = [(c, t, "user", f"{t % 7}") for c in (1, 2) for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = trie.ordered_turns(df).groupBy("conv_id").agg(
        F.count("*").alias("n"), F.countDistinct("pos").alias("d"), F.max("pos").alias("m")
    )
    assert sorted(map(tuple, got.collect())) == [(1, 3000, 3000, 2999), (2, 3000, 3000, 2999)]
