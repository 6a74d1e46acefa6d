"""Prefix trie of conversations, built as a burst trie.

A turn is known by a digest of its role and text. The trie is built in strides of turns. At the start of
a stride every trie head holds a container: the suffixes of the conversations that pass through it. An
oversized container bursts by the next turn id, again and again, into smaller ones; what is left is small,
is gathered in one task by container, sorted, and swept into nodes. Conversations that share a stride to its
end with another one go on to the next, longer stride. The rest of a conversation that no other one shares is a
plain chain; it is never gathered, its nodes are one projection of its turns.

Building leaves one row per conversation and depth at which it shares a node, with the node's smallest
member. A node's figures are sums over those rows: each conversation answers for the nodes whose
smallest member it is, below the row's depth. So nothing is added up level by level.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.scratch import keep, map_batches

STRIDE, LONGEST_STRIDE = 16, 4096  # turns of the first stride; each next one is twice as long
CONTAINER_TURNS = 1 << 12  # turns that a container may hold
HEAD_TURNS, GROUP = 8, 5  # splice(): turns a group of conversations can share, and its size
BLOCK_BITS = 12  # ids that are joined into one text before digests: 2 ** 12 in a row

_LAID = "conv_id bigint, digest binary, n_bytes bigint, part int, local bigint"
_STEP = "conv_id bigint, n_turns bigint, depth bigint, n_bytes bigint, key binary"
_MEMBER = (
    "conv_id bigint, n_turns bigint, depth bigint, rep bigint, n bigint, longest bigint, n_bytes bigint"
)
_MEMBER_COLUMNS = [f.split()[0] for f in _MEMBER.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        [name for name, _ in fields],
    )


def _local_places(batches):
    """Place of each row among its conversation's rows of this partition; rows arrive sorted."""
    part = TaskContext.get().partitionId()
    last, count = None, 0
    for batch in batches:
        local = []
        for conv in batch.column("conv_id").to_pylist():
            count = count + 1 if conv == last else 0
            last = conv
            local.append(count)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv_id", "digest", "n_bytes")),
                pa.array([part] * batch.num_rows, pa.int32()),
                pa.array(local, pa.int64()),
            ],
            ["conv_id", "digest", "n_bytes", "part", "local"],
        )


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Turns as (conv_id, pos, digest, n_bytes), pos from 0 by turn.

    Rows are sorted over ranges, so that the turns of one conversation may span partitions; only the
    first conversation of a partition can continue an earlier one, and those few offsets go through the
    driver, one per partition.
    """
    role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")
    )
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.unhex(F.substring(F.sha2(framed, 256), 1, 32)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    laid = keep(
        map_batches(
            rows.repartitionByRange(*order).sortWithinPartitions(*order), _local_places, _LAID
        ),
        "turns",
    )
    ends = laid.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "local")).alias("last")
    )
    carried, open_conv, so_far = [], None, 0
    for r in sorted(ends.collect(), key=lambda r: r["part"]):
        carry = so_far if r["first"] == open_conv else 0
        if carry:
            carried.append((r["part"], r["first"], carry))
        open_conv = r["last"]["conv_id"]
        so_far = r["last"]["local"] + 1 + (carry if open_conv == r["first"] else 0)
    table = laid.sparkSession.createDataFrame(carried, "part int, conv_id bigint, carry bigint")
    return laid.join(F.broadcast(table), ["part", "conv_id"], "left").select(  # a row per partition
        "conv_id", (F.col("local") + F.coalesce("carry", F.lit(0))).alias("pos"), "digest", "n_bytes"
    )


def splice(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations so that those of a group share their first turns.

    Conversation c gets the first h turns of the group's first one, c - c % 5, and then its own turns
    after its first h; h is the CRC-32 of its decimal id modulo 9. Returns turns and conversations
    (conv_id, n_turns), those without turns included. Only up to eight turns of a group's first
    conversation are gathered.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9)).cast("int")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))
    heads = (
        turns.where((F.col("pos") < HEAD_TURNS) & (F.col("conv_id") == base))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "n_bytes"))).alias("head"))
    )
    plan = keep(
        turns.where("pos = 0")
        .select("conv_id", h.alias("h"), base.alias("base"))
        .join(heads, "base", "left")
        .withColumn("head", F.when(F.col("head").isNotNull(), F.expr("slice(head, 1, h)")))
        .select(
            "conv_id",
            "head",
            (F.col("h") - F.coalesce(F.size("head"), F.lit(0))).alias("back"),
        ),
        "plan",
    )
    shared = plan.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    back = plan.where("back > 0").select("conv_id", "back")
    own = (
        turns.where(F.col("pos") >= h)
        .join(back, "conv_id", "left")
        .withColumn("pos", F.col("pos") - F.coalesce("back", F.lit(0)))
        .select(shared.columns)
    )
    rebuilt = keep(shared.unionByName(own), "rebuilt")
    counts = rebuilt.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    convs = plan.select("conv_id").join(counts, "conv_id", "left")
    return rebuilt, keep(convs.fillna(0, ["n_turns"]), "convs")


def _steps(batches):
    """For each turn of a stride, the id of the trie path from the head to it."""
    for batch in batches:
        rows: list[tuple] = []
        for conv, n_turns, depth, head, turns in zip(
            *(batch.column(c).to_pylist() for c in ("conv_id", "n_turns", "depth", "head", "next")),
            strict=True,
        ):
            key = str(head).encode()
            for i, t in enumerate(turns):
                key = hashlib.sha256(key + t["digest"]).digest()[:16]
                rows.append((conv, n_turns, depth + i + 1, t["n_bytes"], key))
        yield _batch(rows, _STEP)


def sweep(container: list[tuple[int, int, int, list[bytes], list[int]]]) -> list[tuple]:
    """Nodes that conversations of one container share, a row per member.

    A suffix is (conv_id, n_turns, depth, digests, sizes), beginning after ``depth`` turns. They are
    sorted, so the members of a node stand side by side.
    """
    rows: list[tuple] = []
    order = sorted(container, key=lambda s: s[3])
    ranges = [(0, len(order), 0)]
    while ranges:
        low, high, level = ranges.pop()
        while low < high and len(order[low][3]) == level:  # these end above
            low += 1
        while low < high:
            digest, stop = order[low][3][level], low + 1
            while stop < high and order[stop][3][level] == digest:
                stop += 1
            if stop - low > 1:
                members = order[low:stop]
                rep, longest = min(s[0] for s in members), max(s[1] for s in members)
                rows += [
                    (s[0], s[1], s[2] + level + 1, rep, stop - low, longest, s[4][level])
                    for s in members
                ]
                ranges.append((low, stop, level + 1))
            low = stop
    return rows


def _sweep_batches(batches):
    name, group, out = None, [], []
    for batch in batches:
        for container, conv, n_turns, depth, digests, sizes in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            if container != name:
                if len(group) > 1:
                    out += sweep(group)
                name, group = container, []
                if len(out) > 10_000:
                    yield _batch(out, _MEMBER)
                    out = []
            group.append((conv, n_turns, depth, digests, sizes))
    if len(group) > 1:
        out += sweep(group)
    yield _batch(out, _MEMBER)


def _stride(turns: DataFrame, active: DataFrame, depth: int, length: int, limit: int) -> DataFrame:
    """Member rows of the shared nodes at depths ``depth + 1`` to ``depth + length``."""
    ahead = turns.where(F.col("pos").between(depth, depth + length - 1))
    if depth:
        ahead = ahead.join(active.select("conv_id"), "conv_id", "left_semi")
    ahead = ahead.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "n_bytes"))).alias("next")
    )
    rows = keep(
        active.join(ahead, "conv_id").withColumn("depth", F.lit(depth).cast("bigint")), "stride"
    )
    big = rows.groupBy("head").agg(F.count("*").alias("size")).where(F.col("size") > limit)
    bursting = rows.join(big.select("head"), "head", "left_semi")
    steps = keep(map_batches(bursting, _steps, _STEP), "steps")
    oversized = (
        steps.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min("conv_id").alias("rep"),
            F.max("n_turns").alias("longest"),
        )
        .where(F.col("n") > limit)
    )
    burst = keep(steps.join(oversized, "key").select(*_MEMBER_COLUMNS), "burst")
    # The next turn after the last oversized node names the container; heads that did not burst
    # are containers themselves.
    passed = burst.groupBy("conv_id").agg(F.count("*").cast("int").alias("passed"))
    names = big.select("head", F.lit(True).alias("is_big"))
    placed = (
        rows.join(names, "head", "left")
        .join(passed, "conv_id", "left")
        .fillna(0, ["passed"])
        .withColumn("led", F.when(F.col("is_big"), F.col("passed") + 1).otherwise(0))
        .where(F.col("passed") < F.size("next"))
        .select(
            F.md5(
                F.concat_ws(
                    ",",
                    F.col("head").cast("string"),
                    F.transform(F.expr("slice(next, 1, led)"), lambda t: F.hex(t["digest"])),
                ).cast("binary")
            ).alias("container"),
            "conv_id",
            "n_turns",
            (F.col("depth") + F.col("passed")).alias("depth"),
            F.expr("slice(next, passed + 1, size(next)).digest").alias("digests"),
            F.expr("slice(next, passed + 1, size(next)).n_bytes").alias("sizes"),
        )
    )
    containers = placed.repartition("container").sortWithinPartitions("container")
    return keep(burst.unionByName(map_batches(containers, _sweep_batches, _MEMBER)), "members")


def shared_members(
    turns: DataFrame, convs: DataFrame, stride: int = STRIDE, container_turns: int = CONTAINER_TURNS
) -> DataFrame | None:
    """A row per conversation and depth at which it stands in a node with others, the root included.

    Columns: conv_id, n_turns, depth, rep (the node's smallest member), n (its members), longest (the most
    turns of a member) and n_bytes of the turn. None where there are no conversations.
    """
    root = convs.agg(F.count("*"), F.min("conv_id"), F.max("n_turns")).first()
    if not root[0]:
        return None
    parts = [
        convs.select(
            "conv_id",
            "n_turns",
            *[
                F.lit(v).cast("bigint").alias(c)
                for c, v in zip(("depth", "rep", "n", "longest", "n_bytes"), (0, root[1], root[0], root[2], 0), strict=True)
            ],
        )
    ]
    active = convs.where("n_turns > 0").select("conv_id", "n_turns", F.lit(root[1]).alias("head"))
    depth = 0
    while depth < root[2]:
        found = _stride(turns, active, depth, stride, max(1, container_turns // stride))
        parts.append(found)
        depth += stride
        active = found.where((F.col("depth") == depth) & (F.col("n_turns") > depth)).select(
            "conv_id", "n_turns", F.col("rep").alias("head")
        )
        if active.isEmpty():
            break
        stride = min(2 * stride, LONGEST_STRIDE)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _node(*figures: Column) -> list[Column]:
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return [f.cast("bigint").alias(n) for f, n in zip(figures, names, strict=True)]


NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,"
    " n_leaves bigint, saved_tokens bigint"
)
ENDS = "conv_id bigint, depth bigint, member bigint"


def prefix_trie(
    turns: DataFrame,
    convs: DataFrame,
    stride: int = STRIDE,
    container_turns: int = CONTAINER_TURNS,
) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie, and which conversations end at which node.

    turns has conv_id, pos (0, 1, 2 ...), digest and n_bytes, convs each conv_id once with n_turns.
    A node is named by its smallest member and its depth. Nodes: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves and saved_tokens, the last two over the node's subtree. Ends: conv_id, depth,
    member. Without conversations both are empty, and there is no root.
    """
    spark = turns.sparkSession
    members = shared_members(turns, convs, stride, container_turns)
    if members is None:
        return spark.createDataFrame([], NODE), spark.createDataFrame([], ENDS)
    deepest_first = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    down_to_here = deepest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("rep") == F.col("conv_id")
    goes_on = F.col("n_turns") > F.col("depth")
    # The row one turn deeper; where there is none, what follows is the conversation's alone.
    below = F.lag("rep").over(deepest_first)
    leads = F.when(below.isNull(), goes_on).otherwise(below == F.col("conv_id"))
    leaf = below.isNull() & (goes_on | own & (F.col("longest") == F.col("depth")))
    saved = F.when(own, (F.col("n") - 1) * F.col("n_bytes")).otherwise(0)
    rows = keep(
        members.select(
            "*",
            F.lead("rep").over(deepest_first).alias("parent"),
            below.isNull().alias("last_shared"),
            leads.cast("bigint").alias("child"),
            leaf.cast("bigint").alias("leaf"),
        ).select(
            "*",
            F.sum("leaf").over(down_to_here).alias("leaves"),
            F.sum(saved).over(down_to_here).alias("saved"),
        ),
        "figures",
    )
    shared = (
        rows.groupBy("rep", "depth")
        .agg(
            F.max(F.when(own, F.col("parent"))).alias("parent"),
            F.count("*").alias("n_convs"),
            F.sum("child").alias("n_children"),
            F.sum("leaves").alias("n_leaves"),
            F.sum("saved").alias("saved"),
        )
        .select(
            *_node(*map(F.col, ("rep", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved")))
        )
    )
    tails = rows.where(F.col("last_shared") & goes_on).select("conv_id", "n_turns", "depth", "rep")
    alone = turns.join(tails, "conv_id").where(F.col("pos") >= F.col("depth"))
    here = F.col("pos") + 1
    chain = alone.select(
        *_node(
            F.col("conv_id"),
            here,
            F.when(F.col("pos") == F.col("depth"), F.col("rep")).otherwise(F.col("conv_id")),
            F.lit(1),
            F.col("n_turns") > here,
            F.lit(1),
            F.lit(0),
        )
    )
    ends = rows.where(F.col("depth") == F.col("n_turns")).select(
        F.col("rep").alias("conv_id"), "depth", F.col("conv_id").alias("member")
    )
    ends_alone = tails.select("conv_id", F.col("n_turns").alias("depth"), F.col("conv_id").alias("member"))
    return shared.unionByName(chain), ends.unionByName(ends_alone)


def _digests(batches):
    """SHA-256 of each node's id texts, block after block; rows arrive sorted."""
    name, sha, out = None, None, []
    for batch in batches:
        for conv, depth, ids in zip(
            *(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")), strict=True
        ):
            if (conv, depth) != name:
                if sha is not None:
                    out.append((*name, sha.hexdigest()))
                name, sha = (conv, depth), hashlib.sha256(ids.encode())
            else:
                sha.update(f",{ids}".encode())
        if len(out) > 10_000:
            yield _batch(out, _DIGEST)
            out = []
    if sha is not None:
        out.append((*name, sha.hexdigest()))
    yield _batch(out, _DIGEST)


_DIGEST = "conv_id bigint, depth bigint, ends_sha256 string"


def ends_digests(ends: DataFrame) -> DataFrame:
    """Per node with ends, the SHA-256 of the members' decimal ids, ascending, comma-joined.

    Ids are first joined in blocks of neighbours, so a node at which very many conversations end sends
    few rows; its digest is then one pass over them, which holds one block at a time.
    """
    blocks = ends.groupBy(
        "conv_id", "depth", F.shiftright("member", BLOCK_BITS).alias("block")
    ).agg(F.array_join(F.sort_array(F.collect_list("member")).cast("array<string>"), ",").alias("ids"))
    laid = blocks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "block")
    return map_batches(laid, _digests, _DIGEST)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Trie of the spliced conversations, with a digest of the conversations that end at each node.

    conversations needs conv_id, turn, role and text; other columns are ignored. Turns stand in the order
    of ``turn``, null first; rows of one turn are in order of their role, then of a digest of role and
    text, and each is a turn of its own, repeated rows too. A null role or text is empty. Rows without
    conv_id belong to no conversation and are left out. Texts count whole, whatever their length. An
    empty table gives no rows.
    """
    turns, convs = splice(ordered_turns(conversations))
    nodes, ends = prefix_trie(turns, convs)
    return nodes.join(ends_digests(ends), ["conv_id", "depth"], "left").fillna(
        hashlib.sha256(b"").hexdigest(), ["ends_sha256"]
    )
