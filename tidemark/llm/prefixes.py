"""A trie of conversation prefixes by whole-sequence collapse.

A node is a sequence of turns (role, text) with which some conversation begins; the root is the empty one. The trie is
never built link by link:

1. *Collapse.* A turn is reduced to a digest and the length of its text, a conversation to the array of these, and
   the digest of a prefix is chained over it. Identical conversations become one weighted sequence, counted
   before the shuffle; the ids that end at a node are listed apart (``ends``).
2. *Leaves.* Sequences that are a proper prefix of another go by an anti-join; the ends of the others are the leaves.
3. *Prefixes.* Every weighted sequence gives a row per prefix, and rows of one prefix are summed. A node belongs to the
   sequence with the smallest member among those through it, and a sequence owns the nodes from some depth on. So sums
   over a subtree need no walk: a sequence brings its weight times the lengths behind the prefix, less the lengths of the nodes
   it owns there, which leaves every node of the subtree (members - 1) times its length.
4. *Parents.* Inside the owned part of a sequence the parent has the same smallest member; only the first owned node looks
   its parent up.

Texts are shuffled once, as digests. A prefix that most conversations share is summed in the tasks first, the many children
of a node meet only their one parent row in a join that can be split, and the ids that end at one node are sorted in
ranges, written as text blocks and hashed in a stream. Only that hash, which has to read its ids in order, is
one task per node. A conversation is an array of 20 bytes a turn and has to fit into a task.

Edge cases: NULL role and text are empty; a NULL turn comes first; equal turns are ordered by role, then text; repeated rows are
repeated turns; rows with a NULL conv_id name no conversation and are left out; an empty table has no node, not
even the root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored

_BYTES = 16
ROOT = bytes(_BYTES)
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_BLOCK = 4096


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of (conv_id, turn, role, text): ordered arrays of (digest, length of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role keeps (role, text) pairs apart that run together to the same characters
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.substring(F.unhex(F.sha2(content, 256)), 1, _BYTES).alias("digest"),
        F.length(text).alias("size"),
    )
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation the digest of each prefix, the empty one first, and the length of all its texts."""
    for batch in batches:
        nodes, reach = [], []
        for digests, sizes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            chain = [ROOT]
            for digest in digests:
                chain.append(hashlib.blake2b(chain[-1] + digest, digest_size=_BYTES).digest())
            nodes.append(chain)
            reach.append(np.cumsum([0, *sizes], dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(nodes, pa.list_(pa.binary())), pa.array(reach, pa.list_(pa.int64()))], names=["conv_id", "nodes", "reach"]
        )


def chains(sequences: DataFrame) -> DataFrame:
    """conv_id, nodes, reach of (conv_id, turns): one row per conversation, with an element per prefix."""
    flat = sequences.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))
    return flat.mapInArrow(_chain_batches, "conv_id bigint, nodes array<binary>, reach array<bigint>")


def ends(chained: DataFrame) -> DataFrame:
    """(node, conv_id): where each conversation ends."""
    return chained.select(F.element_at("nodes", -1).alias("node"), "conv_id")


def collapsed(chained: DataFrame) -> DataFrame:
    """node, weight, first_id, nodes, reach: one row per different conversation."""
    return chained.groupBy(F.element_at("nodes", -1).alias("node")).agg(
        F.count("*").alias("weight"),
        F.min("conv_id").alias("first_id"),
        F.any_value("nodes").alias("nodes"),
        F.any_value("reach").alias("reach"),
    )


def leaves(weighted: DataFrame) -> DataFrame:
    """The sequences that are no proper prefix of another."""
    proper = weighted.select(F.explode(F.slice("nodes", F.lit(1), F.size("nodes") - 1)).alias("node")).distinct()
    return weighted.join(proper, "node", "left_anti")


def trie(sequences: DataFrame) -> DataFrame:
    """node, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    ``sequences`` has conv_id and turns as ``sequences()`` makes them, one row per conv_id; ``node`` and ``parent`` are digests.
    """
    chained = stored(chains(sequences), "chains")
    weighted = stored(collapsed(chained), "weighted")

    each = weighted.select("first_id", F.posexplode("nodes").alias("depth", "node"))
    owners = each.groupBy("node").agg(F.min("first_id").alias("_owner"), F.any_value("depth").alias("depth"))
    owned = owners.groupBy("_owner").agg(F.min("depth").alias("owned_from"))
    weighted_owned = weighted.join(owned, F.col("first_id") == F.col("_owner"), "left")

    def behind(depth: Column) -> Column:
        """Length of the texts of a sequence from a depth on."""
        return F.element_at("reach", -1) - F.get("reach", F.greatest(depth - 1, F.lit(0)))

    beyond = F.size("nodes")  # a depth behind the last one
    rows = weighted_owned.select("*", F.posexplode("nodes").alias("depth", "at")).select(
        F.col("at").alias("node"),
        F.when(F.col("depth") > 0, F.get("nodes", F.col("depth") - 1)).alias("parent"),
        "depth",
        "first_id",
        "weight",
        (F.col("weight") * behind(F.col("depth")) - behind(F.greatest("depth", F.coalesce("owned_from", beyond)))).alias("saved"),
        (F.col("depth") == F.col("owned_from")).alias("top"),
        F.lit(0).alias("leaf"),
    )
    nothing = {"parent": "binary", "depth": "int", "first_id": "bigint", "weight": "bigint", "saved": "bigint", "top": "boolean"}
    of_leaves = leaves(weighted).select(
        F.explode("nodes").alias("node"), *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()], F.lit(1).alias("leaf")
    )
    nodes = stored(
        rows.unionByName(of_leaves)
        .groupBy("node")
        .agg(
            F.min("parent").alias("parent"),
            F.min("first_id").alias("conv_id"),
            F.max("depth").cast("bigint").alias("depth"),
            F.sum("weight").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"),
            F.sum("saved").alias("saved_tokens"),
            F.max("top").alias("top"),
        ),
        "nodes",
    )
    return _with_parents(nodes).join(_children(nodes), "node", "left").join(ends_hashes(ends(chained)), "node", "left").select(
        "node",
        "parent",
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def _children(nodes: DataFrame) -> DataFrame:
    return nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """The nodes with their parent's smallest member; see the module text."""
    root = nodes.where("depth = 0").agg(F.min("conv_id").alias("id")).scalar()
    known = (F.col("depth") <= 1) | ~F.col("top")
    near = nodes.where(known).withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, root).when(F.col("depth") > 1, F.col("conv_id"))
    )
    parents = nodes.select(F.col("node").alias("_parent"), F.col("conv_id").alias("parent_conv_id"))
    far = nodes.where(~known).join(parents, F.col("parent") == F.col("_parent"), "left").drop("_parent")
    return near.unionByName(far)


def _id_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of rows sorted by node and id as comma-joined text, up to ``_BLOCK`` of one node in a row."""
    for batch in batches:
        frame = batch.to_pandas()
        new = frame["node"] != frame["node"].shift()
        run = new.cumsum()
        piece = frame.groupby(run, sort=False).cumcount() // _BLOCK
        found = frame.groupby([run, piece], sort=False).agg(
            node=("node", "first"), first=("conv_id", "first"), ids=("conv_id", lambda ids: ",".join(map(str, ids)))
        )
        yield pa.RecordBatch.from_pandas(
            found, pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]), preserve_index=False
        )


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash over all blocks of a node, in order; a node can go on in the next batch."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, state = None, None
    for batch in batches:
        done = []
        for at, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if at != node:
                if state is not None:
                    done.append({"node": node, "ends_sha256": state.hexdigest()})
                node, state = at, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist(done, schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": state.hexdigest()}], schema)


def ends_hashes(ended: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids at each node, ascending and comma-joined.

    Ids are sorted in ranges, so the ids of one node are dealt over tasks, and only the finished text meets again.
    """
    sorted_ids = ended.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    blocks = sorted_ids.mapInArrow(_id_blocks, "node binary, first bigint, ids string")
    return (
        blocks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hash_batches, "node binary, ends_sha256 string")
    )
