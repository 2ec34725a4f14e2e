"""Conversation prefix trie.

A node of depth d is a distinct sequence of the first d turns (role and text); the conversations that start with it are
its members. The node is known by a digest of 128 bits, the exclusive or of the digests of its turns at their places, which
running sums give for all depths at once. Texts never move: a turn travels as its digest and its number of characters.

Screening: a count-min sketch counts the prefix digests. An estimate of one proves that the prefix has a single
member, so its node is emitted where the row lies: its members, children, leaves and sums are known. Only prefixes with a larger
estimate, the possibly shared ones, are shuffled and grouped exactly; a prefix that the sketch takes for shared by mistake
is a group of one. The sketch is kept as one bit for each cell ("more than one"), with ``CELLS_FOR_ROW`` cells for each
prefix up to ``MAX_CELLS`` in each of ``SKETCH_ROWS`` rows: at most 48 MB reach the executors. With more prefixes than that
the sketch gets fuller, more rows shuffle, and the result stays the same.

Sums over subtrees take no rounds: each node counts for its smallest member, whose path leads through all nodes above it. So
a running sum from a conversation's end to its start, added up over the members of a node, is the sum over the node's
subtree. Running sums are taken in blocks of ``BLOCK`` turns and then over blocks, so that one conversation may hold any share of
all rows; turns are numbered by a sort over all rows, and nodes with many members are joined apart (``split_join``). A list of
the members that end at a node is digested row by row from a sorted partition; SHA-256 has to read the list of one node
in order, so that list passes one task, as ids alone.

Defined results: a null role or text is empty; turns follow ``turn`` (nulls first), equal ones their digest; repeated
rows are turns of their own; rows with a null conv_id belong to no conversation; an empty table has no nodes.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenuelake.llm.common import shuffle_partitions, tidy
from revenuelake.operators.skew import global_row_number, heavy_keys, split_join
from revenuelake.session import materialize, ship_package

FAMILY = 100  # conversations that share a leader, the first of their hundred
CELLS_FOR_ROW = 4
MAX_CELLS = 1 << 27  # a power of two
SKETCH_ROWS = 3
SKETCH_BLOCK = 1 << 18  # cells whose counts are merged at once
BLOCK = 4096
KEY = ["depth", "a", "b"]
PARENT = ["parent_depth", "pa", "pb"]


def running(df: DataFrame, by: str, place: str, totals: dict[str, tuple[str, str]], descending: bool = False, block: int = BLOCK) -> DataFrame:
    """Running totals (name: aggregate, column) over ``place``, a number from 0, within ``by``; values are in blocks first."""
    cut = df.withColumn("_block", F.floor(F.col(place) / block))

    def ordered(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    inner = Window.partitionBy(by, "_block").orderBy(ordered(place)).rowsBetween(Window.unboundedPreceding, 0)
    within = cut.select("*", *[getattr(F, f)(c).over(inner).alias(name) for name, (f, c) in totals.items()])
    whole = cut.groupBy(by, "_block").agg(*[getattr(F, f)(c).alias(name) for name, (f, c) in totals.items()])
    outer = Window.partitionBy(by).orderBy(ordered("_block")).rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select(by, "_block", *[getattr(F, f)(name).over(outer).alias(f"_{name}") for name, (f, _) in totals.items()])
    # Only conversations of more than one block have anything before a block.
    some = before.where(F.coalesce(*[F.col(f"_{name}") for name in totals]).isNotNull())
    joined = within.join(some, [by, "_block"], "left")

    def added(name: str, f: str) -> Column:
        past, here = F.coalesce(F.col(f"_{name}"), F.lit(0)), F.col(name)
        return past.bitwiseXOR(here) if f == "bit_xor" else past + here

    return joined.select(*df.columns, *[added(name, f).alias(name) for name, (f, _) in totals.items()])


def number_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and characters of every turn, and n, the turns of its conversation."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("said"), F.char_length(text).cast("long").alias("chars")
    )
    numbered = global_row_number(turns, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("said")], "_number")
    sizes = materialize(numbered.groupBy("conv_id").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("n")), "conversation-sizes")
    placed = split_join(numbered, sizes, ["conv_id"], heavy_keys(sizes, ["conv_id"], "n"))
    return placed.select("conv_id", (F.col("_number") - F.col("_first") + 1).alias("place"), "said", "chars", "n")


def rebuild(turns: DataFrame, borrowed: Column, most: int, family: int = FAMILY) -> DataFrame:
    """Turns of the rebuilt conversations: conv_id, depth (from 0: a textless turn that all share), said, chars, size.

    ``borrowed`` is the number of turns, at most ``most``, that a conversation takes from its leader; they stand in place
    of its own first ones.
    """
    turns = materialize(turns, "numbered-turns")
    conv = F.col("conv_id")
    convs = turns.where("place = 1").select("conv_id", "n", borrowed.cast("long").alias("h"), (conv - conv % family).alias("leader"))
    heads = turns.where((F.col("place") <= most) & (conv % family == 0)).select(conv.alias("leader"), "place", "said", "chars")
    led = convs.where(conv % family == 0).select(conv.alias("leader"), F.col("n").alias("led"))
    # At most ``family`` conversations have one leader, whose first ``most`` turns are all that is copied.
    plan = convs.join(led, "leader", "left").withColumn("head", F.least("h", F.coalesce("led", F.lit(0))))
    plan = materialize(plan.withColumn("size", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt-conversations")
    taken = plan.join(heads, "leader").where(F.col("place") <= F.col("h")).select("conv_id", F.col("place").alias("depth"), "said", "chars", "size")
    own = split_join(turns.drop("n"), plan, ["conv_id"], heavy_keys(plan, ["conv_id"], "n")).where(F.col("place") > F.col("h"))
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("depth"), "said", "chars", "size")
    root = plan.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("said"), F.lit(0).cast("long").alias("chars"), "size")
    return root.unionByName(taken).unionByName(own)


def prefixes(sequences: DataFrame) -> DataFrame:
    """Each turn with the digest (a, b) of the sequence that ends with it and that of its parent (pa, pb)."""
    mixed = sequences.withColumn("x", F.xxhash64(F.lit(1), "depth", "said")).withColumn("y", F.xxhash64(F.lit(2), "said", "depth"))
    summed = running(mixed, "conv_id", "depth", {"a": ("bit_xor", "x"), "b": ("bit_xor", "y")})
    return summed.select(
        "conv_id",
        *KEY,
        (F.col("depth") - 1).alias("parent_depth"),
        F.col("a").bitwiseXOR(F.col("x")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("y")).alias("pb"),
        "chars",
        "size",
    )


def sketch_cells(a: np.ndarray, b: np.ndarray, row: int, cells: int) -> np.ndarray:
    """The cell of each digest in a row of the sketch."""
    mixed = a.view(np.uint64) + np.uint64(2 * row + 1) * b.view(np.uint64)
    return ((mixed ^ (mixed >> np.uint64(31))) & np.uint64(cells - 1)).astype(np.int64)


def sketch(rows: DataFrame, total: int, most_cells: int = MAX_CELLS) -> tuple[int, np.ndarray]:
    """Cells in a row, and for each row the bits of the cells that count more than one prefix.

    Tasks send the cells they meet, with counts of one or "more", grouped by block; the counts of a block are added as they
    arrive, in one array.
    """
    cells = 1 << 10
    while cells < min(CELLS_FOR_ROW * total, most_cells):
        cells *= 2
    size = min(cells, SKETCH_BLOCK)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            for row in range(SKETCH_ROWS):
                at, count = np.unique(sketch_cells(a, b, row, cells) + row * cells, return_counts=True)
                cuts = np.flatnonzero(np.diff(at // size)) + 1
                blocks = [part for part in zip(np.split(at, cuts), np.split(count, cuts)) if len(part[0])]
                yield pa.record_batch(
                    [
                        pa.array([int(where[0]) // size for where, _ in blocks], pa.int32()),
                        pa.array([(where % size).astype("<u4").tobytes() for where, _ in blocks], pa.binary()),
                        pa.array([np.packbits(counts > 1).tobytes() for _, counts in blocks], pa.binary()),
                    ],
                    names=["block", "cells", "more"],
                )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, counts = None, np.zeros(size, dtype=np.uint8)

        def bits() -> pa.RecordBatch:
            return pa.record_batch([pa.array([current], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for block, where, more in zip(*[batch.column(c) for c in ("block", "cells", "more")]):
                if block.as_py() != current:
                    if current is not None:
                        yield bits()
                    current, counts[:] = block.as_py(), 0
                at = np.frombuffer(where.as_buffer(), dtype="<u4")
                several = np.unpackbits(np.frombuffer(more.as_buffer(), dtype=np.uint8), count=len(at))
                counts[at] = np.minimum(counts[at] + 1 + several, 2)
        if current is not None:
            yield bits()

    parts = rows.select("a", "b").mapInArrow(tidy(met), "block int, cells binary, more binary")
    sorted_parts = parts.repartition("block").sortWithinPartitions("block")
    found = sorted_parts.mapInArrow(tidy(merged), "block int, bits binary").toArrow()  # one bit a cell
    out = np.zeros((SKETCH_ROWS * cells // size, size // 8), dtype=np.uint8)
    for block, bits in zip(found.column("block").to_pylist(), found.column("bits")):
        out[block] = np.frombuffer(bits.as_py(), dtype=np.uint8)
    return cells, out.reshape(SKETCH_ROWS, cells // 8)


def screen(rows: DataFrame, total: int, most_cells: int = MAX_CELLS) -> DataFrame:
    """Adds whether the sketch proves that the prefix, and its parent, have one member (``alone``, ``parent_alone``)."""
    cells, table = sketch(rows, total, most_cells)
    shared = rows.sparkSession.sparkContext.broadcast(table)  # at most SKETCH_ROWS * MAX_CELLS bits

    def alone(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        proof = np.zeros(len(a), dtype=bool)
        for row in range(SKETCH_ROWS):
            at = sketch_cells(a, b, row, cells)
            proof |= ((shared.value[row, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1) == 0
        return proof

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = {name: batch.column(name).to_numpy() for name in ("a", "b", "pa", "pb")}
            own = alone(numbers["a"], numbers["b"])
            parent = alone(numbers["pa"], numbers["pb"]) & (batch.column("depth").to_numpy() > 0)
            yield batch.append_column("alone", pa.array(own)).append_column("parent_alone", pa.array(parent))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(tidy(estimated), f"{kinds}, alone boolean, parent_alone boolean")


def digest_lists(rows: DataFrame, key: Sequence[str], member: str, out: str) -> DataFrame:
    """SHA-256 of the sorted members of each key, joined by commas, read one by one from a sorted partition."""
    key = list(key)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in key]
            members = pc.cast(batch.column(member), pa.string()).to_pylist()
            for value, name in zip(zip(*columns), members):
                if value != current:
                    if current is not None:
                        done.append((*current, digest.hexdigest()))
                    current, digest = value, hashlib.sha256(name.encode())
                else:
                    digest.update(b"," + name.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip([*key, out], r)) for r in done], schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([dict(zip([*key, out], (*current, digest.hexdigest())))], schema)

    schema = pa.schema([*[(c, pa.int64()) for c in key], (out, pa.string())])
    ordered = rows.select(*key, member).repartition(shuffle_partitions(rows.sparkSession), *key).sortWithinPartitions(*key, member)
    return ordered.mapInArrow(told, ", ".join([*[f"{c} {kinds[c]}" for c in key], f"{out} string"]))


def build_trie(sequences: DataFrame, most_cells: int = MAX_CELLS) -> DataFrame:
    """One row for each node of the trie over the sequences of ``rebuild``; see the columns at the end."""
    spark = sequences.sparkSession
    ship_package(spark)
    rows = materialize(prefixes(sequences), "trie-prefixes")
    rows = materialize(screen(rows, rows.count(), most_cells), "trie-screened")
    ends = F.col("depth") == F.col("size")
    own_id = F.sha2(F.col("conv_id").cast("string"), 256)
    nobody = F.sha2(F.lit(""), 256)

    # Nodes of one member are told where they lie; those below a possibly shared node still want its id.
    tails = rows.where("alone").select(
        "conv_id", *KEY, *PARENT, "parent_alone",
        F.lit(1).cast("long").alias("n_convs"),
        F.when(ends, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(ends, own_id).otherwise(nobody).alias("ends_sha256"),
    )

    shared = rows.where("NOT alone")
    groups = materialize(
        shared.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count(F.when(ends, 1)).alias("n_ends"),
            F.first("chars").alias("chars"), *[F.first(c).alias(c) for c in PARENT],
        ),
        "trie-groups",
    )
    members = split_join(
        shared, groups.select(*KEY, F.col("conv_id").alias("_rep"), F.col("n_convs").alias("_n"), F.col("n_ends").alias("_ends")),
        KEY, heavy_keys(groups, KEY, "n_convs"),
    )
    first = F.col("_rep") == F.col("conv_id")
    worth = members.select(
        "conv_id", *KEY, F.lit(True).alias("counts"),
        F.when(first, (F.col("_n") - 1) * F.col("chars")).otherwise(0).alias("worth"),
        (first & ends & (F.col("_ends") == F.col("_n"))).cast("long").alias("leaf"),
    )
    last = rows.where(F.col("alone") & ends).select("conv_id", *KEY, F.lit(False).alias("counts"), F.lit(0).cast("long").alias("worth"), F.lit(1).cast("long").alias("leaf"))
    below = running(worth.unionByName(last), "conv_id", "depth", {"saved": ("sum", "worth"), "leaves": ("sum", "leaf")}, descending=True)
    sums = below.where("counts").groupBy(*KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    border = tails.where("NOT parent_alone").select("conv_id", *KEY, *PARENT)
    nodes = groups.select("conv_id", *KEY, *PARENT).unionByName(border)
    children = materialize(nodes.groupBy(*PARENT).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    parents = groups.select(F.col("conv_id").alias("parent_conv_id"), F.col("depth").alias("parent_depth"), F.col("a").alias("pa"), F.col("b").alias("pb"))
    found = split_join(nodes, parents, PARENT, heavy_keys(children, PARENT, "n_children"), "left")
    # A node without a possibly shared parent is below one of a single member, its own.
    parent_id = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id")
    found = materialize(found.select(*KEY, "conv_id", parent_id), "trie-parents")

    lists = digest_lists(shared.where(ends), KEY, "conv_id", "ends_sha256")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    counted = children.withColumnsRenamed({p: k for p, k in zip(PARENT, KEY)})
    whole = (
        groups.select("n_convs", *KEY)
        .join(found, KEY)
        .join(sums, KEY)
        .join(counted, KEY, "left")
        .join(lists, KEY, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
        )
    )
    deep = tails.where("parent_alone").withColumn("parent_conv_id", F.col("conv_id")).select(*names)
    edge = tails.where("NOT parent_alone").join(found.drop("conv_id"), KEY).select(*names)
    return whole.unionByName(edge).unionByName(deep)


def conversation_trie(conversations: DataFrame, most_cells: int = MAX_CELLS) -> DataFrame:
    """The trie of the contract: conversations borrow crc32(conv_id) % 6 turns from the leader of their hundred."""
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return build_trie(rebuild(number_turns(conversations), borrowed, 5), most_cells)
