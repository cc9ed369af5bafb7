"""The trie of conversation prefixes, by van Emde Boas recursion.

A conversation is a sequence of turns, held as one binary string of ``TOKEN`` bytes a
turn: the 128-bit name of the prefix that the turn ends, and the size of the turn's
text.  Names are chained digests, so equal prefixes have equal names wherever they
are met.

Going down.  Sequences of a tree are cut at half its depth.  The cut prefix's name
becomes the root of a lower tree; the upper halves, each distinct one once with its
number of conversations, are the upper tree.  Upper tree and lower forest are cut
again in the same round, all trees of a depth in one job, until no tree is deeper
than ``BASE`` turns: the rounds are the logarithm of the longest conversation.
Trees of that depth are spelled out: a row for each node with its path in the tree.

Going up.  Sums over the nodes of the lowest trees are summed to their roots.  In
each round, what lies below a cut prefix is grafted: added to every node of the upper
path that ends there, and to the root of the tree that both halves make up.  A node gets
one contribution a round from each cut below it, never one from each descendant.

Order of turns: by turn, null first; turns that share one in the order of a digest
of role and text.  Nulls: a null role or text is empty; rows without a conv_id belong
to no conversation.  Repeated rows are turns of their own.  Very long texts enter by
digest and size alone; a conversation is a row of 24 bytes a turn.  The ids
that end in a node are strung together in ranges, in parallel, and only the SHA-256
over the finished strings runs in one task.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C

NAME, SIZE = 16, 8
TOKEN = NAME + SIZE
ROOT = bytes(NAME)
BASE = 16  # turns of the trees that are spelled out
PIECE = 4096  # values strung together in one row
GROUP = 5  # conversations that share the start of the first of them
STARTS = 9  # lengths of the shared start, 0 to 8


def strung(df: DataFrame, key: str, order: list[Column], value: str, sep: bytes = b"") -> DataFrame:
    """(key, part, no, piece): the binary values of each key joined in order, at most ``PIECE`` to a row.
    Ranges and not keys are dealt to tasks, so a key may have any number of values."""
    kind = df.schema[key].dataType
    schema = pa.schema([("key", pa.binary() if kind.typeName() == "binary" else pa.int64()), ("part", pa.int32()), ("no", pa.int64()),
                        ("piece", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, own, waiting, out = TaskContext.get().partitionId(), 0, None, [], []

        def flush():
            nonlocal no
            if waiting:
                out.append((own, part, no, sep.join(waiting)))
                no += 1
                waiting.clear()

        def made():
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != own or len(waiting) >= PIECE:
                    flush()
                    own = k
                waiting.append(v)
            if out:
                yield made()
        flush()
        if out:
            yield made()

    return df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order).select(key, value).mapInArrow(
        run, f"{key} {kind.simpleString()}, part int, no bigint, piece binary")


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, 16 bytes of digest and 8 of size for each."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.unhex(F.substring(F.sha2(content, 256), 1, 2 * NAME)).alias("digest"),
        F.unhex(F.lpad(F.hex(F.octet_length(text).cast("bigint")), 2 * SIZE, "0")).alias("size"))
    turns = C.written(turns.select("conv_id", "turn", F.concat("digest", "size").alias("token")), "turns")
    pieces = strung(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("token").asc()], "token")
    ordered = F.array_sort(F.collect_list(F.struct("part", "no", "piece")))
    return pieces.groupBy("conv_id").agg(ordered.alias("p")).select(
        "conv_id", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["piece"])).alias("turns"))


def cut(seq: Column, start: Column | int, n: Column | int | None = None) -> Column:
    """Turns [start, start + n) of a sequence, to its end if n is None."""
    first = (F.lit(start) if isinstance(start, int) else start) * TOKEN + 1
    return F.substring(seq, first, F.lit(1 << 31) - 1 if n is None else (F.lit(n) if isinstance(n, int) else n) * TOKEN)


def shared_start(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its group."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % STARTS).cast("int")


def rebuilt(seqs: DataFrame) -> DataFrame:
    """(conv_id, turns): the first h turns of the group's first conversation, then the own ones after the first h."""
    first = seqs.select(F.col("conv_id").alias("_base"), cut(F.col("turns"), 0, STARTS - 1).alias("_start"))
    h = shared_start(F.col("conv_id"))
    return seqs.withColumn("_base", F.col("conv_id") - F.col("conv_id") % GROUP).join(first, "_base", "left").select(
        "conv_id", F.concat(cut(F.coalesce("_start", F.lit(b"")), 0, h), cut(F.col("turns"), h)).alias("turns"))


def named(seqs: DataFrame) -> DataFrame:
    """(conv_id, seg, end): each turn's digest replaced by the name of the prefix that it ends; the last name."""
    schema = pa.schema([("conv_id", pa.int64()), ("seg", pa.binary()), ("end", pa.binary())])

    def run(conv_id, turns):
        segs, ends = [], []
        for t in turns.to_pylist():
            name, out = ROOT, []
            for at in range(0, len(t), TOKEN):
                name = hashlib.blake2b(name + t[at:at + TOKEN], digest_size=NAME).digest()
                out += [name, t[at + NAME:at + TOKEN]]
            segs.append(b"".join(out))
            ends.append(name)
        return {"conv_id": conv_id, "seg": segs, "end": ends}

    return seqs.mapInArrow(C.by_batch(run, schema, "conv_id", "turns"), "conv_id bigint, seg binary, end binary")


def n_turns(seg: Column) -> Column:
    return (F.octet_length(seg) / TOKEN).cast("int")


def name_at(seg: Column, i: Column | int) -> Column:
    """The name that turn i (from 0) ends."""
    return F.substring(seg, (F.lit(i) if isinstance(i, int) else i) * TOKEN + 1, F.lit(NAME))


def names_in(seg: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), n_turns(seg) - 1), lambda i: name_at(seg, i))


def halved(segs: DataFrame, half: int) -> DataFrame:
    """Upper and lower parts of the sequences of every tree (tree, lo, seg, n, first), each distinct one once; ``goes_on``:
    a cut prefix, below which there is a lower tree."""
    seg, more = F.col("seg"), n_turns(F.col("seg")) > half
    parts = F.array(
        F.struct(F.col("tree").alias("tree"), F.col("lo").alias("lo"), cut(seg, 0, half).alias("seg"), more.alias("goes_on")),
        F.struct(name_at(seg, half - 1).alias("tree"), (F.col("lo") + half).alias("lo"), cut(seg, half).alias("seg"),
                 F.lit(False).alias("goes_on")))
    return segs.select("n", "first", F.inline(parts)).where(F.octet_length("seg") > 0).groupBy("tree", "lo", "seg").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("goes_on").alias("goes_on"))


def spelled(segs: DataFrame) -> DataFrame:
    """(name, parent, depth, tree, lo, path, size, n, first): the nodes of trees that aren't cut further."""
    seg, i = F.col("seg"), F.col("i")
    rows = segs.select("*", F.explode(F.sequence(F.lit(0), n_turns(seg) - 1)).alias("i")).select(
        name_at(seg, i).alias("name"), F.when(i == 0, F.col("tree")).otherwise(name_at(seg, i - 1)).alias("parent"),
        (F.col("lo") + i + 1).alias("depth"), "tree", "lo", cut(seg, 0, i + 1).alias("path"),
        F.conv(F.hex(F.substring(seg, i * TOKEN + NAME + 1, F.lit(SIZE))), 16, 10).cast("bigint").alias("size"), "n", "first")
    same = ("parent", "depth", "tree", "lo", "path", "size")
    return rows.groupBy("name").agg(*(F.first(c).alias(c) for c in same), F.sum("n").alias("n"), F.min("first").alias("first"))


def summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256): the ids that end in a node, ascending, comma-joined."""
    pieces = strung(ends.select(F.col("end").alias("name"), "conv_id", F.col("conv_id").cast("string").cast("binary").alias("id")),
                    "name", [F.col("conv_id").asc()], "id", b",")
    schema = pa.schema([("name", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest = None, None
        for batch in batches:
            done = []
            for name, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name == own:
                    digest.update(b",")
                else:
                    done += [(own, digest.hexdigest())] if digest else []
                    own, digest = name, hashlib.sha256()
                digest.update(piece.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], f.type) for i, f in enumerate(schema)], schema=schema)
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (own, digest.hexdigest())], schema=schema)

    return pieces.repartition("name").sortWithinPartitions("name", "part", "no").select("name", "piece").mapInArrow(
        run, "name binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, base: int = BASE) -> DataFrame:
    """The nodes of the trie of (conv_id, turns) sequences: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    convs = C.written(named(convs), "named")
    whole = convs.agg(F.max(n_turns(F.col("seg"))).alias("deepest"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))
    deepest = whole.first()["deepest"] or 0
    segs = convs.where(F.octet_length("seg") > 0).groupBy("seg").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")).select(
        F.lit(ROOT).alias("tree"), F.lit(0).alias("lo"), "seg", "n", "first")
    span, rounds = base, []
    while span < deepest:
        span *= 2
    while span > base:
        span //= 2
        segs = C.written(halved(segs, span), "halves")
        rounds.append((span, segs.where("goes_on").select("tree", "lo", "seg")))

    top = whole.where("n > 0").select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), F.lit(None).cast("binary").alias("tree"),
        F.lit(0).alias("lo"), F.lit(b"").alias("path"), F.lit(0).cast("bigint").alias("size"), "n", "first")
    nodes = C.written(spelled(segs).unionByName(top), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = C.written(nodes.join(children, "name", "left").select(
        "*", F.col("n_children").isNull().cast("bigint").alias("leaves"), ((F.col("n") - 1) * F.col("size")).alias("saved")), "valued")

    inner = nodes.where("depth > 0")
    below = C.written(summed(inner, "tree", "lo"), "below")  # by tree: sums over its nodes, the root left out
    found = [inner.select(F.explode(names_in(F.col("path"))).alias("name"), "leaves", "saved"),
             nodes.where("depth = 0").select("name", "leaves", "saved")]
    for half, prefixes in reversed(rounds):
        grafts = prefixes.withColumn("_p", name_at(F.col("seg"), half - 1)).join(
            below.select(F.col("tree").alias("_p"), "leaves", "saved"), "_p")
        found.append(grafts.select(F.explode(names_in(F.col("seg"))).alias("name"), "leaves", "saved"))
        joined = below.where(F.col("lo") % (2 * half) == 0).unionByName(grafts.select("tree", "lo", "leaves", "saved"))
        below = C.written(summed(joined, "tree", "lo"), "below")
    found.append(below.where(F.col("tree") == F.lit(ROOT)).select(F.col("tree").alias("name"), "leaves", "saved"))
    totals = found[0]
    for part in found[1:]:
        totals = totals.unionByName(part)
    totals = summed(totals, "name").select("name", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))

    parents = nodes.select(F.col("name").alias("parent"), F.col("first").alias("parent_conv_id"))
    rows = nodes.select("name", "parent", "depth", "n", "first", "n_children").join(totals, "name") \
        .join(ends_digests(convs.select("conv_id", "end")), "name", "left").join(parents, "parent", "left")
    return rows.select(
        F.col("first").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, base: int = BASE) -> DataFrame:
    """The trie of the rebuilt conversations of (conv_id, turn, role, text)."""
    return prefix_trie(rebuilt(C.written(sequences(conversations), "sequences")), base)
