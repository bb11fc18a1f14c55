"""Prefix trie over conversations, built as a burst trie on Spark.

A turn is known by the first 128 bits of the SHA-256 of its role and text.  Equal conversations form one class, held once
under its smallest id.  Trie heads hold containers of suffixes: windows of up to `WINDOW` turns, equal ones once.  A
container with more than `BOX` windows bursts: each of its windows moves to the head below, by its next turn id.  What is
left is sorted, and each container is swept into nodes in one task.  Where a whole window is shared, its classes go
on with their next window under the node at its end; a class that is alone needs no container any more.

A node belongs to its smallest member, so the nodes of a class are a chain, the one from `start` to its end, and a node's
key is (owner, depth).  Sums over a subtree are sums over the classes that pass: of what they share with smaller
ones, and of the leaves that they end in.  So all counts are grouped sums that merge partial results, and neither a third of all conversations
in one node nor a conversation with a third of all turns meets in one task.

Rows without a conv_id are left out.  Turns with equal numbers are ordered by their ids, equal rows count as often as they
stand there.  A null role or text is empty.  An empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trilayer.llm.common import stored

#: Turns in a window, windows in a container, bytes of a turn id, ids packed into one row before they are hashed.
WINDOW, BOX, ID_BYTES, PACK = 64, 4096, 16, 4096
#: Of the rebuilding: conversations in a family, turns taken from its first one at most, plus one.
FAMILY, TAKEN = 5, 9


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, turn_id and bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(named, 256)), 1, ID_BYTES).alias("turn_id"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """Each turn with `pos`, its place in its conversation from 1, and `upto`, the bytes up to its end.

    Rows are dealt into ranges, so a long conversation is cut into pieces; places are counted in each piece and moved on by
    the pieces before.
    """
    tied = turns.withColumn("tie", F.monotonically_increasing_id())
    dealt = stored(tied.repartitionByRange("conv_id", "turn", "turn_id", "tie").withColumn("piece", F.spark_partition_id()))
    inside = Window.partitionBy("conv_id", "piece").orderBy("turn", "turn_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = dealt.groupBy("conv_id", "piece").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    pieces = pieces.select("conv_id", "piece", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "b")))
    placed = dealt.withColumns({"pos": F.count("*").over(inside), "upto": F.sum("bytes").over(inside)}).join(pieces, ["conv_id", "piece"])
    return placed.select("conv_id", (F.col("pos") + F.col("n_before")).alias("pos"), "turn_id", "bytes", (F.col("upto") + F.col("b_before")).alias("upto"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, depth, turn_id, left), where `left` are the bytes from this turn to the end, and
    (conv_id, length)."""
    rows = stored(numbered(turn_rows(conversations)))
    takes = F.crc32(F.col("conv_id").cast("string")) % TAKEN
    whole = rows.withColumn("h", takes).groupBy("conv_id", "h").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("total"), F.coalesce(F.max(F.when(F.col("pos") <= F.col("h"), F.col("upto"))), F.lit(0)).alias("skipped")
    )
    # A family's first turns are at most eight rows.
    firsts = rows.where(F.col("pos") < TAKEN).groupBy(F.col("conv_id").alias("family")).agg(F.sort_array(F.collect_list(F.struct("pos", "turn_id", "bytes", "upto"))).alias("opening"))
    plan = whole.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(firsts, "family", "left")
    plan = plan.withColumn("opening", F.when(F.col("opening").isNotNull() & (F.col("h") > 0), F.slice("opening", 1, F.greatest(F.col("h"), F.lit(1)).cast("int"))))
    plan = plan.withColumn("m", F.greatest(F.coalesce(F.size("opening"), F.lit(0)), F.lit(0)).cast("long"))
    plan = stored(plan.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    tail = F.col("total") - F.col("skipped")
    inherited = plan.select("conv_id", tail.alias("tail"), F.element_at("opening", -1)["upto"].alias("end"), F.explode("opening").alias("t")).select(
        "conv_id", F.col("t.pos").alias("depth"), "t.turn_id", (F.col("tail") + F.col("end") - F.col("t.upto") + F.col("t.bytes")).alias("left")
    )
    own = rows.join(plan.select("conv_id", "h", "m", "total"), "conv_id").where(F.col("pos") > F.col("h"))
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("depth"), "turn_id", (F.col("total") - F.col("upto") + F.col("bytes")).alias("left"))
    return stored(inherited.unionByName(own)), plan.select("conv_id", "length")


def _joined(parts: Column) -> Column:
    """Binary values of an array, one after the other."""
    return F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p)), ""))


def windows_of(paths: DataFrame) -> DataFrame:
    """conv_id, `at` (number of the window from 0) and `window`, its turn ids one after the other."""
    at = F.expr(f"(depth - 1) div {WINDOW}").alias("at")
    return paths.groupBy("conv_id", at).agg(_joined(F.sort_array(F.collect_list(F.struct("depth", "turn_id")))["turn_id"]).alias("window"))


def classes_of(convs: DataFrame, windows: DataFrame) -> DataFrame:
    """conv_id, length, rep, the smallest conversation with the same turns.  Windows are hashed, then groups of hashes, until
    there is one for each conversation."""
    marks, last = windows.select("conv_id", "at", F.sha2("window", 256).alias("mark")), windows.agg(F.max("at")).first()[0] or 0
    while last:
        up = F.expr(f"at div {WINDOW}").alias("at")
        marks = marks.groupBy("conv_id", up).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.struct("at", "mark")))["mark"], "").cast("binary"), 256).alias("mark"))
        last //= WINDOW
    # Stored first: so both sides of the last join have plain exchanges, and a class with many members is split.
    marked = stored(convs.join(marks.select("conv_id", "mark"), "conv_id", "left").withColumn("mark", F.coalesce("mark", F.lit(""))))
    reps = stored(marked.groupBy("mark").agg(F.min("conv_id").alias("rep")))
    return stored(marked.join(reps, "mark").select("conv_id", "length", "rep"))


def sweep(windows: list[bytes], firsts: list[int], counts: list[int], at: int) -> list[list[int]]:
    """Of sorted windows that agree in their first `at` turns: for each window the smallest owner at every further depth that
    at least two classes share."""
    owners: list[list[int]] = [[] for _ in windows]
    runs = [(0, len(windows), at * ID_BYTES)]
    while runs:
        low, high, cut = runs.pop()
        while low < high and len(windows[low]) <= cut:
            low += 1
        while low < high:
            turn, end = windows[low][cut : cut + ID_BYTES], low + 1
            while end < high and windows[end][cut : cut + ID_BYTES] == turn:
                end += 1
            if end - low > 1 or counts[low] > 1:
                owner = min(firsts[low:end])
                for found in owners[low:end]:
                    found.append(owner)
                runs.append((low, end, cut + ID_BYTES))
            low = end
    return owners


def _swept(boxes: DataFrame) -> DataFrame:
    """(head, window, owners) of all containers, one after the other in sorted partitions."""

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        found = sweep([r[2] for r in rows], [r[3] for r in rows], [r[4] for r in rows], rows[0][5])
        columns = [pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[6] + more for r, more in zip(rows, found)], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["head", "window", "owners"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield emit(held)
                    held = []
                held.append(row)
        if held:
            yield emit(held)

    dealt = boxes.select("box", "head", "window", "first", "n", "deep", "owners").repartition("box").sortWithinPartitions("box", "window")
    return dealt.mapInArrow(run, "head long, window binary, owners array<long>")


def burst(boxes: DataFrame, limit: int) -> DataFrame:
    """(head, window, owners) of all windows, after containers with more than `limit` windows have burst."""
    done, owners = [], F.array().cast("array<long>")
    boxes = boxes.withColumns({"box": F.hex(F.col("head").cast("string").cast("binary")), "deep": F.lit(0), "owners": owners})
    while True:
        sizes = boxes.groupBy("box").agg(F.count("*").alias("size")).where(F.col("size") > limit)
        sizes = stored(sizes)
        if not sizes.limit(1).count():
            break
        small = boxes.join(sizes, "box", "left_anti")
        large = boxes.join(sizes.select("box"), "box")
        turn = F.substring(F.hex("window"), F.col("deep") * (2 * ID_BYTES) + 1, F.lit(2 * ID_BYTES))
        moved = large.withColumn("turn", turn)
        below = moved.where("turn <> ''").groupBy("box", "turn").agg(F.min("first").alias("owner"), F.sum("n").alias("classes"))
        moved = moved.join(below, ["box", "turn"], "left")
        shared = F.col("classes") > 1
        moved = stored(
            moved.select(
                F.concat("box", "turn").alias("box"), "head", "window", "first", "n", (F.col("deep") + 1).alias("deep"),
                F.when(shared, F.concat("owners", F.array("owner"))).otherwise(F.col("owners")).alias("owners"),
                F.coalesce(shared, F.lit(False)).alias("goes_on"),
            )
        )
        done.append(moved.where("not goes_on").select("head", "window", "owners"))
        boxes = stored(small.unionByName(moved.where("goes_on").drop("goes_on")))
    found = _swept(boxes)
    for part in done:
        found = found.unionByName(part)
    return found


def shared_nodes(classes: DataFrame, windows: DataFrame, limit: int) -> DataFrame:
    """(rep, depth, owner) of every node that at least two classes share, but for the root."""
    held = windows.join(classes.select("rep"), windows["conv_id"] == classes["rep"]).select("rep", "at", "window")
    active, at, found = classes.where("length > 0").select("rep", F.lit(0).cast("long").alias("head")), 0, None
    while True:
        here = stored(held.where(F.col("at") == at).join(active, "rep").select("head", "window", "rep"))
        boxes = here.groupBy("head", "window").agg(F.min("rep").alias("first"), F.count("*").alias("n"))
        owned = here.join(burst(stored(boxes), limit), ["head", "window"]).where(F.size("owners") > 0)
        owned = stored(owned.select("rep", F.lit(at).cast("long").alias("at"), "owners"))
        found = owned if found is None else found.unionByName(owned)
        whole = owned.where(F.size("owners") == WINDOW).select("rep", F.element_at("owners", -1).alias("head"))
        at += 1
        active = whole.join(classes.where(F.col("length") > at * WINDOW).select("rep"), "rep")
        if not active.limit(1).count():
            break
    nodes = found.select("rep", "at", F.posexplode("owners").alias("i", "owner"))
    return nodes.select("rep", (F.col("at") * WINDOW + F.col("i") + 1).alias("depth"), "owner")


def id_hashes(members: DataFrame) -> DataFrame:
    """(rep, ends_sha256): the hash of each class's conversation ids, ascending and comma-joined.  Ids are packed by ranges, and
    the packs of a class run through its hash one by one."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, ids, rows, low = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], 0
            for i in range(1, len(reps) + 1):
                if i == len(reps) or reps[i] != reps[low] or i - low == PACK:
                    rows.append((reps[low], ids[low], ",".join(map(str, ids[low:i]))))
                    low = i
            yield pa.RecordBatch.from_pylist([dict(zip(("rep", "first", "ids"), r)) for r in rows], pa.schema([("rep", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, state = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([state.hexdigest()])], names=["rep", "ends_sha256"])

        for batch in batches:
            for this, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
                if this != rep:
                    if state:
                        yield out()
                    rep, state = this, hashlib.sha256(ids.as_py().encode())
                else:
                    state.update(b"," + ids.as_py().encode())
        if state:
            yield out()

    packs = members.select("rep", "conv_id").repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInArrow(pack, "rep long, first long, ids string")
    return packs.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(hashed, "rep long, ends_sha256 string")


def prefix_trie(paths: DataFrame, convs: DataFrame, limit: int = BOX) -> DataFrame:
    """The nodes of the trie of `paths` (conv_id, depth from 1, turn_id, left) of the conversations `convs` (conv_id, length)."""
    windows = stored(windows_of(paths))
    members = classes_of(convs, windows)
    classes = stored(members.groupBy("rep").agg(F.count("*").alias("copies"), F.max("length").alias("length")))
    shared = stored(shared_nodes(classes, windows, limit))
    top = classes.agg(F.min("rep")).first()[0]
    root = F.lit(top).cast("long")

    # Of each class: the depth to which it shares, the depth from which it owns, and the owner above that.
    mine, above = F.col("owner") == F.col("rep"), F.col("owner") != F.col("rep")
    own = shared.groupBy("rep").agg(F.max("depth").alias("deepest"), F.min(F.when(mine, F.col("depth"))).alias("owned"), F.max_by("owner", F.when(above, F.col("depth"))).alias("over"))
    reach = classes.join(own, "rep", "left").select(
        "rep", "copies", "length",
        F.coalesce("deepest", F.lit(0)).alias("deepest"),
        F.coalesce("owned", F.coalesce("deepest", F.lit(0)) + 1).alias("start"),
        F.coalesce("over", root).alias("over"),
    )
    of_rep = paths.join(classes.select("rep"), paths["conv_id"] == classes["rep"]).select("rep", "depth", "left")
    starts = reach.join(of_rep.select("rep", F.col("depth").alias("start"), F.col("left").alias("start_left")), ["rep", "start"], "left")
    # A class ends in a leaf if no other one shares its end; the only class of all may end at the root.
    alone = F.lit(classes.limit(2).count() == 1)
    leaf = (F.when(F.col("length") > F.col("deepest"), 1).when((F.col("length") == 0) & alone, 1).otherwise(0)).cast("long")
    reach = stored(starts.withColumns({"start_left": F.coalesce("start_left", F.lit(0)), "leaf": leaf}))

    def saved(left: Column, depth: Column) -> Column:
        """What a class adds to the saving below a node: all of its copies' bytes but the first's, and the first's above `start`."""
        return (F.col("copies") - 1) * left + F.when(depth < F.col("start"), left - F.col("start_left")).otherwise(0)

    passing = shared.join(of_rep, ["rep", "depth"]).join(reach, "rep")
    sums = [F.sum("copies").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum("saving").alias("saved_tokens")]
    met = passing.withColumn("saving", saved(F.col("left"), F.col("depth"))).groupBy("owner", "depth").agg(*sums)
    tails = of_rep.join(reach, "rep").where(F.col("depth") > F.col("deepest"))
    lone = tails.select(F.col("rep").alias("owner"), "depth", F.col("copies").alias("n_convs"), F.lit(1).cast("long").alias("n_leaves"), saved(F.col("left"), F.col("depth")).alias("saved_tokens"))
    # From the root on, a class passes all of its bytes.
    whole = reach.join(of_rep.where("depth = 1").select("rep", "left"), "rep", "left").withColumn("saving", saved(F.coalesce("left", F.lit(0)), F.lit(0)))
    base = whole.agg(*sums).where(F.col("n_convs").isNotNull()).select(root.alias("owner"), F.lit(0).cast("long").alias("depth"), "n_convs", "n_leaves", "saved_tokens")
    nodes = base.unionByName(met).unionByName(lone)

    branches = reach.where((F.col("start") <= F.col("length")) & (F.col("rep") != root)).groupBy(F.col("over").alias("owner"), (F.col("start") - 1).alias("depth")).agg(F.count("*").alias("branches"))
    last = shared.join(classes.select("rep", F.col("length").alias("depth")), ["rep", "depth"])
    ends = id_hashes(members).join(classes, "rep").join(last.select("rep", "owner"), "rep", "left")
    ends = ends.select(F.when(F.col("length") == 0, root).otherwise(F.coalesce("owner", "rep")).alias("owner"), F.col("length").alias("depth"), "ends_sha256")
    chain = reach.select(F.col("rep").alias("owner"), "length", "start", "over")
    full = nodes.join(branches, ["owner", "depth"], "left").join(ends, ["owner", "depth"], "left").join(chain, "owner")
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") == 1, root).when(F.col("depth") == F.col("start"), F.col("over")).otherwise(F.col("owner"))
    return full.select(
        F.col("owner").alias("conv_id"),
        "depth",
        parent.cast("long").alias("parent_conv_id"),
        "n_convs",
        (F.coalesce("branches", F.lit(0)) + (F.col("depth") < F.col("length")).cast("long")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, limit: int = BOX) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(*rebuilt(conversations), limit=limit)
