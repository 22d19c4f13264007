"""Shared prefixes of conversations as a z-fast trie over turns.

A conversation is a string whose letters are its turns (role, text). Prefixes are told apart by two 64-bit hashes, running
over the turns. The compacted trie keeps one row per edge: its owner (the smallest conversation below it), its extent (the
depth where it ends), its handle, the owner's prefix at the two-fattest depth of the edge (the depth between its ends that
is divisible by the highest power of two), and its name, the prefix one turn below its start.

Conversations are inserted in batches of rising ids, each about as large as all before. A conversation of n turns finds the
edge where it leaves the trie, or the one above, by a fat binary search: at most log2(n) + 1 look-ups of one prefix each
among the handles, as joins for the whole batch; one look-up among the names decides which. Comparing the turns of that
edge alone then gives its exit depth. What lies below its exit is
new; new prefixes of one batch meet by a grouping of their hashes, the smallest conversation owns each. As ids rise, the
exit of a conversation is at once where the nodes that it owns begin, and the owner of the node above is its parent.

Sums over subtrees run up the tree of parents by pointer doubling, and along each owner's turns by running sums. At the
end the edges are expanded into a row per node. Equal conversations are one string with a count throughout.

Nothing gathers a conversation, a group of copies or the children of a node in one place: running sums are cut every
SPAN turns, shared prefixes and copies are partial aggregates, and the ids that end in one node reach its hash as sorted
pieces. Only that hash itself reads its ids in one task, as SHA-256 has to.

Defined results: null roles and texts are empty; turns are ordered by number, null first, then by role and text; rows
without a conversation id belong to none and are left out; repeated rows are repeated turns; the rest of a negative id by 5
has the sign of the id; an empty table gives an empty result. Only id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.scratch import keep, ship

#: Turns per running sum, and ids per piece of a list of ids.
SPAN, PIECE = 4096, 1024
_EMPTY = hashlib.sha256().hexdigest()
#: Sums that go up the tree: conversations, their bytes, bytes of the distinct prefixes, leaves.
SUMS = ("convs", "conv_bytes", "own_bytes", "leaves")


def numbered(conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, at (from 0), two hashes and the bytes of each turn, in order."""
    turns = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("span", F.floor(F.col("turn") / SPAN))
    inside = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    found = turns.select(
        "conv_id", "span", (F.row_number().over(inside) - 1).cast("long").alias("at"),
        F.xxhash64("role", "text").alias("x1"), F.xxhash64("text", "role", F.lit(1)).alias("x2"), F.octet_length("text").cast("long").alias("bytes"),
    )
    found = keep(found, "turns")
    before = Window.partitionBy("conv_id").orderBy(F.col("span").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("conv_id", "span").agg(F.count("*").alias("n"))
    later = sizes.withColumn("before", F.sum("n").over(before)).filter("before IS NOT NULL").select("conv_id", F.col("span").alias("_span"), "before")
    joined = found.join(later.withColumnRenamed("conv_id", "_id"), (F.col("conv_id") == F.col("_id")) & F.col("span").eqNullSafe(F.col("_span")), "left")
    return joined.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "x1", "x2", "bytes")


def rebuilt(turns: DataFrame, *, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are those of the first of their `group`, h = crc32(id) % `most`.

    Returns (conv_id, len) and the turns (conv_id, len, at, x1, x2, bytes).
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n")).selectExpr(
        "conv_id", "n", f"crc32(cast(conv_id AS STRING)) % {most} AS h", f"conv_id - conv_id % {group} AS base"
    )
    own = keep(own, "conversations")
    lengths = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    sizes = own.join(lengths, "base", "left").selectExpr(
        "conv_id", "base", "h", "least(h, coalesce(base_n, 0)) AS taken", "least(h, coalesce(base_n, 0)) + greatest(n - h, 0) AS len"
    )
    sizes = keep(sizes, "lengths")
    later = turns.join(sizes, "conv_id").filter("at >= h").selectExpr("conv_id", "len", "taken + at - h AS at", "x1", "x2", "bytes")
    first = turns.filter(F.col("at") < most - 1).withColumnRenamed("conv_id", "base").join(sizes, "base").filter("at < h")
    return sizes.select("conv_id", "len"), later.unionByName(first.select("conv_id", "len", "at", "x1", "x2", "bytes"))


def _running(rows: DataFrame, key: str, depth: str, sums: dict[str, str], backwards: bool = False) -> DataFrame:
    """Adds running aggregates along the rows of a key, `sums` being column -> aggregate function of it, inclusive.

    `rows` has `len`, the largest depth of the key. Within SPAN rows a window runs; totals of whole spans are added to the
    rows of the spans behind them, for the keys that have several.
    """
    order = F.col(depth).desc() if backwards else F.col(depth).asc()
    rows = rows.withColumn("_span", F.floor(F.col(depth) / SPAN))
    inside = Window.partitionBy(key, "_span").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = keep(rows.withColumns({f"run_{c}": F.expr(f"{f}({c})").over(inside) for c, f in sums.items()}), "running")
    long = done.filter(F.col("len") >= SPAN)
    spans = F.col("_span").desc() if backwards else F.col("_span").asc()
    behind = Window.partitionBy(key).orderBy(spans).rowsBetween(Window.unboundedPreceding, -1)
    totals = long.groupBy(key, "_span").agg(*(F.expr(f"{f}({c})").alias(f"all_{c}") for c, f in sums.items()))
    totals = totals.select(key, "_span", *(F.expr(f"{f}(all_{c})").over(behind).alias(f"add_{c}") for c, f in sums.items()))

    def plus(c: str, f: str):
        add = F.coalesce(F.col(f"add_{c}"), F.lit(0))
        return F.col(f"run_{c}").bitwiseXOR(add) if f == "bit_xor" else F.col(f"run_{c}") + add

    joined = long.join(totals, [key, "_span"]).select(*rows.columns, *(plus(c, f).alias(f"run_{c}") for c, f in sums.items()))
    return done.filter(F.col("len") < SPAN).unionByName(joined).drop("_span")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, len, depth (from 1), the hashes h1, h2 of the first `depth` turns, and `upto`, their bytes."""
    mixed = turns.select("conv_id", "len", (F.col("at") + 1).alias("depth"), F.xxhash64("x1", "x2", "at").alias("h1"), F.xxhash64("at", "x2", "x1").alias("h2"), "bytes")
    found = _running(mixed, "conv_id", "depth", {"h1": "bit_xor", "h2": "bit_xor", "bytes": "sum"})
    return found.select("conv_id", "len", "depth", F.col("run_h1").alias("h1"), F.col("run_h2").alias("h2"), "bytes", F.col("run_bytes").alias("upto"))


def _two_fattest(low: str, high: str) -> str:
    """The depth in (low, high] that is divisible by the highest power of two."""
    bits = f"(length(bin({low} ^ {high})) - 1)"
    return f"shiftleft(shiftright({high}, {bits}), {bits})"


def _edges(points: DataFrame, begins: DataFrame, paths: DataFrame) -> DataFrame:
    """Edges of the compacted trie from its extents (owner, extent): start, fat, handle k1, k2 and name n1, n2."""
    up = Window.partitionBy("owner").orderBy("extent")
    edges = points.join(begins, "owner").withColumn("start", F.coalesce(F.lag("extent").over(up), F.greatest("begin", F.lit(0))))
    edges = edges.withColumn("fat", F.expr(_two_fattest("start", "extent")))
    handles = paths.select(F.col("conv_id").alias("owner"), F.col("depth").alias("fat"), F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    names = paths.select(F.col("conv_id").alias("owner"), (F.col("depth") - 1).alias("start"), F.col("h1").alias("n1"), F.col("h2").alias("n2"))
    return edges.join(handles, ["owner", "fat"]).join(names, ["owner", "start"])


def _exits(batch: DataFrame, paths: DataFrame, edges: DataFrame, all_paths: DataFrame, longest: int) -> DataFrame:
    """conv_id, exit (depth of its longest prefix in the trie), above (owner there; null: the root) for each of a batch."""
    found = batch.select("conv_id", F.lit(0).cast("long").alias("low"), F.col("len").alias("high"), *(F.lit(None).cast("long").alias(c) for c in ("owner", "start", "extent")))
    own = paths.select(F.col("conv_id").alias("_id"), F.col("depth").alias("_at"), F.col("h1").alias("_k1"), F.col("h2").alias("_k2"))
    handles = edges.select(*(F.col(c).alias(f"e_{c}") for c in edges.columns))
    for step in range(longest.bit_length()):
        asked = found.withColumn("fat", F.when(F.col("low") < F.col("high"), F.expr(_two_fattest("low", "high"))))
        asked = asked.join(own, (F.col("conv_id") == F.col("_id")) & (F.col("fat") == F.col("_at")), "left")
        hit = asked.join(handles, (F.col("fat") == F.col("e_fat")) & (F.col("_k1") == F.col("e_k1")) & (F.col("_k2") == F.col("e_k2")), "left")
        yes = F.col("e_owner").isNotNull()
        found = hit.select(
            "conv_id",
            F.when(yes, F.col("e_extent")).otherwise(F.col("low")).alias("low"),
            F.when(F.col("fat").isNotNull() & ~yes, F.col("fat") - 1).otherwise(F.col("high")).alias("high"),
            *(F.when(yes, F.col(f"e_{c}")).otherwise(F.col(c)).alias(c) for c in ("owner", "start", "extent")),
        )
        if step % 4 == 3:
            found = keep(found, "search")
    # Where the edge found is only the one above, the exit edge begins at its extent with the next turn.
    below = own.select("_id", (F.col("_at") - 1).alias("low"), F.col("_k1").alias("e_n1"), F.col("_k2").alias("e_n2"))
    child = found.join(below, (F.col("conv_id") == F.col("_id")) & (found["low"] == below["low"]), "left").drop(below["low"])
    child = child.join(handles, (F.col("low") == F.col("e_start")) & (child["e_n1"] == handles["e_n1"]) & (child["e_n2"] == handles["e_n2"]), "left")
    found = child.select("conv_id", *(F.coalesce(f"e_{c}", c).alias(c) for c in ("owner", "start", "extent")))
    found = keep(found, "exits")
    # The turns of the exit edge, against the owner's.
    on_edge = paths.join(found.filter("owner IS NOT NULL"), "conv_id").filter("depth > start AND depth <= extent").select("conv_id", "owner", "depth", "h1", "h2")
    theirs = all_paths.select(F.col("conv_id").alias("owner"), "depth", "h1", "h2")
    matched = on_edge.join(theirs, ["owner", "depth", "h1", "h2"]).groupBy("conv_id").agg(F.max("depth").alias("exit"))
    return found.select("conv_id", F.col("owner").alias("above")).join(matched, "conv_id", "left").withColumn("exit", F.coalesce("exit", F.lit(0).cast("long")))


def _insert(batch: DataFrame, paths: DataFrame, exits: DataFrame) -> DataFrame:
    """conv_id, len, begin (depth above the nodes it owns), above (owner of the node there) for each of a batch."""
    fresh = paths.join(exits, "conv_id").filter("depth > exit").select("conv_id", "depth", "h1", "h2")
    owners = fresh.groupBy("h1", "h2", "depth").agg(F.min("conv_id").alias("first"))
    shared = fresh.join(owners, ["h1", "h2", "depth"]).filter("first <> conv_id").groupBy("conv_id").agg(
        F.max("depth").alias("_depth"), F.max_by("first", "depth").alias("_first")
    )
    rows = batch.select("conv_id", "len").join(exits, "conv_id").join(shared, "conv_id", "left")
    return rows.select("conv_id", "len", F.coalesce("_depth", "exit").alias("begin"), F.coalesce("_first", "above").alias("above"))


def insert_all(strings: DataFrame, paths: DataFrame, *, batches: int = 3) -> DataFrame:
    """conv_id, len, begin, above of all distinct conversations: `begin` is -1 for the smallest, which owns the root."""
    ends = strings.agg(
        F.min("conv_id").alias("root"), F.max("len").alias("longest"),
        F.percentile_approx("conv_id", F.array(*(F.lit(0.5**i) for i in range(batches - 1, 0, -1))) if batches > 1 else F.array(F.lit(1.0)), 1000).alias("cuts"),
    ).first()
    root, longest, cuts = ends["root"], ends["longest"] or 0, sorted(set(ends["cuts"] or []))[: batches - 1]
    done: list[DataFrame] = []
    edges = None
    for i in range(len(cuts) + 1):
        part = F.lit(True)
        if i:
            part = part & (F.col("conv_id") > cuts[i - 1])
        if i < len(cuts):
            part = part & (F.col("conv_id") <= cuts[i])
        batch, own = strings.filter(part), paths.filter(part)
        if edges is None:
            exits = batch.select("conv_id", F.lit(None).cast("long").alias("above"), F.lit(0).cast("long").alias("exit"))
        else:
            exits = keep(_exits(batch, own, edges, paths, longest), "exits")
        placed = _insert(batch, own, exits)
        is_root = F.col("conv_id") == F.lit(root)
        placed = placed.select(
            "conv_id", "len", F.when(is_root, F.lit(-1).cast("long")).otherwise(F.col("begin")).alias("begin"),
            F.when(~is_root, F.coalesce("above", F.lit(root))).cast("long").alias("above"),
        )
        done.append(keep(placed, "placed"))
        if i < len(cuts):
            so_far = done[0]
            for more in done[1:]:
                so_far = so_far.unionByName(more)
            points = so_far.filter("begin > 0").select(F.col("above").alias("owner"), F.col("begin").alias("extent"))
            points = points.unionByName(so_far.filter("len > begin AND len > 0").select(F.col("conv_id").alias("owner"), F.col("len").alias("extent"))).distinct()
            begins = so_far.select(F.col("conv_id").alias("owner"), "begin")
            edges = keep(_edges(points, begins, paths), "edges")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _up(placed: DataFrame) -> DataFrame:
    """SUMS of each conversation over all that hang below it: each round doubles the distance that the sums have come."""
    now = placed
    while not now.filter("above IS NOT NULL").isEmpty():
        below = now.filter("above IS NOT NULL").groupBy(F.col("above").alias("conv_id")).agg(*(F.sum(c).alias(f"_{c}") for c in SUMS))
        next_up = now.select(F.col("conv_id").alias("above"), F.col("above").alias("_above"))
        after = now.join(below, "conv_id", "left").join(next_up, "above", "left")
        now = keep(after.select("conv_id", F.col("_above").alias("above"), *((F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in SUMS)), "sums")
    return now.select("conv_id", *SUMS)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Numbers in all columns but the last, which holds text."""
    columns = list(zip(*rows))
    kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def list_hashes(members: DataFrame, keys: list[str], member: str) -> DataFrame:
    """keys, ends_sha256: SHA-256 of the decimal numbers `member` of each key, rising and joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: list = []
        ids: list[int] = []
        done: list[tuple] = []

        def close() -> None:
            done.append((*key, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for *own, one in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (own != key or len(ids) == PIECE):
                    close()
                    ids = []
                    if len(done) == PIECE:
                        yield _rows(done, [*keys, "least", "piece"])
                        done = []
                key = own
                ids.append(one)
        if ids:
            close()
            yield _rows(done, [*keys, "least", "piece"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: list = []
        digest = None
        for batch in batches:
            done: list[tuple] = []
            for *own, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is not None and own == key:
                    digest.update(b",")
                else:
                    if digest is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                digest.update(text.encode())
            if done:
                yield _rows(done, [*keys, "ends_sha256"])
        if digest is not None:
            yield _rows([(*key, digest.hexdigest())], [*keys, "ends_sha256"])

    kinds = ", ".join(f"{k} long" for k in keys)
    ship(members.sparkSession)
    order = [*keys, member]
    cut = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, f"{kinds}, least long, piece string")
    cut = keep(cut, "pieces")
    return cut.repartition(*(F.col(k) for k in keys)).sortWithinPartitions(*keys, "least").mapInArrow(hashes, f"{kinds}, ends_sha256 string")


def nodes(conversations: DataFrame, *, group: int = 5, most: int = 9, batches: int = 3, **columns: str) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations: see the queries' contract for its columns."""
    lengths, turns = rebuilt(numbered(conversations, **columns), group=group, most=most)
    paths = keep(prefixes(turns), "prefixes")
    nothing = {c: F.lit(0).cast("long") for c in ("h1", "h2", "upto")}
    ends = paths.filter("depth = len").select("conv_id", "len", "h1", "h2", "upto")
    ends = keep(ends.unionByName(lengths.filter("len = 0").select("conv_id", "len").withColumns(nothing)), "ends")
    strings = keep(ends.groupBy("len", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("upto").alias("full")), "strings")
    paths = keep(paths.drop("len").join(strings.select("conv_id", "len"), "conv_id"), "paths")
    placed = keep(insert_all(strings, paths, batches=batches), "trie")

    above_bytes = paths.select("conv_id", F.col("depth").alias("begin"), F.col("upto").alias("shared"))
    ended_on = placed.filter("begin >= 0").select(F.col("above").alias("conv_id"), F.col("begin").alias("len")).distinct().withColumn("_inner", F.lit(True))
    own = placed.join(strings.select("conv_id", "n", "full"), "conv_id").join(above_bytes, ["conv_id", "begin"], "left").join(ended_on, ["conv_id", "len"], "left")
    leaf = (F.col("len") > F.col("begin")) & F.col("_inner").isNull()
    own = own.select(
        "conv_id", "len", "begin", "above", "full", F.col("n").alias("convs"), (F.col("n") * F.col("full")).alias("conv_bytes"),
        (F.col("full") - F.coalesce("shared", F.lit(0))).alias("own_bytes"), leaf.cast("long").alias("leaves"),
    )
    own = keep(own, "own")
    total = _up(own.select("conv_id", "above", *SUMS))

    hanging = own.filter("above IS NOT NULL").select("conv_id", "above", "begin", (F.col("len") > F.col("begin")).cast("long").alias("child"))
    hanging = hanging.join(total, "conv_id").groupBy(F.col("above").alias("conv_id"), F.col("begin").alias("depth")).agg(
        F.sum("child").alias("hung"), *(F.sum(c).alias(f"below_{c}") for c in SUMS)
    )
    # Edges expanded: the turns that each conversation owns, and the root.
    steps = paths.select("conv_id", "depth", "bytes", "upto").unionByName(
        own.filter("begin = -1").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("upto"))
    )
    rows = steps.join(own.drop("own_bytes"), "conv_id").filter("depth > begin").join(hanging, ["conv_id", "depth"], "left")
    rows = rows.withColumns({f"below_{c}": F.coalesce(F.col(f"below_{c}"), F.lit(0)) for c in SUMS})
    rows = _running(rows, "conv_id", "depth", {f"below_{c}": "sum" for c in SUMS}, backwards=True)

    end = own.select(F.col("conv_id").alias("string"), F.when(F.col("len") > F.col("begin"), F.col("conv_id")).otherwise(F.col("above")).alias("node"), F.col("len").alias("depth"))
    same = strings.select(F.col("conv_id").alias("string"), "len", "h1", "h2")
    members = ends.join(same, ["len", "h1", "h2"]).join(end, "string").select("node", "depth", "conv_id")
    finished = list_hashes(members, ["node", "depth"], "conv_id").withColumnRenamed("node", "conv_id")

    n_convs = F.col("convs") + F.col("run_below_convs")
    before = F.col("upto") - F.col("bytes")
    saved = F.col("conv_bytes") + F.col("run_below_conv_bytes") - n_convs * before - (F.col("full") - before) - F.col("run_below_own_bytes")
    return rows.join(finished, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("begin") + 1, F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
        n_convs.alias("n_convs"), (F.coalesce("hung", F.lit(0)) + (F.col("depth") < F.col("len")).cast("long")).alias("n_children"),
        (F.col("leaves") + F.col("run_below_leaves")).alias("n_leaves"), saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
