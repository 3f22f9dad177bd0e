"""Merkle manifest of a table, with proofs by pointer jumping.

Each row is a leaf: H (lowercase hex SHA-256) over its columns, each as its UTF-8 byte count,
``:`` and its value, or ``-`` for null.  Leaves of a group (language) ascend by id; every 8
consecutive nodes (fewer at the end) are hashed to one, level by level, until the group's
subroot is left.  The subroots, ordered by group (null first, bytewise), lead to the root in
the same way.

Proofs: every node but the root starts with one segment, its siblings, that leads to its
parent.  A self-join on (node = ancestor) appends the ancestor's segments and takes over its
ancestor, so the distance doubles with each of a logarithmic number of rounds until every
leaf has reached the root.  A key of the join is an ancestor 2**round levels up; rows that
are through leave the join, the other side is the nodes that far up, and planner and AQE
broadcast or split it by its size.

Places of leaves come from one range shuffle of (group, id, hash), positions within its
sorted partitions and running sums of counts by partition; no group is gathered.  Rows that
are equal in all of these are dealt by a salt and stay interchangeable.

Defined cases: null group and null id sort first; equal ids ascend by leaf; repeated rows are
leaves of their own; a lone leaf is its group's subroot, a lone subroot the root; a null id
has no decimal form and is never tampered with; an empty table gives no rows; columns that
are not hashed are left behind, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
TOP = -1  # the tree over the subroots
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field_text(value: Column) -> Column:
    """A value in a leaf: byte count, ``:`` and value, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, values)), 256)


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined_hash(digests: Column) -> Column:
    """H of an array of binary digests, taken as hex text."""
    return F.sha2(F.array_join(F.transform(digests, hexed), ""), 256)


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place`` (from 0, in ``order`` within ``group``, nulls first) and the
    group's ``members``, stored.  One range shuffle; a partition's rows get their places
    from their position and the counts of the partitions before it."""
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    dealt = (salted.repartitionByRange(*keys, F.col("_salt")).sortWithinPartitions(*keys).drop("_salt")
             .withColumn("_at", F.monotonically_increasing_id()))
    laid = staged(dealt, f"{name}-sorted").withColumn("_part", F.shiftright("_at", 33))
    by_part = laid.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select(
        *[F.col(c).alias(f"_{c}") for c in group], F.col("_part").alias("_in"), "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("members"))
    same = reduce(lambda a, b: a & b, [laid[c].eqNullSafe(offsets[f"_{c}"]) for c in group], laid["_part"] == offsets["_in"])
    return laid.join(offsets, same).select(
        *[laid[c] for c in rows.columns], (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "members")


def levels_above(members: int) -> int:
    """Levels from ``members`` nodes up to a single one."""
    n = 0
    while members > 1:
        members, n = -(-members // FAN), n + 1
    return n


def height(members: Column, most: int) -> Column:
    """``levels_above`` as a column, for at most ``most`` members."""
    steps = [F.when(members > FAN ** n, 1).otherwise(0) for n in range(levels_above(most))]
    return reduce(lambda a, b: a + b, steps, F.lit(0))


def build_trees(leaves: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level (tree, level, run, high, members: [node, digest, payload]),
    each stored, and the trees' roots (tree, digest).

    ``leaves``: tree, place, high (levels of its tree), digest (binary) and ``payload``, a
    struct that is null above the leaves.  A tree of one node has no run.
    """
    runs, roots, level = [], [], leaves.select("tree", "place", "high", "digest", "payload")
    for n in range(levels_above(most)):
        roots.append(level.where(F.col("high") == n).select("tree", "digest"))
        run = level.where(F.col("high") > n).groupBy("tree", "high", F.floor(F.col("place") / FAN).alias("run")).agg(
            F.sort_array(F.collect_list(F.struct("place", "digest", "payload"))).alias("members"))
        run = staged(run.withColumn("parent", F.unhex(joined_hash(F.col("members.digest")))), f"{name}-level{n}")
        runs.append(run.withColumn("level", F.lit(n)))
        level = run.select("tree", F.col("run").alias("place"), "high", F.col("parent").alias("digest"),
                           F.lit(None).cast(leaves.schema["payload"].dataType).alias("payload"))
    roots.append(level.select("tree", "digest"))
    return runs, reduce(DataFrame.unionByName, roots)


def first_segments(runs: DataFrame, top: bool) -> DataFrame:
    """Every node of ``runs`` with its siblings and its parent as ancestor.  The parent on a
    group's highest level is the group's place in the tree of subroots."""
    node = F.col("member")
    parent = F.struct(F.col("tree"), (F.col("level") + 1).alias("level"), F.col("run").alias("place"))
    if not top:
        in_top = F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"))
        parent = F.when(F.col("level") + 1 == F.col("high"), in_top).otherwise(parent)
    digests, size = F.col("members.digest"), F.size("members")
    at = F.col("at")
    segment = F.struct(F.slice(digests, F.lit(1), at).alias("left"), F.slice(digests, at + 2, size - at - 1).alias("right"))
    return runs.select("*", F.posexplode("members").alias("at", "member")).select(
        F.struct("tree", "level", node["place"].alias("place")).alias("node"), parent.alias("ancestor"),
        F.array(segment).alias("segments"), node["digest"].alias("digest"), node["payload"].alias("payload"))


def jumped(nodes: DataFrame, distance: int, root: Column) -> DataFrame:
    """One round: nodes that are not at the root take over the segments and the ancestor of
    their ancestor, which stands ``distance`` levels up or in the tree of subroots."""
    onward = nodes.where(F.col("ancestor") != root)
    through = nodes.where(F.col("ancestor") == root)
    high_up = (F.col("node.tree") == TOP) | (F.col("node.level") >= distance)
    far = nodes.where(high_up).select(F.col("node").alias("_node"), F.col("ancestor").alias("_ancestor"), F.col("segments").alias("_segments"))
    moved = onward.join(far, F.col("ancestor") == F.col("_node")).select(
        "node", F.col("_ancestor").alias("ancestor"), F.concat("segments", "_segments").alias("segments"), "digest", "payload")
    return through.unionByName(moved)


def folded(start: Column, segments: Column) -> Column:
    """The hex digest that ``start`` (hex) and the siblings on its way lead to."""
    return F.aggregate(segments, start, lambda h, s: F.sha2(F.concat(
        F.array_join(F.transform(s["left"], hexed), ""), h, F.array_join(F.transform(s["right"], hexed), "")), 256))


def merkle_proofs(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
                  tampered: dict[str, Column] | None = None, tamper_where: Column | None = None) -> tuple[DataFrame, str | None]:
    """(doc_id, leaf, presented, high, segments) of every row, and the root (None if there
    are no rows).  ``segments`` is the proof: by level up to the root, the digests left and
    right of the node on the way.  ``presented`` is the leaf of the row as presented, with
    the columns in ``tampered`` replaced where ``tamper_where`` holds."""
    values = {c: F.col(f"`{c}`") for c in columns}
    leaf = leaf_hash(list(values.values()))
    other = leaf_hash([(tampered or {}).get(c, v) for c, v in values.items()])
    presented = F.when(tamper_where, other).otherwise(F.col("leaf")) if tampered and tamper_where is not None else F.col("leaf")
    hashed = docs.withColumn("leaf", leaf).select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{group_col}`").cast("string").alias("grp"),
        F.unhex("leaf").alias("leaf"), F.unhex(presented).alias("presented"))
    placed = staged(numbered(staged(hashed, "merkle-leaves"), ["grp"], ["doc_id", "leaf"], "merkle"), "merkle-placed")
    groups = staged(placed.groupBy("grp").agg(F.max("members").alias("members")), "merkle-groups")
    most, n_groups = groups.agg(F.max("members"), F.count(F.lit(1))).first()
    if not n_groups:
        schema = "doc_id {}, leaf string, presented string, high int, segments array<struct<left: array<binary>, right: array<binary>>>"
        return docs.sparkSession.createDataFrame([], schema.format(placed.schema["doc_id"].dataType.simpleString())), None

    order = numbered(groups.select("grp", F.lit(1).alias("one")), ["one"], ["grp"], "merkle-order").select(
        F.col("grp").alias("_grp"), F.col("place").alias("tree"))
    leaves = placed.join(order, placed["grp"].eqNullSafe(order["_grp"])).select(
        "tree", "place", height(F.col("members"), most).alias("high"), F.col("leaf").alias("digest"),
        F.struct("doc_id", "presented", height(F.col("members"), most).alias("high")).alias("payload"))
    runs, subroots = build_trees(leaves, most, "merkle-tree")
    payload = leaves.schema["payload"].dataType
    tops = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"),
                           F.lit(levels_above(n_groups)).alias("high"), "digest", F.lit(None).cast(payload).alias("payload"))
    top_runs, top = build_trees(tops, n_groups, "merkle-top")
    root = top.first()["digest"]

    height_all = levels_above(most) + levels_above(n_groups)
    lone = leaves.where(F.col("high") == 0).select(  # a lone leaf stands in the tree of subroots itself
        F.struct("tree", F.lit(0).alias("level"), "place").alias("node"),
        F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place")).alias("ancestor"),
        F.array().cast("array<struct<left: array<binary>, right: array<binary>>>").alias("segments"), "digest", "payload")
    nodes = reduce(DataFrame.unionByName, [lone, *(first_segments(r, top=False) for r in runs), *(first_segments(r, top=True) for r in top_runs)])
    end = F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(levels_above(n_groups)).alias("level"), F.lit(0).cast("long").alias("place"))
    distance = 1
    while distance < height_all + 1:  # a lone leaf is one jump behind
        nodes = jumped(nodes, distance, end)
        distance *= 2
        if distance < height_all + 1:
            nodes = staged(nodes, f"merkle-jump{distance}")
    proofs = nodes.where(F.col("payload").isNotNull()).select(
        F.col("payload.doc_id").alias("doc_id"), hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("payload.presented")).alias("presented"), F.col("payload.high").alias("high"), "segments")
    return proofs, bytes(root).hex()


def lowered_text(text_col: str = "text") -> Column:
    """A text with only A-Z lower-cased."""
    return F.translate(F.col(f"`{text_col}`"), UPPER, LOWER)


def every_third(id_col: str = "doc_id") -> Column:
    """Whether 3 divides the CRC-32 of the decimal id (never, without an id)."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): the manifest, with
    each row's proof checked against the row as presented (every third one tampered with)."""
    proofs, root = merkle_proofs(docs, tampered={"text": lowered_text()}, tamper_where=every_third())
    siblings = F.flatten(F.transform("segments", lambda s: F.concat(s["left"], s["right"])))
    return proofs.select(
        "doc_id", "leaf", folded(F.col("leaf"), F.slice("segments", F.lit(1), F.col("high"))).alias("subroot"),
        F.lit(root).cast("string").alias("root"), joined_hash(siblings).alias("proof_sha256"),
        folded(F.col("presented"), F.col("segments")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
