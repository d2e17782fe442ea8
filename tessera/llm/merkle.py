"""Merkle manifest of a dataset: built natively, proved by a recursive query.

H is the lowercase hex SHA-256 of its inputs put one after the other. A row's
leaf is H of its columns, each ``-`` where null, else its UTF-8 byte count, ``:`` and
the value. The leaves of a group (a value of ``group``) ascend by id; as long as a level has several
nodes, every two consecutive ones (the last one alone, where their number is odd) become their H. What
remains is the group's subroot; the subroots, ordered by group (null first, by bytes), give the root likewise.

The built levels are stored as parent-linked node rows: a node's key, its digest, the key of its
ancestor ``stride`` levels up and the siblings met on the way there. A row a level is ``stride`` = 1;
larger strides store only every so many levels and keep the siblings of those between, so that a climb moves each
leaf fewer times. Levels are built in blocks of 2 ** ``stride`` consecutive nodes, which bounds every group.

A recursive query then climbs from every leaf at once: each step joins the climbers with the node rows they have reached, appends
the siblings to the proof, folds them into the hash, and goes on to the parent, until there is none.

Digests are kept as 32 bytes and hashed as hex text. Handling of odd rows: null ids come first, rows
with one id are ordered by their leaf, equal rows by their place in their file (they prove alike); repeated rows are
leaves of their own; null groups are a group; a number that can't be raised by one counts as null when tampered with;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise, own_places
from .order import numbered

#: Levels that a node row spans, and so the binary logarithm of the nodes of a block.
STRIDE = 12

#: Node rows above the leaves that are broadcast at most (under 1 KB each).
MAX_BROADCAST_NODES = 20_000

#: Spark's own bound on the rows of a recursive query, which grows with the leaves here.
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def field(value: Column) -> Column:
    """One column's part of a leaf: ``-`` for null, else byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*hex_or_text: Column) -> Column:
    """H of its inputs as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*hex_or_text), 256))


def as_hex(x: Column) -> Column:
    return F.lower(F.hex(x))


def _parents(nodes: Column) -> Column:
    """The digests a level above ``nodes`` (an array in order)."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) + 1) / 2).cast("int") - 1), lambda i: digest(
        as_hex(F.get(nodes, i * 2)), F.coalesce(as_hex(F.get(nodes, i * 2 + 1)), F.lit(""))))


_CARRIED = ["node", "doc_id", "tampered", "is_leaf", "is_subroot"]


def _ascend(nodes: DataFrame, stride: int) -> tuple[DataFrame, DataFrame]:
    """Node rows of a level (tree, members, level, idx, node, digest; several members a tree), and the nodes ``stride`` levels up."""
    runs = nodes.groupBy("tree", "members", "level", F.shiftright("idx", stride).alias("block")) \
        .agg(F.sort_array(F.collect_list(F.struct("idx", "digest", *_CARRIED))).alias("run"))
    # levels from here to the tree's end: the bits of (members - 1)
    runs = runs.withColumn("steps", F.least(F.lit(stride), F.length(F.bin(F.col("members") - 1))))
    levels = F.aggregate(F.sequence(F.lit(1), F.col("steps")), F.array(F.col("run.digest")),
                         lambda built, _: F.concat(built, F.array(_parents(F.element_at(built, -1)))))
    runs = runs.withColumn("levels", levels).withColumns({
        "up_level": (F.col("level") + F.col("steps")).cast("int"), "up_digest": F.get(F.element_at("levels", -1), F.lit(0))})
    runs = runs.withColumn("up", node_key(F.col("tree"), F.col("up_level"), F.col("block")))

    def siblings(place: Column) -> Column:
        def at(level: Column) -> Column:
            here = F.floor(place / F.pow(F.lit(2), level)).cast("int")
            beside = here.bitwiseXOR(F.lit(1))
            return F.struct((here > beside).alias("before"), F.get(F.get("levels", level), beside).alias("digest"))
        return F.transform(F.sequence(F.lit(0), F.col("steps") - 1), at)

    rows = runs.select("up", F.inline(F.transform("run", lambda x, i: F.struct(
        x["digest"].alias("digest"), *[x[c].alias(c) for c in _CARRIED], siblings(i).alias("siblings"))))) \
        .withColumnRenamed("up", "parent")
    above = runs.select("tree", F.ceil(F.col("members") / F.pow(F.lit(2.0), F.col("steps"))).cast("long").alias("members"), F.col("up_level").alias("level"),
                        F.col("block").alias("idx"), F.col("up_digest").alias("digest"), F.col("up").alias("node"),
                        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("tampered"),
                        F.lit(False).alias("is_leaf"), F.lit(False).alias("is_subroot"))
    return rows, above


def node_key(tree: Column, level: Column, idx: Column) -> Column:
    return F.concat_ws("/", tree, level.cast("string"), idx.cast("string"))


_NODE = ["parent", "digest", *_CARRIED, "siblings"]


def _build(nodes: DataFrame, stride: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored node rows of all trees in ``nodes``, and each tree's last node."""
    stored, ends = [], []
    top = nodes.agg(F.max("members")).first()[0] or 0
    while True:
        ends.append(nodes.filter("members = 1"))
        if top <= 1:
            break
        rows, above = _ascend(nodes.filter("members > 1"), stride)
        stored.append(materialise(rows.select(*_NODE), f"{name}-nodes"))
        nodes = materialise(above, f"{name}-level")
        top = -(-top >> stride)
    last = ends[0]
    for other in ends[1:]:
        last = last.unionByName(other)
    return stored, last


def nodes_of(leaves: DataFrame, stride: int = STRIDE) -> DataFrame:
    """The manifest: node rows (node, digest, parent, siblings, and doc_id, tampered of leaves) of
    ``leaves`` (doc_id, grp, leaf, tampered, file, place)."""
    leaves = numbered(leaves, [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("file"), F.col("place")], "merkle-leaves", group="grp")
    # a tree's name: its group, told apart from null and from the tree of subroots
    tree = F.coalesce(F.concat(F.lit("g"), F.col("grp")), F.lit("null"))
    leaves = leaves.select(tree.alias("tree"), "members", F.lit(0).alias("level"), "idx", F.col("leaf").alias("digest"),
                           node_key(tree, F.lit(0), F.col("idx")).alias("node"), "doc_id", "tampered",
                           F.lit(True).alias("is_leaf"), F.lit(False).alias("is_subroot"))
    lower, subroots = _build(leaves, stride, "merkle")
    subroots = numbered(subroots.drop("members", "idx", "is_subroot"), [(F.col("tree") != "null"), F.col("tree")], "merkle-subroots")
    upper, root = _build(subroots.withColumns({"tree": F.lit("root"), "level": F.lit(0), "is_subroot": F.lit(True)}), stride, "merkle-root")
    root = root.select(F.lit(None).cast("string").alias("parent"), "digest", *_CARRIED,
                       F.array().cast("array<struct<before:boolean,digest:binary>>").alias("siblings"))
    out = root.select(*_NODE)
    for rows in (*lower, *upper):
        out = out.unionByName(rows)
    return materialise(out, "merkle-manifest")


def climb(nodes: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (siblings' digests, 32 bytes each), folded of every leaf:
    ``folded`` is what the leaf, tampered with where it is, gives with its siblings."""
    spark = nodes.sparkSession
    fold = """aggregate(n.siblings, {0}, (x, s) -> unhex(sha2(CASE WHEN s.before THEN concat(coalesce(lower(hex(s.digest)), ''), lower(hex(x)))
        ELSE concat(lower(hex(x)), coalesce(lower(hex(s.digest)), '')) END, 256)))"""
    proof = "aggregate(n.siblings, {0}, (x, s) -> concat(x, coalesce(s.digest, X'')))"
    climbed = spark.sql(f"""
        WITH RECURSIVE climb AS (
          SELECT n.doc_id, n.digest AS leaf, n.parent AS at, {proof.format("X''")} AS proof, {fold.format("coalesce(n.tampered, n.digest)")} AS folded,
                 CASE WHEN n.is_subroot THEN n.digest END AS subroot, CASE WHEN n.parent IS NULL THEN n.digest END AS root
          FROM {{leaves}} n
          UNION ALL
          SELECT c.doc_id, c.leaf, n.parent, {proof.format("c.proof")}, {fold.format("c.folded")},
                 coalesce(c.subroot, CASE WHEN n.is_subroot THEN n.digest END), CASE WHEN n.parent IS NULL THEN n.digest END
          FROM climb c JOIN {{upper}} n ON c.at = n.node)
        SELECT doc_id, leaf, subroot, root, proof, folded FROM climb WHERE at IS NULL""",
        leaves=nodes.filter("is_leaf"), upper=broadcast_if_small(nodes.filter("NOT is_leaf"), MAX_BROADCAST_NODES))
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        return materialise(climbed, "merkle-climb")
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def manifest(docs: DataFrame, id_col: str = "doc_id", group: str = "lang", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             counter: str = "n_chars", tampered: Column | None = None, stride: int = STRIDE) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row, all but the last two
    of the untampered table. Where ``tampered`` (a condition on ``_id``) holds, ``counter`` is one more in the row that is folded."""
    rows = own_places(docs, "merkle-docs")
    rows = rows.select(F.col(f"_doc.{id_col}").cast("long").alias("_id"), F.col(f"_doc.{group}").cast("string").alias("grp"),
                       *[F.col(f"_doc.{c}").alias(f"_v{k}") for k, c in enumerate(columns)], "file", "place")
    plain = [field(F.col(f"_v{k}")) for k in range(len(columns))]
    more = [field(F.try_add(F.col(f"_v{k}"), F.lit(1))) if c == counter else plain[k] for k, c in enumerate(columns)]
    leaves = rows.select(F.col("_id").alias("doc_id"), "grp", digest(*plain).alias("leaf"),
                         F.when(tampered if tampered is not None else F.lit(False), digest(*more)).alias("tampered"), "file", "place")
    found = climb(nodes_of(materialise(leaves, "merkle-leaf"), stride))
    return found.select("doc_id", as_hex(F.col("leaf")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), as_hex(F.col("root")).alias("root"),
                        F.sha2(as_hex(F.col("proof")), 256).alias("proof_sha256"), as_hex(F.col("folded")).alias("folded_root"),
                        (F.col("folded") == F.col("root")).alias("verified"))
